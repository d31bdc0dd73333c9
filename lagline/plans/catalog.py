"""All registered queries; importing the parts registers them."""

from lagline.plans import (  # noqa: F401
    catalog_eda,
    catalog_models,
    catalog_quality,
    catalog_scalars,
    catalog_shapes,
    catalog_sources,
    catalog_survival,
)
from lagline.plans.registry import ORACLES, QUERIES  # noqa: F401
from lagline.session import release


def forget() -> None:
    """Drop fitted models and kept frames, so that the next run computes them again."""
    for part in (catalog_models, catalog_survival):
        for value in vars(part).values():
            if hasattr(value, "cache_clear"):
                value.cache_clear()
    release()
