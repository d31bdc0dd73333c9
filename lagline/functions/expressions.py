"""Scalar column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Service threshold, censoring horizon, report thresholds and category labels.
DELAY_MINUTES = 8.0
CENSOR_MINUTES = 60.0
THRESHOLDS = (8, 10, 30, 60)
HOUR_LEVELS = ("Night", "Morning", "Afternoon", "Evening")
SEASON_LEVELS = ("winter", "spring", "summer", "fall")
DAY_LEVELS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
TIME_OF_DAY = ("Night (12AM-6AM)", "Morning (6AM-12PM)", "Afternoon (12PM-6PM)", "Evening (6PM-12AM)")
RESPONSE_BANDS = ((5, "Excellent (<5 min)"), (10, "Good (5-10 min)"), (15, "Fair (10-15 min)"))
RESPONSE_WORST = "Poor (>15 min)"
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy h:mm a")
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
HR_SLOWER = "HR < 1 → slower arrival (higher delay risk)"
HR_FASTER = "HR > 1 → faster arrival (lower delay risk)"
HR_NEUTRAL = "HR = 1 → no change"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cases(pairs: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """First matching condition wins; NULL conditions never match."""
    out = None
    for condition, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def yes_no(c: str | Column) -> Column:
    """Y/N text to boolean, anything else to NULL."""
    s = F.upper(F.trim(as_col(c)))
    return F.when(s == "Y", True).when(s == "N", False)


def upper_trim(c: str | Column) -> Column:
    return F.upper(F.trim(as_col(c)))


def _shape(fmt: str) -> str:
    """A pattern that every text of a datetime format has; cheap to test before parsing."""
    out = []
    for token in re.findall(r"'[^']*'|[A-Za-z]+|[^A-Za-z']", fmt):
        if token.startswith("'"):
            out.append(re.escape(token[1:-1]))
        elif not token.isalpha():
            out.append(re.escape(token))
        else:
            out.append(r"[+-]?[0-9]+" if token[0] in "yMdHhmsS" and not token.startswith("MMM") else ".+")
    return "^" + "".join(out) + "$"


def parse_timestamp(c: str | Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Parse by the first format that fits; text fitting none gives NULL.

    A failing parse costs far more than a pattern test, so a format is only tried on text of its shape.
    """
    text = as_col(c)
    return F.coalesce(*[F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f))) for f in formats])


def epoch_seconds(c: str | Column) -> Column:
    return F.unix_timestamp(as_col(c).cast("timestamp"))


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end, NULL when either is missing."""
    return epoch_seconds(end) - epoch_seconds(start)


def to_minutes(seconds: str | Column, decimals: int = 2) -> Column:
    return F.round((as_col(seconds) / 60).cast("double"), decimals)


def response_band(minutes: str | Column) -> Column:
    """Service band; a missing time falls into the worst band, as in the source data's rule."""
    m = as_col(minutes)
    return cases([(m < limit, label) for limit, label in RESPONSE_BANDS], RESPONSE_WORST)


def delay_indicator(minutes: str | Column, threshold: float = DELAY_MINUTES) -> Column:
    """1 above the threshold, 0 at or below it, NULL when unknown."""
    return (as_col(minutes) > F.lit(threshold)).cast("int")


def event_indicator(observed: str | Column) -> Column:
    return as_col(observed).isNotNull().cast("int")


def season(month: str | Column) -> Column:
    """Meteorological season; an unknown month counts as fall."""
    m = as_col(month)
    return cases([(m.isin(12, 1, 2), "winter"), (m.isin(3, 4, 5), "spring"), (m.isin(6, 7, 8), "summer")], "fall")


def quarter_of_day(hour: str | Column, labels: Sequence[str] = HOUR_LEVELS) -> Column:
    """Six-hour band of the day; an unknown hour falls into the last one."""
    h = as_col(hour)
    return cases([(h.between(6 * i, 6 * i + 5), labels[i]) for i in range(3)], labels[3])


def day_name(day_of_week: str | Column) -> Column:
    """1..7 to Sunday..Saturday."""
    d = as_col(day_of_week)
    return F.when(d.between(1, 7), F.element_at(F.array(*map(F.lit, DAY_LEVELS)), d))


def day_number(name: str | Column) -> Column:
    """Sunday..Saturday to 1..7, NULL for other text."""
    p = F.array_position(F.array(*map(F.lit, DAY_LEVELS)), as_col(name))
    return F.when(p > 0, p.cast("int"))


def is_weekend(day_of_week: str | Column) -> Column:
    return F.coalesce(as_col(day_of_week).isin(1, 7), F.lit(False))


def time_parts(ts: str | Column) -> dict[str, Column]:
    t = as_col(ts)
    return {"hour": F.hour(t), "day_of_week": F.dayofweek(t), "month": F.month(t), "year": F.year(t)}


def normalise_text(c: str | Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 to one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(as_col(c)), r"[^a-z0-9]+", " "))


def preferred_position(c: str | Column, order: Sequence[str]) -> Column:
    """1-based place in a preferred order; values outside it get 0 and sort first."""
    return F.array_position(F.array(*map(F.lit, order)), as_col(c))


def clip_negative(c: str | Column) -> Column:
    v = as_col(c)
    return F.when(v < 0, F.lit(0)).otherwise(v)


def finite_number(c: str | Column) -> Column:
    """Numeric reading of a column; NULL where it is no finite number."""
    v = as_col(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def valid_email(c: str | Column) -> Column:
    return F.coalesce(as_col(c).rlike(EMAIL_PATTERN), F.lit(False))


def hazard_reading(hr: str | Column) -> Column:
    """Text reading of a hazard ratio; missing and NaN read as neutral."""
    h = F.when(~F.isnan(as_col(hr)), as_col(hr))
    return cases([(h < 1, HR_SLOWER), (h > 1, HR_FASTER)], HR_NEUTRAL)


def p_value_text(p: str | Column) -> Column:
    """Underflow marker, or up to three significant digits without trailing zeros; NULL stays NULL."""
    text = F.format_string("%.3g", as_col(p))
    text = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+(e|$)", "$1$2"), r"\.(e|$)", "$1")
    return F.when(as_col(p) == 0, F.lit("< 1e-300")).when(as_col(p).isNotNull(), text)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))
