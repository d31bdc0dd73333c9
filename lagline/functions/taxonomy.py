"""Harmonisation of differently coded sources into shared categories.

Each mapping is a rule table; compiling it gives one CASE expression over a text normalised once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lagline.functions.expressions import as_col, cases, normalise_text

MEDICAL = "Medical"
STRUCTURAL = "Fire – Structural"
NON_STRUCTURAL = "Fire – Non-Structural"
RESCUE = "Rescue / Entrapment"
HAZARD = "Hazardous / Utility"
NO_ACTION = "False Alarm / No Action"
ASSISTANCE = "Other / Assistance"

# Label patterns of the code-list source, in order of precedence, and the category of each.
CODED_LABELS: Sequence[tuple[str, str]] = (
    (r"^MEDICAL EMERGENCIES$|^MEDICAL MFAS$", MEDICAL),
    (r"^STRUCTURAL FIRES$", STRUCTURAL),
    (r"^NONSTRUCTURAL FIRES$", NON_STRUCTURAL),
    (r"^NONMEDICAL MFAS$", RESCUE),
    (r"^NONMEDICAL EMERGENCIES$", ASSISTANCE),
    (r"^\s*98\s*-\s*ASSISTANCE NOT REQUIRED", ASSISTANCE),
    (r"^\s*23\s*-\s*OPEN AIR BURNING/UNAUTHORIZED CONTROLLED BURNING", ASSISTANCE),
    (r"^\s*21\s*-\s*OVERHEAT", ASSISTANCE),
    (r"^\s*29\s*-\s*OTHER PRE FIRE CONDITIONS", ASSISTANCE),
    (r"^\s*49\s*-\s*RUPTURED WATER,\s*STEAM PIPE", HAZARD),
    (r"^\s*11\s*-\s*OVERPRESSURE RUPTURE", HAZARD),
    (r"^\s*13\s*-\s*OVERPRESSURE RUPTURE\s*-\s*GAS PIPE", HAZARD),
    (r"^\s*53\s*-\s*CO INCIDENT,\s*CO PRESENT", HAZARD),
    (r"^\s*48\s*-\s*RADIO-?ACTIVE MATERIAL PROBLEM", HAZARD),
    (r"^\s*69\s*-\s*OTHER RESCUE", RESCUE),
    (r"^\s*605\s*-\s*ANIMAL RESCUE", RESCUE),
    (r"^\s*68\s*-\s*WATER ICE RESCUE", RESCUE),
    (r"^\s*54\s*-\s*SUSPICIOUS SUBSTANCE", ASSISTANCE),
    (r"^\s*26\s*-\s*FIREWORKS\s*\(NO FIRE\)", ASSISTANCE),
    (r"\bMEDICAL\b|\bEMS\b", MEDICAL),
    (
        r"\bALARM\b|ALARM SYSTEM|ALARM EQUIPMENT|MALFUNCTION|ACCIDENTAL ACTIVATION|PERCEIVED EMERGENCY|PRANK|"
        r"MALICIOUS|CO FALSE ALARM|NO CO PRESENT|INCIDENT NOT FOUND|CANCELLED ON ROUTE|CANCELLED|"
        r"PUBLIC HAZARD CALL FALSE ALARM|PUBLIC HAZARD NO ACTION REQUIRED|RESCUE FALSE ALARM|"
        r"RESCUE NO ACTION REQUIRED|NO ACTION REQUIRED",
        NO_ACTION,
    ),
    (r"\b01\s*-\s*FIRE\b|STRUCTURAL FIRE|STRUCTURE FIRE", STRUCTURAL),
    (
        r"NONSTRUCTURAL FIRE|NO LOSS OUTDOOR FIRE|OUTDOOR FIRE|COOKING|TOASTING|SMOKE|STEAM|POT ON STOVE|STOVE",
        NON_STRUCTURAL,
    ),
    (
        r"PERSONS TRAPPED|ENTRAPMENT|ELEVATOR|EXTRICATION|WATER RESCUE|HIGH ANGLE|LOW ANGLE|CONFINED SPACE|TRENCH|"
        r"\b691\b\s*-\s*PERSONAL/INDUSTRIAL ENTRAPMENT",
        RESCUE,
    ),
    (
        r"GAS LEAK|NATURAL GAS|PROPANE|REFRIGERATION|\bCO INCIDENT\b|CO PRESENT|CARBON MONOXIDE|HAZMAT|HAZARDOUS|"
        r"SPILL|TOXIC CHEMICAL|GASOLINE|FUEL|POWER LINES|ARCI?NG|RADIO-?ACTIVE|RADIATION|OVERPRESSURE RUPTURE|"
        r"GAS PIPE|RUPTURED WATER|STEAM PIPE",
        HAZARD,
    ),
)

# Label patterns of the described-class source. A rule is (category, any-of patterns); the
# manhole rule additionally excludes fires that reached a building.
CLASS_LABELS: Sequence[tuple[str, str]] = (
    (MEDICAL, r"^MEDICAL\s*-|^MEDICAL MFA\s*-"),
    (
        NO_ACTION,
        r"^ALARM SYSTEM\s*-|^SPRINKLER SYSTEM\s*-|NON-MEDICAL 10-91\s*\(UNNECESSARY ALARM\)|"
        r"NON-MEDICAL MFA\s*-\s*PRIVATE FIRE ALARM",
    ),
    (
        STRUCTURAL,
        r"PRIVATE DWELLING FIRE|MULTIPLE DWELLING\s*'A'\s*-.*FIRE|MULTIPLE DWELLING\s*'B'\s*FIRE|"
        r"OTHER COMMERCIAL BUILDING FIRE|STORE FIRE|SCHOOL FIRE|HOSPITAL FIRE|CHURCH FIRE|FACTORY FIRE|"
        r"OTHER PUBLIC BUILDING FIRE|THEATER OR TV STUDIO FIRE|TRANSIT SYSTEM\s*-\s*STRUCTURAL|"
        r"UNDER CONTRUCTION\s*/\s*VACANT FIRE|UNDER CONSTRUCTION\s*/\s*VACANT FIRE|"
        r"MANHOLE FIRE\s*-\s*EXTENDED TO BUILDING",
    ),
    (
        NON_STRUCTURAL,
        r"DEMOLITION DEBRIS OR RUBBISH FIRE|BRUSH FIRE|AUTOMOBILE FIRE|ABANDONED DERELICT VEHICLE FIRE|"
        r"OTHER TRANSPORTATION FIRE|TRANSIT SYSTEM\s*-\s*NONSTRUCTURAL|UNDEFINED NONSTRUCTURAL FIRE|MARITIME FIRE",
    ),
    (HAZARD, r"^UTILITY EMERGENCY\s*-|^CARBON MONOXIDE\s*-|^ODOR\s*-|DEFECTIVE OIL BURNER"),
    (
        RESCUE,
        r"^ELEVATOR EMERGENCY\s*-\s*OCCUPIED|VEHICLE ACCIDENT\s*-\s*WITH EXTRICATION|"
        r"REMOVE CIVILIAN\s*-\s*NON-FIRE|MARITIME EMERGENCY|NON-MEDICAL MFA\s*-\s*(ERS|BARS)",
    ),
)
MANHOLE = r"^MANHOLE FIRE\s*-"
REACHED_BUILDING = r"EXTENDED TO BUILDING"

# Alarm texts and the unified level they stand for.
LEVEL_TEXT_EXACT = (("initial alarm", 1), ("default record", 1))
LEVEL_TEXT_PARTS = (
    ("second alarm", 2), ("7 5", 2), ("10 75", 2), ("10 76", 2), ("10 77", 2),
    ("third alarm", 3), ("fourth alarm", 3), ("fifth alarm", 3), ("sixth alarm", 3),
)
LEVEL_NAMES = ((1, "Level 1 – Initial"), (2, "Level 2 – Escalated"), (3, "Level 3 – Major"))

# Call-source texts and the unified source they stand for.
PUBLIC, EMS, ALARM, OTHER, UNKNOWN = "Public", "EMS / Medical", "Alarm System", "Other / System", "Unknown"
SOURCE_PARTS = (
    ("911", PUBLIC), ("civilian", PUBLIC), ("verbal report", PUBLIC),
    ("ambulance", EMS),
    ("monitoring agency", ALARM), ("direct connection", ALARM), ("other alarm", ALARM),
)
SOURCE_CODES = (("phone", PUBLIC), ("911", PUBLIC), ("911text", PUBLIC), ("verbal", PUBLIC))
SOURCE_CODE_PARTS = (("ems", EMS), ("class 3", ALARM))
SOURCE_ORDER = (PUBLIC, EMS, ALARM, "Police / Fire", OTHER, UNKNOWN)


def ordered_rules(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Ordered (pattern, category) rules over a text: the first matching pattern decides."""
    return cases([(text.rlike(pattern), category) for pattern, category in rules], default)


def coded_category(label: str | Column) -> Column:
    return ordered_rules(F.upper(F.trim(as_col(label))), CODED_LABELS, ASSISTANCE)


def class_category(label: str | Column) -> Column:
    s = F.upper(F.trim(as_col(label)))
    manhole = s.rlike(MANHOLE) & ~s.rlike(REACHED_BUILDING)
    return cases(
        [(s.rlike(p) | manhole if category == NON_STRUCTURAL else s.rlike(p), category) for category, p in CLASS_LABELS],
        ASSISTANCE,
    )


def level_from_number(level: str | Column) -> Column:
    """0 is initial, 1 and 2 escalated, 3 and more major; others unmapped."""
    v = as_col(level)
    return cases([(v == 0, 1), (v.isin(1, 2), 2), (v >= 3, 3)]).cast("int")


def level_from_text(text: str | Column) -> Column:
    s = normalise_text(text)
    rules = [(s == t, level) for t, level in LEVEL_TEXT_EXACT]
    rules += [(s.contains(t), level) for t, level in LEVEL_TEXT_PARTS]
    return cases(rules).cast("int")


def level_name(level: str | Column) -> Column:
    """Display label; a NULL level stays NULL because concatenation with NULL does."""
    v = as_col(level)
    return cases([(v == k, t) for k, t in LEVEL_NAMES], F.concat(F.lit("Unknown ("), v.cast("string"), F.lit(")")))


def source_from_phrase(text: str | Column) -> Column:
    """Unified source of free phrases; anything unlisted is a system source."""
    s = normalise_text(text)
    return cases([(as_col(text).isNull(), UNKNOWN)] + [(s.contains(t), u) for t, u in SOURCE_PARTS], OTHER)


def source_from_code(text: str | Column) -> Column:
    """Unified source of short codes; anything unlisted is a system source."""
    s = normalise_text(text)
    rules = [(as_col(text).isNull(), UNKNOWN)] + [(s == t, u) for t, u in SOURCE_CODES]
    return cases(rules + [(s.contains(t), u) for t, u in SOURCE_CODE_PARTS], OTHER)
