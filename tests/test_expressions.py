import math

import pytest
from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.functions import taxonomy
from lagline.functions.distributions import chi2_tail, normal_two_sided


def one(spark, rows, ddl, col):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(col).collect()]


def test_yes_no_and_text(spark):
    rows = [("y ",), (" N",), ("x",), (None,)]
    assert one(spark, rows, "a string", x.yes_no("a")) == [True, False, None, None]
    assert one(spark, [("  7-5  (All_Hands) ",)], "a string", x.normalise_text("a")) == ["7 5 all hands"]


def test_timestamps_of_every_format(spark):
    texts = ["2024-01-02 03:04:05", "2024-01-02T03:04:05", "01/02/2024 03:04:05", "01/02/2024 3:04 PM", "soon", None]
    got = one(spark, [(t,) for t in texts], "a string", F.date_format(x.parse_timestamp("a"), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-01-02 03:04:05"] * 3 + ["2024-01-02 15:04:00", None, None]


def test_indicators_and_bands(spark):
    rows = [(4.99,), (5.0,), (8.0,), (8.01,), (14.0,), (15.0,), (None,)]
    assert one(spark, rows, "m double", x.delay_indicator("m")) == [0, 0, 0, 1, 1, 1, None]
    assert one(spark, rows, "m double", x.event_indicator("m")) == [1, 1, 1, 1, 1, 1, 0]
    bands = one(spark, rows, "m double", x.response_band("m"))
    assert bands[0].startswith("Excellent") and bands[1].startswith("Good") and bands[4].startswith("Fair")
    assert bands[5] == bands[6] == x.RESPONSE_WORST


def test_calendar(spark):
    assert one(spark, [(m,) for m in (1, 3, 8, 11, None)], "m int", x.season("m")) == [
        "winter", "spring", "summer", "fall", "fall",
    ]
    assert one(spark, [(h,) for h in (0, 5, 6, 17, 18, None)], "h int", x.quarter_of_day("h")) == [
        "Night", "Night", "Morning", "Afternoon", "Evening", "Evening",
    ]
    assert one(spark, [(1,), (7,), (None,)], "d int", x.day_name("d")) == ["Sunday", "Saturday", None]
    assert one(spark, [(1,), (2,), (None,)], "d int", x.is_weekend("d")) == [True, False, False]
    assert one(spark, [("Monday",), ("Moonday",)], "d string", x.day_number("d")) == [2, None]


def test_numbers(spark):
    rows = [("1.5",), ("abc",), ("NaN",), ("-Infinity",), (None,)]
    assert one(spark, rows, "a string", x.finite_number("a")) == [1.5, None, None, None, None]
    assert one(spark, [("a.b@c.org",), ("a@b",), (None,)], "a string", x.valid_email("a")) == [True, False, False]
    p = [0.0, 0.01234, 1.0, 0.5, 0.05, 1e-5, 1.5e-7, 0.99999, None]
    want = ["< 1e-300", "0.0123", "1", "0.5", "0.05", "1e-05", "1.5e-07", "1", None]
    assert one(spark, [(v,) for v in p], "p double", x.p_value_text("p")) == want
    got = one(spark, [(0.5,), (2.0,), (1.0,), (float("nan"),), (None,)], "h double", x.hazard_reading("h"))
    assert got == [x.HR_SLOWER, x.HR_FASTER, x.HR_NEUTRAL, x.HR_NEUTRAL, x.HR_NEUTRAL]


CODED = [
    ("98 - Assistance Not Required by Other Agency", taxonomy.ASSISTANCE),
    ("23 - Open air burning/unauthorized controlled burning (no uncontrolled fire)", taxonomy.ASSISTANCE),
    ("53 - CO incident, CO present (exc false alarms)", taxonomy.HAZARD),
    ("605 - Animal rescue", taxonomy.RESCUE),
    ("89 - Other Medical", taxonomy.MEDICAL),
    ("37 - CO false alarm - perceived emergency (no CO present)", taxonomy.NO_ACTION),
    ("01 - Fire", taxonomy.STRUCTURAL),
    ("24 - Other Cooking/toasting/smoke/steam (no fire)", taxonomy.NON_STRUCTURAL),
    ("66 - Persons Trapped in Elevator", taxonomy.RESCUE),
    ("41 - Gas Leak - Natural Gas", taxonomy.HAZARD),
    ("Structural Fires", taxonomy.STRUCTURAL),
    ("NonMedical MFAs", taxonomy.RESCUE),
    ("99 - anything else", taxonomy.ASSISTANCE),
]
CLASSED = [
    ("Medical - Breathing / Ill or Sick", taxonomy.MEDICAL),
    ("Alarm System - Unnecessary", taxonomy.NO_ACTION),
    ("Non-Medical MFA - Private Fire Alarm", taxonomy.NO_ACTION),
    ("Private Dwelling Fire", taxonomy.STRUCTURAL),
    ("Manhole Fire - Extended to Building", taxonomy.STRUCTURAL),
    ("Manhole Fire - Blown Cover", taxonomy.NON_STRUCTURAL),
    ("Odor - Other Than Smoke", taxonomy.HAZARD),
    ("Elevator Emergency - Occupied", taxonomy.RESCUE),
    ("Elevator Emergency - Unoccupied", taxonomy.ASSISTANCE),
    (None, taxonomy.ASSISTANCE),
]


def test_taxonomies(spark):
    assert one(spark, CODED, "a string, b string", taxonomy.coded_category("a")) == [b for _, b in CODED]
    assert one(spark, CLASSED, "a string, b string", taxonomy.class_category("a")) == [b for _, b in CLASSED]
    assert one(spark, [(v,) for v in (0, 1, 2, 3, 9, None, -1)], "v int", taxonomy.level_from_number("v")) == [
        1, 2, 2, 3, 3, None, None,
    ]
    texts = ["Initial Alarm", "7-5 (All Hands Alarm)", "Fourth Alarm", "whatever", None]
    assert one(spark, [(t,) for t in texts], "t string", taxonomy.level_from_text("t")) == [1, 2, 3, None, None]
    assert one(spark, [(1,), (None,)], "v int", taxonomy.level_name("v")) == ["Level 1 – Initial", None]
    assert one(spark, [("03 - From Ambulance",), ("police",), (None,)], "t string", taxonomy.source_from_phrase("t")) == [
        taxonomy.EMS, taxonomy.OTHER, taxonomy.UNKNOWN,
    ]
    assert one(spark, [("CLASS-3",), ("EMS-911",), ("911",), ("SOL",)], "t string", taxonomy.source_from_code("t")) == [
        taxonomy.ALARM, taxonomy.EMS, taxonomy.PUBLIC, taxonomy.OTHER,
    ]


@pytest.mark.parametrize("stat,df,p", [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (12.591587, 6, 0.05), (16.811894, 6, 0.01)])
def test_tails(stat, df, p):
    assert chi2_tail(stat, df) == pytest.approx(p, rel=1e-5)
    assert normal_two_sided(1.959963985) == pytest.approx(0.05, rel=1e-6)
    assert chi2_tail(0.0, df) == 1.0 and math.isfinite(chi2_tail(1e4, df))
