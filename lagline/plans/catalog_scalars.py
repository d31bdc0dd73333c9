"""Registered projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.functions import expressions as x
from lagline.functions import taxonomy
from lagline.operators import survival
from lagline.plans.inputs import FREIGHT_SQL, INC_SQL, MODEL_SQL, freight_incidents, incidents, model_ready
from lagline.plans.registry import query
from lagline.sources.tables import load


@query(
    "sc_yn_bool",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE f WHEN 'Y' THEN true WHEN 'N' THEN false END AS flag
    FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'Y' ELSE l_returnflag END AS f FROM lineitem)""",
)
def sc_yn_bool(spark, d):
    raw = F.concat(F.lit(" "), F.lower(F.when(F.col("l_returnflag") == "A", "y").otherwise(F.col("l_returnflag"))))
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", x.yes_no(raw).alias("flag"))


@query(
    "sc_fillna",
    INC_SQL + """SELECT city, incident_id, coalesce(response_minutes, 60.0::DOUBLE) AS response_minutes,
    coalesce(unified_alarm_level, 0) AS unified_alarm_level FROM inc""",
)
def sc_fillna(spark, d):
    rows = incidents(spark, d).select("city", "incident_id", "response_minutes", "unified_alarm_level")
    return x.fill_defaults(rows, {"response_minutes": 60.0, "unified_alarm_level": 0})


@query("sc_upper_trim", "SELECT p_partkey, upper(trim(p_name)) AS name FROM part")
def sc_upper_trim(spark, d):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return load(spark, d, "part").select("p_partkey", x.upper_trim(padded).alias("name"))


@query(
    "sc_multi_ts",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
      ELSE l_shipdate END AS parsed FROM lineitem""",
)
def sc_multi_ts(spark, d):
    ts = F.col("l_shipdate")
    text = x.cases(
        [
            (F.concat("l_returnflag", "l_linestatus") == "NF", F.lit("not a time")),
            (F.col("l_returnflag") == "A", F.date_format(ts, "yyyy-MM-dd HH:mm:ss")),
            (F.col("l_returnflag") == "R", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")),
            (F.col("l_linenumber") > 3, F.date_format(ts, "MM/dd/yyyy HH:mm:ss")),
        ],
        F.date_format(ts, "MM/dd/yyyy h:mm a"),
    )
    parsed = x.parse_timestamp(text).cast("timestamp_ntz")
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", parsed.alias("parsed"))


@query(
    "sc_ts_diff",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'R' THEN
      CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) END AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def sc_ts_diff(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_shipdate")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    end = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", x.seconds_between("o_orderdate", end).alias("seconds"))


@query("sc_minutes_from_sec", "SELECT event_id, round(floor(value) * 6 / 60, 2) AS minutes FROM events")
def sc_minutes_from_sec(spark, d):
    return load(spark, d, "events").select("event_id", x.to_minutes(F.floor("value") * 6).alias("minutes"))


@query(
    "sc_resp_category",
    INC_SQL + """SELECT city, incident_id, CASE WHEN response_minutes < 5 THEN 'Excellent (<5 min)'
      WHEN response_minutes < 10 THEN 'Good (5-10 min)' WHEN response_minutes < 15 THEN 'Fair (10-15 min)'
      ELSE 'Poor (>15 min)' END AS band FROM inc""",
)
def sc_resp_category(spark, d):
    return incidents(spark, d).select("city", "incident_id", x.response_band("response_minutes").alias("band"))


@query(
    "sc_delay_ind",
    INC_SQL + """SELECT city, incident_id, CASE WHEN response_minutes IS NULL THEN NULL WHEN response_minutes > 8.0 THEN 1
      ELSE 0 END AS delay FROM inc""",
)
def sc_delay_ind(spark, d):
    return incidents(spark, d).select("city", "incident_id", x.delay_indicator("response_minutes").alias("delay"))


@query(
    "sc_event_ind",
    INC_SQL + "SELECT city, incident_id, CASE WHEN response_minutes IS NULL THEN 0 ELSE 1 END AS event FROM inc",
)
def sc_event_ind(spark, d):
    return incidents(spark, d).select("city", "incident_id", x.event_indicator("response_minutes").alias("event"))


@query(
    "sc_time_parts",
    """SELECT event_id, CAST(extract(hour FROM ts) AS INTEGER) AS hour, CAST(extract(dow FROM ts) + 1 AS INTEGER) AS day_of_week,
      CAST(extract(month FROM ts) AS INTEGER) AS month, CAST(extract(year FROM ts) AS INTEGER) AS year FROM events""",
)
def sc_time_parts(spark, d):
    return load(spark, d, "events").select("event_id", *[c.alias(n) for n, c in x.time_parts("ts").items()])


@query(
    "sc_date_names",
    """SELECT o_orderkey, dayname(o_orderdate) AS day_name, monthname(o_orderdate) AS month_name,
      CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_number FROM orders""",
)
def sc_date_names(spark, d):
    day = F.date_format("o_orderdate", "EEEE")
    return load(spark, d, "orders").select(
        "o_orderkey", day.alias("day_name"), F.date_format("o_orderdate", "MMMM").alias("month_name"),
        x.day_number(day).alias("day_number"),
    )


@query(
    "sc_season",
    """SELECT o_orderkey, s AS season, upper(s[1]) || s[2:] AS season_title FROM (SELECT o_orderkey, CASE
      WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) BETWEEN 3 AND 5 THEN 'spring'
      WHEN month(o_orderdate) BETWEEN 6 AND 8 THEN 'summer' ELSE 'fall' END AS s FROM orders)""",
)
def sc_season(spark, d):
    s = x.season(F.month("o_orderdate"))
    return load(spark, d, "orders").select("o_orderkey", s.alias("season"), F.initcap(s).alias("season_title"))


@query(
    "sc_time_of_day",
    INC_SQL + """SELECT city, incident_id, CASE WHEN hour <= 5 THEN 'Night (12AM-6AM)' WHEN hour <= 11 THEN 'Morning (6AM-12PM)'
      WHEN hour <= 17 THEN 'Afternoon (12PM-6PM)' ELSE 'Evening (6PM-12AM)' END AS time_of_day FROM inc""",
)
def sc_time_of_day(spark, d):
    band = x.quarter_of_day("hour", x.TIME_OF_DAY)
    return incidents(spark, d).select("city", "incident_id", band.alias("time_of_day"))


@query(
    "sc_hour_group",
    INC_SQL + """SELECT city, incident_id, CASE hour // 6 WHEN 0 THEN 'Night' WHEN 1 THEN 'Morning' WHEN 2 THEN 'Afternoon'
      ELSE 'Evening' END AS hour_group FROM inc""",
)
def sc_hour_group(spark, d):
    return incidents(spark, d).select("city", "incident_id", x.quarter_of_day("hour").alias("hour_group"))


@query("sc_dow_name", INC_SQL + "SELECT city, incident_id, dayname(incident_datetime) AS day_of_week_name FROM inc")
def sc_dow_name(spark, d):
    return incidents(spark, d).select("city", "incident_id", x.day_name("day_of_week").alias("day_of_week_name"))


@query(
    "sc_weekend",
    INC_SQL + """SELECT city, incident_id, dayofweek(incident_datetime) IN (0, 6) AS is_weekend,
      CASE WHEN dayofweek(incident_datetime) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type FROM inc""",
)
def sc_weekend(spark, d):
    flag = x.is_weekend("day_of_week")
    return incidents(spark, d).select(
        "city", "incident_id", flag.alias("is_weekend"), F.when(flag, "Weekend").otherwise("Weekday").alias("day_type")
    )


@query(
    "sc_norm_text",
    """SELECT doc_id, md5(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS norm_md5,
      length(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS norm_chars FROM documents""",
)
def sc_norm_text(spark, d):
    s = x.normalise_text("text")
    return load(spark, d, "documents").select("doc_id", F.md5(s).alias("norm_md5"), F.length(s).cast("bigint").alias("norm_chars"))


def _coded_label():
    """Labels in the style of the code-list source, built from the part descriptions."""
    return F.concat(
        x.cases([(F.col("p_size") % 50 == s, t) for s, t in _CODED_SAMPLES], F.lit("99 - ")),
        F.lit(" "), F.upper("p_name"),
    )


# Label texts used to exercise the rules; a part's size picks one.
_CODED_SAMPLES = tuple(enumerate((
    "98 - Assistance Not Required", "23 - Open air burning/unauthorized controlled burning", "21 - Overheat",
    "29 - Other pre fire conditions", "49 - Ruptured Water, Steam Pipe", "11 - Overpressure Rupture",
    "13 - Overpressure Rupture - Gas Pipe", "53 - CO Incident, CO present", "48 - Radio-active Material Problem",
    "69 - Other Rescue", "605 - Animal rescue", "68 - Water Ice Rescue", "54 - Suspicious substance",
    "26 - Fireworks (no fire)", "89 - Other Medical", "31 - Alarm System Equipment - Malfunction", "01 - Fire",
    "24 - Other Cooking/toasting/smoke/steam", "61 - Persons Trapped in Elevator", "41 - Gas Leak - Natural Gas",
    "Structural Fires", "03 - No Loss Outdoor Fire", "37 - CO false alarm", "Gasoline Spill",
)))
_CLASS_SAMPLES = tuple(enumerate((
    "Medical - Breathing", "Medical MFA - PD Link", "Alarm System - Unnecessary", "Sprinkler System - Working",
    "Non-Medical 10-91 (Unnecessary Alarm)", "Non-Medical MFA - Private Fire Alarm", "Private Dwelling Fire",
    "Multiple Dwelling 'A' - Food on the stove fire", "Store Fire", "Manhole Fire - Extended to Building",
    "Manhole Fire - Blown Cover", "Brush Fire", "Automobile Fire", "Transit System - NonStructural",
    "Utility Emergency - Gas", "Carbon Monoxide - Code 1", "Odor - Other", "Defective Oil Burner",
    "Elevator Emergency - Occupied", "Vehicle Accident - With Extrication", "Remove Civilian - Non-Fire",
    "Non-Medical MFA - ERS", "Elevator Emergency - Unoccupied", "Downed Tree",
)))


def _sql_text(v):
    return "'" + v.replace("'", "''") + "'"


def _sql_samples(column, samples, default):
    whens = " ".join(f"WHEN {i} THEN {_sql_text(t)}" for i, t in samples)
    return f"CASE {column} % 50 {whens} ELSE {_sql_text(default)} END"


def _sql_rules(text, rules, default):
    whens = " ".join(f"WHEN regexp_matches({text}, {_sql_text(p)}) THEN {_sql_text(c)}" for p, c in rules)
    return f"CASE {whens} ELSE {_sql_text(default)} END"


@query(
    "sc_regex_taxonomy_a",
    f"""SELECT p_partkey, label, {_sql_rules('s', taxonomy.CODED_LABELS, taxonomy.ASSISTANCE)} AS category FROM (
      SELECT p_partkey, label, upper(trim(label)) AS s FROM (SELECT p_partkey,
        {_sql_samples('p_size', _CODED_SAMPLES, '99 - ')} || ' ' || upper(p_name) AS label FROM part))""",
)
def sc_regex_taxonomy_a(spark, d):
    rows = load(spark, d, "part").select("p_partkey", _coded_label().alias("label"))
    return rows.withColumn("category", taxonomy.coded_category("label"))


@query(
    "sc_regex_taxonomy_b",
    f"""SELECT p_partkey, label, CASE
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[0][1])}) THEN 'Medical'
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[1][1])}) THEN 'False Alarm / No Action'
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[2][1])}) THEN 'Fire – Structural'
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[3][1])})
        OR (s LIKE 'MANHOLE FIRE -%' AND s NOT LIKE '%EXTENDED TO BUILDING%') THEN 'Fire – Non-Structural'
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[4][1])}) THEN 'Hazardous / Utility'
      WHEN regexp_matches(s, {_sql_text(taxonomy.CLASS_LABELS[5][1])}) THEN 'Rescue / Entrapment'
      ELSE 'Other / Assistance' END AS category FROM (SELECT p_partkey, label, upper(trim(label)) AS s FROM (
        SELECT p_partkey, {_sql_samples('p_size', _CLASS_SAMPLES, 'Service call')} AS label FROM part))""",
)
def sc_regex_taxonomy_b(spark, d):
    label = x.cases([(F.col("p_size") % 50 == s, t) for s, t in _CLASS_SAMPLES], F.lit("Service call"))
    rows = load(spark, d, "part").select("p_partkey", label.alias("label"))
    return rows.withColumn("category", taxonomy.class_category("label"))


@query(
    "sc_level_map",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN v = 0 THEN 1 WHEN v IN (1, 2) THEN 2 WHEN v >= 3 THEN 3 END AS level
    FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN CAST(round(l_tax * 100) AS INTEGER) - 1 END AS v FROM lineitem)""",
)
def sc_level_map(spark, d):
    raw = F.when(F.col("l_returnflag") != "N", F.round(F.col("l_tax") * 100).cast("int") - 1)
    level = taxonomy.level_from_number(raw)
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", level.alias("level"))


_LEVEL_SAMPLES = tuple(enumerate((
    "Initial Alarm", "DEFAULT RECORD", "Second Alarm", "7-5 (All Hands Alarm)", "10-75 Signal (Request Assistance)",
    "10-76 & 10-77 Signal (Notification Hi-Rise Fire)", "Third Alarm", "Fourth Alarm", "Fifth Alarm or Higher",
    "Sixth-Alarm", "Simultaneous Call",
)))
# Made-up inputs that reach every rule of the source maps, the null and the default included.
_PHRASE_SAMPLES = tuple(enumerate((
    "caller dialled 911", "Verbal Report by a neighbour", "CIVILIAN at the door", "ambulance crew asks for help",
    "Monitoring-Agency desk", "direct connection, school", "some other alarm", "harbour patrol", "crew on a drill", "?",
)))
_CODE_SAMPLES = tuple(enumerate(("Phone", "911", " 911text ", "verbal", "verbal note", "EMS", "x-ems-y", "Class 3", "class_3b", "KIOSK", "")))


def normal_sql(text):
    """Lower-case letters and digits, one blank between them."""
    return f"trim(regexp_replace(lower({text}), '[^a-z0-9]+', ' ', 'g'))"


# Unified source of a normalised phrase or code `t`.
PHRASE_SOURCE_SQL = """CASE WHEN t IS NULL THEN 'Unknown'
      WHEN t LIKE '%911%' OR t LIKE '%civilian%' OR t LIKE '%verbal report%' THEN 'Public'
      WHEN t LIKE '%ambulance%' THEN 'EMS / Medical'
      WHEN t LIKE '%monitoring agency%' OR t LIKE '%direct connection%' OR t LIKE '%other alarm%' THEN 'Alarm System'
      ELSE 'Other / System' END"""
CODE_SOURCE_SQL = """CASE WHEN t IS NULL THEN 'Unknown' WHEN t IN ('phone', '911', '911text', 'verbal') THEN 'Public'
      WHEN t LIKE '%ems%' THEN 'EMS / Medical' WHEN t LIKE '%class 3%' THEN 'Alarm System' ELSE 'Other / System' END"""


@query(
    "sc_level_map_text",
    f"""SELECT p_partkey, CASE WHEN t IN ('initial alarm', 'default record') THEN 1
      WHEN t LIKE '%second alarm%' OR t LIKE '%7 5%' OR t LIKE '%10 75%' OR t LIKE '%10 76%' OR t LIKE '%10 77%' THEN 2
      WHEN t LIKE '%third alarm%' OR t LIKE '%fourth alarm%' OR t LIKE '%fifth alarm%' OR t LIKE '%sixth alarm%' THEN 3 END AS level
    FROM (SELECT p_partkey, trim(regexp_replace(lower({_sql_samples('p_size', _LEVEL_SAMPLES, '')}), '[^a-z0-9]+', ' ', 'g')) AS t FROM part)""",
)
def sc_level_map_text(spark, d):
    raw = x.cases([(F.col("p_size") % 50 == s, t) for s, t in _LEVEL_SAMPLES], F.lit(""))
    return load(spark, d, "part").select("p_partkey", taxonomy.level_from_text(raw).alias("level"))


@query(
    "sc_source_map_a",
    f"""SELECT p_partkey, {PHRASE_SOURCE_SQL} AS source
    FROM (SELECT p_partkey, CASE WHEN p_size % 50 < 10 THEN {normal_sql(_sql_samples('p_size', _PHRASE_SAMPLES, ''))}
      WHEN p_size % 50 < 25 THEN 'x' END AS t FROM part)""",
)
def sc_source_map_a(spark, d):
    size = F.col("p_size") % 50
    raw = x.cases([(size == s, t) for s, t in _PHRASE_SAMPLES] + [(size < 25, "x")])
    return load(spark, d, "part").select("p_partkey", taxonomy.source_from_phrase(raw).alias("source"))


@query(
    "sc_source_map_b",
    f"""SELECT p_partkey, {CODE_SOURCE_SQL} AS source
    FROM (SELECT p_partkey, CASE WHEN p_size % 50 < 11 THEN {normal_sql(_sql_samples('p_size', _CODE_SAMPLES, ''))} END AS t FROM part)""",
)
def sc_source_map_b(spark, d):
    raw = x.cases([(F.col("p_size") % 50 == s, t) for s, t in _CODE_SAMPLES])
    return load(spark, d, "part").select("p_partkey", taxonomy.source_from_code(raw).alias("source"))


@query(
    "sc_label_level",
    INC_SQL + """SELECT unified_alarm_level, CASE unified_alarm_level WHEN 1 THEN 'Level 1 – Initial' WHEN 2 THEN 'Level 2 – Escalated'
      WHEN 3 THEN 'Level 3 – Major' END AS alarm_level, count(*) AS n FROM inc GROUP BY 1""",
)
def sc_label_level(spark, d):
    counts = incidents(spark, d).groupBy("unified_alarm_level").agg(F.count("*").alias("n"))
    return counts.withColumn("alarm_level", taxonomy.level_name("unified_alarm_level"))


@query(
    "sc_custom_order",
    INC_SQL + """SELECT unified_call_source, n, row_number() OVER (ORDER BY CASE unified_call_source WHEN 'Public' THEN 1
      WHEN 'EMS / Medical' THEN 2 WHEN 'Alarm System' THEN 3 WHEN 'Other / System' THEN 5 WHEN 'Unknown' THEN 6 ELSE 0 END) AS place
    FROM (SELECT unified_call_source, count(*) AS n FROM inc GROUP BY 1)""",
)
def sc_custom_order(spark, d):
    from lagline.operators.ranking import rank_within

    counts = incidents(spark, d).groupBy("unified_call_source").agg(F.count("*").alias("n"))
    order = [x.preferred_position("unified_call_source", taxonomy.SOURCE_ORDER)]
    return rank_within(counts, [], order, "place").withColumn("place", F.col("place").cast("bigint"))


@query(
    "sc_clip_neg",
    """SELECT l_orderkey, l_linenumber, l_partkey, greatest(date_diff('day', o_orderdate, l_shipdate), 0) AS days
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def sc_clip_neg(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    days = x.clip_negative(F.datediff("l_shipdate", "o_orderdate").cast("bigint"))
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days"))


@query(
    "sc_censor",
    INC_SQL + """SELECT city, incident_id, least(coalesce(response_minutes, 60), 60::DOUBLE) AS response_minutes,
      CASE WHEN response_minutes <= 60 AND event_indicator = 1 THEN 1 ELSE 0 END AS event_indicator FROM inc
    WHERE event_indicator IN (0, 1) AND (response_minutes IS NULL OR response_minutes > 0)""",
)
def sc_censor(spark, d):
    return survival.survival_view(incidents(spark, d), ["city", "incident_id"])


@query(
    "sc_cox_admin_censor",
    INC_SQL + """SELECT city, count(*) FILTER (response_minutes IS NULL) AS censored_from_null,
      count(*) FILTER (response_minutes > 60) AS censored_from_over,
      count(*) FILTER (unified_alarm_level IS NULL) AS dropped_missing_predictors,
      count(*) FILTER (unified_alarm_level IS NOT NULL) AS rows_final,
      count(*) FILTER (unified_alarm_level IS NOT NULL AND response_minutes <= 60) AS events_final
    FROM inc WHERE response_minutes IS NULL OR response_minutes > 0 GROUP BY city""",
)
def sc_cox_admin_censor(spark, d):
    rows = incidents(spark, d).filter("event_indicator IN (0, 1) AND (response_minutes IS NULL OR response_minutes > 0)")
    return survival.admin_censoring_report(rows, ["city"], ["unified_alarm_level"])


@query(
    "sc_coerce_num",
    """SELECT event_id, v AS number FROM (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN NULL
      ELSE value END AS v FROM events) WHERE v IS NOT NULL""",
)
def sc_coerce_num(spark, d):
    text = x.cases(
        [(F.col("event_type") == "click", F.lit("n/a")), (F.col("event_type") == "view", F.lit("Infinity"))],
        F.col("value").cast("string"),
    )
    return load(spark, d, "events").select("event_id", x.finite_number(text).alias("number")).filter("number IS NOT NULL")


@query(
    "sc_email_valid",
    r"""SELECT page_id, coalesce(regexp_matches(a, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false) AS valid
    FROM (SELECT page_id, replace(split_part(split_part(url, '/', 3), '/', 1), 'www.', 'desk@') AS a FROM pages)""",
)
def sc_email_valid(spark, d):
    address = F.replace(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("www."), F.lit("desk@"))
    return load(spark, d, "pages").select("page_id", x.valid_email(address).alias("valid"))




@query(
    "sc_interpret",
    INC_SQL + """SELECT city, incident_category, CASE WHEN hr < 1 THEN 'HR < 1 → slower arrival (higher delay risk)'
      WHEN hr > 1 THEN 'HR > 1 → faster arrival (lower delay risk)' ELSE 'HR = 1 → no change' END AS interpretation
    FROM (SELECT city, incident_category, avg(delay_indicator) / 0.9::DOUBLE AS hr FROM inc GROUP BY 1, 2)""",
)
def sc_interpret(spark, d):
    hr = incidents(spark, d).groupBy("city", "incident_category").agg((F.avg("delay_indicator") / 0.9).alias("hr"))
    return hr.select("city", "incident_category", x.hazard_reading("hr").alias("interpretation"))


@query(
    "sc_pvalue_text",
    INC_SQL + """, s AS (SELECT city, location_area, round(avg(delay_indicator) - 0.9, 4) AS p FROM inc GROUP BY ALL)
    SELECT city, location_area, greatest(p, 0) AS p, CASE WHEN p <= 0 THEN '< 1e-300' ELSE format('{:.3g}', p) END AS p_text
    FROM s WHERE p IS NOT NULL""",
)
def sc_pvalue_text(spark, d):
    share = F.round(F.avg("delay_indicator") - 0.9, 4)
    p = F.when(share < 0, F.lit(0.0)).otherwise(share)
    return (
        incidents(spark, d).groupBy("city", "location_area").agg(p.alias("p")).filter("p IS NOT NULL")
        .withColumn("p_text", x.p_value_text("p"))
    )


@query(
    "pr_rename_drop",
    "SELECT l_orderkey AS order_id, l_partkey AS part_id, lower(l_returnflag) AS return_flag, l_quantity AS quantity FROM lineitem",
)
def pr_rename_drop(spark, d):
    li = load(spark, d, "lineitem").withColumnsRenamed({"l_orderkey": "order_id", "l_partkey": "part_id", "l_quantity": "quantity"})
    return li.drop("l_suppkey", "l_tax").select("order_id", "part_id", F.lower("l_returnflag").alias("return_flag"), "quantity")


@query("pr_model_ready", MODEL_SQL + "SELECT * FROM mr")
def pr_model_ready(spark, d):
    rows = model_ready(spark, d)
    return rows.withColumn("incident_datetime", F.col("incident_datetime").cast("timestamp_ntz"))


@query(
    "fl_year",
    "WITH " + FREIGHT_SQL + "SELECT incident_id, year FROM freight WHERE year IN (1996, 1997)",
)
def fl_year(spark, d):
    return freight_incidents(spark, d).filter(F.col("year").isin(1996, 1997)).select("incident_id", "year")


@query(
    "fl_valid_survival",
    INC_SQL + "SELECT city, incident_id FROM inc WHERE event_indicator IN (0, 1) AND (response_minutes IS NULL OR response_minutes > 0)",
)
def fl_valid_survival(spark, d):
    return survival.valid_rows(incidents(spark, d)).select("city", "incident_id")


@query(
    "fl_cap",
    INC_SQL + "SELECT city, incident_id, response_minutes FROM inc WHERE response_minutes > 0 AND response_minutes <= 180",
)
def fl_cap(spark, d):
    m = F.col("response_minutes")
    return incidents(spark, d).filter(m.isNotNull() & (m > 0) & (m <= 180)).select("city", "incident_id", "response_minutes")
