"""Registered data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.functions import taxonomy
from lagline.operators import quality
from lagline.plans.inputs import INC_SQL, incidents
from lagline.plans.registry import query
from lagline.sources.tables import load

WEB_RULES = {
    "valid_minutes": "response_minutes IS NULL OR response_minutes >= 1",
    "known_level": "unified_alarm_level BETWEEN 1 AND 2",
    "has_area": "location_area IS NOT NULL",
}


@query(
    "dq_expect_drop",
    INC_SQL + """SELECT city, incident_id, response_minutes, unified_alarm_level FROM inc
    WHERE (response_minutes IS NULL OR response_minutes >= 1) AND unified_alarm_level BETWEEN 1 AND 2
      AND location_area IS NOT NULL""",
)
def dq_expect_drop(spark, d):
    kept = quality.expect_or_drop(incidents(spark, d), WEB_RULES)
    return kept.select("city", "incident_id", "response_minutes", "unified_alarm_level")


@query(
    "dq_expect_warn",
    INC_SQL + """, n AS (SELECT count(*) AS rows,
      CAST(sum(CASE WHEN response_minutes IS NULL OR response_minutes >= 1 THEN 0 ELSE 1 END) AS BIGINT) AS a,
      CAST(sum(CASE WHEN unified_alarm_level BETWEEN 1 AND 2 THEN 0 ELSE 1 END) AS BIGINT) AS b,
      CAST(sum(CASE WHEN location_area IS NOT NULL THEN 0 ELSE 1 END) AS BIGINT) AS c FROM inc)
    SELECT rows, 'valid_minutes' AS rule, a AS violations FROM n UNION ALL SELECT rows, 'known_level', b FROM n
    UNION ALL SELECT rows, 'has_area', c FROM n""",
)
def dq_expect_warn(spark, d):
    return quality.expect(incidents(spark, d), WEB_RULES)[1]


_MISSING = ("response_minutes", "delay_indicator", "unified_alarm_level", "location_area")


@query(
    "dq_missing_pct",
    INC_SQL + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
        f"round((count(*) - count({c})) / count(*) * 100, 6) AS missing_pct FROM inc"
        for c in _MISSING
    )
    + ")",
)
def dq_missing_pct(spark, d):
    return quality.missing_percent(incidents(spark, d).select(*_MISSING), decimals=6)


@query(
    "dq_null_or_empty",
    """SELECT c AS column_name, n AS empty_count, round(n / t * 100, 6) AS empty_pct FROM (
      SELECT 'lang' AS c, count(*) FILTER (lang IS NULL OR trim(lang) = '') AS n, count(*) AS t FROM documents UNION ALL
      SELECT 'source', count(*) FILTER (source IS NULL OR trim(source) = ''), count(*) FROM documents UNION ALL
      SELECT 'text', count(*) FILTER (text IS NULL OR trim(text) = ''), count(*) FROM documents)""",
)
def dq_null_or_empty(spark, d):
    return quality.null_or_blank(load(spark, d, "documents"), ["lang", "source", "text"], decimals=6)


@query("dq_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dq_duplicates(spark, d):
    return quality.duplicate_groups(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_duplicate_totals",
    """SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""",
)
def dq_duplicate_totals(spark, d):
    return quality.duplicate_totals(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_dup_sample",
    """SELECT l.* FROM lineitem l JOIN (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1
    ORDER BY ALL LIMIT 1) USING (l_orderkey, l_linenumber)""",
)
def dq_dup_sample(spark, d):
    return quality.duplicate_sample(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_range",
    """WITH j AS (SELECT CAST(date_diff('day', o_orderdate, l_shipdate) AS DOUBLE) AS ship_days, l_quantity, l_discount
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT 'ship_days' AS column_name, min(ship_days) AS min_value, max(ship_days) AS max_value,
      count(*) FILTER (ship_days < 0) AS negative_count FROM j UNION ALL
    SELECT 'l_quantity', min(l_quantity), max(l_quantity), count(*) FILTER (l_quantity < 0) FROM j UNION ALL
    SELECT 'l_discount', min(l_discount), max(l_discount), count(*) FILTER (l_discount < 0) FROM j""",
)
def dq_range(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_quantity", "l_discount")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.withColumn("ship_days", F.datediff("l_shipdate", "o_orderdate"))
    return quality.value_ranges(j, ["ship_days", "l_quantity", "l_discount"])


@query(
    "dq_reconcile",
    INC_SQL + """SELECT (SELECT count(*) FROM inc) AS total_rows,
    (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT incident_category, count(*) AS n FROM inc GROUP BY 1)) AS category_sum,
    true AS reconciled""",
)
def dq_reconcile(spark, d):
    return quality.reconcile(incidents(spark, d), "incident_category")


@query(
    "dq_unmapped",
    """SELECT o_orderpriority, count(*) AS n FROM orders WHERE CASE
      WHEN o_orderpriority LIKE '1%' THEN 1 WHEN o_orderpriority LIKE '2%' OR o_orderpriority LIKE '3%' THEN 2 END IS NULL
    GROUP BY 1""",
)
def dq_unmapped(spark, d):
    rank = F.substring("o_orderpriority", 1, 1).cast("int")
    mapped = load(spark, d, "orders").withColumn(
        "level", taxonomy.level_from_number(F.when(rank <= 3, rank - 1))
    )
    return quality.unmapped(mapped, "o_orderpriority", "level")


@query(
    "dq_label_check",
    INC_SQL + "SELECT delay_indicator, count(*) AS n FROM inc WHERE delay_indicator IS NOT NULL GROUP BY 1",
)
def dq_label_check(spark, d):
    return quality.require_two_classes(incidents(spark, d), "delay_indicator")
