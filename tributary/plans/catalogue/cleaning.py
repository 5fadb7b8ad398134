"""Row filters and the reports about them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import clean, fused
from tributary.plans.catalogue.registry import query, table


@query(
    "drop_all_null",
    """
    SELECT kind, amount FROM (
      SELECT CASE WHEN user_id % 5 <> 0 THEN event_type END AS kind,
             CASE WHEN event_id % 3 <> 0 THEN value END AS amount FROM events)
    WHERE NOT (kind IS NULL AND amount IS NULL)
    """,
)
def drop_all_null(spark, sf):
    holed = table(spark, sf, "events").select(
        F.when(F.col("user_id") % 5 != 0, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("amount"),
    )
    return clean.drop_all_null(holed)


@query(
    "range_filter",
    """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE o_orderdate >= DATE '1996-02-29' AND o_orderdate <= DATE '1999-12-31'
    """,
)
def range_filter(spark, sf):
    kept = clean.keep_range(
        table(spark, sf, "orders"),
        "o_orderdate",
        F.lit("1996-02-29").cast("timestamp_ntz"),
        F.lit("1999-12-31").cast("timestamp_ntz"),
    )
    return kept.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))


@query(
    "lower_bound_report",
    """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (o_orderdate < DATE '1996-06-05') AS n_hits,
           COUNT(*) FILTER (o_orderdate IS NULL) AS n_null,
           ROUND(COUNT(*) FILTER (o_orderdate < DATE '1996-06-05') * 100.0 / COUNT(*), 4)::DOUBLE AS pct_hits,
           CAST(MIN(o_orderdate) AS DATE) AS min_value, CAST(MAX(o_orderdate) AS DATE) AS max_value
    FROM orders
    """,
)
def lower_bound_report(spark, sf):
    day = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return clean.condition_report(day, F.col("day") < F.lit("1996-06-05").cast("date"), "day")


def _dates(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ordered"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("shipped")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


DATES_SQL = """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped,
       CAST(o_orderdate AS DATE) AS ordered
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


@query("column_compare_filter", f"SELECT * FROM ({DATES_SQL}) WHERE ordered <= shipped")
def column_compare_filter(spark, sf):
    return clean.keep_ordered(_dates(spark, sf), "ordered", "shipped")


@query(
    "column_compare_report",
    f"""
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (ordered > shipped) AS n_hits,
           COUNT(*) FILTER (shipped IS NULL) AS n_null,
           ROUND(COUNT(*) FILTER (ordered > shipped) * 100.0 / COUNT(*), 4)::DOUBLE AS pct_hits,
           MIN(shipped) AS min_value, MAX(shipped) AS max_value
    FROM ({DATES_SQL})
    """,
)
def column_compare_report(spark, sf):
    return clean.condition_report(
        _dates(spark, sf), F.col("ordered") > F.col("shipped"), "shipped"
    )


@query(
    "invalid_share",
    """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (v < 5 OR v > 200) AS n_hits,
           COUNT(*) FILTER (v IS NULL) AS n_null,
           ROUND(COUNT(*) FILTER (v < 5 OR v > 200) * 100.0 / COUNT(*), 4)::DOUBLE AS pct_hits,
           MIN(v) AS min_value, MAX(v) AS max_value
    FROM (SELECT CASE WHEN event_id % 9 <> 0 THEN value END AS v FROM events)
    """,
)
def invalid_share(spark, sf):
    value = F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("v")
    bad = (F.col("v") < 5) | (F.col("v") > 200)
    return clean.condition_report(table(spark, sf, "events").select(value), bad, "v")


@query(
    "outlier_rows",
    """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal >= 9000
    """,
)
def outlier_rows(spark, sf):
    balance = F.col("c_acctbal")
    outliers, _ = clean.split_rows(table(spark, sf, "customer"), (balance < 0) | (balance >= 9000))
    return outliers.select("c_custkey", "c_acctbal")


# Twelve conditions over order lines, in Spark's SQL and DuckDB's alike.
CONDITIONS = {
    "small": ("l_quantity < 5", "l_quantity"),
    "large": ("l_quantity > 45", "l_quantity"),
    "odd lines": ("l_linenumber % 2 = 1", "l_linenumber"),
    "late lines": ("l_linenumber > 4", "l_linenumber"),
    "no discount": ("l_discount = 0", "l_discount"),
    "high discount": ("l_discount > 0.07", "l_discount"),
    "no tax": ("l_tax = 0", "l_tax"),
    "high tax": ("l_tax > 0.06", "l_tax"),
    "cheap": ("l_extendedprice < 5000", "l_extendedprice"),
    "dear": ("l_extendedprice > 50000", "l_extendedprice"),
    "first parts": ("l_partkey <= 100", "l_partkey"),
    "first suppliers": ("l_suppkey <= 5", "l_suppkey"),
}


@query(
    "fused_reports",
    " UNION ALL ".join(
        f"""
        SELECT '{name}' AS report, COUNT(*) AS n_rows, COUNT(*) FILTER ({condition}) AS n_hits,
               COUNT(*) FILTER ({c} IS NULL) AS n_null,
               ROUND(COUNT(*) FILTER ({condition}) * 100.0 / COUNT(*), 4)::DOUBLE AS pct_hits,
               MIN({c})::DOUBLE AS min_value, MAX({c})::DOUBLE AS max_value
        FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 6 <> 0 THEN {c} END AS {c}) FROM lineitem)
        """
        for name, (condition, c) in CONDITIONS.items()
    ),
)
def fused_reports(spark, sf):
    """Twelve reports on a table with gaps, from one scan."""
    columns = list(dict.fromkeys(c for _, c in CONDITIONS.values()))
    lines = table(spark, sf, "lineitem").select(
        *[F.when(F.col("l_orderkey") % 6 != 0, F.col(c)).alias(c) for c in columns]
    )
    found = fused.fused(lines, {n: fused.condition_report(F.expr(cond), c) for n, (cond, c) in CONDITIONS.items()})
    parts = [
        rows.select(
            F.lit(name).alias("report"), "n_rows", "n_hits", "n_null", "pct_hits",
            F.col("min_value").cast("double").alias("min_value"), F.col("max_value").cast("double").alias("max_value"),
        )
        for name, rows in found.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
