"""Aggregates, profiles, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions.recode import band
from tributary.functions.text import label
from tributary.operators import aggregate, encode, profile
from tributary.operators.carried import Carried
from tributary.plans import vocabulary as v
from tributary.plans.catalogue.registry import longs, plant, planted, query, table
from tributary.session import scratch_path

HOLED_SQL = """
SELECT event_id, user_id, CAST(ts AS DATE) AS day,
       CASE WHEN event_id % 4 <> 1 THEN event_type END AS kind,
       CASE WHEN user_id % 3 <> 0 THEN user_id % 10 END AS cell,
       CASE WHEN user_id % 10 NOT IN (1, 4) THEN value END AS value
FROM events
"""


def holed(spark, sf):
    """Events with null keys, and with cells whose values are all null."""
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.to_date("ts").alias("day"),
        F.when(F.col("event_id") % 4 != 1, F.col("event_type")).alias("kind"),
        F.when(user % 3 != 0, user % 10).alias("cell"),
        F.when(~(user % 10).isin(1, 4), F.col("value")).alias("value"),
    )


def money(column: str):
    return F.round(F.col(column), 2)


@query(
    "group_count_null_keys",
    f"SELECT kind, cell, COUNT(*) AS total FROM ({HOLED_SQL}) GROUP BY kind, cell",
)
def group_count_null_keys(spark, sf):
    return aggregate.group_count(holed(spark, sf), ["kind", "cell", "not_there"], "total")


@query(
    "group_sum_null_zero",
    f"""
    SELECT kind, cell, ROUND(COALESCE(SUM(value), 0), 2) AS value FROM ({HOLED_SQL})
    GROUP BY kind, cell
    """,
)
def group_sum_null_zero(spark, sf):
    sums = aggregate.group_sum(holed(spark, sf), ["kind", "cell"], "value")
    return sums.withColumn("value", money("value"))


@query(
    "presence_flag",
    f"""
    SELECT kind, cell, ROUND(COALESCE(SUM(value), 0), 2) AS value,
           CASE WHEN COUNT(value) > 0 THEN 'reportado' ELSE 'sin informacion' END AS observed,
           'reportado' AS constant
    FROM ({HOLED_SQL}) GROUP BY kind, cell
    """,
)
def presence_flag(spark, sf):
    rows, labels = holed(spark, sf), (v.REPORTED, v.UNKNOWN)
    sums = aggregate.group_sum(
        rows, ["kind", "cell"], "value", flag="observed", labels=labels, flag_mode="observed"
    )
    return sums.withColumns({"value": money("value"), "constant": F.lit(v.REPORTED)})


@query(
    "consolidate",
    """
    SELECT day, kind, source, ROUND(COALESCE(SUM(total), 0), 2) AS total FROM (
      SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS kind, 'orders' AS source,
             o_totalprice AS total FROM orders
      UNION ALL SELECT CAST(ts AS DATE), event_type, 'events', value FROM events
      UNION ALL SELECT CAST(l_shipdate AS DATE), l_returnflag, 'lines', l_quantity FROM lineitem)
    GROUP BY day, kind, source
    """,
)
def consolidate(spark, sf):
    """Partial sums per source, their union, and the sum of the sums."""
    grain = ["day", "kind", "source"]

    def part(name, day, kind, total, source):
        rows = table(spark, sf, name).select(
            F.to_date(day).alias("day"),
            F.col(kind).alias("kind"),
            F.lit(source).alias("source"),
            F.col(total).alias("total"),
        )
        return aggregate.group_sum(rows, grain, "total")

    union = (
        part("orders", "o_orderdate", "o_orderstatus", "o_totalprice", "orders")
        .unionByName(part("events", "ts", "event_type", "value", "events"))
        .unionByName(part("lineitem", "l_shipdate", "l_returnflag", "l_quantity", "lines"))
    )
    return aggregate.consolidate(union, grain, "total").withColumn("total", money("total"))


@query(
    "avg_topk",
    """
    SELECT n_name, AVG(CAST(ROUND(c_acctbal * 100) AS BIGINT)) AS avg_cents
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY avg_cents DESC, n_name LIMIT 10
    """,
)
def avg_topk(spark, sf):
    """Means are taken per key, then named; cents keep the sums exact."""
    cents = F.round(F.col("c_acctbal") * 100).cast("long").alias("cents")
    balances = table(spark, sf, "customer").select("c_nationkey", cents)
    means = aggregate.mean_per_group(balances, "c_nationkey", "cents", "avg_cents")
    named = means.join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return aggregate.top_k(
        named.select("n_name", "avg_cents"), 10, F.desc("avg_cents"), F.asc("n_name")
    )


MODE_SQL = """
SELECT user_id, event_type, n FROM (
  SELECT user_id, event_type, n,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r
  FROM (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY user_id, event_type))
WHERE r = 1
"""


@query("mode_per_group", MODE_SQL)
def mode_per_group(spark, sf):
    return aggregate.mode_per_group(
        table(spark, sf, "events"), ["user_id"], "event_type", out_value="event_type"
    )


@query(
    "argmax_per_group",
    f"SELECT 'User ' || user_id || ' - ' || event_type AS label, n AS total FROM ({MODE_SQL})",
)
def argmax_per_group(spark, sf):
    counts = aggregate.group_count(table(spark, sf, "events"), ["user_id", "event_type"])
    best = aggregate.argmax_per_group(counts, ["user_id"], "n", ["event_type"], {"n": "total"})
    name = label("User ", F.col("user_id"), " - ", F.col("event_type"))
    return best.select(name.alias("label"), "total")


SHARES_SQL = """
SELECT source, COUNT(*) AS n,
       ROUND(COUNT(*) * 100.0 / (SELECT COUNT(source) FROM documents), 4)::DOUBLE AS pct
FROM documents WHERE source IS NOT NULL GROUP BY source
"""


@query("value_share_topk", f"{SHARES_SQL} ORDER BY n DESC, source LIMIT 5")
def value_share_topk(spark, sf):
    return aggregate.value_shares(table(spark, sf, "documents"), "source", k=5)


@query("value_shares", SHARES_SQL)
def value_shares(spark, sf):
    return aggregate.value_shares(table(spark, sf, "documents"), "source")


@query(
    "null_profile",
    f"""
    SELECT column_name AS column, n_rows, n_null, ROUND(n_null * 100.0 / n_rows, 4)::DOUBLE AS pct_null
    FROM (
      SELECT 'kind' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(kind) AS n_null FROM ({HOLED_SQL})
      UNION ALL SELECT 'cell', COUNT(*), COUNT(*) - COUNT(cell) FROM ({HOLED_SQL})
      UNION ALL SELECT 'value', COUNT(*), COUNT(*) - COUNT(value) FROM ({HOLED_SQL})
      UNION ALL SELECT 'day', COUNT(*), COUNT(*) - COUNT(day) FROM ({HOLED_SQL}))
    """,
)
def null_profile(spark, sf):
    return profile.null_profile(holed(spark, sf), ["kind", "cell", "value", "day"])


@query(
    "label_share",
    """
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (event_type = 'error') AS n_label,
           ROUND(COUNT(*) FILTER (event_type = 'error') * 100.0 / COUNT(*), 4)::DOUBLE AS pct_label
    FROM events
    """,
)
def label_share(spark, sf):
    return profile.label_share(table(spark, sf, "events"), "event_type", "error")


@query(
    "duplicate_count",
    """
    SELECT COUNT(*) AS n_rows, COUNT(DISTINCT text) AS n_distinct,
           COUNT(*) - COUNT(DISTINCT text) AS n_duplicates FROM documents
    """,
)
def duplicate_count(spark, sf):
    return profile.duplicate_count(table(spark, sf, "documents"), ["text"])


@query(
    "duplicate_rows",
    """
    SELECT SUM(n)::BIGINT AS n_rows, COUNT(*) AS n_distinct, (SUM(n) - COUNT(*))::BIGINT AS n_duplicates
    FROM (SELECT l_orderkey, l_linenumber, l_returnflag, COUNT(*) AS n FROM lineitem
          GROUP BY l_orderkey, l_linenumber, l_returnflag)
    """,
)
def duplicate_rows(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return profile.duplicate_count(lines)


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return profile.distinct_values(table(spark, sf, "orders"), "o_orderpriority")


def describe_sql(name: str, columns) -> str:
    parts = [
        f"""
        SELECT '{c}' AS "column", SUM(n) FILTER ({c} IS NOT NULL)::BIGINT AS n_values,
               COUNT({c}) AS n_unique,
               FIRST({c} ORDER BY n DESC, {c}) FILTER ({c} IS NOT NULL) AS top,
               MAX(n) FILTER ({c} IS NOT NULL) AS freq
        FROM (SELECT {c}, COUNT(*) AS n FROM {name} GROUP BY {c})
        """
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query(
    "column_describe",
    describe_sql("orders", ["o_orderstatus", "o_orderpriority"])
    + " UNION ALL "
    + describe_sql("customer", ["c_name", "c_mktsegment"]),
)
def column_describe(spark, sf):
    return profile.column_describe(table(spark, sf, "orders")).unionByName(
        profile.column_describe(table(spark, sf, "customer"))
    )


KINDS = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_report",
    "SELECT CAST(ts AS DATE) AS day, "
    + ", ".join(f"NULLIF(COUNT(*) FILTER (event_type = '{k}'), 0) AS {k}" for k in KINDS)
    + " FROM events GROUP BY day",
)
def pivot_report(spark, sf):
    counts = aggregate.group_count(
        table(spark, sf, "events").withColumn("day", F.to_date("ts")), ["day", "event_type"]
    )
    return aggregate.pivot_first(counts, "day", "event_type", KINDS, "n")


@query(
    "histogram",
    """
    WITH ends AS (SELECT MIN(c_acctbal) AS lo, MAX(c_acctbal) AS hi FROM customer),
    counted AS (
      SELECT CAST(LEAST(FLOOR(20 * (c_acctbal - lo) / (hi - lo)) + 1, 20) AS BIGINT) AS bin,
             COUNT(*) AS n
      FROM customer, ends GROUP BY 1)
    SELECT b.bin, ROUND(lo + (b.bin - 1) * ((hi - lo) / 20), 4) AS low,
           ROUND(lo + b.bin * ((hi - lo) / 20), 4) AS high, COALESCE(n, 0) AS n
    FROM (SELECT UNNEST(range(1, 21)) AS bin) b LEFT JOIN counted ON b.bin = counted.bin, ends
    """,
)
def histogram(spark, sf):
    bins = aggregate.histogram(table(spark, sf, "customer"), "c_acctbal", 20)
    return bins.withColumns({c: F.round(c, 4) for c in ("low", "high")})


@query(
    "ordered_category_count",
    """
    SELECT position, c.band, COALESCE(n, 0) AS n
    FROM (VALUES (1::BIGINT, 'Childhood'), (2, 'Youth'), (3, 'Adulthood'), (4, 'Older adults')) c(position, band)
    LEFT JOIN (SELECT CASE WHEN p_size <= 13 THEN 'Childhood' WHEN p_size <= 26 THEN 'Youth'
                           WHEN p_size <= 59 THEN 'Adulthood' ELSE 'Older adults' END AS band,
                      COUNT(*) AS n FROM part GROUP BY 1) g ON c.band = g.band
    """,
)
def ordered_category_count(spark, sf):
    bands = table(spark, sf, "part").select(
        band(F.col("p_size"), v.AGE_EDGES, v.AGE_LABELS).alias("band")
    )
    return aggregate.ordered_category_count(bands, "band", v.AGE_LABELS)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEGMENT_SQL = "CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END"


def segments(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")).alias("segment"),
    )


@query(
    "label_encode",
    f"""
    SELECT c_custkey, segment,
           CASE WHEN segment IS NOT NULL
                THEN DENSE_RANK() OVER (ORDER BY segment NULLS LAST) - 1 END AS code
    FROM (SELECT c_custkey, {SEGMENT_SQL} AS segment FROM customer)
    """,
)
def label_encode(spark, sf):
    return encode.label_encode(segments(spark, sf), "segment", "code")


@query(
    "label_mapping",
    """
    SELECT c_name, ROW_NUMBER() OVER (ORDER BY c_name) - 1 AS code
    FROM (SELECT DISTINCT c_name FROM customer)
    """,
)
def label_mapping(spark, sf):
    return encode.label_mapping(table(spark, sf, "customer"), "c_name", "code")


@query(
    "one_hot",
    "SELECT c_custkey, segment, "
    + ", ".join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS seg_{s}" for s in SEGMENTS)
    + f" FROM (SELECT c_custkey, {SEGMENT_SQL} AS segment FROM customer)",
)
def one_hot(spark, sf):
    return encode.one_hot(segments(spark, sf), "segment", "seg", max_columns=100)


CARRIED_SQL = """
SELECT o_orderpriority AS priority, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 50 END AS area,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 90 END AS total, year(o_orderdate) AS year,
       o_orderstatus AS status
FROM orders
"""


@query(
    "consolidate_carried",
    f"""
    SELECT priority, area, COALESCE(SUM(total), 0)::BIGINT AS total FROM ({CARRIED_SQL})
    WHERE year <> 1994 AND (year <> 1993 OR status = 'F') GROUP BY priority, area
    """,
)
def consolidate_carried(spark, sf):
    """A run per order year; one is replaced by part of its rows, one by nothing."""
    customer = F.col("o_custkey")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.when(customer % 7 != 0, customer % 50).alias("area"),
        F.when(F.col("o_orderkey") % 3 != 0, customer % 90).alias("total"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("status"),
    )
    store = Carried(spark, scratch_path(spark, "carried"), ["priority", "area"], "total")
    store.add(rows.filter("year = 1993"), "1993")
    store.add(rows.filter("year = 1994"), "1994")
    store.add(rows.filter("year NOT IN (1993, 1994)"), "rest")
    store.add(rows.filter("year = 1993 AND status = 'F'"), "1993")
    store.add(rows.filter("year = 1994").limit(0), "1994")
    return store.table()


MEASURED = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query(
    "number_describe",
    " UNION ALL ".join(
        f"""
        SELECT '{c}' AS "column", COUNT({c}) AS n_values, round(AVG({c}), 6) AS mean,
               round(stddev_samp({c}), 6) AS std, MIN({c})::DOUBLE AS low,
               quantile_disc({c}, 0.25)::DOUBLE AS q25, quantile_disc({c}, 0.5)::DOUBLE AS q50,
               quantile_disc({c}, 0.75)::DOUBLE AS q75, MAX({c})::DOUBLE AS high
        FROM (SELECT CASE WHEN l_orderkey % 9 <> 0 THEN {c} END AS {c} FROM lineitem)
        """
        for c in MEASURED
    ),
)
def number_describe(spark, sf):
    """Numbers with gaps, summed up by one aggregate."""
    lines = table(spark, sf, "lineitem").select(
        *[F.when(F.col("l_orderkey") % 9 != 0, F.col(c)).alias(c) for c in MEASURED]
    )
    found = profile.number_describe(lines)
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "date_describe",
    """
    SELECT 'day' AS "column", COUNT(day) AS n_values, MIN(day) AS low, MAX(day) AS high
    FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS day FROM orders)
    """,
)
def date_describe(spark, sf):
    day = F.when(F.col("o_orderkey") % 9 != 0, F.to_date("o_orderdate")).alias("day")
    return profile.date_describe(table(spark, sf, "orders").select(day)).drop("q25", "q50", "q75")


@query(
    "column_describe_long",
    """
    WITH t AS (SELECT text AS t FROM documents),
    c AS (SELECT t, COUNT(*) AS n FROM t WHERE t IS NOT NULL GROUP BY t)
    SELECT 'text' AS "column", SUM(n)::BIGINT AS n_values, COUNT(*) AS n_unique,
           (SELECT t FROM c ORDER BY n DESC, t LIMIT 1) AS top, MAX(n) AS freq
    FROM c
    """,
)
def column_describe_long(spark, sf):
    """Whole documents, of which only the most frequent one is fetched."""
    return profile.column_describe(table(spark, sf, "documents"), ["text"])
