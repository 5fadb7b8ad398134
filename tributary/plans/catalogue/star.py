"""Dimensions, facts, loads, reports on a star."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import keys, skew, star
from tributary.operators.star import Dimension
from tributary.plans import reports
from tributary.plans.catalogue.registry import longs, query, table
from tributary.session import scratch_path
from tributary.sources.files import write_parquet

KIND = Dimension("kind", "id_kind", ("status", "priority"))
SEGMENT = Dimension("segment", "id_segment", ("segment",))

BATCH_SQL = """
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS status, o_orderpriority AS priority,
       CASE WHEN o_orderkey % 7 <> 0 THEN c_mktsegment END AS segment,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, o_totalprice AS total
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def batch(spark, sf):
    """Orders with their customer's segment; natural keys and dates have nulls."""
    order = F.col("o_orderkey")
    orders = table(spark, sf, "orders").select(
        "o_custkey",
        F.when(order % 5 != 0, F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        (order % 7 != 0).alias("has_segment"),
        F.when(order % 11 != 0, F.to_date("o_orderdate")).alias("day"),
        F.col("o_totalprice").alias("total"),
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return star.star_join(orders, [(customer, "o_custkey", "c_custkey")]).select(
        "status",
        "priority",
        F.when(F.col("has_segment"), F.col("c_mktsegment")).alias("segment"),
        "day",
        "total",
    )


KIND_SQL = f"""
SELECT ROW_NUMBER() OVER (ORDER BY status NULLS FIRST, priority NULLS FIRST) AS id_kind, status, priority
FROM (SELECT DISTINCT status, priority FROM ({BATCH_SQL}))
"""
SEGMENT_SQL = f"""
SELECT ROW_NUMBER() OVER (ORDER BY segment NULLS FIRST) AS id_segment, segment
FROM (SELECT DISTINCT segment FROM ({BATCH_SQL}))
"""


@query("surrogate_dim", KIND_SQL)
def surrogate_dim(spark, sf):
    return star.build_dimension(batch(spark, sf), KIND).table


@query(
    "surrogate_dim_ranges",
    """
    SELECT ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber) AS id, l_orderkey, l_linenumber
    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    """,
)
def surrogate_dim_ranges(spark, sf):
    """Numbering of a dimension as large as its fact."""
    lines = table(spark, sf, "lineitem")
    return keys.number_distinct(lines, ["l_orderkey", "l_linenumber"], "id").table


@query(
    "dim_date",
    """
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS BIGINT) AS year,
           CAST(month(o_orderdate) AS BIGINT) AS month
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def dim_date(spark, sf):
    day = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("day")
    return longs(star.date_dimension(table(spark, sf, "orders").select(day), "day"), "year", "month")


@query(
    "insert_ignore_dim",
    """
    WITH stored AS (SELECT o_custkey AS id, MIN(o_orderpriority) AS label FROM orders
                    WHERE o_orderdate < DATE '1995-06-01' GROUP BY o_custkey)
    SELECT id, label FROM stored
    UNION ALL
    SELECT o_custkey, MIN(o_orderpriority) FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM stored WHERE id = o_custkey) GROUP BY o_custkey
    """,
)
def insert_ignore_dim(spark, sf):
    """Stored rows of a first load, then the whole table as the next batch."""
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("label"), "o_orderdate"
    )
    first = orders.filter(F.to_date("o_orderdate") < F.lit("1995-06-01").cast("date"))
    stored = first.groupBy("id").agg(F.min("label").alias("label"))
    return star.insert_ignore(stored, orders.select("id", "label"), ["id"])


@query(
    "extend_dimension",
    """
    WITH first AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < DATE '1995-06-01'),
    stored AS (SELECT ROW_NUMBER() OVER (ORDER BY o_custkey) AS id_customer, o_custkey FROM first),
    fresh AS (SELECT DISTINCT o_custkey FROM orders
              WHERE o_custkey NOT IN (SELECT o_custkey FROM first))
    SELECT id_customer, o_custkey FROM stored
    UNION ALL
    SELECT (SELECT COALESCE(MAX(id_customer), 0) FROM stored) + ROW_NUMBER() OVER (ORDER BY o_custkey),
           o_custkey FROM fresh
    """,
)
def extend_dimension(spark, sf):
    """Ids of a first load stay; customers seen later are numbered after them."""
    customer = Dimension("customer", "id_customer", ("o_custkey",))
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    first = orders.filter(F.col("day") < F.lit("1995-06-01").cast("date"))
    stored = star.build_dimension(first, customer).table
    return star.extend_dimension(stored, orders, customer)


FACT_SQL = f"""
SELECT k.id_kind, s.id_segment, b.day, CAST(trunc(b.total) AS BIGINT) AS total
FROM ({BATCH_SQL}) b
LEFT JOIN ({KIND_SQL}) k ON b.status IS NOT DISTINCT FROM k.status
                        AND b.priority IS NOT DISTINCT FROM k.priority
LEFT JOIN ({SEGMENT_SQL}) s ON b.segment IS NOT DISTINCT FROM s.segment
WHERE b.day IS NOT NULL
"""


@query("fact_build", FACT_SQL)
def fact_build(spark, sf):
    rows = batch(spark, sf)
    dims = [(dim, ids.for_join()) for dim, ids in star.build_dimensions(rows, [KIND, SEGMENT])]
    fact, _ = star.build_fact(rows, dims, "day", ["total"], integers=["total"])
    return fact


@query("fact_rejects", f"SELECT status, priority, segment, total FROM ({BATCH_SQL}) WHERE day IS NULL")
def fact_rejects(spark, sf):
    _, rejected = star.build_fact(batch(spark, sf), [], "day", ["total"])
    return rejected.select("status", "priority", "segment", "total")


@query("star_load", f"{FACT_SQL}")
def star_load(spark, sf):
    """The same batch loaded twice leaves the facts of one load."""
    store = star.StarStore(
        spark, scratch_path(spark, "order-star"), (KIND, SEGMENT), "day", ("total",), ("total",)
    )
    handed = scratch_path(spark, "order-batch")
    write_parquet(batch(spark, sf), handed)
    store.load(spark.read.parquet(handed), "day-1")
    store.load(spark.read.parquet(handed), "day-1")
    return store.table("facts").drop("run")


@query(
    "star_rerun",
    f"""
    SELECT 'facts' AS name, COUNT(*) AS n, '007' AS run FROM ({BATCH_SQL})
    UNION ALL SELECT 'rejects', 0, '007'
    """,
)
def star_rerun(spark, sf):
    """A run repeated with its missing dates mended: no reject is left."""
    store = star.StarStore(
        spark, scratch_path(spark, "order-star"), (KIND, SEGMENT), "day", ("total",), ("total",)
    )
    handed = scratch_path(spark, "order-batch")
    write_parquet(batch(spark, sf), handed)
    rows = spark.read.parquet(handed)
    store.load(rows, "007")
    store.load(rows.withColumn("day", F.coalesce("day", F.to_date(F.lit("2020-01-01")))), "007")
    parts = [
        store.table(name).agg(F.count("*").alias("n"), F.lit(name).alias("name"), F.lit("007").alias("run"))
        for name in ("facts", "rejects")
    ]
    return parts[0].unionByName(parts[1]).select("name", "n", "run")


@query("star_reset", f"SELECT DISTINCT segment FROM ({BATCH_SQL}) WHERE status = 'F'")
def star_reset(spark, sf):
    """A star emptied and loaded anew holds the new batch's members only."""
    store = star.StarStore(
        spark, scratch_path(spark, "order-star"), (KIND, SEGMENT), "day", ("total",), ("total",)
    )
    handed = scratch_path(spark, "order-batch")
    write_parquet(batch(spark, sf), handed)
    rows = spark.read.parquet(handed)
    store.load(rows, "day-1")
    store.reset(rows.filter("status = 'F'"), "day-2")
    return store.table(SEGMENT.name).select("segment")


@query(
    "star_commit",
    f"""
    WITH b AS ({BATCH_SQL}), f AS (SELECT * FROM b WHERE status = 'F')
    SELECT 1::BIGINT AS version, (SELECT COUNT(*) FROM b WHERE day IS NOT NULL) AS facts,
           (SELECT COUNT(*) FROM b WHERE day IS NULL) AS rejects,
           (SELECT COUNT(*) FROM (SELECT DISTINCT status, priority FROM b)) AS kinds
    UNION ALL
    SELECT 2, (SELECT COUNT(*) FROM b), 0, (SELECT COUNT(*) FROM (SELECT DISTINCT status, priority FROM b))
    UNION ALL
    SELECT 3, (SELECT COUNT(*) FROM f WHERE day IS NOT NULL), (SELECT COUNT(*) FROM f WHERE day IS NULL),
           (SELECT COUNT(*) FROM (SELECT DISTINCT status, priority FROM f))
    """,
)
def star_commit(spark, sf):
    """Three versions of a star, each still whole: a load, its mended rerun, a reset.

    A batch that breaks a constraint on the way makes no version.
    """
    store = star.StarStore(
        spark, scratch_path(spark, "order-star"), (KIND, SEGMENT), "day", ("total",), ("total",),
        check="total >= 0",
    )
    handed = scratch_path(spark, "order-batch")
    write_parquet(batch(spark, sf), handed)
    rows = spark.read.parquet(handed)
    store.load(rows, "day-1")
    try:
        store.load(rows.withColumn("total", -F.col("total")), "day-1")
    except star.ConstraintBroken:
        store.load(rows.withColumn("day", F.coalesce("day", F.to_date(F.lit("2020-01-01")))), "day-1")
    store.reset(rows.filter("status = 'F'"), "day-2")
    parts = []
    for version in store.log.versions():
        counts = [
            store.table(name, version).agg(F.count("*")).scalar().alias(out)
            for name, out in (("facts", "facts"), ("rejects", "rejects"), ("kind", "kinds"))
        ]
        parts.append(spark.range(1).select(F.lit(version).cast("long").alias("version"), *counts))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


HOT_SQL = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_orderkey % 2 = 0 THEN 'sin informacion' WHEN l_orderkey % 11 <> 0 THEN 'p' || l_partkey END AS label
FROM lineitem
"""


@query(
    "hot_key_join",
    f"""
    WITH r AS ({HOT_SQL})
    SELECT l_orderkey, l_linenumber, id_label
    FROM r JOIN (SELECT ROW_NUMBER() OVER (ORDER BY label NULLS FIRST) AS id_label, label
                 FROM (SELECT DISTINCT label FROM r)) d ON r.label IS NOT DISTINCT FROM d.label
    """,
)
def hot_key_join(spark, sf):
    """A natural-key lookup in which one label and the null key hold over half of the rows."""
    key = F.col("l_orderkey")
    label = F.when(key % 2 == 0, F.lit("sin informacion")).when(
        key % 11 != 0, F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    )
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"))
    dim = keys.number_distinct(rows, ["label"], "id_label").table
    return skew.attach_number_split(rows, dim, ["label"], "id_label").drop("label")


@query(
    "load_violations",
    f"""
    SELECT 'not null: day' AS "constraint", COUNT(*) FILTER (day IS NULL) AS n FROM ({BATCH_SQL})
    UNION ALL SELECT 'length: status', COUNT(*) FILTER (length(status) > 7) FROM ({BATCH_SQL})
    UNION ALL SELECT 'length: priority', COUNT(*) FILTER (length(priority) > 7) FROM ({BATCH_SQL})
    UNION ALL SELECT 'length: segment', COUNT(*) FILTER (length(segment) > 7) FROM ({BATCH_SQL})
    UNION ALL SELECT 'check: total < 100000', COUNT(*) FILTER (NOT total < 100000) FROM ({BATCH_SQL})
    """,
)
def load_violations(spark, sf):
    """Rows of a batch that break each constraint of its star."""
    store = star.StarStore(
        spark, "", (KIND, SEGMENT), "day", ("total",),
        not_null=("day",), max_length=7, check="total < 100000",
    )
    return store.violations(batch(spark, sf))


def order_star(spark, sf):
    """Fact of orders on the customer's nation and the order date, with both dimensions."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    fact = star.star_join(orders, [(customer, "o_custkey", "c_custkey")]).drop("o_custkey")
    dates = star.date_dimension(orders, "day").withColumnRenamed("day", "id_day")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return fact, (dates, "day", "id_day"), (nation, "c_nationkey", "n_nationkey")


ORDER_STAR_SQL = """
orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


@query(
    "report_year_group",
    f"""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, n_name, COUNT(*) AS total FROM {ORDER_STAR_SQL}
    GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def report_year_group(spark, sf):
    fact, dates, nation = order_star(spark, sf)
    counts = reports.count_by(fact, [dates, nation], ["year", "n_name"])
    return longs(counts, "year").orderBy("year", "n_name")


NATIONS = [f"NATION_{i}" for i in range(25)]


@query(
    "report_over_time",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, "
    + ", ".join(f"NULLIF(COUNT(*) FILTER (n_name = '{n}'), 0) AS {n}" for n in NATIONS)
    + f" FROM {ORDER_STAR_SQL} GROUP BY 1",
)
def report_over_time(spark, sf):
    fact, dates, nation = order_star(spark, sf)
    counts = reports.count_by(fact, [dates, nation], ["year", "n_name"])
    return longs(reports.counts_over_time(counts, "year", "n_name", None, "total", max_columns=100), "year")


@query(
    "report_group_total",
    f"SELECT n_name, COUNT(*) AS total FROM {ORDER_STAR_SQL} GROUP BY n_name ORDER BY total DESC, n_name",
)
def report_group_total(spark, sf):
    fact, _, nation = order_star(spark, sf)
    return reports.count_by(fact, [nation], ["n_name"]).orderBy(F.desc("total"), "n_name")


@query(
    "report_year",
    """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY 1
    """,
)
def report_year(spark, sf):
    fact, dates, _ = order_star(spark, sf)
    return longs(reports.count_by(fact, [dates], ["year"]), "year").orderBy("year")


@query(
    "report_mode_by_group",
    f"""
    SELECT n_name, o_orderpriority, total FROM (
      SELECT n_name, o_orderpriority, COUNT(*) AS total,
             ROW_NUMBER() OVER (PARTITION BY n_name ORDER BY COUNT(*) DESC, o_orderpriority) AS r
      FROM {ORDER_STAR_SQL} GROUP BY n_name, o_orderpriority)
    WHERE r = 1
    """,
)
def report_mode_by_group(spark, sf):
    fact, _, nation = order_star(spark, sf)
    priority = Dimension("priority", "id_priority", ("o_orderpriority",))
    dim = star.build_dimension(table(spark, sf, "orders"), priority).for_join()
    numbered = keys.attach_number(fact, dim, ["o_orderpriority"], "id_priority")
    facts = numbered.select("c_nationkey", F.col("id_priority").alias("act"))
    return reports.most_common(
        facts, nation, (dim, "act", "id_priority"), "n_name", "o_orderpriority"
    )


SQL_REPORT = """
SELECT d.year, n.n_name, COUNT(*) AS total
FROM star_facts f
JOIN star_nation n ON f.c_nationkey = n.n_nationkey
JOIN star_dates d ON f.day = d.id_day
GROUP BY d.year, n.n_name
ORDER BY total DESC, n.n_name, d.year
"""


@query(
    "report_sql",
    f"""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year, n_name, COUNT(*) AS total FROM {ORDER_STAR_SQL}
    GROUP BY 1, 2 ORDER BY total DESC, n_name, year
    """,
)
def report_sql(spark, sf):
    """A report given as SQL text over the star's tables."""
    fact, (dates, *_), (nation, *_) = order_star(spark, sf)
    tables = {"star_facts": fact, "star_dates": longs(dates, "year"), "star_nation": nation}
    return reports.sql_report(spark, tables, SQL_REPORT)
