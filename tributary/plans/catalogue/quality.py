"""Rules, validation, constraint checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import quality, states
from tributary.plans.catalogue.registry import query, table
from tributary.session import scratch_path
from tributary.sources.files import read_runs, write_run

PROFILE_COLUMNS = ["c_custkey", "c_acctbal", "c_name", "c_mktsegment"]


@query(
    "profile_rules",
    """
    SELECT 'row_count' AS rule, 'row_count' AS kind, 1.0::DOUBLE AS low, NULL::DOUBLE AS high,
           NULL::VARCHAR AS member
    UNION ALL SELECT 'c_custkey: null_share', 'null_share', 0, (COUNT(*) - COUNT(c_custkey)) / COUNT(*), NULL FROM customer
    UNION ALL SELECT 'c_acctbal: null_share', 'null_share', 0, (COUNT(*) - COUNT(c_acctbal)) / COUNT(*), NULL FROM customer
    UNION ALL SELECT 'c_name: null_share', 'null_share', 0, (COUNT(*) - COUNT(c_name)) / COUNT(*), NULL FROM customer
    UNION ALL SELECT 'c_mktsegment: null_share', 'null_share', 0, COUNT(*) FILTER (c_custkey % 4 = 0) / COUNT(*), NULL FROM customer
    UNION ALL SELECT 'c_custkey: range', 'range', MIN(c_custkey), MAX(c_custkey), NULL FROM customer
    UNION ALL SELECT 'c_acctbal: range', 'range', MIN(c_acctbal), MAX(c_acctbal), NULL FROM customer
    UNION ALL SELECT 'c_name: length', 'length', MIN(length(c_name)), MAX(length(c_name)), NULL FROM customer
    UNION ALL SELECT 'c_mktsegment: length', 'length', MIN(length(c_mktsegment)), MAX(length(c_mktsegment)), NULL
              FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL SELECT DISTINCT 'c_mktsegment: value_set', 'value_set', NULL::DOUBLE, NULL::DOUBLE, c_mktsegment
              FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL SELECT DISTINCT 'c_name: value_set', 'value_set', NULL::DOUBLE, NULL::DOUBLE, c_name FROM customer
    """,
)
def profile_rules(spark, sf):
    segment = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    customer = table(spark, sf, "customer").withColumn("c_mktsegment", segment)
    rules = quality.infer_rules(customer.select(*PROFILE_COLUMNS), ["c_mktsegment", "c_name"])
    return rules.select(
        "rule",
        "kind",
        F.col("low").cast("double").alias("low"),
        F.col("high").cast("double").alias("high"),
        "member",
    )


@query(
    "validate_rules",
    """
    WITH early AS (SELECT * FROM orders WHERE o_orderdate < DATE '1996-01-01'),
    b AS (SELECT MIN(o_totalprice) FILTER (o_orderkey % 60 <> 0) AS lo,
                 MAX(o_totalprice) FILTER (o_orderkey % 60 <> 0) AS hi, MIN(o_orderdate) AS d0,
                 MAX(o_orderdate) AS d1, MIN(length(o_orderpriority)) AS l0,
                 MAX(length(o_orderpriority)) AS l1, MIN(length(o_orderstatus)) AS s0,
                 MAX(length(o_orderstatus)) AS s1 FROM early),
    late AS (SELECT o_totalprice AS t, o_orderdate AS d,
                    CASE WHEN o_orderkey % 50 = 0 THEN 'X' ELSE o_orderstatus END AS s,
                    CASE WHEN o_orderkey % 40 <> 0 THEN o_orderpriority END AS p FROM orders),
    n AS (
      SELECT 'o_totalprice: range' AS rule, 'range' AS kind, COUNT(*) FILTER (t < lo OR t > hi) AS bad FROM late, b
      UNION ALL SELECT 'day: range', 'range', COUNT(*) FILTER (d < d0 OR d > d1) FROM late, b
      UNION ALL SELECT 'o_orderstatus: length', 'length', COUNT(*) FILTER (length(s) < s0 OR length(s) > s1) FROM late, b
      UNION ALL SELECT 'o_orderpriority: length', 'length', COUNT(*) FILTER (length(p) < l0 OR length(p) > l1) FROM late, b
      UNION ALL SELECT 'o_orderstatus: value_set', 'value_set',
                       COUNT(*) FILTER (s NOT IN (SELECT o_orderstatus FROM early)) FROM late
      UNION ALL SELECT 'o_orderpriority: value_set', 'value_set',
                       COUNT(*) FILTER (p IS NOT NULL AND p NOT IN (SELECT o_orderpriority FROM early)) FROM late
      UNION ALL SELECT 'o_totalprice: null_share', 'null_share', COUNT(*) - COUNT(t) FROM late
      UNION ALL SELECT 'day: null_share', 'null_share', COUNT(*) - COUNT(d) FROM late
      UNION ALL SELECT 'o_orderstatus: null_share', 'null_share', COUNT(*) - COUNT(s) FROM late
      UNION ALL SELECT 'o_orderpriority: null_share', 'null_share', COUNT(*) - COUNT(p) FROM late
    )
    SELECT rule, kind, CASE WHEN kind = 'null_share' THEN bad / (SELECT COUNT(*) FROM late) ELSE bad END AS observed,
           bad = 0 AS ok FROM n
    UNION ALL SELECT 'row_count', 'row_count', COUNT(*), COUNT(*) >= 1 FROM late
    """,
)
def validate_rules(spark, sf):
    """Rules of the first year's orders, some prices not a number, held against all orders with faults."""
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    columns = ["o_totalprice", "day", "o_orderstatus", "o_orderpriority"]
    early = orders.filter(F.col("day") < F.lit("1996-01-01").cast("date"))
    order = F.col("o_orderkey")
    faulty = orders.withColumns(
        {
            "o_orderstatus": F.when(order % 50 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")),
            "o_orderpriority": F.when(order % 40 != 0, F.col("o_orderpriority")),
        }
    )
    domains = ["o_orderstatus", "o_orderpriority"]
    nan = F.when(order % 60 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    early = early.withColumn("o_totalprice", nan)
    rules = quality.infer_rules(early.select(*columns), domains)
    outcome = quality.validate(faulty.select(*columns), rules)
    return outcome.select("rule", "kind", F.col("observed").cast("double").alias("observed"), "ok")


@query(
    "key_violations",
    """
    SELECT l_orderkey, line, COUNT(*) AS n
    FROM (SELECT l_orderkey, CASE WHEN l_quantity < 50 THEN l_linenumber END AS line FROM lineitem)
    GROUP BY l_orderkey, line HAVING COUNT(*) > 1 OR line IS NULL
    """,
)
def key_violations(spark, sf):
    line = F.when(F.col("l_quantity") < 50, F.col("l_linenumber")).alias("line")
    return quality.key_violations(
        table(spark, sf, "lineitem").select("l_orderkey", line), ["l_orderkey", "line"]
    )


@query(
    "fk_violations",
    """
    SELECT 'o_custkey' AS foreign_key, CAST(k AS VARCHAR) AS value, COUNT(*) AS n
    FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 WHEN o_orderkey % 7 = 0 THEN NULL
                      ELSE o_custkey END AS k FROM orders)
    WHERE k IS NOT NULL AND k NOT IN (SELECT c_custkey FROM customer) GROUP BY k
    UNION ALL
    SELECT 'status', o_orderstatus, COUNT(*) FROM orders
    WHERE o_orderstatus NOT IN (SELECT l_linestatus FROM lineitem) GROUP BY o_orderstatus
    """,
)
def fk_violations(spark, sf):
    """A third of all orders points to one customer that does not exist."""
    order = F.col("o_orderkey")
    customer_key = (
        F.when(order % 3 == 0, F.lit(-1).cast("long"))
        .when(order % 7 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("o_custkey"))
    )
    fact = table(spark, sf, "orders").select(
        customer_key.alias("o_custkey"), F.col("o_orderstatus").alias("status")
    )
    states = table(spark, sf, "lineitem").select("l_linestatus").distinct()
    return quality.fk_violations(
        fact,
        [
            ("o_custkey", table(spark, sf, "customer"), "c_custkey"),
            ("status", states, "l_linestatus"),
        ],
    )


@query(
    "check_violations",
    """
    SELECT p_partkey, kind FROM (
      SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_type END AS kind FROM part)
    WHERE kind NOT IN ('ECONOMY', 'SMALL', 'LARGE')
    """,
)
def check_violations(spark, sf):
    kind = F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")).alias("kind")
    part = table(spark, sf, "part").select("p_partkey", kind)
    return quality.check_violations(part, F.col("kind").isin("ECONOMY", "SMALL", "LARGE"))


@query(
    "replace_rules",
    """
    SELECT 'row_count' AS rule, '1' AS low, NULL AS high
    UNION ALL SELECT 'n: null_share', '0.0', '0.0'
    UNION ALL SELECT 'n: range', CAST(MIN(c_nationkey) AS VARCHAR), CAST(MAX(c_nationkey) AS VARCHAR) FROM customer
    """,
)
def replace_rules(spark, sf):
    """Rules stored first are replaced by the next ones."""
    path = scratch_path(spark, "rules")
    customer = table(spark, sf, "customer")
    quality.save_rules(quality.infer_rules(customer, ["c_mktsegment"]), path)
    nations = customer.select(F.col("c_nationkey").cast("int").alias("n"))
    quality.save_rules(quality.infer_rules(nations), path)
    return quality.load_rules(spark, path).select("rule", "low", "high")


@query(
    "stored_outcomes",
    """
    SELECT r.run, o.rule, o.ok FROM (VALUES ('007'), ('2024-01-02')) r(run),
    (SELECT 'row_count' AS rule, COUNT(*) >= 1 AS ok FROM customer
     UNION ALL SELECT 'c_acctbal: null_share', TRUE
     UNION ALL SELECT 'c_acctbal: range', FALSE) o
    """,
)
def stored_outcomes(spark, sf):
    """Outcomes of two runs, one of them repeated; run names stay text."""
    path = scratch_path(spark, "outcomes")
    customer = table(spark, sf, "customer").select("c_acctbal")
    rules = quality.infer_rules(customer.filter("c_acctbal < 0"))
    for run in ("007", "2024-01-02", "007"):
        quality.save_outcome(quality.settled(quality.validate(customer, rules)), path, run)
    return quality.load_outcomes(spark, path).select("run", "rule", "ok")


@query(
    "profile_history",
    """
    WITH r AS (SELECT o_custkey AS customer, CASE WHEN o_orderkey % 8 <> 0 THEN o_orderdate::DATE END AS day,
                      CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority FROM orders),
    n AS (SELECT COUNT(*) AS n FROM r)
    SELECT 'customer: type' AS rule, 'bigint' AS bound UNION ALL SELECT 'day: type', 'date'
    UNION ALL SELECT 'priority: type', 'string'
    UNION ALL SELECT 'customer: range', MIN(customer) || ' to ' || MAX(customer) FROM r
    UNION ALL SELECT 'day: range', MIN(day) || ' to ' || MAX(day) FROM r
    UNION ALL SELECT 'priority: length', MIN(length(priority)) || ' to ' || MAX(length(priority)) FROM r
    UNION ALL SELECT 'customer: null_share', round(COUNT(*) FILTER (customer IS NULL) / COUNT(*), 6)::VARCHAR FROM r
    UNION ALL SELECT 'day: null_share', round(COUNT(*) FILTER (day IS NULL) / COUNT(*), 6)::VARCHAR FROM r
    UNION ALL SELECT 'priority: null_share', round(COUNT(*) FILTER (priority IS NULL) / COUNT(*), 6)::VARCHAR FROM r
    UNION ALL SELECT c || ': distinct_count', 'holds' FROM (VALUES ('customer'), ('day'), ('priority')) v(c)
    UNION ALL SELECT 'customer: quantile ' || f, 'holds' FROM (VALUES ('0.05'), ('0.5'), ('0.95')) v(f)
    """,
)
def profile_history(spark, sf):
    """Rules of the merged states of three runs; those of sketches are held against all rows."""
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.when(key % 8 != 0, F.to_date("o_orderdate")).alias("day"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("priority"),
        (key % 3).alias("run"),
    )
    path = scratch_path(spark, "states")
    for run in range(3):
        write_run(states.column_states(rows.filter(F.col("run") == run).drop("run")), path, f"day-{run}")
    merged = states.merge_states(read_runs(spark, path).drop("run"))
    rules = states.rules_from_states(merged)
    held = quality.validate(rows.drop("run"), rules).filter("kind IN ('distinct_count', 'quantile')")
    exact = rules.filter("kind NOT IN ('distinct_count', 'quantile')")
    bound = (
        F.when(F.col("kind") == "type", F.col("member"))
        .when(F.col("kind") == "null_share", F.round(F.col("high").cast("double"), 6).cast("string"))
        .otherwise(F.concat_ws(" to ", "low", "high"))
    )
    sketched = held.select("rule", F.when(F.col("ok"), "holds").otherwise(F.col("observed")).alias("bound"))
    return exact.select("rule", bound.alias("bound")).unionByName(sketched)
