"""Sources and sinks, column shapes, unions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tributary.functions.text import label
from tributary.operators import profile, shape
from tributary.operators.star import star_join
from tributary.plans.catalogue.registry import listed, longs, plant, planted, query, table, text
from tributary.plans.vocabulary import INGEST_TAGS
from tributary.session import scratch_path
from tributary.sources import files, pages, types

EXTRACT_SQL = f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(year(o.o_orderdate) AS BIGINT) AS order_year, o.o_orderpriority, c.c_mktsegment,
       n.n_name, r.r_name, {text(INGEST_TAGS[0])} AS source
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def extract(spark, sf):
    """Flat record out of five normalised tables.

    The dimension chain is joined from its small end and before the fact, so the
    fact is shuffled once, on the order key, and the wide record not at all.
    """
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("order_date")
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    customer_side = star_join(
        customer,
        [
            (table(spark, sf, "nation"), "c_nationkey", "n_nationkey"),
            (table(spark, sf, "region"), "n_regionkey", "r_regionkey"),
        ],
    )
    order_side = star_join(orders, [(customer_side, "o_custkey", "c_custkey")])
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    flat = star_join(lines, [(order_side, "l_orderkey", "o_orderkey")])
    flat = flat.withColumn("order_year", F.year("order_date").cast("long"))
    columns = [
        "l_orderkey", "l_linenumber", "l_quantity", "order_date", "order_year",
        "o_orderpriority", "c_mktsegment", "n_name", "r_name",
    ]
    return files.tag(flat.select(*columns), INGEST_TAGS[0])


@query("star_join_extract", EXTRACT_SQL)
def star_join_extract(spark, sf):
    return extract(spark, sf)


CITIES = ["Bogotá", "Nariño", "NA", "San Andrés, isla", "Quindío", "None", "N/A", 'El "Peñol"', "nan"]
MISSING = ["NA", "None", "N/A", "nan"]


@query(
    "csv_header_scan",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
           CASE WHEN city NOT IN ({listed(MISSING)}) THEN city END AS city,
           {text(INGEST_TAGS[1])} AS source
    FROM (SELECT *, {planted("c_custkey", CITIES)} AS city FROM customer)
    """,
)
def csv_header_scan(spark, sf):
    columns = ["c_custkey", "c_name", "c_mktsegment", "city"]
    customer = table(spark, sf, "customer").withColumn("city", plant("c_custkey", CITIES))
    path = scratch_path(spark, "customer-latin1")
    files.write_csv(customer.select(*columns), path, encoding=files.LATIN1)
    scan = files.read_csv(spark, path, columns, encoding=files.LATIN1)
    return files.tag(scan, INGEST_TAGS[1])


@query(
    "csv_headerless_scan",
    """
    SELECT o_orderkey AS code, o_orderpriority AS priority, o_orderstatus AS status,
           CAST(o_orderdate AS DATE) AS day
    FROM orders
    """,
)
def csv_headerless_scan(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", F.to_date("o_orderdate").alias("o_orderdate")
    )
    path = scratch_path(spark, "orders-unnamed")
    files.write_csv(orders, path, sep=";", encoding=files.LATIN1)
    rows = files.read_csv_unnamed(
        spark, path, ["code", "priority", "status", "day"], header_cell="o_orderkey"
    )
    return rows.withColumns(
        {"code": F.col("code").cast("bigint"), "day": F.col("day").cast("date")}
    )


@query(
    "paged_json_scan",
    f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(day(ts) AS VARCHAR) AS vigencia,
           CASE WHEN event_id % 7 <> 3 THEN CAST(user_id AS VARCHAR) END AS user_id,
           {text(INGEST_TAGS[2])} AS source
    FROM events WHERE day(ts) >= 12
    """,
)
def paged_json_scan(spark, sf):
    records = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.dayofmonth("ts").cast("string").alias("vigencia"),
        F.when(F.col("event_id") % 7 != 3, F.col("user_id").cast("string")).alias("user_id"),
    )
    path = scratch_path(spark, "event-pages")
    pages.land(records, path)
    landed = pages.read_landed(spark, path, ["event_id", "event_type", "vigencia", "user_id"])
    recent = landed.filter(pages.from_year(F.col("vigencia"), 12))
    return files.tag(recent, INGEST_TAGS[2])


LINE = "CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',' || o_orderstatus"


@query(
    "csv_rejects",
    f"""
    SELECT CASE WHEN o_orderkey % 13 = 0 THEN {LINE} || ',more'
                ELSE CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority END AS record, NULL AS status
    FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0
    UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderstatus
    FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
    """,
)
def csv_rejects(spark, sf):
    """Lines with a cell too many or too few are kept apart, whole."""
    key = F.col("o_orderkey")
    short = F.concat_ws(",", key.cast("string"), "o_orderpriority")
    whole = F.concat_ws(",", short, "o_orderstatus")
    line = F.when(key % 13 == 0, F.concat(whole, F.lit(",more"))).when(key % 17 == 0, short)
    path = scratch_path(spark, "lines")
    table(spark, sf, "orders").select(F.coalesce(line, whole).alias("value")).write.text(path)
    rows, rejects = files.split_csv(spark, path, ["code", "priority", "status"], header=False)
    broken = rejects.select("record", F.lit(None).cast("string").alias("status"))
    return broken.unionByName(rows.select(F.col("code").alias("record"), "status"))


@query(
    "json_rejects",
    """
    SELECT '{"id": "' || event_id AS record, NULL AS kind FROM events WHERE event_id % 19 = 0
    UNION ALL SELECT CAST(event_id AS VARCHAR), event_type FROM events WHERE event_id % 19 <> 0
    """,
)
def json_rejects(spark, sf):
    """Lines that are no records are kept apart, whole."""
    key = F.col("event_id").cast("string")
    record = F.to_json(F.struct(key.alias("id"), F.col("event_type").alias("kind")))
    broken = F.concat(F.lit('{"id": "'), key)
    line = F.when(F.col("event_id") % 19 == 0, broken).otherwise(record)
    path = scratch_path(spark, "records")
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    rows, rejects = pages.split_landed(spark, path, ["id", "kind"])
    lost = rejects.select("record", F.lit(None).cast("string").alias("kind"))
    return lost.unionByName(rows.select(F.col("id").alias("record"), "kind"))


@query("paged_json_overlap", "SELECT event_id, event_type, user_id FROM events")
def paged_json_overlap(spark, sf):
    """Pages that repeat records: every purchase comes twice, in the scan once."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    again = events.filter("event_type = 'purchase'")
    path = scratch_path(spark, "event-pages-overlap")
    pages.land(events.unionByName(again), path)
    landed = pages.read_landed(spark, path, events.columns)
    once = pages.drop_repeated(landed, "event_id")
    return longs(once, "event_id", "user_id")


@query("parquet_roundtrip", "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "orders-parquet")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    files.write_parquet(orders, path)
    return files.read_parquet(spark, path, "orders")


@query("csv_roundtrip", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "part-csv")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    files.write_csv(part, path)
    return files.read_csv(spark, path, part.columns).select(
        F.col("p_partkey").cast("bigint"),
        "p_name",
        "p_brand",
        F.col("p_size").cast("int"),
        F.col("p_retailprice").cast("double"),
    )


COMMON = StructType(
    [
        StructField("key", LongType()),
        StructField("kind", StringType()),
        StructField("amount", DoubleType()),
        StructField("segment", StringType()),
        StructField("source", StringType()),
    ]
)


@query(
    "source_tag_union",
    """
    SELECT o_orderkey AS key, o_orderstatus AS kind, o_totalprice AS amount,
           CAST(NULL AS VARCHAR) AS segment, 'orders' AS source FROM orders
    UNION ALL
    SELECT event_id, event_type, value, NULL, 'events' FROM events
    UNION ALL
    SELECT c_custkey, NULL, c_acctbal, c_mktsegment, 'customers' FROM customer
    """,
)
def source_tag_union(spark, sf):
    names = {
        "o_orderkey": "key", "o_orderstatus": "kind", "o_totalprice": "amount",
        "event_id": "key", "event_type": "kind", "value": "amount",
        "c_custkey": "key", "c_acctbal": "amount", "c_mktsegment": "segment",
    }
    return shape.union_tagged(
        {
            "orders": shape.rename(table(spark, sf, "orders"), names),
            "events": shape.rename(table(spark, sf, "events"), names),
            "customers": shape.rename(table(spark, sf, "customer"), names),
        },
        COMMON,
    )


@query(
    "conform_columns",
    """
    SELECT p_brand, p_partkey, CAST(NULL AS VARCHAR) AS colour, CAST(NULL AS BIGINT) AS stock,
           CAST(p_size AS BIGINT) AS p_size
    FROM part
    """,
)
def conform_columns(spark, sf):
    schema = StructType(
        [
            StructField("p_brand", StringType()),
            StructField("p_partkey", LongType()),
            StructField("colour", StringType()),
            StructField("stock", LongType()),
            StructField("p_size", LongType()),
        ]
    )
    return shape.conform(table(spark, sf, "part"), schema)


@query(
    "rename_conform",
    """
    SELECT c_custkey AS codigo_cliente, c_name AS nombre, c_mktsegment AS segment,
           c_nationkey AS nationkey FROM customer
    """,
)
def rename_conform(spark, sf):
    messy = table(spark, sf, "customer").toDF(
        " Código Cliente", "NOMBRE", "C_NationKey", "C_AcctBal", "Segmentó"
    )
    named = shape.rename(shape.fold_names(messy), {"segmento": "segment", "absent": "x"})
    named = shape.rename(shape.lower_names(named), {"c_nationkey": "nationkey"})
    return shape.drop(named, "c_acctbal", "not_there")


@query("total_rows_column", "SELECT c_custkey, c_name, COUNT(*) OVER () AS total_rows FROM customer")
def total_rows_column(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return shape.with_total_rows(customer, "total_rows")


@query("text_label", "SELECT p_partkey, 'Part ' || p_partkey || ' - ' || p_name AS label FROM part")
def text_label(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey", label("Part ", F.col("p_partkey"), " - ", F.col("p_name")).alias("label")
    )


@query(
    "step_metrics",
    """
    SELECT 'read' AS step, COUNT(*) AS n_rows FROM orders
    UNION ALL
    SELECT 'urgent', COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def step_metrics(spark, sf):
    """Row counts per step, taken while the one job that needs the rows runs."""
    orders, read = profile.watch(table(spark, sf, "orders"), "read")
    urgent, kept = profile.watch(orders.filter("o_orderpriority = '1-URGENT'"), "urgent")
    urgent.write.format("noop").mode("overwrite").save()
    return profile.watched_rows(orders, [("read", read), ("urgent", kept)])


# Columns of text: numbers with gaps, exponents, codes with leading zeros, dates, times, a mixture.
TYPED = {
    "key": "o_orderkey::VARCHAR",
    "area": "CASE WHEN o_custkey % 5 <> 0 THEN (o_custkey - 100)::VARCHAR END",
    "price": "(o_custkey % 1000)::VARCHAR || '.' || lpad((o_orderkey % 100)::VARCHAR, 2, '0')",
    "rate": "CASE WHEN o_orderkey % 3 = 0 THEN (o_custkey % 7)::VARCHAR || 'e-2' ELSE (o_custkey % 7)::VARCHAR END",
    "code": "lpad((o_custkey % 33)::VARCHAR, 2, '0')",
    "day": "CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END",
    "moment": "CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m-%d 10:11:12') END",
    "flag": "CASE WHEN o_custkey % 2 = 0 THEN 'True' ELSE 'false' END",
    "mixed": "CASE WHEN o_orderkey % 50 = 0 THEN 'none' ELSE o_custkey::VARCHAR END",
    "empty": "NULL::VARCHAR",
}


def untyped_csv(spark, sf):
    """Orders as a CSV file of these columns."""
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    orders = table(spark, sf, "orders").select(
        key.cast("string").alias("key"),
        F.when(customer % 5 != 0, (customer - 100).cast("string")).alias("area"),
        F.concat((customer % 1000).cast("string"), F.lit("."), F.lpad((key % 100).cast("string"), 2, "0")).alias("price"),
        F.concat((customer % 7).cast("string"), F.when(key % 3 == 0, F.lit("e-2")).otherwise(F.lit(""))).alias("rate"),
        F.lpad((customer % 33).cast("string"), 2, "0").alias("code"),
        F.when(key % 6 != 0, F.date_format(day, "yyyy-MM-dd")).alias("day"),
        F.date_format(day, "yyyy-MM-dd").alias("moment"),
        F.when(customer % 2 == 0, F.lit("True")).otherwise(F.lit("false")).alias("flag"),
        F.when(key % 50 == 0, F.lit("none")).otherwise(customer.cast("string")).alias("mixed"),
        F.lit(None).cast("string").alias("empty"),
    )
    moment = F.when(F.col("key") % 2 == 0, F.col("moment")).otherwise(F.concat("moment", F.lit(" 10:11:12")))
    path = scratch_path(spark, "untyped")
    files.write_csv(orders.withColumn("moment", moment), path)
    return path


TYPED_ROWS_SQL = f"SELECT {', '.join(f'{sql} AS {c}' for c, sql in TYPED.items())} FROM orders"


def _type_sql(c: str) -> str:
    def fits(kind: str, also: str = "true") -> str:
        return f"COUNT({c}) = COUNT(CASE WHEN TRY_CAST({c} AS {kind}) IS NOT NULL AND {also} THEN 1 END)"

    digits = f"max(length(ltrim(split_part({c}, '.', 1), '0-')))", f"max(length(split_part({c}, '.', 2)))"
    return f"""
    SELECT '{c}' AS "column", CASE WHEN COUNT({c}) = 0 THEN 'string'
      WHEN {fits("BIGINT", f"regexp_full_match({c}, '-?[0-9]+')")} THEN 'bigint'
      WHEN {fits("DOUBLE", f"regexp_full_match({c}, '-?[0-9]*[.]?[0-9]*')")}
      THEN 'decimal(' || ({digits[0]} + {digits[1]}) || ',' || {digits[1]} || ')'
      WHEN {fits("DOUBLE")} THEN 'double'
      WHEN {fits("DATE", f"length({c}) = 10")} THEN 'date'
      WHEN {fits("TIMESTAMP")} THEN 'timestamp'
      WHEN {fits("BOOLEAN")} THEN 'boolean' ELSE 'string' END AS type
    FROM ({TYPED_ROWS_SQL})
    """


@query("inferred_types", " UNION ALL ".join(map(_type_sql, TYPED)))
def inferred_types(spark, sf):
    """The type of every column of a CSV file, by one aggregate."""
    found = types.infer_types(files.read_csv(spark, untyped_csv(spark, sf)))
    return spark.createDataFrame(list(found.items()), "column string, type string")


@query(
    "typed_csv",
    f"""
    SELECT key::BIGINT AS key, area::BIGINT AS area, price::DOUBLE AS price, rate::DOUBLE AS rate,
           code AS code, day::DATE AS day, strftime(moment::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS moment,
           flag::BOOLEAN AS flag, mixed, empty
    FROM ({TYPED_ROWS_SQL})
    """,
)
def typed_csv(spark, sf):
    """A CSV file in the types its values have, codes with leading zeros left as they are."""
    rows = types.read_typed_csv(spark, untyped_csv(spark, sf), codes_as_text=True)
    stamp = F.date_format("moment", "yyyy-MM-dd HH:mm:ss")
    return rows.withColumns({"price": F.col("price").cast("double"), "moment": stamp})
