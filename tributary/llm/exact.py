"""Exact duplicates by a content sort.

Rows are range-partitioned by sampled splitters over the normalised content and
sorted externally, so equal contents lie next to each other; each row is then
compared in full with the row before it. Runs of equal rows may cross a
partition border, so a run of any size is spread over as many tasks as its rows
need; the first and last run of each partition (two rows per partition) decide
which runs belong together. There equality is by SHA-256 digest, not by text. Sizes
are counted per run of one partition, and only the few runs that were joined over
borders are summed further, so no task holds more of a group than one partition does.

The sort key is the head of the content, then its SHA-256 digest, so splitters
stay short whatever the texts are. Null text counts as empty. Of equal rows the
one with the most code points stays, then the smallest id (null ids last), then
the first in the sort; rows that repeat an id are rows of their own, so exactly
one row of a group stays. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import SPACE_CLASS, giving_back, stored, text_chunks, texts

HEAD = 32
CHUNK = 2 << 20  # bytes of text compared at once, and sent back at once
RUN_FIELDS = [
    T.StructField("part", T.IntegerType()),
    T.StructField("run", T.LongType()),
    T.StructField("first", T.BooleanType()),
]


@giving_back
def _runs(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of equal rows of one sorted partition; the text stays only if asked for."""
    part, run, last = TaskContext.get().partitionId(), -1, None
    for batch in text_chunks(batches, limit=CHUNK):
        content = pc.replace_substring_regex(texts(batch), SPACE_CLASS + "+", "")
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = pc.not_equal(content[1:], content[:-1]).to_numpy(zero_copy_only=False)
        new[0] = last is None or content[0].as_py() != last
        numbers = run + np.cumsum(new)
        run, last = int(numbers[-1]), content[-1].as_py()
        kept = [n for n in batch.schema.names if with_text or n != "text"]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in kept),
                pa.array(np.full(batch.num_rows, part, np.int32)),
                pa.array(numbers.astype(np.int64)),
                pa.array(new),
            ],
            names=[*kept, "part", "run", "first"],
        )


def _sorted_runs(rows: DataFrame, with_text: bool = False) -> DataFrame:
    """Rows of (doc_id, text, more) in content order, with digest, partition, run, first."""
    order = ["head", "text_sha256", F.desc("points"), F.asc_nulls_last("doc_id")]
    whole = F.coalesce("text", F.lit(""))
    content = F.regexp_replace(whole, SPACE_CLASS + "+", "")
    keyed = rows.withColumns(
        {
            "head": F.substring(content, 1, HEAD),
            "text_sha256": F.sha2(content, 256),
            "points": F.char_length(whole),
        }
    )
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("head", "points")
    fields = [f for f in ranged.schema.fields if with_text or f.name != "text"]
    return ranged.mapInArrow(lambda batches: _runs(batches, with_text), T.StructType(fields + RUN_FIELDS))


def _joined_runs(runs: DataFrame) -> list[tuple[int, int, int, int]]:
    """(part, run, first part, first run) of the runs that continue one of an earlier partition.

    Reads the first and the last run of each partition.
    """
    edges = (
        runs.groupBy("part")
        .agg(
            F.min_by("text_sha256", "run").alias("head"),
            F.max_by("text_sha256", "run").alias("tail"),
            F.max("run").alias("last"),
        )
        .orderBy("part")
        .collect()
    )
    joined, before = [], None
    for edge in edges:
        origin = None
        if before and before[0] == edge["head"]:
            origin = before[1]
            joined.append((edge["part"], 0, *origin))
        if edge["last"] or origin is None:
            origin = (edge["part"], edge["last"])
        before = (edge["tail"], origin)
    return joined


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    runs = stored(_sorted_runs(rows), "exact-runs")
    sizes = runs.groupBy("part", "run").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("first"), F.col("doc_id"))).alias("keep")
    )
    # at most two runs per partition: those that were joined, and those they were joined to
    joined = _joined_runs(runs)
    linked = docs.sparkSession.createDataFrame(
        joined + [(*to, *to) for to in sorted({j[2:] for j in joined})],
        "part int, run long, to_part int, to_run long",
    ).withColumn("own", (F.col("part") == F.col("to_part")) & (F.col("run") == F.col("to_run")))
    whole = (
        sizes.join(F.broadcast(linked), ["part", "run"])
        .groupBy("to_part", "to_run")
        .agg(F.sum("n").alias("all_n"), F.max(F.when(F.col("own"), F.col("keep"))).alias("all_keep"))
    )
    borders = linked.join(whole, ["to_part", "to_run"]).drop("to_part", "to_run")
    return (
        runs.join(sizes.filter("n > 1"), ["part", "run"], "left")
        .join(F.broadcast(borders), ["part", "run"], "left")
        .select(
            "doc_id",
            F.when(F.col("own").isNotNull(), F.col("all_keep"))
            .when(F.col("n").isNotNull(), F.col("keep"))
            .otherwise(F.col("doc_id"))
            .alias("keep_id"),
            F.coalesce("all_n", "n", F.lit(1).cast("long")).alias("group_size"),
            (F.col("first") & F.coalesce("own", F.lit(True))).alias("kept"),
            "text_sha256",
        )
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    rows = docs.select(
        quoted[id_col].cast("long").alias("doc_id"),
        quoted[text_col].alias("text"),
        F.struct(*[column for c, column in quoted.items() if c != text_col]).alias("row"),
    )
    first = stored(_sorted_runs(rows, with_text=True).filter("first"), "exact-first")
    joined = docs.sparkSession.createDataFrame(
        [j[:2] for j in _joined_runs(first)], "part int, run long"
    )
    return first.join(F.broadcast(joined), ["part", "run"], "left_anti").select(
        *[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in quoted]
    )
