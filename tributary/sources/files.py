"""CSV and Parquet files."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tributary.session import scratch_path

LATIN1 = "ISO-8859-1"

# Texts a data-frame CSV reader takes as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


class SourceMissing(FileNotFoundError):
    """A named source is not where it should be."""


def text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _load(name: str, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceMissing(f"source '{name}': {error.getMessage()}") from error
        raise


def read_parquet(spark: SparkSession, path: str, name: str = "parquet") -> DataFrame:
    return _load(name, lambda: spark.read.parquet(path))


def tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Text columns with the listed missing-value texts as null."""
    missing = list(tokens)
    return df.withColumns(
        {
            f.name: F.when(~F.col(f.name).isin(missing), F.col(f.name))
            for f in df.schema
            if isinstance(f.dataType, StringType)
        }
    )


CORRUPT = "_corrupt_record"


def _csv_reader(spark: SparkSession, columns: Sequence[str] | None, rejects: bool, **options):
    """A reader that fails on a row that does not fit, or keeps it in a column of its own.

    Pruning is off, since a row is only checked against the columns parsed.
    """
    reader = spark.read.options(escape='"', columnPruning=False, **options)
    if rejects:
        names = [*columns, CORRUPT]
        return reader.options(columnNameOfCorruptRecord=CORRUPT).schema(text_schema(names))
    reader = reader.options(mode="FAILFAST")
    return reader.schema(text_schema(columns)) if columns else reader


def read_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    name: str = "csv",
    sep: str = ",",
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Files with a header row, all columns as text; typing is a later step.

    Given column names are checked against the header; without them the header
    of one file is read. No pass over the data infers types. A row with more or
    fewer cells fails the job; ``split_csv`` keeps such rows apart.
    ``multi_line`` allows line breaks inside quotes; such files cannot be split
    between tasks.
    """
    reader = _csv_reader(
        spark, columns, False,
        header=True, sep=sep, encoding=encoding, enforceSchema=False, multiLine=multi_line,
    )
    return tokens_to_null(_load(name, lambda: reader.csv(path)), null_tokens)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that fit, and the raw records of those that do not.

    What was parsed is stored first, so both come from one parse.
    """
    path = scratch_path(df.sparkSession, "parsed")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    broken = F.col(CORRUPT).isNotNull()
    return df.filter(~broken).drop(CORRUPT), df.filter(broken).select(F.col(CORRUPT).alias("record"))


def split_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    name: str = "csv",
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    null_tokens: Sequence[str] = NULL_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """Rows with as many cells as columns, and the raw records of all others."""
    reader = _csv_reader(spark, columns, True, header=header, sep=sep, encoding=encoding)
    rows, rejects = split_corrupt(_load(name, lambda: reader.csv(path)))
    return tokens_to_null(rows, null_tokens), rejects


def read_csv_unnamed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    header_cell: str | None = None,
    name: str = "csv",
    sep: str = ";",
    encoding: str = LATIN1,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """Files read without a header; names go by position, other cell counts fail the job.

    A header row inside the data is known by its first cell and removed by
    content, since the rows of a distributed scan have no first one.
    """
    reader = _csv_reader(
        spark, columns, False, header=False, sep=sep, encoding=encoding, multiLine=multi_line
    )
    rows = _load(name, lambda: reader.csv(path))
    if header_cell is not None:
        rows = rows.filter(~F.col(columns[0]).eqNullSafe(header_cell))
    return tokens_to_null(rows, null_tokens)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(
    df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True
) -> None:
    df.write.mode("overwrite").options(
        header=header, sep=sep, encoding=encoding, escape='"'
    ).csv(path)


def tag(df: DataFrame, origin: str, column: str = "source") -> DataFrame:
    """Origin of every row as a constant column; a tag already there is replaced."""
    return df.withColumn(column, F.lit(origin))


def folder_name(run: str) -> str:
    """A run's name as part of a path; Spark reads ASCII escapes back, and no others."""
    return "".join(quote(c, safe="") if c.isascii() else c for c in run)


def _run_folder(run: str) -> str:
    return f"run={folder_name(run)}"


def write_run(df: DataFrame, path: str, run: str) -> None:
    """A run's rows as its own folder, replacing all it held, also by none."""
    df.write.mode("overwrite").parquet(f"{path}/{_run_folder(run)}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs' rows with ``run`` as the text it was given."""
    found = spark.read.parquet(path).schema
    fields = [StructField(f.name, StringType()) if f.name == "run" else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)
