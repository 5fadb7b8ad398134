"""Records of a paged JSON service.

``read_landed`` scans page files already on shared storage and is the way for
large volumes. ``paged_source`` reads the service itself: the rows are counted
first, the offsets are dealt out over the tasks, and every task reads its own
offsets to the end, however short the pages are that it gets.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from tributary.functions.numbers import safe_number
from tributary.sources.files import CORRUPT, _load, split_corrupt, text_schema

PAGE_SIZE = 50_000  # Fixed value: rows per page of the service.

# (offset, limit, where) to records, and (where) to the number of rows; ``where``
# is a list of (column, operator, text).
Where = list[tuple[str, str, str]]
Fetch = Callable[[int, int, Where], list[dict]]
CountRows = Callable[[Where], int]

# (key, key, limit) to the first records whose key is above the one and at most the
# other, in order of the key; and a number of parts to the keys that cut them.
FetchAfter = Callable[[object, object, int], list[dict]]
Quantiles = Callable[[int], list]

OPERATORS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
}


def land(df: DataFrame, path: str, page_size: int = PAGE_SIZE) -> None:
    """Rows as JSON-lines files of at most one page each."""
    df.write.mode("overwrite").option("maxRecordsPerFile", page_size).json(path)


def read_landed(
    spark: SparkSession, path: str, columns: Sequence[str], name: str = "pages"
) -> DataFrame:
    """Page files as one table of text columns; keys a record lacks are null.

    A line that is no record fails the job; ``split_landed`` keeps it apart.
    """
    reader = spark.read.schema(text_schema(columns)).option("mode", "FAILFAST")
    return _load(name, lambda: reader.json(path))


def split_landed(
    spark: SparkSession, path: str, columns: Sequence[str], name: str = "pages"
) -> tuple[DataFrame, DataFrame]:
    """Records of page files, and the lines that are none."""
    reader = spark.read.schema(text_schema([*columns, CORRUPT]))
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return split_corrupt(_load(name, lambda: reader.json(path)))


def from_year(year: Column, start: int) -> Column:
    """Rows from a year on, compared as numbers."""
    return safe_number(year) >= start


def drop_repeated(df: DataFrame, key: str) -> DataFrame:
    """One row per id, for pages that overlap: copies of a record are equal."""
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("row"))
    return kept.select(key, "row.*").select(*df.columns)


class OffsetRange(InputPartition):
    """Rows start .. stop - 1 of the service; ``last`` marks the end of all rows."""

    def __init__(self, start: int, stop: int, last: bool):
        super().__init__(start)
        self.start = start
        self.stop = stop
        self.last = last


class RowsChanged(RuntimeError):
    """The service has more or fewer rows than it counted."""


def walk(fetch: Fetch, part: OffsetRange, page_size: int, where: Where) -> Iterator[list[dict]]:
    """Pages that together hold exactly the rows of the range; short ones are read on from."""
    at = part.start
    while at < part.stop:
        records = fetch(at, min(page_size, part.stop - at), where)
        if not records:
            raise RowsChanged(f"no rows from offset {at} on, {part.stop} expected")
        yield records
        at += len(records)
    if part.last and fetch(at, 1, where):
        raise RowsChanged(f"more than the {part.stop} rows counted")


def cell(value) -> str | None:
    """A JSON value as text, in the form a scan of landed pages gives it."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def paged_source(
    fetch: Fetch, count: CountRows, name: str = "paged_json", push_filters: bool = False
) -> type[DataSource]:
    """Data source over ``fetch`` and ``count``; register it with the session.

    Options: ``columns`` (comma separated), ``pageSize``, ``pagesPerTask``. With
    ``push_filters`` simple comparisons of a column with a text are handed to the
    service; the session must allow that for such sources
    (``spark.sql.python.filterPushdown.enabled``). An error in ``fetch`` fails the task; Spark tries it again and then fails the
    job. Order the pages by a unique id in ``fetch``, or use ``drop_repeated``.
    """

    class PagedJson(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ", ".join(f"`{c}` string" for c in self.options["columns"].split(","))

        def reader(self, schema) -> DataSourceReader:
            kind = FilteringReader if push_filters else PagedReader
            return kind(
                schema.fieldNames(),
                int(self.options.get("pagesize", PAGE_SIZE)),
                int(self.options.get("pagespertask", 4)),
            )

    class PagedReader(DataSourceReader):
        def __init__(self, columns: list[str], page_size: int, pages: int):
            self.columns = columns
            self.page_size = page_size
            self.pages = pages
            self.where: Where = []

        def partitions(self):
            rows, step = count(self.where), self.page_size * self.pages
            starts = range(0, max(rows, 1), step)
            return [OffsetRange(s, min(s + step, rows), s + step >= rows) for s in starts]

        def read(self, partition):
            for records in walk(fetch, partition, self.page_size, self.where):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell(r.get(c)) for r in records], pa.string()) for c in self.columns],
                    names=self.columns,
                )

    class FilteringReader(PagedReader):
        def pushFilters(self, filters):
            for one in filters:
                text = OPERATORS.get(type(one))
                if text and isinstance(one.value, str) and len(one.attribute) == 1:
                    self.where.append((one.attribute[0], text, one.value))
                else:
                    yield one

    return PagedJson


class KeyRange(InputPartition):
    """Rows whose key is above ``low`` and at most ``high``; None is no end."""

    def __init__(self, low, high):
        super().__init__((low, high))
        self.low = low
        self.high = high


class KeysOutOfOrder(RuntimeError):
    """The service gave keys that do not rise, or lie outside of what was asked for."""


def walk_keys(fetch: FetchAfter, key: str, part: KeyRange, page_size: int) -> Iterator[list[dict]]:
    """Pages of a range, each from the last key of the one before on, until there is none."""
    last = part.low
    while records := fetch(last, part.high, page_size):
        for record in records:
            now = record[key]
            if (last is not None and now <= last) or (part.high is not None and now > part.high):
                raise KeysOutOfOrder(f"key {now!r} behind {last!r}, up to {part.high!r}")
            last = now
        yield records


def keyset_source(fetch: FetchAfter, quantiles: Quantiles, key: str, name: str = "keyset_json") -> type[DataSource]:
    """Data source over ``fetch`` and ``quantiles``; register it with the session.

    Options: ``columns`` (comma separated), ``pageSize``, ``tasks``. The ranges are cut
    at the service's own quantiles of a unique key, and a page is what follows the last
    key seen, not an offset. So rows that come or go while the service is read move no
    other row: a row that is there throughout occurs once, and none occurs twice.
    """

    class KeysetJson(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ", ".join(f"`{c}` string" for c in self.options["columns"].split(","))

        def reader(self, schema) -> DataSourceReader:
            return KeysetReader(
                schema.fieldNames(),
                int(self.options.get("pagesize", PAGE_SIZE)),
                int(self.options.get("tasks", 8)),
            )

    class KeysetReader(DataSourceReader):
        def __init__(self, columns: list[str], page_size: int, tasks: int):
            self.columns = columns
            self.page_size = page_size
            self.tasks = tasks

        def partitions(self):
            ends = sorted(set(quantiles(self.tasks)))
            return [KeyRange(*ends_) for ends_ in zip([None, *ends], [*ends, None], strict=True)]

        def read(self, partition):
            for records in walk_keys(fetch, key, partition, self.page_size):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cell(r.get(c)) for r in records], pa.string()) for c in self.columns],
                    names=self.columns,
                )

    return KeysetJson


def http_keyset(url: str, key: str, timeout: int = 120) -> tuple[FetchAfter, Quantiles]:
    """Rows behind a key, and quantiles of the keys, of a query service over HTTP.

    A quantile is the key of the row at an even share of the offsets; it only cuts the
    work, so it need not hold when the rows are read.
    """

    def ask(query: dict):
        from urllib.parse import urlencode
        from urllib.request import urlopen

        with urlopen(f"{url}?{urlencode(query)}", timeout=timeout) as reply:
            return json.load(reply)

    def fetch(low, high, limit: int) -> list[dict]:
        ends = [(key, ">", str(low))] if low is not None else []
        ends += [(key, "<=", str(high))] if high is not None else []
        return ask({"$limit": limit, "$order": key, **_query_text(ends)})

    def quantiles(parts: int) -> list:
        rows = int(ask({"$select": "count(*) AS n"})[0]["n"])
        found = []
        for part in range(1, parts):
            found += ask({"$select": key, "$order": key, "$limit": 1, "$offset": rows * part // parts})
        return [row[key] for row in found]

    return fetch, quantiles


def _query_text(where: Where) -> dict[str, str]:
    quoted = [f"{c} {op} '{text.replace(chr(39), chr(39) * 2)}'" for c, op, text in where]
    return {"$where": " AND ".join(quoted)} if quoted else {}


def http_pages(url: str, order: str = ":id", timeout: int = 120) -> tuple[Fetch, CountRows]:
    """Pages and row count of a limit/offset JSON service over HTTP; errors are raised."""

    def ask(query: dict):
        from urllib.parse import urlencode
        from urllib.request import urlopen

        with urlopen(f"{url}?{urlencode(query)}", timeout=timeout) as reply:
            return json.load(reply)

    def fetch(offset: int, limit: int, where: Where) -> list[dict]:
        return ask({"$limit": limit, "$offset": offset, "$order": order, **_query_text(where)})

    def count(where: Where) -> int:
        return int(ask({"$select": "count(*) AS n", **_query_text(where)})[0]["n"])

    return fetch, count
