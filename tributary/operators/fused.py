"""Many reports over one table from one scan of it.

A report is a set of aggregates and the rows made of them. The aggregates of all
reports are evaluated together, as one row that is stored; each report then makes its
rows of its own cells, and reads nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.clean import share_of
from tributary.session import shared_dir

Cells = Mapping[str, Column]


@dataclass(frozen=True)
class Report:
    """Named aggregates, and the rows (name to value, all of one shape) made of them."""

    cells: Cells
    rows: Callable[[Cells], Sequence[Cells]]


def condition_report(condition: Column, column: str) -> Report:
    """What ``clean.condition_report`` gives."""
    cells = {
        "n_rows": F.count("*"),
        "n_hits": F.count_if(condition),
        "n_null": F.count_if(F.col(column).isNull()),
        "pct_hits": share_of(condition),
        "min_value": F.min(column),
        "max_value": F.max(column),
    }
    return Report(cells, lambda found: [found])


def label_report(column: str, value: str) -> Report:
    """What ``profile.label_share`` gives."""
    hit = F.col(column) == F.lit(value)
    cells = {"n_rows": F.count("*"), "n_label": F.count_if(hit), "pct_label": share_of(hit)}
    return Report(cells, lambda found: [found])


def null_report(columns: Sequence[str]) -> Report:
    """What ``profile.null_profile`` gives."""
    cells = {"n_rows": F.count("*")} | {f"null {c}": F.count_if(F.col(c).isNull()) for c in columns}

    def rows(found: Cells) -> list[Cells]:
        share = {c: F.round(F.try_divide(found[f"null {c}"] * 100.0, found["n_rows"]), 4) for c in columns}
        return [
            {"column": F.lit(c), "n_rows": found["n_rows"], "n_null": found[f"null {c}"], "pct_null": share[c]}
            for c in columns
        ]

    return Report(cells, rows)


def extremes_report(columns: Sequence[str]) -> Report:
    """Least and largest value of every column, as text."""
    cells = {f"{end} {c}": of(c).cast("string") for c in columns for end, of in (("min", F.min), ("max", F.max))}
    return Report(
        cells,
        lambda found: [
            {"column": F.lit(c), "min_value": found[f"min {c}"], "max_value": found[f"max {c}"]} for c in columns
        ],
    )


def fused_row(df: DataFrame, reports: Mapping[str, Report]) -> DataFrame:
    """The aggregates of all reports as one row, from one scan; equal ones are computed once."""
    cells = [
        F.struct(*[cell.alias(name) for name, cell in report.cells.items()]).alias(f"r{i}")
        for i, report in enumerate(reports.values())
    ]
    return df.agg(*cells)


def fused(df: DataFrame, reports: Mapping[str, Report]) -> dict[str, DataFrame]:
    """Every report's rows; the table is read once for all of them."""
    shared_dir(df.sparkSession)
    row = fused_row(df, reports).checkpoint()
    out = {}
    for i, (name, report) in enumerate(reports.items()):
        found = {cell: F.col(f"r{i}").getField(cell) for cell in report.cells}
        rows = [F.struct(*[value.alias(c) for c, value in one.items()]) for one in report.rows(found)]
        out[name] = row.select(F.inline(F.array(*rows)))
    return out
