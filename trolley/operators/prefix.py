"""Running aggregates per key that stay parallel when one key holds much of the data.

Ordinary keys use a window per key. A key with very many rows ("hot") is cut into blocks of its
order column: each block is reduced on its own, the few block totals are accumulated per key, and
every row combines its in-block value with its block's carry. The order column is unique, so a
block never holds more than ``BLOCK_ROWS`` rows of a key, whatever the key's size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.session import stored

BLOCK = "_block"
BLOCK_ROWS = 1 << 20
HOT_ROWS = 1_000_000
# Heavy keys: a table of one column, or a plain list; empty if there are none.
Keys = DataFrame | list | None


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> Keys:
    """The keys with at least ``min_rows`` rows, however many, as a table; ``[]`` without any."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    largest = sizes.filter(F.col("_rows") >= min_rows).select(key)
    return [] if largest.isEmpty() else stored(largest, "heavy")


def split_by_keys(df: DataFrame, key: str, keys: Keys) -> tuple[DataFrame, DataFrame]:
    """The rows of the heavy ``keys``, and all others.

    Neither side is forced to be broadcast. A key table small enough is, and no row moves; with a
    larger one the rows of a heavy key are many partitions' work by adaptive skew handling.
    """
    if isinstance(keys, list):
        keys = df.sparkSession.createDataFrame([(k,) for k in keys], df.select(key).schema)
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def in_blocks(
    df: DataFrame, key: str, order: str, hot: Keys, block_rows: int | None = None
) -> tuple[DataFrame | None, DataFrame]:
    """The rows of hot keys with their block, if there are any, and all others."""
    if hot is None or isinstance(hot, list) and not hot:
        return None, df
    heavy, others = split_by_keys(df, key, hot)
    return heavy.withColumn(BLOCK, F.floor(F.col(order) / F.lit(block_rows or BLOCK_ROWS))), others


def per_key(
    df: DataFrame,
    key: str,
    order: str,
    hot: Keys,
    step: Callable[[DataFrame], DataFrame],
    block_rows: int | None = None,
) -> DataFrame:
    """Apply ``step`` to ordinary keys as they are and to hot keys in blocks of ``order``."""
    blocks, others = in_blocks(df, key, order, hot, block_rows)
    if blocks is None:
        return step(others)
    return step(others).unionByName(step(blocks).drop(BLOCK))


@dataclass(frozen=True)
class Running:
    """One running aggregate: sum, max, min or last non-null of an expression up to a row."""

    kind: str
    value: str
    include_row: bool = True

    def _call(self, value: str) -> str:
        return f"last({value}, true)" if self.kind == "last" else f"{self.kind}({value})"

    def local(self, by: list[str], order: list[str]) -> str:
        end = "CURRENT ROW" if self.include_row else "1 PRECEDING"
        return (
            f"{self._call(self.value)} OVER (PARTITION BY {', '.join(by)} "
            f"ORDER BY {', '.join(order)} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"
        )

    def total(self, order: list[str]) -> str:
        """The block's contribution to everything after it."""
        if self.kind == "last":
            position = f"CASE WHEN ({self.value}) IS NOT NULL THEN struct({', '.join(order)}) END"
            return f"max_by({self.value}, {position})"
        return self._call(self.value)

    def carry(self, total: str, by: list[str]) -> str:
        return (
            f"{self._call(total)} OVER (PARTITION BY {', '.join(by)} ORDER BY {BLOCK} "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        )

    def combine(self, local: str, carry: str) -> str:
        return {
            # Null only where neither side has seen a value.
            "sum": f"coalesce({local} + {carry}, {local}, {carry})",
            "max": f"greatest({local}, {carry})",
            "min": f"least({local}, {carry})",
            "last": f"coalesce({local}, {carry})",
        }[self.kind]


@dataclass(frozen=True)
class Peak:
    """How far the running sum of ``value`` has been below zero: the largest -sum so far, taken
    at the rows where ``where`` holds."""

    value: str
    where: str = "true"
    include_row: bool = True

    def over(self, run: str) -> Running:
        return Running("max", f"CASE WHEN {self.where} THEN -{run} END", self.include_row)


def running_sum(value: str, include_row: bool = True) -> Running:
    return Running("sum", value, include_row)


def running_max(value: str, include_row: bool = True) -> Running:
    return Running("max", value, include_row)


def running_min(value: str, include_row: bool = True) -> Running:
    return Running("min", value, include_row)


def running_last(value: str, include_row: bool = True) -> Running:
    return Running("last", value, include_row)


@dataclass(frozen=True)
class Group:
    """Running aggregates that share their keys and order; ``by`` columns must not be null."""

    by: list[str]
    order: list[str]
    columns: dict[str, Running | Peak]

    def with_sums(self, df: DataFrame, by: list[str]) -> tuple[DataFrame, dict[str, Running]]:
        """The frame with the running sums peaks are taken of, and all columns as plain ones."""
        peaks = {n: c for n, c in self.columns.items() if isinstance(c, Peak)}
        sums = [
            f"{running_sum(peak.value).local(by, self.order)} AS _run_{name}"
            for name, peak in peaks.items()
        ]
        plain = {
            name: column.over(f"_run_{name}") if name in peaks else column
            for name, column in self.columns.items()
        }
        return (df.selectExpr("*", *sums) if sums else df), plain

    def add_windows(self, df: DataFrame) -> DataFrame:
        df, plain = self.with_sums(df, self.by)
        added = [f"{run.local(self.by, self.order)} AS {name}" for name, run in plain.items()]
        return df.selectExpr("*", *added).drop(*[c for c in df.columns if c.startswith("_run_")])

    def carries(self, rows: DataFrame) -> DataFrame:
        """Per block, what the key's earlier blocks add up to."""
        keys = [*self.by, BLOCK]
        rows, plain = self.with_sums(rows, keys)
        totals = [F.expr(r.total(self.order)).alias(f"_total_{n}") for n, r in plain.items()]
        peaks = {n: c for n, c in self.columns.items() if isinstance(c, Peak)}
        totals += [F.sum(F.expr(p.value)).alias(f"_moved_{n}") for n, p in peaks.items()]
        blocks = rows.groupBy(*keys).agg(*totals)
        if peaks:
            # A block's peak counts from the sum its key had reached when the block began.
            shift = Running("sum", "")
            blocks = blocks.selectExpr(
                "*",
                *[f"coalesce({shift.carry(f'_moved_{n}', self.by)}, 0) AS _shift_{n}"
                  for n in peaks],
            )
        total = {n: f"_total_{n} - _shift_{n}" if n in peaks else f"_total_{n}" for n in plain}
        return blocks.selectExpr(
            *keys,
            *[f"{run.carry(total[n], self.by)} AS _carry_{n}" for n, run in plain.items()],
            *[f"_shift_{n}" for n in peaks],
        )

    def add_blocks(self, df: DataFrame, carries: DataFrame) -> DataFrame:
        keys = [*self.by, BLOCK]
        rows, plain = self.with_sums(df, keys)
        local = rows.selectExpr(
            "*", *[f"{run.local(keys, self.order)} AS _local_{n}" for n, run in plain.items()]
        )
        here = {
            n: f"(_local_{n} - _shift_{n})" if isinstance(c, Peak) else f"_local_{n}"
            for n, c in self.columns.items()
        }
        return local.join(carries, keys, "left").selectExpr(
            *df.columns,
            *[f"{run.combine(here[n], f'_carry_{n}')} AS {n}" for n, run in plain.items()],
        )


def running_groups(df: DataFrame, *groups: Group) -> DataFrame:
    """Add several groups of running aggregates none of which reads another's result."""
    if BLOCK not in df.columns:
        for group in groups:
            df = group.add_windows(df)
        return df
    # The rows feed both the carries and the result: keep them once, on storage that survives.
    rows = result = stored(df, "blocks")
    for group in groups:
        result = group.add_blocks(result, group.carries(rows))
    return result


def running(
    df: DataFrame, by: list[str], order: list[str], **columns: Running | Peak
) -> DataFrame:
    """Add running aggregates per ``by`` in ``order``; null where no row has contributed."""
    return running_groups(df, Group(by, order, columns))
