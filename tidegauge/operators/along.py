"""What runs along a series, computed over parts of it: no series is one task's work. The names of a series are never null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions.vocab import SERIES

#: Milliseconds of a series, or numbers of arrival, that one window adds up.
CHUNK_MS = 30 * 24 * 3_600_000
CHUNK_SEQ = 1_000_000
#: Rows of a series that one window looks around from.
BLOCK_ROWS = 1 << 16
BY_TIME = ("t_ms", "seq")


def so_far(rows: DataFrame, sums: dict[str, Column], chunk: Column, order: list[str]) -> DataFrame:
    """Adds running sums, the row's own included, of the series in an order that chunks follow.

    Each chunk is a window of its own, and the totals of the chunks before make up for the rest: no series is one task's work.
    """
    own = rows.withColumns({"chunk": chunk} | {f"one_{n}": c for n, c in sums.items()})
    within = Window.partitionBy(*SERIES, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*SERIES).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = own.groupBy(*SERIES, "chunk").agg(*(F.sum(f"one_{n}").alias(f"all_{n}") for n in sums))
    offsets = totals.select(*SERIES, "chunk", *(F.coalesce(F.sum(f"all_{n}").over(before), F.lit(0)).alias(f"upto_{n}") for n in sums))
    joined = own.withColumns({n: F.sum(f"one_{n}").over(within) for n in sums}).join(offsets, [*SERIES, "chunk"])
    return joined.withColumns({n: F.col(n) + F.col(f"upto_{n}") for n in sums}).drop("chunk", *(f"one_{n}" for n in sums), *(f"upto_{n}" for n in sums))


def window(order: Sequence[str], first: int | None = None, last: int | None = None) -> WindowSpec:
    """What columns for around() are made over: the rows from `first` to `last` of a row, or all for lag and lead."""
    w = Window.partitionBy(*SERIES, "block").orderBy(*order)
    return w if first is None else w.rowsBetween(first, last)


def around(rows: DataFrame, columns: dict[str, Column], order: Sequence[str], before: int, after: int, block: int = BLOCK_ROWS) -> DataFrame:
    """Adds columns made over window(), which look at most so many rows before and after, and `place`, 1 for the first row of a series.

    Rows are numbered, and a series is cut into blocks of them. Rows near the edge of a block are copied to the one that
    looks at them, so that each block is a window of its own.
    """
    chunk = F.floor(F.col("t_ms") / CHUNK_MS) if order[0] == "t_ms" else F.floor(F.col(order[0]) / CHUNK_SEQ)
    placed = so_far(rows, {"place": F.lit(1).cast("long")}, chunk, list(order))

    def block_of(place: Column) -> Column:
        return F.floor(F.greatest(place - 1, F.lit(0)) / block)

    place = F.col("place")
    dealt = placed.withColumns({"home": block_of(place), "block": F.explode(F.sequence(block_of(place - after), block_of(place + before)))})
    return dealt.withColumns(columns).filter("block = home").drop("block", "home")
