"""Windows along an order for keys of any size: what a row takes from the rows before or after it, by pieces.

A plain window brings all rows of a key into one task. Here keys with more than ``PIECE_ROWS`` rows are dealt into pieces by
ranges of (key, order); each piece is a window of its own and written, its first and last row tell its edge values and sums, and a
window over these few rows carries them on to the pieces after (or before). Keys below the bound take the plain window. Both give
the same rows. Rows that agree in the whole order stay in one piece; their order among themselves is undefined, as in any window.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sondage.scratch import written

from .quantiles import key_of

#: Rows of a key from which on it is cut into pieces, and about the rows of a piece.
PIECE_ROWS = 1_000_000
#: Of a smaller bound, about the most pieces, as long as they don't hold more than ``PIECE_ROWS`` rows then.
PIECES = 512


@dataclass(frozen=True)
class Layout:
    """A table by keys, in an order: ``cold`` rows of keys that one task can hold, and ``hot`` rows with their ``_piece``."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cold: DataFrame
    hot: DataFrame | None

    def map(self, f: Callable[[DataFrame], DataFrame]) -> Layout:
        """``f``, which works row by row, on both parts."""
        return replace(self, cold=f(self.cold), hot=self.hot and f(self.hot))

    def table(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot.drop("_piece"))

    def windowed(self, lag: dict[str, Column] | None = None, total: dict[str, Column] | None = None, last: dict[str, Column] | None = None, ahead: dict[str, Column] | None = None) -> Layout:
        """New columns: ``lag`` the row before's value, ``last`` the last value that isn't null up to the row, ``ahead`` the first
        from the row on, ``total`` the sum up to the row of a value that may be made of the other new columns of ``lag``."""
        lag, total, last, ahead = lag or {}, total or {}, last or {}, ahead or {}
        w = Window.partitionBy(*self.keys).orderBy(*self.order)
        cold = self.cold.withColumns(_plain(w, lag, last, ahead)).withColumns({n: F.sum(v).over(_upto(w)) for n, v in total.items()})
        return replace(self, cold=cold, hot=self.hot and self._by_pieces(lag, total, last, ahead))

    def _by_pieces(self, lag: dict, total: dict, last: dict, ahead: dict) -> DataFrame:
        """Each piece by itself, written with marks on its first and last row; what these rows tell reaches the pieces after (or
        before) as one row a piece. A piece's own sums leave its first row out, whose value needs the row before."""
        w = Window.partitionBy("_piece", *self.keys).orderBy(*self.order)
        marks = {"_scan_first": F.row_number().over(w) == 1, "_scan_end": F.lead(F.lit(1)).over(w).isNull()}
        first, end = F.col("_scan_first"), F.col("_scan_end")
        own = self.hot.withColumns(_plain(w, lag, last, ahead) | marks)
        own = written(own.withColumns({n: F.sum(F.when(~first, v)).over(_upto(w)) for n, v in total.items()}), "pieces").withColumn("_scan_k", key_of(list(self.keys)))
        by = Window.partitionBy("_scan_k").orderBy("_piece", first.desc())
        before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
        edges = own.where(first | end).withColumns({n: F.when(first, F.lag(v).over(by)).otherwise(F.col(n)) for n, v in lag.items()})
        sums = {f"_scan_{n}": _plus(F.sum(F.when(first, v)).over(_upto(by)), F.sum(F.when(end, F.col(n))).over(_upto(by))) for n, v in total.items()}
        reach = {f"_scan_{n}": F.last(n, True).over(before) for n in last} | {f"_scan_{n}": F.first(n, True).over(after) for n in ahead}
        carry = edges.withColumns(sums | reach | {f"_scan_{n}": F.col(n) for n in lag}).where(first)
        carry = carry.select("_scan_k", "_piece", *[f"_scan_{n}" for n in (*lag, *total, *last, *ahead)])  # a row for a piece of a key
        kinds = {f.name: f.dataType for f in own.schema}
        merged = {n: F.when(first, F.col(f"_scan_{n}")).otherwise(F.col(n)) for n in lag} | {n: _plus(F.col(n), F.col(f"_scan_{n}")).cast(kinds[n]) for n in total}
        merged |= {n: F.coalesce(n, f"_scan_{n}") for n in (*last, *ahead)}
        out = own.join(F.broadcast(carry), ["_scan_k", "_piece"], "left").withColumns(merged)
        return out.select(*self.hot.columns, *[n for n in (*lag, *last, *ahead, *total) if n not in self.hot.columns])


def _upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _plus(a: Column, b: Column) -> Column:
    """The sum of those that aren't null."""
    return F.coalesce(a + b, a, b)


def _plain(w: WindowSpec, lag: dict, last: dict, ahead: dict) -> dict[str, Column]:
    on = w.rowsBetween(0, Window.unboundedFollowing)
    return {n: F.lag(v).over(w) for n, v in lag.items()} | {n: F.last(v, True).over(_upto(w)) for n, v in last.items()} | {n: F.first(v, True).over(on) for n, v in ahead.items()}


def layout(df: DataFrame, keys: list[str], order: list[str], piece_rows: int | None = None) -> Layout:
    """The table's rows by keys (null is a key like others). Keys are counted first, with map-side combine; where none has more
    than ``piece_rows`` (``PIECE_ROWS``) rows, nothing else changes. Pieces hold about so many rows; of a large table more, see ``PIECES``."""
    most = piece_rows or PIECE_ROWS
    sizes = df.groupBy(key_of(list(keys)).alias("_scan_k")).agg(F.count(F.lit(1)).alias("_scan_n")).where(F.col("_scan_n") > most)
    hot = written(sizes, "hot-keys")  # at most a row for PIECE_ROWS rows
    n = hot.agg(F.sum("_scan_n")).first()[0]
    if not n:
        return Layout(tuple(keys), tuple(order), df, None)
    rows, found = df.withColumn("_scan_k", key_of(list(keys))), hot.select("_scan_k")
    piece = max(most, min(PIECE_ROWS, n // PIECES))
    dealt = rows.join(found, "_scan_k", "left_semi").drop("_scan_k").repartitionByRange(-(-n // piece) + 1, *keys, *order)
    return Layout(tuple(keys), tuple(order), rows.join(found, "_scan_k", "left_anti").drop("_scan_k"), dealt.withColumn("_piece", F.spark_partition_id()))
