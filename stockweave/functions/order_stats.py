"""Exact order statistics of a distributed column, without sorting it.

A rank is located by counting: the value range is cut into equal bins, the bins
are counted with map-side combine, and the search continues inside the bin that
holds the rank. Each round shuffles at most `BINS` counters per open range, so
neither a heavy value nor the size of the table reaches one task or the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 16384


@dataclass
class Rank:
    """Search for the `rank`-th smallest (1-based) `key` among the rows matching `where`.

    Searches with the same `scope` name look at the same rows and share counters.
    """

    key: str
    rank: int
    low: int
    high: int
    where: Column | None = None
    scope: str = ""
    below: int = 0  # rows of the scope that are smaller than `low`

    @property
    def bracket(self) -> tuple[str, str, int, int]:
        return (self.scope, self.key, self.low, self.high)

    def width(self, bins: int) -> int:
        return -(-(self.high - self.low + 1) // bins)


def locate(df: DataFrame, ranks: list[Rank], bins: int = BINS) -> list[Rank]:
    """Narrow every search to a single value; its `low` is then the answer.

    Keys are non-null longs. All open ranges are counted in one job per round, and
    log(range) / log(bins) rounds are needed.
    """
    while still_open := [r for r in ranks if r.low < r.high]:
        brackets = {r.bracket: r for r in still_open}
        ids = {bracket: i for i, bracket in enumerate(brackets)}
        marks, any_inside = [], F.lit(False)
        for bracket, r in brackets.items():
            inside = F.col(r.key).between(r.low, r.high)
            if r.where is not None:
                inside = inside & r.where
            any_inside = any_inside | inside
            slot = F.expr(f"({r.key} - ({r.low}L)) div {r.width(bins)}L")
            marks.append(
                F.when(inside, F.struct(F.lit(ids[bracket]).alias("id"), slot.alias("slot")))
            )
        counters = (
            df.filter(any_inside)  # after the first round few rows are inside any range
            .select(F.explode(F.array(*marks)).alias("mark"))
            .filter(F.col("mark").isNotNull())
            .groupBy("mark.id", "mark.slot")
            .count()
            .collect()  # at most `bins` counters per open range
        )
        histograms: dict[int, list[tuple[int, int]]] = {}
        for counter in counters:
            histograms.setdefault(counter["id"], []).append((counter["slot"], counter["count"]))
        for r in still_open:
            width, before = r.width(bins), r.below
            for slot, n in sorted(histograms.get(ids[r.bracket], [])):
                if before + n >= r.rank:
                    r.low += slot * width
                    r.high = min(r.high, r.low + width - 1)
                    r.below = before
                    break
                before += n
            else:
                raise ValueError(f"rank {r.rank} of {r.key} is outside its scope")
    return ranks


def percentile(df: DataFrame, key: str, fraction: float, rows: int, low: int, high: int) -> float:
    """Linearly interpolated percentile of a long column holding `rows` values."""
    position = (rows - 1) * fraction
    first = int(position)
    wanted = [Rank(key, first + 1, low, high), Rank(key, min(first + 2, rows), low, high)]
    left, right = (r.low for r in locate(df, wanted))
    return left + (right - left) * (position - first)
