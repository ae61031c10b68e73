"""Exact quantiles of wide columns, by narrowing the range in which each rank lies."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Values of one range that the driver sorts at last, at most.
FEW = 100_000
# A sketch's ranks are off by at most one part in so many.
ACCURACY = 10_000


@dataclass
class Range:
    """An open range of values that holds rank ``rank`` of a column; ``below`` values come before it."""

    column: str
    rank: int
    low: float | None
    high: float | None
    below: int
    inside: int
    value: float | None = None

    def holds(self) -> Column:
        x, within = F.col(self.column), F.col(self.column).isNotNull()
        within = within if self.low is None else within & (x > self.low)
        return within if self.high is None else within & (x < self.high)

    def narrowed(self, low: float, high: float, counts: tuple[int, int, int, int]) -> None:
        """Move to the part that holds the rank; ``counts`` of values under and up to ``low``, and ``high``."""
        under_low, upto_low, under_high, upto_high = (self.below + c for c in counts)
        if self.rank < under_low:
            self.high, self.inside = low, under_low - self.below
        elif self.rank < upto_low:
            self.value = low
        elif self.rank < under_high:
            self.low, self.high, self.below, self.inside = low, high, upto_low, under_high - upto_low
        elif self.rank < upto_high:
            self.value = high
        else:
            self.low, self.below, self.inside = high, upto_high, self.below + self.inside - upto_high


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as doubles, ``c0`` and so on; NaN counts as missing."""
    doubles = [F.col(f"`{c}`").cast("double") for c in columns]
    return df.select(*[F.when(~F.isnan(d), d).alias(f"c{i}") for i, d in enumerate(doubles)])


def _narrow(numbers: DataFrame, ranges: list[Range], accuracy: int) -> None:
    """One round: a sketch of every range proposes two values around the rank, and counts tell where it lies."""
    sketches = []
    for i, r in enumerate(ranges):
        at, slack = (r.rank - r.below + 0.5) / r.inside, 2 / accuracy
        wanted = F.array(F.lit(max(0.0, at - slack)), F.lit(min(1.0, at + slack)))
        sketches.append(F.percentile_approx(F.when(r.holds(), F.col(r.column)), wanted, accuracy).alias(f"r{i}"))
    bounds = [list(b) for b in numbers.agg(*sketches).first()]
    counts = []
    for i, (r, (low, high)) in enumerate(zip(ranges, bounds)):
        x = F.col(r.column)
        tests = (x < low, x <= low, x < high, x <= high)
        counts += [F.count_if(r.holds() & t).alias(f"n{i}_{j}") for j, t in enumerate(tests)]
    found = numbers.agg(*counts).first()
    for i, (r, (low, high)) in enumerate(zip(ranges, bounds)):
        r.narrowed(low, high, tuple(found[4 * i:4 * i + 4]))


def _finish(numbers: DataFrame, ranges: list[Range]) -> None:
    """Values of ranges that hold few: one job, a row for each distinct value of each range."""
    spots = sorted({(r.column, r.low, r.high) for r in ranges}, key=repr)
    first = {spot: next(r for r in ranges if (r.column, r.low, r.high) == spot) for spot in spots}
    pieces = [F.when(r.holds(), F.struct(F.lit(i).alias("spot"), F.col(r.column).alias("x"))) for i, r in enumerate(first.values())]
    rows = numbers.select(F.explode(F.array_compact(F.array(*pieces))).alias("v")).groupBy("v.spot", "v.x").agg(F.count(F.lit(1)).alias("n")).collect()
    for i, spot in enumerate(spots):
        values = sorted((row.x, row.n) for row in rows if row.spot == i)
        for r in ranges:
            if (r.column, r.low, r.high) == spot:
                left = r.rank - r.below
                for x, n in values:
                    if left < n:
                        r.value = x
                        break
                    left -= n


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], few: int = FEW, accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """For each column its quantiles, interpolated between neighbouring ranks as ``percentile`` does.

    ``percentile`` gathers every distinct value of a column in one task. Here a mergeable sketch
    (``percentile_approx``, of bounded size in any task) proposes a range around each rank, and counts
    show exactly where the rank lies; the range is narrowed until it holds ``few`` values at most, which the driver
    sorts. A round reads the table twice, for all columns and ranks at once, and leaves some four parts in
    ``accuracy`` of the values: 10^12 rows take three rounds. A range always loses its ends, so
    any distribution, ties and infinities included, comes to an end. Nulls and NaN are left out; a
    column without values gives nulls. Values are taken as doubles.
    """
    numbers = _numbers(df, columns)
    sizes = numbers.agg(*[F.count(c) for c in numbers.columns]).first()
    ranks = {}
    for name, n in zip(numbers.columns, sizes):
        for p in probabilities if n else ():
            for rank in (math.floor((n - 1) * p), math.ceil((n - 1) * p)):
                ranks[name, rank] = Range(name, rank, None, None, 0, n)
    while True:
        wide = [r for r in ranks.values() if r.value is None and r.inside > few]
        if not wide:
            break
        _narrow(numbers, wide, accuracy)
    left = [r for r in ranks.values() if r.value is None]
    if left:
        _finish(numbers, left)

    def quantile(name: str, n: int, p: float) -> float | None:
        if not n:
            return None
        at = (n - 1) * p
        low, high = ranks[name, math.floor(at)].value, ranks[name, math.ceil(at)].value
        return low if low == high else low + (at - math.floor(at)) * (high - low)

    return {c: [quantile(name, n, p) for p in probabilities] for c, name, n in zip(columns, numbers.columns, sizes)}


def inside_fences(df: DataFrame, columns: list[str], rate: float = 1.5, few: int = FEW) -> DataFrame:
    """Rows inside the fence of every one of the columns, ``rate`` times the range of quartiles away; one pass of quantiles for all."""
    for column, (first, third) in exact_quantiles(df, columns, [0.25, 0.75], few).items():
        reach = ((third or 0.0) - (first or 0.0)) * rate
        df = df.where((F.col(f"`{column}`") >= first - reach) & (F.col(f"`{column}`") <= third + reach)) if first is not None else df.where(F.lit(False))
    return df
