"""Exact interpolated quantiles without gathering all values in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIRECT_ROWS = 1_000_000
LISTED_ROWS = 1_000_000
REACH, ACCURACY = 0.0005, 10_000


@dataclass
class _Bracket:
    """Where one order statistic must lie: `inside` rows in [low, high], `below` rows under it."""

    column: str
    rank: int
    below: int
    inside: int
    low: float = -math.inf
    high: float = math.inf
    value: float | None = None

    def cell(self):
        v = F.col(f"`{self.column}`")
        return F.when((v >= F.lit(self.low)) & (v <= F.lit(self.high)), v)

    def probes(self) -> list[float]:
        share = (self.rank - self.below + 0.5) / self.inside
        return sorted({min(max(share + s, 0.0), 1.0) for s in (-REACH, 0.0, REACH)})

    def narrow(self, cuts: list[tuple[float, int, int]]) -> None:
        """Shrink by cut values, each with the bracket's rows below it and up to it."""
        place = self.rank - self.below
        for value, under, upto in cuts:
            if under <= place < upto:
                self.value = value
                return
        lower = [(under, value) for value, under, _ in cuts if under <= place]
        upper = [(value, upto) for value, _, upto in cuts if upto > place]
        end = self.inside
        if upper:
            self.high, end = min(upper)
        start = 0
        if lower:
            start, self.low = max(lower)
        self.below, self.inside = self.below + start, end - start


def _settle(df: DataFrame, wanted: list[_Bracket], listed: int) -> None:
    """Fill in every bracket's value; two passes per round serve all columns together."""
    while True:
        wide = [b for b in wanted if b.value is None and b.inside > listed]
        if not wide:
            break
        sketch = df.agg(*[
            F.percentile_approx(b.cell(), b.probes(), ACCURACY).alias(f"p{i}") for i, b in enumerate(wide)
        ]).first()
        cuts = [sorted(set(sketch[f"p{i}"])) for i in range(len(wide))]
        counts = df.agg(*[
            F.count_if(test).alias(f"{side}{i}_{j}")
            for i, b in enumerate(wide) for j, c in enumerate(cuts[i])
            for side, test in (("u", b.cell() < F.lit(c)), ("t", b.cell() <= F.lit(c)))
        ]).first()
        for i, b in enumerate(wide):
            b.narrow([(c, counts[f"u{i}_{j}"], counts[f"t{i}_{j}"]) for j, c in enumerate(cuts[i])])
    small = [b for b in wanted if b.value is None]
    if not small:
        return
    cells = F.array(*[F.struct(F.lit(i).alias("b"), b.cell().alias("v")) for i, b in enumerate(small)])
    rows = (
        df.select(F.explode(cells).alias("c")).where(F.col("c.v").isNotNull())
        .groupBy("c.b", "c.v").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    for i, b in enumerate(small):
        seen = b.below
        for row in sorted((r for r in rows if r["b"] == i), key=lambda r: r["v"]):
            seen += row["n"]
            if b.rank < seen:
                b.value = row["v"]
                break


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], direct: int = DIRECT_ROWS
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of every column, NULL and NaN left out.

    Up to `direct` rows the built-in aggregate does it in one pass; its state grows with
    the distinct values, so beyond that each needed order statistic is bracketed by a
    bounded sketch and exact counts until few values are left to read.
    """
    clean = df.select(*[F.nullif(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    counts = clean.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first().asDict()
    if max(counts.values()) <= direct:
        row = clean.agg(*[F.percentile(F.col(f"`{c}`"), list(shares)).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(shares) for c in columns}
    places = {c: [share * (counts[c] - 1) for share in shares] for c in columns if counts[c]}
    wanted = {
        (c, rank): _Bracket(c, rank, 0, counts[c])
        for c, spots in places.items() for p in spots for rank in (math.floor(p), math.ceil(p))
    }
    _settle(clean, list(wanted.values()), max(min(direct, LISTED_ROWS) // len(wanted), 10))
    out: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    for c, spots in places.items():
        out[c] = []
        for p in spots:
            low, high = wanted[c, math.floor(p)].value, wanted[c, math.ceil(p)].value
            out[c].append(low + (high - low) * (p - math.floor(p)))
    return out
