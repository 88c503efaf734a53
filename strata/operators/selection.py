"""Exact percentiles by selection: a mergeable quantile sketch bounds each wanted position, and only the values
between its bounds are counted and ordered.

The sketch (``percentile_approx``, one aggregate over all columns) is off by at most ``1 / accuracy`` of the rows, so
the value at a position lies between the sketch's values some ranks below and above. A second aggregate counts the
values below the lower bound; those inside, a few thousandths of the rows, are counted by value and ordered. The counts
tell whether the bounds hold; a position that they miss is looked for between the column's least and greatest value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.rank import prefix_sums
from strata.session import Scratch

ACCURACY = 2000


def _bounds(narrow: DataFrame, wanted: dict[str, list[int]], size: dict[str, int], accuracy: int) -> dict:
    """{(column, position): (low, high)} from one aggregate of sketches: two ranks of its error to either side."""
    exprs, named = [], {}
    for k, (c, positions) in enumerate(wanted.items()):
        n = size[c]
        margin = 2.0 / accuracy + 1.0 / n
        shares = [s for p in positions for s in (max(0.0, (p + 1) / n - margin), min(1.0, (p + 1) / n + margin))]
        exprs += [F.percentile_approx(c, shares, accuracy).alias(f"q{k}"), F.min(c).alias(f"a{k}"), F.max(c).alias(f"b{k}")]
        named[c] = k
    row = narrow.agg(*exprs).first()  # two numbers a position
    out = {}
    for c, positions in wanted.items():
        q, low, high = (row[f"{x}{named[c]}"] for x in "qab")
        margin = 2.0 / accuracy + 1.0 / size[c]
        for i, p in enumerate(positions):
            share = (p + 1) / size[c]
            out[c, p] = (low if share - margin <= 0 else q[2 * i], high if share + margin >= 1 else q[2 * i + 1])
    return out


def value_counts(narrow: DataFrame, bounds: dict) -> DataFrame:
    """``(k, value, n)``: rows of each value between the bounds of the k-th position. Equal values are counted in each
    task first, so a value that fills a column is one row from there on."""
    pairs = F.array(*(F.when(F.col(c).between(F.lit(lo), F.lit(hi)), F.struct(F.lit(k).alias("k"), F.col(c).alias("value")))
                      for k, ((c, _), (lo, hi)) in enumerate(bounds.items())))
    return (narrow.select(F.explode(F.array_compact(pairs)).alias("p")).select("p.k", "p.value").groupBy("k", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def _inside(narrow: DataFrame, bounds: dict) -> dict:
    """{(column, position): value} for the positions whose bounds hold."""
    keys = list(bounds)
    below = narrow.agg(*(F.count_if(F.col(c) < F.lit(lo)).alias(f"n{k}") for k, ((c, _), (lo, _)) in enumerate(bounds.items())))
    before = list(below.first())  # one number a position
    ranked = prefix_sums(value_counts(narrow, bounds), [F.col("k").asc(), F.col("value").asc()], {"n": "n"}, totals=False)
    first = ranked.groupBy("k").agg(F.min(F.col("cum_n") - F.col("n")).alias("base"))  # a row a position
    offset = F.element_at(F.array(*(F.lit(p - b) for (_, p), b in zip(keys, before, strict=True))), F.col("k") + 1)
    at = F.col("cum_n") - F.col("base")
    hit = ranked.join(first, "k").where((offset >= at - F.col("n")) & (offset < at)).select("k", "value")
    return {keys[r["k"]]: r["value"] for r in hit.collect()}  # at most a number a position


def values_at(df: DataFrame, wanted: dict[str, Sequence[float]], accuracy: int = ACCURACY) -> dict[str, dict[float, float | None]]:
    """For each column and q the exact linear percentile (nulls ignored; None for a column without a value).

    ``df`` is read once: the columns are stored as doubles for the passes and removed at the end."""
    columns = list(wanted)
    with Scratch(df.sparkSession) as scratch:
        narrow = scratch.store(df.select(*(F.col(c).cast("double").alias(c) for c in columns)), "selection")
        counted = narrow.agg(*(F.count(c).alias(f"n{k}") for k, c in enumerate(columns))).first()
        size = {c: counted[f"n{k}"] for k, c in enumerate(columns)}
        place = {(c, q): ((size[c] - 1) * float(q)) for c in columns if size[c] for q in wanted[c]}
        need = {c: sorted({p for (x, _), h in place.items() if x == c for p in (int(h), min(int(h) + 1, size[c] - 1))})
                for c in columns if size[c]}
        found: dict = {}
        if need:
            bounds = _bounds(narrow, need, size, accuracy)
            # equal bounds: the position's value is known; the others are counted
            found = {k: lo for k, (lo, hi) in bounds.items() if lo == hi}
            rest = {k: b for k, b in bounds.items() if k not in found}
            if rest:
                found |= _inside(narrow, rest)
            missed = [k for k in bounds if k not in found]
            if missed:
                ends = narrow.agg(*(f(c).alias(f"{f.__name__}_{i}") for i, (c, _) in enumerate(missed) for f in (F.min, F.max))).first()
                found |= _inside(narrow, {k: (ends[2 * i], ends[2 * i + 1]) for i, k in enumerate(missed)})
    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(wanted[c]) for c in columns}
    for (c, q), h in place.items():
        lo, hi = found[c, int(h)], found[c, min(int(h) + 1, size[c] - 1)]
        out[c][q] = lo + (hi - lo) * (h - int(h))
    return out
