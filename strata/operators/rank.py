"""Global order without a single-task window.

``Window.orderBy(...)`` with no partition moves every row into one task. The
operators here get the same answers in a distributed way:

1. range-partition on the full sort key (score, then a unique tie-break key), so
   even a score value shared by a third of the rows is split across tasks;
2. sort within partitions, number rows and run their sums locally, while they are in order
   (an Arrow pass with a cumulative sum per batch: no second shuffle or sort);
3. cut lineage with a reliable checkpoint (range bounds come from sampling and
   could differ if the plan were recomputed after an executor loss);
4. per-partition totals (one row per partition, a proven bound) give offsets,
   broadcast back to every row.

Derived operators: exact positions, prefix sums, exact quantiles, average rank,
position and value deciles, per-class positions (stratified splits, capped
class samples).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import cut_lineage

_PART, _IDX = "_part", "_idx"


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _running(df: DataFrame, sums: Sequence[str]) -> DataFrame:
    """Adds ``_c_<name>`` for each ``_v_<name>``: the inclusive running sum over the rows of a partition, in
    their order. Nulls add nothing; integers run as longs, other numbers as doubles."""
    whole = {k: isinstance(df.schema[f"_v_{k}"].dataType, T.IntegralType) for k in sums}
    schema = T.StructType(df.schema.fields + [
        T.StructField(f"_c_{k}", T.LongType() if w else T.DoubleType()) for k, w in whole.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = {k: 0 if w else 0.0 for k, w in whole.items()}
        for b in batches:
            if b.num_rows == 0:
                continue
            columns = []
            for k, w in whole.items():
                values = b.column(f"_v_{k}").cast(pa.int64() if w else pa.float64()).fill_null(0)
                columns.append(pc.cumulative_sum(values, start=carry[k]))
                carry[k] = columns[-1][-1].as_py()
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=schema.names)

    return df.mapInArrow(run, schema)


def fixed_partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, for orders whose rows a fit reads: its sums of doubles depend on how
    rows lie, which adaptive execution must not decide."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ordered_partitions(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None,
                       sums: Sequence[str] = ()) -> DataFrame:
    """Rows range-partitioned and sorted on ``order``, with ``_part``, local index ``_idx`` and, for each of
    ``sums``, the local running sum; stored. Without ``partitions``, adjacent ranges that turn out small are read by
    one task (adaptive execution): a short table costs a few tasks and files, not ``spark.sql.shuffle.partitions``."""
    cols = _order_cols(order)
    r = (df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)).sortWithinPartitions(*cols)
    # monotonically_increasing_id = (partition id << 33) + record number within the partition
    part = F.spark_partition_id()
    r = r.withColumn(_PART, part).withColumn(
        _IDX, F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    )
    return cut_lineage(_running(r, sums) if sums else r)


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: dict[str, Column | str] | None = None,
    partitions: int | None = None,
    pos_col: str = "pos",
    totals: bool = True,
) -> DataFrame:
    """Adds ``pos`` (0-based position in ``order``) and, for each ``name -> value``,
    ``cum_<name>`` (inclusive running sum) and ``total_<name>``; ``total_rows`` too.

    ``order`` must be a total order (end it with a unique key) for results to be fixed.
    """
    sums = sums or {}
    vals = {f"_v_{k}": (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    r = ordered_partitions(df.withColumns(vals) if vals else df, order, partitions, list(sums))

    part_tot = r.groupBy(_PART).agg(
        F.count(F.lit(1)).alias("_rows"), *(F.sum(f"_v_{k}").alias(f"_s_{k}") for k in sums)
    )
    # one row per partition: an unpartitioned window here is bounded by the partition count
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offs = part_tot.select(
        _PART,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off_rows"),
        F.sum("_rows").over(everything).alias("total_rows"),
        *(F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0)).alias(f"_off_{k}") for k in sums),
        *(F.sum(f"_s_{k}").over(everything).alias(f"total_{k}") for k in sums),
    )
    out = r.join(F.broadcast(offs), _PART, "inner").withColumn(pos_col, F.col("_off_rows") + F.col(_IDX))
    if sums:
        out = out.withColumns({f"cum_{k}": F.col(f"_off_{k}") + F.col(f"_c_{k}") for k in sums})
    drop = [_PART, _IDX, "_off_rows", *vals, *(f"_off_{k}" for k in sums), *(f"_c_{k}" for k in sums)]
    if not totals:
        drop += ["total_rows", *(f"total_{k}" for k in sums)]
    return out.drop(*drop)


def positions(df: DataFrame, score: str, key: str, label: str | None = None, partitions: int | None = None) -> DataFrame:
    """``pos`` in order (score desc, key asc), ``total_rows``; with ``label``: ``cum_pos`` / ``total_pos``."""
    sums = {"pos": label} if label else None
    return prefix_sums(df, [F.col(score).desc(), F.col(key).asc()], sums, partitions)


def score_stats(df: DataFrame, score: str, label: str, partitions: int | None = None) -> DataFrame:
    """One row per distinct score (descending): ``n_s``, ``pos_s``, inclusive ``cum_n``/``cum_pos``
    (rows / positives with score >= s) and the totals. Equal scores collapse in a partial aggregate
    first, so a hot score value costs nothing extra."""
    dist = df.groupBy(score).agg(F.count(F.lit(1)).alias("n_s"), F.sum(label).cast("long").alias("pos_s"))
    return prefix_sums(dist, [F.col(score).desc()], {"n": "n_s", "pos": "pos_s"}, partitions).drop("pos")


def average_rank(df: DataFrame, score: str, out: str = "rank", partitions: int | None = None) -> DataFrame:
    """Descending average rank (ties share the mean of their positions), truncated to an integer."""
    stats = df.groupBy(score).agg(F.count(F.lit(1)).alias("_n_s"))
    stats = prefix_sums(stats, [F.col(score).desc()], {"n": "_n_s"}, partitions, totals=False).select(
        score, (F.col("cum_n") - F.col("_n_s") + (F.col("_n_s") + 1) / 2).cast("long").alias(out)
    )
    # join on the score: each score is one row on the right; a hot score on the left is
    # split by adaptive skew-join handling
    return df.join(stats, score, "left")


def position_decile(pos: Column, n: Column) -> Column:
    """Decile by position (0-based) among n sorted rows: equal-width bins of the index, 1 = first."""
    return F.when(n <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(F.lit(10) * pos / (n - 1)))).cast("int")


def quantile_positions(n: int, qs: Sequence[float]) -> dict[float, tuple[int, int, float]]:
    """For each q: ascending positions (lo, hi) and the interpolation weight (linear method)."""
    out = {}
    for q in qs:
        h = (n - 1) * q
        lo = int(h // 1)
        hi = min(lo + 1, n - 1)
        out[q] = (lo, hi, h - lo)
    return out


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], key: str | None = None,
                    partitions: int | None = None) -> list[float | None]:
    """Exact linear-interpolated quantiles of ``column`` (nulls ignored), distributed.

    Positions come from the range-partitioned order; only the <= 2*len(qs) values at the
    needed positions reach the driver.
    """
    vals = df.select(column, *([key] if key else [])).filter(F.col(column).isNotNull())
    order = [F.col(column).asc()] + ([F.col(key).asc()] if key else [])
    ranked = prefix_sums(vals, order, None, partitions)
    n_row = ranked.select("total_rows").limit(1).collect()
    if not n_row:
        return [None for _ in qs]
    n = n_row[0][0]
    need = quantile_positions(n, qs)
    wanted = sorted({p for lo, hi, _ in need.values() for p in (lo, hi)})
    at = dict(ranked.filter(F.col("pos").isin(wanted)).select("pos", column).collect())
    res = []
    for q in qs:
        lo, hi, t = need[q]
        a, b = float(at[lo]), float(at[hi])
        res.append(a + (b - a) * t)
    return res


def value_decile(score: Column, edges: Sequence[float]) -> Column:
    """Right-closed bins over 9 inner edges: 1 + number of edges strictly below the score (10 = best)."""
    expr = F.lit(1)
    for e in edges:
        expr = expr + F.when(score > F.lit(e), 1).otherwise(0)
    return expr.cast("int")


def class_positions(df: DataFrame, label: str, order: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """``pos_in_class`` (0-based, in ``order`` within each label value) and ``n_class``.

    Computed from one global order (label, then ``order``) minus the count of rows in lower
    classes, so a class holding most rows is still spread over many tasks.
    """
    ranked = prefix_sums(df, [F.col(label).asc(), *_order_cols(order)], None, partitions, totals=False)
    # counted on the stored rows, so the upstream plan is not evaluated a second time
    counts = ranked.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("n_class"))
    # one row per class value (null is a class, the first): bounded by the number of classes
    w = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("n_class").over(w), F.lit(0)))
    # broadcast, so that the rows stay where they are instead of meeting class by class in a task or two
    return (
        ranked.join(F.broadcast(counts), F.col(label).eqNullSafe(F.col("_class")), "inner")
        .withColumn("pos_in_class", F.col("pos") - F.col("_before"))
        .drop("_before", "pos", "_class")
    )
