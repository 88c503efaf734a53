"""Border over-sampling of the positive class: new positives between positives near the border and their neighbours.

Nearest neighbours come from a forest of balanced projection trees. Every tree orders the rows by a random projection
into equal blocks, and each block by a second one into leaves of at most ``leaf`` rows: leaves are cut by position, so
none is larger, whatever the values. A query is compared with the rows of its leaf in every tree, inside the task that
holds the leaf: every row is sent once a tree, a leaf sends back at most ``m`` rows a query, and no pair is written. Up to
``leaf`` rows the answer is exact; beyond that it is approximate, and ``recall`` measures it against brute force.

Joins with rows are sort-merge joins by hint: Spark takes an array for one value, so by its own estimate it would broadcast
all rows through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.prep import hash_order
from strata.operators.rank import class_positions, prefix_sums
from strata.session import store

SEED = 42


def vectors(df: DataFrame, key: str, y: str, features: Sequence[str], scale: bool = True) -> DataFrame:
    """``(key, y, vec)`` with the features as doubles (null: 0), divided by their standard deviations if ``scale``."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    if scale:
        row = df.agg(*(F.stddev_pop(v) for v in values)).first()  # one number a feature
        values = [v / F.lit(float(s)) if s else v for v, s in zip(values, row, strict=True)]
    return df.select(F.col(key).alias("key"), F.col(y).alias("y"), F.array(*values).alias("vec"))


def _dot(vec: Column, direction: np.ndarray) -> Column:
    return F.aggregate(F.zip_with(vec, F.array(*(F.lit(float(x)) for x in direction)), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def leaves(rows: DataFrame, width: int, n: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """``(key, tree, leaf)`` of every row: two global orders for all trees together."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(trees, 2, width))
    spread = F.array(*(F.struct(F.lit(t).alias("tree"), _dot(F.col("vec"), d[0]).alias("a"), _dot(F.col("vec"), d[1]).alias("b"))
                       for t, d in enumerate(directions)))
    long_ = rows.select("key", F.explode(spread).alias("p")).select("key", "p.tree", "p.a", "p.b")
    blocks = max(1, int(np.sqrt(-(-n // leaf))))
    first = class_positions(long_, "tree", [F.col("a").asc(), F.col("key").asc()])
    block = F.floor(F.col("pos_in_class") * blocks / F.col("n_class"))
    first = first.select("key", "b", (F.col("tree") * blocks + block).alias("part"))
    second = class_positions(first, "part", [F.col("b").asc(), F.col("key").asc()])
    # a block's rows are dealt out to equal leaves of at most ``leaf``
    count = F.ceil(F.col("n_class") / leaf)
    return second.select("key", F.floor(F.col("part") / blocks).cast("int").alias("tree"),
                         (F.col("part") * n + F.floor(F.col("pos_in_class") * count / F.col("n_class"))).alias("leaf"))


def neighbours(rows: DataFrame, queries: DataFrame, width: int, m: int, trees: int = 8, leaf: int = 256,
               seed: int = SEED) -> DataFrame:
    """``(query, neighbour, distance, place)``: the ``m`` nearest rows (``key``, ``vec``) of each query, which is one of
    the rows and not its own neighbour; ties by key. ``queries`` holds keys. A query gets fewer only if its leaves
    hold fewer rows. Stored."""
    # a number a row: rows that share a key are told apart, and a pair that several trees find counts once
    rows = store(rows.select("key", "vec").withColumn("row", F.monotonically_increasing_id()), "neighbour-rows")
    n = rows.count()
    placed = store(leaves(rows, width, n, trees if n > leaf else 1, leaf, seed), "neighbour-leaves")
    asked = queries.select("key").distinct().withColumn("asked", F.lit(True))
    members = placed.distinct().join(asked.hint("merge"), "key", "left").join(rows.hint("merge"), "key").select("tree", "leaf", "key", "row", F.coalesce("asked", F.lit(False)).alias("asked"), "vec")
    kind = rows.schema["key"].dataType.simpleString()
    found = members.groupBy("tree", "leaf").applyInArrow(_nearest(m), f"query {kind}, distance double, neighbour {kind}, row long, other long")
    # at most trees * m pairs a query
    best = found.groupBy("query").agg(F.slice(F.sort_array(F.collect_set(F.struct("distance", "neighbour", "row", "other"))), 1, m).alias("best"))
    ranked = best.select("query", F.posexplode("best").alias("place", "b"))
    return store(ranked.select("query", "b.neighbour", "b.distance", (F.col("place") + 1).alias("place")), "neighbours")


def _nearest(m: int, block: int = 256):
    """Gives the ``m`` nearest rows of a leaf for each of its queries, by distance, then key. The squares are added
    feature by feature, in the order of the vector; only ``block`` queries are compared at a time."""
    def nearest(leaf: pa.Table) -> pa.Table:
        row, asked = (leaf.column(c).to_numpy() for c in ("row", "asked"))
        queries = np.flatnonzero(asked)
        keys = leaf.column("key").combine_chunks()
        picked = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        if len(queries):
            _, code = np.unique(keys.to_numpy(zero_copy_only=False), return_inverse=True)
            x = np.concatenate([c.flatten().to_numpy() for c in leaf.column("vec").chunks]).reshape(len(row), -1)
            for own in (queries[i:i + block] for i in range(0, len(queries), block)):
                square = np.zeros((len(own), len(row)))
                for f in range(x.shape[1]):
                    apart = x[own, f][:, None] - x[None, :, f]
                    square += apart * apart
                distance, itself = np.sqrt(square), code[own][:, None] == code[None, :]
                order = np.lexsort((np.broadcast_to(row, itself.shape), np.broadcast_to(code, itself.shape), distance, itself))[:, :m]
                at, which = np.nonzero(~np.take_along_axis(itself, order, axis=1))
                near = order[at, which]
                for into, found in zip(picked, (own[at], near, distance[at, near]), strict=True):
                    into.append(found)
        own, near, distance = map(np.concatenate, picked)
        return pa.table({"query": keys.take(pa.array(own)), "distance": distance, "neighbour": keys.take(pa.array(near)),
                         "row": row[own], "other": row[near]})

    return nearest


def recall(rows: DataFrame, found: DataFrame, queries: Sequence, m: int) -> float:
    """Share of the true ``m`` nearest rows of some given queries that ``found`` holds. Each of the queries, which are
    part of the plan as literals, is compared with all rows."""
    share = []
    for q in queries:
        own = rows.where(F.col("key") == F.lit(q)).first()["vec"]
        square = F.aggregate(F.zip_with("vec", F.array(*map(F.lit, own)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        limit = [r[0] for r in rows.where(F.col("key") != F.lit(q)).select(F.sqrt(square).alias("d")).orderBy("d").limit(m).collect()]
        got = [r["distance"] for r in found.where(F.col("query") == F.lit(q)).collect()]
        share.append(sum(d <= limit[-1] + 1e-9 for d in got) / len(limit) if limit else 1.0)
    return float(np.mean(share))


def border(rows: DataFrame, near: DataFrame, m: int) -> DataFrame:
    """Keys of the queries near the border: at least half of their ``m`` neighbours are negative, but not all."""
    labels = rows.select(F.col("key").alias("neighbour"), F.col("y").alias("label"))
    per = near.join(labels.hint("merge"), "neighbour").groupBy("query").agg(F.count_if(F.col("label") != 1).alias("negative"))
    return per.where((2 * F.col("negative") >= m) & (F.col("negative") < m)).select(F.col("query").alias("key"))


def oversample(df: DataFrame, key: str, y: str, features: Sequence[str], positives: int, *, k: int = 5, m: int = 10,
               trees: int = 8, leaf: int = 256, scale: bool = True, seed: int = SEED) -> DataFrame:
    """``df``'s key, label and features, and new positives so that there are ``positives`` in all (none if there are as
    many already): ``synthetic``, and of new rows ``parent`` and ``neighbour``, between which they lie (their key is null).

    Every positive at the border (see ``border``) is a parent of as many new rows as the others, but for one; each new
    row goes a pseudo-random part of the way to one of the parent's ``k`` nearest positives. Both are fixed by hashes
    of the parent's key, so a lost task makes the same rows again. Without a border, or with a single positive, there
    is no new row. Null features count as 0; rows without a label are kept and are neither class.
    """
    own = df.select(key, y, *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features))
    kept = own.select("*", F.lit(False).alias("synthetic"), F.lit(None).cast(df.schema[key].dataType).alias("parent"),
                      F.lit(None).cast(df.schema[key].dataType).alias("neighbour"))
    rows = store(vectors(df.where(F.col(y).isNotNull()), key, y, features, scale), "smote-rows")
    minority = rows.where("y = 1")
    wanted = positives - minority.count()
    if wanted <= 0:
        return kept
    width = len(features)
    edge = store(border(rows, neighbours(rows, minority, width, m, trees, leaf, seed), m), "smote-border")
    n = edge.count()
    if n == 0:
        return kept
    near = neighbours(minority, edge, width, k, trees, leaf, seed + 1)
    # one list of at most k neighbours a parent
    parents = near.groupBy(F.col("query").alias("key")).agg(F.sort_array(F.collect_list(F.struct("place", "neighbour"))).alias("near"))
    n = parents.count()
    if n == 0:
        return kept
    ordered = prefix_sums(parents, [hash_order("key", seed), F.col("key")], None, totals=False)
    times = F.lit(wanted // n) + F.when(F.col("pos") < wanted % n, 1).otherwise(0)
    made = ordered.withColumn("i", F.explode(F.sequence(F.lit(1), times))) if wanted >= n else ordered.where(F.col("pos") < wanted).withColumn("i", F.lit(1))
    h = F.xxhash64(F.col("key"), F.col("i"), F.lit(seed))
    # 53 bits of the hash: a number in [0, 1)
    part = F.shiftrightunsigned(F.xxhash64(h, F.lit("part")), 11).cast("double") / float(1 << 53)
    made = made.select(F.col("key").alias("parent"), F.get("near", F.pmod(h, F.size("near")).cast("int"))["neighbour"].alias("neighbour"), part.alias("part"))
    ends = lambda name: own.select(F.col(key).alias(name), F.array(*features).alias(f"_{name}")).hint("merge")
    made = made.join(ends("parent"), "parent").join(ends("neighbour"), "neighbour")
    new = [(F.get("_parent", i) + F.col("part") * (F.get("_neighbour", i) - F.get("_parent", i))).alias(c) for i, c in enumerate(features)]
    made = made.select(F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(1).cast(df.schema[y].dataType).alias(y), *new,
                       F.lit(True).alias("synthetic"), "parent", "neighbour")
    return kept.unionByName(made)
