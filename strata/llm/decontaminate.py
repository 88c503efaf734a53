"""Benchmark decontamination by a prefix-filtered set join (operator 9), in DataFrame functions alone.

Items are cut into windows of ``window`` consecutive words (a shorter item is one window), windows into
shingles of five words. Documents are exploded into shingles and joined with the items' shingles; only
the matches ``M(document, position, shingle)`` are stored. Then

1. shingles are ordered by their frequency in the documents, and a window's rarest one is its prefix: to
   hold the whole window a document must hold that token (containment 1 needs a prefix of one token);
   a window with a shingle that no document holds is dropped;
2. prefixes are joined with ``M``: a match at ``pos`` of the window's shingle ``j`` places the window at
   ``pos - j``, which must lie inside the document (positional and length bounds);
3. each candidate is verified over the item-sized window: all its shingles must be matched at their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_list(text: Column) -> Column:
    """A-Z lower-cased, maximal runs of characters outside ``_NOT_WORD``; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _NOT_WORD, -1), "")


def shingle_hashes(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, by position."""
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(0), F.size(words) - size),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])))


def item_windows(items: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``(item, win, words, len)`` for every window of every item; ``win`` is the window's text."""
    w = items.select(F.col(item_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("w"))
    w = w.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = w.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return cut.select("item", F.array_join("words", " ").alias("win"), "words", F.size("words").alias("len")).distinct()


def _matches(docs: DataFrame, shingles: DataFrame, size: int) -> DataFrame:
    """``M`` for shingles of ``size`` words. ``docs``: doc, version, words."""
    mine, _ = common.small_side(shingles.where(F.col("size") == size).select("h"))
    rows = docs.select("doc", "version", F.size("words").alias("n"),
                       F.posexplode(shingle_hashes(F.col("words"), size)).alias("pos", "h"))
    return rows.join(mine, "h").withColumn("size", F.lit(size))


def occurrences(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text", window: int = 10,
                shingle: int = 5) -> tuple[DataFrame, DataFrame]:
    """(occurrences ``doc, version, win, start, len``; windows ``item, win``). ``version`` (the text's hash)
    tells rows that share an id apart."""
    wins = common.store(item_windows(items, item_col, item_text_col, window), "item-windows")
    size = F.least(F.lit(shingle), F.col("len"))
    distinct = wins.select("win", "words", "len").distinct()
    parts = common.store(
        distinct.withColumn("size", size).select(
            "win", "len", "size", F.posexplode(F.transform(
                F.sequence(F.lit(1), F.col("len") - F.col("size") + 1),
                lambda i: F.xxhash64(F.slice("words", i, F.col("size"))))).alias("j", "h")), "window-shingles")
    shingles = common.store(parts.select("h", "size").distinct(), "item-shingles")
    sizes = sorted(r[0] for r in shingles.select("size").distinct().collect())  # at most ``shingle`` numbers

    base = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("version"),
                       word_list(F.col(text_col)).alias("words"))
    empty = base.sparkSession.createDataFrame([], base.select("doc", "version").schema).select(
        "doc", "version", F.lit(0).alias("n"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("h"), F.lit(0).alias("size"))
    found = empty
    for k in sizes:
        found = found.unionByName(_matches(base, shingles, k))
    found = common.store(found, "shingle-matches")

    rarity = found.groupBy("h", "size").agg(F.count(F.lit(1)).alias("freq"))
    ranked = parts.join(rarity, ["h", "size"], "left")
    prefix = ranked.groupBy("win", "len", "size").agg(
        F.min(F.struct("freq", "h", "j")).alias("p"), F.count("freq").alias("held"), F.count(F.lit(1)).alias("all"))
    prefix = common.store(prefix.where("held = all").select("win", "len", "size", "p.h", "p.j"), "window-prefixes")
    probe, _ = common.small_side(prefix)
    start = F.col("pos") - F.col("j")
    candidates = (found.join(probe, ["h", "size"])
                  .where((start >= 0) & (start + F.col("len") <= F.col("n")))
                  .select("doc", "version", "win", "len", "size", start.alias("start")).distinct())
    every = parts.select("win", "j", "h", (F.col("len") - F.col("size") + 1).alias("all"))
    every, _ = common.small_side(every)
    wanted = candidates.join(every, "win").select(
        "doc", "version", "win", "len", "size", "start", (F.col("start") + F.col("j")).alias("pos"), "h", "j", "all")
    c, m = wanted.alias("c"), found.select("doc", "version", "pos", "h", "size").alias("m")
    held = c.join(m, F.col("c.doc").eqNullSafe(F.col("m.doc")) & (F.col("c.version") == F.col("m.version"))
                  & (F.col("c.pos") == F.col("m.pos")) & (F.col("c.h") == F.col("m.h"))
                  & (F.col("c.size") == F.col("m.size")))
    verified = (held.groupBy("c.doc", "c.version", "c.win", "c.start", "c.len", "c.all")
                .agg(F.count_distinct("c.j").alias("got")).where("got = all").drop("got", "all"))
    return verified, wins.select("item", "win")


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """Per row of ``docs``: its columns, and ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``hit_items`` (sorted ids, as strings, of the items with occurring windows).

    Null and empty texts have no words and no hits; items without words have no window, and items without
    an id mark words but are not listed. Repeated rows each get their row; an empty table of documents
    gives an empty table, an empty table of items no hit. Columns of the result's names are replaced.
    """
    occ, wins = occurrences(docs, items, id_col=id_col, text_col=text_col, **options)
    occ = common.store(occ, "window-occurrences")
    order = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("stop"))))
    hits = occ.groupBy("doc", "version").agg(order.alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["hit"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["reach"]))).alias("hit"),
            F.greatest(s["stop"], a["reach"]).alias("reach")), lambda a: a["hit"].cast("long"))
    small, _ = common.small_side(wins)
    named = occ.select("doc", "version", "win").distinct().join(small, "win").groupBy("doc", "version").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    out = docs.drop("n_words", "n_hit", "hit_items")
    d, v, hit, its = common.internal(out, "__doc", "__version", "__hit", "__items")
    both = hits.select(F.col("doc").alias(d), F.col("version").alias(v), covered.alias(hit))
    named = named.select(F.col("doc").alias(d + "2"), F.col("version").alias(v + "2"), F.col("items").alias(its))
    both = both.join(named, F.col(d).eqNullSafe(F.col(d + "2")) & (F.col(v) == F.col(v + "2")), "left")
    both = both.drop(d + "2", v + "2")
    joined = out.withColumn("n_words", F.size(word_list(F.col(text_col))).cast("long")).join(
        both, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(v)), "left")
    return joined.drop(d, v).withColumns({
        "n_hit": F.coalesce(hit, F.lit(0).cast("long")),
        "hit_items": F.coalesce(its, F.array().cast("array<string>"))}).drop(hit, its)


def clean(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which a window of an item occurs."""
    occ, _ = occurrences(docs, items, id_col=id_col, text_col=text_col, **options)
    bad = occ.select("doc", "version").distinct()
    d, v = common.internal(docs, "__doc", "__version")
    bad = bad.select(F.col("doc").alias(d), F.col("version").alias(v))
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(d)) & (F.xxhash64(text_col) == F.col(v)), "left_anti")
