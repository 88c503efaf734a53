"""Line, substring and near-duplicate operators against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SPACES, as_dict, lower, words_of
from strata.llm import common, line_dedup, parts, simhash, substring_dedup
from strata.llm.components import components

# ------------------------------------------------------------- lines

def brute_lines(rows, min_chars=10, min_docs=2):
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            k = lower(line.strip(SPACES))
            if len(k) >= min_chars:
                holders[k].add(i)
    out = {}
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(lower(x.strip(SPACES)), ())) >= min_docs and min(h) != i for x in lines]
        out[i] = (len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g))
    return out


def test_line_dedup(docs, rows):
    got = as_dict(line_dedup.dedup_lines(docs))
    for i, (n, dropped, text) in brute_lines(rows).items():
        assert (got[i]["n_lines"], got[i]["n_dropped"], got[i]["text"] or "") == (n, dropped, text)
    assert sum(r["n_dropped"] for r in got.values()) > 10


def test_line_dedup_threshold(docs, rows):
    got = as_dict(line_dedup.dedup_lines(docs, min_docs=5, min_chars=3))
    assert {i: (r["n_lines"], r["n_dropped"], r["text"] or "") for i, r in got.items()} == brute_lines(rows, 3, 5)


def test_line_dedup_odd_rows(odd, empty):
    out = line_dedup.dedup_lines(odd).collect()
    assert len(out) == odd.count() and {"__id", "hash", "pos", "doc", "version", "__doc"} <= set(out[0].asDict())
    texts = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out)
    assert texts == [(False, 1, "another text under the same id\nsame line of text"),
                     (False, 1, "one line of text here\nsame line of text"), (False, 1, "one line of text here\nsame line of text"),
                     (False, 7, ""), (True, 0, ""), (True, 0, "more")]
    assert line_dedup.dedup_lines(empty).count() == 0


# ------------------------------------------------------------- substrings

def brute_substrings(rows, n):
    every = {i: words_of(text) for i, text, *_ in rows}
    count = Counter(tuple(w[j:j + n]) for w in every.values() for j in range(len(w) - n + 1))
    out = {}
    for i, w in every.items():
        gone = set()
        for j in range(len(w) - n + 1):
            if count[tuple(w[j:j + n])] > 1:
                gone.update(range(j, j + n))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize(("window", "load"), [(35, 4), (5, 1), (1, 4)])
def test_substring_dedup(docs, rows, window, load):
    got = as_dict(substring_dedup.dedup_substrings(docs, window=window, load=load))
    expected = brute_substrings(rows, window)
    assert {i: (r["n_words"], r["n_removed"], r["text"]) for i, r in got.items()} == expected
    assert sum(x[1] for x in expected.values()) > 100


def test_window_hash_steps():
    """Windows hashed in several steps equal windows hashed in one."""
    from strata.llm import spans
    import pyarrow as pa

    rnd = random.Random(2)
    text = " ".join(rnd.choice("abcdefgh") for _ in range(1_200_000))
    t = spans.texts_of(pa.array([text, text[2:]]))
    h, at = substring_dedup.window_hashes(spans.words(t), t.data, 7, 1)
    n = 1_200_000 - 6
    assert len(h) == n + n - 1 and (h[1:n] == h[n:]).all() and at[n] == 1_200_000


def test_sketch_only_overestimates():
    rng = np.random.default_rng(0)
    own = [np.unique(rng.integers(0, 5000, 900).astype(np.uint64)) for _ in range(4)]
    twice = [rng.random(len(x)) < 0.1 for x in own]
    from strata.llm import common

    replies = substring_dedup.merge_block([common.pack_sorted(x) for x in own], [np.packbits(t).tobytes() for t in twice])
    total = Counter()
    for x, t in zip(own, twice, strict=True):
        for c, k in zip(x.tolist(), t, strict=True):
            total[c] += 1 + int(k)
    for x, r in zip(own, replies, strict=True):
        flags = np.unpackbits(np.frombuffer(r, np.uint8), count=len(x)).astype(bool)
        assert flags.tolist() == [total[c] >= 2 for c in x.tolist()]


def test_substring_odd_rows(odd, empty):
    out = substring_dedup.dedup_substrings(odd, window=3).collect()
    assert len(out) == odd.count() and sum(r["doc_id"] is None for r in out) == 2
    assert all(r["n_removed"] == r["n_words"] for r in out if r["doc_id"] == 1 and r["text"] == "")
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_parts_end_by_rows_alone(docs):
    corpus = parts.copy(docs, {"doc": docs["doc_id"], "text": docs["text"]}, file_rows=7)
    batches = corpus.rows.select("file", "doc", "text").toArrow().to_batches()
    a = {p: t.column("doc").to_pylist() for p, t in parts.parts_of(iter(batches), 2000)}
    small = [b.slice(i, 2) for b in batches for i in range(0, b.num_rows, 2)]
    b = {p: t.column("doc").to_pylist() for p, t in parts.parts_of(iter(small), 2000)}
    assert a == b and sum(map(len, a.values())) == docs.count() and len(a) > 20


def test_parts_do_not_depend_on_row_groups_or_splits(spark, monkeypatch):
    """Spark's writer would cut the copy into many row groups here, and its reader deal them to many tasks."""
    from pyspark.sql.readwriter import DataFrameWriter

    option = DataFrameWriter.option
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, key, value: option(
        self, key, "1024" if key == "parquet.block.size" else value))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rnd = random.Random(4)
    passage = " ".join(rnd.choice("abcdefgh") * rnd.randint(1, 9) for _ in range(8))
    rows = [(i, f"{rnd.random()} {rnd.random()} " * 20 + (passage if i % 50 == 7 else "")) for i in range(2000)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = as_dict(substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), window=6))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {i: (r["n_words"], r["n_removed"], r["text"]) for i, r in got.items()} == brute_substrings(rows, 6)


def test_files_of_the_copy_are_bounded_by_bytes(docs, rows):
    corpus = parts.copy(docs, {"doc": docs["doc_id"], "text": docs["text"]}, file_bytes=20_000)
    held = defaultdict(list)
    for r in corpus.rows.collect():
        held[r["file"]].append(len((r["text"] or "").encode()))
    assert all(len(x) == 1 or sum(x) <= 20_000 for x in held.values())
    assert corpus.n_bytes == sum(len((r[1] or "").encode()) for r in rows) == sum(map(sum, held.values()))


# ------------------------------------------------------------- SimHash

def brute_fingerprint(text, k=4):
    import xxhash

    w = words_of(lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_equal_sparks_hash(spark):
    """The shingle hash is Spark's xxhash64 (seed 42)."""
    from pyspark.sql import functions as F

    text = "One two THREE four"
    native = spark.range(1).select(F.xxhash64(F.lit("one two three four"))).first()[0] & (2**64 - 1)
    assert simhash.fingerprint(text.encode()) == native == brute_fingerprint(text)


def brute_components(fps, radius):
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def test_near_duplicates(docs, rows):
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows}
    got = as_dict(simhash.near_duplicates(docs))
    assert {i: r["fp"] & (2**64 - 1) for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fps, 4)
    kept = {r["doc_id"] for r in simhash.keep_first(docs).collect()}
    assert kept == set(brute_components(fps, 4).values())


@pytest.mark.parametrize(("radius", "prefix", "budget"), [
    (4, None, 1 << 20), (4, 8, 1 << 20), (4, 20, 1 << 20), (2, 10, 1 << 20), (0, 8, 1 << 20),
    (4, 8, 20_000), (4, 16, 50), (2, 10, 1), (0, 8, 1)])  # a small budget: prefixes are sliced, down to the last bit
def test_links_lose_nothing(spark, radius, prefix, budget):
    rnd = random.Random(radius)
    fps = [rnd.getrandbits(64) for _ in range(60)]
    for base in list(fps):  # chains at every distance up to the radius and just beyond
        for d in (1, 2, 3, 4, 5):
            x = base
            for b in rnd.sample(range(64), d):
                x ^= 1 << b
            fps.append(x)
    fps = sorted(set(fps))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    links = simhash.linked(spark.createDataFrame(signed, "fp long"), radius, prefix, budget).collect()
    assert all(0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= radius for r in links)
    found = {x: x for x in fps}

    def find(i):
        while found[i] != i:
            i = found[i]
        return i

    for r in links:
        x, y = sorted((find(r["a"] & (2**64 - 1)), find(r["b"] & (2**64 - 1))))
        found[y] = x
    assert {x: find(x) for x in fps} == brute_components({x: x for x in fps}, radius)


def test_a_crowded_prefix_is_expanded_in_slices(spark):
    # 1500 near copies of one text: all of one prefix, and all linked
    base = random.Random(5).getrandbits(64) | 1 << 63
    fps = [base] + [base ^ (1 << i) ^ (1 << j) for i in range(56) for j in range(i)][:1499]
    table = spark.createDataFrame([(x - (1 << 64),) for x in fps if x >> 63], "fp long").distinct()
    whole = simhash.linked(table, 4, 8).collect()
    parts = simhash.linked(table, 4, 8, 1 << 14).collect()
    for links in (whole, parts):
        roots = {r["node"]: r["root"] for r in components(
            spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
        assert len(roots) == table.count() and len(set(roots.values())) == 1


def test_crowded_prefixes_are_met_by_several_tasks(spark):
    """Fingerprints of one template share 44 bits: they go on to longer prefixes, and no link is lost."""
    rnd = random.Random(12)
    head = rnd.getrandbits(44) << 20
    values = {head | rnd.getrandbits(20) for _ in range(700)} | {rnd.getrandbits(64) for _ in range(200)}
    values |= {v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in list(values)[:300]}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    table = spark.createDataFrame(signed, "fp long").repartition(3)
    whole = {tuple(r) for r in simhash.linked(table, 4, 8).collect()}
    long_ = {tuple(r) for r in simhash.linked(table, 4, 8, crowded=60).collect()}
    assert linked_classes(values, long_) == linked_classes(values, whole) == linked_classes(values, [
        (a, b) for a, b in itertools.combinations(sorted(values), 2) if (a ^ b).bit_count() <= 4])
    sent = table.crossJoin(spark.createDataFrame([(0,)], "one int")).selectExpr("shiftrightunsigned(fp, 56) as at", "fp", "cast(0 as byte) as flips")
    levels = simhash.dealt(table, sent, 8, 2, 60)
    assert len(levels) > 1 and levels[0][0] == 8
    own = levels[-1][1].where(F.shiftrightunsigned("fp", 20) == F.shiftrightunsigned(F.lit(head - (1 << 64) if head >> 63 else head), 20))
    assert own.select("at").distinct().count() > 8  # keys of the shuffle that the template's rows go by


def linked_classes(values, links):
    """The classes of values that links connect, as sorted lists."""
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a % (1 << 64)), root(b % (1 << 64))
        parent[max(a, b)] = min(a, b)
    groups = defaultdict(list)
    for v in values:
        groups[root(v)].append(v)
    return sorted(sorted(g) for g in groups.values())


def plan_of(df):
    assert df.collect()  # runs this frame's own plan, which is then the final one
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hub_is_split(spark):
    """The join of links with their stored minima splits a node that holds most of them."""
    keep = {k: spark.conf.get(k, None) for k in (
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k, v in zip(keep, ("64k", "64k", "-1", "-1")):
        spark.conf.set(k, v)
    try:
        links = spark.range(200_000).selectExpr("case when id % 10 < 9 then 0 else id + 1000000 end as u", "id + 1 as v").repartition(8)
        stored = common.store(links, "hub")
        low = common.store(stored.groupBy("u").agg(F.min("v").alias("m")), "hub-low")
        assert "skew=true" in plan_of(stored.join(low, "u"))
    finally:
        for k, v in keep.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_components_of_a_hub_and_a_chain(spark):
    links = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert roots == {i: 0 for i in range(400)} | {1000 + i: 1000 for i in range(61)}


def test_simhash_odd_rows(odd, empty):
    out = simhash.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    assert {r["component_id"] for r in out if r["fp"] == 0} == {7}  # empty and null texts are one group
    assert simhash.keep_first(odd).columns == odd.columns
    assert simhash.near_duplicates(empty).count() == 0


def test_keep_first_tells_texts_of_one_id_apart(spark):
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in ("ab", "cd", "ef"))
    rows = [(1, two), (5, one), (5, two), (7, three), (None, three), (None, "alone " + one[:50]), (5, one)]
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, kept.collect())) == Counter(
        [(1, two), (5, one), (5, one), (7, three), (None, "alone " + one[:50])])


def test_components(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + rnd.randint(1, 300)) for _ in range(300)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {got[i] for i in range(201)} == {0} and {r for n, r in got.items() if 1000 <= n < 2000} == {1000}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_line_key_is_ascii_only():
    assert line_dedup.line_key("\t ÉA\x0b".encode()) == "Éa".encode()
