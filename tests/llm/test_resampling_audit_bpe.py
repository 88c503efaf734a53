"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import as_dict, lower, words_of
from strata.llm import audit, byte_bpe, queries, resampling, spans

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
LABELS = "doc_id long, quality int, toxic int"


# ------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(RANKS, byte_bpe.class_table())


PARTS = ["'", "s", "t", "re", "ve", "v", "l", "ll", "m", "d", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "a", "Z",
         "é", "ß", "1", "²", "٣", "!", "-", "…", "中", "\U0001f600", "́", "'ll", "''", "I'd've", "<|endoftext|>"]


def encoded(codec, texts):
    out = []
    for _, ids, ends, first in codec.encode(pa.array(texts, pa.string()), 300):
        for a, b in zip(first[:-1], first[1:]):
            out.append((ids[a:b].tolist(), ends[a:b].tolist()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), st.text(max_size=30)), max_size=8))
def test_ids_equal_the_library(library, codec, texts):
    for text, (ids, ends) in zip(texts, encoded(codec, texts), strict=True):
        assert ids == library.encode_ordinary(text)
        raw = text.encode()
        assert codec.decode(np.array(ids, dtype=np.int64)).tobytes() == raw
        assert [raw[a:b] for a, b in zip([0, *ends], ends)] == [library.decode_single_token_bytes(i) for i in ids]


def test_classes_are_the_library_s(library, codec):
    rnd = random.Random(2)
    points = [chr(c) for c in rnd.sample(range(0x30000), 4000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b {c}1{c} {c}{c}x" for c in points]
    assert [ids for ids, _ in encoded(codec, texts)] == [library.encode_ordinary(t) for t in texts]


def test_scan_composes_in_order():
    m = byte_bpe.machine()
    rnd = random.Random(1)
    for n in (1, 2, 255, 256, 257, 70_000):
        x = np.array([rnd.choice(m.of.tolist()) for _ in range(n)], dtype=np.uint16)
        want, state = [], 0
        for f in x.tolist():
            state = int(m.compose[state * m.n + f])
            want.append(state)
        assert byte_bpe.scan(x).tolist() == want


def test_merges_agree(codec):
    rnd = random.Random(3)
    pieces = [bytes(rnd.choice(b"aeinrst\xc3\xa9 ") for _ in range(rnd.randint(2, 60))) for _ in range(300)]
    pieces += [b"a" * n for n in range(2, 64)]
    ids, lens = byte_bpe.merge_many(pieces, codec.single, codec.pairs)
    ends = np.cumsum(lens)
    for p, a, b in zip(pieces, ends - lens, ends):
        assert ids[a:b].tolist() == byte_bpe._from_heap(p, codec.ranks)
        assert b"".join(t for i in ids[a:b].tolist() for t, r in [(codec.pool[codec.place[i]:codec.place[i] + codec.width[i]].tobytes(), i)]) == p


def test_remembered_pieces_change_no_id(library):
    small = byte_bpe.Codec(RANKS, byte_bpe.class_table(), limit=2000)
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(PARTS) * rnd.randint(1, 4) for _ in range(40)) for _ in range(60)]
    assert [ids for ids, _ in encoded(small, texts)] == [library.encode_ordinary(t) for t in texts]


def test_invalid_bytes_become_replacement_characters(codec, library):
    column = pa.array([b"ok", b"a\xffb", b""], pa.binary())
    got = [ids[a:b].tolist() for _, ids, _, f in codec.encode(column) for a, b in zip(f[:-1], f[1:])]
    assert got == [library.encode_ordinary(t) for t in ("ok", "a�b", "")]


def test_round_trip_of_documents(docs, rows, library):
    encoded_ = byte_bpe.encode(docs, RANKS)
    got, decoded = as_dict(encoded_), as_dict(byte_bpe.decode(encoded_, RANKS))
    one_pass, part = as_dict(byte_bpe.round_trip(docs, RANKS)), as_dict(byte_bpe.decode(encoded_, RANKS, first=2, last=5))
    assert len(got) == len(rows) == len(one_pass)
    for i, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        assert got[i]["ids"] == ids and got[i]["ends"] == np.cumsum([len(library.decode_single_token_bytes(k)) for k in ids]).tolist()
        want = {"doc_id": i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                "decoded": bytearray((text or "").encode())}
        assert decoded[i] == want == one_pass[i]
        assert bytes(part[i]["decoded"]) == library.decode_bytes(ids[2:5])


def test_bpe_odd_rows(odd, empty, spark):
    out = byte_bpe.round_trip(odd, RANKS).collect()
    assert len(out) == odd.count() and sum(r["doc_id"] is None for r in out) == 2
    assert all(bytes(r["decoded"]) == b"" and r["n_tokens"] == 0 for r in out if r["doc_id"] == 7)
    assert byte_bpe.round_trip(empty, RANKS).count() == 0 == byte_bpe.encode(empty, RANKS).count()
    named = spark.createDataFrame([("x", "Hello  world")], "doc_id string, text string")
    assert bytes(byte_bpe.round_trip(named, RANKS).first()["decoded"]) == b"Hello  world"


# ------------------------------------------------------------- importance resampling

def feature_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def brute_resample(rows, target, buckets=10_000, min_words=20, percent=25):
    def features(text):
        w = feature_words(text)
        return [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = (Counter(b for r in table for b in features(r[1])) for table in (rows, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = {}
    for i, text, *_ in rows:
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    drawn = sorted((i for i, text, *_ in rows if len(feature_words(text)) >= min_words), key=lambda i: (-out[i][2], i))
    for k, i in enumerate(drawn[:len(drawn) * percent // 100]):
        out[i][3] = k + 1
    return out


@pytest.mark.parametrize("limit", [0, 60, 1 << 20])
def test_resampling_equals_brute_force(spark, docs, rows, limit):
    target = [(i, rows[i][1] if i % 3 else "THE an ti-on er, 12 über") for i in range(0, 60, 5)] + [(99, None)]
    items = spark.createDataFrame(target, "item_id long, text string")
    got = resampling.resample(docs, items, dictionary_bytes=limit).collect()
    want = brute_resample(rows, target)
    assert {r["doc_id"]: [r["n_features"], r["weight"], r["score"], r["rank"]] for r in got} == want
    assert sum(r["rank"] is not None for r in got) > 5 and len({r["weight"] for r in got}) > 20


def test_crc_of_runs_is_composed():
    rnd = random.Random(6)
    a = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 5, 90]))) for _ in range(200)]
    b = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 63, 64, 200, 5000]))) for _ in range(200)]
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], dtype=np.uint32)
    got = resampling.compose(crc(a), crc(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


def test_longer_runs_and_rows_stay_apart():
    texts = [None, "", "Ab", "ab CD", "x" * 300 + " é,y", "-", "p q r s"]
    dictionary = zlib.compress(b"ab q \xc3\xa9")
    (first, grams), = resampling._features(pa.array(texts), dictionary, 3, 1000)
    for i, text in enumerate(texts):
        w = feature_words(text)
        assert first[i + 1] - first[i] == len(w)
        for k, (bucket, at) in enumerate(grams):
            runs = [" ".join(w[j:j + k + 1]) for j in range(len(w) - k)]
            assert bucket[at[i]:at[i + 1]].tolist() == [zlib.crc32(x.encode()) % 1000 for x in runs]


def test_resampling_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    out = resampling.resample(odd, items, min_words=1, percent=50).collect()
    assert len(out) == odd.count() and sorted(r["rank"] for r in out if r["rank"]) == [1, 2]
    assert {(r["n_features"], r["weight"]) for r in out if r["doc_id"] == 7} == {(0, 0)}
    assert resampling.resample(empty, items).count() == 0
    named = spark.createDataFrame([("b", "one two"), ("a", "one two"), (None, None)], "doc_id string, text string")
    assert {r["doc_id"] for r in resampling.resample(named, named).collect()} == {"a", "b", None}


# ------------------------------------------------------------- filter interaction audit

def brute_mask(rows):
    """doc -> (part, set of failed filters); ``rows``: (doc, text, part)."""
    out = []
    for i, text, part in rows:
        text, fails = text or "", set()
        w = words_of(text)
        fails |= {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        same = [j for j, other, _ in rows if (other or "") == text and j is not None]
        fails |= {"E"} if same and (i is None or min(same) < i) else set()
        out.append((i, part or "", fails))
    return out


def brute_audit(rows, labels):
    judged, out = brute_mask(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    for part in {p for _, p, _ in judged}:
        own, shapley = [(i, f) for i, p, f in judged if p == part], Counter()
        for order in permutations("ABCDE"):
            left, name = list(own), "".join(order)
            for k, x in enumerate(order):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(gone)
                out[part, name, k + 1] = [len(left), len(gone), sum(x in f for _, f in own) - len(gone), sum(f == {x} for _, f in own),
                                          sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, name, k), row in out.items():
            if p == part:
                row.append(shapley[name[k - 1]])
    return out


def as_audit(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in (
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in df.collect()}


def test_audit_equals_brute_force(spark, docs, rows):
    rnd = random.Random(8)
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 130, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    got = as_audit(audit.audit(docs, spark.createDataFrame(labels, LABELS)))
    want = brute_audit([(i, t, lang) for i, t, lang, *_ in rows], labels)
    assert got == want and len(got) == 600 * len({r[2] or "" for r in rows})


def test_masks_of_copies(spark):
    """A text that a third of the rows hold, over many parts of the corpus, and near copies of it."""
    long_ = " ".join(f"w{i}" for i in range(150))
    rows = [(i, long_ if i % 3 == 0 else f"{long_} {i}" if i % 3 == 1 else f"text {i % 40}", None) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(12)
    got = {r["doc"]: r["mask"] for r in audit.flags(docs).collect()}
    assert got == {i: sum(1 << "ABCDE".index(x) for x in f) for i, _, f in brute_mask(rows)}


def test_sketch_clears_only_unique_texts():
    rnd = random.Random(9)
    tables, blocks = [], 2
    for _ in range(6):
        texts = [f"t{rnd.randint(0, 400)}" if rnd.random() < 0.5 else f"u{rnd.random()}" for _ in range(300)]
        tables.append(pa.table({"text": pa.array(texts)}))
    made = [audit._Cells(t, blocks) for t in tables]
    replies = [{} for _ in made]
    for block in range(blocks):
        asked = [(i, k, x) for i, c in enumerate(made) for _, b, k, x in c.asked() if b == block]
        for (i, _, _), reply in zip(asked, audit.merge_block([k for _, k, _ in asked], [x for _, _, x in asked]), strict=True):
            replies[i][block] = reply
    total = Counter(x for t in tables for x in t.column("text").to_pylist())
    cleared = 0
    for t, c, r in zip(tables, made, replies):
        for text, maybe in zip(t.column("text").to_pylist(), c.possible(r).tolist(), strict=True):
            assert maybe or total[text] == 1
            cleared += not maybe
    assert cleared > 0.95 * sum(n == 1 for n in total.values())


def test_one_cell_counts_once():
    """A text whose two cells are one and the same is not its own repeat."""
    a = np.array([5, 7], dtype=np.uint64)
    assert spans.group(np.concatenate([a, a]))[0].tolist() == [5, 7]
    c = audit._Cells.__new__(audit._Cells)
    c.own, place, _ = spans.group(np.concatenate([a, a]))
    c.a, c.b = place[:2], place[2:]
    second = c.b[c.a != c.b]
    assert len(second) == 0 and np.bincount(c.a, minlength=2).tolist() == [1, 1]


def test_audit_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1)], LABELS)
    mixed = odd.withColumnRenamed("hash", "lang")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in mixed.collect()]
    assert as_audit(audit.audit(mixed, labels)) == brute_audit(rows, [(1, 1, 0), (1, 0, 1), (None, 1, 1)])
    assert audit.audit(empty, labels).count() == 0
    none = spark.createDataFrame([], LABELS)
    assert all(v[4] == v[5] == 0 for v in as_audit(audit.audit(mixed, none)).values())
    named = spark.createDataFrame([("b", "x", None), ("a", "x", "en")], "doc_id string, text string, lang string")
    assert {r["doc"]: r["mask"] >> 4 for r in audit.flags(named).collect()} == {"b": 1, "a": 0}


def test_new_queries_run_on_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    out = as_dict(queries.op13_byte_bpe(spark, sf))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        assert out[r["doc_id"]] == {
            "doc_id": r["doc_id"], "n_tokens": len(ids), "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256((r["text"] or "").encode()).hexdigest()}
