"""Token ids, packing, packed id files and token counts against the tokenizers library and plain Python."""

import io
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import binary_ids, packing, spans, token_counts
from strata.llm.queries import tokenizer_path
from strata.llm.tokens import encoder

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def ids_of(enc, texts):
    out = []
    for _, ids, offs in enc.encode(pa.array(texts, pa.string())):
        out += [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:], strict=True)]
    return out


def library(enc, text):
    return enc.tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_ids_equal_the_library_on_documents(name, rows):
    enc = encoder(tokenizer_path(name))
    texts = [r[1] for r in rows]
    assert ids_of(enc, texts) == [library(enc, t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab Z.,!'\n\t\r…é́ΣςİÅ각ᄀ 　 ‑\x1c_1²<|>", max_size=25), max_size=6))
def test_ids_equal_the_library_on_any_text(texts):
    for name in (BYTE, WORD):
        enc = encoder(tokenizer_path(name))
        assert ids_of(enc, texts) == [library(enc, t) for t in texts]


def test_words_and_hashes():
    texts = ["a  bb\tccc", None, "", "bb", " x" * 3, "y" * 9000 + " bb"]
    t = spans.texts_of(pa.array(texts))
    starts, ends, first = spans.words(t)
    got = [[t.data[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(first[:-1], first[1:], strict=True)]
    assert got == [(x or "").encode().split() for x in texts]
    h = spans.hash_spans(t.data, starts, ends)
    words = [w for x in got for w in x]
    assert len(set(h.tolist())) == len(set(words))
    assert {w: int(x) for w, x in zip(words, h, strict=True)} == dict(zip(words, map(int, h), strict=True))


def test_order_of_falls_back_when_low_bits_matter():
    v = np.array([5, 4, 5, 6, 4, 2**63], dtype=np.uint64)
    own, inverse, count = spans.group(v)
    assert own[inverse].tolist() == v.tolist() and count.sum() == len(v) and sorted(own.tolist()) == own.tolist()


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check_packing(pieces, expected, seq_len):
    """Every id in one piece, sequences gapless and full or a power of two; similar to the contract's words."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert sorted(by_doc, key=str) == sorted(expected, key=str)
    for doc, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(expected[doc])
            ids = expected[doc][at:at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
            at += p["length"]
        assert at == len(expected[doc])
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == seq_len or at < seq_len and at & (at - 1) == 0


def test_packing(docs, rows):
    enc = encoder(tokenizer_path(BYTE))
    expected = {r[0]: library(enc, r[1]) + [1] for r in rows}
    for seq_len in (2048, 64):
        check_packing(packing.pack(docs, tokenizer_path(BYTE), seq_len=seq_len).collect(), expected, seq_len)


def test_packing_keeps_alike_documents_together(spark):
    rnd = random.Random(1)
    kinds = [[f"{c}{i}word" for i in range(40)] for c in "abcd"]
    data = [(i, " ".join(rnd.choices(kinds[i % 4], k=150))) for i in range(400)]
    out = packing.pack(spark.createDataFrame(data, "doc_id long, text string").repartition(4), tokenizer_path(BYTE)).collect()
    mixed = defaultdict(set)
    for p in out:
        mixed[p["sequence_id"]].add(p["doc_id"] % 4)
    assert sum(len(k) for k in mixed.values()) / len(mixed) < 2  # by chance nearly all four kinds would meet


def test_packing_odd_rows(odd, empty):
    out = packing.pack(odd, tokenizer_path(BYTE), with_ids=True).collect()
    assert sum(p["length"] for p in out if p["doc_id"] == 7) == 1
    assert sum(1 for p in out if p["start"] == 0) == odd.count()
    assert packing.pack(empty, tokenizer_path(BYTE)).count() == 0


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 24, 31, 32])
def test_bit_packing_round_trip(bits):
    for n in (0, 1, 7, 8, 9, 1000):
        ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64)
        data = binary_ids.pack(ids, bits)
        assert len(data) == -(-n * bits // 8)
        assert binary_ids.unpack(data, n, bits).tolist() == ids.tolist()


def test_random_access():
    f, rnd = io.BytesIO(), np.random.default_rng(0)
    w = binary_ids.Writer(f, 13, 1, block=100)
    every, sizes = [], [0, 1, 99, 100, 101, 1000, 0, 7]
    for k, n in enumerate(sizes):
        ids = rnd.integers(0, 1 << 13, n, dtype=np.uint32)
        w.add([k if k != 3 else None], ids, np.array([n]))
        every.append(ids)
    w.close()
    flat = np.concatenate(every)
    r = binary_ids.Reader(f, f.tell())
    assert r.doc_ids == [0, 1, 2, None, 4, 5, 6, 7] and np.diff(r.ends, prepend=0).tolist() == sizes
    for a, b in [(0, 0), (0, 1), (99, 101), (250, 1250), (0, len(flat))]:
        assert r.ids(a, b).tolist() == flat[a:b].tolist()
    assert np.concatenate([ids for _, ids, _ in r.runs(step=64)]).tolist() == flat.tolist()


def test_packed_ids(docs, rows):
    enc = encoder(tokenizer_path(WORD))
    got = binary_ids.read_ids(binary_ids.write_ids(docs, tokenizer_path(WORD), block=500), with_ids=True)
    at, found = 0, {r["doc_id"]: r for r in got.collect()}
    assert len(found) == len(rows)
    for doc, text, *_ in sorted(rows):
        ids = library(enc, text) + [1]
        r = found[doc]
        assert (r["start"], r["n_tokens"], r["ids"]) == (at, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        at += len(ids)


def test_packed_ids_odd_rows(spark, odd, empty):
    assert binary_ids.read_ids(binary_ids.write_ids(odd, tokenizer_path(WORD))).count() == odd.count()
    assert binary_ids.read_ids(binary_ids.write_ids(empty, tokenizer_path(WORD))).count() == 0
    named = spark.createDataFrame([("b", "two words"), ("a", None), (None, "x")], "doc_id string, text string")
    got = binary_ids.read_ids(binary_ids.write_ids(named, tokenizer_path(WORD)), "string").orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, "a", "b"]


def brute_lines(enc, text, rule):
    text = text or ""
    starts = [0] + [i + 1 for i, c in enumerate(text) if c == "\n"]
    bounds = [*starts, len(text)]
    tokens, crossing = [0] * len(starts), [0] * len(starts)
    home = lambda i: max(k for k, s in enumerate(starts) if s <= i)
    for a, b in enc.tok.encode(text, add_special_tokens=False).offsets:
        first, last = home(a), home(b - 1)
        k = first if rule == "first" else last
        if rule == "most":
            k = max(range(first, last + 1), key=lambda k: (min(b, bounds[k + 1]) - max(a, bounds[k]), -k))
        tokens[k] += 1
        crossing[k] += first != last
    return [(s, bounds[k + 1] - s, tokens[k], crossing[k]) for k, s in enumerate(starts)]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_line_counts(spark, rule, rows):
    data = [(r[0], r[1]) for r in rows[:60] + rows[-6:-3]] + [(1000, "a\n\n\n\nb\n \n c\n"), (1001, "\n\n\nx"), (1002, "é\né…\n各\n")]
    data = [(i, t) for i, t in data if "<|" not in (t or "")]
    got = defaultdict(list)
    for r in token_counts.count_lines(spark.createDataFrame(data, "doc_id long, text string"), tokenizer_path(BYTE), rule=rule).collect():
        got[r["doc_id"]].append((r["section"], (r["start_char"], r["n_chars"], r["n_tokens"], r["n_crossing"])))
        assert r["doc_tokens"] >= r["n_tokens"]
    enc = encoder(tokenizer_path(BYTE))
    for i, t in data:
        assert [x for _, x in sorted(got[i])] == brute_lines(enc, t, rule), repr(t)[:80]


def test_field_counts(spark, odd, empty):
    d = spark.createDataFrame([(1, "a title", None, "body text"), (2, None, None, None)], "doc_id long, t string, u string, b string")
    got = {(r["doc_id"], r["section"]): r["n_tokens"] for r in
           token_counts.count_fields(d, tokenizer_path(BYTE), ["t", "u", "b"]).collect()}
    enc = encoder(tokenizer_path(BYTE))
    assert sum(v for k, v in got.items() if k[0] == 1) == len(library(enc, "a title\n\nbody text"))
    assert set(got) == {(i, k) for i in (1, 2) for k in range(3)}
    assert token_counts.count_lines(odd, tokenizer_path(BYTE)).where("section = 0").count() == odd.count()
    assert token_counts.count_lines(empty, tokenizer_path(BYTE)).count() == 0
