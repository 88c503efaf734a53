"""Host rules, archives, decontamination and language-model scores against brute force."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import as_dict, lower, words_of
from pyspark.sql import functions as F

from strata.llm import common, ctw, decontaminate, quality, queries, warc

# ------------------------------------------------------------- quality


def brute_counts(text):
    text = text or ""
    w = words_of(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] >= 2 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def test_counts(docs, rows):
    got = as_dict(quality.with_counts(docs))
    for r in rows:
        assert {c: got[r[0]][c] for c in quality.COUNTS} == brute_counts(r[1]), r[0]


def test_counts_fall_back_to_whole_hashes(docs, rows, monkeypatch):
    """With most of the hash cut off, windows collide in the packed form and whole hashes decide."""
    monkeypatch.setattr(quality, "_POS_BITS", 58)
    got = as_dict(quality.with_counts(docs))
    assert {i: r["n_repeat_words"] for i, r in got.items()} == {r[0]: brute_counts(r[1])["n_repeat_words"] for r in rows}


def test_host_rates_shrink(spark):
    data = [("good", i < 10) for i in range(1000)] + [("bad", i < 900) for i in range(1000)] + [("tiny", True)] \
        + [(f"h{k}", i < 5) for k in range(20) for i in range(100)]
    rows = spark.createDataFrame(data, "host string, rule boolean")
    rate = {r["host"]: r["rate_rule"] for r in quality.host_rates(rows, "host", ["rule"]).collect()}
    assert abs(rate["good"] - 0.01) < 0.01 and rate["bad"] > 0.85
    assert rate["tiny"] < 0.9 and rate["tiny"] > rate["h0"]  # one document is drawn towards the mean
    same = spark.createDataFrame([("a", i < 5) for i in range(50)] + [("b", i < 5) for i in range(50)], rows.schema)
    assert {round(r["rate_rule"], 4) for r in quality.host_rates(same, "host", ["rule"]).collect()} == {0.1}


def test_a_bad_host_is_rejected(spark):
    good = " ".join(f"w{i}" for i in range(60))
    data = [(i, "junk" if i % 10 else good, "farm") for i in range(200)] + [(1000 + i, good, f"ok{i % 8}") for i in range(800)]
    got = as_dict(quality.judged(spark.createDataFrame(data, "doc_id long, text string, source string")))
    assert not any(r["kept"] for r in got.values() if r["source"] == "farm")
    assert all(r["kept"] for r in got.values() if r["source"] != "farm")
    assert {tuple(r["host_failed"]) for r in got.values()} == {("words",), ()}


def test_hosts_fail_by_rules_beside_the_base_ones(spark):
    """No document of these hosts fails a base rule; their symbols, lines and word lengths reject them."""
    plain = " ".join(f"word{i}" for i in range(60))
    texts = {"marks": plain + " # $ % & | < > # $ %", "lines": "\n".join([plain, *["one short line"] * 3]),
             "length": " ".join(f"averyverylongword{i}" for i in range(60))}
    data = [(k * 100 + i, texts[h] if i % 5 else plain, h) for k, h in enumerate(texts) for i in range(60)]
    data += [(1000 + i, texts["marks"] if i % 40 == 0 else plain, f"ok{i // 60}") for i in range(1200)]
    got = as_dict(quality.judged(spark.createDataFrame(data, "doc_id long, text string, source string")))
    assert not any(r["base_failed"] for r in got.values())
    for h, rule in (("marks", "symbols"), ("lines", "lines"), ("length", "length")):
        assert {tuple(r["host_failed"]) for r in got.values() if r["source"] == h} == {(rule,)}
        assert not any(r["kept"] for r in got.values() if r["source"] == h)
    assert all(r["kept"] for r in got.values() if r["source"].startswith("ok"))


def test_no_host_near_the_mean_is_rejected(spark):
    """Where all hosts are equally bad, no host is worse than the others."""
    data = [(i, "junk" if i % 3 else " ".join(f"w{k}" for k in range(60)), f"h{i % 7}") for i in range(700)]
    got = as_dict(quality.judged(spark.createDataFrame(data, "doc_id long, text string, source string")))
    assert all(r["host_failed"] == [] and r["kept"] != r["base_failed"] for r in got.values())


def test_quality_odd_rows(odd, empty):
    out = quality.judged(odd)
    assert out.count() == odd.count() and out.where("kept").count() == 0
    assert {"__id", "hash", "file", "__doc"} <= set(out.columns)
    assert quality.judged(empty).count() == 0


# ------------------------------------------------------------- archives

PAGES = [(1, "http://a/1", "<p>é</p>" * 50), (2, "http://a/2", "<p>é</p>" * 50), (3, "http://a/\r\nX: y", "x"), (4, None, None),
         (5, "http://a/5", ""), (9, "http://a/9", "<p>é</p>" * 50), (9, "http://a/9", "<p>é</p>" * 50),
         (10, "http://a/10", "WARC/1.1\r\nContent-Length: 99\r\n\r\n" * 20), (11, "u", "y" * 3_000_000), (None, "n", "x")]


def base32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_archive_round_trip(spark, min_bytes):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("body", F.lit(1)).repartition(3)
    out = warc.read_archives(warc.archive(pages, min_bytes=min_bytes), with_payload=True).collect()
    last = {}
    for i, _, html in PAGES:
        raw = (html or "").encode()
        if len(raw) >= min_bytes:
            last[raw] = max(last.get(raw, -1), -1 if i is None else i)
    expected = Counter()
    for i, url, html in PAGES:
        raw = (html or "").encode()
        to = last.get(raw, i)
        again = to != i and to != -1
        expected[(f"urn:page:{i}", "revisit" if again else "response", f"urn:page:{to}" if again else None,
                  url and url.replace("\r", "%0D").replace("\n", "%0A"), len(raw), base32(raw), b"" if again else raw)] += 1
    assert Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in out) == expected


def test_normalised_members_stand_alone(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(1)
    m = warc.archive(pages)
    file, index, n = m.first()
    fs, p = common.filesystem(file)
    raw = fs.open_input_file(p).read()
    assert n == len(PAGES) and gzip.decompress(raw).count(b"WARC-Record-ID") == n
    import json

    ifs, ip = common.filesystem(index)
    entries = [json.loads(x) for x in ifs.open_input_file(ip).read().splitlines()]
    assert [e["offset"] for e in entries] == np.cumsum([0] + [e["length"] for e in entries])[:-1].tolist()
    for e in entries:
        assert zlib.decompress(raw[e["offset"]:e["offset"] + e["length"]], 31).startswith(b"WARC/1.1\r\n")


def test_inflate_streams(monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 7)
    plain = bytes(random.Random(1).choices(b"abcd", k=5000))
    assert b"".join(warc.inflate(io.BytesIO(gzip.compress(plain)))) == plain
    assert b"".join(warc.inflate(io.BytesIO(gzip.compress(plain[:99]) + gzip.compress(plain[99:])))) == plain
    body = warc.head([("Content-Length", "5")]) + b"hello\r\n\r\n"
    parts = iter([body[i:i + 3] for i in range(0, len(body), 3)] + [body * 20])
    assert len(list(warc.records_of(parts))) == 21
    with pytest.raises(ValueError):
        list(warc.records_of(iter([body[:-6]])))


def test_archive_of_nothing(spark):
    assert warc.read_archives(warc.archive(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_the_archive_query_keeps_a_page_without_an_id(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    out = queries.op8_warc(spark, str(tmp_path)).collect()
    assert any(i is None for i, *_ in PAGES)
    assert Counter(r["page_id"] for r in out) == Counter(i for i, *_ in PAGES)


# ------------------------------------------------------------- decontamination

def brute_contamination(rows, items, n):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        for j in range(max(len(w) - n + 1, 1) if w else 0):
            windows[tuple(w[j:j + n])].add(i)
    out = {}
    for i, t, *_ in rows:
        w, hit, found = split(t), set(), set()
        for win, ids in windows.items():
            for j in range(len(w) - len(win) + 1):
                if tuple(w[j:j + len(win)]) == win:
                    hit.update(range(j, j + len(win)))
                    found |= ids
        out[i] = (len(w), len(hit), sorted(str(x) for x in found if x is not None))
    return out


@pytest.mark.parametrize("window", [10, 4, 2])
def test_contamination(spark, docs, rows, window):
    rnd = random.Random(window)
    long_texts = [r[1] for r in rows if r[1] and 30 < len(words_of(r[1])) < 400]
    items = [(100 + k, "New start " + " ".join(words_of(t)[7:7 + rnd.randint(2, 20)]).upper() + " ! end of it")
             for k, t in enumerate(rnd.sample(long_texts, 12))]
    items += [(200 + k, " ".join(words_of(t)[3:3 + k])) for k, t in enumerate(rnd.sample(long_texts, 6))]
    items += [(300, None), (301, "..."), (302, items[0][1]), (None, items[1][1]), (300, "nothing alike zzz")]
    got = as_dict(decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), window=window))
    expected = brute_contamination(rows, items, window)
    assert {i: (r["n_words"], r["n_hit"], r["hit_items"]) for i, r in got.items()} == expected
    assert sum(x[1] > 0 for x in expected.values()) >= 3
    kept = {r["doc_id"] for r in decontaminate.clean(docs, spark.createDataFrame(items, "item_id long, text string"), window=window).collect()}
    assert kept == {i for i, x in expected.items() if not x[1]}


def test_contamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "same line of text"), (2, "another text under the same id same line")], "item_id long, text string")
    out = decontaminate.contamination(odd, items).collect()
    assert len(out) == odd.count()
    assert sorted((r["n_hit"], len(r["hit_items"])) for r in out) == [(0, 0), (0, 0), (4, 1), (4, 1), (4, 1), (10, 2)]
    assert decontaminate.contamination(empty, items).count() == 0
    assert decontaminate.contamination(odd, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.clean(odd, items).columns == odd.columns


# ------------------------------------------------------------- context-tree weighting

class BruteTrees:
    """Recursive context-tree weighting with one dictionary of counts, straight from the definition."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.kids = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for t in texts:
            s = b"\xff" * depth + t + b"\xff"
            for i in range(depth, len(s)):
                for z, bit in self.bits(s[i]):
                    for d in range(depth + 1):
                        self.n[s[i - d:i], z][bit] += 1
                        if d < depth:
                            self.kids[s[i - d:i], z].add(s[i - d - 1:i])
        self.memo = {}

    @staticmethod
    def bits(byte):
        z = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            yield z, bit
            z = 2 * z + bit

    def kt(self, c, z):
        a, b = self.n[c, z] if (c, z) in self.n else (0, 0)
        return math.lgamma(a + .5) + math.lgamma(b + .5) - 2 * math.lgamma(.5) - math.lgamma(a + b + 1)

    def pw(self, c, z):
        if (c, z) not in self.memo:
            kt = self.kt(c, z)
            if len(c) < self.depth:
                down = sum(self.pw(k, z) for k in sorted(self.kids.get((c, z), ())))
                kt = float(np.logaddexp(math.log(.5) + kt, math.log(.5) + down))
            self.memo[c, z] = kt
        return self.memo[c, z]

    def one(self, c, z, context):
        a, b = self.n[c, z] if (c, z) in self.n else (0, 0)
        p = (b + .5) / (a + b + 1)
        if len(c) == self.depth:
            return p
        w = math.exp(math.log(.5) + self.kt(c, z) - self.pw(c, z))
        return w * p + (1 - w) * self.one(context[len(context) - len(c) - 1:], z, context)

    def score(self, t):
        s, total = b"\xff" * self.depth + t + b"\xff", 0.0
        for i in range(self.depth, len(s)):
            for z, bit in self.bits(s[i]):
                p = self.one(b"", z, s[i - self.depth:i])
                total += math.log10(p if bit else 1 - p)
        return total


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_scores(spark, rows, depth):
    data = [(r[0], r[1]) for r in rows if len(r[1] or "") < 400][:60]
    learn = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = as_dict(ctw.score(df, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, depth=depth))
    plain = {i: lower(t or "") for i, t in data}
    trees = BruteTrees([plain[i].encode() for i in plain if learn(i)], depth)
    count = Counter(w for i in plain if learn(i) for w in [*words_of(plain[i]), None])
    n, v = sum(count.values()), len(count)
    for i, t in plain.items():
        tokens = [*words_of(t), None]
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            not learn(i), len(tokens), sum(count[w] > 0 for w in tokens), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens), rel=1e-9)
        assert r["score"] == pytest.approx(trees.score(t.encode()), rel=1e-9, abs=1e-9)


def test_kt_of_large_counts():
    a = np.array([0, 3, 16383, 16384, 50_000, 10**7, 10**9])
    for x in a:
        got = ctw.log_kt(np.array([x]), a.copy()[:1] + 7)[0]
        want = math.lgamma(x + .5) + math.lgamma(7.5) - 2 * math.lgamma(.5) - math.lgamma(x + 8)
        assert got == pytest.approx(want, rel=1e-6, abs=1e-4)  # sums near 1e10 cancel


def test_the_model_predicts_held_out_text(spark, rows):
    """Code length of held-out documents is far below 8 bits a byte, and junk costs more than prose."""
    rnd = random.Random(9)
    junk = [(10_000 + i, "".join(chr(rnd.randint(33, 126)) for _ in range(300))) for i in range(20)]
    data = [(r[0], r[1]) for r in rows if r[1] and len(r[1]) > 100] + junk
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = ctw.score(df, F.col("doc_id") % 3 != 0).collect()
    held = [r["bits_per_byte"] for r in got if r["held_out"] and r["doc_id"] < 1000]
    odd = [r["bits_per_byte"] for r in got if r["held_out"] and r["doc_id"] >= 10_000]
    assert np.mean(held) < 4 and min(odd) > np.mean(held) + 1


def test_no_group_grows_with_the_number_of_parts(spark, rows, monkeypatch, tmp_path):
    """Many parts of one hot byte pair: the groups hold a few of them each, and scores are the same."""
    data = [(r[0], r[1]) for r in rows if len(r[1] or "") < 400][:40] + [(1000 + i, f"hot hot hot {i}") for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    learn = F.col("doc_id") % 5 != 0
    whole = as_dict(ctw.score(df, learn))
    monkeypatch.setattr(ctw, "PART_BYTES", 10)
    monkeypatch.setattr(ctw, "PARTS", 8, raising=False)
    monkeypatch.setattr(ctw, "MERGED", 3, raising=False)
    kind, folder = type(df.groupBy("doc_id")), str(tmp_path)

    def frame(self, f, schema, apply=kind.applyInPandas):
        def seen(key, group):
            open(f"{folder}/{len(group)}", "w").close()
            return f(key, group)
        return apply(self, seen, schema)

    monkeypatch.setattr(kind, "applyInPandas", frame)
    cut = as_dict(ctw.score(df, learn))
    assert cut.keys() == whole.keys()
    for i, r in whole.items():
        assert cut[i] == pytest.approx(r, rel=1e-9)
    assert 1 < max(int(p.name) for p in tmp_path.iterdir()) < 30  # all parts of the hot pair: 60 and more


def test_score_odd_rows(odd, empty):
    out = ctw.score(odd, F.col("doc_id") == 1).collect()
    assert len(out) == odd.count() and all(r["score"] < 0 for r in out)
    nothing = ctw.score(odd, F.lit(False)).collect()
    assert nothing[0]["train_tokens"] == 0
    assert all(r["bits_per_byte"] == pytest.approx(8) for r in nothing)
    assert ctw.score(empty, F.lit(True)).count() == 0


# ------------------------------------------------------------- helpers

def test_broadcasts_are_bounded_by_rows_and_bytes(spark):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(20)], "k long, t string")
    assert common.small_side(df)[1]
    assert not common.small_side(df, rows=19)[1]
    assert not common.small_side(df, size=2000)[1]  # few rows, but long ones
    assert common.small_side(df.limit(0))[1]
