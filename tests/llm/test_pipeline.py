"""The stages of the corpus pipeline, and the whole of it, against plain Python."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline as cp
from llm_helpers import make_docs
from strata.llm.queries import tokenizer_path
from strata.llm.tokens import encoder
from test_dedup import brute_components, brute_fingerprint, brute_lines
from test_rules_archives_lm import brute_contamination, brute_counts
from test_tokens_packing import check_packing, library

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item"), (3, None)]


def rows_of(seed=11):
    """Documents of the fixtures; some with a passage of an item, long copies and near copies; a bad host."""
    rnd = random.Random(seed)
    out = [list(r) for r in make_docs(seed, 80)]
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(400)]
    for k in range(12):
        words = list(base)
        if k % 2:
            words[rnd.randrange(400)] = f"changed{k}"
        out.append([500 + k, " ".join(words), "en", "src1", 1])
    for k in range(6):
        own = [f"v{rnd.randint(0, 9000)}" for _ in range(120)]
        own[60:60] = (ITEM[0][1] if k < 3 else ITEM[1][1]).split()
        out.append([600 + k, " ".join(own), "en", "src2", 1])
    for k in range(60):
        own = " ".join(f"u{rnd.randint(0, 9000)}" for _ in range(80))
        out.append([700 + k, own if k % 6 == 0 else "junk", "en", "farm", 1])
    return [tuple(r) for r in out]


def kept_by_quality(rows):
    """Documents by the rules of the operator's docstring, with the beta prior in plain Python."""
    count = {i: brute_counts(t) for i, t, *_ in rows}
    lines = {i: sum(bool(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")) for i, t, *_ in rows}

    def fails(i):
        c, n = count[i], count[i]["n_words"]
        return [n < 50, 100 * c["n_repeat_words"] > 50 * n, 100 * c["n_symbols"] > 10 * n,
                100 * c["n_dup_lines"] > 30 * lines[i], not 3 * n <= c["word_chars"] <= 10 * n]

    hosts = defaultdict(list)
    for i, _, _, host, _ in rows:
        hosts[host].append(fails(i))
    rejected = set()
    for r in range(5):
        docs = {h: len(x) for h, x in hosts.items()}
        bad = {h: sum(f[r] for f in x) for h, x in hosts.items()}
        n, k = sum(docs.values()), sum(bad.values())
        m = k / n
        spread = sum(bad[h] ** 2 / docs[h] for h in hosts) - n * m * m
        weight = n - sum(d * d for d in docs.values()) / n
        v = (spread - (len(hosts) - 1) * m * (1 - m)) / weight
        s = min(max(m * (1 - m) / v - 1, 1.0), 1e6) if v > 0 else 1e6
        rejected |= {h for h in hosts if (bad[h] + m * s) / (docs[h] + s) > max(min(max(3 * m, 0.25), 0.5), 1.25 * m)}
    return [r for r in rows if not any(fails(r[0])[:2]) and r[3] not in rejected], rejected


def brute_stages(rows):
    """The rows after each stage but the last."""
    first, rejected = kept_by_quality(rows)
    lines = brute_lines(first)
    second = [(i, lines[i][2], lang, host, len(lines[i][2])) for i, _, lang, host, _ in first]
    root = brute_components({i: brute_fingerprint(t) for i, t, *_ in second}, 4)
    third = [r for r in second if root[r[0]] == r[0]]
    hit = brute_contamination(third, ITEM, 10)
    return [first, second, third, [r for r in third if not hit[r[0]][1]]], rejected


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows_of(), COLUMNS).repartition(4).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(ITEM, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_every_stage_equals_plain_python(spark, folder):
    want, rejected = brute_stages(rows_of())
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for (name, stage), expected in zip(cp.STAGES[:-1], want, strict=True):
        docs = cp.common.store(stage(spark, docs, folder), f"test-{name}")
        got = sorted((r["doc_id"], r["text"] or "", r["lang"], r["source"]) for r in docs.collect())
        assert got == sorted((i, t or "", lang, host) for i, t, lang, host, _ in expected), name
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")]
        sizes.append(len(got))
    assert "farm" in rejected and sizes[0] > sizes[1] >= sizes[2] > sizes[3] > sizes[4] > 20


def test_run_packs_what_is_left(spark, folder):
    left = brute_stages(rows_of())[0][-1]
    enc = encoder(tokenizer_path("byte_bpe_50k.json"))
    expected = {i: [*library(enc, t), 1] for i, t, *_ in left}
    got = cp.run(spark, folder)
    check_packing([r.asDict() for r in got.collect()], expected, 2048)


def test_own_columns_named_like_results_stay(spark, folder):
    text = " ".join(f"w{i}" for i in range(70))
    docs = spark.createDataFrame(
        [(1, text, "s", 777, "mine", 5, "x", 9), (2, text + " more words here", "s", 778, "yours", 6, "y", 8)],
        "doc_id long, text string, source string, n_words long, kept string, n_dropped int, Base_Failed string, n_lines long")
    want = sorted(tuple(r) for r in docs.drop("text").collect())
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        got = sorted(tuple(r) for r in out.drop("text").collect())
        assert got == (want if name != "simhash_near_dedup" else got) and set(got) <= set(want), name


def test_odd_rows_and_empty_tables_go_through(spark, odd, empty, folder):
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, odd, folder).columns == odd.columns, name
        assert stage(spark, odd, folder).count() <= odd.count()
        out = stage(spark, empty, folder)
        assert out.columns == empty.columns and out.count() == 0, name
    assert cp.STAGES[-1][1](spark, empty, folder).count() == 0
    assert cp.STAGES[-1][1](spark, odd, folder).count() >= odd.count()
