"""Host-level quality rules with shrunken failure rates (operator 4), in DataFrame functions alone.

Each document gets counts from its whole text and a verdict per rule (``rules``). Failures of every rule are summed
by host. For each rule the prior is a beta distribution fitted to the hosts' rates by moments, and a host's rate is
its posterior mean: a host with few documents is drawn towards the mean of all, a host with many speaks for itself.
A host fails a rule if its rate is beyond the rule's limit, which follows from the mean of all hosts (``limit``); a
host that fails any rule is rejected as a whole, and the verdict is joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import common

#: White space of the word rule, for split and for trim.
_SPACE_RUN = r"[\x20\x09-\x0D]+"
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOL = r"[#*$%&|<>]"
_POS_BITS = 22

_LINES = "__word_lines"  # lines with a word, beside the counts
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(positions: Column, size: int) -> Column:
    """Words covered by windows of ``size`` words that begin at sorted ``positions``."""
    overlap = F.aggregate(
        F.zip_with(F.slice(positions, 2, F.greatest(F.size(positions) - 1, F.lit(0))),
                   F.slice(positions, 1, F.greatest(F.size(positions) - 1, F.lit(0))),
                   lambda b, a: F.greatest(F.lit(0), F.lit(size) - (b - a).cast("int"))),
        F.lit(0), lambda s, x: s + x)
    return F.size(positions) * size - overlap


def with_counts(docs: DataFrame, text_col: str = "text", window: int = 3) -> DataFrame:
    """``docs`` with the columns of COUNTS, and the number of lines with a word, from each whole text.

    Repeated windows are found inside the row, without exploding words into a shuffle: window hashes are
    packed with their positions into longs, sorted, and neighbours compared. Texts without a repeated
    window stop after a distinct count; the rare text in which two windows share the packed part of their
    hash, or that has more words than positions fit, is compared on whole hashes.
    """
    w, h, p, s, t, nb = common.internal(docs, "__words", "__hashes", "__packed", "__sorted", "__trimmed", "__lines")
    d = docs.drop(*COUNTS)
    d = d.withColumn(t, F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(_SPACES)))
    d = d.withColumn(w, F.when(F.col(t) == "", F.array().cast("array<string>")).otherwise(F.split(F.col(t), _SPACE_RUN)))
    d = d.withColumn("n_words", F.size(w).cast("long"))
    d = d.withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
    d = d.withColumn("n_symbols", F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(_SYMBOL)).cast("long"))
    d = d.withColumn(nb, F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
                                  lambda x: F.btrim(x, F.lit(_SPACES)) != ""))
    d = d.withColumn("n_dup_lines", (F.size(nb) - F.size(F.array_distinct(nb))).cast("long")).withColumn(_LINES, F.size(nb).cast("long"))
    d = d.withColumn(h, F.when(
        F.size(w) >= window,
        F.transform(F.sequence(F.lit(0), F.size(w) - window),
                    lambda i: F.xxhash64(*[F.get(F.col(w), i + k) for k in range(window)])))
        .otherwise(F.array().cast("array<bigint>")))
    some = F.size(F.array_distinct(h)) < F.size(h)
    packed = F.transform(h, lambda x, i: F.shiftleft(x, _POS_BITS).bitwiseOR(i.cast("long")))
    d = d.withColumn(p, F.when(some & (F.size(h) < 1 << _POS_BITS), F.sort_array(packed)))
    top = lambda x: F.shiftright(x, _POS_BITS)
    clean = F.size(F.array_distinct(F.transform(p, top))) == F.size(F.array_distinct(h))
    beside = F.filter(p, lambda x, i: top(x).eqNullSafe(top(F.get(F.col(p), i - 1)))
                      | top(x).eqNullSafe(top(F.get(F.col(p), i + 1))))
    quick = F.sort_array(F.transform(beside, lambda x: x.bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.withColumn(s, F.when(some & ~F.coalesce(clean, F.lit(False)), pairs))
    exact = F.sort_array(F.transform(
        F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(F.col(s), i - 1)["h"])
                 | x["h"].eqNullSafe(F.get(F.col(s), i + 1)["h"])), lambda x: x["i"].cast("long")))
    positions = F.when(~some, F.array().cast("array<bigint>")).when(F.col(s).isNull(), quick).otherwise(exact)
    d = d.withColumn(p, positions)
    d = d.withColumn("n_repeat_words", _covered(F.col(p), window).cast("long"))
    return d.drop(w, h, p, s, t, nb)


def rules(min_words: int = 50, max_repeat_percent: int = 50, symbol_percent: int = 10, dup_line_percent: int = 30,
          word_length: tuple[int, int] = (3, 10)) -> dict[str, Column]:
    """Whether a document fails each rule, from its counts: too few words, too many of them in repeated windows, too
    many symbols a word, too many repeated lines among those with a word, words that are too short or too long on
    average. The first two are the base rules, which also judge the document by itself."""
    n = F.col("n_words")
    return {
        "words": n < min_words,
        "repeats": 100 * F.col("n_repeat_words") > max_repeat_percent * n,
        "symbols": 100 * F.col("n_symbols") > symbol_percent * n,
        "lines": 100 * F.col("n_dup_lines") > dup_line_percent * F.col(_LINES),
        "length": (F.col("word_chars") < word_length[0] * n) | (F.col("word_chars") > word_length[1] * n),
    }


def limit(mean: Column) -> Column:
    """The highest rate a host may have under a rule that ``mean`` of all documents fail: three times the mean, but at
    least a quarter and at most a half. A host near the mean is never rejected, however bad all are."""
    return F.greatest(F.least(F.greatest(3 * mean, F.lit(0.25)), F.lit(0.5)), mean * 1.25)


def judged(docs: DataFrame, *, host_col: str = "source", text_col: str = "text", **thresholds) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` (the document fails a base rule), ``host_failed`` (the rules that its
    host fails, sorted) and ``kept``: not failed, and the host fails no rule. ``thresholds``: see ``rules``.

    Null and empty texts have no words and fail the base rules. Documents without a host (null) are one host of their
    own. Repeated rows count each. Every row is returned; an empty table gives an empty table. Columns of the result's
    names are replaced, all others pass through.
    """
    fails = rules(**thresholds)
    d = with_counts(docs.drop("base_failed", "host_failed", "kept", _LINES), text_col)
    d = d.withColumn("base_failed", fails["words"] | fails["repeats"])
    d = common.store(d, "quality-counts")
    flags = d.select(F.col(host_col).alias("host"), *(c.alias(name) for name, c in fails.items()))
    hosts = host_verdicts(host_rates(flags, "host", list(fails)), list(fails))
    key, failed = common.internal(d, "__host", "__failed")
    hosts = common.store(hosts.where(F.size("failed") > 0).select(F.col("host").alias(key), F.col("failed").alias(failed)), "quality-hosts")
    # the table of rejected hosts is measured: broadcast while it is small, else a shuffle that splits hot hosts
    verdicts, _ = common.small_side(hosts)
    out = d.drop(_LINES).join(verdicts, F.col(host_col).eqNullSafe(F.col(key)), "left").drop(key)
    out = out.withColumn("host_failed", F.coalesce(failed, F.array().cast("array<string>"))).drop(failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("host_failed") == 0))


def host_rates(flags: DataFrame, host: str, names: list[str]) -> DataFrame:
    """Per host: ``docs`` and for each rule ``failures_<name>``, ``rate_<name>``, the posterior mean
    (failures + a) / (docs + a + b), and ``mean_<name>``, the share of all documents that fail it.

    A rule's beta prior is fitted over the hosts by moments: mean m = all failures / all documents; the variance
    between hosts v is the weighted variance of their rates less what sampling alone gives, m(1-m)(hosts-1)/docs over
    its weight; a + b = m(1-m)/v - 1. Where hosts do not differ beyond chance (v <= 0) all hosts get the mean: a + b
    is held at ``1e6``."""
    per = flags.groupBy(host).agg(F.count(F.lit(1)).alias("docs"), *(F.sum(F.col(n).cast("long")).alias(f"failures_{n}") for n in names))
    squares = [F.sum(F.try_divide(F.col(f"failures_{n}") * F.col(f"failures_{n}"), F.col("docs"))).alias(f"k2_{n}") for n in names]
    total = per.agg(F.sum("docs").alias("n"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("docs") * F.col("docs")).alias("n2"),
                    *(F.sum(f"failures_{n}").alias(f"k_{n}") for n in names), *squares)
    weight = F.col("n") - F.try_divide("n2", "n")

    def prior(name: str) -> tuple[Column, Column]:
        m = F.try_divide(f"k_{name}", "n")
        spread = F.col(f"k2_{name}") - F.col("n") * m * m  # sum of docs * (rate - m)^2
        v = F.try_divide(spread - (F.col("hosts") - 1) * m * (1 - m), weight)
        strength = F.when(v > 0, F.least(F.greatest(F.try_divide(m * (1 - m), v) - 1, F.lit(1.0)), F.lit(1e6))).otherwise(1e6)
        return m.alias(f"m_{name}"), strength.alias(f"s_{name}")

    found = total.select(*(c for name in names for c in prior(name))).first()  # one row, two numbers a rule
    out = []
    for n in names:
        mean, strength = F.lit(float(found[f"m_{n}"] or 0.0)), F.lit(float(found[f"s_{n}"]))
        out += [F.col(f"failures_{n}"), F.try_divide(F.col(f"failures_{n}") + mean * strength, F.col("docs") + strength).alias(f"rate_{n}"),
                mean.alias(f"mean_{n}")]
    return per.select(host, "docs", *out)


def host_verdicts(rates: DataFrame, names: list[str]) -> DataFrame:
    """``rates`` with ``failed``: the rules whose limit the host's rate is beyond, sorted."""
    failed = F.array_sort(F.array_compact(F.array(*(
        F.when(F.col(f"rate_{n}") > limit(F.col(f"mean_{n}")), F.lit(n)) for n in names))))
    return rates.withColumn("failed", failed)
