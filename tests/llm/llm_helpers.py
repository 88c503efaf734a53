"""Small helpers of the tests in this folder."""

import random
import re

SPACES = " \t\n\x0b\x0c\r"


def as_dict(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def make_docs(seed: int = 3, n: int = 120) -> list[tuple]:
    """Small documents with copies, near copies, repeated lines, odd white space, nulls, a very long text,
    a hot source and hot lines."""
    rnd = random.Random(seed)
    syllables = ["the", "an", "ti", "on", "er", "é", "ü", "sch", "re", "in", "THE", "Ed", "ö", "ing"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))
    lines = [" ".join(word() for _ in range(rnd.randint(3, 8))) for _ in range(6)]
    out = []
    for i in range(n):
        kind = rnd.random()
        body = [word() for _ in range(rnd.choice([5, 30, 80, 200]))]
        if kind < 0.2:
            text = " ".join([*body, passage, word()])
        elif kind < 0.4:
            text = "\n".join([" ".join(body), rnd.choice(lines), " ".join(body[:7]), "  " + rnd.choice(lines).upper() + "\t"])
        elif kind < 0.5 and out:
            text = rnd.choice(out)[1]
        elif kind < 0.6 and out:
            text = (rnd.choice(out)[1] or "") + " " + word()
        elif kind < 0.65:
            text = " ".join(["spam spam eggs"] * 40)
        else:
            text = "  ".join(body) + rnd.choice(["", "\n", " \n\n ", "***", " x", "<|endoftext|>", "…"])
        out.append((i, text, "en", "src0" if rnd.random() < 0.4 else f"src{rnd.randint(1, 5)}", len(text or "")))
    out.append((n, None, None, None, None))
    out.append((n + 1, "", "en", "src1", 0))
    out.append((n + 2, " \n\t ", "en", "src1", 4))
    out.append((n + 3, " ".join(word() for _ in range(20_000)), "de", "src2", None))
    out.append((n + 4, "x" * 50_000, "de", "src2", 50_000))
    out.append((n + 5, "\n" * 500, "de", "src2", 500))
    return out
