"""Token counts of sections and fields by offset mapping (operator 5).

A document is encoded once, as a whole: encoding its sections one by one would give other ids, because
tokens cross their boundaries. Every token has a character span; an interval join (a binary search in the
sorted section starts) gives each token to one section, and a token that crosses a boundary is allocated
by an explicit rule:

* ``first``: the section that holds its first character;
* ``last``: the section that holds its last character;
* ``most``: the section that holds most of its characters, the earliest of equals.

Counts of a document's sections therefore add up to the document's own count. Spans come from the
vocabulary: a byte-level token stands for a known number of bytes, so the running sum of those is the
offset map (a character whose bytes are shared by tokens belongs to each of them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common, spans
from strata.llm.tokens import encoder

RULES = ("first", "last", "most")
_BYTES: dict[str, np.ndarray] = {}


def token_bytes(path: str) -> np.ndarray:
    """Bytes each id of a byte-level vocabulary stands for."""
    if path not in _BYTES:
        enc = encoder(path)
        if not enc.space or enc.normalizer is not None:
            raise ValueError("the offset map needs a byte-level vocabulary that changes no character")
        added = {i: t.content for i, t in enc.tok.get_added_tokens_decoder().items()}
        size = np.zeros(max([enc.vocab - 1, *added]) + 1, dtype=np.int64)
        for token, i in enc.tok.get_vocab(with_added_tokens=True).items():
            size[i] = len(added[i].encode()) if i in added else len(token)  # one character a byte
        _BYTES[path] = size
    return _BYTES[path]


def allocate(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, data: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary) for byte spans ``[begin, end)`` and ascending
    section ``starts``. Of sections that start together all but the last are empty."""
    first = np.searchsorted(starts, begin, side="right") - 1
    last = np.searchsorted(starts, end - 1, side="right") - 1
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    out = first.copy()
    whole = (data & 0xC0) != 0x80  # first bytes of characters
    for t in np.flatnonzero(crossing):
        bounds = np.unique(np.concatenate([[begin[t]], starts[first[t] + 1:last[t] + 1], [end[t]]]))
        chars = np.add.reduceat(whole[begin[t]:end[t]].astype(np.int64), bounds[:-1] - begin[t])
        out[t] = np.searchsorted(starts, bounds[int(np.argmax(chars))], side="right") - 1
    return out, crossing


def _run(texts: spans.Texts, ids: np.ndarray, offs: np.ndarray, starts: np.ndarray, size: np.ndarray, rule: str):
    """Per section: (tokens, crossing tokens, first character in the run, characters)."""
    n = size[ids]
    end = np.cumsum(n)
    if len(texts.data) != (end[-1] if len(end) else 0):
        raise ValueError("token spans do not cover the texts")
    section, crossing = allocate(end - n, end, starts, texts.data, rule)
    chars = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    begin = chars[starts]
    return (np.bincount(section, minlength=len(starts)), np.bincount(section[crossing], minlength=len(starts)),
            begin, np.diff(begin, append=chars[-1]))


def _sections(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, cut, rule: str, extra: list[str]) -> DataFrame:
    """Rows per section; ``cut(texts, batch, row)`` gives (section starts, text of each section) of a run."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    text_id = docs.schema[id_col].dataType.typeName() == "string"
    ident = F.col(id_col) if text_id else F.col(id_col).cast("long")
    names = common.internal(docs.limit(0), "__id", "__text")
    rows = docs.select(ident.alias(names[0]), F.col(text_col).alias(names[1]), *extra)
    schema = pa.schema([(id_col, pa.string() if text_id else pa.int64())] + [(c, pa.int64()) for c in (
        "section", "start_char", "n_chars", "n_tokens", "n_crossing", "doc_tokens")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, size = encoder(tokenizer), token_bytes(tokenizer)
        for b in batches:
            every = spans.texts_of(b.column(1))
            for row, ids, offs in enc.encode(b.column(1)):
                n = len(offs) - 1
                o = every.offsets[row:row + n + 1]
                texts = spans.Texts(every.data[o[0]:o[-1]], o - o[0])
                starts, owner = cut(texts, b, row)
                tokens, crossing, begin, chars = _run(texts, ids, offs, starts, size, rule)
                new = np.ones(len(owner), dtype=bool)
                new[1:] = owner[1:] != owner[:-1]
                at = np.flatnonzero(new)
                number = np.arange(len(owner)) - np.repeat(at, np.diff(at, append=len(owner)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(owner + row)), pa.array(number),
                     pa.array(begin - begin[at][owner]), pa.array(chars), pa.array(tokens), pa.array(crossing),
                     pa.array(np.diff(offs)[owner])], schema=schema)

    out = f"`{id_col}` {'string' if text_id else 'long'}, " + ", ".join(f"{f.name} long" for f in list(schema)[1:])
    return rows.mapInArrow(count, out)


def count_lines(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                rule: str = "first") -> DataFrame:
    """Tokens per line of whole texts. A line holds the newline that ends it; a text that ends with one has
    an empty last line, and a null or empty text is one empty line without tokens.

    Returns a row per line: ``id_col``, ``section`` (from 0), ``start_char``, ``n_chars``, ``n_tokens``,
    ``n_crossing`` (tokens allocated here that reach into another line) and ``doc_tokens``. Repeated rows and
    null ids are kept; other columns are ignored; an empty table gives an empty result.
    """

    def cut(texts: spans.Texts, batch: pa.RecordBatch, row: int):
        lines = np.flatnonzero(texts.data == 10) + 1
        owner = np.searchsorted(texts.offsets, lines - 1, side="right") - 1
        starts = np.concatenate([texts.offsets[:-1], lines])
        owner = np.concatenate([np.arange(len(texts)), owner])
        order = np.lexsort((starts, owner))
        return starts[order], owner[order]

    return _sections(docs, tokenizer, id_col, text_col, cut, rule, [])


def count_fields(docs: DataFrame, tokenizer: str, fields: list[str], *, id_col: str = "doc_id",
                 separator: str = "\n", rule: str = "first") -> DataFrame:
    """Tokens per field of a document made of ``fields`` joined by ``separator`` (null fields are empty; the
    separator belongs to the field before it). Rows as in ``count_lines``; ``section`` numbers the fields."""
    whole, size = common.internal(docs, "__whole", "__sizes")
    texts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    joined = docs.withColumn(size, F.array(*[F.octet_length(t) for t in texts])).withColumn(whole, F.concat_ws(separator, *texts))
    gap = len(separator.encode())

    def cut(run: spans.Texts, batch: pa.RecordBatch, row: int):
        n = np.array(batch.column(2).slice(row, len(run)).to_pylist(), dtype=np.int64).reshape(len(run), len(fields)) + gap
        starts = run.offsets[:-1, None] + np.cumsum(n, axis=1) - n
        return starts.ravel(), np.repeat(np.arange(len(run)), len(fields))

    return _sections(joined, tokenizer, id_col, whole, cut, rule, [size])
