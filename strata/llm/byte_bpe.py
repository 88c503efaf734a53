"""Byte-level BPE encoding and decoding without a regular expression (operator 13).

1. A run of texts becomes one array of code points and one array of their classes (letter, number, white
   space, other, and the few characters that contractions are made of).
2. Where a pre-token begins depends on what is before it through a small automaton. Each class is a function
   from state to state, functions compose, and composition is associative, so the states after all characters
   are a prefix scan: a table holds the composition of any two functions, blocks are scanned side by side,
   then the blocks' totals, then every block after what is before it. The first character of a text is a
   constant function, which keeps texts apart.
3. A character begins a pre-token by its class and the states around it (a table and two look-aheads).
4. Distinct slices are merged once, lowest rank first and all new ones of a run side by side, and remembered
   (bounded in bytes; those that were not used for a while are forgotten).
   ``ends``, the byte position after each token, is kept beside the ids; decoding joins the tokens' bytes and
   uses it to return any range of tokens.

The pattern is the one of the rank files:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import spans

# classes of characters: the last four are letters too (contractions are 's 't 'm 'd, 're 've, 'll)
OTHER, QUOTE, NUMBER, WHITE, SPACE, LETTER, E, L, RV, STMD = range(10)
# states: nothing yet, in a run of letters, numbers or others, after white space, after a quote that may begin
# a contraction, after such a quote and r or v, after such a quote and l, after a whole contraction
START, LETTERS, NUMBERS, OTHERS, SPACED, WHITED, QUOTED, QUOTED_RV, QUOTED_L, SHORT = range(10)
_N = 10
_BLOCK = 256
_STEP = 1 << 20  # bytes of text in a run
_LONG = 64  # bytes of a piece beyond which the lowest pair comes from a heap
REMEMBERED = 32 << 20
_ENTRY = 170
_BITS = 20
_EMPTY = np.uint64(2**64 - 1)
NONE = np.uint64(2**32 - 1)


# ------------------------------------------------------------- classes

def class_table() -> bytes:
    """The class of every code point, compressed. Letters, numbers and white space are those that the installed
    library's pattern engine knows (its Unicode version may differ from Python's): a pattern of one class keeps
    its members and drops all else."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        own = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        table[np.frombuffer(bytes(own).decode().encode("utf-32-le"), dtype=np.uint32)] = kind
    for letters, kind in ((" ", SPACE), ("'", QUOTE), ("e", E), ("l", L), ("rv", RV), ("stmd", STMD)):
        table[[ord(c) for c in letters]] = kind
    return zlib.compress(table.tobytes())


# ------------------------------------------------------------- the automaton

def _next(state: int, kind: int) -> int:
    """The state after a character of class ``kind``."""
    if kind >= LETTER:
        if state == QUOTED and kind in (STMD, RV, L):
            return {STMD: SHORT, RV: QUOTED_RV, L: QUOTED_L}[kind]
        if (state, kind) in ((QUOTED_RV, E), (QUOTED_L, L)):
            return SHORT
        return LETTERS
    if kind == QUOTE:  # after a space or inside a run of others it is an ordinary character
        return OTHERS if state in (OTHERS, QUOTED, SPACED) else QUOTED
    return {OTHER: OTHERS, NUMBER: NUMBERS, WHITE: WHITED, SPACE: SPACED}[kind]


def _begins(state: int, kind: int) -> bool:
    """Whether a character of class ``kind`` after ``state`` begins a pre-token, but for the two look-aheads of
    ``starts``: the last of several white-space characters, and r, v or l after a quote."""
    if state in (START, SHORT):
        return True
    if kind in (WHITE, SPACE):
        return state not in (SPACED, WHITED)
    if state == SPACED:
        return False  # one space belongs to what follows it
    if state in (LETTERS, QUOTED_RV, QUOTED_L):
        return kind < LETTER
    if state in (OTHERS, QUOTED):
        return kind not in (OTHER, QUOTE, *((STMD,) if state == QUOTED else ()))
    return not (state == NUMBERS and kind == NUMBER)


class Machine(NamedTuple):
    """The functions that classes generate: ``compose[a * n + b]`` is a then b, ``of[class]`` the function of a
    class (``of[class + 10]`` if it is the first character of a text), ``after`` the state each leads to from START."""

    n: int
    compose: np.ndarray
    of: np.ndarray
    after: np.ndarray
    begins: np.ndarray


@lru_cache(maxsize=1)
def machine() -> Machine:
    single = [tuple(_next(s, k) for s in range(_N)) for k in range(_N)]
    first = [(f[START],) * _N for f in single]
    known = {tuple(range(_N)): 0}  # the identity pads blocks
    todo = list(known)
    for f in todo:
        for g in (*single, *first):
            h = tuple(g[s] for s in f)
            if h not in known:
                known[h] = len(known)
                todo.append(h)
    n = len(todo)
    compose = np.array([[known[tuple(g[s] for s in f)] for g in todo] for f in todo], dtype=np.uint16)
    return Machine(n, compose.ravel(), np.array([known[f] for f in (*single, *first)], dtype=np.uint16),
                   np.array([f[START] for f in todo], dtype=np.uint8),
                   np.array([[_begins(s, k) for k in range(_N)] for s in range(_N)]).ravel())


def scan(functions: np.ndarray) -> np.ndarray:
    """Compositions of all prefixes of ``functions`` (indices into the machine)."""
    m = machine()
    n = len(functions)
    rows = -(-n // _BLOCK)
    columns = np.zeros(rows * _BLOCK, dtype=np.uint16)
    columns[:n] = functions
    columns = np.ascontiguousarray(columns.reshape(rows, _BLOCK).T)
    for j in range(1, _BLOCK):
        columns[j] = m.compose[columns[j - 1].astype(np.int32) * m.n + columns[j]]
    if rows > 1:
        before = scan(columns[-1])
        columns[:, 1:] = m.compose[before[None, :-1].astype(np.int32) * m.n + columns[:, 1:]]
    return columns.T.ravel()[:n]


def starts(kinds: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each character, whether it begins a pre-token. ``first``: whether it begins a text."""
    m = machine()
    n = len(kinds)
    state = m.after[scan(m.of[kinds + _N * first.astype(np.uint8)])]
    before = np.zeros(n, dtype=np.uint8)
    before[1:] = state[:-1]
    before[first] = START
    out = m.begins[before * np.uint8(_N) + kinds]
    more = np.zeros(n, dtype=bool)  # whether a character of the same text follows
    more[:-1] = ~first[1:]
    white = (kinds == WHITE) | (kinds == SPACE)
    last = white & more  # the last of several white-space characters goes with what follows
    last[1:] &= white[:-1]
    last[:1] = False
    last[first] = False
    last[:-1] &= ~white[1:]
    out[last] = True
    at = np.flatnonzero((state == QUOTED_RV) | (state == QUOTED_L))
    whole = more[at]
    whole[whole] = state[at[whole] + 1] == SHORT
    out[at] = ~whole
    return out


# ------------------------------------------------------------- pieces

class Pairs:
    """Which two tokens form a token: a hash table in one array, looked up for many pairs at once. A slot holds
    both ids and the rank of what they form (``_BITS`` bits each); a full slot sends a pair to the next one."""

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= 1 << _BITS:
            raise ValueError(f"ranks of at most {_BITS} bits are supported")
        found = [(ranks[t[:i]] << _BITS | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs, rank = np.array(found, dtype=np.uint64).reshape(-1, 2).T
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        self.slots = np.full(1 << int(np.uint64(64) - self.shift), _EMPTY, dtype=np.uint64)
        self.depth, slot = 0, self._slot(pairs)
        while len(pairs):  # every free slot takes the first pair that asks for it
            slot, order = np.unique(slot, return_index=True)
            free = self.slots[slot] == _EMPTY
            own = order[free]
            self.slots[slot[free]] = pairs[own] << np.uint64(_BITS) | rank[own]
            left = np.ones(len(pairs), dtype=bool)
            left[own] = False
            pairs, rank = pairs[left], rank[left]
            self.depth += 1
            slot = (self._slot(pairs) + self.depth) % len(self.slots)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` if the two form no token."""
        pairs = a.astype(np.uint64) << np.uint64(_BITS) | b.astype(np.uint64)
        out = np.full(len(pairs), NONE, dtype=np.uint64)
        at, slot = np.arange(len(pairs)), self._slot(pairs)
        for _ in range(self.depth):
            if not len(at):
                break
            found = self.slots[slot]
            same = found >> np.uint64(_BITS) == pairs[at]
            out[at[same]] = found[same] & np.uint64((1 << _BITS) - 1)
            on = ~same & (found != _EMPTY)
            at, slot = at[on], (slot[on] + 1) % len(self.slots)
        return out


def merge_many(pieces: list[bytes], single: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces one after the other, their number for each piece). In a round every unfinished piece
    merges its pair of the lowest rank (the leftmost of equals); a piece without such a pair is finished.
    ``single``: the id of each byte."""
    lens = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    ids = single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
    who = np.arange(len(pieces))
    final = np.zeros(len(ids) + 1, dtype=bool)
    final[np.cumsum(lens) - 1] = True  # the last token of a piece begins no pair
    final = final[:-1]
    rank = np.full(len(ids), NONE, dtype=np.uint64)
    inner = np.flatnonzero(~final)
    rank[inner] = pairs.ranks(ids[inner], ids[inner + 1])
    done = []
    while len(who):
        first = np.cumsum(lens) - lens
        low = np.minimum.reduceat(rank << np.uint64(32) | np.arange(len(ids), dtype=np.uint64), first)
        live = low >> np.uint64(32) != NONE
        if not live.all():
            own = np.repeat(live, lens)
            done.append((who[~live], lens[~live], ids[~own]))
            moved = np.cumsum(own) - 1
            ids, rank, final, who, lens, low = ids[own], rank[own], final[own], who[live], lens[live], low[live]
            if not len(who):
                break
            at = moved[(low & np.uint64(0xFFFFFFFF)).astype(np.int64)]
            first = np.cumsum(lens) - lens
        else:
            at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ids[at] = rank[at]
        final[at] = final[at + 1]
        keep = np.ones(len(ids), dtype=bool)
        keep[at + 1] = False
        begins = at == first
        ids, rank, final, at = ids[keep], rank[keep], final[keep], at - np.arange(len(at))
        lens = lens - 1
        rank[at[final[at]]] = NONE
        on = at[~final[at]]
        rank[on] = pairs.ranks(ids[on], ids[on + 1])
        prior = at[~begins] - 1
        rank[prior] = pairs.ranks(ids[prior], ids[prior + 1])
    who, lens, ids = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(who)
    return ids[spans.ragged((np.cumsum(lens) - lens)[order], lens[order])], lens[order]


def _from_heap(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for one long piece: pairs in a heap by (rank, place); one that changed since is passed over."""
    n = len(piece)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)

    def push(i: int) -> None:
        if i >= 0 and after[i] < n:
            end = after[after[i]]
            r = ranks.get(piece[i:end])
            if r is not None:
                heapq.heappush(heap, (r, i, end))

    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or after[i] >= n or after[after[i]] != end:
            continue
        alive[after[i]] = 0
        after[i] = end
        if end < n:
            before[end] = i
        push(i)
        push(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:after[i]]])
        i = after[i]
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, f.read().splitlines()))}


class Codec:
    """Encoding and decoding with one rank file. ``limit``: bytes of the pieces that a worker remembers."""

    def __init__(self, path: str, table: bytes, limit: int = REMEMBERED):
        self.ranks = read_ranks(path)
        self.table = np.frombuffer(zlib.decompress(table), dtype=np.uint8)
        size = max(self.ranks.values()) + 1
        self.width = np.zeros(size, dtype=np.int64)
        for token, rank in self.ranks.items():
            self.width[rank] = len(token)
        self.place = np.cumsum(self.width) - self.width
        ordered = sorted(self.ranks.items(), key=lambda item: item[1])
        self.pool = np.frombuffer(b"".join(token for token, _ in ordered), dtype=np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.uint64)
        self.pairs = Pairs(self.ranks)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.limit, self.held = limit, 0

    def ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian unsigned 32-bit integers; new ones are merged together."""
        ranks = self.ranks
        out = [self.known.get(p) for p in pieces]
        new = [i for i, ids in enumerate(out) if ids is None]
        many = []
        for i in new:
            p = pieces[i]
            out[i] = self.older.get(p)
            if out[i] is not None:
                continue
            one = ranks.get(p)
            if one is not None:
                out[i] = one.to_bytes(4, "little")
            elif len(p) > _LONG:
                out[i] = np.array(_from_heap(p, ranks), dtype="<u4").tobytes()
            else:
                many.append(i)
        if many:
            ids, lens = merge_many([pieces[i] for i in many], self.single, self.pairs)
            raw, end = ids.astype("<u4").tobytes(), (4 * np.cumsum(lens)).tolist()
            for i, a, b in zip(many, [0, *end], end):
                out[i] = raw[a:b]
        for i in new:
            self.held += len(pieces[i]) + len(out[i]) + _ENTRY
            if 2 * self.held > self.limit:
                self.older, self.known = self.known, {}
                self.held = len(pieces[i]) + len(out[i]) + _ENTRY
            self.known[pieces[i]] = out[i]
        return out

    def pieces(self, texts: spans.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begins, ends, first): byte spans of all pre-tokens, and the index of each text's first one."""
        data, offs = texts
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each character
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        first = np.zeros(len(lead), dtype=bool)
        first[np.searchsorted(lead, offs[:-1][offs[:-1] < offs[1:]])] = True
        begins = lead[starts(self.table[points], first)]
        return begins, np.append(begins[1:], len(data)), np.searchsorted(begins, offs)

    def run(self, texts: spans.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, index of each text's first id)."""
        if len(texts.data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        begins, ends, first = self.pieces(texts)
        _, inverse, _ = spans.group(spans.hash_spans(texts.data, begins, ends))
        sample = np.empty(int(inverse.max()) + 1, dtype=np.int64)
        sample[inverse] = np.arange(len(inverse))
        whole = texts.data.tobytes()
        found = self.ids_of([whole[a:b] for a, b in zip(begins[sample].tolist(), ends[sample].tolist(), strict=True)])
        lens = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        count = lens[inverse]
        ids = pool[spans.ragged((np.cumsum(lens) - lens)[inverse], count)]
        return ids, np.concatenate([[0], np.cumsum(count)])[first]

    def encode(self, column: pa.Array, step: int = _STEP) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, ids, ends, index of each row's first id) for runs of rows of about ``step`` bytes;
        ``ends`` is the byte position in its text after each token."""
        texts = spans.texts_of(column)
        row = 0
        while row < len(texts):
            to = max(row + 1, int(np.searchsorted(texts.offsets, texts.offsets[row] + step, side="right")) - 1)
            o = texts.offsets[row:to + 1]
            ids, first = self.run(_valid(spans.Texts(texts.data[o[0]:o[-1]], o - o[0])))
            reach = np.concatenate([[0], np.cumsum(self.width[ids])])
            yield row, ids, reach[1:] - np.repeat(reach[first[:-1]], np.diff(first)), first
            row = to

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, one after the other."""
        return self.pool[spans.ragged(self.place[ids], self.width[ids])]


def _valid(texts: spans.Texts) -> spans.Texts:
    """``texts`` as valid UTF-8: bytes that are not become U+FFFD, as Python decodes them."""
    try:
        texts.data.tobytes().decode()
        return texts
    except UnicodeDecodeError:
        each = [texts.bytes(i).decode("utf-8", "replace").encode() for i in range(len(texts))]
        return spans.Texts(np.frombuffer(b"".join(each), dtype=np.uint8),
                           np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64))


@lru_cache(maxsize=1)
def codec(path: str, table: bytes) -> Codec:
    """The Python worker's codec (loaded once)."""
    return Codec(path, table)


# ------------------------------------------------------------- DataFrames

def _id_type(docs: DataFrame, id_col: str) -> tuple[str, pa.DataType]:
    return ("string", pa.string()) if docs.schema[id_col].dataType.typeName() == "string" else ("long", pa.int64())


def _encoded(batches: Iterator[pa.RecordBatch], path: str, table: bytes) -> Iterator[pa.RecordBatch]:
    """Batches (id, text) as batches (id, ids, ends)."""
    for b in batches:
        for row, ids, ends, first in codec(path, table).encode(b.column(1)):
            at = pa.array(first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(row, len(first) - 1),
                 pa.ListArray.from_arrays(at, pa.array(ids.astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(ends, pa.int64()))], names=[b.schema.names[0], "ids", "ends"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, table: bytes, first: int,
             last: int | None) -> Iterator[pa.RecordBatch]:
    """Batches (id, ids, ends) as batches (id, n_tokens, ids_sha256, decoded)."""
    for b in batches:
        ids, ends = ([np.asarray(x.values) if x.is_valid else np.zeros(0, np.int64) for x in b.column(k)] for k in (1, 2))
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        hashes, texts = [], []
        for k, (x, end) in enumerate(zip(ids, ends, strict=True)):
            raw = codec(path, table).decode(x).tobytes()
            lo, hi = np.concatenate([[0], end])[[min(first, len(x)), len(x) if last is None else min(last, len(x))]]
            hashes.append(hashlib.sha256(x.astype("<u4").tobytes()).hexdigest())
            texts.append(raw[lo:hi])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(counts), pa.array(hashes, pa.string()), pa.array(texts, pa.binary())],
            names=[b.schema.names[0], "n_tokens", "ids_sha256", "decoded"])


def encode(docs: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``ids`` and ``ends`` (byte position in the UTF-8 text after each token), as
    the library encodes the whole text without special tokens.

    Null and empty texts have no ids. Repeated rows and null ids are all returned; an empty table gives an empty
    table. Other columns are ignored. ``ranks``: a rank file that every worker can open.
    """
    kind, _ = _id_type(docs, id_col)
    table = class_table()
    rows = docs.select(F.col(id_col).cast(kind).alias(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _encoded(batches, ranks, table),
                           f"`{id_col}` {kind}, ids array<int>, ends array<bigint>")


def decode(encoded: DataFrame, ranks: str, *, id_col: str = "doc_id", first: int = 0, last: int | None = None) -> DataFrame:
    """Per row of ``encode``'s result: ``id_col``, ``n_tokens``, ``ids_sha256`` (lowercase hex, of the ids as
    little-endian unsigned 32-bit integers) and ``decoded``, the bytes of tokens ``first`` to ``last`` (all of
    them by default), cut by ``ends``. Null ids and a null list decode to no bytes."""
    kind, _ = _id_type(encoded, id_col)
    table = class_table()
    return encoded.select(F.col(id_col).cast(kind).alias(id_col), "ids", "ends").mapInArrow(
        lambda batches: _decoded(batches, ranks, table, first, last),
        f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded binary")


def round_trip(docs: DataFrame, ranks: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass over the rows: the ids of a run of texts are decoded where they were
    made and do not travel."""
    kind, _ = _id_type(docs, id_col)
    table = class_table()
    rows = docs.select(F.col(id_col).cast(kind).alias(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _decoded(_encoded(batches, ranks, table), ranks, table, 0, None),
                           f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded binary")
