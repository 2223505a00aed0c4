"""Language-model scores from a hierarchical Pitman-Yor model (operator 4).

Tokens of a text: lower-cased (A-Z) words, then one end. The model has a
restaurant per preceding token (the end, before a text's first); all of them
share the token restaurant as parent. Its base spells tokens by bytes, the
nested Pitman-Yor construction: byte restaurants, one per context of up to
``CONTEXT`` preceding bytes, share parents with a byte less down to the empty
context above a uniform base. Customers of the pair restaurants are all
training tokens; each of their tables sends a customer to the token
restaurant; each table there sends the token's spelling, byte by byte, to the
byte restaurants; each table there sends a customer to the parent.

Seating is sampled by blocked Gibbs steps. Given all else, the number of
tables t that serve one dish to c customers has weight

    S_d(c, t) * product over j < t of (theta + d * (T_other + j)) * p ** t

(S_d: generalised Stirling numbers, T_other: tables of other dishes, p: the
parent's predictive probability). It is drawn exactly up to ``EXACT``
customers and carried on beyond by the expected number of new tables with
normal noise. A draw uses a number derived from the dish and round, so it is
the same on any partitioning. The first round seats every pair at one table.
After ``burn_in`` rounds the predictive probabilities of ``samples`` rounds
are averaged.

At scale: words are dealt to parts by ranges of their 64-bit hashes, pairs by
a mix of their words' hashes; a part keeps its words or pairs as arrays in one
row, and tasks move arrays, not rows. A block of documents keeps its distinct
words, by hash, and its tokens as places among them; its pairs are made anew
from these where they are dealt and where they are scored, in the order of
their words' hashes. It sends each part the distinct words and pairs it holds,
counted, and gets the answers in the same order: counts, tables and customers,
from which it makes the probabilities of its words. A pair that occurs once
has one table in every round, so it sends its customers once, and only
repeated pairs are drawn: in a round, a pair part sends the word parts the
tables of the words it needs and gets back their prices, and the first time
the words, for the draws' numbers. Different words of one hash are an error.
Only the byte restaurants are broadcast. Their depth is the same at every size,
and so low that the alphabet bounds them: ``SYMBOLS`` entries a context, and at most 256 ** ``CONTEXT`` contexts.

Defined results: null and empty texts have the end token only. A null id is
trained on and scored like others; repeated rows count as often as they
occur. Without training tokens the score is the spelling model's uniform
base. An empty table gives an empty result. Only id and text are used, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, table

#: Deepest context in bytes.
CONTEXT = 2
END = b"\n"  # no word holds it; also fills contexts before a token's first byte
SYMBOLS = 257  # bytes, and the end of a spelling
EXACT = 32
#: Bytes of text of which a block of documents is made.
BLOCK_BYTES = 16 << 20
#: Tokens that are spelled at once.
SPELLED = 1 << 16
#: Tokens of blocks to a part, beyond the first ``FEW`` parts of a tenth of it.
PART_PAIRS = 1 << 20
FEW = 32
THETA = 1.0


def log_stirling(d: float, most: int = EXACT) -> np.ndarray:
    """log S_d(n, t) for n, t up to ``most``."""
    s = np.full((most + 1, most + 1), -np.inf)
    s[0, 0] = 0
    for n in range(most):
        for t in range(1, n + 2):
            stay = s[n, t] + np.log(n - d * t) if n - d * t > 0 else -np.inf
            s[n + 1, t] = np.logaddexp(s[n, t - 1], stay)
    return s


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, d: float, theta: float, u: np.ndarray) -> np.ndarray:
    """Numbers of tables for dishes with ``c`` customers; ``u``: uniform."""
    t, log_s = np.ones(len(c)), log_stirling(d)
    for n in range(2, EXACT + 1):
        at = np.nonzero(c == n if n < EXACT else c >= n)[0]
        for k in range(0, len(at), 1 << 14):
            own = at[k : k + (1 << 14)]
            step = np.log(theta + d * (others[own, None] + np.arange(n))) + np.log(p[own, None])
            w = log_s[n, 1 : n + 1] + np.cumsum(step, 1)
            w = np.cumsum(np.exp(w - w.max(1, keepdims=True)), 1)
            t[own] = 1 + (w < u[own, None] * w[:, -1:]).sum(1)
    more = np.nonzero(c > EXACT)[0]
    if len(more):
        i, goal, now, a = np.full(len(more), float(EXACT)), c[more].astype(float), t[more], theta + d * others[more]
        first = now.copy()
        while (i < goal).any():
            m = np.minimum(goal - i, np.maximum(1, i // 4))
            new = (a + d * now) * p[more]
            now = now + m * new / (new + np.maximum(i + m / 2 - d * now, 1e-9))
            i = i + m
        z = np.sqrt(-2 * np.log(np.maximum(u[more], 1e-12))) * np.cos(2 * np.pi * ((u[more] * 7919) % 1))
        t[more] = np.clip(np.rint(now + z * np.sqrt(now - first)), 1, goal)
    return t.astype(np.int64)


def uniforms(keys: np.ndarray, round_: int) -> np.ndarray:
    """A number in [0, 1) for each key and round (splitmix64)."""
    z = keys.astype(np.uint64) + np.uint64((round_ + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def discount(n1: float, n2: float) -> float:
    """From how many dishes have one and two customers."""
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


def spell(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token number, context of CONTEXT bytes, symbol) of every byte."""
    raw = np.frombuffer(b" ".join([*tokens, b""]), np.uint8)  # no token holds a space
    last = raw == 32
    context, outside = np.zeros(len(raw), np.int64), np.zeros(len(raw), bool)
    for k in range(1, CONTEXT + 1):
        before = np.append(np.full(k, 32, np.uint8), raw)[: len(raw)]
        outside |= before == 32
        context += np.where(outside, END[0], before).astype(np.int64) << 8 * (k - 1)
    return np.cumsum(last) - last, context, np.where(last, 256, raw.astype(np.int64))


class Bytes:
    """Byte restaurants of all depths: per entry (context, symbol) customers
    and tables, per restaurant their sums."""

    def __init__(self, keys: np.ndarray, depth: int):
        """``keys``: context * 512 + symbol of the deepest restaurants."""
        self.depth, self.keys, self.up = depth, [np.unique(keys)], []
        for depth in range(depth, 0, -1):
            context, symbol = self.keys[0] >> 9, self.keys[0] & 511
            above, up = np.unique((context % 256 ** (depth - 1) << 9) + symbol, return_inverse=True)
            self.keys.insert(0, above)
            self.up.insert(0, up)
        self.rooms = [np.unique(k >> 9, return_inverse=True) for k in self.keys]
        self.c = [np.zeros(len(k), np.int64) for k in self.keys]
        self.t = [np.ones(len(k), np.int64) for k in self.keys]
        self.d, self.theta = [0.5] * len(self.keys), [1.0] * len(self.keys)
        self._sum()

    def _sum(self) -> None:
        self.customers = [np.bincount(r[1], c, len(r[0])) for r, c in zip(self.rooms, self.c, strict=True)]
        self.tables = [np.bincount(r[1], t, len(r[0])) for r, t in zip(self.rooms, self.t, strict=True)]

    def predict(self, context: np.ndarray, symbol: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Predictive probability of the symbols after the contexts."""
        p = np.full(len(symbol), 1 / SYMBOLS)
        for k in range((self.depth if depth is None else depth) + 1):
            if not len(self.keys[k]):
                continue
            own = context % 256**k
            room = np.minimum(np.searchsorted(self.rooms[k][0], own), len(self.rooms[k][0]) - 1)
            known = (self.rooms[k][0][room] == own) & (self.customers[k][room] > 0)
            key = (own << 9) + symbol
            at = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
            there = self.keys[k][at] == key
            d, theta = self.d[k], self.theta[k]
            top = np.where(there, self.c[k][at] - d * self.t[k][at], 0) + (theta + d * self.tables[k][room]) * p
            p = np.where(known, top / (theta + self.customers[k][room]), p)
        return p

    def sweep(self, customers: np.ndarray, round_: int) -> None:
        """Seat the customers of the deepest restaurants, and their tables in
        the parents, given the probabilities of the last round."""
        base = [self.predict(k >> 9, k & 511, depth - 1) for depth, k in enumerate(self.keys)]
        now = customers
        for k in range(self.depth, -1, -1):
            self.c[k] = now
            self.d[k] = discount((now == 1).sum(), (now == 2).sum())
            others = self.tables[k][self.rooms[k][1]] - self.t[k]
            self.t[k] = draw_tables(now, others, base[k], self.d[k], self.theta[k], uniforms(self.keys[k] * 8 + k, round_))
            if k:
                now = np.bincount(self.up[k - 1], self.t[k], len(self.keys[k - 1])).astype(np.int64)
        self._sum()


class Numbering(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def _token_hash(tokens: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter((xxhash.xxh64_intdigest(t) for t in tokens), np.uint64, len(tokens))


def _copy(model: Bytes) -> Bytes:
    new = object.__new__(Bytes)
    new.__dict__ = {k: list(v) if isinstance(v, list) else v for k, v in model.__dict__.items()}
    return new


def _uniform(tokens: list[bytes]) -> np.ndarray:
    return np.exp(-np.log(SYMBOLS) * (np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1))


U64, U32, I64, F64 = np.uint64, np.uint32, np.int64, np.float64
#: Rows that tasks exchange: a part, the kind of row, where it is from, three
#: counts and arrays.
ROW = ["part", "kind", "source", "seq", "i0", "i1", "i2", *[f"x{k}" for k in range(8)]]
ROW_TYPE = "part int, kind int, source bigint, seq int, i0 bigint, i1 bigint, i2 bigint, " + ", ".join(f"x{k} binary" for k in range(8))
DOCS, WORDS, PAIRS, STATE, ASK, COUNTS, NEED, TABLES, PRICES = range(9)


def _row(part: int, kind: int, source: int | None = None, seq: int | None = None, counts: tuple = (), arrays: tuple = ()) -> tuple:
    arrays = [_pack(a) for a in arrays]
    return (part, kind, source, seq, *counts, *[None] * (3 - len(counts)), *arrays, *[None] * (8 - len(arrays)))


def _frame(rows: list[tuple], names: list[str] = ROW) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names, dtype=object)


@cache
def _codec() -> tuple[Callable, Callable]:
    return zstandard.ZstdCompressor(1).compress, zstandard.ZstdDecompressor().decompress


def _pack(a: np.ndarray | bytes) -> bytes:
    """Text, or numbers as planes of their bytes (hashes as differences: they
    ascend; counts in as few bytes as they need), compressed."""
    if isinstance(a, bytes):
        return _codec()[0](a)
    a = np.ascontiguousarray(a).reshape(-1)
    if a.dtype == U64:
        a = np.diff(a, prepend=U64(0))
    head = b""
    if a.dtype == I64:
        least, most = (int(a.min()), int(a.max())) if len(a) else (0, 0)
        width = 8 if least < 0 else next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
        a, head = a.astype(f"u{width}"), bytes([width])
    return head + _codec()[0](a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _planes(raw: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(_codec()[1](raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _text(raw: bytes) -> list[bytes]:
    return _codec()[1](raw).split(b" ")


def _array(raw: bytes, kind) -> np.ndarray:
    if kind == I64:
        return _planes(raw[1:], f"u{raw[0]}").astype(I64)
    a = _planes(raw, kind)
    return np.cumsum(a, dtype=U64) if kind == U64 else a


def _joined(raw, kind) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(_array(r, kind) for r in raw)])


def _segments(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of ascending hashes: parts are ranges of hashes."""
    ends = np.searchsorted(hashes, np.array([(k << 64) // parts for k in range(1, parts)], U64), "left")
    ends = [0, *ends.tolist(), len(hashes)]
    yield from ((k, x, y) for k, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if y > x)


def _in_parts(rows: DataFrame, parts: int, make: Callable[[int, pd.DataFrame], list[tuple]], names: list[str] = ROW, kinds: str = ROW_TYPE) -> DataFrame:
    """``make`` of all rows of a part."""
    def run(key, own: pd.DataFrame) -> pd.DataFrame:
        return _frame(make(int(key[0]), own), names)

    # the number is given, so that parts of few bytes are not put into one task
    return rows.repartition(3 * parts, "part").groupBy("part").applyInPandas(run, kinds)


def _blocks(docs: DataFrame, id_type: str) -> DataFrame:
    """Documents in blocks: a row per document; a row per block with the
    distinct words by ascending hash, the times each is seen in training, and
    all tokens as places among them, with the documents' sizes and flags."""
    kind = f"block bigint, kind int, seq int, n bigint, id {id_type}, train boolean, x0 binary, x1 binary, x2 binary, x3 binary, x4 binary, x5 binary"
    names = ["block", "kind", "seq", "n", "id", "train", *[f"x{k}" for k in range(6)]]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, size, texts = Numbering(), 0, []
        block = TaskContext.get().partitionId() << 32
        number[END]

        def whole() -> Iterator[pd.DataFrame]:
            hashes = _token_hash(number)
            order = np.argsort(hashes, kind="stable")
            word, place = np.array([*number], object)[order], np.argsort(order, kind="stable")
            sizes, trained = np.array([len(t[2]) for t in texts]), np.array([t[1] for t in texts])
            codes = place[np.concatenate([t[2] for t in texts])]
            n = np.bincount(codes[np.repeat(trained, sizes)], minlength=len(word))
            yield _frame([(block, WORDS, 0, len(codes), None, None, *map(_pack, (
                hashes[order], b" ".join(word), n, codes.astype(U32), sizes.astype(I64), trained)))], names)
            for k in range(0, len(texts), 4096):
                yield _frame([(block, DOCS, k + i, len(own), id_, train, *[None] * 6) for i, (id_, train, own) in enumerate(texts[k : k + 4096])], names)

        for batch in batches:
            for id_, text, train in zip(batch["id"], batch["text"], batch["train"], strict=True):
                raw = (text or "").encode().lower()
                codes = np.array([*map(number.__getitem__, raw.split()), 0], U32)
                texts.append((None if pd.isna(id_) else id_, bool(train), codes))
                size += len(raw)
                if size >= BLOCK_BYTES:
                    yield from whole()
                    number, size, texts, block = Numbering(), 0, [], block + 1
                    number[END]
        if texts:
            yield from whole()

    return docs.mapInPandas(make, kind)


def _block_pairs(codes: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct pairs as places of their words, the part of each,
    and each token's pair. Pairs ascend by the hashes of their words."""
    codes = codes.astype(I64)
    prev = np.append(0, codes[:-1])
    prev[np.cumsum(sizes) - sizes] = codes[sizes[0] - 1]  # the end
    bits, below = len(hashes).bit_length(), len(codes).bit_length()
    keys = (prev << bits) + codes
    if 2 * bits + below < 64:  # a sort of plain numbers: much faster than one of places
        keys = np.sort((keys << below) + np.arange(len(keys)))
        order, keys = keys & (1 << below) - 1, keys >> below
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    new = np.append([True], keys[1:] != keys[:-1])
    at = np.empty(len(keys), np.int64)
    at[order] = np.cumsum(new) - 1
    keys = keys[new]
    prev, code = keys >> bits, keys & (1 << bits) - 1
    mixed = (hashes[prev] * U64(0x9E3779B97F4A7C15)) ^ hashes[code]
    mixed = (mixed ^ (mixed >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return prev, code, ((mixed >> U64(32)) * U64(parts) >> U64(32)).astype(np.uint16 if parts <= 1 << 16 else U32), at


def _used(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers below ``size``, ascending, and each one's place."""
    if 8 * len(codes) < size:
        return np.unique(codes, return_inverse=True)
    some = np.zeros(size, bool)
    some[codes] = True
    return np.flatnonzero(some), (np.cumsum(some) - 1)[codes]


def _dealt_words(blocks: DataFrame, parts: int) -> DataFrame:
    """The words of blocks, to their parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, seq, x0, x1, x2 in batch.itertuples(index=False):
                hashes, word, n = _array(x0, U64), _text(x1), _array(x2, I64)
                yield _frame([_row(k, WORDS, block, seq, (y - x,), (hashes[x:y], b" ".join(word[x:y]), n[x:y])) for k, x, y in _segments(hashes, parts)])

    return blocks.filter(F.col("kind") == WORDS).select("block", "seq", "x0", "x1", "x2").mapInPandas(run, ROW_TYPE)


def _dealt_pairs(blocks: DataFrame, parts: int) -> DataFrame:
    """The pairs of blocks, as places among the words they use, to their parts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, x0, x3, x4, x5 in batch.itertuples(index=False):
                hashes, sizes = _array(x0, U64), _array(x4, I64)
                prev, code, part, at = _block_pairs(_array(x3, U32), sizes, hashes, parts)
                n = np.bincount(at[np.repeat(_array(x5, bool), sizes)], minlength=len(code))
                order = np.argsort(part, kind="stable")
                ends = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order)).tolist()
                prev, code, n, part = prev[order], code[order], n[order], part[order]
                rows = []
                for x, y in zip(ends[:-1], ends[1:], strict=True):
                    some, own = _used(np.append(prev[x:y], code[x:y]), len(hashes))
                    rows.append(_row(int(part[x]), PAIRS, block, 0, (y - x,), (_steps(own[: y - x]), _steps(own[y - x :]), hashes[some], n[x:y])))
                    if len(rows) == 256:
                        yield _frame(rows)
                        rows = []
                if rows:
                    yield _frame(rows)

    return blocks.filter(F.col("kind") == WORDS).select("block", "x0", "x3", "x4", "x5").mapInPandas(run, ROW_TYPE)


def _steps(a: np.ndarray) -> np.ndarray:
    """Numbers that mostly ascend, as differences."""
    return np.diff(a, prepend=0).astype(np.int32)


def _from_steps(raw: bytes) -> np.ndarray:
    return np.cumsum(_array(raw, np.int32), dtype=I64)


def _asks(part: int, own: pd.DataFrame, at: np.ndarray) -> list[tuple]:
    """For every row that asked, where its words or pairs are."""
    sizes = own["i0"].astype(I64).tolist()
    ends = np.cumsum(sizes).tolist()
    return [_row(part, ASK, int(block), int(seq), (), (_steps(at[end - n : end]),))
            for block, seq, n, end in zip(own["source"], own["seq"], sizes, ends, strict=True)]


def _pair_part(parts: int) -> Callable[[int, pd.DataFrame], list[tuple]]:
    """A part's distinct pairs: their counts; of the repeated ones words and
    counts; the words that these need; tables of all other pairs."""
    def make(part: int, own: pd.DataFrame) -> list[tuple]:
        used = [_array(x, U64) for x in own["x2"]]
        hashes, place = np.unique(np.concatenate(used), return_inverse=True)
        ends = np.cumsum([len(x) for x in used]).tolist()
        prev, code = (np.concatenate([place[end - len(h) : end][_from_steps(x)] for x, h, end in zip(own[of], used, ends, strict=True)]) for of in ("x0", "x1"))
        keys = (prev << 32) + code
        order = np.argsort(keys, kind="stable")
        new = np.append([True], np.diff(keys[order]) != 0)
        at = np.empty(len(keys), np.int64)
        at[order] = np.cumsum(new) - 1
        first = order[new]
        c = np.bincount(at, _joined(own["x3"], I64), len(first)).astype(I64)
        often, once = first[c > 1], first[c == 1]
        need, of = _used(np.append(prev[often], code[often]), len(hashes))
        need = hashes[need]
        state = _row(part, STATE, None, None, (int((c == 1).sum()), int((c == 2).sum())), (
            of.astype(U32), c[c > 1], np.empty(0, U64), np.ones(len(often), I64), np.empty(0, I64), need))
        out = [state, _row(part, COUNTS, None, None, (), (c,)), *_asks(part, own, at)]
        single, of = _used(np.append(prev[once], code[once]), len(hashes))
        tables, customers = np.bincount(of[: len(once)], minlength=len(single)), np.bincount(of[len(once) :], minlength=len(single))
        single = hashes[single]
        out += [_row(k, TABLES, part, None, (), (single[x:y], tables[x:y], customers[x:y])) for k, x, y in _segments(single, parts)]
        return out + [_row(k, NEED, part, None, (), (need[x:y],)) for k, x, y in _segments(need, parts)]

    return make


def _word_part(part: int, own: pd.DataFrame) -> list[tuple]:
    """A part's distinct words: counts, tables and customers of single pairs,
    and for each pair part the places of the words that it needs."""
    asked, needed, singles = (own[own["kind"] == k] for k in (WORDS, NEED, TABLES))
    hashes = _joined(asked["x0"], U64)
    word = [w for x in asked["x1"] for w in _text(x)]
    known, first, at = np.unique(hashes, return_index=True, return_inverse=True)
    if any(word[f] != w for w, f in zip(word, first[at].tolist(), strict=True)):
        raise ValueError("two words of one hash")
    word = [word[f] for f in first.tolist()]
    c = np.bincount(at, _joined(asked["x2"], I64), len(known)).astype(I64)
    tables, customers = np.zeros((2, len(known)), I64)
    for x0, x1, x2 in singles[["x0", "x1", "x2"]].itertuples(index=False):
        place = np.searchsorted(known, _array(x0, U64))
        tables[place] += _array(x1, I64)
        customers[place] += _array(x2, I64)
    needed = needed.sort_values("source")
    places = [np.searchsorted(known, _array(x, U64)).astype(U32) for x in needed["x0"]]
    linked = np.zeros(len(known), bool)
    for place in places:
        linked[place] = True
    # words that have one customer in every round; their tables spell the same
    fixed = ~linked & (customers == 1)
    keys, n = _spelling_sums([word[k] for k in np.flatnonzero(fixed)], np.ones(int(fixed.sum()), I64))
    state = _row(part, STATE, None, None, (int(c.sum()), int((c > 0).sum())), (
        b" ".join(word), tables, customers, np.concatenate([np.empty(0, U32), *places]),
        np.array([(q, len(x)) for q, x in zip(needed["source"], places, strict=True)], I64), fixed, linked))
    return [state, _row(part, COUNTS, None, None, (int(fixed.sum()),), (c, keys, n)), *_asks(part, asked, at)]


def _entries(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Per byte its token, and a number for its context and symbol; the
    contexts by these numbers, and how many numbers there are."""
    owner, context, symbol = spell(tokens)
    contexts, own = _used(context, 256**CONTEXT)
    return owner, own * SYMBOLS + symbol, contexts, len(contexts) * SYMBOLS


def _spelling_sums(tokens: list[bytes], t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries (context * 512 + symbol) of the spellings, and their sums of ``t``."""
    keys, n = [np.empty(0, I64)], [np.empty(0)]
    for k in range(0, len(tokens), SPELLED):
        owner, entry, contexts, most = _entries(tokens[k : k + SPELLED])
        sums = np.bincount(entry, t[k : k + SPELLED][owner], most)
        some = np.flatnonzero(sums)
        keys.append((contexts[some // SYMBOLS] << 9) + some % SYMBOLS)
        n.append(sums[some])
    some, at = np.unique(np.concatenate(keys), return_inverse=True)
    return some, np.bincount(at, np.concatenate(n), len(some)).astype(I64)


def _spelled(tokens: list[bytes], *models: Bytes) -> np.ndarray:
    """The spelling models' probabilities, a row per model."""
    out = [np.empty((len(models), 0))]
    for k in range(0, len(tokens), SPELLED):
        own = tokens[k : k + SPELLED]
        owner, entry, contexts, most = _entries(own)
        some, at = _used(entry, most)
        log_p = [np.log(m.predict(contexts[some // SYMBOLS], some % SYMBOLS)) for m in models]
        out.append(np.exp([np.bincount(owner, v[at], len(own)) for v in log_p]))
    return np.concatenate(out, axis=1)


def _tables(tokens: list[bytes], c: np.ndarray, model: Bytes | None, words: dict) -> np.ndarray:
    """The round's tables of each token of the token restaurant."""
    t = (c > 0).astype(I64)
    more = np.flatnonzero(c > 1)
    some = [tokens[k] for k in more]
    spelled = np.full(len(some), 1 / SYMBOLS) if model is None else _spelled(some, model)[0]
    t[more] = draw_tables(c[more], np.full(len(more), max(0.0, words["others"] - 1.0)), np.maximum(spelled, 1e-300), words["d"], THETA,
                          uniforms(_token_hash(some), words["round"]))
    return t


def _probabilities(c: np.ndarray, t: np.ndarray, spelled: np.ndarray, words: dict) -> np.ndarray:
    """The token restaurant's predictive probabilities of tokens with ``c``
    customers at ``t`` tables, after a round."""
    return (c - words["d"] * t + (THETA + words["d"] * words["T"]) * spelled) / (THETA + words["N"])


def _seat_pairs(parts: int, d: float, round_: int, keep: bool, last: bool) -> Callable[[int, pd.DataFrame], list[tuple]]:
    """The round's tables of a part's repeated pairs, drawn with the prices
    of the round before; to the word parts the tables after and with each
    word. After the ``last`` round only the kept tables are needed."""
    def make(part: int, own: pd.DataFrame) -> list[tuple]:
        state = own[own["kind"] == STATE].iloc[0]
        of, c, keys, t, need = (_array(state[x], k) for x, k in (("x0", U32), ("x1", I64), ("x2", U64), ("x3", I64), ("x5", U64)))
        of = of.astype(I64)
        prev, code = of[: len(c)], of[len(c) :]
        if round_:
            prices = own[own["kind"] == PRICES].sort_values("source")
            p, tables = _joined(prices["x0"], F64), _joined(prices["x1"], I64)
            if round_ == 1:
                word = [w for x in prices["x2"] for w in _text(x)]
                keys = _token_hash([word[x] + b" " + word[y] for x, y in zip(prev.tolist(), code.tolist(), strict=True)])
            others = np.maximum(0.0, (tables[prev] - t).astype(F64))
            t = draw_tables(c, others, np.maximum(p[code], 1e-300), d, THETA, uniforms(keys, round_))
        kept = np.append(_array(state["x4"], I64), t if keep else t[:0])
        tables, customers = (np.bincount(x, t, len(need)).astype(I64) for x in (prev, code))
        sent = [_row(k, TABLES, part, None, (), (tables[x:y], customers[x:y])) for k, x, y in _segments(need, parts)]
        of, c, keys, t, need = (x[:0] if last else x for x in (of, c, keys, t, need))
        return [_row(part, STATE, None, None, (), (of.astype(U32), c, keys, t, kept, need)), *sent]

    return make


def _links(state) -> list[tuple[int, np.ndarray]]:
    """Pair parts, and the places of the words that they need."""
    of = _array(state["x4"], I64).reshape(-1, 2)
    ends = np.cumsum(of[:, 1])
    at = _array(state["x3"], U32)
    return [(int(q), at[end - n : end]) for (q, n), end in zip(of, ends, strict=True)]


def _seat_words(part: int, own: pd.DataFrame) -> list[tuple]:
    """A part's words with the round's tables and customers."""
    state = own[own["kind"] == STATE].iloc[0]
    tables, customers = _array(state["x1"], I64).copy(), _array(state["x2"], I64).copy()
    sent = {int(q): (x0, x1) for q, x0, x1 in own[own["kind"] == TABLES][["source", "x0", "x1"]].itertuples(index=False)}
    for q, at in _links(state):
        tables[at] += _array(sent[q][0], I64)
        customers[at] += _array(sent[q][1], I64)
    counts = (int(customers.sum()), int((customers == 1).sum()), int((customers == 2).sum()))
    return [_row(part, STATE, None, None, counts)[:7] + (state["x0"], _pack(tables), _pack(customers), *(state[f"x{k}"] for k in range(3, 8)))]


def seat_bytes(seated: DataFrame, state: Bytes | None, words: dict, fixed: tuple[np.ndarray, np.ndarray, int]) -> tuple[Bytes, int]:
    """Byte restaurants and number of tables of the token restaurant after a
    round. ``seated``: the word parts with the round's customers; ``words``:
    their sums and the round; ``fixed``: spelling sums of the words that have
    one customer in every round, and how many they are."""
    shared = seated.sparkSession.sparkContext.broadcast((state, words))

    def seat(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
        model, sums = shared.value
        for batch in batches:
            for x0, x2, x5 in batch.itertuples(index=False):
                c, tokens = _array(x2, I64), _text(x0)
                some = np.flatnonzero((c > 0) & ~_array(x5, bool))
                tokens = [tokens[k] for k in some]
                t = _tables(tokens, c[some], model, sums)
                keys, n = _spelling_sums(tokens, t)
                yield pd.DataFrame({"key": np.append(keys, -1), "n": np.append(n, t.sum())})

    sums = cut(seated.select("x0", "x2", "x5").mapInPandas(seat, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "seated")
    rows = np.fromiter((x for r in sums.toLocalIterator() for x in r), np.int64).reshape(-1, 2)
    keys, at = np.unique(np.concatenate([[-1], rows[:, 0], fixed[0]]), return_inverse=True)
    n = np.bincount(at, np.concatenate([[fixed[2]], rows[:, 1], fixed[1]])).astype(I64)
    state = Bytes(keys[1:], CONTEXT) if state is None else _copy(state)
    state.sweep(n[1:], words["round"])
    shared.destroy()
    drop(sums)
    return state, int(n[0])


def _priced(seated: DataFrame, shared, keep: bool, first: bool) -> DataFrame:
    """To the pair parts the prices of the words that they need, and the words
    if it is the ``first`` time; if ``keep``, tables and customers of all words
    in both kinds of restaurant."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for state in batch.to_dict("records"):
                tables, c, tokens = _array(state["x1"], I64), _array(state["x2"], I64), _text(state["x0"])
                model, used, sums = shared.value
                linked = np.flatnonzero(_array(state["x6"], bool))
                some = np.arange(len(c)) if keep else linked
                t, p = np.zeros(len(c), I64), np.zeros(len(c))
                t[some] = _tables([tokens[k] for k in some], c[some], used, sums)
                p[linked] = _probabilities(c[linked], t[linked], _spelled([tokens[k] for k in linked], model)[0], sums)
                rows = []
                for q, at in _links(state):
                    rows.append(_row(q, PRICES, state["part"], None, (), (p[at], tables[at], *([b" ".join([tokens[k] for k in at])] if first else []))))
                yield _frame(rows + ([_row(state["part"], STATE, None, None, (), (tables, c, t))] if keep else []))

    return seated.select("part", "x0", "x1", "x2", "x3", "x4", "x6").mapInPandas(run, ROW_TYPE)


def _of(rows: DataFrame, *kinds: int) -> DataFrame:
    return rows.filter(F.col("kind").isin(*kinds))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when a query inside ends, not when the driver happens
    to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def fit(words: DataFrame, seats: DataFrame, parts: int, burn_in: int, samples: int) -> tuple[list[tuple[Bytes, dict]], dict, list[DataFrame], DataFrame]:
    """Per kept round the byte restaurants and the token restaurant's sums;
    the corpus' sums; per kept round the word parts' tables and customers; the
    pair parts with the tables of the kept rounds."""
    spark = words.sparkSession
    total = _of(words, STATE).agg(F.sum("i0"), F.sum("i1")).first()
    seen = _of(seats, STATE).agg(F.sum("i0"), F.sum("i1")).first()
    corpus = {"N": total[0] or 0, "V": total[1] or 0, "d": discount(seen[0] or 0, seen[1] or 0)}
    found, kept, state, tables, priced, now = [], [], None, corpus["V"], None, seats
    if not corpus["N"]:
        return kept, corpus, found, now
    fixed = _fixed(words)
    for round_ in range(burn_in + samples):
        keep = round_ >= burn_in
        before, last = now, priced
        end = round_ == burn_in + samples - 1
        now = cut(_in_parts(_of(now, STATE) if last is None else _of(now, STATE).union(_of(last, PRICES)), parts,
                            _seat_pairs(parts, corpus["d"], round_, keep, end)), "pair-tables")
        drop(before)
        if last is not None:
            drop(last)
        seated = cut(_in_parts(_of(words, STATE).union(_of(now, TABLES)), parts, _seat_words), "token-customers")
        sums = seated.agg(F.sum("i0"), F.sum("i1"), F.sum("i2")).first()
        of_round = {"N": sums[0], "d": discount(sums[1], sums[2]), "round": round_, "others": tables}
        used = state
        state, tables = seat_bytes(seated, used, of_round, fixed)
        of_round["T"] = tables
        shared = spark.sparkContext.broadcast((state, used, of_round))
        priced = cut(_priced(seated, shared, keep, not round_), "token-prices")
        shared.destroy()
        drop(seated)
        if keep:  # prices go after the next round
            found.append(cut(_of(priced, STATE), "kept-words"))
            kept.append((state, of_round))
    if priced is not None:
        drop(priced)
    return kept, corpus, found, now


def _fixed(words: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Spelling sums of the words that have one customer in every round; the
    alphabet bounds them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i0, x1, x2 in batch.itertuples(index=False):
                yield pd.DataFrame({"key": np.append(_array(x1, I64), -1), "n": np.append(_array(x2, I64), i0)})

    sums = cut(_of(words, COUNTS).select("i0", "x1", "x2").mapInPandas(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "fixed")
    rows = np.fromiter((x for r in sums.toLocalIterator() for x in r), np.int64).reshape(-1, 2)
    drop(sums)
    some = rows[:, 0] >= 0
    return rows[some, 0], rows[some, 1], int(rows[~some, 1].sum())


def _answer_words(part: int, own: pd.DataFrame) -> list[tuple]:
    """To the blocks their words' counts and, per kept round, tables and
    customers."""
    kinds = {k: own[own["kind"] == k] for k in (COUNTS, ASK, PRICES)}
    c = _array(kinds[COUNTS].iloc[0]["x0"], I64)
    kept = kinds[PRICES].sort_values("seq")
    sums = [[_array(x, I64) for x in kept[of]] for of in ("x0", "x1", "x2")]
    out = []
    for block, seq, x0 in kinds[ASK][["source", "seq", "x0"]].itertuples(index=False):
        at = _from_steps(x0)
        out.append((block, WORDS, seq, part, _pack(c[at]), *(_pack(np.array([v[at] for v in of], I64)) for of in sums)))
    return out


def _answer_pairs(rounds: int) -> Callable[[int, pd.DataFrame], list[tuple]]:
    """To the blocks their pairs' counts and tables."""
    def make(part: int, own: pd.DataFrame) -> list[tuple]:
        c = _array(own[own["kind"] == COUNTS].iloc[0]["x0"], I64)
        kept = _array(own[own["kind"] == STATE].iloc[0]["x4"], I64)
        tables = np.tile((c == 1).astype(I64), (rounds, 1))
        if len(kept):
            tables[:, c > 1] = kept.reshape(rounds, -1)
        out = []
        for block, seq, x0 in own[own["kind"] == ASK][["source", "seq", "x0"]].itertuples(index=False):
            at = _from_steps(x0)
            out.append((block, PAIRS, seq, part, _pack(c[at]), _pack(tables[:, at]), None, None))
        return out

    return make


ANSWER = ["block", "kind", "seq", "part", "x0", "x1", "x2", "x3"]
ANSWER_TYPE = "block bigint, kind int, seq int, part int, x0 binary, x1 binary, x2 binary, x3 binary"


def lm_scores(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", burn_in: int = 2,
              samples: int = 3) -> DataFrame:
    """A row per document: id, train, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score, both log10, and perplexity."""
    id_type = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), train.alias("train"))
    with _shuffles_dropped(df.sparkSession):
        blocks = cut(_blocks(docs, id_type), "blocks")
        held = blocks.filter(F.col("kind") == WORDS).agg(F.sum("n")).first()[0] or 0
        parts = max(1, min(-(-held // max(1, PART_PAIRS // 10)), FEW), -(-held // PART_PAIRS))
        pairs = cut(_in_parts(_dealt_pairs(blocks, parts), parts, _pair_part(parts)), "pair-parts")
        words = cut(_in_parts(_dealt_words(blocks, parts).union(_of(pairs, TABLES, NEED)), parts, _word_part), "word-parts")
        asked, seats = cut(_of(pairs, COUNTS, ASK), "pair-answers"), cut(_of(pairs, STATE), "pair-tables")
        drop(pairs)
        kept, corpus, found, seats = fit(words, seats, parts, burn_in, samples)
    rounds = len(kept)
    prices = _of(words, COUNTS, ASK)
    for k, own in enumerate(found):
        prices = prices.union(_of(own, STATE).withColumn("kind", F.lit(PRICES)).withColumn("seq", F.lit(k)))
    of_words = _in_parts(prices, parts, _answer_words, ANSWER, ANSWER_TYPE)
    of_pairs = _in_parts(asked.union(_of(seats, STATE)), parts, _answer_pairs(max(1, rounds)), ANSWER, ANSWER_TYPE)
    tokens = blocks.filter(F.col("kind") == WORDS).select("block", F.lit(STATE).alias("kind"), "seq", F.lit(0).alias("part"), F.col("x3").alias("x0"),
                                                          F.col("x4").alias("x1"), F.col("x1").alias("x2"), F.lit(None).cast("binary").alias("x3"))
    answers = of_words.union(of_pairs).union(tokens)
    n_all, v_all, d = corpus["N"], corpus["V"], corpus["d"]
    shared = df.sparkSession.sparkContext.broadcast(kept)

    def score(key, texts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        of = {k: rows[rows["kind"] == k] for k in (WORDS, PAIRS, STATE)}

        def by_round(raw, kind=I64) -> np.ndarray:
            return np.concatenate([_array(x, I64).astype(kind).reshape(max(1, rounds), -1) for x in raw], axis=1)

        own = of[STATE].iloc[0]
        sizes, word = _array(own["x1"], I64), _text(own["x2"])
        prev, code, part, place = _block_pairs(_array(own["x0"], U32), sizes, _token_hash(word), parts)
        c = _joined(of[WORDS]["x0"], I64)
        if rounds:
            models, sums = zip(*shared.value, strict=True)
            spelled = _spelled(word, *models)
            tables, customers, t = (by_round(of[WORDS][x]) for x in ("x1", "x2", "x3"))
            p = [*map(_probabilities, customers, t, spelled, sums)]
        else:  # nothing to learn from: the uniform spelling
            tables, p = np.zeros((1, len(c)), I64), [_uniform(word)]
        del word
        order = np.argsort(np.argsort(part, kind="stable"), kind="stable")  # answers come by part
        seated, less = _joined(of[PAIRS]["x0"], I64)[order], by_round(of[PAIRS]["x1"], U32)
        found, all_ = np.zeros(len(prev)), THETA + c[prev]
        for k in range(len(p)):
            found += (seated - d * less[k][order] + (THETA + d * tables[k])[prev] * p[k][code]) / all_
        found = np.log10(np.maximum(found / len(p), 1e-300))[place]
        del seated, less, order, all_
        base, known = np.log10((c + 1) / (n_all + v_all + 1))[code][place], (c > 0)[code][place]
        ends = np.cumsum(sizes).tolist()
        out = []
        for id_, is_train, seq, n in zip(texts["id"], texts["train"], texts["seq"].tolist(), texts["n"].tolist(), strict=True):
            at = slice(ends[seq] - n, ends[seq])
            total = float(found[at].sum())
            out.append((None if pd.isna(id_) else id_, bool(is_train), n, int(known[at].sum()), n_all,
                        float(base[at].sum()), total, 10 ** min(300.0, -total / n)))
        return pd.DataFrame(out, columns=["id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    texts = blocks.filter(F.col("kind") == DOCS).select("block", "id", "train", "seq", "n")
    done = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, f"id {id_type}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
               "score double, perplexity double")
    return done.withColumnRenamed("id", id_col)


def op4_lm_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7, F.lit(0)) == 2
    return lm_scores(docs, ~held_out).select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                                             "train_tokens", "base_score", "score", "perplexity")
