"""Best-fit packing by bin completion (operator 8).

Texts become token ids, an end id is added, and only documents longer than a
sequence are cut into full pieces and a rest. All pieces of one length are
interchangeable, so the bins are planned on the count of each length: at most
``cap`` numbers on the driver, whatever the corpus. A plan step is a filling
around the largest length left, used as often as its counts allow.

Search: depth first over steps. At each step the undominated fillings around
the largest piece are listed by waste (none in which one or two chosen pieces
could be replaced by one unused piece that fits and is at least as large). A
branch is cut when its bins so far plus the waste bound of the rest reach the
incumbent; the first incumbent is best-fit decreasing. The search ends when
the incumbent meets the bound of the whole input or after ``nodes`` steps.

Pieces of a length are then ranked by Spark (a rank inside each of many
salts, plus the salts' offsets), and the rank says which bin and place a
piece takes.

Defined results: null and empty texts are one piece with the end id alone.
Repeated rows are packed each. An empty table packs into nothing. Of clashing
columns, the operator's own win.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import cut, fresh, small, table

CAP = 2048
#: Distinct chunks of text that a worker remembers the ids of.
REMEMBERED = 800_000
SALTS = 64
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def byte_alphabet() -> list[str]:
    """The printable character that byte-level tokenizers write for a byte:
    itself if it is printable, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Encoder:
    """Packed little-endian ids of whole texts.

    The tokenizer neither merges nor normalises across white space, so ids are
    remembered per chunk between ASCII white space; punctuation after an ASCII
    letter is a token run of its own, so it is looked up apart. A run of
    letters below U+0180 (but U+0130) that is in normal form needs only lower
    case and the byte alphabet, so it goes to the tokenizer's model directly.
    Texts that may hold a special token's string are encoded whole.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.chunks: dict[bytes, bytes] = {}
        self.cores: dict[bytes, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([self.packed[i] for i in ids])

    def core(self, core: bytes) -> bytes:
        if core not in self.cores:
            text = core.decode()
            if core.isascii() and text.isalpha():
                known = text.lower()
                self.cores[core] = b"".join([self.packed[t.id] for t in self.model.tokenize(known)])
            elif text.isalpha() and max(text) < "\u0180" and "\u0130" not in text and unicodedata.is_normalized("NFC", text):
                known = "".join(map(self.alphabet.__getitem__, text.lower().encode()))
                self.cores[core] = b"".join([self.packed[t.id] for t in self.model.tokenize(known)])
            else:
                self.cores[core] = self.whole(text)
        return self.cores[core]

    def chunk(self, chunk: bytes) -> bytes:
        core = chunk.rstrip(_PUNCTUATION)
        if core and chunk[: len(core)][-1:].isalpha() and len(core) < len(chunk):
            return self.core(core.lower()) + self.core(chunk[len(core) :])
        return self.core(chunk.lower())

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        tokens = text.encode().split()
        if len(self.chunks) + len(self.cores) > REMEMBERED:
            self.chunks.clear()
            self.cores.clear()
        known = self.chunks
        for new in set(tokens).difference(known):
            known[new] = self.chunk(new)
        return b"".join(map(known.__getitem__, tokens))


_ENCODERS: dict[int, Encoder] = {}  # of this worker process


def _encoder(tokenizer_json: str) -> Encoder:
    key = hash(tokenizer_json)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer_json)
    return _ENCODERS[key]


def pieces(df: DataFrame, text_col: str, tokenizer_path: str, cap: int, end_id: int, keep_ids: bool) -> DataFrame:
    """A row per piece: the other columns, piece, start, length, ids_crc32."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # one vocabulary file
    end = end_id.to_bytes(4, "little")

    def of_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoder(shared.value)
        for texts in batches:
            out = []
            for text in texts:
                ids = encode(text) + end
                parts = [ids[k : k + 4 * cap] for k in range(0, len(ids), 4 * cap)]
                out.append([(i, i * cap, len(p) // 4, zlib.crc32(p), p if keep_ids else None) for i, p in enumerate(parts)])
            yield pd.Series(out)

    kind = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"
    (p,) = fresh(df, "pieces")
    names = ["piece", "start", "length", "ids_crc32", "ids"][: 5 if keep_ids else 4]
    others = [c for c in df.columns if c != text_col and c.lower() not in (*names, "sequence_id", "offset", "piece_row")]
    made = df.select(*others, F.explode(F.pandas_udf(of_text, kind)(F.col(text_col))).alias(p))
    return made.select(*others, *[F.col(f"{p}.{n}").alias(n) for n in names],
                       F.monotonically_increasing_id().alias("piece_row"))


def least_bins(counts: dict[int, int], cap: int) -> int:
    """Lower bound: the total; and pieces over half a bin never share one, so
    for each k what those of length k to cap / 2 lack in the room beside the
    larger ones of at most cap - k needs further bins."""
    n = np.zeros(cap + 1, np.int64)
    n[list(counts)] = list(counts.values())
    s, half = np.arange(cap + 1), cap // 2
    total = -(-int((s * n).sum()) // cap)
    rest = np.cumsum((s * n)[half::-1])[::-1]  # lengths k to half, by k
    room = np.cumsum(np.where(s > half, (cap - s) * n, 0))[cap - np.arange(half + 1)]
    return max(total, int(n[half + 1 :].sum()) + max(0, -(-int((rest - room).max()) // cap)))


def best_fit(counts: dict[int, int], cap: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: each step takes the largest piece and
    then always the largest that still fits, as often as the counts allow."""
    left, plan = dict(counts), []
    while left:
        sizes = sorted(left, reverse=True)
        filling, room, used = [], cap, {}
        for s in sizes:
            k = min(room // s, left[s])
            if k:
                filling += [s] * k
                used[s], room = k, room - k * s
        times = min(left[s] // k for s, k in used.items())
        plan.append((tuple(filling), times))
        for s, k in used.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
    return plan


def fillings(counts: dict[int, int], cap: int, most_waste: int, width: int) -> list[tuple[int, ...]]:
    """Up to ``width`` undominated fillings around the largest piece, of least
    waste first and larger pieces first."""
    sizes = sorted(counts, reverse=True)
    largest, space = sizes[0], cap - sizes[0]
    left = dict(counts)
    left[largest] -= 1
    usable = [s for s in sizes if s <= space and left[s]]
    reach = 1  # bit x: x is a sum of usable lengths
    every = (1 << (space + 1)) - 1
    for s in reversed(usable):
        if reach == every:
            break
        k = s
        while k <= space:
            reach |= reach << k
            k *= 2
        reach &= every

    def dominated(chosen: list[int], room: int) -> bool:
        def free(low: int, high: int) -> bool:
            return any(left.get(s, 0) > chosen.count(s) for s in range(low, min(high, space) + 1))

        return any(free(a + 1, a + room) or any(free(a + b, a + b + room) for b in chosen[i + 1 :])
                   for i, a in enumerate(chosen))

    found: list[tuple[int, ...]] = []
    budget = [50 * width]

    def search(i: int, room: int, waste: int, chosen: list[int]) -> None:
        if len(found) >= width or budget[0] <= 0:
            return
        budget[0] -= 1
        if room == waste:
            if not dominated(chosen, waste):
                found.append((largest, *chosen))
            return
        for j in range(i, len(usable)):
            s = usable[j]
            if s <= room - waste and reach >> (room - waste - s) & 1 and chosen.count(s) < left[s]:
                search(j, room - s, waste, [*chosen, s])
                if len(found) >= width or budget[0] <= 0:
                    return

    for waste in range(min(most_waste, space) + 1):
        if reach >> (space - waste) & 1:
            search(0, space, waste, [])
        if len(found) >= width:
            break
    return found


def plan_bins(counts: dict[int, int], cap: int, nodes: int = 2_500, width: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """(filling, times) steps that use up ``counts``."""
    counts = {s: n for s, n in counts.items() if n}
    total, goal = sum(s * n for s, n in counts.items()), least_bins(counts, cap)
    best = best_fit(counts, cap)
    bins = sum(t for _, t in best)
    # a stack of steps: what is left, bins so far, plan, fillings still to try
    stack = [(counts, 0, [], None)]
    while stack and bins > goal and nodes > 0:
        left, used, plan, todo = stack.pop()
        if not left:
            if used < bins:
                best, bins = plan, used
            continue
        if todo is None:
            nodes -= 1
            if used + least_bins(left, cap) >= bins:
                continue
            # all later waste must leave fewer bins than the incumbent
            spare = (bins - 1 - used) * cap - sum(s * n for s, n in left.items())
            todo = fillings(left, cap, spare, width)
        if not todo:
            continue
        filling, *more = todo
        stack.append((left, used, plan, more))
        each = {s: filling.count(s) for s in filling}
        times = min(left[s] // k for s, k in each.items())
        rest = {s: n - each.get(s, 0) * times for s, n in left.items()}
        stack.append(({s: n for s, n in rest.items() if n}, used + times, [*plan, (filling, times)], None))
    assert sum(sum(f) * t for f, t in best) == total
    return best


def places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces per bin, first bin, offset) rows:
    ranks of a length inside the range fill the bins one after the other."""
    next_rank: dict[int, int] = {}
    rows, bin_ = [], 0
    for filling, times in plan:
        offset = 0
        for s in dict.fromkeys(filling):
            k = filling.count(s)
            begin = next_rank.get(s, 0)
            rows.append((s, begin, begin + k * times, k, bin_, offset))
            next_rank[s] = begin + k * times
            offset += k * s
        bin_ += times
    return rows


def pack(df: DataFrame, tokenizer_path: str, text_col: str = "text", cap: int = CAP, end_id: int = 0,
         keep_ids: bool = False) -> DataFrame:
    """A row per piece: the other columns of ``df``, piece, start, length,
    ids_crc32 (and the packed ids), sequence_id, offset."""
    spark = df.sparkSession
    made = cut(pieces(df, text_col, tokenizer_path, cap, end_id, keep_ids), "pieces")
    salted = made.withColumn("salt", F.pmod("piece_row", F.lit(SALTS)))
    per_salt = cut(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = places(plan_bins(counts, cap))
    plan = spark.createDataFrame(rows, "size bigint, begin bigint, stop bigint, each bigint, bin bigint, at bigint")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = small(per_salt.select(F.col("length").alias("l"), F.col("salt").alias("s"),
                                    F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("piece_row")) - 1)
    ranked = ranked.join(offsets, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s"))).withColumn(
        "rank", F.col("rank") + F.col("skip"))
    placed = ranked.join(small(plan), (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("begin"))
                         & (F.col("rank") < F.col("stop")))
    nth = F.col("rank") - F.col("begin")
    return placed.select(
        *[c for c in made.columns if c != "piece_row"], (F.col("bin") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"))


def op8_packing(spark, sf_dir):
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
