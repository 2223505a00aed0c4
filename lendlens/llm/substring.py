"""Substring deduplication with suffix automata of reference shards (operator 6).

A window is ``window`` consecutive words of one text; each word inside a
window whose word sequence also starts anywhere else is removed.

The reference is the corpus itself, so its automata cannot be broadcast whole;
the corpus is dealt to shards such that equal windows meet in one shard:

1. Copies of a text are one row with a weight, in a table bucketed by the
   text's hash; later joins on that key move no text. All windows of a text
   with copies are repeated.
2. The anchor of a window is the leftmost smallest of its ``GRAM``-word
   hashes: equal windows have equal anchors. Windows with one anchor in a row
   form a segment; only anchors that occur twice or more are followed.
3. Distinct segments (with their weights) go to shards by anchor. A shard's
   segments are built into one suffix automaton with occurrence counts, and
   then streamed through it for matching statistics: where the match is at
   least a window long, the state of the last ``window`` words tells how often
   that window occurs. Hashes only bring candidates together; the automaton
   compares the words.
4. An anchor with more than ``hot`` distinct segments (a passage that very
   many texts embed) has its segments cut into single windows, which are
   combined before the shuffle and dealt to further shards by their content.
5. The windows found are joined to maximal spans per text and removed.

Defined results: null and empty texts have no words and keep none. Repeated
rows are documents of their own, so each removes the other's windows. Texts
shorter than a window keep all words. An empty table gives an empty result.
Columns of the input keep their values; the output's name gets an underscore
where it clashes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, fresh, per_text, small, table

GRAM = 8
#: Windows whose anchors are sought at once, and words of a shard's automaton
#: after which the next anchor begins a new one.
WINDOWS_AT_ONCE, SHARD_WORDS = 1 << 16, 50_000
#: Texts whose segments a task holds at once.
TEXTS_AT_ONCE = 200
KEY = ["k1", "k2"]


class SuffixAutomaton:
    """Suffix automaton of several sequences with weighted occurrence counts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, sequence, weight: int) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)
            self.count[last] += weight

    def finish(self) -> None:
        """Carry the counts of end positions up the suffix links."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence, window: int) -> list[int]:
        """Starts of the windows of ``sequence`` that occur twice or more."""
        state, length, starts = 0, 0, []
        for end, c in enumerate(sequence):
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            if length >= window:
                while self.length[self.link[state]] >= window:  # later matches may be as long as needed only
                    state = self.link[state]
                    length = self.length[state]
                if self.count[state] >= 2:
                    starts.append(end - window + 1)
        return starts


def anchors(tokens: list[bytes], window: int) -> tuple[list[int], list[int], list[int]]:
    """Anchor hashes, first and last window starts of the text's segments."""
    n = len(tokens) - window + 1
    if n <= 0:
        return [], [], []
    gram = min(GRAM, window)
    word = np.fromiter(map(zlib.crc32, tokens), np.uint64, len(tokens))
    g = np.zeros(len(word) - gram + 1, np.uint64)
    for k in range(gram):
        g = g * np.uint64(0x9E3779B97F4A7C15) + word[k : k + len(g)]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    wide = window - gram + 1
    at = np.concatenate([
        k + np.arange(min(n - k, WINDOWS_AT_ONCE)) + np.lib.stride_tricks.sliding_window_view(
            g[k : k + WINDOWS_AT_ONCE + wide - 1], wide).argmin(1) for k in range(0, n, WINDOWS_AT_ONCE)])
    first = np.nonzero(np.append(True, at[1:] != at[:-1]))[0]
    last = np.append(first[1:], n) - 1
    return g[at[first]].view(np.int64).tolist(), first.tolist(), last.tolist()


def _hash2(data: bytes) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)
    return int(d[0]), int(d[1])


def _runs(starts: list[int]) -> list[list[int]]:
    """Consecutive numbers as [first, last]."""
    out: list[list[int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return out


def _through_shards(parts: DataFrame, window: int, by: list[str]) -> DataFrame:
    """(s1, s2, runs) of the segments that hold repeated windows. ``parts``:
    ``by``, s1, s2, seg, weight; rows of equal ``by`` share an automaton."""
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, same, size, last, out = [], [], 0, None, []

        def close() -> None:
            """Rows of equal ``by`` are complete. A segment of weight 2 repeats
            all its windows; it is a reference only where others are asked for."""
            nonlocal size
            alone = [s for s in same if s[3] < 2]
            out.extend((s1, s2, [[0, bytes(seg).count(b" ") + 1 - window]]) for s1, s2, seg, weight in same if weight > 1)
            if alone and len(same) > 1:
                shard.extend(same)
                size += sum(bytes(s[2]).count(b" ") + 1 for s in same)
            same.clear()

        def judge() -> None:
            nonlocal size
            automaton, number = SuffixAutomaton(), {}
            coded = [[number.setdefault(w, len(number)) for w in bytes(seg).split(b" ")] for _, _, seg, _ in shard]
            for ids, (*_, weight) in zip(coded, shard, strict=True):
                automaton.add(ids, weight)
            automaton.finish()
            for ids, (s1, s2, _, weight) in zip(coded, shard, strict=True):
                if weight < 2 and (starts := automaton.repeated(ids, window)):
                    out.append((s1, s2, _runs(starts)))
            shard.clear()
            size = 0

        def ready() -> pd.DataFrame:
            made = pd.DataFrame(out, columns=["s1", "s2", "runs"])
            out.clear()
            return made

        for batch in batches:
            for *key, s1, s2, seg, weight in zip(*[batch[c] for c in (*by, "s1", "s2", "seg", "weight")], strict=True):
                if key != last:
                    close()
                    if size >= SHARD_WORDS:
                        judge()
                last = key
                same.append((s1, s2, seg, int(weight)))
            yield ready()
        close()
        judge()
        yield ready()

    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n, *by).sortWithinPartitions(*by, "s1", "s2").mapInPandas(
        stream, "s1 bigint, s2 bigint, runs array<array<int>>")


def _combined(df: DataFrame, *keys: str) -> DataFrame:
    """Equal segments as one, combined before the shuffle; a weight over 2
    says no more than 2."""
    return df.groupBy(*keys).agg(F.first("seg").alias("seg"), F.least(F.sum("weight"), F.lit(2)).alias("weight"))


def repeated_windows(segments: DataFrame, window: int, hot: int) -> DataFrame:
    """(s1, s2, runs): window starts, from 0 in the segment, that occur twice."""
    whole = cut(_combined(segments, "h", "s1", "s2"), "whole-segments")
    crowded = cut(whole.groupBy("h").count().filter(F.col("count") > hot).select(F.col("h").alias("hot_h")), "hot-anchors")
    crowded_side = small(crowded)
    plain = _through_shards(whole.join(crowded_side, F.col("h") == F.col("hot_h"), "left_anti"), window, ["h"])

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for s1, s2, seg, weight in zip(*[batch[c] for c in ("s1", "s2", "seg", "weight")], strict=True):
                tokens = bytes(seg).split(b" ")
                cuts = [b" ".join(tokens[k : k + window]) for k in range(len(tokens) - window + 1)]
                yield pd.DataFrame([(s1, s2, k, *_hash2(c), c, weight) for k, c in enumerate(cuts)],
                                   columns=["o1", "o2", "at", "s1", "s2", "seg", "weight"])

    single = whole.join(crowded_side, F.col("h") == F.col("hot_h"), "left_semi").mapInPandas(
        windows, "o1 bigint, o2 bigint, at int, s1 bigint, s2 bigint, seg binary, weight bigint")
    single = cut(single, "single-windows")
    found = _through_shards(_combined(single, "s1", "s2"), window, ["s1", "s2"]).select(
        F.col("s1").alias("w1"), F.col("s2").alias("w2"))
    back = single.select("o1", "o2", "at", "s1", "s2").join(found, (F.col("s1") == F.col("w1")) & (F.col("s2") == F.col("w2")))
    per_segment = back.groupBy("o1", "o2").agg(F.collect_set("at").alias("at")).select(
        F.col("o1").alias("s1"), F.col("o2").alias("s2"), F.transform("at", lambda x: F.array(x, x)).alias("runs"))
    return plain.unionByName(per_segment)


def _words_of(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def substring_dedup(df: DataFrame, text_col: str = "text", window: int = 35, hot: int = 256, out: str = "dedup",
                    keep_text: bool = True) -> DataFrame:
    """``df`` (without its text unless ``keep_text``) with a struct column
    ``out``: n_words, n_removed, kept_sha256 and, with ``keep_text``, kept."""
    spark = df.sparkSession
    (o,) = fresh(df, out)
    text = F.coalesce(F.col(text_col), F.lit(""))
    k1, k2 = F.xxhash64(text), F.xxhash64(F.lit(7), text)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"lendlens_texts_{uuid.uuid4().hex[:12]}"
    distinct = df.select(k1.alias("k1"), k2.alias("k2"), text.alias("text")).groupBy(*KEY).agg(
        F.first("text").alias("text"), F.least(F.count(F.lit(1)), F.lit(2)).alias("weight"))
    distinct.write.option("compression", "zstd").bucketBy(n, *KEY).sortBy(*KEY).saveAsTable(name)
    texts = spark.table(name)

    found = texts.select(*KEY, per_text(lambda s: anchors(_words_of(s), window), "h array<bigint>, a array<int>, b array<int>")(
        F.col("text")).alias("f"))
    marks = cut(found, "anchors").select(*KEY, F.explode(F.arrays_zip("f.h", "f.a", "f.b")).alias("m")).select(*KEY, "m.h", "m.a", "m.b")
    often = marks.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    followed = marks.join(often, "h", "left_semi")
    # a text with copies repeats all its windows: no anchor needs to say so
    listed = followed.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("a", "b", "h"))).alias("m")).select(
        *KEY, F.col("m.h").alias("h"), F.col("m.a").alias("a"), F.col("m.b").alias("b"))

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (whole.iloc[k : k + TEXTS_AT_ONCE] for whole in batches for k in range(0, len(whole), TEXTS_AT_ONCE)):
            segs, owner = [], np.repeat(np.arange(len(batch)), batch["h"].map(len))
            for text, firsts, lasts in zip(batch["text"], batch["a"], batch["b"], strict=True):
                tokens = _words_of(text)
                segs += [b" ".join(tokens[a : b + window]) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]
            if not segs:
                continue
            both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, segs)), np.int64).reshape(-1, 2)
            yield pd.DataFrame({
                "h": np.concatenate(batch["h"].to_list()), "s1": both[:, 0], "s2": both[:, 1], "k1": batch["k1"].to_numpy()[owner],
                "k2": batch["k2"].to_numpy()[owner], "a": np.concatenate(batch["a"].to_list()), "seg": segs,
                "weight": batch["weight"].to_numpy()[owner]})

    segments = cut(texts.join(listed, KEY).mapInPandas(
        segment, "h bigint, s1 bigint, s2 bigint, k1 bigint, k2 bigint, a int, seg binary, weight bigint"), "segments")
    runs = cut(repeated_windows(segments, window, hot), "repeated")
    spans = segments.select(*KEY, "a", "s1", "s2").join(runs, ["s1", "s2"]).select(*KEY, F.explode(F.transform(
        "runs", lambda r: F.array(r[0] + F.col("a"), r[1] + F.col("a") + window))).alias("span"))
    spans = spans.groupBy(*KEY).agg(F.collect_list("span").alias("spans"))

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for *key, text, weight, found in zip(*[batch[c] for c in (*KEY, "text", "weight", "spans")], strict=True):
                tokens = _words_of(text)
                gone = np.zeros(len(tokens) + 1, np.int64)
                if weight > 1 and len(tokens) >= window:
                    found = [(0, len(tokens))]
                for a, b in (() if found is None else found):
                    gone[a] += 1
                    gone[b] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, g in zip(tokens, gone, strict=True) if not g])
                rows.append((*key, len(tokens), int(gone.sum()), kept.decode()))
            yield pd.DataFrame(rows, columns=[*KEY, "n_words", "n_removed", "kept"])

    done = texts.join(spans, KEY, "left").mapInPandas(remove, "k1 bigint, k2 bigint, n_words bigint, n_removed bigint, kept string")
    done = done.withColumn("kept_sha256", F.sha2("kept", 256))
    done = cut(done if keep_text else done.drop("kept"), "without-repeats")
    drop(segments), drop(runs)
    spark.sql(f"DROP TABLE {name}")
    result = done.select(F.col("k1").alias("done_k1"), F.col("k2").alias("done_k2"), F.struct(
        *[c for c in ("n_words", "n_removed", "kept_sha256", "kept") if c in done.columns]).alias(o))
    keyed = df if keep_text else df.withColumns(dict(zip(fresh(df, "k1", "k2"), (k1, k2), strict=True)))
    if keep_text:
        both = keyed.join(result, (k1 == F.col("done_k1")) & (k2 == F.col("done_k2")))
        return both.select(*[df[c] for c in df.columns], o)
    a, b = keyed.columns[-2:]
    keyed = keyed.drop(text_col)
    return keyed.join(result, (keyed[a] == F.col("done_k1")) & (keyed[b] == F.col("done_k2"))).select(
        *[keyed[c] for c in df.columns if c != text_col], o)


def op6_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup(docs, keep_text=False).select(
        "doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT rid, p, md5(array_to_string(w[p : p + 34], ' ')) AS s
            FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, q FROM (
           SELECT rid, unnest(range(p, p + 35)) AS q FROM windows WHERE s IN (SELECT s FROM again))),
placed AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
per AS (SELECT rid, count(gone.q) AS n, string_agg(word, ' ' ORDER BY placed.q) FILTER (gone.q IS NULL) AS kept
        FROM placed LEFT JOIN gone USING (rid, q) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN per USING (rid)
"""
