"""Benchmark decontamination by a prefix-filtered set join (operator 7).

Words are runs of digits, lower-cased letters a-z and non-ASCII characters. A
window is ``window`` consecutive words of a benchmark item; an item with
fewer words, but not none, is one window. The join looks for documents that
contain a window exactly (containment 1), so one shingle per window is a
sufficient prefix: its rarest, by occurrences in all documents. A document
position that holds a prefix shingle gives a candidate alignment of the
window; it must lie inside the document (length and positional bounds) and is
then verified word by word.

The benchmark side is sent to the tasks in blocks of at most
``BLOCK_WORDS`` words of items; documents stream past each block. Two scans
of the documents: occurrence counts of the benchmark's shingles, then the
join.

Defined results: null or empty texts have no words, hit nothing and are not
contaminated. Items without words have no window; items with a null id mark
words but are not listed. Repeated rows, items and ids are judged alike (equal
item ids count once). An empty benchmark leaves every document clean; an empty
table gives an empty result. A clashing column of the input keeps its values.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import fresh, per_text, table

#: Words of benchmark items that one block holds at most (an item is whole).
BLOCK_WORDS = 1_000_000
SHINGLE = 3

# every ASCII character but digits and letters separates; A-Z become a-z
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def fold_words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Windows:
    """The distinct windows of a block of items over a vocabulary of ints."""

    def __init__(self, items: list[tuple], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple, set] = defaultdict(set)
        for item_id, tokens in items:
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens)
            for k in range(max(1, len(ids) - window + 1)):
                owners[ids[k : k + window]].add(item_id)
        self.windows = list(owners)
        self.owners = [sorted(x for x in owners[w] if x is not None) for w in self.windows]
        self.base = len(self.vocabulary) + 1
        # shingles of one width: a window shorter than that is padded by its own key
        self.widths = sorted({min(SHINGLE, len(w)) for w in self.windows})

    def keys(self, ids: np.ndarray, width: int) -> np.ndarray:
        """A number for each run of ``width`` words; -1 where one is unknown."""
        n = len(ids) - width + 1
        if n <= 0:
            return np.empty(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(width):
            part = ids[k : n + k]
            out, known = out * self.base + part, known & (part >= 0)
        return np.where(known, out, -1)

    def shingles(self) -> dict[int, np.ndarray]:
        out = {}
        for width in self.widths:
            keys = [self.keys(np.array(w), width) for w in self.windows if min(SHINGLE, len(w)) == width]
            out[width] = np.unique(np.concatenate(keys))
        return out

    def choose_prefixes(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep, of each window, its rarest shingle and that one's place."""
        self.prefixes: dict[int, dict[int, list[tuple[int, int]]]] = {w: defaultdict(list) for w in self.widths}
        for i, w in enumerate(self.windows):
            width = min(SHINGLE, len(w))
            keys = self.keys(np.array(w), width).tolist()
            at = min(range(len(keys)), key=lambda k: (counts.get((width, keys[k]), 0), keys[k], k))
            self.prefixes[width][keys[at]].append((i, at))
        self.sorted = {w: np.array(sorted(p), np.int64) for w, p in self.prefixes.items()}

    def number(self, tokens: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(t, -1) for t in tokens), np.int64, len(tokens))

    def find(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(start, window number) of every window occurrence."""
        found, listed = [], None
        for width in self.widths:
            keys, prefix = self.keys(ids, width), self.sorted[width]
            if not len(keys) or not len(prefix):
                continue
            at = np.minimum(np.searchsorted(prefix, keys), len(prefix) - 1)
            for p in np.nonzero(prefix[at] == keys)[0].tolist():
                for i, offset in self.prefixes[width][int(keys[p])]:
                    w, start = self.windows[i], p - offset
                    if start < 0 or start + len(w) > len(ids):
                        continue
                    listed = ids.tolist() if listed is None else listed
                    if tuple(listed[start : start + len(w)]) == w:
                        found.append((start, i))
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Items with words, in blocks of bounded size, streamed to the driver."""
    block, size = [], 0
    for r in benchmark.select(id_col, text_col).toLocalIterator():
        tokens = fold_words(r[1])
        if tokens and block and size + len(tokens) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        if tokens:
            block.append((r[0], tokens))
            size += len(tokens)
    if block:
        yield block


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", window: int = 13, least_share: float = 0.05,
                  out: str = "contamination") -> DataFrame:
    """``docs`` with a struct column ``out``: n_words, n_hit, items (sorted as
    strings), spans of hit words, contaminated (hit share at least
    ``least_share``)."""
    spark, (o,) = docs.sparkSession, fresh(docs, out)
    per_mille = round(1 / least_share)
    indexes = []
    for block in _blocks(benchmark, item_col, item_text):
        index = Windows(block, window)
        shingles = spark.sparkContext.broadcast((index.vocabulary, index.base, index.shingles()))

        def occurrences(batches: Iterator[pd.DataFrame], shingles=shingles, shell=index.__class__) -> Iterator[pd.DataFrame]:
            vocabulary, base, wanted = shingles.value
            probe = shell([], 1)
            probe.vocabulary, probe.base = vocabulary, base
            sums = {w: np.zeros(len(k), np.int64) for w, k in wanted.items()}
            for batch in batches:
                for text in batch[text_col]:
                    ids = probe.number(fold_words(text))
                    for w, known in wanted.items():
                        keys = probe.keys(ids, w)
                        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                        sums[w] += np.bincount(at[known[at] == keys], minlength=len(known))
            for w, known in wanted.items():
                some = np.nonzero(sums[w])[0]
                yield pd.DataFrame({"w": np.full(len(some), w), "k": known[some], "n": sums[w][some]})

        counted = docs.select(text_col).mapInPandas(occurrences, "w int, k bigint, n bigint")
        rows = counted.groupBy("w", "k").agg(F.sum("n").alias("n")).collect()  # at most the block's shingles
        index.choose_prefixes({(r["w"], r["k"]): r["n"] for r in rows})
        indexes.append(spark.sparkContext.broadcast(index))

    def judge(text: str | None) -> tuple:
        tokens = fold_words(text)
        hit, items = np.zeros(len(tokens) + 1, np.int64), set()
        for shared in indexes:
            index = shared.value
            for start, i in index.find(index.number(tokens)):
                hit[start] += 1
                hit[start + len(index.windows[i])] -= 1
                items.update(index.owners[i])
        inside = np.concatenate(([0], (np.cumsum(hit[:-1]) > 0).astype(np.int64), [0]))
        edges = np.diff(inside)
        starts, ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        n_hit = int(inside.sum())
        return (len(tokens), n_hit, sorted(str(x) for x in items), [[int(a), int(b)] for a, b in zip(starts, ends, strict=True)],
                n_hit > 0 and per_mille * n_hit >= len(tokens))

    returns = "n_words bigint, n_hit bigint, items array<string>, spans array<array<bigint>>, contaminated boolean"
    return docs.withColumn(o, per_text(judge, returns)(F.col(text_col)))


def op7_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contamination")
    c = "contamination."
    return judged.select(
        "doc_id", F.col(c + "n_words").alias("n_words"), F.col(c + "n_hit").alias("n_hit"),
        F.size(c + "items").cast("long").alias("n_items"),
        F.sha2(F.array_join(c + "items", ","), 256).alias("items_sha256"), F.col(c + "contaminated").alias("contaminated"))


OP7_SQL = r"""
WITH fold AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, w FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k : k + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS k FROM items)),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT rid, p, n, array_to_string(w[p : p + n - 1], ' ') AS s
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM fold, sizes WHERE len(w) >= n)),
found AS (SELECT rid, p, starts.n, item_id FROM starts JOIN windows ON starts.s = windows.s AND starts.n = windows.n),
hits AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM found) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM fold LEFT JOIN hits USING (rid) LEFT JOIN named USING (rid)
"""
