"""Near duplicates by MinHash bands and odd sketches (operator 13).

Texts: lower-case A-Z, words, the set of distinct ``shingle``-word shingles
(fewer words: the whole sequence as one). Shingles are compared by 64-bit
hashes, whole sets by the 128-bit digest of their hashes, so copies are one
node however many rows hold them.

Candidates share a band of ``rows`` MinHash samples in one of ``bands`` bands;
with 30 bands of 5 a pair at similarity 0.85 shares none with a probability of
2e-8. Nodes that share a band with another get an odd sketch: ``samples`` more
MinHash values are folded into ``bits`` parity bits. The XOR of two sketches
has a one for every position hit an odd number of times by values that differ,
so its population count estimates the similarity, most precisely where it is
high. A pair is dropped only if its count exceeds what a pair at the threshold
shows by ``SPREADS`` standard deviations (``most_ones``, a probability of about
1e-9); the others are confirmed on the full sets.

Not all pairs of a bucket are looked at. First every node meets two nodes of
each of its buckets, the one with most copies and the one with least hash;
confirmed pairs are united. Then only nodes of one bucket that are still in
different components meet: their sketches are compared inside the join, a pair
is emitted in the first band that it shares, and confirmed. Components over
all confirmed pairs are the answer: a pair that was not looked at lies in one
component already, so none is lost. Comparisons (not rows) inside a bucket of
many components are quadratic; the join's skew handling splits them.

Defined results: null texts and texts without words have the empty set and
link with nothing. A null id is a member but names no group unless all its
ids are null. Repeated rows are members like others; rows with equal ids and
different texts are told apart. Ties do not arise: the smallest id names a
group. Very long texts are shingled whole, their hashes sampled in pieces. An
empty table gives an empty result. Columns of the input keep their values; the
new one gets an underscore if its name is taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, fresh, small, table
from lendlens.llm.simhash import connected_components

BANDS, ROWS = 30, 5
SAMPLES, BITS = 1024, 2048
SPREADS = 6.0
#: Hash values of a text that are sampled at once.
AT_ONCE = 4096


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit values of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, shingle: int = 5) -> np.ndarray:
    """Distinct hashes of the shingles of a text, ascending."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    of = np.fromiter((xxhash.xxh64_intdigest(t) for t in tokens), np.uint64, len(tokens))
    size = min(shingle, len(tokens))
    n = len(tokens) - size + 1
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + of[k : k + n])
    return np.unique(h)


def min_hashes(h: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Least product (modulo 2 ** 64) with each factor over the hashes."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(h), AT_ONCE):
        np.minimum(least, np.multiply.outer(factors, h[k : k + AT_ONCE]).min(axis=1), out=least)
    return least


def band_keys(h: np.ndarray, bands: int, rows: int) -> np.ndarray:
    of = min_hashes(h, _odd_numbers(bands * rows, 1)).reshape(bands, rows)
    key = np.zeros(bands, np.uint64)
    for k in range(rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + of[:, k])
    return key


def odd_sketch(h: np.ndarray, samples: int, bits: int) -> np.ndarray:
    """``bits`` parities as 64-bit words of the samples' positions."""
    numbered = _mix(min_hashes(h, _odd_numbers(samples, 2)) + np.arange(samples, dtype=np.uint64))
    ones = np.bincount((numbered % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8)).view(">u8").astype(np.uint64)


def most_ones(percent: int, samples: int, bits: int, spreads: float = SPREADS) -> int:
    """Ones in the XOR of two sketches that a pair of similarity
    ``percent`` / 100 exceeds only by more than ``spreads`` deviations: the
    number of differing values is binomial, each flips a random parity."""
    j = percent / 100
    d, n = 2 * samples * (1 - j), bits
    keep = (1 - 2 / n) ** d
    mean = n / 2 * (1 - keep)
    places = max(0.0, (n + n * (n - 1) * (1 - 4 / n) ** d - n * n * keep * keep) / 4)
    return int(mean + spreads * sqrt(places + (keep * 2) ** 2 * samples * j * (1 - j))) + 1


def _signatures(texts: pa.Array, shingle: int, bands: int, rows: int) -> pa.Array:
    n, node, keys = [], [], []
    for t in texts.to_pylist():
        h = shingle_hashes(t, shingle)
        n.append(len(h))
        node.append(hashlib.md5(h.tobytes()).digest() if len(h) else None)
        keys.append(band_keys(h, bands, rows).view(np.int64) if len(h) else None)
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                                      names=["n", "node", "bands"])


def _details(texts: pa.Array, shingle: int, samples: int, bits: int) -> pa.Array:
    sets = [shingle_hashes(t, shingle) for t in texts.to_pylist()]
    words = [odd_sketch(h, samples, bits).view(np.int64) for h in sets]
    return pa.StructArray.from_arrays([pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64())),
                                       pa.array(words, pa.list_(pa.int64()))], names=["hashes", "sketch"])


def _udf(fn, kind: str, *args):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield fn(texts, *args)

    return F.arrow_udf(run, kind)


def _alike(a: str, b: str, words: int, percent: int, limit: int) -> Column:
    """Sizes and sketches of two sides admit the similarity."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    ones = F.bit_count(F.col(f"{a}.w0").bitwiseXOR(F.col(f"{b}.w0")))
    for k in range(1, words):
        ones = ones + F.bit_count(F.col(f"{a}.w{k}").bitwiseXOR(F.col(f"{b}.w{k}")))
    return sizes & (ones <= limit)


def _confirmed(pairs: DataFrame, details: DataFrame, percent: int, share: int = 1000) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. A node may occur
    in very many pairs, so its set is dealt to as many parts as it has
    ``share`` pairs."""
    often = pairs.groupBy("b").agg(F.floor(F.count(F.lit(1)) / share).cast("int").alias("most")).withColumnRenamed("b", "of")
    sets = details.select(F.col("node"), "n", "hashes")
    right = sets.join(often, F.col("node") == F.col("of")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("most")))).select(
        F.col("node").alias("b_node"), "part", F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    left = pairs.join(often, F.col("b") == F.col("of")).withColumn(
        "part", F.pmod(F.xxhash64("a"), F.col("most") + 1).cast("int")).select("a", "b", "part")
    met = left.join(right, (left["b"] == right["b_node"]) & (left["part"] == right["part"])).select("a", "b", "nb", "hb")
    met = met.join(sets.select(F.col("node").alias("a_node"), F.col("n").alias("na"), F.col("hashes").alias("ha")),
                   F.col("a") == F.col("a_node"))
    both = F.size(F.array_intersect("ha", "hb"))
    return met.filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _links(nodes: DataFrame, texts: DataFrame, percent: int, bands: int, shingle: int, samples: int, bits: int) -> DataFrame | None:
    """Confirmed pairs (a, b) that connect all nodes that any confirmed pairs
    connect; None if no two nodes share a band."""
    keys = nodes.select("node", "copies", F.posexplode("bands").alias("band", "key"))
    buckets = keys.groupBy("band", "key").agg(
        F.max(F.struct("copies", "node"))["node"].alias("first"), F.min(F.struct(F.xxhash64("node").alias("h"), "node"))["node"].alias("second"),
        F.count(F.lit(1)).alias("of")).filter("of > 1").drop("of")
    crowded = cut(keys.join(buckets, ["band", "key"]).drop("copies"), "crowded")
    shared = cut(crowded.select("node").distinct(), "shared")
    if shared.isEmpty():
        return None
    # a text of each of these nodes, whose set and sketch are made anew
    wanted = small(nodes.join(shared, "node", "left_semi").select("node", F.col("least").alias("of"), F.col("h").alias("hash")))
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("hash"))).select("node", "text")
    made = _udf(_details, "hashes array<bigint>, sketch array<bigint>", shingle, samples, bits)
    words = bits // 64
    details = cut(found.dropDuplicates(["node"]).select("node", made("text").alias("d")).select(
        "node", F.size("d.hashes").cast("bigint").alias("n"), "d.hashes", *[F.col("d.sketch")[k].alias(f"w{k}") for k in range(words)]),
        "sketches")
    marks = details.drop("hashes")
    limit = most_ones(percent, samples, bits)

    stars = crowded.select("node", F.explode(F.array("first", "second")).alias("centre")).filter("node <> centre")
    stars = stars.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"), "node", "centre").dropDuplicates(["a", "b"])
    likely = stars.select("node", "centre").alias("s").join(marks.alias("x"), F.col("s.node") == F.col("x.node")).join(
        marks.alias("y"), F.col("s.centre") == F.col("y.node")).filter(_alike("x", "y", words, percent, limit))
    tested = cut(likely.select(F.col("s.node").alias("a"), F.col("s.centre").alias("b")), "stars")
    links = cut(_confirmed(tested, details, percent), "links")
    drop(tested)

    # nodes of one bucket in different components so far
    roots = connected_components(links)
    placed = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("band", "key")
    left = placed.join(open_, ["band", "key"], "left_semi").join(nodes.select("node", "bands"), "node").join(marks, "node")
    left = cut(left, "open")
    x, y = left.alias("x"), left.alias("y")
    here = F.array_position(F.zip_with("x.bands", "y.bands", lambda p, q: p == q), True) == F.col("x.band") + 1
    apart = (F.col("x.root") != F.col("y.root")) & (F.col("x.node") > F.col("y.node"))
    pairs = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & apart
                   & _alike("x", "y", words, percent, limit) & here)
    pairs = cut(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "pairs")
    more = cut(_confirmed(pairs, details, percent), "links")
    for t in (crowded, shared, details, left, pairs):
        drop(t)
    return links.union(more)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "near", shingle: int = 5,
                    percent: int = 85, bands: int = BANDS, rows: int = ROWS, samples: int = SAMPLES, bits: int = BITS) -> DataFrame:
    """``df`` without its text, with a struct column ``out``: ``n_shingles``,
    ``component`` (the smallest id of the group) and ``kept`` (it is this id)."""
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    others = [c for c in df.columns if c != text_col]
    s, h, i, g, o = fresh(df, "signature", "text_hash", "group_id", "group_node", out)
    made = _udf(_signatures, "n bigint, node binary, bands array<bigint>", shingle, bands, rows)
    marked = cut(df.withColumn(s, made(F.col(text_col))).withColumn(h, F.xxhash64(text_col)).drop(text_col), "signatures")
    nodes = cut(marked.filter(F.col(f"{s}.n") > 0).groupBy(F.col(f"{s}.node").alias("node")).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"),
                                                          F.col(h).alias("h"))).alias("one"),
        F.first(f"{s}.bands").alias("bands")).select("node", "copies", F.col("one.id").alias("least"), F.col("one.h").alias("h"), "bands"), "nodes")
    links = _links(nodes, df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), percent, bands, shingle, samples, bits)
    groups = nodes.select("node", F.col("least").alias("component"))
    if links is not None:
        linked = groups.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = linked.groupBy("root").agg(F.min("component").alias("component"))
        groups = linked.select("node", "root").join(least, "root").select("node", "component")
    groups = groups.select(F.col("node").alias(g), F.col("component").alias(i))
    joined = marked.join(groups, F.col(f"{s}.node") == F.col(g), "left")
    component = F.when(F.col(f"{s}.n") > 0, F.col(i)).otherwise(F.col(id_col))
    return joined.select(*[F.col(c) for c in others], F.struct(
        F.col(f"{s}.n").alias("n_shingles"), component.alias("component"),
        F.col(id_col).eqNullSafe(component).alias("kept")).alias(o))


def op13_odd_sketch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "near.n_shingles", F.col("near.component").alias("component_id"), "near.kept")
