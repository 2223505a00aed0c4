"""SimHash near-duplicates by the generalised pigeonhole principle (operator 5).

Fingerprint: lower-case A-Z, words, ``shingle``-word shingles (repeats count;
fewer words: the whole sequence), XXH64 with seed 42; a bit is 1 if it is set
in over half the hashes. No words: fingerprint 0.

Links are sought between distinct fingerprints, so copies cost one row. If the
64 bits are cut into parts and the parts get thresholds t_i (-1: unused) with
sum(t_i + 1) = d + 1, then two fingerprints at most d bits apart differ in at
most t_i bits of some part i. Bits that are set together (correlation over all
fingerprints) share a part; dynamic programming allots the thresholds from the
candidate pairs and probe rows each would cost, the former estimated from the
value counts of each part; the number of parts is the cheapest under the same
costs. Each fingerprint is stored under its parts' values and probes with the
values at most t_i flips away; the join verifies the whole distance and keeps
a pair only in the first part that yields it. Nothing is capped: a frequent
part value makes more comparisons, split by Spark's skew handling, no rows.

Groups are connected components by alternating large-star and small-star steps
on the linked fingerprints.

Defined results: null and empty texts have fingerprint 0 and link with each
other. A null id is a member, but never names a group unless the group has
only null ids. Repeated rows are members like others. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, fresh, off_driver, per_text, table

BITS = 64
#: Costs of the plan choice: a shuffled probe row against one comparison.
ROW_COST, PAIR_COST = 1.0, 0.02
HASHES_AT_ONCE = 1 << 16
#: No part is probed with more values than this by one fingerprint.
MOST_PROBES = 4096


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of one whole text, as a signed integer."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return 0
    joined = memoryview(b" ".join(tokens))
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(BITS, np.int64)
    for k in range(0, n, HASHES_AT_ONCE):
        h = [xxhash.xxh64_intdigest(joined[a:b], 42)
             for a, b in zip(first[k : k + HASHES_AT_ONCE], last[k : k + HASHES_AT_ONCE], strict=True)]
        ones += np.unpackbits(np.array(h, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def bit_statistics(nodes: DataFrame, col: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of each bit, correlation of bit pairs;
    64 x 64 sums per task, added up by Spark."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = ((batch[col].to_numpy(np.int64)[:, None] >> np.arange(BITS)) & 1).astype(np.float64)
            both, n = both + bits.T @ bits, n + len(bits)
        yield pd.DataFrame({"i": np.arange(BITS * BITS + 1), "v": np.append(both.ravel(), n)})

    rows = nodes.select(col).mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for r in rows:
        flat[r["i"]] = r["v"]
    n, both = int(flat[-1]), flat[:-1].reshape(BITS, BITS) / max(flat[-1], 1)
    p = both.diagonal()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return n, p.copy(), (both - np.outer(p, p)) / np.outer(sd, sd)


def group_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of about equal size; the bit most correlated with a
    group joins it next."""
    strength, left, groups = np.abs(corr), set(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (strength[b, [x for x in rest if x != b]].max(initial=0), -b))]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: (strength[b, group].sum(), -b)))
        left -= set(group)
        groups.append(sorted(group))
    return groups


def allot(widths: list[int], n: int, same: list[float], distance: int) -> tuple[float, list[int]]:
    """Least cost and thresholds t_i >= -1 with sum(t_i + 1) = distance + 1.

    ``same[i]``: estimated pairs that agree in part i; within t flips, as many
    more as there are ways to flip."""
    def cost(i: int, t: int) -> float:
        probes = sum(comb(widths[i], k) for k in range(t + 1))
        if probes > MOST_PROBES:
            return float("inf")
        return 0.0 if t < 0 else n * (probes + 1) * ROW_COST + same[i] * probes * PAIR_COST

    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for i in range(len(widths)):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (c, ts) in best.items():
            for t in range(-1, min(distance - used, widths[i]) + 1):
                new = (c + cost(i, t), [*ts, t])
                if used + t + 1 not in step or new < step[used + t + 1]:
                    step[used + t + 1] = new
        best = step
    return best[distance + 1]


def choose_parts(nodes: DataFrame, col: str, distance: int) -> list[tuple[int, int]]:
    """(bit mask, threshold) of each part in use; none for fewer than two
    fingerprints. ``distance + 1`` parts of threshold 0 always stay within
    ``MOST_PROBES``, so a plan is always found."""
    n, p, corr = bit_statistics(nodes, col)
    if n < 2:
        return []
    agree = p * p + (1 - p) * (1 - p)
    plans = []
    for parts in range(1, distance + 2):
        groups = group_bits(corr, parts)
        guess = [n * n / 2 * float(np.prod(agree[g])) for g in groups]
        plans.append((allot([len(g) for g in groups], n, guess, distance)[0], groups))
    groups = min(plans, key=lambda x: x[0])[1]
    masks = [sum(1 << b for b in g) for g in groups]
    counted = nodes.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.col(col).bitwiseAND(_long(m)).alias("value"))
        for i, m in enumerate(masks)])).alias("x")).groupBy("x.part", "x.value").count()
    pairs = dict(counted.groupBy("part").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect())
    _, ts = allot([len(g) for g in groups], n, [pairs.get(i, 0.0) for i in range(len(groups))], distance)
    return [(m, t) for m, t in zip(masks, ts, strict=True) if t >= 0]


def _long(x: int) -> Column:
    return F.lit(x - (1 << BITS) if x >> (BITS - 1) else x).cast("long")


def _flips(mask: int, t: int) -> Column:
    bits = [b for b in range(BITS) if mask >> b & 1]
    return F.array(*[_long(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(bits, k)])


def links(nodes: DataFrame, col: str, distance: int) -> DataFrame:
    """All pairs (a, b), a < b, of distinct values at most ``distance`` bits
    apart, each once."""
    parts = choose_parts(nodes, col, distance)
    v = F.col(col)
    if not parts:
        return nodes.select(v.alias("a"), v.alias("b")).filter(F.lit(False))
    stored = nodes.select(v.alias("b"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), v.bitwiseAND(_long(m)).alias("key")) for i, (m, _) in enumerate(parts)
    ])).alias("x")).select("b", "x.part", "x.key")

    def near(i: int, mask: int, t: int) -> Column:
        return F.transform(_flips(mask, t), lambda x: F.struct(
            F.lit(i).alias("part"), v.bitwiseAND(_long(mask)).bitwiseXOR(x).alias("key")))

    probes = nodes.select(v.alias("a"), F.explode(F.flatten(F.array(*[
        near(i, m, t) for i, (m, t) in enumerate(parts)]))).alias("x")).select("a", "x.part", "x.key")
    differ = F.col("a").bitwiseXOR(F.col("b"))
    earlier = F.lit(False)  # an earlier part has found the pair
    for i, (m, t) in enumerate(parts):
        earlier |= (F.lit(i) < F.col("s.part")) & (F.bit_count(differ.bitwiseAND(_long(m))) <= t)
    return probes.alias("p").join(off_driver(stored, len(parts) * nodes.count()).alias("s"), (F.col("p.part") == F.col("s.part"))
        & (F.col("p.key") == F.col("s.key")) & (F.col("a") < F.col("b"))
        & (F.bit_count(differ) <= distance) & ~earlier).select("a", "b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): root is the smallest
    node reachable. Every round is a written table."""
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    state, size = None, now.count()
    while True:
        # large star: every larger neighbour of a node is tied to its smallest
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select("v", "u"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = cut(both.filter("y > x").join(off_driver(least, 2 * size), "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct(), "large")
        # small star: a node and its smaller neighbours are tied to the smallest
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(off_driver(least, 2 * size), "v").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", "m"))
        small = cut(tied.filter("v <> u").distinct(), "small")
        after = small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        drop(now), drop(large)
        now = small
        if tuple(after) == state:
            return now.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                now.select("u", "u").distinct())
        state, size = tuple(after), after[0]


def with_fingerprint(df: DataFrame, text_col: str, shingle: int, name: str) -> DataFrame:
    (s,) = fresh(df, "simhash")
    return df.withColumn(s, per_text(lambda t: (fingerprint(t, shingle),), "f bigint")(F.col(text_col))).select(
        *df.columns, F.col(f"{s}.f").alias(name))


def _groups(marked: DataFrame, f: str, id_col: str, distance: int) -> DataFrame:
    """(node, component): every distinct fingerprint's smallest reachable id."""
    nodes = cut(marked.groupBy(F.col(f).alias("node")).agg(F.min(id_col).alias("least")), "nodes")
    roots = connected_components(links(nodes, "node", distance))
    size = nodes.count()
    linked = nodes.join(off_driver(roots, size), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component"))
    return off_driver(linked.join(off_driver(least, size), "root").select("node", "component"), size)


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                   distance: int = 4) -> DataFrame:
    """``df`` without its text, with ``fingerprint`` (long) and ``component``."""
    kept = [c for c in df.columns if c != text_col and c not in ("fingerprint", "component")]
    marked = cut(with_fingerprint(df, text_col, shingle, fresh(df, "simhash_f")[0]).drop(text_col), "fingerprints")
    f = marked.columns[-1]
    groups = _groups(marked, f, id_col, distance)
    return marked.join(groups, marked[f] == groups["node"]).select(
        *[marked[c] for c in kept], marked[f].alias("fingerprint"), groups["component"].alias("component"))


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                  distance: int = 4) -> DataFrame:
    """One row of each group, with the columns of ``df``: that of the smallest
    id (non-null first); equal ids are told apart by a hash of the whole row,
    and of wholly equal rows one stays."""
    f, h = fresh(df, "simhash_f", "row_hash")
    row = F.xxhash64(*[F.col(c) for c in df.columns]) if df.columns else F.lit(0)
    marked = cut(with_fingerprint(df, text_col, shingle, f).withColumn(h, row), "fingerprints")
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(h).alias("hash"))
    nodes = cut(marked.groupBy(F.col(f).alias("node")).agg(F.min(order).alias("first")), "nodes")
    roots = connected_components(links(nodes.select("node"), "node", distance))
    size = nodes.count()
    linked = nodes.join(off_driver(roots, size), "node", "left").withColumn("root", F.coalesce("root", "node"))
    stay = linked.groupBy("root").agg(F.min(F.struct("first", "node")).alias("s")).select(
        F.col("s.node").alias("s_node"), F.col("s.first.id").alias("s_id"), F.col("s.first.hash").alias("s_hash"))
    kept = marked.join(off_driver(stay, size), (marked[f] == stay["s_node"]) & (marked[h] == stay["s_hash"])
                       & marked[id_col].eqNullSafe(stay["s_id"]), "left_semi")
    return kept.dropDuplicates([f, h, id_col]).select(*df.columns)


def op5_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))
