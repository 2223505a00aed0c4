import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lendlens.llm import simhash
from lendlens.llm.simhash import allot, connected_components, fingerprint, group_bits, links, op5_simhash, simhash_dedup, simhash_groups

from . import cases
from ..conftest import SF_SMALL


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    """rows: (id, fingerprint); the smallest id reachable, by fingerprint."""
    prints = np.array(sorted({f for _, f in rows}), np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(prints[i] ^ prints) <= 4)[0]:
            root[find(i)] = find(int(j))
    at = {int(f): i for i, f in enumerate(prints)}
    least = defaultdict(list)
    for id_, f in rows:
        least[find(at[f])].append(id_)
    return {f: min((x for x in least[find(i)] if x is not None), default=None) for f, i in at.items()}


def test_fingerprint():
    for t in (None, "", " \n", "One", "a b c", "A b C d", "a b c d e f g", cases.PROSE, cases.LONG[:3000], "é Ü x"):
        assert fingerprint(t) % (1 << 64) == brute_fingerprint(t)


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in cases.documents(spark).collect()}
    want = brute_components([(i, brute_fingerprint(t)) for i, t in texts.items()])
    rows = op5_simhash(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        f = brute_fingerprint(texts[r["doc_id"]])
        assert (r["fingerprint"], r["component_id"]) == (f"{f:016x}", want[f])


def test_links_lose_none(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-(1 << 63), (1 << 63) - 1, 40)
    values = set(base.tolist())
    for v in base.tolist():
        for k in range(8):
            flip = sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False))
            values.add(int(np.int64(np.uint64(v % (1 << 64)) ^ np.uint64(flip))))
    values = sorted(values)
    u = np.array(values, np.int64).view(np.uint64)
    want = {(values[i], values[j]) for i in range(len(u)) for j in range(len(u)) if values[i] < values[j] and np.bitwise_count(u[i] ^ u[j]) <= 4}
    nodes = spark.createDataFrame([(v,) for v in values], "node long")
    got = [(r["a"], r["b"]) for r in links(nodes, "node", 4).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_thresholds_cover_the_distance():
    for widths in ([64], [32, 32], [22, 21, 21], [16] * 4, [13, 13, 13, 13, 12]):
        for n in (10, 10**6, 10**9):
            _, ts = allot(widths, n, [n * n / 2 / 2.0**w for w in widths], 4)
            assert sum(t + 1 for t in ts) == 5 and all(t >= -1 for t in ts)
    corr = np.zeros((64, 64))
    corr[3, 60] = corr[60, 3] = 0.9
    groups = group_bits(corr, 5)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({3, 60} <= set(g) for g in groups)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "simhash", "simhash_f", "node")
    rows = simhash_groups(df).collect()
    assert len(rows) == df.count()
    none = [r for r in rows if r["fingerprint"] == 0]
    assert len(none) == 4 and {r["component"] for r in none} == {1}
    prose = [r for r in rows if r["fingerprint"] == fingerprint(cases.PROSE)]
    assert len(prose) == 4 and {r["component"] for r in prose} == {4}
    kept = simhash_dedup(cases.clashing(cases.awkward(spark), "row_hash", "simhash_f"))
    assert kept.columns == [*cases.awkward(spark).columns, "row_hash", "simhash_f"]
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == [1, 4, 6, 7, 8]
    assert simhash_groups(cases.empty(spark)).count() == 0 and simhash_dedup(cases.empty(spark)).count() == 0


def test_part_choice_grows_finer_keys(spark):
    nodes = spark.createDataFrame([(int(v),) for v in np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 500)], "node long")
    parts = simhash.choose_parts(nodes, "node", 4)
    assert sum(t + 1 for _, t in parts) == 5


def test_plans_stay_small():
    """Whatever the size, a fingerprint probes a part with few values."""
    from math import comb
    rng = np.random.default_rng(3)
    corr = rng.random((64, 64))
    for n in (0, 1, 2, 1000, 10**9):
        for parts in range(1, 6):
            groups = group_bits(corr, parts)
            cost, ts = allot([len(g) for g in groups], n, [n * n / 2 / 2 ** len(g) for g in groups], 4)
            if cost < float("inf"):
                assert sum(t + 1 for t in ts) == 5
                assert all(sum(comb(len(g), k) for k in range(t + 1)) <= simhash.MOST_PROBES for g, t in zip(groups, ts, strict=True))
        assert cost < float("inf")  # five parts


def test_tiny_tables(spark):
    for n in (0, 1, 2):
        rows = [(i, "same words in this text", "en", "a", 0) for i in range(n)]
        df = spark.createDataFrame(rows, cases.SCHEMA)
        assert {r["component"] for r in simhash_groups(df).collect()} == ({0} if n else set())
        assert simhash_dedup(df).count() == min(n, 1)


def test_large_sides_stay_off_the_driver(spark, monkeypatch):
    """Beyond BROADCAST_ROWS fingerprints no join is planned as a broadcast,
    however small the files are; groups stay the same."""
    from lendlens.llm import common, simhash
    docs = spark.createDataFrame([(i, f"a b c d e f g {i // 3} {i // 3}") for i in range(60)], "doc_id bigint, text string")
    want = sorted(tuple(r) for r in simhash.simhash_groups(docs).collect())
    monkeypatch.setattr(simhash, "off_driver", lambda df, rows: common.off_driver(df, rows, 10))
    out = simhash.simhash_groups(docs)
    assert sorted(tuple(r) for r in out.collect()) == want
    nodes = spark.range(50).select(F.xxhash64("id").alias("node"))
    for df in (out, simhash.links(nodes, "node", 4), simhash.simhash_dedup(docs)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
