import random
import re

import numpy as np
import pytest

from lendlens.llm import oddsketch as od
from lendlens.llm.oddsketch import band_keys, most_ones, near_duplicates, odd_sketch, op13_odd_sketch, shingle_hashes

from . import cases
from ..conftest import SF_SMALL


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(id, text) rows -> n_shingles and smallest reachable id of each row."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for k, (id_, _) in enumerate(rows):
        r = find(k)
        least[r] = id_ if least.get(r) is None else least[r] if id_ is None else min(id_, least[r])
    return [(id_, len(s), least[find(k)], id_ == least[find(k)]) for k, ((id_, _), s) in enumerate(zip(rows, sets))]


def test_shingle_hashes():
    for t in (None, "", " \n", "One", "a b c", "A b C d e", "a b c d e f g a b c d e f g", cases.PROSE, "é Ü x", "a\x1cb c"):
        assert len(shingle_hashes(t)) == len(shingles(t))
    assert shingle_hashes("A b").tolist() == shingle_hashes("a  B\n").tolist() != shingle_hashes("a b c").tolist()


def test_pieces_of_long_texts(monkeypatch):
    h = shingle_hashes(cases.LONG)
    whole = band_keys(h, 30, 5), odd_sketch(h, 256, 512)
    monkeypatch.setattr(od, "AT_ONCE", 7)
    assert all((a == b).all() for a, b in zip(whole, (band_keys(h, 30, 5), odd_sketch(h, 256, 512))))


def test_sketches_admit_pairs_at_the_threshold():
    """Of sets at the threshold none is dropped, of unlike ones nearly all."""
    rng = np.random.default_rng(0)
    limit, far, ones = most_ones(85, 1024, 2048), 0, []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, 1850, dtype=np.uint64)
        a, b = np.unique(base[:1700]), np.unique(np.concatenate([base[150:1700], base[1700:1823]]))
        assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) == pytest.approx(0.85, abs=0.002)
        xor = odd_sketch(a, 1024, 2048) ^ odd_sketch(b, 1024, 2048)
        ones.append(int(np.bitwise_count(xor).sum()))
        c = np.unique(np.concatenate([base[600:1700], base[1700:1850]]))  # about 0.59
        far += int(np.bitwise_count(odd_sketch(a, 1024, 2048) ^ odd_sketch(c, 1024, 2048)).sum()) > limit
    assert max(ones) <= limit and far >= 59
    mean = 1024 * (1 - (1 - 2 / 2048) ** (2 * 1024 * 0.15))
    assert abs(np.mean(ones) - mean) < 12


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in cases.documents(spark).select("doc_id", "text").collect()]
    assert sorted(map(tuple, op13_odd_sketch(spark, SF_SMALL).collect())) == sorted(brute(rows))


def near_copies(n, seed):
    """A group of texts around one, at similarities from about 0.6 to 1."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_large_group_of_near_copies(spark):
    texts = near_copies(150, 1) + near_copies(60, 2) + [near_copies(1, 1)[0]] * 20 + ["Same five words in here"] * 3
    rows = [(5 * i % 997, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], cases.SCHEMA)
    got = [(r["doc_id"], *r["near"]) for r in near_duplicates(df).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_hot_centre_is_dealt_out(spark):
    texts = near_copies(40, 3)
    hashes = [shingle_hashes(t) for t in texts]
    details = spark.createDataFrame([(bytes([k]), len(h), h.view(np.int64).tolist()) for k, h in enumerate(hashes)],
                                    "node binary, n bigint, hashes array<bigint>")
    pairs = spark.createDataFrame([(bytes([k]), bytes([0])) for k in range(1, 40)], "a binary, b binary")
    want = {(k, 0) for k in range(1, 40) if 100 * len(np.intersect1d(hashes[k], hashes[0])) >= 60 * len(np.union1d(hashes[k], hashes[0]))}
    got = [(r["a"][0], r["b"][0]) for r in od._confirmed(pairs, details, 60, share=4).collect()]
    assert set(got) == want and 0 < len(got) == len(want) < 39


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "near", "signature", "node", "component", "text_hash", "row_id", "h")
    got = near_duplicates(df).collect()
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()])
    key = repr
    for r in got:
        assert r["near"] == "own near" and r["node"] == "own node"
    expected = [(i, n, i if n == 0 else c, i == (i if n == 0 else c)) for i, n, c, _ in want]
    assert sorted(((r["doc_id"], *r["near_"]) for r in got), key=key) == sorted(expected, key=key)
    assert near_duplicates(cases.empty(spark)).count() == 0
