import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lendlens.llm import lm
from lendlens.llm.lm import EXACT, Bytes, draw_tables, lm_scores, log_stirling, op4_lm_scores, spell, uniforms

from . import cases
from ..conftest import SF_SMALL


def test_draws_follow_the_exact_conditional():
    d, theta, others, p, c = 0.4, 1.0, 5.0, 0.3, 6
    weight = {1: 1.0}  # seat customers one by one over table counts, with all sizes
    weight = np.exp([log_stirling(d)[c, t] + sum(math.log(theta + d * (others + j)) for j in range(t)) + t * math.log(p) for t in range(1, c + 1)])
    # Stirling numbers against the sum over set partitions of 3 customers
    s = np.exp(log_stirling(d))
    assert np.allclose(s[3, 1:4], [(1 - d) * (2 - d), 3 * (1 - d), 1])
    n = 40_000
    t = draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, theta, uniforms(np.arange(n), 0))
    assert np.allclose(np.bincount(t, minlength=c + 1)[1:] / n, weight / weight.sum(), atol=0.01)
    many = draw_tables(np.array([EXACT, 10_000, 10**7]), np.full(3, 9.0), np.full(3, 0.01), d, theta, np.full(3, 0.5))
    assert (many >= 1).all() and many[0] <= many[1] <= many[2]


def test_byte_model_is_a_distribution():
    owner, context, symbol = spell([b"abc", b"abd", b"xa", b"ab"])
    model = Bytes((context % 256**2 << 9) + symbol, 2)
    keys, n = np.unique((context % 256**2 << 9) + symbol, return_counts=True)
    for r in range(3):
        model.sweep(n, r)
    for ctx in (0x0A0A, 0x6162, 0x7A7A):
        p = model.predict(np.full(257, ctx), np.arange(257))
        assert abs(p.sum() - 1) < 1e-9 and (p > 0).all()


def test_query_base_and_score(spark):
    docs = {r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"] or "")) + [None]
            for r in cases.documents(spark).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = op4_lm_scores(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0 and math.isclose(r["perplexity"], 10 ** (-r["score"] / len(ws)), rel_tol=1e-9)


def test_same_scores_on_any_partitioning_and_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "id", "train", "block", "word")
    got = [sorted(((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in lm_scores(df.repartition(n), F.lit(True)).collect())) for n in (1, 4)]
    assert got[0] == got[1] and len(got[0]) == df.count()
    assert lm_scores(cases.empty(spark), F.lit(True)).count() == 0
    assert all(r["n_known"] == 0 and r["score"] < 0 for r in lm_scores(cases.awkward(spark), F.lit(False)).collect())


def test_order_of_words_counts(spark):
    rows = [(k, "the red fox saw a blue bird near the old mill", "en", "a", 0) for k in range(30)]
    rows += [(100, "the red fox saw a blue bird near the old mill", "en", "a", 0), (101, "mill a the saw old near red bird the blue fox", "en", "a", 0)]
    out = {r["doc_id"]: r for r in lm_scores(spark.createDataFrame(rows, cases.SCHEMA), F.col("doc_id") < 100).collect()}
    assert out[100]["base_score"] == out[101]["base_score"] and out[100]["score"] > out[101]["score"] + 5


def test_pairs_and_tokens_make_a_distribution(spark):
    texts = ["a b a c", "b a b", "c c a", "a b"]
    contexts = ["a", "b", "c", "zz"]
    words = ["a", "b", "c"]
    rows = [(k, t, "en", "a", 0) for k, t in enumerate(texts)]
    held = [(100 + 10 * i + j, f"{u} {w}", "en", "a", 0) for i, u in enumerate(contexts) for j, w in enumerate(words)]
    out = {r["doc_id"]: 10 ** r["score"] for r in lm_scores(spark.createDataFrame(rows + held, cases.SCHEMA), F.col("doc_id") < 100).collect()}
    assert sum(v for k, v in out.items() if k >= 100) < 1
    assert out[101] > out[102] and out[110] > out[112]  # a b was seen oftener than a c, b a than b c


def test_blocks_and_parts_move_arrays(spark, monkeypatch):
    """A block is a row per document and few more, whatever words it holds;
    dealt to many parts it has the scores of one part."""
    texts = [" ".join(f"w{(k * k + i * i) % 997} x{(k + i) % 13}" for i in range(120)) for k in range(60)]
    df = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in enumerate(texts)], cases.SCHEMA).repartition(2)
    blocks = lm._blocks(df.select(F.col("doc_id").alias("id"), "text", F.lit(True).alias("train")), "bigint")
    assert blocks.count() <= 60 + 2 * 2
    scores = []
    for size in (1 << 20, 1 << 12):
        monkeypatch.setattr(lm, "PART_PAIRS", size)
        scores.append({r["doc_id"]: round(r["score"], 6) for r in lm_scores(df, F.col("doc_id") % 5 != 0).collect()})
    assert scores[0] == scores[1] and len(scores[0]) == 60


def test_blocks_hold_tokens_once_and_no_pairs(spark):
    """A token of a block takes a place among the block's words, not a pair's hash too."""
    some = np.random.default_rng(0).integers(0, 3000, (40, 2000))
    df = spark.createDataFrame([(k, " ".join(f"w{w}" for w in own), "en", "a", 0) for k, own in enumerate(some.tolist())], cases.SCHEMA).coalesce(1)
    blocks = lm._blocks(df.select(F.col("doc_id").alias("id"), "text", F.lit(True).alias("train")), "bigint")
    arrays = [c for c, kind in blocks.dtypes if kind == "binary"]
    assert blocks.agg(F.sum(sum(F.coalesce(F.length(c), F.lit(0)) for c in arrays))).first()[0] < 3 * some.size


def test_pairs_of_a_block_by_either_sort():
    rng = np.random.default_rng(1)
    sizes = np.full(1 << 9, 1 << 9)
    codes = rng.integers(1, 50, sizes.sum())
    codes[np.cumsum(sizes) - 1] = 7  # the end
    hashes = np.sort(rng.integers(0, 1 << 63, 1 << 22).astype(np.uint64))
    few, many = (lm._block_pairs(codes.astype(np.uint32), sizes, h, 5) for h in (hashes[:64], hashes))
    assert all((x == y).all() for x, y in zip(few, many, strict=True))
    prev, code, part, at = few
    expected = codes[:-1].copy()
    expected[np.cumsum(sizes)[:-1] - 1] = 7
    assert (code[at] == codes).all() and prev[at][0] == 7 and (prev[at][1:] == expected).all() and set(part) == set(range(5))


def test_packed_numbers_come_back():
    for a in ([], [0, 255], [0, 256], [5, 1 << 16], [1 << 32, 3], [-1, 1 << 62]):
        a = np.array(a, np.int64)
        assert (lm._array(lm._pack(a), np.int64) == a).all() and lm._array(lm._pack(a), np.int64).dtype == np.int64


def test_session_keeps_its_shuffle_setting(spark):
    before = spark.conf.get(lm.CLEANUP, None)
    assert lm_scores(cases.awkward(spark), F.lit(True)).count() == cases.awkward(spark).count()
    assert spark.conf.get(lm.CLEANUP, None) == before
