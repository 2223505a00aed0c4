import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from lendlens.llm.packing import Encoder, best_fit, fillings, least_bins, op8_packing, pack, places, plan_bins

from . import cases
from ..conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return Encoder(f.read())


def fewest(items, cap):
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + items[i] <= cap:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])
    go(0, [])
    return best[0]


def test_as_few_bins_as_possible():
    for seed in range(150):
        rng = random.Random(seed)
        cap = rng.choice([10, 20, 37])
        items = sorted((rng.randint(1, cap) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = plan_bins(dict(Counter(items)), cap)
        used = Counter()
        for filling, times in plan:
            assert sum(filling) <= cap
            used.update({s: times * filling.count(s) for s in set(filling)})
        assert used == Counter(items)
        want = fewest(items, cap)
        assert sum(t for _, t in plan) == want and least_bins(dict(Counter(items)), cap) <= want <= sum(t for _, t in best_fit(dict(Counter(items)), cap))


def test_fillings_are_undominated():
    assert fillings({10: 2, 6: 1, 5: 1, 4: 1, 1: 1}, 16, 3, 5)[0] == (10, 6)
    assert all(sum(f) <= 16 for f in fillings({10: 1, 3: 2, 2: 5}, 16, 3, 5))


def test_places_use_every_rank_once():
    counts = {s: 3 + s % 5 for s in range(1, 60)}
    rows = places(plan_bins(counts, 64))
    for s, n in counts.items():
        ranks = sorted((a, b) for size, a, b, *_ in rows if size == s)
        assert ranks[0][0] == 0 and ranks[-1][1] == n and all(x[1] == y[0] for x, y in zip(ranks, ranks[1:]))


def test_encoder_equals_the_tokenizer(encoder):
    rng = random.Random(3)
    letters = "abcXYZ éÉüßñçøŁſΣς'’“,.!?012-_#$ ́İıªµǅ中​  \x1c\x85\t\n<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 20))) for _ in range(2000)]
    for t in [*texts, "<|endoftext|> a", "it's the'm", cases.PROSE]:
        assert encoder(t) == encoder.whole(t), t


def checked(rows, cap):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= cap
    return len(bins)


def test_query_keeps_all_ids(spark, encoder):
    rows = op8_packing(spark, SF_SMALL).collect()
    total = sum(r["length"] for r in rows)
    assert checked(rows, 2048) <= 1.01 * -(-total // 2048) + 1
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    want = {}
    for d in cases.documents(spark).collect():
        ids = encoder.tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want[d["doc_id"], k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    assert got == want and len(rows) == len(want)


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "pieces", "piece", "length", "salt", "rank")
    rows = pack(df, PATH, cap=100, keep_ids=True).collect()
    checked(rows, 100)
    ids = {(r["doc_id"], r["piece"]): r for r in rows}
    assert bytes(ids[1, 0]["ids"]) == b"\0\0\0\0" and ids[2, 0]["length"] == 1
    assert sum(r["piece"] == 0 for r in rows) == df.count()
    assert pack(cases.empty(spark), PATH).count() == 0
