import random
import re
from collections import Counter

import pytest

from lendlens.llm.substring import OP6_SQL, SuffixAutomaton, anchors, op6_substring_dedup, substring_dedup

from . import cases
from ..compare import compare, duck
from ..conftest import SF_SMALL


def repeated(sequences, window):
    count = Counter(tuple(s[k : k + window]) for s in sequences for k in range(len(s) - window + 1))
    return [[k for k in range(len(s) - window + 1) if count[tuple(s[k : k + window])] > 1] for s in sequences]


def test_automaton():
    for seed in range(300):
        rng = random.Random(seed)
        seqs = [[rng.randint(0, 2) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 5))]
        window, a = rng.randint(1, 5), SuffixAutomaton()
        for s in seqs:
            a.add(s, 1)
        a.finish()
        assert [a.repeated(s, window) for s in seqs] == repeated(seqs, window)


def test_each_window_has_one_anchor_by_content():
    rng, by_window = random.Random(1), {}
    for _ in range(30):
        tokens = [b"%d" % rng.randint(0, 3) for _ in range(rng.randint(1, 90))]
        starts = []
        for h, a, b in zip(*anchors(tokens, 12), strict=True):
            for k in range(a, b + 1):
                starts.append(k)
                assert by_window.setdefault(tuple(tokens[k : k + 12]), h) == h
        assert starts == list(range(max(0, len(tokens) - 11)))


def test_query_matches_sql(spark):
    res = compare(op6_substring_dedup(spark, SF_SMALL), duck(SF_SMALL), OP6_SQL)
    assert res["match"], res


@pytest.mark.parametrize("hot", [256, 1])
def test_shared_passage_and_awkward_rows(spark, hot):
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(100 + k, f"{' '.join(f'd{k}x{j}' for j in range(40))} {passage} {' '.join(f'e{k}x{j}' for j in range(40))}", "en", "a", 0) for k in range(8)]
    df = cases.clashing(cases.awkward(spark).union(spark.createDataFrame(rows, cases.SCHEMA)), "dedup", "k1", "k2", "weight")
    out = substring_dedup(df, hot=hot).collect()
    assert len(out) == df.count()
    words = [re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "") for r in out]
    for r, w, starts in zip(out, words, repeated(words, 35), strict=True):
        gone = {k + j for k in starts for j in range(35)}
        assert r["dedup"] == "own dedup" and (r["dedup_"]["n_words"], r["dedup_"]["n_removed"]) == (len(w), len(gone))
        assert r["dedup_"]["kept"] == " ".join(x for k, x in enumerate(w) if k not in gone)


def test_empty_table(spark):
    assert substring_dedup(cases.empty(spark)).count() == 0
