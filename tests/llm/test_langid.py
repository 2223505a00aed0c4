from lendlens.llm.langid import language_id, op3_language_id, term_counts

from . import cases
from ..conftest import SF_CHECK


def test_held_out_accuracy_and_und(spark):
    docs = cases.documents(spark, SF_CHECK)
    rows = op3_language_id(spark, SF_CHECK).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)


def test_counts_piece_by_piece(monkeypatch):
    import numpy as np

    from lendlens.llm import langid
    text = "ab cd, é12 fg " * 50
    at, n = term_counts(text)
    monkeypatch.setattr(langid, "PIECE", 7)
    at2, n2 = term_counts(text)
    assert (at == at2).all() and (n == n2).all() and isinstance(at, np.ndarray)


def test_awkward_rows(spark):
    train = spark.createDataFrame([(k, w, lang, "a", 0) for k in range(30) for lang, w in (("en", f"the house and the word {k}"), ("de", f"das haus und der satz {k}"), (None, "x"))], cases.SCHEMA)
    df = cases.clashing(cases.awkward(spark), "language", "label")
    rows = language_id(df, train).collect()
    assert len(rows) == df.count() and all(r["language"] == "own language" for r in rows)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["language_"]["label"] == "und") == (not letters)
    assert language_id(cases.empty(spark), train).count() == 0
    assert {r["language"]["label"] for r in language_id(df.drop("language"), cases.empty(spark)).collect()} == {"und"}


def test_lowest_hashes_are_found_without_sorting(spark):
    import random

    from lendlens.llm.langid import HASH_BITS, lowest
    rnd = random.Random(3)
    rows = [(label, h) for label, n in (("a", 900), ("b", 40), ("c", 1)) for _ in range(n)
            for h in [rnd.choice([rnd.getrandbits(HASH_BITS), rnd.getrandbits(20)])]]
    rows += rows[:300] + [("a", 0), ("a", (1 << HASH_BITS) - 1)]
    df = spark.createDataFrame(rows, "label string, h long").repartition(7)
    for k in (1, 50, 5000):
        want = {x: sorted({h for y, h in rows if y == x})[:k][-1] for x in "abc"}
        assert {r["label"]: r["most"] for r in lowest(df, k).collect()} == want
    assert lowest(df.limit(0), 5).count() == 0
