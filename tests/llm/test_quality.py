import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lendlens.llm.quality import op10_quality_rules, quality_rules, text_counts

from . import cases
from ..conftest import SF_SMALL


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(zip(words, words[1:], words[2:]))
    inside = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab é\n\t#|\x1c\x85"), max_size=60))
def test_counts(text):
    assert text_counts(text)[:5] == brute(text)


def test_query_is_whole_and_right(spark):
    texts = {r["doc_id"]: r["text"] for r in cases.documents(spark).collect()}
    rows = op10_quality_rules(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b
        assert r["base_failed"] == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r["base_failed"] and r["kept"])


def test_thresholds_adapt_per_group(spark):
    def text(i, symbols):
        return " ".join(f"w{i}x{k}" + "#" * (symbols and k % symbols == 0) for k in range(60))
    rows = [(i, text(i, 0), "en", "plain", 0) for i in range(150)] + [(200, text(200, 2), "en", "plain", 0)]
    rows += [(1000 + i, text(i, 2), "en", "code", 0) for i in range(150)]  # symbols are usual here
    kept = {r["doc_id"]: r["quality"]["kept"] for r in quality_rules(spark.createDataFrame(rows, cases.SCHEMA), min_group=50).collect()}
    assert not kept[200] and all(v for k, v in kept.items() if k != 200)


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "quality", "counts", "limits", "kept")
    rows = quality_rules(df).collect()
    assert len(rows) == df.count() and all(r["quality"] == "own quality" for r in rows)
    assert all(r["quality_"]["base_failed"] for r in rows if not (r["text"] or "").strip())
    assert quality_rules(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("text", [None, "", "x"])
def test_tiny(text):
    assert text_counts(text)[4] == 0
