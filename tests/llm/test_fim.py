import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lendlens.llm import fim
from lendlens.llm.fim import bytes_of, fill_in_middle, op12_fill_in_middle, restored

from . import cases
from ..conftest import SF_SMALL


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def run(ids, texts):
    return fim.transform_batch(pa.array(ids, pa.string()), pa.array(texts, pa.string()), 1, 90, 20).to_pylist()


TEXT = st.none() | st.text(st.sampled_from("ab cZ<PSM>é中\U0001F600\n1"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), TEXT), max_size=12), st.sampled_from([1, 40, 1 << 20]))
def test_against_brute_force(rows, size):
    old, fim.SLICE = fim.SLICE, size
    try:
        got = run([str(i) for i, _ in rows], [t for _, t in rows])
        assert [tuple(r.values()) for r in got] == [brute(i, t) for i, t in rows]
        back = fim.restore_batch(pa.array([r["text"] for r in got], pa.string()), pa.array([r["form"] for r in got], pa.string()))
        assert back.to_pylist() == [t or "" for _, t in rows]
    finally:
        fim.SLICE = old


def test_bytes_of_slices():
    texts = pa.array(["ab", None, "", "cé", "x"])
    data, at = bytes_of(texts.slice(1, 3))
    assert data.tobytes() == "cé".encode() and at.tolist() == [0, 0, 0, 3]
    assert bytes_of(pa.array([], pa.string()))[1].tolist() == [0]


def test_broken_outputs_are_told():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        fim.restore(data, np.array([0, 8]), np.array([1]))


def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in cases.documents(spark).collect()}
    rows = op12_fill_in_middle(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        n, form, p, m, out = brute(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[1:] == (n, form, p, m, sha(out), sha(texts[r["doc_id"]] or ""))


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "fim", "form").union(
        spark.createDataFrame([(9, "word " * 600_000, "en", "a", 1, "x", "y")], f"{cases.SCHEMA}, fim string, form string"))
    done = fill_in_middle(df).withColumn("back", restored(F.col("fim_.text"), F.col("fim_.form"))).collect()
    assert len(done) == df.count() and all(r["back"] == (r["text"] or "") for r in done)
    for r in done:
        assert tuple(r["fim_"]) == brute(r["doc_id"], r["text"])
    assert fill_in_middle(cases.empty(spark)).count() == 0
