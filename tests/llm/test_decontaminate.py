import pytest

from lendlens.llm import decontaminate as dc
from lendlens.llm.decontaminate import OP7_SQL, decontaminate, op7_decontamination

from . import cases
from ..compare import compare, duck
from ..conftest import SF_SMALL

ITEM = " ".join(f"item{k}" for k in range(20))


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_query_matches_sql(spark):
    res = compare(op7_decontamination(spark, SF_SMALL), duck(SF_SMALL), OP7_SQL)
    assert res["match"], res


@pytest.mark.parametrize("block", [1_000_000, 25])
def test_windows_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK_WORDS", block)
    items = bench(spark, [(1, ITEM), (2, "Tiny thing"), (3, None), (4, "..."), (None, ITEM + " more"), (5, ITEM), (5, ITEM)])
    filler = " ".join(f"f{k}" for k in range(300))
    docs = spark.createDataFrame([
        (1, "x " + " ".join(ITEM.upper().split()[3:16]) + " y", "en", "a", 0),  # one window of 13
        (2, " ".join(ITEM.split()[3:15]), "en", "a", 0),  # 12 words: none
        (3, "a tiny, thing; b", "en", "a", 0), (4, filler + " " + ITEM, "en", "a", 0),
        (5, filler + " tiny thing", "en", "a", 0)], cases.SCHEMA)
    got = {r["doc_id"]: r["contamination"] for r in decontaminate(docs, items).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["items"], got[1]["contaminated"]) == (15, 13, ["1", "5"], True)
    assert (got[2]["n_hit"], got[2]["contaminated"]) == (0, False)
    assert (got[3]["n_hit"], got[3]["items"], [list(x) for x in got[3]["spans"]]) == (2, ["2"], [[1, 3]])
    assert (got[4]["n_hit"], got[4]["contaminated"]) == (20, True)
    assert (got[5]["n_hit"], got[5]["contaminated"]) == (2, False)


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "contamination", "items")
    items = bench(spark, [(1, cases.PROSE), (2, None)])
    rows = decontaminate(df, items).collect()
    assert len(rows) == df.count()
    assert all(r["contamination"] == "own contamination" for r in rows)
    assert all(r["contamination_"]["contaminated"] == (r["text"] == cases.PROSE) for r in rows)
    assert decontaminate(cases.empty(spark), items).count() == 0
    assert not any(r["contamination"]["contaminated"] for r in decontaminate(cases.awkward(spark), bench(spark, [])).collect())
