"""Driver contract and a few oracle comparisons on the smallest tables."""

import __spark_entry__ as E
from tests.compare import compare, duck

from .conftest import SF_SMALL


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fairness_score" in df.columns and "rank" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 40


def test_oracles_match_small(spark):
    con = duck(SF_SMALL)
    for name in ["lender_fairness", "lender_summary", "outcome_by_year_long", "clean_applications",
                 "rate_by_dti_race", "county_map", "roc_curve", "classification_report"]:
        r = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
        assert r["match"], (name, r)
