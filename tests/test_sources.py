"""Bronze CSV scans, yearly landing and incremental streaming landing."""

import os
import tempfile

from pyspark.sql import functions as F

from lendlens.sources import tables as TB
from lendlens.streaming.landing import land_incremental, stage_yearly_csv


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_csv_all_string_with_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="ll-csv-")
    _write(f"{d}/a.csv", "lei,action_taken,income,Entity.LegalName\n"
                         " x1 ,1,NA,Bank A\n"
                         "x2,3,,nan\n"
                         "x3,1,12d,Exempt\n")
    df = TB.read_csv_table(spark, f"{d}/a.csv")
    assert all(t == "string" for _, t in df.dtypes)
    rows = [tuple(r) for r in df.collect()]
    assert rows == [(" x1 ", "1", None, "Bank A"), ("x2", "3", None, None), ("x3", "1", "12d", "Exempt")]
    # predicate subset silently ignores absent names; list subset is strict
    sub = TB.read_csv_table(spark, f"{d}/a.csv", columns=lambda c: c in ("lei", "nope"))
    assert sub.columns == ["lei"]
    try:
        TB.read_csv_table(spark, f"{d}/a.csv", columns=["lei", "nope"])
        raise AssertionError("strict subset should fail")
    except ValueError:
        pass


def test_load_years_adds_year_from_path(spark):
    d = tempfile.mkdtemp(prefix="ll-years-")
    for y in (2019, 2020):
        _write(f"{d}/year={y}/part.csv", "lei,action_taken\nA,1\nB,3\n")
    df = TB.load_years(spark, d, [2019, 2020])
    got = sorted((r["year"], r["lei"]) for r in df.collect())
    assert got == [(2019, "A"), (2019, "B"), (2020, "A"), (2020, "B")]


def test_infer_types_whole_column(spark):
    df = spark.createDataFrame([("1", "a", "2.5"), ("2", "3", None), (None, "b", "1e3")],
                               "x string, y string, z string")
    out = TB.infer_types(df)
    assert dict(out.dtypes) == {"x": "double", "y": "string", "z": "double"}


def test_union_all_columns_reconciles_types(spark):
    a = spark.createDataFrame([(1, "p")], "k int, s string")
    b = spark.createDataFrame([(2.5, 7)], "k double, t int")
    u = TB.union_all_columns(a, b)
    assert dict(u.dtypes) == {"k": "string", "s": "string", "t": "int"}
    assert sorted((r["k"], r["s"], r["t"]) for r in u.collect()) == [("1", "p", None), ("2.5", None, 7)]


def test_incremental_landing_skips_landed_files(spark):
    d = tempfile.mkdtemp(prefix="ll-stream-")
    rows = [(y, f"L{i}", i % 3 + 1) for y in (2019, 2020, 2021) for i in range(5)]
    apps = spark.createDataFrame(rows, "activity_year int, lei string, action_taken int")
    cols = ["lei", "action_taken", "activity_year"]
    apps = apps.select(*cols)
    stage_yearly_csv(apps, f"{d}/raw", years=[2019, 2020])
    assert land_incremental(spark, f"{d}/raw", f"{d}/out", f"{d}/ck", cols) == 10
    assert land_incremental(spark, f"{d}/raw", f"{d}/out", f"{d}/ck", cols) == 0
    stage_yearly_csv(apps, f"{d}/raw", years=[2021])
    assert land_incremental(spark, f"{d}/raw", f"{d}/out", f"{d}/ck", cols) == 5
    landed = spark.read.parquet(f"{d}/out")
    assert landed.count() == 15
    assert landed.filter(F.col("activity_year") == 2021).count() == 5


def _csv(path, text):
    path.mkdir(parents=True)
    (path / "part.csv").write_text(text)


def test_years_are_read_by_name(spark, tmp_path):
    """Another column order and a missing column in one year; any file name."""
    from lendlens.sources.tables import load_years
    _csv(tmp_path / "nc_2019.csv", "lei,action_taken,loan_amount\nA,1,100\n")
    _csv(tmp_path / "nc_2020.csv", "lei,loan_amount,extra\nB,200,x\n")
    rows = load_years(spark, str(tmp_path), [2019, 2020], pattern="{base}/nc_{year}.csv").orderBy("lei").collect()
    assert [r.asDict() for r in rows] == [
        {"lei": "A", "action_taken": "1", "loan_amount": "100", "year": 2019, "extra": None},
        {"lei": "B", "action_taken": None, "loan_amount": "200", "year": 2020, "extra": "x"}]


def test_files_of_one_source_must_agree_on_the_header(spark, tmp_path):
    import pytest

    from lendlens.sources.tables import read_csv_table
    _csv(tmp_path / "t.csv", "a,b\n1,2\n")
    (tmp_path / "t.csv" / "z.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv_table(spark, str(tmp_path / "t.csv")).collect()


def test_a_repeated_batch_lands_once_and_the_manifest_counts_files(spark):
    """The process dies after the sink's commit, before the stream's own: the
    batch runs again. Files of a batch that never reached the log are not read."""
    import glob
    import shutil

    from lendlens.streaming.landing import landing_manifest
    d = tempfile.mkdtemp(prefix="ll-stream-")
    apps = spark.createDataFrame([(f"L{i}", i, 2019 + i % 2) for i in range(20)], "lei string, n int, activity_year int")
    stage_yearly_csv(apps, f"{d}/raw")
    args = (spark, f"{d}/raw", f"{d}/out", f"{d}/ck", apps.columns)
    assert land_incremental(*args, files_per_batch=1) == 20
    batches = glob.glob(f"{d}/ck/commits/[0-9]*")
    assert len(batches) == len(glob.glob(f"{d}/raw/*/*.csv")) > 2
    last = max(int(os.path.basename(b)) for b in batches)
    os.unlink(f"{d}/ck/commits/{last}")
    os.unlink(f"{d}/ck/commits/.{last}.crc")
    some = glob.glob(f"{d}/out/activity_year=2019/*.parquet")[0]
    shutil.copy(some, some.replace("part-", "part-9"))
    land_incremental(*args, files_per_batch=1)
    landed = spark.read.parquet(f"{d}/out")
    assert sorted(r["n"] for r in landed.collect()) == sorted(str(i) for i in range(20))
    manifest = landing_manifest(spark, f"{d}/out").collect()
    assert len(manifest) == len(batches) and sum(r["rows"] for r in manifest) == 20


def test_landing_refuses_another_header(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="ll-stream-")
    _write(f"{d}/raw/activity_year=2019/a.csv", "action_taken,lei\n1,A\n")
    columns = ["lei", "action_taken", "activity_year"]
    with pytest.raises(Exception, match="a.csv"):
        land_incremental(spark, f"{d}/raw", f"{d}/out", f"{d}/ck", columns)
    assert not [f for _, _, fs in os.walk(f"{d}/out/_spark_metadata") for f in fs]
    _write(f"{d}/raw/activity_year=2019/a.csv", "lei,action_taken\nA,1\n")  # delivered anew
    assert land_incremental(spark, f"{d}/raw", f"{d}/out", f"{d}/ck", columns) == 1


def test_many_files_with_several_headers_load_without_a_job_each(spark, tmp_path):
    """Files of one year may differ in their headers; empty files, gzip, odd names."""
    import gzip
    from collections import Counter
    want = Counter()
    for y in (2019, 2020, 2021):
        folder = tmp_path / f"nc {y}"
        folder.mkdir()
        for k in range(60):
            names = ("lei", "n") if k % 2 else ("n", "lei", "extra")
            values = {"lei": f"L{k}", "n": str(k), "extra": "e"}
            text = ",".join(names) + "\n" + ",".join(values[c] for c in names) + "\n"
            (folder / f"f[{k}] %20.csv").write_text(text)
            want[y, f"L{k}", str(k), values["extra"] if len(names) == 3 else None] += 1
        (folder / "empty.csv").write_text("")
        with gzip.open(folder / "z.csv.gz", "wt") as f:
            f.write('"lei","n"\nZ,9\n')
        want[y, "Z", "9", None] += 1
    sc = spark.sparkContext
    sc.setJobGroup("load-years", "load")
    try:
        df = TB.load_years(spark, str(tmp_path), [2019, 2020, 2021], pattern="{base}/nc {year}")
        jobs = len(sc.statusTracker().getJobIdsForGroup("load-years"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 6  # listings of many paths, none per file
    got = Counter((r["year"], r["lei"], r["n"], r["extra"]) for r in df.collect())
    assert got == want
    plan = df.filter("year = 2020")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_no_file_with_a_header_is_an_error(spark, tmp_path):
    import pytest
    (tmp_path / "year=2019").mkdir()
    (tmp_path / "year=2019" / "a.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        TB.load_years(spark, str(tmp_path), [2019])


def test_applications_are_numbered_before_they_are_widened(spark):
    """Landing gives the rows and ids of the registered SQL, while its shuffles
    and sorts see the joined source columns only."""
    from lendlens.sources import adapter
    from lendlens.sources.landing import ID_COLUMN, identity_sql, with_identity
    from .conftest import SF_SMALL
    assert adapter.LEI_SQL in adapter.APPLICATIONS_SQL and adapter.LOAN_AMOUNT_SQL in adapter.APPLICATIONS_SQL
    bronze = adapter.bronze(spark, SF_SMALL, "applications")
    want = bronze.select(F.expr(identity_sql("applications")).alias(ID_COLUMN), "*")
    got = with_identity(spark, SF_SMALL, "applications")
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":  # the wide columns come after every sort and window
        plan = plan.children().head()
    assert plan.nodeName() == "Sort" and plan.output().size() < 25


def test_code_columns_give_the_same_features_as_their_text(spark):
    from lendlens.functions import codes
    from lendlens.plans.hmda import MODEL_CODES, model_features_from
    from lendlens.sources import adapter
    from .conftest import SF_SMALL
    apps = adapter.bronze(spark, SF_SMALL, "applications").select("action_taken", "activity_year", *[F.col(f"`{c}`") for c in codes.MODEL_FEATURES])
    text = apps.withColumns({c: F.col(f"`{c}`").cast("string") for c in MODEL_CODES})
    got, want = model_features_from(apps), model_features_from(text)
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") < model_features_from(text)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")


def test_deliveries_and_landed_tables_are_compressed(spark, tmp_path):
    """Raw files come compressed, of a bounded number of rows, and land whole;
    landed tables are written with zstd."""
    import pyarrow.parquet as pq

    from lendlens.streaming import landing as L
    df = spark.range(7).selectExpr("CAST(id AS STRING) AS k", "repeat('a', 50) AS v", "CAST(2020 AS INT) AS activity_year").coalesce(1)
    raw, target = str(tmp_path / "raw"), str(tmp_path / "landed")
    L.stage_yearly_csv(df, raw, options=L.DELIVERY_OPTIONS)
    files = list((tmp_path / "raw").rglob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert int(L.DELIVERY_OPTIONS["maxRecordsPerFile"]) <= 1_000_000
    assert L.land_incremental(spark, raw, target, str(tmp_path / "c"), ["k", "v", "activity_year"]) == 7
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == [str(i) for i in range(7)]
    landed = next((tmp_path / "landed").rglob("*.parquet"))
    assert pq.ParquetFile(landed).metadata.row_group(0).column(0).compression == "ZSTD"


def test_landing_leaves_no_shuffle_files(spark, tmp_path):
    """The shuffle of a landed table goes with its write."""
    from lendlens.sources.landing import writing_session
    own = writing_session(spark)

    def shuffles():
        get = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {get.apply(i).getName() for i in range(get.size()) if get.apply(i).getName().startswith("shuffle_")}
    before = shuffles()
    own.range(1000).selectExpr("id", "id % 7 AS k").repartition(5, "k").write.parquet(str(tmp_path / "t"))
    assert shuffles() <= before
