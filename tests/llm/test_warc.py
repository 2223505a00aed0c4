from pyspark.sql import functions as F

from lendlens.llm.common import shared_folder
from lendlens.llm.warc import OP9_SQL, one_shard_a_task, op9_warc, read_archive, read_manifest, write_archive

from ..compare import compare, duck
from ..conftest import SF_SMALL

BIG = "<p>" + "same " * 300


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_query_matches_sql(spark):
    res = compare(op9_warc(spark, SF_SMALL), duck(SF_SMALL), OP9_SQL)
    assert res["match"], res


def test_awkward_rows_and_revisits(spark):
    rows = [(1, "http://a/é b\r\nX: y", BIG), (9, None, BIG), (9, "http://c", BIG), (3, "http://d", "small"), (4, "http://e", "small"),
            (5, "http://f", None), (None, "http://g", BIG), (None, None, BIG + "!"), (None, None, BIG + "!"), (7, "u", "é" * 700), (8, "u", "é" * 700)]
    df = pages(spark, rows).select("*", F.lit(0).alias("page"), F.lit(1).alias("owner"), F.lit(2).alias("shard"), F.lit(3).alias("key"))
    folder = shared_folder(spark, "warc")
    write_archive(df, folder, file_bytes=600, shard_bytes=2000)
    got = [tuple(r) for r in read_archive(spark, folder).select("page", "record_type", "refers_to", "payload_bytes").collect()]
    n, m = len(BIG), len(BIG) + 1
    assert sorted(got, key=str) == sorted([
        (1, "revisit", 9, n), (9, "response", None, n), (9, "response", None, n), (3, "response", None, 5), (4, "response", None, 5),
        (5, "response", None, 0), (None, "revisit", 9, n), (None, "response", None, m), (None, "response", None, m),
        (7, "revisit", 8, 1400), (8, "response", None, 1400)], key=str)
    assert read_manifest(spark, folder).count() > 2  # files were rolled


def test_same_rows_same_files(spark):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    made = []
    for n in (1, 5):
        folder = shared_folder(spark, "warc")
        manifest = write_archive(df.repartition(n), folder, file_bytes=15_000, shard_bytes=100_000)
        made.append(sorted((r["name"], r["bytes"], r["records"], r["sha256"]) for r in manifest.collect()))
        back = read_archive(spark, folder, with_payload=True)
        assert back.join(df, (back["page"] == df["page_id"]) & (back["payload"].cast("string") == df["html"])).count() == df.count()
    assert made[0] == made[1] and len(made[0]) > 3


def test_empty_table(spark):
    folder = shared_folder(spark, "warc")
    assert write_archive(pages(spark, []), folder).count() == 0 and read_archive(spark, folder).count() == 0


def test_one_shard_a_task(spark):
    rows = spark.range(4000).select((F.col("id") % 40).cast("int").alias("shard"), F.col("id").alias("page"),
                                    F.lit("k").alias("key"), F.lit(None).cast("long").alias("owner"), F.lit("u").alias("url"))
    placed = one_shard_a_task(rows, 40).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count_distinct("shard").alias("shards"), F.count(F.lit(1)).alias("n")).collect()
    assert len(placed) == 40 and {(r["shards"], r["n"]) for r in placed} == {(1, 100)}
