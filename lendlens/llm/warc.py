"""Deterministic sharded WARC writer and reader (operator 9).

Records are sorted by id inside shards; shards are consecutive id ranges of
about equal payload size, computed from exact byte counts per id block (not
from samples), so the same rows always give the same files. An id block too
large for one shard (a hot id, null ids) is divided further by payload digest.
Inside a shard a new file begins when the compressed size reaches
``file_bytes``. Every record is a gzip member of its own.

Of records with equal payloads of at least ``min_revisit`` bytes, that with
the largest id is the response and the others revisit it.

Commit: a task writes under ``_temporary/<attempt>/`` and reports its files as
rows, of which Spark keeps those of one successful attempt per task. The files
named there are moved to their final names (moving twice is harmless), then
the manifest is written under a temporary name and renamed. An archive without
``manifest`` is not complete; readers start from the manifest only.

Defined results: a null payload is empty; a null url is written as the record
id. Rows with a null id are records without a page number; they may revisit,
and are revisited only if no equal payload has an id: then all are responses.
Rows that repeat the largest id are all responses. An empty table gives an
archive without files. Only the three named columns are used, so others may
have any name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.llm.common import cut, shared_folder, small, table

ID_BLOCKS = 4096
#: Shards whose files one task moves to their final names.
MOVES = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"
FILES = ("shard int, seq int, name string, temporary string, bytes bigint, records bigint, sha256 string")


def open_store(uri: str):
    """(file system, path) of a folder named by a URI or a plain path."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member without time stamp
    return squeeze.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def page_record(page: int | None, url: str | None, payload: bytes, owner: int | None, date: str) -> bytes:
    """A response record, or a revisit of ``owner``'s."""
    name = f"{RECORD_ID}{'' if page is None else page}"
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if owner is not None else http + payload
    fields = [("WARC-Type", "response" if owner is None else "revisit"), ("WARC-Record-ID", f"<{name}>"),
              ("WARC-Date", date), ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else name)]
    if owner is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{RECORD_ID}{owner}>")]
    fields += [("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)),
               ("Content-Type", "application/http;msgtype=response")]
    return _record(fields, block)


def prepare(df: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit: int) -> tuple[DataFrame, DataFrame]:
    """Pages (page, url, payload, key), and marks (page, key, owner): the
    revisits and whom they refer to, found without moving payloads."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    pages = df.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).alias("url"), payload.alias("payload"))
    pages = pages.withColumn("key", F.sha2("payload", 256))
    long_ones = pages.filter(F.length("payload") >= min_revisit).select("page", "key")
    copies = long_ones.groupBy("key").agg(F.max("page").alias("owner"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1 AND owner IS NOT NULL").select("key", "owner")
    marks = long_ones.join(copies, "key").filter("page IS NULL OR page <> owner")
    return pages, marks.select("page", "key", "owner").distinct()


def shard_ranges(pages: DataFrame, shard_bytes: int) -> tuple[Column, DataFrame, int]:
    """The id block of a page; each block's first shard and number of shards,
    by exact byte counts; the number of all shards."""
    low, high = pages.agg(F.min("page"), F.max("page")).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // ID_BLOCKS))
    block = F.coalesce(F.floor((F.col("page") - (low or 0)) / width).cast("int"), F.lit(-1))
    rows = pages.groupBy(block.alias("block")).agg(F.sum(F.length("payload") + 400).alias("b")).orderBy("block").collect()
    shards, shard, filled = [], 0, 0
    for r in rows:  # at most ID_BLOCKS + 1
        parts = -(-r["b"] // shard_bytes)
        if filled and (parts > 1 or filled + r["b"] > shard_bytes):
            shard, filled = shard + 1, 0
        shards.append((r["block"], shard, parts))
        shard, filled = (shard + parts, 0) if parts > 1 else (shard, filled + r["b"])
    ranges = pages.sparkSession.createDataFrame(shards, "in_block int, first int, parts bigint")
    return block, ranges, max(1, shard + bool(filled))


def assign_shards(rows: DataFrame, block: Column, ranges: DataFrame) -> DataFrame:
    part = F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("long") * F.col("parts") / (1 << 24))
    return rows.withColumn("block", block).join(small(ranges), F.col("block") == F.col("in_block")).select(
        (F.col("first") + part).cast("int").alias("shard"), *rows.columns)


def one_shard_a_task(rows: DataFrame, n: int) -> DataFrame:
    """Range-sorted: task k gets shard k (an id range) whole, in order of ids."""
    return rows.repartitionById(n, "shard").sortWithinPartitions("shard", "page", "key", F.col("owner").asc_nulls_last(), "url")


def write_archive(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = 1000, file_bytes: int = 64 << 20, shard_bytes: int = 128 << 20,
                  date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archive and return its manifest."""
    pages, marks = prepare(df, id_col, url_col, payload_col, min_revisit)
    block, ranges, n = shard_ranges(pages, shard_bytes)
    none = F.lit(None)
    rows = assign_shards(pages, block, ranges).withColumn("owner", none.cast("long")).unionByName(
        assign_shards(marks, block, ranges).withColumns({"url": none.cast("string"), "payload": none.cast("binary")}))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        here = f"{root}/_temporary/{uuid.uuid4().hex}"
        out, done, current, mark = None, [], None, (None, None, None)

        def begin(shard: int, seq: int) -> None:
            nonlocal out, current
            store.create_dir(here, recursive=True)
            name = f"{shard:06d}-{seq:05d}.warc.gz"
            current = {"shard": shard, "seq": seq, "name": name, "temporary": f"{here}/{name}", "bytes": 0, "records": 0,
                       "sha256": hashlib.sha256()}
            out = store.open_output_stream(current["temporary"], compression=None)
            put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{RECORD_ID}file:{name}>"), ("WARC-Date", date),
                         ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC/1.1\r\n"))

        def put(data: bytes) -> None:
            out.write(data)
            current["bytes"] += len(data)
            current["sha256"].update(data)

        def end() -> None:
            out.close()
            done.append({**current, "sha256": current["sha256"].hexdigest()})

        for batch in batches:
            for shard, page, key, url, payload, owner in zip(*[batch[c] for c in (
                    "shard", "page", "key", "url", "payload", "owner")], strict=True):
                page = None if pd.isna(page) else int(page)
                if payload is None:  # a mark comes before the pages that it is about
                    mark = (page, key, int(owner))
                    continue
                if current is None or current["shard"] != shard:
                    if current is not None:
                        end()
                    begin(int(shard), 0)
                elif current["bytes"] >= file_bytes:
                    end()
                    begin(int(shard), current["seq"] + 1)
                put(page_record(page, url, bytes(payload), mark[2] if mark[:2] == (page, key) else None, date))
                current["records"] += 1
        if current is not None:
            end()
        yield pd.DataFrame(done, columns=[c.split()[0] for c in FILES.split(", ")])

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        store, root = open_store(folder)
        for batch in batches:
            for name, temporary, size in zip(batch["name"], batch["temporary"], batch["bytes"], strict=True):
                final = f"{root}/{name}"
                if store.get_file_info(temporary).type == fs.FileType.File:
                    store.move(temporary, final)
                if store.get_file_info(final).size != size:
                    raise OSError(f"{final} is not the file that was written")
            yield batch

    files = cut(one_shard_a_task(rows, n).mapInPandas(write, FILES), "warc-files")
    moved = files.repartition(-(-n // MOVES), "name").mapInPandas(move, FILES).drop("temporary")
    spark = df.sparkSession
    moved.write.json(f"{folder}/manifest.temporary")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(path(f"{folder}/manifest.temporary"), path(f"{folder}/manifest")):
        raise OSError(f"{folder}/manifest can't be put in place")
    fs.delete(path(f"{folder}/_temporary"), True)
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(FILES).json(f"{folder}/manifest").drop("temporary")


def parse_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode().partition(":")
            fields[k.strip().lower()] = v.strip()
        block = stream.read(int(fields["content-length"]))
        yield fields, block


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """The archive's page records: page, url, record_type, refers_to,
    payload_bytes, payload_digest (hex) and, if asked for, the payload
    (null for revisits). Block and payload digests are verified."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        for batch in batches:
            for name in batch["name"]:
                rows = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw:
                    for fields, block in parse_records(io.BufferedReader(gzip.GzipFile(fileobj=raw))):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        head, _, payload = block.partition(b"\r\n\r\n")
                        response = fields["warc-type"] == "response"
                        if _sha1(block) != fields["warc-block-digest"] or response and _sha1(payload) != fields["warc-payload-digest"]:
                            raise ValueError(f"{name}: a digest of {fields['warc-record-id']} doesn't hold")
                        length = next(int(x.partition(b":")[2]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                        number = [fields.get(k, "").strip("<>").removeprefix(RECORD_ID) for k in ("warc-record-id", "warc-refers-to")]
                        rows.append((int(number[0]) if number[0] else None, fields["warc-target-uri"], fields["warc-type"],
                                     int(number[1]) if number[1] else None, length,
                                     base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex(),
                                     payload if response and with_payload else None))
                        if len(rows) >= 2000:
                            yield pd.DataFrame(rows, columns=names).astype({"page": "Int64", "refers_to": "Int64"})
                            rows = []
                yield pd.DataFrame(rows, columns=names).astype({"page": "Int64", "refers_to": "Int64"})

    kind = ("page bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
            "payload binary")
    names = [c.split()[0] for c in kind.split(", ")]
    files = cut(read_manifest(spark, folder), "manifest")
    records = files.repartition(max(1, files.count())).mapInPandas(read, kind)  # a task reads about one rolled file
    return records if with_payload else records.drop("payload")


def op9_warc(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), folder, file_bytes=8 << 20, shard_bytes=32 << 20)
    return read_archive(spark, folder).select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
copies AS (SELECT payload_digest, max(page_id) AS largest, count(*) AS n FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id <> largest THEN largest END AS refers_to
FROM p LEFT JOIN copies USING (payload_digest)
"""
