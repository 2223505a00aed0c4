"""Language identification by nearest centroid (operator 3).

A text is the TF-IDF vector of its character n-grams: n-grams of 1 to 4 bytes
of the lower-cased text, in which runs of ASCII characters other than letters
are one space, hashed to ``BUCKETS`` dimensions, 1 + log(tf) times the inverse document frequency, length 1. The
document frequencies are counted over every training text. Per language,
spherical k-means clusters the vectors of a bounded sample of its training
texts (``per_language`` of the lowest hashes of id and text) into at most
``clusters`` centroids. A text takes the language of the centroid of highest
cosine. Its score is the cosine, cut to 0..1; it is marked ``rejected`` when
the cosine is under that language's limit: mean - ``reach`` standard
deviations of the sample's cosines to their centroids, at least ``least``.
Language, source and id of a document never enter its prediction.

Defined results: ``und`` with score 0, rejected, if a text is null, empty or
has no letter, and if nothing could be learned. Languages that are null are
not learned. Repeated rows are predicted alike. An empty table gives an empty
result. A clashing column of the input keeps its values.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.llm.common import cut, drop, fresh, per_text, small, table

BUCKETS = 1 << 14
#: Training texts per language that the centroids are fitted on, at most.
PER_LANGUAGE = 1000
#: Hashes of which the lowest are taken, and the digits that narrow them down.
HASH_BITS, DIGIT_BITS = 60, 12
UNKNOWN = "und"
PIECE = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
LONGEST = 4


def term_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers and counts of the n-grams of one whole text."""
    raw = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    raw = raw[np.append(True, (raw[1:] != 32) | (raw[:-1] != 32))]
    total = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(raw), PIECE):  # long texts piece by piece; pieces overlap
        part = raw[k : k + PIECE + LONGEST - 1]
        gram = np.zeros(len(part), np.int64)
        for n in range(1, LONGEST + 1):
            gram = gram[: max(0, len(part) - n + 1)] * 257 + part[n - 1 :] + 1
            mixed = (gram[:PIECE] * 0x9E3779B97F4A7C1 + n) & 0x7FFFFFFFFFFFFFFF
            total += np.bincount((mixed >> 40) % BUCKETS, minlength=BUCKETS)
    at = np.nonzero(total)[0]
    return at, total[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = term_counts(text)
    v = (1 + np.log(n)) * idf[at]
    return at, v / (np.sqrt((v * v).sum()) or 1.0)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and each row's cosine to its own; starts from the
    mean's nearest row and then rows far from all centroids."""
    mean = x.mean(0)
    chosen = [int(np.argmax(x @ mean))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen].copy()
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        for j in range(len(c)):
            if (own == j).any():
                m = x[own == j].mean(0)
                c[j] = m / (np.sqrt((m * m).sum()) or 1.0)
    return c, (x @ c.T).max(1)


def lowest(hashes: DataFrame, k: int) -> DataFrame:
    """(label, most): the ``k``-th lowest distinct ``h`` of each label, or the
    highest where there are fewer. Each task hands on its own ``k`` lowest a label;
    these are narrowed down digit by digit, by counts that are added up in the
    tasks, so no label is sorted or met whole anywhere."""
    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            for label, some in batch.groupby("label")["h"]:
                kept[label] = np.unique(np.append(kept.get(label, np.empty(0, np.int64)), some.to_numpy(np.int64)))[:k]
        for label, some in kept.items():
            yield pd.DataFrame({"label": label, "h": some})

    low = cut(hashes.mapInPandas(own, "label string, h bigint").distinct(), "lowest")
    found = low.groupBy("label").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("need")).withColumn("prefix", F.lit(0).cast("long"))
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        here = low.join(small(found), "label").filter(F.shiftright("h", shift + DIGIT_BITS) == F.col("prefix"))
        counts = here.groupBy("label", "need", F.shiftright("h", shift).alias("next")).agg(F.count(F.lit(1)).alias("n"))
        # at most 2 ** DIGIT_BITS rows a label
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("label").orderBy("next")))
        found = cut(upto.filter(F.col("upto") >= F.col("need")).groupBy("label").agg(
            F.min(F.struct("next", (F.col("need") - F.col("upto") + F.col("n")).alias("need"))).alias("at")).select(
            "label", "at.need", F.col("at.next").alias("prefix")), "lowest-digits")
    drop(low)
    return found.select("label", F.col("prefix").alias("most"))


def fit(train: DataFrame, text_col: str, label_col: str, id_col: str, clusters: int, per_language: int, reach: float,
        least: float) -> dict:
    """The model: idf, centroids, their languages and limits."""
    usable = train.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, df = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch[text_col]:
                if has_letter(text):
                    df[term_counts(text)[0]] += 1
                    n += 1
        at = np.nonzero(df)[0]
        yield pd.DataFrame({"bucket": [*at, -1], "n": [*df[at], n]})

    rows = usable.select(text_col).mapInPandas(frequencies, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    h = F.xxhash64(F.col(id_col), F.col(text_col)).bitwiseAND((1 << HASH_BITS) - 1)
    limit = lowest(usable.select(F.col(label_col).alias("label"), h.alias("h")), per_language)
    sample = usable.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), h.alias("h")).join(
        small(limit), "label").filter(F.col("h") <= F.col("most")).dropDuplicates(["label", "h"])

    def centroids(key, rows: pd.DataFrame) -> pd.DataFrame:
        """k-means over one language's sample: at most per_language texts."""
        made = [vector(t, idf) for t in rows.sort_values("h")["text"] if has_letter(t)]
        if not made:
            return pd.DataFrame({"label": [], "j": [], "limit": [], "centroid": []})
        x = np.zeros((len(made), BUCKETS), np.float32)
        for row, (at, v) in zip(x, made, strict=True):
            row[at] = v
        c, cosines = spherical_kmeans(x, clusters)
        limit = max(least, float(cosines.mean() - reach * cosines.std()))
        return pd.DataFrame({"label": key[0], "j": range(len(c)), "limit": limit, "centroid": list(c.astype(np.float64))})

    found = sample.groupBy("label").applyInPandas(centroids, "label string, j int, limit double, centroid array<double>")
    rows = sorted(found.collect(), key=lambda r: (r["label"], r["j"]))  # at most clusters rows a language
    return {"idf": idf, "centroids": np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), BUCKETS),
            "labels": [r["label"] for r in rows], "limits": [r["limit"] for r in rows]}


def identify(df: DataFrame, model: dict, text_col: str = "text", out: str = "language") -> DataFrame:
    """``df`` with a struct column ``out``: label, score, rejected."""
    (o,) = fresh(df, out)
    shared = df.sparkSession.sparkContext.broadcast(model)  # clusters x languages x BUCKETS numbers

    def predict(text: str | None) -> tuple:
        m = shared.value
        if not m["labels"] or not has_letter(text):
            return (UNKNOWN, 0.0, True)
        at, v = vector(text, m["idf"])
        cosines = m["centroids"][:, at] @ v
        best = int(np.argmax(cosines))
        cosine = float(cosines[best])
        return (m["labels"][best], min(1.0, max(0.0, cosine)), cosine < m["limits"][best])

    return df.withColumn(o, per_text(predict, "label string, score double, rejected boolean")(F.col(text_col)))


def held_out(id_col: str, folds: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(1)) == 0


def language_id(df: DataFrame, train: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
                clusters: int = 4, per_language: int = PER_LANGUAGE, reach: float = 4.0, least: float = 0.05,
                out: str = "language") -> DataFrame:
    return identify(df, fit(train, text_col, label_col, id_col, clusters, per_language, reach, least), text_col, out)


def op3_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    train = docs.filter(~held_out("doc_id", 5))
    found = language_id(docs.select("doc_id", "text"), train)
    return found.select("doc_id", held_out("doc_id", 5).alias("held_out"), F.col("language.label").alias("lang_pred"),
                        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))
