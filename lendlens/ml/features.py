"""Model features.

The encoder is fitted once on the training rows (ordinal DTI, medians, a
dictionary table of labels) and applied by joins and expressions, so scoring
any table reproduces training alignment exactly: an unseen or missing category
encodes as all zeros, a missing number takes the training median (T13, T14).
Labels never pass the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions import codes
from lendlens.functions import exprs as X
from lendlens.sources.tables import q


def safe_name(c: str) -> str:
    """Feature column names without characters ML params dislike."""
    return c.replace("-", "_").replace(".", "_")


def stratified_split(df: DataFrame, label: str, test_fraction: float = 0.2,
                     seed: int = 42, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split of rows by id, stratified in expectation within each class.

    A row goes to the test side when the seeded key of its id falls below the
    fraction, so equal rows are split independently and each class at the same
    rate: no window, no shuffle, and no write when ``id_col`` names the id that
    the table was landed with (without one the rows are written with ids).
    """
    from lendlens.operators.sampling import ROW_ID, drawn, with_row_id
    own = df if id_col else with_row_id(df)
    test = drawn(id_col or ROW_ID, seed, test_fraction)
    return own.filter(~test).select(*[q(c) for c in df.columns]), own.filter(test).select(*[q(c) for c in df.columns])


def stratified_split_exact(df: DataFrame, label: str, test_fraction: float = 0.2,
                           seed: int = 42, id_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """R3 with exact class sizes: ``ceil(fraction · n)`` test rows; per class
    the train size is allocated first and the test size from the remaining
    rows (floors plus largest remainders, as a stratified shuffle split does).
    Within each class the rows with the smallest keys go to the test side; the
    class thresholds come from a few counting passes over ids and labels, so
    no row is moved.
    """
    from lendlens.operators.sampling import ROW_ID, smallest_keys, split_sizes, with_row_id
    own = df if id_col else with_row_id(df)
    counts = class_counts(own, label)
    classes = sorted(counts)
    n = sum(counts.values())
    n_test = math.ceil(test_fraction * n)
    sizes = [counts[k] for k in classes]
    train_n = split_sizes(sizes, n - n_test)
    test_n = split_sizes([c - t for c, t in zip(sizes, train_n)], n_test)
    test = smallest_keys(own, id_col or ROW_ID, seed, dict(zip(classes, test_n)), label)
    cols = [q(c) for c in df.columns]
    return own.filter(~test).select(*cols), own.filter(test).select(*cols)


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class (one aggregate, a two-row result)."""
    return {int(r[0]): int(r[1]) for r in df.groupBy(label).count().collect()}


def with_class_weights(df: DataFrame, label: str, mode: str = "balanced",
                       counts: dict[int, int] | None = None, name: str = "weight") -> DataFrame:
    """M6: ``balanced`` → n / (2·n_c); ``pos_ratio`` → neg/pos on positives."""
    counts = counts or class_counts(df, label)
    n = sum(counts.values())
    if mode == "balanced":
        w = {c: n / (len(counts) * k) for c, k in counts.items()}
    elif mode == "pos_ratio":
        w = {0: 1.0, 1: counts.get(0, 0) / max(counts.get(1, 1), 1)}
    else:
        raise ValueError(mode)
    expr = F.lit(1.0)
    for c, v in w.items():
        expr = F.when(q(label) == c, F.lit(float(v))).otherwise(expr)
    return df.withColumn(name, expr)


#: Labels of a column up to which its dictionary is broadcast; and one-hot
#: slots up to which features are one dense array.
BROADCAST_LABELS = 100_000
DENSE_SLOTS = 4096


def label_dictionary(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """M1: (``c`` column number, ``label``, ``place``) for every distinct
    non-NULL value of the text columns, ``place`` its rank in its column from
    0 in alphabetical order, and the number of labels per column.

    Labels are numbered by the distributed row number over (column, label);
    only one count per column reaches the driver."""
    from lendlens.operators.aggs import value_counts
    from lendlens.operators.window import global_row_number
    cols = list(cols)
    distinct = value_counts(df, cols).select("c", F.col("v").alias("label"))
    ranked = global_row_number(distinct, [F.col("c"), F.col("label")], name="r")
    counts = {r["c"]: r["count"] for r in ranked.groupBy("c").count().collect()}
    start, starts = 0, {}
    for i in range(len(cols)):
        starts[i] = start
        start += counts.get(i, 0)
    before = F.element_at(F.create_map(*[F.lit(x) for kv in starts.items() for x in kv]), F.col("c")) if cols else F.lit(0)
    return ranked.select("c", "label", (F.col("r") - 1 - before).cast("bigint").alias("place")), {
        c: counts.get(i, 0) for i, c in enumerate(cols)}


def with_places(df: DataFrame, labels: DataFrame, cols: Sequence[str], sizes: dict[str, int], prefix: str = "_x_") -> DataFrame:
    """``df`` with the place of each text column's value (NULL: missing or
    unseen), one left join per column: a broadcast up to ``BROADCAST_LABELS``
    labels, a shuffle join (split where skewed) beyond."""
    for i, c in enumerate(cols):
        own = labels.filter(F.col("c") == i).select(F.col("label").alias(f"_label{i}"), F.col("place").alias(f"{prefix}{i}"))
        own = F.broadcast(own) if sizes[c] <= BROADCAST_LABELS else own
        df = df.join(own, q(c) == F.col(f"_label{i}"), "left").drop(f"_label{i}")
    return df


def _one_hot(place: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.when(j == place, 1.0).otherwise(0.0))


@dataclass
class Encoder:
    """M1 + M2 + C15 + C20 as fitted on the training rows: DTI labels to their
    order, ±inf to NULL, NULL numbers to training medians (0 if there is none),
    text columns to one-hot slots without the alphabetically first label. A
    missing or unseen label has no slot."""

    numeric: list[str]
    ordinal: list[str]
    categorical: list[str]
    medians: dict[str, float]
    sizes: dict[str, int]
    labels: DataFrame
    drop_first: bool = True

    @property
    def offsets(self) -> list[int]:
        at, out = len(self.numeric), []
        for c in self.categorical:
            out.append(at)
            at += max(self.sizes[c] - self.drop_first, 0)
        return [*out, at]

    @property
    def n_features(self) -> int:
        return self.offsets[-1]

    def _numbers(self) -> list[Column]:
        out = []
        for c in self.numeric:
            v = dti_ordinal(c).cast("double") if c in self.ordinal else X.finite(q(c).cast("double"))
            out.append(F.coalesce(v, F.lit(float(self.medians.get(c) or 0.0))))
        return out

    def sparse(self, df: DataFrame, numbers: str = "numbers", slots: str = "slots") -> DataFrame:
        """``df`` with its numbers and, per text column that has one, the slot
        of its label: for dictionaries of any size."""
        own = with_places(df, self.labels, self.categorical, self.sizes)
        found = [F.when(F.col(f"_x_{i}") >= int(self.drop_first), F.col(f"_x_{i}") - int(self.drop_first) + self.offsets[i])
                 for i in range(len(self.categorical))]
        made = F.array_compact(F.array(*found)) if found else F.array().cast("array<bigint>")
        return own.withColumn(numbers, F.array(*self._numbers())).withColumn(slots, made).drop(
            *[f"_x_{i}" for i in range(len(self.categorical))])

    def array(self, df: DataFrame, name: str = "x") -> DataFrame:
        """``df`` with all features as one dense array."""
        if self.n_features > DENSE_SLOTS:
            raise ValueError(f"{self.n_features} features do not make a dense array: reduce the categories or use sparse()")
        own = with_places(df, self.labels, self.categorical, self.sizes)
        parts = [F.array(*self._numbers())] if self.numeric else []
        for i, c in enumerate(self.categorical):
            k = self.sizes[c] - self.drop_first
            if k > 0:
                parts.append(_one_hot(F.coalesce(F.col(f"_x_{i}"), F.lit(-1)) - int(self.drop_first), k))
        return own.withColumn(name, F.concat(*parts)).drop(*[f"_x_{i}" for i in range(len(self.categorical))])

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features`` as an ML vector."""
        from pyspark.ml.functions import array_to_vector
        return self.array(df, "_dense").withColumn("features", array_to_vector("_dense")).drop("_dense")

    def names_table(self) -> DataFrame:
        """(``slot``, ``name``) of every feature."""
        spark = self.labels.sparkSession
        numbers = spark.createDataFrame([(i, safe_name(c)) for i, c in enumerate(self.numeric)], "slot bigint, name string")
        column = F.element_at(F.array(*[F.lit(safe_name(c)) for c in self.categorical] or [F.lit("")]), F.col("c") + 1)
        offset = F.element_at(F.array(*[F.lit(x) for x in self.offsets]), F.col("c") + 1)
        own = self.labels.filter(F.col("place") >= int(self.drop_first)).select(
            (offset + F.col("place") - int(self.drop_first)).cast("bigint").alias("slot"), F.concat(column, F.lit("_"), F.col("label")).alias("name"))
        return numbers.union(own)

    def names(self) -> list[str]:
        """The feature names in order, of at most ``DENSE_SLOTS`` features."""
        if self.n_features > DENSE_SLOTS:
            raise ValueError("too many features to list; use names_table()")
        return [r["name"] for r in sorted(self.names_table().collect())]

    def save(self, path: str) -> None:
        import json
        spark = self.labels.sparkSession
        self.labels.write.mode("overwrite").parquet(f"{path}/labels")
        meta = {k: getattr(self, k) for k in ("numeric", "ordinal", "categorical", "medians", "sizes", "drop_first")}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark, path: str) -> Encoder:
        import json
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        return Encoder(**meta, labels=spark.read.schema("c int, label string, place bigint").parquet(f"{path}/labels"))


def fit_encoder(train: DataFrame, label: str = "approved", categorical: Sequence[str] | None = None,
                ordinal_cols: Sequence[str] = ("debt_to_income_ratio",), drop_first: bool = True,
                leave_out: Sequence[str] = ()) -> Encoder:
    """Fit on the training rows: medians of the numbers, a dictionary of the
    text columns. Columns in ``leave_out`` (ids) are no features."""
    from lendlens.operators.aggs import column_medians
    from lendlens.session import materialize
    types = dict(train.dtypes)
    cols = [c for c in train.columns if c != label and c not in leave_out]
    ordinal = [c for c in ordinal_cols if c in cols and types[c] == "string"]
    if categorical is None:
        categorical = [c for c in cols if types[c] == "string" and c not in ordinal]
    numeric = [c for c in cols if c not in categorical]
    values = [(dti_ordinal(c).cast("double") if c in ordinal else X.finite(q(c).cast("double"))).alias(f"n{i}") for i, c in enumerate(numeric)]
    medians = {}
    if numeric:
        row = column_medians(train.select(*values), [f"n{i}" for i in range(len(numeric))]).first()
        medians = {c: row[f"n{i}"] for i, c in enumerate(numeric)}
    places, sizes = label_dictionary(train, categorical)
    return Encoder(numeric, ordinal, list(categorical), medians, sizes, materialize(places, "labels"), drop_first)


def fit_feature_pipeline(train: DataFrame, label: str = "approved",
                         categorical: Sequence[str] | None = None,
                         ordinal_cols: Sequence[str] = ("debt_to_income_ratio",),
                         drop_first: bool = True) -> tuple[Encoder, list[str]]:
    """The fitted encoder and its feature names."""
    encoder = fit_encoder(train, label, categorical, ordinal_cols, drop_first)
    return encoder, encoder.names()


def reduce_high_cardinality(df: DataFrame, cols: Sequence[str] | None = None,
                            top_n: int = 10, max_distinct: int = 20) -> DataFrame:
    """A16 for feature selection: rare values of wide text columns → OTHER."""
    from lendlens.operators.aggs import reduce_categories
    cols = list(cols or [c for c, t in df.dtypes if t == "string"])
    return reduce_categories(df, cols, top_n=top_n, max_distinct=max_distinct)


def dti_ordinal(c) -> "F.Column":
    """C15 with the fixed nine-label DTI order; anything else → NULL."""
    return X.ordinal(c, codes.DTI_ORDER)
