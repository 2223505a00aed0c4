"""Approval models.

* ``train_approval_model(kind)``: ``rf`` (forest of unlimited depth, balanced
  class weights), ``gbt`` (second-order boosted trees, positives weighted
  neg/pos) or ``fair`` (the forest without demographic columns). Fit on the
  training side of the stratified split, evaluated on the test side with the
  distributed ROC / Youden / report operators.
* ``select_features``: L1 logistic regressions for a grid of penalties and
  folds at once, chosen by mean AUC over the folds, non-zero coefficients
  ranked by size per standard deviation.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens.functions import codes
from lendlens.ml import evaluate as EV
from lendlens.ml.boost import BoostedTrees, BoostParams, fit_boosted
from lendlens.ml.features import Encoder, class_counts, fit_encoder, stratified_split
from lendlens.ml.forest import Forest, ForestParams, fit_forest
from lendlens.ml.lasso import auc_by_group, l1_path, scores
from lendlens.ml.linear import LinearModel
from lendlens.operators.sampling import ROW_ID, draw_key, with_row_id
from lendlens.session import discard, materialize
from lendlens.sources.tables import drop_existing, drop_family, write_table

LEARNERS = {"rf": Forest, "fair": Forest, "gbt": BoostedTrees, "linear": LinearModel}
#: Trees and depth limit of each kind (None: grown to the end).
TREES = {"rf": (400, None), "fair": (400, None), "gbt": (500, 6)}


@dataclass
class TrainedModel:
    kind: str
    encoder: Encoder
    learner: Forest | BoostedTrees | LinearModel
    feature_names: list[str]
    threshold: float
    metrics: dict = field(default_factory=dict)
    input_types: dict = field(default_factory=dict)   # raw input column → type

    def score(self, df: DataFrame, prob_col: str = "p_approve") -> DataFrame:
        """Align and score any table of applicants (batch)."""
        return score(self, df, prob_col)

    def save(self, path: str) -> None:
        """Encoder (medians, labels, feature order) and learner, plus a
        one-row metadata table, all written through Spark."""
        spark = SparkSession.getActiveSession()
        self.encoder.save(f"{path}/encoder")
        self.learner.save(spark, f"{path}/learner")
        meta = {"kind": self.kind, "threshold": self.threshold, "feature_names": json.dumps(self.feature_names),
                "input_types": json.dumps(self.input_types), "metrics": json.dumps(self.metrics)}
        spark.createDataFrame([meta]).write.mode("overwrite").json(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TrainedModel:
        """Read a model written by ``save``."""
        m = spark.read.json(f"{path}/meta").first()
        return TrainedModel(m["kind"], Encoder.load(spark, f"{path}/encoder"), LEARNERS[m["kind"]].load(spark, f"{path}/learner"),
                            json.loads(m["feature_names"]), float(m["threshold"]),
                            json.loads(m["metrics"]), json.loads(m["input_types"]))


def model_input(table: DataFrame, kind: str, label: str = "approved") -> DataFrame:
    """P4 for the fair model: demographic columns removed before encoding."""
    return drop_family(table, codes.DEMOGRAPHIC_COLUMNS) if kind == "fair" else table


def fit_learner(kind: str, train: DataFrame, label: str, n_features: int, counts: dict[int, int], seed: int = 42,
                num_trees: int | None = None, max_depth: int | None = None, min_info_gain: float = 0.1) -> Forest | BoostedTrees:
    """M4/M5 on an encoded training table (columns ``x`` and ``label``)."""
    trees, depth = num_trees or TREES[kind][0], max_depth or TREES[kind][1]
    if kind == "gbt":
        weight = counts.get(0, 0) / max(counts.get(1, 1), 1)
        return fit_boosted(train, "x", label, n_features, BoostParams(
            rounds=trees, max_depth=depth, gamma=min_info_gain, scale_pos_weight=weight, seed=seed))
    return fit_forest(train, "x", label, n_features, ForestParams(trees=trees, max_depth=depth, seed=seed))


def train_approval_model(table: DataFrame, kind: str = "rf", label: str = "approved",
                         seed: int = 42, num_trees: int | None = None, max_depth: int | None = None,
                         test_fraction: float = 0.2, min_info_gain: float = 0.1,
                         id_col: str | None = None) -> tuple[TrainedModel, DataFrame]:
    """Q12: fit and evaluate one model kind; returns the model and the scored
    test split (``label``, ``p_approve``). Trees and depth default to ``TREES``.

    ``min_info_gain`` is the gain below which a boosted split is pruned;
    ``id_col`` names the id of landed rows, by which they are split."""
    df = model_input(table, kind, label)
    train, test = stratified_split(df, label, test_fraction, seed, id_col)
    # read several times: written once, with the features that are in use
    train = materialize(train.drop(*([id_col] if id_col else [])), "train")
    counts = class_counts(train, label)
    encoder = fit_encoder(train, label)
    names = encoder.names()
    encoded = materialize(encoder.array(train, "x").select("x", F.col(label).cast("int").alias(label)), "encoded")
    learner = fit_learner(kind, encoded, label, encoder.n_features, counts, seed, num_trees, max_depth, min_info_gain)
    discard(encoded), discard(train)
    inputs = {c: t for c, t in df.dtypes if c not in (label, id_col)}
    model = TrainedModel(kind, encoder, learner, names, 0.5, {}, inputs)
    # inference runs once: the two-column scored split is written and read by
    # ROC, threshold, AUC, accuracy and report alike
    scored = materialize(score(model, test).select(F.col(label).cast("int").alias(label), "p_approve"), "scored-test")
    model.metrics = {"model": kind, **measured(scored, label), "n_features_used": len(names), "train_rows": sum(counts.values())}
    model.threshold = model.metrics["threshold"]
    return model, scored


def measured(scored: DataFrame, label: str = "approved") -> dict:
    """M7, M8: threshold by Youden's J, accuracy at it, area under the curve."""
    roc = EV.roc_curve(scored, label, "p_approve")
    yt = EV.youden_threshold(roc).first()
    threshold = float(yt["threshold"]) if yt["threshold"] is not None else 0.5
    auc = EV.auc_from_roc(roc).first()["auc"]
    acc = EV.accuracy(EV.predictions(scored, "p_approve", threshold), label).first()["accuracy"]
    return {"accuracy": round(float(acc or 0.0), 5), "roc_auc": round(float(auc or 0.0), 5), "threshold": threshold}


def model_report(model: TrainedModel, scored: DataFrame, label: str = "approved") -> DataFrame:
    """M9 of a trained model: the classification report of its test split at
    its threshold."""
    return EV.classification_report(EV.predictions(scored, "p_approve", model.threshold), label)


def feature_importances(model: TrainedModel, top: int = 20) -> list[tuple[str, float]]:
    """Importances zipped with the encoded feature names."""
    pairs = sorted(zip(model.feature_names, model.learner.importances()), key=lambda t: (-t[1], t[0]))
    return [(n, float(v)) for n, v in pairs[:top]]


def score(model: TrainedModel, df: DataFrame, prob_col: str = "p_approve") -> DataFrame:
    """Score rows; a wholly absent numeric feature column is 0 and an
    absent text column is NULL (→ all-zero dummies), as in the reference."""
    out = df
    for c, t in model.input_types.items():
        if c not in df.columns:
            out = out.withColumn(c, F.lit(None).cast("string") if t == "string" else F.lit(0.0))
    scored = model.learner.transform(model.encoder.array(out, "_x"), "_x", "_p")
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_p").alias(prob_col))


def metrics_frame(spark: SparkSession, model: TrainedModel) -> DataFrame:
    """The metrics as a one-row DataFrame, the threshold to five digits."""
    return spark.createDataFrame([{**model.metrics, "threshold": round(model.threshold, 5)}])


def write_metrics(model: TrainedModel, path: str) -> DataFrame:
    """The metrics as JSON at ``path``; returns them as read back."""
    spark = SparkSession.getActiveSession()
    frame = metrics_frame(spark, model)
    write_table(frame, path, fmt="json")
    return spark.read.schema(frame.schema).json(path)


# --------------------------------------------------------------------------
# Q11 — L1 feature selection
# --------------------------------------------------------------------------
def select_features(table: DataFrame, label: str = "approved", seed: int = 42,
                    num_c: int = 10, folds: int = 3, max_iter: int = 3000,
                    id_col: str | None = None) -> tuple[DataFrame, dict]:
    """M3 + M11: L1 logistic regression, penalty chosen by k-fold AUC.

    All fits of the grid ``C = logspace(-4, 4, num_c)`` by the folds, and those
    on all training rows, advance in the same passes (``ml.lasso``).
    Coefficients are per standard deviation of the training rows and ranked by
    size. Folds come from the rows' ids, so they are stable across
    recomputation. The chosen fit is evaluated on the test split.
    """
    from lendlens.ml.features import reduce_high_cardinality
    spark = table.sparkSession
    df = drop_existing(table, codes.SELECTION_DROP)
    df = reduce_high_cardinality(df, [c for c, t in df.dtypes if t == "string" and c != id_col])
    if not id_col:
        df = materialize(with_row_id(df), "selection")
    key = id_col or ROW_ID
    train, test = stratified_split(df, label, 0.2, seed, key)
    counts = class_counts(train, label)
    n = sum(counts.values())
    weight = F.lit(1.0)
    for k, own in counts.items():
        weight = F.when(F.col(label) == k, n / (len(counts) * own)).otherwise(weight)
    encoder = fit_encoder(train, label, leave_out=[key])
    names = encoder.names()
    fold = F.pmod(draw_key(key, seed + 1), F.lit(folds)).cast("int")
    enc = materialize(encoder.array(train, "x").select("x", F.col(label).cast("double").alias("label"), weight.alias("weight"),
                                                       fold.alias("fold")), "selection-train")
    cs = [10 ** (-4 + 8 * i / (num_c - 1)) for i in range(num_c)] if num_c > 1 else [1.0]
    fits = l1_path(enc, encoder.n_features, cs, [*range(folds), -1], max_iter)
    aucs = {r["fit"]: r["auc"] for r in auc_by_group(scores(enc, fits), "fit", "label", "score").collect()}
    mean = [np.mean([aucs.get(fits.index(c, f)) or 0.0 for f in range(folds)]) for c in range(len(cs))]
    best = int(np.argmax(mean))  # ties: the stronger penalty
    chosen = fits.index(best, -1)
    coefs = fits.coefficients[chosen]
    rows = [(nm, float(c), abs(float(c))) for nm, c in zip(names, coefs)]
    selected = spark.createDataFrame(rows, "feature string, coef double, abs double")
    selected = selected.filter(F.col("coef") != 0).orderBy(F.col("abs").desc(), F.col("feature"))
    raw = (coefs / fits.spreads).tolist()
    learner = LinearModel(raw, float(fits.intercepts[chosen] - np.dot(raw, fits.means)))
    inputs = {c: t for c, t in df.dtypes if c not in (label, key)}
    model = TrainedModel("linear", encoder, learner, names, 0.5, {}, inputs)
    held = materialize(score(model, test).select(F.col(label).cast("int").alias(label), "p_approve"), "selection-test")
    model.metrics = {"model": "linear", **measured(held, label), "n_features_used": len(names), "train_rows": n}
    # the selector decides at a probability of one half
    half = EV.accuracy(EV.predictions(held, "p_approve", 0.5), label).first()["accuracy"]
    info = {"best_C": cs[best], "n_features": len(names), "n_selected": int((coefs != 0).sum()), "passes": fits.passes,
            "cv_auc": float(mean[best]), "test_auc": model.metrics["roc_auc"], "test_accuracy": round(float(half or 0.0), 5),
            "model": model}
    discard(enc), discard(held)
    return selected, info
