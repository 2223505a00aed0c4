"""Evaluation invariants: AUC equals Spark's evaluator; report identities."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendlens.ml import evaluate as EV
from lendlens.ml.features import stratified_split


def _scored(spark):
    df = spark.range(0, 4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0).alias("score"), F.col("id"))
    return df.withColumn("label", ((F.col("score") + F.pmod(F.col("id"), F.lit(7)) / 10.0) > 0.6)
                         .cast("int"))


def test_auc_matches_evaluator(spark):
    s = _scored(spark)
    roc = EV.roc_curve(s, "label", "score")
    ours = EV.auc_from_roc(roc).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC").evaluate(
        s.withColumn("label", F.col("label").cast("double")))
    assert abs(ours - ev) < 1e-9


def test_roc_ends_at_one_and_youden(spark):
    s = _scored(spark)
    roc = EV.roc_curve(s, "label", "score")
    last = roc.orderBy("threshold").first()
    assert last["tpr"] == 1.0 and last["fpr"] == 1.0
    y = EV.youden_threshold(roc).first()
    best = max(((r["tpr"] - r["fpr"], r["threshold"]) for r in roc.collect()))
    assert (y["youden_j"], y["threshold"]) == best


def test_report_support_sums(spark):
    s = EV.predictions(_scored(spark), "score", 0.5)
    rep = {r["class"]: r for r in EV.classification_report(s, "label").collect()}
    assert rep["0"]["support"] + rep["1"]["support"] == 4000
    acc = EV.accuracy(s, "label").first()["accuracy"]
    assert abs(rep["accuracy"]["f1_score"] - acc) < 1e-12


def test_split_disjoint_and_stable(spark):
    df = spark.range(0, 5000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    tr, te = stratified_split(df, "y", 0.2, 42)
    tr2, te2 = stratified_split(df, "y", 0.2, 42)
    assert tr.join(te, "id").count() == 0
    assert tr.count() + te.count() == 5000
    assert te.exceptAll(te2).count() == 0
    share = te.filter("y = 1").count() / 1000
    assert 0.15 < share < 0.25


def test_model_roundtrip_and_reference_profiles(spark):
    import tempfile

    from lendlens.ml.counterfactual import bias_gap, group_gap_report, reference_profiles
    from lendlens.ml.train import TrainedModel, train_approval_model
    from lendlens.plans import catalog
    from tests.conftest import SF_SMALL

    table = catalog._model(spark, SF_SMALL)
    model, scored = train_approval_model(table, "rf", num_trees=5, max_depth=4)
    fair, _ = train_approval_model(table, "fair", num_trees=5, max_depth=4)
    assert 0.0 <= model.metrics["roc_auc"] <= 1.0 and scored.count() > 0
    path = tempfile.mkdtemp(prefix="ll-model-")
    model.save(path)
    again = TrainedModel.load(spark, path)
    assert again.feature_names == model.feature_names and again.threshold == model.threshold
    profiles = reference_profiles(spark)
    assert profiles.count() == 16
    a = {r["scenario"]: r["p_approve"] for r in model.score(profiles).filter("derived_race = 'White'").collect()}
    b = {r["scenario"]: r["p_approve"] for r in again.score(profiles).filter("derived_race = 'White'").collect()}
    assert a == b
    gaps = bias_gap(profiles, model, fair)
    assert gaps.filter("gap_label IS NULL").count() == 0
    rep = group_gap_report(model.score(profiles.filter("scenario LIKE 'Fairness%'")),
                           "derived_race", "p_approve", "White", "scenario").collect()
    assert len(rep) == 12 and all(r["gap_vs_reference"] == 0.0 for r in rep if r["derived_race"] == "White")


def test_exact_stratified_split_sizes(spark):
    """Exact per-class sizes of a stratified 80/20 split: 201/799 rows give
    test 40/160 (train floors 160.8→161 by largest remainder, 639.2→639)."""
    from lendlens.ml.features import stratified_split_exact
    from lendlens.operators.sampling import split_sizes
    assert split_sizes([201, 799], 800) == [161, 639]
    df = spark.range(1000).selectExpr("id", "CAST(id % 1000 < 201 AS INT) AS y")
    df = df.selectExpr("id", "1 - y AS approved")
    train, test = stratified_split_exact(df, "approved", 0.2, 42)
    t = {r["approved"]: r["count"] for r in test.groupBy("approved").count().collect()}
    tr = {r["approved"]: r["count"] for r in train.groupBy("approved").count().collect()}
    assert t == {0: 40, 1: 160} and tr == {0: 161, 1: 639}
    assert train.join(test, "id").count() == 0
    _, t2 = stratified_split_exact(df.repartition(3), "approved", 0.2, 42)
    assert sorted(r["id"] for r in test.collect()) == sorted(r["id"] for r in t2.collect())


def test_auc_of_very_many_rows(spark):
    """9e9 scored rows: the products of counts do not fit a BIGINT."""
    from lendlens.ml.evaluate import auc_from_roc
    n = 3_000_000_000
    rows = [(0.9, 2 * n, n, 2 * n, n), (0.1, n, 5 * n, 3 * n, 6 * n)]
    roc = spark.createDataFrame(rows, "threshold double, pos long, neg long, tps long, fps long")
    got = auc_from_roc(roc).first()["auc"]
    assert abs(got - (1 * 2 + 5 * 5) / (2 * 6 * 3)) < 1e-12


def test_split_and_sample_of_repeated_rows(spark):
    """Half of the rows are equal: they are split and drawn like the others."""
    from pyspark.sql import functions as F

    from lendlens.ml.features import stratified_split, stratified_split_exact
    from lendlens.operators.sampling import sample_at_most
    df = spark.range(20_000, numPartitions=4).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("x"), (F.col("id") % 10 < 3).cast("int").alias("y"))
    train, test = stratified_split(df, "y", 0.2)
    assert train.count() + test.count() == 20_000
    for part in (test, test.filter("x = -1")):
        whole = df if part is test else df.filter("x = -1")
        assert abs(part.count() / whole.count() - 0.2) < 0.015
    train, test = stratified_split_exact(df, "y", 0.2)
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {0: 2800, 1: 1200}
    taken = sample_at_most(df, 2000)
    assert taken.count() == 2000 and abs(taken.filter("x = -1").count() - 1000) < 120


def test_l1_ranks_by_standard_units(spark):
    """A strong feature in large units outranks a weak one in small units."""
    from pyspark.sql import functions as F

    from lendlens.ml.train import select_features
    df = spark.range(600, numPartitions=2).select(
        (F.rand(1) * 400_000).alias("loan_amount"), F.rand(2).alias("loan_to_value_ratio"), F.rand(3).alias("u"))
    df = df.withColumn("approved", (F.col("loan_amount") / 400_000 * 4 + F.col("loan_to_value_ratio") + F.col("u") * 0.5 > 2.7).cast("int")).drop("u")
    chosen, info = select_features(df, num_c=2, max_iter=50)
    assert "loan_amount" in chosen.first()["feature"] and info["test_auc"] > 0.9


def test_landed_ids_need_no_write(spark, monkeypatch):
    """With an id column, split and sample read only: same rows whatever the
    partitioning, exact sizes, half of the rows equal but for their ids."""
    from lendlens import session
    from lendlens.ml.features import stratified_split_exact
    from lendlens.operators.sampling import sample_at_most

    def none(*_a, **_k):
        raise AssertionError("written")
    df = spark.range(12_000, numPartitions=3).select("id", F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("x"),
                                                     (F.col("id") % 10 < 3).cast("int").alias("y"))
    monkeypatch.setattr(session, "materialize", none)
    monkeypatch.setattr("lendlens.operators.window.materialize", none)
    for fn in (lambda d: stratified_split(d, "y", 0.2, id_col="id")[1], lambda d: stratified_split_exact(d, "y", 0.2, id_col="id")[1],
               lambda d: sample_at_most(d, 2400, id_col="id")):
        a, b = fn(df), fn(df.repartition(5))
        assert "Exchange" not in a._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in b.collect())
        assert abs(a.count() - 2400) < 150 and abs(a.filter("x = -1").count() - 1200) < 120
    assert sample_at_most(df, 2400, id_col="id").count() == 2400
    assert sample_at_most(df, 0, id_col="id").count() == 0 and sample_at_most(df, 10**6, id_col="id").count() == 12_000
    test = stratified_split_exact(df, "y", 0.2, id_col="id")[1]
    assert {r["y"]: r["count"] for r in test.groupBy("y").count().collect()} == {0: 1680, 1: 720}
    assert sample_at_most(df.limit(0), 5, id_col="id").count() == 0
