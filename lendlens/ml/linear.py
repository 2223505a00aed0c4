"""A logistic model with given coefficients (the L1 selector's result, or
published ones): scoring is one native expression."""

from __future__ import annotations

from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class LinearModel:
    """``p = 1 / (1 + exp(-(intercept + sum_i coefficient_i * x_i)))``."""

    coefficients: list[float]
    intercept: float

    @staticmethod
    def by_name(names: list[str], coefficients: dict[str, float], intercept: float) -> LinearModel:
        """Coefficients given by feature name; others are 0."""
        return LinearModel([float(coefficients.get(n, 0.0)) for n in names], float(intercept))

    @property
    def n_features(self) -> int:
        return len(self.coefficients)

    def probability(self, features: Column) -> Column:
        margin = F.lit(float(self.intercept))
        for i, c in enumerate(self.coefficients):
            if c:
                margin = margin + F.lit(float(c)) * features[i]
        return 1.0 / (1.0 + F.exp(-margin))

    def transform(self, df: DataFrame, features: str, out: str = "p") -> DataFrame:
        return df.withColumn(out, self.probability(F.col(features)))

    def importances(self) -> np.ndarray:
        size = np.abs(np.array(self.coefficients))
        return size / size.sum() if size.sum() else size

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.coefficients, self.intercept)], "coefficients array<double>, intercept double").write.mode(
            "overwrite").json(f"{path}/linear")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        r = spark.read.schema("coefficients array<double>, intercept double").json(f"{path}/linear").first()
        return LinearModel(**{k: r[k] for k in asdict(LinearModel([], 0.0))})
