"""Feature assembly, the two regressions and their metrics as rows (ML1-ML4, SNK14)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession

# fixed values: the settings both regressions are trained with
FIT = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}


def assemble(df: DataFrame, inputs: list[str], label: str) -> DataFrame:
    """ML1: scalars and vectors into one ``features`` vector beside ``label``."""
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(df)
    return assembled.withColumnRenamed(label, "label")


def fit_linear(train: DataFrame, **settings) -> LinearRegressionModel:
    """ML2."""
    return LinearRegression(**{**FIT, **settings}).fit(train)


def fit_logistic(train: DataFrame, **settings) -> LogisticRegressionModel:
    """ML3."""
    return LogisticRegression(**{**FIT, **settings}).fit(train)


def logistic_metrics(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    """ML4: (scope, item, metric, value) rows from the training summary; one row per number."""
    summary = model.summary
    labels = [str(label) for label in summary.labels]
    by_label = {
        "false_positive_rate": summary.falsePositiveRateByLabel,
        "true_positive_rate": summary.truePositiveRateByLabel,
        "precision": summary.precisionByLabel,
        "recall": summary.recallByLabel,
        "f_measure": summary.fMeasureByLabel(),
    }
    overall = {
        "accuracy": summary.accuracy,
        "false_positive_rate": summary.weightedFalsePositiveRate,
        "true_positive_rate": summary.weightedTruePositiveRate,
        "precision": summary.weightedPrecision,
        "recall": summary.weightedRecall,
        "f_measure": summary.weightedFMeasure(),
    }
    rows = [
        ("label", label, metric, float(value))
        for metric, values in by_label.items()
        for label, value in zip(labels, values, strict=True)
    ]
    rows += [("overall", "all", metric, float(value)) for metric, value in overall.items()]
    rows += [
        ("iteration", str(i), "objective", float(value))
        for i, value in enumerate(summary.objectiveHistory)
    ]
    rows += [
        ("coefficient", f"{i},{j}", "weight", float(value))
        for i, line in enumerate(model.coefficientMatrix.toArray())
        for j, value in enumerate(line)
    ]
    rows += [
        ("coefficient", str(i), "intercept", float(value))
        for i, value in enumerate(model.interceptVector.toArray())
    ]
    return spark.createDataFrame(rows, "scope string, item string, metric string, value double")


def save_model(model, path: str) -> None:
    """SNK14."""
    model.write().overwrite().save(path)
