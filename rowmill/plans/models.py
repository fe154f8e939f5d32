"""Queries over models (ML1-ML4, SNK14)."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowmill.operators import models
from rowmill.operators.numbering import split
from rowmill.registry import query, table
from rowmill.session import fresh_path


def _features(spark: SparkSession, sf_dir: str, label, fourth: str = "l_extendedprice") -> DataFrame:
    """A scalar, another, and a vector made of two more, in one feature vector; none is the label."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", label.alias("target")
    )
    inner = VectorAssembler(inputCols=["l_tax", fourth], outputCol="metrics").transform(lines)
    return models.assemble(inner, ["l_quantity", "l_discount", "metrics"], "target")


def _train_test(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    parts = split(features, {"train": 0.55, "test": 0.45}, ["l_orderkey", "l_linenumber", "l_partkey"])
    return parts.where(F.col("split") == "train"), parts.where(F.col("split") == "test")


@query("ML1", """
    SELECT l_orderkey, l_linenumber, l_partkey, 4 AS size, l_quantity + l_discount + l_tax + l_extendedprice AS total FROM lineitem
""")
def ml_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir, F.col("l_tax")).withColumn("f", vector_to_array("features"))
    f = F.col("f")
    return features.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.size("f").alias("size"), (f[0] + f[1] + f[2] + f[3]).alias("total")
    )


@query("ML2 SMP2", """
    WITH s AS (SELECT l_quantity AS x1, l_discount AS x2, l_tax AS x3, l_linenumber AS x4, l_extendedprice AS y,
                      CAST(('0x' || substr(md5('0|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), 1, 8)) AS BIGINT) / 4294967296e0 < 0.55 AS train
               FROM lineitem),
    -- Each column without what the ones before it explain in the training part; what is left of y is the error.
    r0 AS (SELECT train, x1 - avg(x1) FILTER (train) OVER () AS x1, x2 - avg(x2) FILTER (train) OVER () AS x2,
                  x3 - avg(x3) FILTER (train) OVER () AS x3, x4 - avg(x4) FILTER (train) OVER () AS x4, y - avg(y) FILTER (train) OVER () AS y FROM s),
    f1 AS (SELECT regr_slope(x2, x1) AS b2, regr_slope(x3, x1) AS b3, regr_slope(x4, x1) AS b4, regr_slope(y, x1) AS b FROM r0 WHERE train),
    r1 AS (SELECT train, x2 - b2 * x1 AS x2, x3 - b3 * x1 AS x3, x4 - b4 * x1 AS x4, y - b * x1 AS y FROM r0, f1),
    f2 AS (SELECT regr_slope(x3, x2) AS b3, regr_slope(x4, x2) AS b4, regr_slope(y, x2) AS b FROM r1 WHERE train),
    r2 AS (SELECT train, x3 - b3 * x2 AS x3, x4 - b4 * x2 AS x4, y - b * x2 AS y FROM r1, f2),
    f3 AS (SELECT regr_slope(x4, x3) AS b4, regr_slope(y, x3) AS b FROM r2 WHERE train),
    r3 AS (SELECT train, x4 - b4 * x3 AS x4, y - b * x3 AS y FROM r2, f3),
    f4 AS (SELECT regr_slope(y, x4) AS b FROM r3 WHERE train)
    SELECT count(*) AS rows_scored, round(sqrt(avg((y - b * x4) * (y - b * x4)))) AS rmse FROM r3, f4 WHERE NOT train
""")
def ml_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price from quantity, discount, tax and line number, regularised; error over the held-out part.

    The penalty is small beside prices: it moves the error by hundredths, so in whole units it is
    that of least squares.
    """
    train, test = _train_test(_features(spark, sf_dir, F.col("l_extendedprice"), "l_linenumber"))
    # Every pass of the fit reads the part again: split and assembled once, it is kept on executors meanwhile.
    kept = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = models.fit_linear(kept)
    finally:
        kept.unpersist()
    error = F.avg(F.pow(F.col("prediction") - F.col("label"), F.lit(2)))
    return model.transform(test).agg(F.count(F.lit(1)).alias("rows_scored"), F.round(F.sqrt(error)).alias("rmse"))


@query("ML2", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
    FROM lineitem
""")
def ml_linear_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without regularisation the fit is least squares, which SQL can check."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    model = models.fit_linear(models.assemble(lines, ["l_quantity"], "l_extendedprice"), regParam=0.0, elasticNetParam=0.0)
    return lines.agg(
        F.lit(round(float(model.coefficients[0]), 2)).alias("slope"), F.lit(round(float(model.intercept), 2)).alias("intercept")
    )


@query("ML2", """
    WITH s AS (SELECT l_quantity AS x, l_extendedprice / 20000 AS y FROM lineitem),
    m AS (SELECT corr(x, y) AS r, stddev_samp(x) AS sx, stddev_samp(y) AS sy, avg(x) AS mx, avg(y) AS my, (count(*) - 1) / count(*) AS u FROM s),
    b AS (SELECT *, sign(r) * greatest(abs(r) * u - 0.3 * 0.8 / sy, 0) / (u + 0.3 * 0.2 / sy) * sy / sx AS slope FROM m)
    SELECT round(slope, 5) AS slope, round(my - slope * mx, 4) AS intercept FROM b
""")
def ml_linear_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column under the same penalty: its coefficient is the correlation, cut by the first part and shrunk by
    the second, both in units of the standardised price."""
    lines = table(spark, sf_dir, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 20000).alias("price"))
    model = models.fit_linear(models.assemble(lines, ["l_quantity"], "price"), maxIter=100, tol=1e-10)
    return spark.range(1).select(
        F.lit(round(float(model.coefficients[0]), 5)).alias("slope"), F.lit(round(float(model.intercept), 4)).alias("intercept")
    )


def _returned() -> Column:
    return F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)


def _rounded(metrics: DataFrame, digits: int) -> DataFrame:
    """Without negative zeros."""
    return metrics.withColumn("value", F.round("value", digits) + 0.0)


@query("ML3 ML4", """
    WITH s AS (SELECT avg(CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END) AS p FROM lineitem),
    c AS (SELECT '0.0' AS item, 1 - p AS share, CASE WHEN p < 0.5 THEN 1e0 ELSE 0e0 END AS r FROM s
          UNION ALL SELECT '1.0', p, CASE WHEN p < 0.5 THEN 0e0 ELSE 1e0 END FROM s),
    l AS (SELECT item, share, unnest(['false_positive_rate', 'true_positive_rate', 'recall', 'precision', 'f_measure']) AS metric,
                 unnest([r, r, r, r * share, r * 2 * share / (1 + share)]) AS value FROM c),
    m AS (SELECT 'label' AS scope, item, metric, value FROM l
          UNION ALL SELECT 'overall', 'all', metric, sum(share * value) FROM l GROUP BY metric
          UNION ALL SELECT 'overall', 'all', 'accuracy', greatest(p, 1 - p) FROM s
          UNION ALL SELECT 'iteration', '0', 'objective', -(p * ln(p) + (1 - p) * ln(1 - p)) FROM s
          UNION ALL SELECT 'coefficient', '0,' || unnest(range(4)), 'weight', 0e0
          UNION ALL SELECT 'coefficient', '0', 'intercept', ln(p / (1 - p)) FROM s)
    SELECT scope, item, metric, round(value, 6) + 0e0 AS value FROM m
""")
def ml_logistic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a line was returned; the training summary as one row per number.

    At this regularisation no column helps and the fit is the share of returned lines, whose summary
    has a closed form.
    """
    model = models.fit_logistic(_features(spark, sf_dir, _returned()))
    return _rounded(models.logistic_metrics(spark, model), 6)


@query("ML3 ML4", """
    WITH r AS (SELECT l_quantity > 25 AS x, (l_quantity > 25) <> (l_orderkey % 10 < 2 OR l_linenumber = 3) AS y FROM lineitem),
    q AS (SELECT x, avg(y::INT) AS p FROM r GROUP BY 1),
    d AS (SELECT y, p > 0.5 AS z FROM r JOIN q USING (x)),
    k AS (SELECT c.y AS cls, count(*) AS n, count(*) FILTER (d.y = c.y) AS own, count(*) FILTER (z = c.y) AS called,
                 count(*) FILTER (d.y = c.y AND z = c.y) AS hit FROM d, (VALUES (true), (false)) c(y) GROUP BY 1),
    l AS (SELECT CASE WHEN cls THEN '1.0' ELSE '0.0' END AS item, own / n AS share,
                 unnest(['false_positive_rate', 'true_positive_rate', 'recall', 'precision', 'f_measure']) AS metric,
                 unnest([(called - hit) / (n - own), hit / own, hit / own, hit / called, 2 * hit / (own + called)]) AS value FROM k),
    m AS (SELECT 'label' AS scope, item, metric, value FROM l
          UNION ALL SELECT 'overall', 'all', metric, sum(share * value) FROM l GROUP BY metric
          UNION ALL SELECT 'overall', 'all', 'accuracy', avg((y = z)::INT) FROM d
          UNION ALL SELECT 'coefficient', '0,0', 'weight', sum(CASE WHEN x THEN 1 ELSE -1 END * ln(p / (1 - p))) FROM q
          UNION ALL SELECT 'coefficient', '0', 'intercept', ln(p / (1 - p)) FROM q WHERE NOT x)
    SELECT scope, item, metric, round(value, 4) + 0e0 AS value FROM m
""")
def ml_logistic_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label that one yes-or-no column tells in part: unregularised, each side's probability is its share."""
    large = F.col("l_quantity") > 25
    swapped = (F.col("l_orderkey") % 10 < 2) | (F.col("l_linenumber") == 3)
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(large, 1.0).otherwise(0.0).alias("large"), F.when(large != swapped, 1.0).otherwise(0.0).alias("target")
    )
    features = models.assemble(lines, ["large"], "target")
    model = models.fit_logistic(features, regParam=0.0, elasticNetParam=0.0, maxIter=100, tol=1e-10)
    return _rounded(models.logistic_metrics(spark, model).where("scope <> 'iteration'"), 4)


@query("ML4 ML3", """
    SELECT count(*) AS rows_counted, count(*) AS rows_summarised, avg(CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END) > 0 AS accuracy_agrees
    FROM lineitem
""")
def ml_metrics_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary's accuracy and row count against a recount over the predictions of all rows."""
    features = _features(spark, sf_dir, _returned())
    model = models.fit_logistic(features, regParam=0.0)
    right = F.avg(F.when(F.col("prediction") == F.col("label"), 1.0).otherwise(0.0))
    recount = model.transform(features).agg(right.alias("accuracy"), F.count(F.lit(1)).alias("rows_counted"))
    return recount.select(
        "rows_counted", F.lit(model.summary.predictions.count()).alias("rows_summarised"),
        (F.abs(F.col("accuracy") - model.summary.accuracy) < 1e-9).alias("accuracy_agrees"),
    )


@query("SNK14 ML3", "SELECT count(*) AS rows_scored, true AS same FROM lineitem")
def ml_save_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored model gives the predictions of the fitted one."""
    features = _features(spark, sf_dir, _returned())
    model = models.fit_logistic(features, regParam=0.01)
    path = fresh_path(spark, "model")
    models.save_model(model, path)
    again = LogisticRegressionModel.load(path)
    scored = model.transform(features).select("features", F.col("prediction").alias("before"))
    both = again.transform(scored)
    return both.agg(
        F.count(F.lit(1)).alias("rows_scored"), F.bool_and(F.col("before") == F.col("prediction")).alias("same")
    )
