"""User-defined functions (UDF1-UDF8), each typed, each beside its native twin.

They are pickled by value, so executors run them without having this package installed.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType

register_pickle_by_value(sys.modules[__name__])


@F.udf(LongType())
def root_step_python(value):
    """UDF1: row-at-a-time form of ``floor(sqrt(x)) + 1``."""
    return None if value is None else math.floor(math.sqrt(value)) + 1


@F.pandas_udf(LongType())
def root_step_pandas(values: pd.Series) -> pd.Series:
    """UDF4: the same over Arrow batches."""
    return (np.floor(np.sqrt(values.astype("float64"))) + 1).astype("Int64")


def root_step(value: Column) -> Column:
    """UDF3: the native form, which stays inside generated code."""
    return F.floor(F.sqrt(value)) + 1


def register_root_step(spark: SparkSession, name: str = "root_step") -> None:
    """UDF2: make the vectorised form callable from SQL text."""
    spark.udf.register(name, root_step_pandas)


def linear_scorer(spark: SparkSession, coefficients: list[float], intercept: float):
    """UDF5: score rows by a broadcast linear model, one unpickling per task, batch by batch."""
    model = spark.sparkContext.broadcast((np.asarray(coefficients, dtype="float64"), float(intercept)))

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        weights, bias = model.value
        for batch in batches:
            total = pd.Series(0.0, index=batch[0].index)
            for weight, feature in zip(weights, batch, strict=True):
                total = total + weight * feature.astype("float64")
            yield total + bias

    return score


@F.udf(IntegerType())
def total_length_udf(items):
    return None if items is None else sum(len(item) for item in items)


@F.udf(ArrayType(StringType()))
def upper_all_udf(items):
    return None if items is None else [item.upper() for item in items]


def containing_udf(text: str):
    return F.udf(lambda items: None if items is None else [i for i in items if text in i], ArrayType(StringType()))


def any_longer_udf(length: int):
    return F.udf(lambda items: None if items is None else any(len(i) > length for i in items), BooleanType())


def tag_partitions(df: DataFrame, name: str = "partition_id") -> DataFrame:
    """UDF7: a per-partition function that knows its partition's index."""

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        index = TaskContext.get().partitionId()
        for batch in batches:
            yield batch.assign(**{name: index})

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(tag, f"{ddl}, `{name}` int")


def count_rows_by_side_effect(df: DataFrame, predicate) -> int:
    """UDF8: ``foreachPartition`` adding to an accumulator.

    Retried tasks can add twice, so this is a progress counter, never a result.
    """
    counter = df.sparkSession.sparkContext.accumulator(0)
    df.foreachPartition(lambda rows: counter.add(sum(1 for row in rows if predicate(row))))
    return counter.value
