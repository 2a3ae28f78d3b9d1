"""Values of a keyed table on the features of a layer, and the check of their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.operators import attributes as T


def key_number(c: Column) -> Column:
    """A key as a number, so that leading zeros don't matter; what is no number is an error."""
    return F.trim(c.cast("string")).cast("long")


def value_table(table: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, values) as numbers; rows without a number for a key or any value go, repeated keys are an error."""
    number = lambda c: F.col(c).cast("string").try_cast("double")
    rows = table.select(F.col(key).cast("string").try_cast("double").cast("long").alias(key), *[number(c).alias(c) for c in values]).dropna()
    twice = [r[0] for r in rows.groupBy(key).count().filter("count > 1").orderBy(key).limit(10).collect()]
    if twice:
        raise ValueError(f"repeated keys {twice}")
    return rows


def valued(features: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Features with the values of their key; those without go, and the table's values win over fields of the same name."""
    T.require(features, [key])
    kept = [c for c in features.columns if c == key or c not in table.columns]
    return features.select(*kept).withColumn(key, key_number(F.col(key))).join(table, key)


def total(rows: DataFrame, value: str, area: str) -> DataFrame:
    """(total): the sum of value times area."""
    return rows.agg(F.coalesce(F.sum(F.col(value) * F.col(area)), F.lit(0.0)).alias("total"))
