"""Checks of row rules and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.functions.rules import Rule, broken_rule


def tag_rows(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    return rows.withColumn("broken_rule", broken_rule(rules))


def split_rows(rows: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects with the rule they break. Stage ``tag_rows`` instead if both are needed at scale."""
    tagged = tag_rows(rows, rules)
    good = tagged.where(F.col("broken_rule").isNull()).drop("broken_rule")
    return good, tagged.where(F.col("broken_rule").isNotNull())


def constraint_violations(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows per broken rule."""
    return (
        tag_rows(rows, rules)
        .where(F.col("broken_rule").isNotNull())
        .groupBy(F.col("broken_rule").alias("rule"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
