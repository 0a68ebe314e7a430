"""Row rules of the result tables, checked before a write because Parquet tables do not enforce them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: user ids hold at most 20 characters.
USER_ID_LENGTH = 20


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule(f"{column} is null", F.col(column).isNull())


def max_length(column: str, length: int) -> Rule:
    return Rule(f"{column} longer than {length}", F.char_length(column) > length)


def user_rules() -> list[Rule]:
    return [not_null("user_id"), max_length("user_id", USER_ID_LENGTH)]


def daily_rules() -> list[Rule]:
    return [*user_rules(), not_null("event_date"), not_null("upload_date")]


def broken_rule(rules: list[Rule]) -> Column:
    """Name of the first rule the row breaks, NULL for a good row."""
    return F.coalesce(*[F.when(rule.broken, F.lit(rule.name)) for rule in rules])
