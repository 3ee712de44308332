"""Joins with contracts, deduplication, ranking, and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table doesn't hold what an operator needs of it."""


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "table") -> DataFrame:
    if missing := sorted(set(columns) - set(df.columns)):
        raise ContractError(f"{name} lacks {', '.join(missing)}")
    return df


def require_none(df: DataFrame, what: str, show: int = 5) -> None:
    """Fails with a few examples if df has rows."""
    if found := df.take(show):
        raise ContractError(f"{what}: {', '.join(str(tuple(r)) for r in found)}")


def require_unique(df: DataFrame, keys: Sequence[str], name: str = "table") -> DataFrame:
    require_none(df.groupBy(*keys).count().where("count > 1"), f"{name} has repeated keys")
    return df


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """A left join with whether the right side had the key."""
    return left.join(right.withColumn(flag, F.lit(True)), list(keys), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def split_matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a partner, joined, and rows without one."""
    return left.join(right, list(keys)), left.join(right, list(keys), "left_anti")


def paired(before: DataFrame, after: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Both sides of a comparison by key, with `side`: both, before or after."""
    one = before.select(*keys, *[F.col(v).alias(f"before_{v}") for v in values], F.lit(1).alias("in_before"))
    two = after.select(*keys, *[F.col(v).alias(f"after_{v}") for v in values], F.lit(1).alias("in_after"))
    side = F.when(F.col("in_after").isNull(), "before").when(F.col("in_before").isNull(), "after").otherwise("both")
    return one.join(two, list(keys), "full").withColumn("side", side).drop("in_before", "in_after")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in a total order."""
    return top(df, keys, order, 1).drop("rank")


def top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows per key, with their rank; the limit lets Spark drop rows before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def best_and_margin(df: DataFrame, keys: Sequence[str], score: str, ties: Sequence[Column]) -> DataFrame:
    """The best row per key, with `margin` over the second best (over 0 if it is alone)."""
    ranked = top(df, keys, [F.col(score).desc(), *ties], 2)
    second = F.max(F.when(F.col("rank") == 2, F.col(score))).over(Window.partitionBy(*keys))
    return ranked.withColumn("margin", F.col(score) - F.coalesce(second, F.lit(0.0))).where("rank = 1").drop("rank")


def equal_shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`share`: one over the number of rows of the key."""
    return df.withColumn("share", F.lit(1.0) / F.count("*").over(Window.partitionBy(*keys)))


def valid_at(df: DataFrame, day: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Rows of a history that hold on a day; an open end holds for good."""
    on = F.lit(day).cast("date")
    return df.where((F.col(start) <= on) & (F.col(end).isNull() | (F.col(end) >= on)))


def upserted(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with the rows of new in place of those with the same key."""
    return old.join(new, list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def stacked(first: DataFrame, *others: DataFrame) -> DataFrame:
    """By name; what a table doesn't have is null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
