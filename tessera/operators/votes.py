"""Votes of several annotators about one item.

A claim is a row with the item's key, the annotator's place in order, and a
value. Ties go to the value that was claimed first, never to an engine's own
order. All operators group by the item's key, so one exchange serves them all,
and aggregate before they rank.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tally(claims: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys, value, n (claims of the value) and first (the place of the first)."""
    return claims.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))


def majority(claims: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """keys, value (the modal one, of equals the first claimed), votes, total and ratio."""
    best = F.max_by(F.col(value), F.struct("n", -F.col("first")))
    return tally(claims, keys, value, order).groupBy(*keys).agg(best.alias(value), F.max("n").alias("votes"),
        F.sum("n").alias("total")).withColumn("ratio", F.round(F.col("votes") / F.col("total"), 4))


def first_modal(values: Column) -> Column:
    """The modal element of a short ordered array, of equals the first; null for none."""
    distinct = F.array_distinct(values)
    counted = F.transform(distinct,
        lambda v: F.struct(F.size(F.filter(values, lambda w: w == v)).alias("n"), (-F.array_position(values, v)).alias("first"),
            v.alias("v")))
    return F.array_max(counted).v


def ordered_distinct(claims: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Distinct values of each item in order of first claim: keys, position from 1, value."""
    place = Window.partitionBy(*keys).orderBy("first")
    return claims.groupBy(*keys, value).agg(F.min(order).alias("first")).select(*keys, F.row_number().over(place).alias("position"), value)


def pairs(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Every pair of an item's rows, the earlier one as l_*, the later as r_*."""
    side = lambda s: rows.select(*keys, F.col(order).alias(f"{s}_{order}"), *[F.col(c).alias(f"{s}_{c}") for c in columns])
    return side("l").join(side("r"), keys).filter(F.col(f"l_{order}") < F.col(f"r_{order}"))


def pairwise_mean(rows: DataFrame, keys: list[str], order: str,
    scores: dict[str, Callable[[Callable[[str], Column], Callable[[str], Column]], Column]], columns: list[str], single: float = 0.5,
    digits: int | None = 4) -> DataFrame:
    """Mean of each score over an item's pairs, rounded to some digits or not; an item with one row gets `single`.

    A score takes two functions from a column's name to the left and right column.
    """
    scored = pairs(rows, keys, order, columns).select(*keys, *[f(lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}")).alias(n) for n, f in scores.items()])
    means = scored.groupBy(*keys).agg(*[F.avg(n).alias(n) for n in scores])
    items = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    shown = lambda c: c if digits is None else F.round(c, digits)
    return items.join(means, keys, "left").select(*keys, "n_rows", *[shown(F.coalesce(n, F.lit(single))).alias(n) for n in scores])


def range_similarity(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """How close the smallest value comes to the largest; one value alone counts half."""
    stats = rows.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    score = F.when(F.col("n") == 0, 0.0).when(F.col("n") == 1, 0.5).when(F.col("hi") == 0,
        F.when(F.col("lo") == 0, 1.0).otherwise(0.0)).otherwise(1 - (F.col("hi") - F.col("lo")) / F.col("hi"))
    return stats.select(*keys, "n", F.round(score, 4).alias("similarity"))


def histogram(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    return rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def support_needed(models: Column) -> Column:
    """Annotators that make a majority: all of up to two, else two thirds, rounded up."""
    return F.when(models <= 2, models).otherwise(F.floor((2 * models + 2) / 3)).cast("int")
