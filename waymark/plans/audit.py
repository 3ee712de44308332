"""Audits: what must hold of services, results and experiments, as tables of what doesn't."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.numbers import is_close
from waymark.operators.relational import paired
from waymark.plans.access import opportunity, share
from waymark.plans.spec import AccessRequest


def eligibility_counts(gated: DataFrame) -> DataFrame:
    """Per service type and reason of the gate: services, and their share of the type's."""
    per = gated.groupBy("service_type", "eligibility").agg(F.count("*").alias("services"))
    whole = gated.groupBy("service_type").agg(F.count("*").alias("of_type"))
    return per.join(whole, "service_type").select("service_type", "eligibility", "services", share(F.col("services"), F.col("of_type")).alias("share"))


def geography_counts(gated: DataFrame) -> DataFrame:
    """Per service type: how many lie inside the footprint, outside, or without evidence, and how many are routable."""
    one = lambda c: F.count(F.when(c, 1))
    inside = F.col("inside_footprint")
    return gated.groupBy("service_type").agg(
        F.count("*").alias("total"), one(inside).alias("inside"), one(~inside).alias("outside"), one(inside.isNull()).alias("missing"), one(F.col("eligibility") == "eligible").alias("routable")
    )


def scenario_metrics(result: DataFrame, request: AccessRequest) -> DataFrame:
    """One row: origins and people reached, their mean and weighted mean minutes, and opportunities per threshold."""
    people, minutes = F.coalesce(F.col("target_population"), F.lit(0.0)), F.col("nearest_service_time_min")
    reached = F.sum(F.when(minutes.isNotNull(), people).otherwise(0.0))
    counts = [F.col(opportunity(t)) for t in request.thresholds]
    totals = [F.sum(c).alias(f"opportunities_within_{t}_min") for c, t in zip(counts, request.thresholds, strict=True)]
    weighted = [share(F.sum(c * people), F.sum(people)).alias(f"mean_opportunities_within_{t}_min") for c, t in zip(counts, request.thresholds, strict=True)]
    return result.agg(F.count(minutes).alias("origins_reached"), reached.alias("population_reached"), F.avg(minutes).alias("mean_min"), share(F.sum(minutes * people), reached).alias("weighted_mean_min"), *totals, *weighted)


def long_deltas(before: DataFrame, after: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Both sides of a comparison, one row per key and metric: before, after, delta and change in percent."""
    both = paired(before, after, keys, metrics)
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"before_{m}").cast("double").alias("before"), F.col(f"after_{m}").cast("double").alias("after")) for m in metrics])).alias("row")
    delta = F.col("after") - F.col("before")
    return both.select(*keys, rows).select(*keys, "row.*").withColumns({"delta": delta, "change_percent": F.when(F.col("before") != 0, delta / F.col("before") * 100)})


def unreconciled(one: DataFrame, two: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    """Keys and values in which two experiments that should agree don't: a side is missing, or a value is off."""
    both = paired(one, two, keys, values)
    off: list[Column] = []
    for v in values:
        a, b = F.col(f"before_{v}"), F.col(f"after_{v}")
        differs = F.when(a.isNull() | b.isNull(), ~a.eqNullSafe(b)).otherwise(~is_close(a, b, tolerance, tolerance))
        off.append(F.when(differs, F.lit(v)))
    told = both.withColumn("wrong", F.when(F.col("side") != "both", F.array(F.concat(F.lit("only_"), "side"))).otherwise(F.array_compact(F.array(*off))))
    return told.select(*keys, F.explode("wrong").alias("wrong"))


def rising_times(sensitivity: DataFrame) -> DataFrame:
    """Origins that take longer, or reach fewer, at a higher speed: none, if the routes are right."""
    fewer = [c for c in sensitivity.columns if c.startswith("opportunity_count")]
    by_speed = F.array_sort(F.collect_list(F.struct("speed_mps", "nearest_service_time_min", *fewer)))
    steps = F.zip_with(F.slice(F.col("s"), 1, F.size("s") - 1), F.slice(F.col("s"), 2, F.size("s") - 1), lambda a, b: step(a, b, fewer))
    return sensitivity.groupBy("origin_id").agg(by_speed.alias("s")).where(F.exists(F.when(F.size("s") > 1, steps), lambda x: x)).select("origin_id")


def step(slow: Column, fast: Column, counts: Sequence[str]) -> Column:
    longer = F.coalesce(fast["nearest_service_time_min"] > slow["nearest_service_time_min"] + 1e-9, F.lit(False))
    wrong = longer | (slow["nearest_service_time_min"].isNotNull() & fast["nearest_service_time_min"].isNull())
    for c in counts:
        wrong = wrong | F.coalesce(fast[c] < slow[c], F.lit(False))
    return wrong
