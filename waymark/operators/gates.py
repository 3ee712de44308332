"""Ordered decisions: the first reason that holds wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from waymark.operators.relational import ContractError


def first_reason(*cases: tuple[Column, str], otherwise: str | None = None) -> Column:
    out = F.lit(otherwise)
    for condition, reason in reversed(cases):
        out = F.when(condition, reason).otherwise(out)
    return out


def require_booleans(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that reads like a boolean is none."""
    if wrong := [c for c in columns if c in df.columns and not isinstance(df.schema[c].dataType, BooleanType)]:
        raise ContractError(f"{', '.join(wrong)} must be boolean")
    return df


def routing_gate(services: DataFrame) -> DataFrame:
    """Services with `eligibility` and, where they aren't eligible, without the node they would be reached at.

    Columns: validated, active, snapped, node_id, snap_distance_m, and boundary_verified and inside_footprint if there
    is boundary evidence.  Without the validation column nothing is eligible.  The original node stays as attachment_*.
    """
    require_booleans(services, ("validated", "active", "snapped", "boundary_verified", "inside_footprint"))
    if "validated" not in services.columns:
        services = services.withColumn("validated", F.lit(None).cast("boolean"))
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    cases = [(F.col("validated").isNull(), "missing_validation_evidence"), (no("validated"), "location_not_validated")]
    if "boundary_verified" in services.columns:
        cases += [(no("boundary_verified"), "boundary_not_verified"), (no("inside_footprint"), "outside_operational_footprint")]
    cases += [(no("active"), "service_not_active"), (no("snapped") | F.col("node_id").isNull(), "not_snapped")]
    gated = services.withColumn("eligibility", first_reason(*cases, otherwise="eligible"))
    eligible = F.col("eligibility") == "eligible"
    return gated.withColumns(
        {
            "attachment_node_id": F.col("node_id"),
            "attachment_snap_distance_m": F.col("snap_distance_m"),
            "node_id": F.when(eligible, F.col("node_id")),
            "snap_distance_m": F.when(eligible, F.col("snap_distance_m")),
        }
    )


def reachability(time: Column, origin_node: Column, services: Column, routable: Column) -> Column:
    return first_reason(
        (time.isNotNull(), "reachable"), (origin_node.isNull(), "origin_not_snapped"), (services == 0, "service_unavailable"), (routable == 0, "service_not_snapped"), otherwise="no_path"
    )
