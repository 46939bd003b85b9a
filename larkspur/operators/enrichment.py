"""Joins that add columns to claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.features import label_delay
from larkspur.functions.projections import drop_clashing
from larkspur.schemas import AUDIT_COLUMNS


def enrich(claims: DataFrame, policies: DataFrame, key: str = "policy_id") -> DataFrame:
    """Claims with policy columns (left join). The policies' audit columns go; other clashing names get ``policy_``."""
    return claims.join(drop_clashing(policies, claims, [key], "policy_", tuple(AUDIT_COLUMNS)), key, "left")


def attach_labels(claims: DataFrame, labels: DataFrame, key: str = "claim_id", time_col: str = "timestamp", available_col: str = "label_available_date") -> DataFrame:
    """Claims with delayed labels (left join) and label_delay_days."""
    joined = claims.join(drop_clashing(labels, claims, [key], "label_", tuple(AUDIT_COLUMNS)), key, "left")
    return joined.withColumn("label_delay_days", label_delay(available_col, time_col))


def with_buffer(main: DataFrame, buffer: DataFrame) -> DataFrame:
    """A table and the late rows of its buffer zone."""
    return main.unionByName(buffer, allowMissingColumns=True)


def flag_membership(df: DataFrame, members: DataFrame, key: str, flag: str, max_broadcast: int = 100_000) -> DataFrame:
    """1 where ``key`` is listed in ``members``, else 0. A list of at most ``max_broadcast`` keys is broadcast, a longer one is shuffled."""
    listed = members.select(F.col(key).alias("_member")).where("_member is not null").distinct()
    small = listed.limit(max_broadcast + 1).count() <= max_broadcast
    joined = df.join(F.broadcast(listed) if small else listed, df[key] == F.col("_member"), "left")
    return joined.withColumn(flag, F.col("_member").isNotNull().cast("int")).drop("_member")


def apply_reference_tables(df: DataFrame, tables: dict[str, DataFrame], spec: dict[str, dict]) -> DataFrame:
    """Membership flags such as ``{"high_risk_bodyshops": {"join_key": "body_shop_id", "output_flag": "is_high_risk_body_shop"}}``."""
    for name, r in spec.items():
        df = flag_membership(df, tables[name], r["join_key"], r["output_flag"])
    return df
