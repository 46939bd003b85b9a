"""Claims, policies, labels and versions as views over the driver tables.

Each view is a list of SQL expressions that Spark and DuckDB read alike, so the query and its twin start from the same rows.
Some expressions put in nulls, negative amounts, orphans and bad codes, so that every rule has rows to reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLAIMS = [
    "CASE WHEN o_orderkey % 97 = 3 THEN NULL ELSE o_orderkey END AS claim_id",
    "CASE WHEN o_orderkey % 89 = 5 THEN NULL ELSE o_custkey END AS policy_id",
    "CASE WHEN o_orderkey % 83 = 7 THEN NULL ELSE o_orderdate END AS timestamp",
    "CASE WHEN o_orderkey % 31 = 4 THEN -o_totalprice ELSE o_totalprice END AS claimed_amount_eur",
    "CAST(o_orderkey % 61 AS INT) - 1 AS days_to_report",
    "CAST(o_custkey % 5 AS INT) AS n_parties_involved",
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'phone' WHEN '2-HIGH' THEN 'agent' WHEN '3-MEDIUM' THEN 'online' WHEN '5-LOW' THEN 'app_selfservice' ELSE 'web' END AS claim_channel",
    "CASE o_orderstatus WHEN 'F' THEN 'none' WHEN 'P' THEN 'minor' ELSE 'severe' END AS injury_level",
    "CASE WHEN o_orderkey % 79 = 8 THEN NULL WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS telematics_anomaly",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'charging_station' ELSE 'highway' END AS accident_location_type",
    "o_custkey % 200 AS body_shop_id",
    "o_orderkey AS source_key",
]
POLICIES = [
    "CASE WHEN c_custkey % 211 = 9 THEN NULL ELSE c_custkey END AS policy_id",
    "16 + CAST(c_custkey % 87 AS INT) AS policyholder_age",
    "c_acctbal AS annual_premium_eur",
    "1978 + CAST(c_custkey % 47 AS INT) AS vehicle_year",
    "c_acctbal * 20 AS vehicle_value_eur",
    "CAST(c_custkey % 1000 AS INT) * 30 - 60 AS annual_mileage_km",
    "CAST(c_custkey % 23 AS INT) - 1 AS bonus_malus_years",
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'urban' WHEN 'MACHINERY' THEN 'suburban' WHEN 'HOUSEHOLD' THEN 'rural' WHEN 'FURNITURE' THEN 'urban' ELSE 'offshore' END AS region_type",
    "CAST(c_custkey % 2 AS INT) AS has_telematics",
    "CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_electric",
]
LABELS = ["l_orderkey AS claim_id", "max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS is_fraud", "max(l_shipdate) AS label_available_date"]
VERSIONS = ["user_id AS policy_id", "ts AS policy_updated_at", "event_id AS version_id", "value AS premium"]
EVENTS = ["event_id", "user_id AS policy_id", "ts AS timestamp", "value AS amount"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*CLAIMS)


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*POLICIES)


def started_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policies with a start date: the customer's first order."""
    starts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg({"o_orderdate": "min"}).toDF("o_custkey", "first")
    return policies(spark, sf_dir).join(starts.selectExpr("o_custkey AS policy_id", "CAST(first AS DATE) AS policy_start_date"), "policy_id", "left")


def labels(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Labels by claim; ``more`` adds aggregates of the same lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("claim_id"))
    return lines.agg(F.max(F.expr("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END")).alias("is_fraud"), F.max("l_shipdate").alias("label_available_date"), *more)


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'signup'").selectExpr(*VERSIONS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").selectExpr(*EVENTS)


SQL = {
    "claims": f"SELECT {', '.join(CLAIMS)} FROM orders",
    "policies": f"SELECT {', '.join(POLICIES)} FROM customer",
    "claim_labels": f"SELECT {', '.join(LABELS)} FROM lineitem GROUP BY l_orderkey",
    "versions": f"SELECT {', '.join(VERSIONS)} FROM events WHERE event_type = 'signup'",
    "purchases": f"SELECT {', '.join(EVENTS)} FROM events WHERE event_type = 'purchase'",
    "started": "SELECT p.*, f.policy_start_date FROM policies p LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS policy_start_date FROM orders GROUP BY o_custkey) f ON p.policy_id = f.o_custkey",
}


def with_views(body: str, *names: str) -> str:
    """DuckDB SQL with the named views in front."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" + body
