"""The whole route: landing files to bronze tables, bronze to silver with quarantine, and checks of what is stored.

Zones are folders below one base path: ``landing`` (events as JSON in ``YYYY/MM`` folders, policies as CSV), ``bronze`` and
``silver``. Every step can be repeated: streams continue from their checkpoints, batch tables are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larkspur import schemas
from larkspur.functions.features import calendar_features, label_delay
from larkspur.functions.projections import cast_columns, drop_clashing, with_audit
from larkspur.operators import integrity
from larkspur.operators.enrichment import with_buffer
from larkspur.operators.history import enrich_as_of, update_history
from larkspur.operators.quality import dead_letter_columns, quarantine_union
from larkspur.operators.reports import partition_counts, table_counts, trainable_count
from larkspur.operators.rules import Rule, load_rules
from larkspur.operators.split import CLEAN, REJECTED, Split, split_write, stored_split, written_split
from larkspur.sources import readers, writers
from larkspur.streaming.streams import run_streams, stream_bronze


@dataclass(frozen=True)
class Zones:
    """Folders of one installation; ``fmt`` is the table format of bronze, ``buckets`` the folders of the policy history."""

    base: str
    fmt: str = "parquet"
    buckets: int = 64

    def at(self, zone: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{zone}/{table}"


#: Streamed tables: schema and partition columns. The buffer holds claims that arrive ahead of time or late.
STREAMED = {"claims": (schemas.CLAIMS, ["year", "month"]), "labels": (schemas.LABELS, ["year", "month"]), "claims_buffer": (schemas.CLAIMS, None)}


def ingest_policies(spark: SparkSession, zones: Zones) -> None:
    """Policies as text from CSV, with audit columns; the table is replaced."""
    text = readers.read_csv(spark, zones.at("landing", "policies"))
    writers.write_table(with_audit(text), zones.at("bronze", "policies"), zones.fmt)


def ingest_streams(spark: SparkSession, zones: Zones, tables: tuple[str, ...] = tuple(STREAMED), max_files: int = 1, timeout: int | None = None) -> None:
    """New landing files of all streamed tables, each with its own checkpoint, until they are worked off; TimeoutError if a given time is up before."""
    running = []
    for name in tables:
        schema, partitions = STREAMED[name]
        target = zones.at("bronze", name)
        running.append(stream_bronze(spark, zones.at("landing", name), schema, target, zones.at("bronze", f"_progress/{name}"), partitions, max_files))
    run_streams(running, timeout)


def _bronze(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """A bronze table with year and month as text; empty, with its columns, if nothing was ingested yet."""
    audit = [T.StructField(c, T.TimestampType() if c == "ingestion_timestamp" else T.StringType()) for c in schemas.AUDIT_COLUMNS]
    if name in STREAMED:
        schema, typed = T.StructType([*STREAMED[name][0].fields, *audit]), True
    else:  # a CSV's own columns; without a file those of the policies
        schema, typed = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schemas.POLICIES), *audit[:2]]), False
    found = readers.read_if_there(spark, zones.at("bronze", name), schema if typed else None, zones.fmt)
    return spark.createDataFrame([], schema) if found is None else found


def read_silver(spark: SparkSession, zones: Zones, name: str) -> DataFrame:
    """The clean rows of a silver table, or the quarantine, the rule metrics or the policy history."""
    if name in ("quarantine", "rule_metrics", "policy_history"):
        return readers.read_table(spark, zones.at("silver", name))
    return stored_split(spark, zones.at("silver", name)).clean


_PARENT = "_parent"
#: Tables whose rows must differ in some columns.
ONCE = {"labels": Rule("label_repeated", "claim_id, label_available_date", tag="labels"), "policies": Rule("policy_version_repeated", "policy_id, policy_updated_at", tag="policies")}


def latest_label(labels: DataFrame, key: str = "claim_id", available: str = "label_available_date") -> DataFrame:
    """The label of each claim that became available last; labels are revised, so an earlier one no longer holds."""
    rest = [c for c in labels.columns if c not in (key, available)]
    newest = labels.groupBy(key).agg(F.max(F.struct(available, *rest)).alias("_row"))
    return newest.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in (available, *rest)])


def enrich_claims(claims: DataFrame, labels: DataFrame, history: DataFrame, policies: DataFrame) -> tuple[DataFrame, list[str]]:
    """Claims with the policy version of their time, calendar features and the latest label, and the names of these columns; ``_parent`` is null for a
    claim whose policy is not in ``policies``.

    Labels are joined while claims are narrow, and parents are looked up in the history and not once more for the wide rows.
    """
    known = policies.select(F.col("policy_id").alias(_PARENT)).distinct()
    marked = history.join(known, F.col("policy_id") == F.col(_PARENT), "left")

    def wide(rows: DataFrame, versions: DataFrame) -> DataFrame:
        timed = enrich_as_of(rows, versions, "policy_id", "timestamp", backfill=True).withColumnRenamed("valid_from", "policy_valid_from").withColumnRenamed("valid_to", "policy_valid_to")
        return calendar_features(timed)

    plain = wide(claims, history)  # for its names only
    label = drop_clashing(latest_label(labels), plain, ["claim_id"], "label_", tuple(schemas.AUDIT_COLUMNS))
    held = {c: f"_label_{i}" for i, c in enumerate(label.columns) if c != "claim_id"}
    early = claims.join(label.withColumnsRenamed(held), "claim_id", "left")
    rows = wide(early, marked)
    added = [F.col(f"`{old}`").alias(c) for c, old in held.items()]
    rows = rows.select("claim_id", *[F.col(f"`{c}`") for c in plain.columns if c != "claim_id"], *added, _PARENT)
    rows = rows.withColumn("label_delay_days", label_delay("label_available_date", "timestamp"))
    return rows, [c for c in rows.columns if c != _PARENT]


def build_silver(spark: SparkSession, zones: Zones, rules: dict[str, list[Rule]] | None = None) -> None:
    """Typed, checked and enriched tables (claims, labels, policies, claims_enriched), policy_history, quarantine and rule_metrics.

    Each bronze table is scanned once: clean rows, dead letters and the counts of all rules come from one write. Claims get the policy
    version that was valid at their time (before a policy's first version: that one, marked ``is_backfilled``) and the latest label. Rows in =
    clean rows + dead letters; claims = enriched claims + orphans; repeated label rows and policy versions are dead letters. A policy without a
    version time counts as known since 1970.
    """
    rules = rules or {name: load_rules(name) for name in ("claims", "labels", "policies")}
    raw = {"claims": with_buffer(_bronze(spark, zones, "claims"), _bronze(spark, zones, "claims_buffer")), "labels": _bronze(spark, zones, "labels"), "policies": _bronze(spark, zones, "policies")}
    typed = {name: cast_columns(df, schemas.TYPED[name]) for name, df in raw.items()}
    typed["policies"] = typed["policies"].withColumn("policy_updated_at", F.coalesce("policy_updated_at", F.lit("1970-01-01").cast("timestamp")))
    split = {name: split_write(df, rules[name], zones.at("silver", name), once=ONCE.get(name)) for name, df in typed.items()}
    claims, labels, policies = (split[name].clean for name in ("claims", "labels", "policies"))
    versions = drop_clashing(policies, claims, ["policy_id"], "policy_", tuple(schemas.AUDIT_COLUMNS))
    history = update_history(spark, zones.at("silver", "policy_history"), versions, "policy_id", "policy_updated_at", zones.buckets)
    with_parent, columns = enrich_claims(claims, labels, history, policies)
    outcome = F.when(F.col(_PARENT).isNull(), REJECTED).otherwise(CLEAN)
    letter = F.struct(*dead_letter_columns(F.lit("policy_fk_missing"), [Rule("policy_fk_missing", "policy_id has a parent", tag="claims_enriched")], claims.columns))
    target = zones.at("silver", "claims_enriched")
    joined = Split(spark, target, written_split(with_parent, outcome, letter, columns, target))
    writers.write_table(quarantine_union(*(s.quarantine for s in split.values()), joined.quarantine), zones.at("silver", "quarantine"))
    counted = [s.metrics.select(F.lit(name).alias("table_name"), "*") for name, s in split.items()]
    writers.write_table(quarantine_union(*counted), zones.at("silver", "rule_metrics"))


def bronze_checks(spark: SparkSession, zones: Zones) -> dict[str, DataFrame]:
    """What to look at after ingestion: counts, partitions, audit values and trainable claims, as frames."""
    claims, labels = _bronze(spark, zones, "claims"), _bronze(spark, zones, "labels")
    tables = {"claims": claims, "labels": labels, "claims_buffer": _bronze(spark, zones, "claims_buffer"), "policies": _bronze(spark, zones, "policies")}
    return {
        "counts": table_counts(tables),
        "partitions": partition_counts(claims, ["year", "month"]),
        "audit": claims.groupBy("source_file").agg(F.count("*").alias("n"), F.min("ingestion_timestamp").alias("first"), F.max("ingestion_timestamp").alias("last")),
        "trainable": trainable_count(claims, labels),
    }
