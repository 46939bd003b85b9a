"""Landing files to silver tables, with the odd rows every suite needs."""

import json

import pytest

from larkspur.plans.medallion import Zones, bronze_checks, build_silver, ingest_policies, ingest_streams, read_silver


def claim(i, policy="P1", **changes):
    row = {"claim_id": f"C{i}", "policy_id": policy, "timestamp": "2024-03-05T10:00:00Z", "accident_type": "theft", "days_to_report": 1, "n_parties_involved": 2, "injury_level": "none", "claimed_amount_eur": 100.0, "body_shop_id": "S1", "telematics_anomaly": 0, "claim_channel": "phone"}
    return row | changes


CLAIMS = [
    claim(1), claim(2, claim_channel="online"), claim(3, claimed_amount_eur=-5.0), claim(4, claimed_amount_eur=None), claim(5, timestamp="soon"),
    claim(6, policy="P9"), claim(10, timestamp="2024-01-15T00:00:00Z"), claim(11, timestamp="2023-01-15T00:00:00Z"), claim(7, policy="P2"), claim(8, policy=None), claim(9, injury_level="severe", n_parties_involved=1),
]
LABELS = [
    {"claim_id": "C1", "is_fraud": 1, "label_available_date": "2024-04-04T09:00:00Z"}, {"claim_id": "C1", "is_fraud": 0, "label_available_date": "2024-05-04T09:00:00Z"},
    {"claim_id": "C1", "is_fraud": 1, "label_available_date": "2024-04-04T09:00:00Z"},
    {"claim_id": "C2", "is_fraud": 7, "label_available_date": "2024-04-04T09:00:00Z"}, {"claim_id": "C9", "is_fraud": 0, "label_available_date": "never"},
]
POLICIES = """policy_id,policy_updated_at,policyholder_age,region_type,policy_start_date,annual_premium_eur,bonus_malus_years,vehicle_year,vehicle_value_eur,annual_mileage_km
P1,2024-01-01T00:00:00Z,40,urban,2020-01-01,500.0,1,2015,18000.0,12000
P1,2024-02-01T00:00:00Z,41,rural,2020-01-01,500.0,1,2015,18000.0,12000
P1,2024-02-01T00:00:00Z,41,rural,2020-01-01,500.0,1,2015,18000.0,12000
P2,2024-01-01T00:00:00Z,17,urban,2020-01-01,500.0,1,2015,18000.0,12000
"""


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("zones")
    z = Zones(str(base))
    for name, rows in (("claims", CLAIMS), ("labels", LABELS), ("claims_buffer", [claim(20, timestamp="2025-01-02T00:00:00Z")])):
        folder = base / "landing" / name / "2024" / "03"
        folder.mkdir(parents=True)
        (folder / "data.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    (base / "landing" / "policies").mkdir()
    (base / "landing" / "policies" / "p.csv").write_text(POLICIES)
    ingest_policies(spark, z)
    ingest_streams(spark, z)
    ingest_streams(spark, z)  # nothing new
    build_silver(spark, z)
    return z


def silver(spark, zones, name):
    return read_silver(spark, zones, name)


def test_bronze(spark, zones):
    checks = bronze_checks(spark, zones)
    assert {r.table_name: r.n for r in checks["counts"].collect()} == {"claims": 11, "labels": 5, "claims_buffer": 1, "policies": 4}
    assert [(r.year, r.month, r.n) for r in checks["partitions"].collect()] == [("2024", "03", 11)]
    assert checks["trainable"].first().n_trainable == 5
    assert all(r.source_file.endswith("data.json") for r in checks["audit"].collect())


def test_clean_tables(spark, zones):
    assert sorted(r.claim_id for r in silver(spark, zones, "claims").collect()) == ["C1", "C10", "C11", "C2", "C20", "C6", "C7", "C9"]
    flags = {r.claim_id: (r.warn_valid_claim_channel, r.warn_injury_requires_multiple_parties) for r in silver(spark, zones, "claims").collect()}
    assert flags["C1"] == (False, False) and flags["C2"] == (True, False) and flags["C9"] == (False, True)
    assert silver(spark, zones, "labels").count() == 2 and silver(spark, zones, "policies").count() == 2


def test_enriched_has_one_row_a_claim(spark, zones):
    rows = {r.claim_id: r for r in silver(spark, zones, "claims_enriched").collect()}
    assert sorted(rows) == ["C1", "C10", "C11", "C2", "C20", "C9"]
    assert rows["C1"].label_delay_days == 60 and rows["C1"].is_fraud == 0 and rows["C1"].event_month == 3
    seen = {k: (r.policyholder_age, r.region_type, r.is_backfilled) for k, r in rows.items()}
    assert seen["C1"] == seen["C20"] == (41, "rural", False) and seen["C10"] == (40, "urban", False) and seen["C11"] == (40, "urban", True)
    assert rows["C2"].is_fraud is None
    assert len(set(silver(spark, zones, "claims_enriched").columns)) == len(silver(spark, zones, "claims_enriched").columns)


def test_every_rejected_record_is_in_quarantine(spark, zones):
    found = sorted((r.error_source_table, r.error_rule) for r in silver(spark, zones, "quarantine").collect())
    assert found == sorted(
        [("claims", "claimed_amount_positive")] * 2 + [("claims", "timestamp_not_null"), ("claims", "policy_id_not_null"), ("labels", "label_is_fraud_binary"), ("labels", "label_available_date_not_null"), ("policies", "policyholder_age_valid")] + [("claims_enriched", "policy_fk_missing")] * 2
        + [("labels", "label_repeated"), ("policies", "policy_version_repeated")]
    )


def test_history_and_metrics(spark, zones):
    history = {(r.policy_id, r.policyholder_age): (str(r.valid_from)[:10], r.valid_to and str(r.valid_to)[:10]) for r in silver(spark, zones, "policy_history").collect()}
    assert history == {("P1", 40): ("2024-01-01", "2024-02-01"), ("P1", 41): ("2024-02-01", None)}
    counted = {(r.table_name, r.rule): (r.n_pass, r.n_fail, r.n_null) for r in silver(spark, zones, "rule_metrics").collect()}
    assert counted["claims", "claimed_amount_positive"] == (10, 1, 1) and counted["labels", "label_is_fraud_binary"] == (4, 1, 0)


def test_running_again_changes_nothing(spark, zones):
    before = {n: silver(spark, zones, n).count() for n in ("claims", "claims_enriched", "quarantine", "policy_history")}
    build_silver(spark, zones)
    assert before == {n: silver(spark, zones, n).count() for n in before}


def test_nothing_ingested_yet(spark, tmp_path):
    z = Zones(str(tmp_path))
    build_silver(spark, z)
    assert silver(spark, z, "claims_enriched").count() == 0 and silver(spark, z, "quarantine").count() == 0
    assert {r.n for r in bronze_checks(spark, z)["counts"].collect()} == {0}


def test_contract(spark):
    from larkspur.operators.enrichment import apply_reference_tables
    from larkspur.operators.rules import contract_rules, load_contract

    contract = load_contract(current_year=2024)
    assert "vehicle_year BETWEEN 1980 AND 2024" in {r.constraint for r in contract_rules(contract, "policies")}
    df = spark.createDataFrame([("a",), ("b",)], "body_shop_id string")
    flagged = apply_reference_tables(df, {"high_risk_bodyshops": df.where("body_shop_id = 'a'")}, contract["reference_tables"])
    assert sorted((r.body_shop_id, r.is_high_risk_body_shop) for r in flagged.collect()) == [("a", 1), ("b", 0)]


def test_parents_are_looked_up_before_claims_are_wide(spark, zones):
    from larkspur.plans.medallion import enrich_claims

    claims, labels, policies = (silver(spark, zones, n) for n in ("claims", "labels", "policies"))
    rows, columns = enrich_claims(claims, labels, silver(spark, zones, "policy_history"), policies)
    assert columns == silver(spark, zones, "claims_enriched").columns
    assert sorted(r.claim_id for r in rows.where("_parent is null").collect()) == ["C6", "C7"]
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert "_s#" in joins[0] and "_parent" not in joins[0]  # the last join of the rows is that with their versions


def test_first_version_holds_before_year_one(spark):
    from larkspur.operators.history import build_history, enrich_as_of

    versions = spark.sql("SELECT 1 AS k, timestamp'2024-01-01' AS t, 7 AS v")
    events = spark.sql("SELECT 1 AS k, timestamp'0000-06-01' AS at UNION ALL SELECT 1, NULL")
    found = enrich_as_of(events, build_history(versions, "k", "t").drop("t"), "k", "at", backfill=True)
    assert [(r.v, r.is_backfilled) for r in found.select("v", "is_backfilled").collect()] == [(7, True)] * 2
