"""Explicit schemas of the landing tables; every field is nullable, as landing data is not trusted."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType()}


def _struct(fields: str) -> T.StructType:
    pairs = (x.split(":") for x in fields.split())
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


#: Column names and types as they land.
CLAIMS = _struct(
    "claim_id:string policy_id:string timestamp:string accident_type:string accident_location_type:string days_to_report:int "
    "n_parties_involved:int witnesses:string injury_level:string police_report_filed:int outside_business_hours:int "
    "claimed_amount_eur:double body_shop_id:string has_third_party_injury:int third_party_same_insurer:int telematics_anomaly:int claim_channel:string"
)
LABELS = _struct("claim_id:string is_fraud:int label_available_date:string")
POLICIES = _struct(
    "policy_id:string policy_updated_at:timestamp policyholder_age:int gender:string region:string region_type:string occupation:string "
    "policy_start_date:date coverage_type:string payment_frequency:string annual_premium_eur:double bonus_malus_years:int has_telematics:int "
    "multi_policy:int vehicle_make:string vehicle_type:string vehicle_year:int vehicle_value_eur:double annual_mileage_km:int is_electric:int"
)
#: Columns to cast after a landing table was read as text.
TYPED = {
    "claims": {"timestamp": "timestamp"},
    "labels": {"label_available_date": "timestamp"},
    "policies": {f.name: f.dataType.simpleString() for f in POLICIES if f.dataType != T.StringType()},
}
AUDIT_COLUMNS = ["source_file", "ingestion_timestamp", "year", "month"]
QUARANTINE = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ("record_json", "error_rule", "error_severity", "error_constraint", "error_source_table")]
    + [T.StructField("error_timestamp", T.TimestampType(), True)]
)
