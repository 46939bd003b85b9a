"""Projections: audit and partition columns, casts, renames, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The last four parts of ``.../2024/07/file`` or ``.../year=2024/month=07/file``; year and month come from the last two folders only.
PARTITION_PATTERN = r"^[^/]*/(?:year=)?(\d{4})/(?:month=)?(\d{2})/[^/]+$"


def source_path(df: DataFrame) -> Column:
    """The file a row was read from; null for rows that come from no file."""
    try:
        path = F.col("_metadata.file_path")
        df.select(path)
    except Exception:  # noqa: BLE001 - frames without file metadata raise different analysis errors
        path = F.nullif(F.input_file_name(), F.lit(""))
    return path


def with_audit(df: DataFrame) -> DataFrame:
    """Adds source_file and ingestion_timestamp."""
    return df.withColumns({"source_file": source_path(df), "ingestion_timestamp": F.current_timestamp()})


def with_path_partitions(df: DataFrame, path_col: str = "source_file") -> DataFrame:
    """Adds year and month (text) from the path; null where the path has none."""
    tail = F.substring_index(path_col, "/", -4)  # a search through long paths would cost more than parsing the rows
    found = {name: F.nullif(F.regexp_extract(tail, PARTITION_PATTERN, i), F.lit("")) for i, name in ((1, "year"), (2, "month"))}
    return df.withColumns(found)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts; a value that cannot be cast becomes null, so a null rule and not the job fails on it."""
    casts = {c: (F.try_to_timestamp(F.col(c).cast("string")) if t == "timestamp" else F.col(c).try_cast(t)) for c, t in types.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Repeated column names get the suffixes ``_dup``, ``_dup2``, ...; the first keeps its name."""
    taken, names = set(df.columns), []
    used: set[str] = set()
    for c in df.columns:
        name, i = c, 0
        while name in used or (i and name in taken):
            i += 1
            name = f"{c}_dup{i if i > 1 else ''}"
        used.add(name)
        names.append(name)
    return df.toDF(*names)


def public_columns(df: DataFrame) -> DataFrame:
    """Without the columns whose name starts with an underscore."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


def sample_rows(df: DataFrame, percent: int, key: str | None = None, seed: int = 42) -> DataFrame:
    """About ``percent`` of 100 rows: by row with a seed, or by key, so that tables sampled by one key still join."""
    if key is None:
        return df.sample(percent / 100, seed)
    digits = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"/{seed}")).cast("binary")), 1, 8), 16, 10)
    return df.where(digits.cast("long") % 100 < percent)


def drop_clashing(right: DataFrame, left: DataFrame, on: list[str], prefix: str, discard: tuple[str, ...] = ()) -> DataFrame:
    """``right`` without the columns to discard and with a prefix where a name is taken by ``left``."""
    right = right.drop(*(c for c in discard if c not in on))
    return right.select([F.col(c) if c in on or c not in left.columns else F.col(c).alias(f"{prefix}{c}") for c in right.columns])
