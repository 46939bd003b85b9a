"""Session settings the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Times are UTC; joins and partitions are planned anew at run time; ``01`` in a partition path stays text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def session(app: str = "larkspur", **more: str) -> SparkSession:
    """The running session or a new one, with these settings; ``more`` adds others, with ``__`` for a dot in a name."""
    settings = SETTINGS | {k.replace("__", "."): v for k, v in more.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
