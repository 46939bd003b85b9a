"""Anomaly flags, case ranking and a supervised classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.sources.workdir import new_dir


def anomaly_flags(df: DataFrame, value: str, segment: str, limit: float = 3.0) -> DataFrame:
    """Adds z_score (by the segment's mean and sample deviation) and is_anomaly (0/1).

    Moments come from a partial aggregation by segment and are joined back, so a large segment stays spread. A segment without
    spread or with one row has a null score and flag 0.
    """
    moments = df.groupBy(F.col(segment).alias("_seg")).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_dev"))
    joined = df.join(moments, F.col(segment).eqNullSafe(F.col("_seg")), "left")
    z = F.when(F.col("_dev") > 0, (F.col(value) - F.col("_mean")) / F.col("_dev"))
    return joined.withColumn("z_score", z).withColumn("is_anomaly", F.coalesce(F.abs("z_score") > limit, F.lit(False)).cast("int")).drop("_seg", "_mean", "_dev")


def top_cases(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The ``k`` rows of highest score, ties by key; each task keeps k rows."""
    return df.orderBy(F.col(score).desc_nulls_last(), key).limit(k)


def fit_classifier(training: DataFrame, features: list[str], label: str, iterations: int = 20):
    """A logistic regression pipeline (null features as their mean, scaled) fitted by Spark on the whole training set, which is made once and stored: each
    step passes over it.

    Rows without a label are not learned from, and a feature without any value there is left out. Training rows of one class only, or none, are a
    ValueError; so are features that are all without values.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler

    narrow = training.where(F.col(label).isNotNull()).select(*dict.fromkeys([label, *features]))
    path = new_dir(training.sparkSession, "training")
    narrow.write.parquet(path)
    training = training.sparkSession.read.schema(narrow.schema).parquet(path)
    values = [F.count(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"n{i}") for i, c in enumerate(features)]
    seen = training.agg(F.min(label).alias("least"), F.max(label).alias("greatest"), *values).first()
    if seen.least is None or seen.least == seen.greatest:
        raise ValueError("the training rows lack one of the classes")
    features = [c for i, c in enumerate(features) if seen[f"n{i}"]]
    if not features:
        raise ValueError("no feature has a value in the training rows")
    filled = [f"{c}_filled" for c in features]
    steps = [
        Imputer(inputCols=features, outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
        LogisticRegression(labelCol=label, featuresCol="features", maxIter=iterations, regParam=0.01),
    ]
    return Pipeline(stages=steps).fit(training)


def score_cases(model, df: DataFrame) -> DataFrame:
    """``df`` with score: the fitted probability of the positive class."""
    from pyspark.ml.functions import vector_to_array

    kept = df.columns
    return model.transform(df).select(*kept, vector_to_array("probability")[1].alias("score"))
