"""Training-corpus pipeline: toxicity filter, language filter, near-duplicate removal, source mix, BPE encoding.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; results go from stage to stage as Parquet.
All stages but the last return the columns of their input, whatever else these are called; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, langid, mixing, neardup, toxicity
from larkspur.llm.queries import TOKENIZER
from larkspur.llm.scratch import Tables

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below 0.5.

    A null or empty text has the score of no sentence, which is the share of toxic documents that no sentence explains (far
    below 0.5, unless nearly all labels are 1), and stays. Equal texts are judged alike; repeated rows all stay or all go. A
    null doc_id takes no part in the fit. Without labels every row stays.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.kept(docs, model, below=0.5)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is known: not ``und``, and with a posterior of at least one half.

    Null, empty and letterless texts are ``und`` and go. Of equally likely languages the first by name counts; with a posterior of
    exactly one half the row stays. Repeated rows fare alike. If no row has a language, nothing can be learned and every row goes.
    """
    return langid.kept(docs, langid.train(docs), least=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id, null last.

    Repeated rows and repeated or null ids are judged row by row. Texts without a word are near nothing, so their rows all stay.
    """
    return neardup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a row appears once for every time the mix takes it, labelled good ones drawn first.

    A null source is a source of its own. Null and empty texts have no words: they come once for each complete epoch. Unlabelled
    documents and null ids have the weight 1; repeated rows share a key and are drawn one after the other.
    """
    return mixing.mixed_copies(docs, mixing.quality_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of the mix, repeated rows and null ids included; a null text is empty."""
    return bpe.encode_digest(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_identified),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; the result of each but the last is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables, last = Tables(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        docs = tables.written(stage(spark, docs, sf_dir), name)
        if last is not None:
            tables.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
