"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), calls one operator on all the rows it
is given, and lets its result take effect; ``run`` writes each result as
Parquet in the shared folder and rereads it for the next. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, langid, mixing, pii, simhash
from tidewater.llm.common import pick, table, written
from tidewater.llm.queries import vocabulary_path

COLUMNS = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}

#: Score from which a predicted language takes the place of a given one.
SURE = 0.9


def _documents(docs: DataFrame) -> DataFrame:
    return pick(docs, **COLUMNS)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (null or no letter) go; a
    document gets the predicted lang where it has none, or where the
    prediction is sure and says otherwise."""
    sure = F.col("lang").isNull() | (F.col("score") >= SURE)
    return langid.with_languages(docs).filter(F.col("lang_pred") != langid.UNKNOWN) \
        .withColumn("lang", F.when(sure, F.col("lang_pred")).otherwise(F.col("lang"))).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies one row stays, that
    of the smallest doc_id; a row without a doc_id stays only if none of its
    group has one. Rows of one doc_id and unlike texts are different rows."""
    return simhash.one_of_each(_documents(docs), list(COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: every span is replaced by its kind; n_chars follows."""
    return pii.with_clean_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document as often as its source's target takes it.
    Repeated rows (of one doc_id, source and text) count their copies together."""
    key = F.to_json(F.struct("doc_id", "source", "row_hash")).alias("_key")
    docs = _documents(docs)
    copies = mixing.mix(docs).select(key, "copies").groupBy("_key").agg(F.sum("copies").alias("copies"))
    rows = docs.withColumn("row_hash", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return rows.select(*COLUMNS, key).dropDuplicates(["_key"]).join(copies.filter("copies > 0"), "_key") \
        .select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")) \
        .select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: the token ids of every document, with their digests."""
    return bpe.encode_documents(_documents(docs), vocabulary_path())


STAGES = [("language ID", keep_known_languages), ("SimHash near-dedup", keep_one_of_each),
          ("PII", redact_personal_data), ("mixing", mix_sources), ("BPE", encode)]

#: A language model and token ids are beyond SQL; tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
