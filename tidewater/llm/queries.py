"""The operators' registered queries, over whole tables with production
parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import align, bpe, chat, fim, langid, license, line_dedup, mixing, pii, quality, rp_forest, simhash, topk
from tidewater.llm.common import table

#: The vocabulary of op5 among the public tokenizers' files.
VOCABULARY = "word_bpe_49k.json"
#: The two tokenizers of op12.
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(table(spark, sf_dir, "documents")).drop("passages")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                said.alias("text"))
    return chat.digest(chat.format_conversations(turns.unionByName(own)))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), with_ids=False)


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256.0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3.0, seed=7)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.93)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = quality.grades_of(table(spark, sf_dir, "labels"))
    return quality.classify(table(spark, sf_dir, "documents"), graded)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.drop_repeated_lines(
        table(spark, sf_dir, "documents"), least_chars=20, least_docs=3))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokenizers(table(spark, sf_dir, "documents"), *map(vocabulary_path, ALIGNED))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(table(spark, sf_dir, "documents"), seed=1, plain_percent=10, spm_percent=20))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_simhash, op3_pii, op4_chat, op5_bpe, op6_topk, op7_mixing, op8_embedding_dedup,
    op9_langid, op10_quality, op11_line_dedup, op12_align, op13_fim, pipeline)}

#: Language models, fingerprints, spans and token ids are beyond SQL; those
#: queries are tested against brute force.
ORACLE = {"op4_chat": chat.ORACLE_SQL, "op6_topk": topk.ORACLE_SQL, "op7_mixing": mixing.ORACLE_SQL,
          "op11_line_dedup": line_dedup.ORACLE_SQL, "op13_fim": fim.ORACLE_SQL}
