"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next one's documents.  All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemon.llm import decontam, jaccard_join, langid, pieceset, pii
from mnemon.llm.queries import PIECE_MODEL
from mnemon.llm.shared import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language can't be told: no letters, no text (null or empty), or a tie of languages.

    Repeated rows are told each, texts read whole, and an empty table stays empty.
    """
    return langid.keep_identified(docs, langid.learn(docs))


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or the first longer one that no column has."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def _with_keys(docs: DataFrame, key: str) -> DataFrame:
    """The rows with a ``key`` of their own: their doc_id or, where it is null or repeats, a large number made from id, text and source.

    Only rows that are alike in these share a key.
    """
    with_id = F.col("doc_id").isNotNull()
    base = F.when(with_id, F.lit(1 << 62)).otherwise(F.lit((1 << 62) + (1 << 61)))
    made = base + F.pmod(F.xxhash64(F.lit("id"), "doc_id", "text", "source"), F.lit(1 << 61))
    again = stored(docs.where(with_id).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "again")
    if again.isEmpty():
        return docs.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), made))
    mark = _free(docs, "again")
    told = docs.where(with_id).join(again.withColumn(mark, F.lit(True)), "doc_id", "left")
    told = told.withColumn(key, F.when(F.col(mark), made).otherwise(F.col("doc_id").cast("long"))).drop(mark)
    return stored(told.unionByName(docs.where(~with_id).withColumn(key, made)), "keyed")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked ones: that with the least doc_id.

    Documents without shingles (null, empty or without words) are groups of
    their own.  Rows whose doc_id repeats come after all others in their group,
    and those without one last; rows that repeat id, text and source leave one.
    Texts are compared whole, of any length; an empty table stays empty.
    """
    key = _free(docs, "pipeline_key")
    keyed = _with_keys(docs, key)
    classes = jaccard_join.jaccard_classes(keyed, key=key)
    kept = stored(classes.where(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count(F.lit(1)).alias("n")), "kept")
    # a shuffle at every size: the ids to keep grow with the documents
    out = keyed.join(kept.where("n = 1").select(key).hint("merge"), key, "left_semi").select(*docs.columns)
    if not (many := kept.where("n > 1").select(key)).isEmpty():
        alike = keyed.join(many.hint("merge"), key, "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("one"))
        out = out.unionByName(alike.select("one.*"))
    return out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item's passage.

    Null and empty texts hold none; repeated rows go or stay each; texts are
    read whole, and an empty table stays empty.
    """
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; every document stays, a null text as null."""
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document, whatever its length; a null or empty text has none."""
    return pieceset.encode(docs, PIECE_MODEL)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", one_of_each),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("sentencepiece", encoding),
]

#: Neither the classifiers nor the piece encoding can be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
