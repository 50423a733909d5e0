"""The corpus pipeline: documents in, packed sequences out.

``STAGES`` lists the stages; each works on all rows that its predecessor kept.
The stages that filter or edit return the columns of ``documents``; the last
returns the packed pieces. NULL ids and texts, empty texts and empty tables pass
as each operator defines: an empty text fails the quality rules, a row without
an id gives way to a copy that has one.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bestfit_packing, decontaminate, jaccard_join, pii_crf, quality_rules
from tessera.llm.rowwise import ROW, unpacked, whole_rows
from tessera.llm.session import ready, tokenizer_path
from tessera.sources.tables import read_table
from tessera.util import shared_scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the default policy keeps."""
    ready(spark)
    return quality_rules.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of copies (five words, similarity 0.8): the one with the smallest id.

    Rows are judged, not ids: texts under one id, or under none, stay or go each by
    its own group. A NULL id counts as larger than all others; of the rows of a group that
    share the smallest id one stays. Rows without words stay.
    """
    ready(spark)
    groups = jaccard_join.jaccard_components(docs, n=5, num=8, den=10, count_links=False, with_class=True)
    groups = groups.where("class_id is not null").select("doc_id", "class_id", "component").checkpoint()
    best = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "class_id")).alias("s"))
    stay = best.select("s.doc_id", "s.class_id").checkpoint()
    named = groups.where("doc_id is not null")
    rows = named.groupBy("doc_id").agg(F.count("*").alias("n"))
    ids = rows.join(stay.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("s")), "doc_id", "left").checkpoint()
    gone, several = ids.where("s is null").select("doc_id"), ids.where("s is not null and n > 1").select("doc_id")
    # Texts are not shuffled where the ids that leave, and those with several rows, are few.
    kept = docs.join(jaccard_join.few(gone), "doc_id", "left_anti").select(*docs.columns)
    apart = []
    if not several.isEmpty():
        several = jaccard_join.few(several)
        apart.append(docs.join(several, "doc_id", "left_semi").select(*docs.columns))
        kept = kept.join(several, "doc_id", "left_anti").select(*docs.columns)
    if not groups.where("doc_id is null").isEmpty():
        apart.append(docs.where("doc_id is null"))
        kept = kept.where("doc_id is not null")
    for part in apart:  # by row: the text's class says which of an id's rows is meant
        own = jaccard_join.class_of(part).withColumn("_id", F.col(f"{ROW}.doc_id"))
        right = stay.select(F.col("doc_id").alias("_stay"), F.col("class_id").alias("_class"))
        told = own.join(right, F.col("_id").eqNullSafe(F.col("_stay")) & (F.col("class_id") == F.col("_class")), "left_semi")
        told = told.dropDuplicates(["_id", "class_id"]).unionByName(own.where("class_id is null"))
        kept = kept.unionByName(whole_rows(told, docs.columns, "text"))
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    ready(spark)
    return decontaminate.clean_rows(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data masked; ``n_chars`` follows the text."""
    ready(spark)
    out = pii_crf.masked_rows(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    ready(spark)
    got = bestfit_packing.best_fit_pack(docs, tokenizer_path())
    return unpacked(got, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("bestfit_packing", packing),
]

#: Tokens, a trained model and a packing search: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = shared_scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(scratch, f"{k}_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
