"""The corpus pipeline: documents to token ids.

Toxic documents go, repeated lines go, one document of each near-duplicate
group stays, documents that hold benchmark items go, and the rest is encoded.
Every stage works on all that the one before it kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ravel.llm import bpe, decontam, lines, simhash, toxicity
from ravel.llm.common import pinned, read
from ravel.session import remove_path, scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents the model judges toxic; it is fitted on those of
    ``labels`` that are among ``docs``."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without repeated lines; ``n_chars`` follows the text."""
    out = lines.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast(kind))
    return out.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a benchmark item is found."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of each document."""
    out = bpe.encode_documents(docs, bpe.default_tokenizer())
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity_stage), ("line dedup", line_dedup_stage),
          ("simhash near-dedup", near_dedup_stage),
          ("benchmark decontamination", decontamination_stage), ("bpe", bpe_stage)]

# Fingerprints, a fitted model and tokens cannot be said in SQL; the tests
# compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage returns is written to the
    shared scratch folder and read by the next one, then removed, also when a
    stage fails."""
    docs, kept = read(spark, sf_dir, "documents"), []
    try:
        for name, stage in STAGES[:-1]:
            kept.append(scratch_path(spark, name.replace(" ", "-")))
            stage(spark, docs, sf_dir).write.parquet(kept[-1])
            if len(kept) > 1:
                remove_path(spark, kept.pop(0))
            docs = spark.read.parquet(kept[-1])
        return pinned(STAGES[-1][1](spark, docs, sf_dir))
    finally:
        for path in kept:
            remove_path(spark, path)
