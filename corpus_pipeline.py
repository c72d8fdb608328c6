"""A corpus-cleaning pipeline: toxicity, line dedup, near-duplicate join, benchmark decontamination, best-fit packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecycle.llm import decontamination, line_dedup, near_dedup, packing, toxicity
from tidecycle.llm.common import materialize, table
from tidecycle.llm.queries import learnable


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score below a half); a null or empty text is scored as empty. Without labels of both kinds it rejects none."""
    model = toxicity.train(docs, learnable(table(spark, sf_dir, "labels")))
    return toxicity.score(docs, model).where("__score < 0.5").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source; n_chars follows the text. Null texts stay null, a null source is a source."""
    out = line_dedup.drop_boilerplate(docs)
    n_chars = F.when(F.col("__n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id; texts without words, null ones too, all stay."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; those without words are not, and an empty benchmark contaminates none."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; a null or empty text is its end id alone, no documents give no rows."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]
#: SQL can't express a trained classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, one after the other; what a stage keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs
