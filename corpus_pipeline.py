"""The corpus pipeline: toxic documents go, shared lines stay once, near copies and benchmark leaks go, sources are mixed.

Each stage is one operator of ``fogline.llm`` on all that the stage before kept, written as Parquet in between.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogline.llm import toxicity
from fogline.llm.decontaminate import drop_contaminated
from fogline.llm.jaccard_join import keep_one_of_each
from fogline.llm.line_dedup import dedup_lines
from fogline.llm.mixing import mix_sources
from fogline.session import DELETE_SHUFFLES, ensure_checkpoint_dir

#: Rows that Spark hands to Python at a time: texts are long, and a batch is held on both sides.
BATCH_ROWS = "1000"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _stage(function):
    """A stage whose texts travel in batches of BATCH_ROWS and whose shuffled texts go when the stage is written.

    Both are settings of the session, as frames are written by whoever called the stage. A frame that is run again computes again what was shuffled.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set(DELETE_SHUFFLES, "true")
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold of a lexicon learned from the labels outside the held-out third.

    NULL and empty texts have no hits and stay; rows without doc_id are scored but never learned from. All stages treat repeated rows as rows
    of their own, return the columns of documents (the last one those of ``mix_sources``) and leave other columns out; an empty table stays empty.
    """
    learn_from = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from)
    scored = toxicity.score_toxicity(docs, lexicon, carry=COLUMNS[1:])
    return scored.where("predicted = 0").select(*COLUMNS)


@_stage
def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without long lines that at least 5 of them share, but for the one that keeps them.

    A NULL text comes back empty; a NULL doc_id counts as the smallest, so it keeps no line that another document holds.
    """
    kept = dedup_lines(docs, min_chars=40, min_docs=5, carry=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id, NULL last.

    Texts without words (NULL, empty, blank) are linked with nothing and stay.
    """
    return keep_one_of_each(docs.select(*COLUMNS))


@_stage
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, as whole documents; NULL and empty texts hold none and stay."""
    return drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), threshold=0.75)


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; a NULL source is a source like any other, a NULL text has no words."""
    return mix_sources(docs, weights=(5, 2, 1), share=1.5, max_repeats=2, seed=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("mix_sources", mix),
]

#: Learned lexicons and fingerprints cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the session's shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}-{name}")
        docs = spark.read.parquet(f"{folder}/{place}-{name}")
    return docs
