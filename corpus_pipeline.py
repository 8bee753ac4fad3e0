"""A corpus pipeline of five operators, each stage written as Parquet and read again.

Toxic documents go; of equal texts one stays; of each near-duplicate component
one stays; secrets are replaced by a mark; what is left is packed into
sequences of 2048 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshstate.llm import exact_dedup, jaccard_join, packing, secret_scan, toxicity
from freshstate.session import scratch_path

#: Documents with such a score or more are rejected as toxic.
TOXIC_SCORE = 0.3

#: Tokenising and fitting a classifier are not expressible in SQL.
ORACLE_SQL = None


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is among ``ids`` (null matches null); the texts
    are shuffled once."""
    ids = ids.select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_kept_id"]), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below ``TOXIC_SCORE``; learnt from the same label rows as the operator's query.
    All of them, if no term could be learnt: every score would be the prior."""
    usable = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=usable)
    if not len(model.words):
        return docs
    # the documents may have a column of the name that the operator adds
    names = [f"_doc_{i}" for i in range(len(docs.columns))]
    scored = toxicity.score(docs.toDF(*names), model, text_col=names[docs.columns.index("text")], keep_cols=tuple(names))
    return scored.where(F.col("score") < TOXIC_SCORE).select(*names).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    text_hash = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    # ids may repeat or be null, so the decision holds for an id with a text
    kept = (exact_dedup.exact_dedup(docs.select("doc_id", "text", text_hash.alias("_hash")), keep_cols=("_hash",)).where("kept")
            .select(F.col("doc_id").alias("_kept_id"), F.col("_hash").alias("_kept_hash")).distinct())
    hashed = docs.withColumn("_text_hash", text_hash)
    out = hashed.join(kept, hashed["doc_id"].eqNullSafe(kept["_kept_id"]) & (hashed["_text_hash"] == kept["_kept_hash"]), "left_semi")
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():
        # an id that repeats: rows with the same id and text are one
        out = out.dropDuplicates(["doc_id", "_text_hash"])
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, the row with the smallest id; rows without an id stay."""
    found = jaccard_join.jaccard_components(docs)
    return _only(docs, found.where("component_id <=> doc_id")).select(*docs.columns)


def mark_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    parts = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.best_fit_pack(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", mark_secrets),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; every stage but the last is written to
    the shared folder and read again, and removed once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            target = spark._jvm.org.apache.hadoop.fs.Path(before)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
