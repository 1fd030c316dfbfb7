"""A corpus pipeline: toxic documents go, one of each group of near copies stays, benchmark passages go, mix, shards.

Every stage takes the documents that its predecessor kept and reads them again from
Parquet. All stages but the last return the columns of ``documents`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptide.llm import decontam, mixing, ngram_join, sharding, toxicity
from snaptide.scratch import materialize, work_area

SHARDS = 24
COLUMNS = ("doc_id", "text", "lang", "source")


def _hidden(docs: DataFrame):
    """``docs`` with the columns no stage reads under names no stage writes, and how to take all back."""
    names = {c: c if c in COLUMNS else f"kept {i}" for i, c in enumerate(docs.columns)}
    out = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return out, [F.col(f"`{n}`").alias(c) for c, n in names.items()]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; null and empty texts stay unless the intercept alone rejects them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1
    hidden, back = _hidden(docs)
    scored = toxicity.score(hidden, toxicity.fit(docs, labels, learn))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*back)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked texts; of rows with one id, the one with the smallest text."""
    return ngram_join.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hidden, back = _hidden(docs)
    others = tuple(c for c in hidden.columns if c != "doc_id")
    found = decontam.decontaminate(hidden, benchmark, keep=others)
    return found.where(F.size("spans") == 0).select(*back)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics have their target shares of tokens; scarce documents are in it repeatedly."""
    hidden, back = _hidden(docs)
    rows = materialize(mixing.measured(hidden), "measured")
    targets = mixing.production_targets(rows)
    drawn = mixing.sample(rows, mixing.fit(rows, targets), targets=targets)
    return mixing.repeated(drawn).select(*back)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and the place in it of every document."""
    return sharding.assign(docs, SHARDS).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The classifier of the first stage has no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{work_area(spark, name)}/docs"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
