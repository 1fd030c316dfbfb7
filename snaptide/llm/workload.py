"""Registered queries of the training-data operators: each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialize
from . import (
    centroids,
    decontam,
    langid,
    lattice,
    mixing,
    negatives,
    ngram_join,
    oracles,
    repeats,
    secretscan,
    sharding,
    template,
    tokencount,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SHARDS = 24


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(parts: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


@query()
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every document; labels are learned where the remainder of the id is not 1."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), _remainder(3) != 1)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query(oracles.SHARDS.format(shards=SHARDS))
def op6_sharding(spark, sf_dir):
    """Every document with its shard, by near-equal bytes."""
    rows = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op9_mixing(spark, sf_dir):
    """Every document with its probability under the target mix and whether it is drawn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    # the cells, the targets and the sample read what was measured once
    rows = materialize(mixing.measured(docs).drop("text"), "measured")
    targets = mixing.production_targets(rows)
    return mixing.sample(rows, mixing.fit(rows, targets), targets=targets)


@query(oracles.DECONTAMINATION)
def op10_decontamination(spark, sf_dir):
    """Words of every document that lie in a window of a benchmark item."""
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(found)


@query(oracles.NGRAM_JACCARD)
def op3_ngram_jaccard(spark, sf_dir):
    """Every document with its number of shingles and the smallest document it is linked with."""
    found = ngram_join.classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query(oracles.SUBSTRINGS)
def op7_substring_dedup(spark, sf_dir):
    """Every document without the passages that a document with a smaller id has too."""
    return repeats.digest(table(spark, sf_dir, "documents"))


@query()
def op1_language_id(spark, sf_dir):
    """Language of every document; learned where the remainder of the id is not 0."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, _remainder(5) != 0)
    found = langid.predict(docs, model).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query(oracles.EMBEDDINGS)
def op5_embedding_dedup(spark, sf_dir):
    """Every vector with its links and the smallest vector it is linked with."""
    found = lattice.classes(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query()
def op8_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return template.extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def token_edits():
    """A script of edits that follows from each document: a line goes, a stretch is replaced, a line is put in, one is added."""
    length = F.length("text")
    own = F.substring("text", 1, 12)

    def edit(start, stop, put):
        return F.struct(start.cast("long").alias("start"), stop.cast("long").alias("stop"), put.alias("put"))

    return F.array(
        edit(F.lit(0), F.instr("text", "\n"), F.lit("")),
        edit(F.floor(length / 2), F.floor(length / 2) + 24, own),
        edit(F.floor(length / 3), F.floor(length / 3), F.concat(F.lit("\n"), "source", F.lit(" says: "), own)),
        edit(length + 100, length + 100, F.concat(F.lit("\nSource: "), "source")),
    )


@query()
def op2_token_counts(spark, sf_dir):
    """Tokens of every document before and after its script of edits, and how much the edits made to encode again."""
    found = tokencount.counted(table(spark, sf_dir, "documents"), token_edits(), tokencount.Vocabulary.read())
    return found.withColumnRenamed("id", "doc_id")


@query(oracles.CENTROIDS)
def op11_centroid_clustering(spark, sf_dir):
    """Every vector with its cluster, its distance from the centroid and what the clustering comes to."""
    found, points = centroids.cluster(table(spark, sf_dir, "embeddings"))
    named = found.withColumnRenamed("id", "vec_id").join(F.broadcast(centroids.digests(spark, points)), "cluster")
    return named.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query(oracles.NEGATIVES)
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives for the positives of every vector whose id is divisible by 100, among all vectors."""
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", relabelled.alias("label"), "embedding")
    return negatives.mine(negatives.usable(rows), F.col("id") % 100 == 0)


@query()
def op13_secret_scan(spark, sf_dir):
    """Secrets in every document: what the patterns find, and tokens that look drawn at random."""
    docs = table(spark, sf_dir, "documents")
    return secretscan.digest(secretscan.scan(docs, secretscan.learn(docs)))
