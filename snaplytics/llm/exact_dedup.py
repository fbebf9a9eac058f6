"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of new documents is first reduced
to one row per digest (map-side combining, so a text that makes up a third of the batch
costs one row per task); digests that the index does not hold are found by an anti-join
over the same buckets (sorted merge, no shuffle of the index). They are appended, and so is a
row of added copies for every digest that was known: the index only ever grows by rows, and
reading it adds them up by digest, again within the buckets. Documents meet the outcome in a join of
plain staged tables, where AQE can split a hot text. A batch has a name, and one that the
index already holds is not added twice, so a load that failed can be run again.

Texts are equal when identical after lower-casing A-Z. Cases: a null text counts as
empty; of equal texts in all batches the largest ``doc_id`` stays, a null ``doc_id`` only
when there is no other; rows that repeat both text and ``doc_id`` are the same document
and share the verdict; an empty batch leaves the index as it is; extra columns pass
through untouched (working columns get names the input does not use).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import lower_ascii, staged, table, unclash

#: Digests of one bucket at most, as planned from the first batch; and the least number of buckets.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with A-Z lower-cased."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))), 256)


def buckets_for(rows: int) -> int:
    """Buckets for an index that is to hold ten batches of so many rows (a power of two)."""
    buckets = LEAST_BUCKETS
    while buckets * BUCKET_ROWS < 10 * rows:
        buckets *= 2
    return buckets


def create_index(spark: SparkSession, name: str, path: str | None = None, buckets: int = LEAST_BUCKETS) -> str:
    """An empty index table, bucketed and sorted by digest; external when a path is given."""
    where = f"LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} (digest STRING, keep_id BIGINT, copies BIGINT, batch STRING) USING parquet "
              f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS {where}")
    return name


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """digest, keep_id, group_size of everything loaded; added up within the buckets."""
    return spark.table(index).groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("copies").alias("group_size"))


def load_batch(digests: DataFrame, index: str, batch: str | None = None) -> DataFrame:
    """Add a batch (doc_id, digest) to the index. Returns the digests that are new to it, with
    keep_id and copies of the batch (none for a batch that is already there)."""
    spark = digests.sparkSession
    batch = batch or uuid.uuid4().hex
    groups = staged(digests.groupBy("digest").agg(F.max("doc_id").cast("long").alias("keep_id"), F.count(F.lit(1)).alias("copies")),
                    "dedup-groups")
    known = spark.table(index).select(F.col("digest").alias("known"))
    if not spark.table(index).where(F.col("batch") == batch).isEmpty():
        return groups.limit(0)
    same = F.col("digest") == F.col("known")
    fresh = staged(groups.join(known.hint("merge"), same, "left_anti"), "dedup-fresh")
    seen = groups.join(known.hint("merge"), same, "left_semi")
    rows = fresh.unionByName(seen).select("digest", "keep_id", "copies", F.lit(batch).alias("batch"))
    rows.repartition(index_buckets(spark, index), "digest").write.insertInto(index)
    spark.catalog.refreshTable(index)
    return fresh


def index_buckets(spark: SparkSession, index: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {index}").where("col_name = 'Num Buckets'").first()
    return int(described["data_type"])


def dedup_against(docs: DataFrame, index: str, batch: str | None = None) -> DataFrame:
    """The documents whose text the index has not seen, one row per text; the batch is
    added to the index."""
    n = unclash(docs, "digest", "keep", "known")
    hashed = staged(docs.withColumn(n["digest"], text_digest(F.col("text"))), "dedup-hashed")
    fresh = load_batch(hashed.select("doc_id", F.col(n["digest"]).alias("digest")), index, batch)
    first = fresh.select(F.col("digest").alias(n["known"]), F.col("keep_id").alias(n["keep"]))
    kept = hashed.join(first, F.col(n["digest"]) == F.col(n["known"])).filter(F.col("doc_id").eqNullSafe(F.col(n["keep"])))
    return kept.dropDuplicates([n["digest"]]).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(digests: DataFrame, index: str) -> DataFrame:
    """Per document (doc_id, digest) of any batch so far: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = staged(read_index(digests.sparkSession, index).withColumnRenamed("digest", "i_digest"), "dedup-state")
    return digests.join(groups, F.col("digest") == F.col("i_digest")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def dedup_report(docs: DataFrame, index: str, batch: str | None = None) -> DataFrame:
    """Add a batch of documents to the index and report on them as the index then stands."""
    digests = staged(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "dedup-digests")
    load_batch(digests, index, batch)
    return report(digests, index)


#: Batches in which the query loads its documents.
BATCHES = 3


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents go through a new index in ``BATCHES`` batches; the report covers them all."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_digest(F.col("text")).alias("digest"))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)), F.lit(0)).cast("int")
    digests = staged(docs.withColumn("part", part), "dedup-digests")
    name = f"digest_index_{uuid.uuid4().hex[:12]}"
    create_index(spark, name, scratch_path(spark, "llm-digest-index"), buckets_for(digests.count() // BATCHES))
    try:
        for k in range(BATCHES):
            load_batch(digests.where(F.col("part") == k).drop("part"), name)
        return staged(report(digests.drop("part"), name), "dedup-report")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = f"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')) AS text_sha256 FROM documents),
g AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
