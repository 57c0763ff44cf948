"""Corpus preparation: quality gate, near-duplicate removal, benchmark decontamination, mixing of
sources, sharding. Each stage works on all that the one before kept, is written as Parquet to the
shared folder and read again; all but the last return the columns of documents.

Null and repeated rows: a null text counts as empty; rows with a null id are never near duplicates;
rows with one id and one text are one document, of which the near-duplicate stage keeps a row; rows
with one id and different texts are documents of their own; a document that the mix takes twice is
two rows, and equal rows (id, source, text) are written as often as the mix takes them together. An
empty table passes through. Columns beyond those of documents pass through up to the
last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adspark.llm.common import BATCH_CONF, bounded_batches, stored, table
from adspark.llm.decontaminate import contamination, text_hash
from adspark.llm.jaccard_join import link
from adspark.llm.mixing import mix
from adspark.llm.quality import keep_good, learn
from adspark.llm.sharding import shard


def quality_gate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the quality classifier rejects go."""
    bounded_batches(spark)
    return keep_good(docs, learn(spark, sf_dir))


def _with_nodes(docs: DataFrame) -> DataFrame:
    """(row, node) of the documents with an id: the id, or a number above all ids where rows of that
    id have different texts."""
    named = docs.where("doc_id is not null")
    row, key = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_hash(F.col("text"))
    shared = stored(named.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo <> hi").select(F.col("doc_id").alias("shared_id")), "shared-ids")
    plain = named.select(row, F.col("doc_id").cast("long").alias("node"))
    if shared.isEmpty():
        return plain
    top = named.agg(F.max("doc_id").cast("long")).first()[0]
    texts = plain.join(shared, F.col("node") == F.col("shared_id"), "left_semi").select(F.col("node").alias("t_id"), text_hash(F.col("row.text")).alias("t_hash")).distinct()
    texts = stored(texts.withColumn("t_node", F.lit(top) + 1 + F.monotonically_increasing_id()), "shared-nodes")
    both = plain.join(texts, (F.col("node") == F.col("t_id")) & (text_hash(F.col("row.text")) == F.col("t_hash")), "left")
    return both.select("row", F.coalesce("t_node", "node").alias("node"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each component of linked documents the one with the least node (id) stays."""
    bounded_batches(spark)
    nodes = _with_nodes(docs)
    every, parts = link(nodes.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text")))
    root = every.join(parts, F.col("g") == F.col("id"), "left").select("doc_id", F.coalesce("component", "g", "doc_id").alias("root"))
    stay = root.where("doc_id = root").select(F.col("doc_id").alias("stay")).distinct()
    kept = nodes.join(stay, F.col("node") == F.col("stay"), "left_semi")
    one = Window.partitionBy("node").orderBy(F.xxhash64("row.text"))
    kept = kept.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents contaminated with benchmark passages go."""
    judged = contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"))
    bad = judged.where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct()
    return docs.alias("d").join(bad.alias("b"), F.col("d.doc_id").eqNullSafe(F.col("b.bad_id")) & (text_hash(F.col("d.text")) == F.col("b.bad_hash")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: each document as often as the mix takes it. Rows that are equal in id, source and
    text are one document here: one of them is written as often as the mix takes them together."""
    slim = docs.select("doc_id", "text", "source", text_hash(F.col("text")).alias("hash"))
    taken = mix(slim, carry=("hash",)).groupBy(F.col("doc_id").alias("t_id"), F.col("source").alias("t_source"), F.col("hash").alias("t_hash")).agg(F.sum("copies").cast("int").alias("copies"), F.count("*").alias("same"))
    taken = stored(taken.where("copies > 0"), "mix-copies")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.t_id")) & F.col("d.source").eqNullSafe(F.col("t.t_source")) & (text_hash(F.col("d.text")) == F.col("t.t_hash"))

    def rows(part: DataFrame) -> DataFrame:
        # Rows travel as a generated struct, so that no column name can clash with those of docs
        both = docs.alias("d").join(part.alias("t"), same)
        return both.select("t.t_id", "t.t_source", "t.t_hash", F.struct(*(F.col(f"d.`{c}`") for c in docs.columns)).alias("row"), "t.copies")

    out = rows(taken.where("same = 1"))
    repeated = taken.where("same > 1")
    if not repeated.isEmpty():
        out = out.unionByName(rows(repeated).dropDuplicates(["t_id", "t_source", "t_hash"]))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth")).select("row.*")


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: shard and slot of every row."""
    return shard(docs.select("doc_id", "text", "lang", "source"))


STAGES = [("quality", quality_gate), ("near_duplicates", drop_near_duplicates), ("decontamination", decontaminate), ("mixing", mix_sources), ("sharding", shard_rows)]

#: SQL cannot express the first stage (a trained network).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    before = spark.conf.get(BATCH_CONF, None)
    try:
        docs = table(spark, sf_dir, "documents")
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        return docs
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
