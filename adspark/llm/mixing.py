"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Every document gets an exponential key, -ln(u) / weight, with u from the hash of its id and weight
from its quality; the smallest keys are drawn first. A source's token target is served by whole
epochs (all its documents, once or twice) before a fractional one: its documents sorted by key and
taken while the running sum of their sizes stays nearest to what is left. A document is taken whole
or not at all, so a source misses its target by at most half of one document.

No source is sorted in one task: keys are cut into bins (their number follows the source's share of
all rows), running sums are taken inside a bin and shifted by the totals of the bins before. Only
per-source and per-bin summaries are ordered as a whole. The text stays out of every shuffle.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own,
last in order; sources of size 0 have target 0; repeated rows are drawn like any other (equal rows
have equal keys; which of them comes first does not show); an empty table gives an empty result.
Other columns are ignored. Reruns agree, as nothing random but the hash is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
#: Sort bins over all sources; more of them where a bin would pass ROWS_PER_BIN.
BINS = 512
ROWS_PER_BIN = 1_000_000
SEED = "mix-1"

WORD = r"[^\x20\x09-\x0D]+"


def quality_weight(text: Column, size: Column) -> Column:
    """From 1 down towards 0 with the runs of symbols per word (junk is drawn later)."""
    runs = F.coalesce(F.regexp_count(text, F.lit(r"[!|*%$#&<>{}]+")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * runs / F.greatest(size, F.lit(1)))


def unit(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1), from the md5 of seed and id."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")), 1, 13), 16, 10).cast("long")
    return (h + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Adds total (all rows) and target to ``sources(source, source_size, n_docs)``, one row each.

    Water filling: sources in order of capacity per weight; the first k are at their capacity
    (``epochs`` times their size) where the level of the others, (budget - their capacity) / weight
    left, lies above them."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    s = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    everything = Window.partitionBy()
    s = s.withColumn("capacity", F.lit(float(epochs)) * F.col("source_size")).withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
    by_level = Window.orderBy(F.col("capacity") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", level)
    # the level of the first source that is not capped
    free = F.min(F.when(F.col("capacity") / F.col("weight") >= F.col("level"), F.struct(F.col("capacity") / F.col("weight"), F.col("level").alias("level")))).over(everything)["level"]
    s = s.withColumn("free", free)
    target = F.least(F.col("capacity"), F.coalesce(F.col("weight") * F.col("free"), F.col("capacity")))
    return s.select("source", "source_size", "n_docs", F.sum("n_docs").over(everything).alias("total"), F.col("mean_weight"), target.alias("target"))


def mix(docs: DataFrame, weight: Column | None = None, bins: int = BINS, carry: tuple[str, ...] = (), **how) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies) of ``docs(doc_id, text, source)``, and
    the columns of ``docs`` named in ``carry``."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", *carry, size.alias("size"), (quality_weight(F.col("text"), size) if weight is None else weight).alias("weight"))
    rows = stored(rows.withColumn("key", -F.log(unit(F.col("doc_id"))) / F.col("weight")), "mix-keys")  # one pass over the texts
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.avg("weight").alias("mean_weight"))
    plan = targets(sources, **how)
    # the bin grows with the key; a source has bins by its share of the rows
    n_bins = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.col("total") * F.greatest(F.lit(float(bins)), F.col("total") / ROWS_PER_BIN)))
    at = F.least(n_bins - 1, F.floor((F.lit(1.0) - F.exp(-F.col("key") * F.col("mean_weight"))) * n_bins))
    rows = rows.withColumnRenamed("source", "s").join(plan, F.col("s").eqNullSafe(F.col("source"))).drop("s").withColumn("bin", at)
    rows = rows.repartition("source", "bin")  # else the join's partitioning by source alone would do for the window

    in_bin = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.coalesce(F.sum("size").over(in_bin), F.lit(0)).alias("before_in_bin"))
    totals = rows.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("source").alias("o_source"), F.col("bin").alias("o_bin"), F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("before_bin"))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bin") == F.col("o_bin")))

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    left = F.col("target") - whole * F.col("source_size")
    drawn = (F.col("before_bin") + F.col("before_in_bin") + F.col("size") / F.lit(2.0)) <= left
    copies = F.when(F.col("size") > 0, whole + drawn.cast("int")).otherwise(0).cast("int")
    return rows.select("doc_id", "source", "size", "source_size", "target", *carry, (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
