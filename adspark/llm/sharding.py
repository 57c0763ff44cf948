"""Sharding along a Hilbert curve, in DataFrame operations only.

Source, language and size are quantised (categories by equal depth in their sort order, size by
half octaves), the cells' place on a three-dimensional Hilbert curve orders the documents, and the
order is cut into runs, one per shard, so that min/max statistics prune files on each of the three.
The law is ``rows`` (shard counts at most one apart) or ``bytes`` (equal sizes).

No task sorts more than a bin: a cell of the curve with many rows is split into sub-bins by the
hash that orders rows inside a cell, ranks are taken in a bin and shifted by the totals of the bins
before. What is ordered as a whole is the table of cells and bins, bounded by 2**(3 * BITS) cells.

Defined results: null source or language is the first category; a null text has size 1 and crc 0;
repeated rows are neighbours and get slots of their own; an empty table gives an empty result.
Other columns are ignored. Equal texts are not kept together by this method (they may differ in
source or language); they share size and crc.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

SHARDS = 8
BITS = 6
#: Sort bins; more of them where one would pass ROWS_PER_BIN.
BINS = 512
ROWS_PER_BIN = 1_000_000


def hilbert_index(axes: list[Column], bits: int = BITS) -> Column:
    """Place on the Hilbert curve of the cell with these coordinates (below 2**bits), by Skilling's
    transform (2004): undo the excess work bit by bit, Gray encode, then interleave."""
    n = len(axes)
    x = F.array(*(a.cast("int") for a in axes))
    steps = [F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)]

    def undo(x, s):
        low = s["q"] - 1
        here = F.get(x, s["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(here).bitwiseAND(low)
        is_set = here.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, j: F.when(is_set, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
                           .otherwise(F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(F.when(s["i"] == 0, 0).otherwise(swap))).otherwise(v)))

    x = F.aggregate(F.array(*steps), x, undo)
    # Gray code: each coordinate with all before it
    x = F.transform(x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), F.lit(0), lambda a, y: a.bitwiseXOR(y)))

    def finish(x):
        last = F.get(x, F.lit(n - 1))
        t = F.lit(0)
        for b in range(bits - 1, 0, -1):
            t = t.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, (1 << b) - 1).otherwise(0))
        return F.transform(x, lambda v: v.bitwiseXOR(t))

    # one bit of each coordinate in turn, highest first
    places = [F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)]
    x = F.transform(F.array(x), finish)[0]
    return F.aggregate(F.transform(F.array(x), lambda y: F.transform(F.array(*places), lambda p: F.call_function("getbit", F.get(y, p["i"]), p["b"]).cast("long")))[0],
                       F.lit(0).cast("long"), lambda a, bit: a * 2 + bit)


def _cells(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """(value, cell): the distinct values of a categorical column in 2**bits classes of equal depth."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col(column).isNotNull(), F.col(column).cast("binary")).rowsBetween(Window.unboundedPreceding, -1)
    cell = F.floor(F.coalesce(F.sum("n").over(order), F.lit(0)) * (1 << bits) / F.sum("n").over(Window.partitionBy()))
    return counts.select(F.col(column).alias(f"{column}_value"), cell.cast("int").alias(f"{column}_cell"))


def shard(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS, bins: int = BINS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, hilbert) of
    ``docs(doc_id, text, lang, source)``."""
    rows = docs.select("doc_id", "lang", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                       F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    for c in ("source", "lang"):
        rows = rows.join(_cells(rows, c, bits), F.col(c).eqNullSafe(F.col(f"{c}_value")))
    size_cell = F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.col("size")) * 2)).cast("int")
    rows = rows.select("doc_id", "size", "text_crc32", hilbert_index([F.col("source_cell"), F.col("lang_cell"), size_cell], bits).alias("hilbert"),
                       F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(1 << 30)).alias("tie"))
    rows = stored(rows, "hilbert")  # one pass over the texts and the curve

    cells = rows.groupBy("hilbert").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / total * F.greatest(F.lit(float(bins)), total / ROWS_PER_BIN)))
    cells = cells.select(F.col("hilbert").alias("h"), parts.alias("parts"))
    rows = rows.join(cells, F.col("hilbert") == F.col("h")).drop("h").withColumn("bin", F.floor(F.col("tie") * F.col("parts") / (1 << 30)))
    rows = rows.repartition("hilbert", "bin")  # else the join's partitioning by cell alone would do for the window
    in_bin = Window.partitionBy("hilbert", "bin").orderBy("tie", "text_crc32", "size", "doc_id")
    up_to = in_bin.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.row_number().over(in_bin).alias("nth"), F.coalesce(F.sum("size").over(up_to), F.lit(0)).alias("bytes_in_bin"))

    totals = rows.groupBy("hilbert", "bin").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    order = Window.orderBy("hilbert", "bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(F.col("hilbert").alias("o_h"), F.col("bin").alias("o_bin"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rows_before"),
                            F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"), F.sum("n").over(everything).alias("n_rows"), F.sum("bytes").over(everything).alias("n_bytes"))
    rows = rows.join(offsets, (F.col("hilbert") == F.col("o_h")) & (F.col("bin") == F.col("o_bin")))
    rank = F.col("rows_before") + F.col("nth") - 1
    if law == "rows":
        base, more = F.floor(F.col("n_rows") / shards), F.col("n_rows") % shards
        long_part = more * (base + 1)
        place = F.when(rank < long_part, F.struct(F.floor(rank / (base + 1)).alias("shard"), (rank % (base + 1)).alias("slot")))
        place = place.otherwise(F.struct((more + F.floor((rank - long_part) / F.greatest(base, F.lit(1)))).alias("shard"), ((rank - long_part) % F.greatest(base, F.lit(1))).alias("slot")))
        rows = rows.withColumn("place", place).select("*", F.col("place.shard").cast("int").alias("shard"), F.col("place.slot").cast("long").alias("slot"))
    elif law == "bytes":
        middle = F.col("bytes_before") + F.col("bytes_in_bin") + F.col("size") / 2
        rows = rows.select("*", rank.alias("rank"), F.least(F.lit(shards - 1), F.floor(middle * shards / F.col("n_bytes"))).cast("int").alias("shard"))
        first = rows.groupBy(F.col("shard").alias("f_shard")).agg(F.min("rank").alias("first"))
        rows = rows.join(F.broadcast(first), F.col("shard") == F.col("f_shard")).withColumn("slot", (F.col("rank") - F.col("first")).cast("long"))  # one row per shard
    else:
        raise ValueError(f"no law {law!r}: rows or bytes")
    return rows.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
