"""Exact top-k search by inner product over a pivot-distance index.

Vectors become integers (floor of ``scale`` times each component). Equal vectors collapse into one
class. Pivots are fitted on a bounded sample; every class is keyed by its nearest pivot and its
distance to it, and the distances of a pivot are cut into rings (annuli). For a query q and a ring
of pivot p with distances in [lo, hi] and norms up to m, the triangle inequality bounds every inner
product in the ring: |q - x| >= gap, the distance from |q - p| to [lo, hi], so q.x is at most
(|q|^2 + m^2 - gap^2) / 2, and at most q.p + |q| hi. Each query visits rings by falling bound, a
growing number a round, and stops where the next bound is below its k-th score: what is left cannot
enter. The result is exact whatever the sample; bounds are widened by more than their rounding.

The index holds at most MAX_CELLS rings of each of the MAX_LENGTHS commonest vector lengths (other
lengths are one ring each), so the driver and the tasks hold a bounded directory. A ring's rows are
dealt over blocks and its queries over chunks; each pair of these is one unit of work, which keeps
its block and streams its queries.

Defined results: vectors that are null or hold null, NaN or infinite components (also those whose
``scale``-fold leaves the double range) take no part; vectors of different lengths are not
compared; empty vectors score 0 with each other. Scores beyond a long are cut to its ends. Each
row is a query and a candidate of its own, also where ids repeat; a null id is never a query and
comes last among ties. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

SCALE = 256
#: Vectors of the sample that pivots and ring edges are fitted on, and its bytes in all.
SAMPLE, SAMPLE_BYTES = 20_000, 64 << 20
#: Classes that a ring, and a block of a ring, holds on average; queries of a chunk.
CELL_ROWS, BLOCK_BYTES, CHUNK = 2048, 8 << 20, 1 << 16
MAX_CELLS, MAX_LENGTHS, ITERATIONS = 4096, 8, 6
#: Rings that a query may visit in the first round; each later round quadruples them.
FIRST = 2
LOW = -(1 << 63)


def _pack(x: np.ndarray) -> bytes:
    """Integers in 16 bits where they fit, else as doubles."""
    return (x.astype(np.int16) if not len(x) or np.abs(x).max() < 32768 else x + 0.0).tobytes()


def _unpack(vectors: list[bytes], dim: int) -> np.ndarray:
    """(rows, dim) doubles of packed vectors."""
    out = np.zeros((len(vectors), dim))
    if not dim:
        return out
    short = [i for i, v in enumerate(vectors) if len(v) == 2 * dim]
    if short:
        out[short] = np.frombuffer(b"".join(vectors[i] for i in short), np.int16).reshape(-1, dim)
    for i, v in enumerate(vectors):
        if len(v) != 2 * dim:
            out[i] = np.frombuffer(v, np.float64)
    return out


def _quantised(scale: int):
    def run(batches):
        for b in batches:
            column = b.column("embedding")
            off = column.offsets.to_numpy().astype(np.int64)
            flat = np.floor(column.values.to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            vec = [_pack(flat[s:e]) for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("vec_id"), b.column("asked"), pa.array(np.diff(off), pa.int32()), pa.array(vec, pa.binary())], ["row", "vec_id", "asked", "dim", "vec"])
    return run


# ---------------------------------------------------------------------------------------------
# The index


class Index:
    """Pivots of one vector length, the edges of their rings, and the rings' bounds."""

    def __init__(self, fit: np.ndarray, n: int):
        cells = max(1, min(MAX_CELLS, ceil(n / CELL_ROWS), len(fit)))
        size = max(1, isqrt(cells))
        self.rings = max(1, cells // size)
        rng = np.random.default_rng(7)
        self.pivots = fit[rng.choice(len(fit), size, replace=False)]
        for _ in range(ITERATIONS):
            near, _ = self.nearest(fit)
            self.pivots = np.stack([fit[near == p].mean(0) if (near == p).any() else self.pivots[p] for p in range(size)])
        near, far = self.nearest(fit)
        steps = np.arange(1, self.rings) / self.rings
        self.edges = np.stack([np.quantile(far[near == p], steps) if (near == p).any() else np.full(self.rings - 1, np.inf) for p in range(size)])

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * x @ self.pivots.T, 0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(x)
        near = d.argmin(1)
        return near, d[np.arange(len(x)), near]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ring and distance of each vector."""
        near, far = self.nearest(x)
        return near * self.rings + (far[:, None] >= self.edges[near]).sum(1), far

    def describe(self, cells: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray) -> None:
        self.cells, self.lo, self.hi, self.norm = cells, lo, hi, norm

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """(queries, rings): the most that an inner product with a vector of the ring can be."""
        of = self.cells // self.rings
        square = (q * q).sum(1)[:, None]
        length, inner = np.sqrt(square), (q @ self.pivots.T)[:, of]
        d = self.distances(q)[:, of]
        gap = np.maximum(0, np.maximum(self.lo - d, d - self.hi))
        most = np.minimum((square + self.norm ** 2 - gap * gap) / 2, inner + length * self.hi)
        scale = square + self.norm ** 2 + (self.pivots * self.pivots).sum(1)[of]
        return np.where(np.isnan(most), np.inf, most + 1e-6 * scale + 1)


def _by_dim(batch: pa.RecordBatch):
    dims = batch.column("dim").to_numpy()
    vectors = batch.column("vec").to_pylist()
    for dim in np.unique(dims):
        i = np.flatnonzero(dims == dim)
        with np.errstate(all="ignore"):
            yield int(dim), i, _unpack([vectors[k] for k in i], int(dim))


def _placed(index: dict[int, Index]):
    def run(batches):
        for b in batches:
            cell, far, norm = np.zeros(b.num_rows, np.int32), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for dim, i, x in _by_dim(b):
                with np.errstate(all="ignore"):
                    norm[i] = np.sqrt((x * x).sum(1))
                    if dim in index:
                        cell[i], far[i] = index[dim].place(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far), pa.array(norm)], [*b.schema.names, "cell", "far", "norm"])
    return run


def _requests(index: dict[int, Index], start: int, stop: int):
    """(dim, cell, q, tau, vec): the rings that each query visits in this round."""
    def run(batches):
        for b in batches:
            q, tau = b.column("q").to_numpy(), b.column("tau").to_numpy()
            vec = b.column("vec")
            for dim, i, x in _by_dim(b):
                if dim in index:
                    with np.errstate(all="ignore"):
                        most = index[dim].bounds(x)
                    order = np.argsort(-most, 1, kind="stable")[:, start:stop]
                    row, at = np.nonzero(np.take_along_axis(most, order, 1) >= tau[i][:, None].astype(np.float64))
                    cell = index[dim].cells[order[row, at]]
                elif start == 0:
                    row, cell = np.arange(len(i)), np.zeros(len(i), np.int32)
                else:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), dim, np.int32)), pa.array(cell.astype(np.int32)), pa.array(q[i[row]]), pa.array(tau[i[row]]), vec.take(pa.array(i[row]))], ["dim", "cell", "q", "tau", "vec"])
    return run


# ---------------------------------------------------------------------------------------------
# The search


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products as longs, cut to the ends of their range."""
    dim = q.shape[1]
    if not dim or np.abs(q).max() * np.abs(x).max() * dim < 1 << 53:  # every partial sum is exact in a double
        return (q @ x.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(q) @ whole(x).T
    return np.frompyfunc(lambda v: min(max(v, LOW), -LOW - 1), 1, 1)(exact).astype(np.int64)


def _best(score: np.ndarray, tau: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, column) of each query's k greatest scores not below tau; ties to the first column."""
    m = score.shape[1]
    least = tau[:, None] if m <= k else np.maximum(tau, np.partition(score, m - k, 1)[:, m - k])[:, None]
    row, col = np.nonzero(score >= least)
    order = np.lexsort((col, -score[row, col].astype(object) if (score == LOW).any() else -score[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], col[keep]


def _search(k: int):
    """Rows sorted by (dim, cell, block, chunk, kind): kind 0 are the block's classes, kind 1 the
    queries. Memory holds one block and one batch of queries."""
    unit = ("dim", "cell", "block", "chunk")

    def run(batches):
        going, held, block = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(c).to_numpy() for c in (*unit, "kind")], 1)
            at = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1))))
            for s, e in zip(at, [*at[1:], len(keys)], strict=True):
                key, kind, part = tuple(keys[s, :4]), keys[s, 4], b.slice(s, e - s)
                if key != going:
                    going, held, block = key, [], None
                if kind == 0:
                    held.append(part)
                    continue
                dim = int(key[0])
                if block is None:
                    if not held:
                        continue
                    rows = pa.Table.from_batches(held)
                    held = []
                    least, ids = rows.column("least").to_numpy(), rows.column("id").to_numpy()
                    missing = rows.column("no_least").to_numpy()
                    order = np.lexsort((ids, least, missing))
                    block = (_unpack([v for c in rows.column("vec").chunks for v in c.to_pylist()], dim)[order], ids[order], least[order], missing[order])
                x, ids, least, missing = block
                step = max(1, (4 << 20) // max(len(ids), dim, 1))
                for a in range(0, part.num_rows, step):
                    few = part.slice(a, step)
                    score = _scores(_unpack(few.column("vec").to_pylist(), dim), x)
                    row, col = _best(score, few.column("tau").to_numpy(), k)
                    if len(row):
                        yield pa.RecordBatch.from_arrays([few.column("id").take(pa.array(row)), pa.array(score[row, col]), pa.array(ids[col]), pa.array(least[col], mask=missing[col])], ["q", "score", "c", "least"])
    return run


def exact_top_k(vectors: DataFrame, asked: Column, k: int = 5, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) of ``vectors(vec_id, embedding)``: for each row where
    ``asked`` holds, the k other rows of greatest inner product, ties to the smaller vec_id."""
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keep = k + 1  # a query's own row may be among the best
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("embedding").isNotNull() & finite).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows.select("row", "vec_id", "asked", "embedding").mapInArrow(_quantised(scale), "row long, vec_id long, asked boolean, dim int, vec binary"), "topk-rows")

    # of equal vectors the first k + 1 by id can be among a query's best k, and no other
    first = Window.partitionBy("dim", "vec").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    member = F.struct(F.col("vec_id").isNull().alias("no_id"), "vec_id", "row")
    few = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= keep)
    classes = stored(few.groupBy("dim", "vec").agg(F.min("row").alias("c"), F.min("vec_id").alias("least"), F.collect_list(member).alias("members")), "topk-classes")

    index = _fit(classes)
    placed = stored(classes.select("dim", "c", "least", "vec").mapInArrow(_placed(index), "dim int, c long, least long, vec binary, cell int, far double, norm double"), "topk-placed")
    rings = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.min("far").alias("lo"), F.max("far").alias("hi"), F.max("norm").alias("norm"))
    known = rings.where(F.col("dim").isin(*index)).toPandas()  # MAX_CELLS rows a fitted length
    for dim, it in index.items():
        own = known[known["dim"] == dim].sort_values("cell")
        it.describe(*(own[c].to_numpy() for c in ("cell", "lo", "hi", "norm")))
    per_block = F.greatest(F.lit(1), F.least(F.lit(2 * CELL_ROWS), (F.lit(BLOCK_BYTES) / (8 * F.greatest(F.col("dim"), F.lit(1)))).cast("int")))
    rings = stored(rings.select("dim", "cell", F.ceil(F.col("n") / per_block).cast("int").alias("blocks")), "topk-rings")

    own = rows.where("asked").join(classes.select("dim", "vec", "c"), ["dim", "vec"]).select("row", F.col("vec_id").alias("query_id"), F.col("c").alias("q"))
    own = stored(own, "topk-queries")
    asking = own.select("q").distinct().join(classes.select(F.col("c").alias("q"), "dim", "vec"), "q")
    best, start, stop = None, 0, FIRST
    most = max([1, *(len(it.cells) for it in index.values())])
    rank = Window.partitionBy("q").orderBy(F.desc("score"), F.col("least").asc_nulls_last(), "c")
    while True:
        if best is None:
            open_ = asking.withColumn("tau", F.lit(LOW))
        else:
            tau = best.groupBy("q").agg(F.when(F.count("*") >= keep, F.min("score")).otherwise(F.lit(LOW)).alias("tau"))
            open_ = asking.join(tau, "q", "left").fillna(LOW, ["tau"])
        wanted = stored(open_.select("dim", "q", F.col("tau").cast("long").alias("tau"), "vec").mapInArrow(_requests(index, start, stop), "dim int, cell int, q long, tau long, vec binary"), "topk-requests")
        units = wanted.groupBy("dim", "cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).join(rings, ["dim", "cell"])
        units = stored(units, "topk-units")
        size = units.agg(F.coalesce(F.sum(F.col("chunks") * F.col("blocks")), F.lit(0)).alias("n")).first().n
        if size:
            here = placed.join(units, ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
            here = here.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            here = here.select("dim", "cell", "block", "chunk", F.lit(0).alias("kind"), F.col("c").alias("id"), F.coalesce("least", F.lit(0)).alias("least"), F.col("least").isNull().alias("no_least"), F.lit(0).cast("long").alias("tau"), "vec")
            ask = wanted.join(units, ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("q"), F.col("chunks")).cast("int"))
            ask = ask.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            ask = ask.select("dim", "cell", "block", "chunk", F.lit(1).alias("kind"), F.col("q").alias("id"), F.lit(0).cast("long").alias("least"), F.lit(False).alias("no_least"), "tau", "vec")
            unit = ["dim", "cell", "block", "chunk"]
            work = here.unionByName(ask).repartition(max(parts, ceil(size / 8)), *unit).sortWithinPartitions(*unit, "kind")
            found = work.mapInArrow(_search(keep), "q long, score long, c long, least long")
            both = found if best is None else best.unionByName(found)
            best = stored(both.withColumn("nth", F.row_number().over(rank)).where(F.col("nth") <= keep).drop("nth"), "topk-best")
        elif best is None:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        if stop >= most:
            break
        start, stop = stop, stop * 4

    members = best.join(classes.select("c", "members"), "c").select("q", "score", F.explode("members").alias("m"))
    entry = F.struct((-F.col("score").cast("decimal(20,0)")).alias("order"), "m.no_id", "m.vec_id", "m.row", "score")
    lists = members.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, keep).alias("list"))  # (k + 1) ** 2 entries at most
    picked = own.join(lists, "q").select("query_id", F.posexplode(F.slice(F.filter("list", lambda e: e["row"] != F.col("row")), 1, k)).alias("at", "e"))
    return picked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))


def _fit(classes: DataFrame) -> dict[int, Index]:
    """Indexes of the commonest vector lengths, fitted on a bounded sample."""
    index = {}
    for r in classes.where("dim > 0").groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(MAX_LENGTHS).collect():
        want = min(SAMPLE, SAMPLE_BYTES // (8 * r.dim))
        share = F.pmod(F.xxhash64("c"), F.lit(1 << 30)) / float(1 << 30) < min(1.0, want / r.n)
        drawn = classes.where((F.col("dim") == r.dim) & share).select("vec").limit(2 * want).toPandas()["vec"]
        fit = _unpack([bytes(v) for v in drawn], r.dim)
        if len(fit) and np.abs(fit).max() < 1e100:
            index[r.dim] = Index(fit, r.n)
    return index


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 greatest integer inner products of each row whose vec_id is divisible by 50."""
    return exact_top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 50 == 0)
