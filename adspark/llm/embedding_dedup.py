"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learned so that signs lose little (ITQ, Gong and Lazebnik 2011),
on a bounded sample; each rotation gives a balanced binary code. The codes are cut into substrings,
one hash table each; vectors that agree in a substring meet, and each pair is reranked with the
original vectors by cosine in double precision, in the first table where it meets. The number of
tables follows from the substring length and the recall: at least as many as the chance of a pair at
the threshold to differ in a bit asks for, then more until TARGET of the probes have met, pairs at
exactly the threshold made of sampled vectors (centring widens the angles of vectors that share a
direction, so the plain chance alone is too good there); further rotations supply the bits. Where
tables would pass MAX_TABLES, substrings get shorter instead.

Every vector is indexed, and buckets have no cap: a bucket beyond BLOCK vectors is split into
blocks, each pair of blocks being a unit of work. Links are counted and joined to spanning stars
inside a unit, so no pair leaves it. Equal vectors of a label collapse into one class first.

Vectors that are null, empty, zero or hold null or non-finite components, and those without label,
link with nothing (n_links 0, component their own id, kept). Vectors of different lengths never
link. A null id has a null component unless it links, and is kept only if it has no component.
Repeated rows are vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, sorted_runs, stored, table

THRESHOLD = 0.98
#: Expected recall of a pair right at the threshold.
TARGET = 0.999
SAMPLE = 20_000
ITERATIONS = 40
BLOCK = 1024
MAX_BITS = 64
#: Sampled vectors that the number of tables is measured with, two probes each.
PROBES = 2_000
#: Tables beyond which substrings get shorter (larger buckets, the same recall); the least length is MIN_WIDTH.
MAX_TABLES = 96
MIN_WIDTH = 4


def learn_rotation(x: np.ndarray, bits: int, seed: int) -> np.ndarray:
    """(dim, bits) projection: the principal axes, turned so that signs are nearest to values."""
    _, vectors = np.linalg.eigh(x.T @ x)
    axes = vectors[:, ::-1][:, :bits]
    v = x @ axes
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(ITERATIONS):
        u, _, w = np.linalg.svd(np.where(v @ rotation > 0, 1.0, -1.0).T @ v)
        rotation = (u @ w).T
    return axes @ rotation


def plan_tables(n: int, threshold: float = THRESHOLD, target: float = TARGET) -> tuple[int, int]:
    """(substring bits, tables) for n vectors of one label: buckets of about four vectors if spread
    evenly, and enough tables for the expected recall."""
    width = min(32, max(8, ceil(log2(max(n, 1))) - 2))
    agree = (1 - acos(threshold) / pi) ** width
    return width, ceil(log(1 - target) / log(1 - agree))


def probe_pairs(unit: np.ndarray, threshold: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors whose cosine is the threshold: sampled vectors, each turned by that
    angle towards a random direction and towards the difference from another sampled vector."""
    r = np.random.default_rng(seed)
    u = unit[r.permutation(len(unit))[:PROBES]]
    left, right = [], []
    for way in (r.normal(size=u.shape), u[::-1] - u):
        way = way - (way * u).sum(1, keepdims=True) * u
        length = np.sqrt((way * way).sum(1))
        some = length > 1e-9
        left.append(u[some])
        right.append(threshold * u[some] + np.sqrt(1 - threshold ** 2) * way[some] / length[some, None])
    return np.concatenate(left), np.concatenate(right)


class Codes:
    """Substring keys of vectors of one length. fit: sample of unit vectors (rows); tables: the least
    number of tables."""

    def __init__(self, fit: np.ndarray, width: int, tables: int, threshold: float = THRESHOLD, target: float = TARGET):
        dim = fit.shape[1]
        self.mean = fit.mean(0) if len(fit) else np.zeros(dim)
        bits = min(dim, MAX_BITS)
        self.width = min(width, bits)
        self.per = max(1, bits // self.width)
        self.tables = tables if self.width > 1 else 1
        self.projections = []
        if not len(fit):
            self.projections = [np.eye(dim)[:, :bits]] * ceil(self.tables / self.per)
            return
        left, right = probe_pairs(fit, threshold)
        missed = np.ones(len(left), bool)
        found = 0  # tables so far
        while found < self.tables or (self.width > 1 and missed.sum() > (1 - target) * len(missed)):
            if found >= max(MAX_TABLES, self.tables) and self.width > MIN_WIDTH:
                self.width, found, missed = max(MIN_WIDTH, self.width - 2), 0, np.ones(len(left), bool)
                self.per = max(1, bits // self.width)
                kept, self.projections = self.projections, []
                for p in kept:  # the same rotations, cut into shorter substrings
                    found, missed = self._add(p, left, right, found, missed)
                    if found >= self.tables and missed.sum() <= (1 - target) * len(missed):
                        break
                continue
            if found >= 4 * MAX_TABLES:
                break  # vectors of one or two components, whose rotations hardly differ
            found, missed = self._add(learn_rotation(fit - self.mean, bits, len(self.projections)), left, right, found, missed)
        self.tables = found

    def _add(self, projection: np.ndarray, left: np.ndarray, right: np.ndarray, found: int, missed: np.ndarray) -> tuple[int, np.ndarray]:
        """One more rotation: the tables with it and the probes that have met in none of them."""
        self.projections.append(projection)
        differ = ((left - self.mean) @ projection > 0) != ((right - self.mean) @ projection > 0)
        for k in range(self.per):
            missed = missed & differ[:, k * self.width:(k + 1) * self.width].any(1)
        return found + self.per, missed

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables) int32"""
        weight = 1 << np.arange(self.width, dtype=np.int64)
        out = []
        for p in self.projections:
            bit = (x - self.mean) @ p > 0
            for k in range(self.per):
                out.append((bit[:, k * self.width:(k + 1) * self.width] @ weight))
        return np.stack(out[:self.tables], 1).astype(np.int64)


def _units(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow on the way to the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _keyed(codes: dict[int, Codes]):
    def run(batches):
        for b in batches:
            dims = b.column("dim").to_numpy()
            vectors = b.column("embedding").to_pylist()
            for dim in np.unique(dims):
                i = np.flatnonzero(dims == dim)
                x = np.array([vectors[k] for k in i], np.float64)
                code = codes.get(int(dim)) or Codes(np.zeros((0, int(dim))), 8, 8)
                keys = code.keys(_units(x.reshape(-1), int(dim)))
                ids, label, mult = (b.column(c).to_numpy(zero_copy_only=False)[i] for c in ("c", "label", "copies"))
                n, t = keys.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(label, t)), pa.array(np.repeat(dims[i], t), pa.int32()), pa.array(np.tile(np.arange(t), n), pa.int32()), pa.array(keys.reshape(-1)),
                     pa.array(np.repeat(ids, t)), pa.array(np.repeat(mult, t)), pa.array([k.tobytes() for k in keys for _ in range(t)], pa.binary()),
                     pa.array([v.tobytes() for v in x for _ in range(t)], pa.binary())],
                    ["label", "dim", "tab", "sub", "c", "copies", "keys", "vector"])
    return run


def _unit_links(threshold: float):
    def run(batches):
        for cols, at, n, _ in sorted_runs(batches, 6, 1 << 30):  # a unit of work has 2 * BLOCK rows at most
            ids, mult, keys, vectors, left = cols[6:11]
            out_id, out_n, out_root = [], [], []
            for a, k in zip(at[n > 1], n[n > 1], strict=True):
                part = slice(a, a + k)
                dim, tab, inner = int(cols[1][a]), int(cols[2][a]), cols[4][a] == cols[5][a]
                x = _units(np.frombuffer(b"".join(vectors[part]), np.float64), dim)
                near = x @ x.T >= threshold
                if inner:
                    near[np.arange(k), np.arange(k)] = False
                else:  # only pairs across the two blocks
                    side = left[part].astype(bool)
                    near &= side[:, None] != side[None, :]
                i, j = np.nonzero(near)
                if not len(i):
                    continue
                if tab:  # taken already where an earlier substring agrees
                    key = np.frombuffer(b"".join(keys[part]), np.int64).reshape(k, -1)
                    new = np.ones(len(i), bool)
                    for t in range(tab):
                        new &= key[i, t] != key[j, t]
                    i, j = i[new], j[new]
                    if not len(i):
                        continue
                own, m = ids[part], mult[part]
                links = np.bincount(i, m[j], k).astype(np.int64)
                root = own.copy()
                while True:  # least id over the unit's links
                    low = root.copy()
                    np.minimum.at(low, i, root[j])
                    if (low == root).all():
                        break
                    root = low
                some = links > 0
                out_id.append(own[some])
                out_n.append(links[some])
                out_root.append(root[some])
            if out_id:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_id, out_n, out_root)], ["c", "links", "root"])
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of ``vectors(vec_id, embedding, label)``."""
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"),
                                 F.coalesce(good & finite, F.lit(False)).alias("valid")).withColumn("row", F.monotonically_increasing_id()), "vectors")
    valid = rows.where("valid")
    classes = valid.groupBy("label", "embedding").agg(F.min("row").alias("c"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = stored(classes.withColumn("dim", F.size("embedding")), "vector-classes")

    counts = {(r.label, r.dim): r.n for r in classes.groupBy("dim", "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.max("n").alias("n"), F.lit(0).alias("label")).collect()}
    total = max(classes.count(), 1)
    drawn = classes.where(F.pmod(F.xxhash64("c"), F.lit(1 << 30)) / float(1 << 30) < min(1.0, sample / total)).select("dim", "embedding").toPandas()
    codes = {}
    for (_, dim), n in counts.items():  # one entry per vector length
        fit = [v for d, v in zip(drawn["dim"], drawn["embedding"], strict=True) if d == dim]
        x = _units(np.array(fit, np.float64).reshape(-1), dim) if fit else np.zeros((0, dim))
        codes[dim] = Codes(x, *plan_tables(n, threshold, target), threshold, target)

    keyed = classes.select("label", "dim", "c", "copies", "embedding").mapInArrow(_keyed(codes), "label long, dim int, tab int, sub long, c long, copies long, keys binary, vector binary")
    keyed = stored(keyed, "hamming-tables")
    bucket = ["label", "dim", "tab", "sub"]
    size = keyed.groupBy(*bucket).agg(F.count("*").alias("in_bucket")).where("in_bucket > 1")
    work = keyed.join(size, bucket).withColumn("blocks", F.ceil(F.col("in_bucket") / (BLOCK / 2)).cast("int"))  # hashed into blocks: half full on average
    work = work.withColumn("mine", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = work.select(*bucket, F.least("mine", "other").alias("bi"), F.greatest("mine", "other").alias("bj"), "c", "copies", "keys", "vector", (F.col("mine") <= F.col("other")).alias("first_side"))
    unit = [*bucket, "bi", "bj"]
    found = stored(work.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(_unit_links(threshold), "c long, links long, root long"), "vector-links")

    parts = components(found.select(F.col("c").alias("u"), F.col("root").alias("v")), "vector-components")
    placed = classes.join(parts, F.col("c") == F.col("id"), "left").select("label", "embedding", "c", "copies", F.coalesce("component", "c").alias("component"), "least")
    name = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    placed = placed.join(name, "component").join(links, "c", "left").select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = valid.join(placed, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
