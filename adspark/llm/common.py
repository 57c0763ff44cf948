"""Shared helpers of the llm operators: stored intermediates, vectorised word hashing over Arrow
text columns, sorted-run passes and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adspark.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step works on; only a single longer text exceeds it.
SLICE_BYTES = 1 << 21
#: The same where nothing is combined over the texts of a step. Hashing words takes about 45 times
#: these bytes.
SMALL_SLICE_BYTES = 1 << 18
#: Bytes of rows that ``bounded_batches`` lets go to Python at once.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Word separators of ``[^\x20\x09-\x0D]+``.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def bounded_batches(spark: SparkSession) -> None:
    """From now on at most BATCH_BYTES of rows go to Python at once, unless the session sets its own
    limit. A task holds such a batch several times: in the JVM outside the heap, where buffers double
    as they grow, and in Python. Spark reads the setting when a plan runs, so the session keeps it."""
    if spark.conf.get(BATCH_CONF, None) is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one written intermediate under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage and survives
    lost executors. The folder lives as long as the cluster keeps its checkpoint folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves 0 modulo 5; a null id is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


# ---------------------------------------------------------------------------------------------
# Texts of an Arrow batch as bytes


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty. No Python string is made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and n else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or one longer row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


# ---------------------------------------------------------------------------------------------
# Word hashes. A run of values v[s:e] has the hash sum(r(v[j]) * B**(j - s)) modulo 2**64, taken
# from one running sum; B is odd, so B**-s exists. A finishing mix spreads the bits.

_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n, kept for the worker's life up to the slice size."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        m = max(SMALL_SLICE_BYTES + 1, min(2 * n, SLICE_BYTES + 1), n)
        base = _BASE[which]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(m, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if n <= SLICE_BYTES + 1:
            _POWERS[which] = have
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit finisher (multiply and xor-shift)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 7)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of values[s:e] for each (s, e), in one pass over ``values`` (uint64)."""
    n = len(values)
    power, inverse = _powers(which, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts], which + 11)


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


class Words:
    """Words (runs of bytes other than the six blanks) of several texts.

    ``hash`` has one 64-bit hash per word in text order, ``at`` the word range of each text
    (len(texts) + 1 entries), ``start`` and ``end`` the byte range of each word."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        mask = ~_IS_BLANK[raw]
        n = len(raw)
        first = offsets[:-1][np.diff(offsets) > 0] if n else offsets[:0]
        begin = mask.copy()
        begin[1:] &= ~mask[:-1]
        begin[first] = mask[first]
        finish = mask.copy()
        finish[:-1] &= ~mask[1:]
        if n:
            finish[first[1:] - 1] = mask[first[1:] - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.at = np.searchsorted(self.start, offsets)
        values = (_BYTE_LOWER if lower else _BYTE)[raw]
        self.hash = run_hashes(values, self.start, self.end)

    def starts_of(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Word index and text index of every run of ``width`` words that lies in one text."""
        counts = np.maximum(np.diff(self.at) - width + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        first = np.concatenate(([0], np.cumsum(counts)))[:-1]
        return np.arange(counts.sum()) - np.repeat(first, counts) + np.repeat(self.at[:-1], counts), text


def list_array(parts: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    """List column from one array per row."""
    off = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=off[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat, kind))


# ---------------------------------------------------------------------------------------------
# Runs of equal keys in sorted rows


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: int, most: int) -> Iterator[tuple]:
    """Cut rows sorted by their first ``keys`` integer columns into pieces that end at run ends.

    Yields (columns, run_start, run_length, more): numpy columns of whole runs, or of a part of one
    run of over ``most`` rows (``more`` is then 1 for its first part and 2 for the later ones), so
    that memory stays bounded by ``most`` rows and one batch, whatever the longest run."""
    held: list[np.ndarray] | None = None
    going: tuple | None = None  # the key of a run that has been yielded in part

    def cut(cols: list[np.ndarray], last: bool):
        nonlocal held, going
        n = len(cols[0])
        if not n:
            held = None
            return
        new = np.zeros(n, bool)
        new[0] = True
        for k in range(keys):
            new[1:] |= cols[k][1:] != cols[k][:-1]
        at = np.flatnonzero(new)
        if going is not None and going == tuple(int(c[0]) for c in cols[:keys]):
            stop = at[1] if len(at) > 1 else n
            yield [c[:stop] for c in cols], np.array([0]), np.array([stop]), 2
            if stop == n:
                held = None
                if last:
                    going = None
                return
            yield from cut([c[stop:] for c in cols], last)
            return
        going = None
        keep = n if last else int(at[-1])
        if keep:
            run = at[at < keep]
            yield [c[:keep] for c in cols], run, np.diff(np.append(run, keep)), 0
        held = [c[keep:] for c in cols] if keep < n else None
        if held is not None and len(held[0]) > most:
            going = tuple(int(c[0]) for c in held[:keys])
            yield held, np.array([0]), np.array([len(held[0])]), 1
            held = None

    for b in batches:
        if not b.num_rows:
            continue
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate((h, c)) for h, c in zip(held, cols, strict=True)]
            held = None
        yield from cut(cols, False)
    if held is not None:
        yield from cut(held, True)


# ---------------------------------------------------------------------------------------------
# Connected components


def _all_stars(e: DataFrame) -> bool:
    """True if each edge (u, v) runs from a node with no other edge to a root."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("child")).union(e.select("v", F.lit(0)))
    return ends.groupBy("id").agg(F.sum("child").alias("n"), F.count("*").alias("c")).where("n > 1 or (n = 1 and c > 1)").isEmpty()


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(id, component) for every id of ``edges(u, v)``: component is the least id reachable.

    Alternating large-star and small-star rounds (each node's edges are re-hung on its least
    neighbour), which need about log(n) rounds. Least neighbours are partial aggregates and are
    joined back, so a hub's edges stay spread over tasks; nothing is collected."""
    e = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    while not _all_stars(e):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large, name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), name)
    # every edge now runs from a node to its root
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
