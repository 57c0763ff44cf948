"""Quality classifier: a byte-level convolutional network in numpy.

Every text is cut into overlapping chunks of bytes that together cover the whole document. In a
chunk, learned filters slide over embedded bytes; each filter's answers are max-pooled and, after
the rectifier, averaged, and the chunk features are combined over the document (mean and maximum)
into one logistic output. Training is plain gradient descent (Adam) on the whole texts of a sample of
labelled rows, bounded in rows and in bytes; it runs in one task, so only the network reaches the
driver. Scoring is one pass without a shuffle.

Defined results: null and empty texts are scored as an empty chunk (all padding); a null id counts
as held out; without labelled rows of both kinds every score is the neutral 0.5 and every document
is kept. An id labelled both ways is learned from with both labels; a row labelled twice counts once.
Repeated rows are scored row by row; other columns are ignored (and kept by ``keep_good``).
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, slices, stored, table, text_bytes

CHUNK = 512
STEP = 384  # chunks overlap by CHUNK - STEP bytes
WIDTH = 8  # bytes under a filter
STRIDE = 2
EMBED = 6
FILTERS = 32
#: Expected number of training rows, and the bytes of their texts, half for each label.
TRAIN_ROWS = 3000
TRAIN_BYTES = 16 << 20
EPOCHS = 14
THRESHOLD = 0.3
_PAD = 256  # id of the padding byte
#: Chunks of one numpy step of scoring (25 MB at its peak; 98 MB at 1024) and of fitting.
BLOCK = 256
FIT_BLOCK = 512


@dataclass
class Network:
    embed: np.ndarray  # (257, EMBED)
    conv: np.ndarray  # (WIDTH * EMBED, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (4 * FILTERS,): chunk max and mean, each as document mean and maximum
    out_bias: float


def _chunk_bytes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(chunks, CHUNK) byte ids, padded at the end."""
    at = starts[:, None] + np.arange(CHUNK)
    ok = at < ends[:, None]
    if not len(raw):
        return np.full(at.shape, _PAD, np.int16)
    return np.where(ok, raw[np.minimum(at, len(raw) - 1)], _PAD).astype(np.int16)


def _patches(net: Network, ids: np.ndarray) -> np.ndarray:
    """(chunks, positions, WIDTH * EMBED)"""
    x = net.embed[ids].reshape(len(ids), CHUNK * EMBED)
    return np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, ::STRIDE * EMBED]


def _pooled(net: Network, ids: np.ndarray) -> np.ndarray:
    """(chunks, 2 * FILTERS): maximum and mean of the rectified filter answers."""
    p = _patches(net, ids)
    z = np.ascontiguousarray(p).reshape(-1, WIDTH * EMBED) @ net.conv + net.bias
    np.maximum(z, 0, out=z)
    z = z.reshape(len(ids), -1, FILTERS)
    return np.concatenate((z.max(1), z.mean(1)), 1)


def _spans(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the chunks that cover each document; an empty one has one."""
    size = np.diff(offsets)
    n = np.maximum(1, 1 + -(-(size - CHUNK) // STEP))
    doc = np.repeat(np.arange(len(size)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[:-1][doc] + k * STEP
    return doc, start, np.minimum(start + CHUNK, offsets[1:][doc])


def score(net: Network | None, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text; chunk features are folded block by block."""
    n = len(offsets) - 1
    if net is None:
        return np.full(n, 0.5)
    doc, start, end = _spans(offsets)
    total, most, count = np.zeros((n, 2 * FILTERS)), np.zeros((n, 2 * FILTERS)), np.bincount(doc, minlength=n)
    for a in range(0, len(doc), BLOCK):
        d = doc[a:a + BLOCK]
        f = _pooled(net, _chunk_bytes(raw, start[a:a + BLOCK], end[a:a + BLOCK])).astype(np.float64)
        first = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        total[d[first]] += np.add.reduceat(f, first)
        most[d[first]] = np.maximum(most[d[first]], np.maximum.reduceat(f, first))
    logit = np.concatenate((total / np.maximum(count, 1)[:, None], most), 1) @ net.out + net.out_bias
    return 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))


def _rectified(w: dict, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Patches as rows, and the rectified filter answers (chunks, positions, FILTERS)."""
    net = Network(w["embed"], w["conv"], w["bias"], w["out"], 0.0)
    p = np.ascontiguousarray(_patches(net, ids)).reshape(-1, WIDTH * EMBED)
    z = p @ w["conv"] + w["bias"]
    np.maximum(z, 0, out=z)
    return p, z.reshape(len(ids), -1, FILTERS)


def _gradient(w: dict, raw: np.ndarray, start: np.ndarray, end: np.ndarray, size: np.ndarray, label: np.ndarray, weight: np.ndarray, block: int) -> dict[str, np.ndarray]:
    """Gradient of a batch of documents with ``size`` chunks each, all of them, in blocks of chunks:
    the features are folded over the blocks, then each block's share is added."""
    n = int(size.sum())
    at = np.cumsum(size) - size
    doc = np.repeat(np.arange(len(size)), size)
    blocks = range(0, n, block)
    f, top = np.empty((n, 2 * FILTERS), np.float32), np.empty((n, FILTERS), np.int64)
    for a in blocks:
        ids = _chunk_bytes(raw, start[a:a + block], end[a:a + block])
        p, r = _rectified(w, ids)
        t = top[a:a + block] = r.argmax(1)
        f[a:a + block, :FILTERS] = np.take_along_axis(r, t[:, None], 1)[:, 0]
        f[a:a + block, FILTERS:] = r.mean(1)
    mean, most = np.add.reduceat(f, at) / size[:, None], np.maximum.reduceat(f, at)
    both = np.concatenate((mean, most), 1)
    logit = both @ w["out"] + w["out_bias"]
    g = (1 / (1 + np.exp(-logit)) - label) * weight / len(size)
    grad = {"out": both.T @ g, "out_bias": g.sum(keepdims=True), "conv": np.zeros_like(w["conv"], np.float64), "bias": np.zeros(FILTERS), "embed": np.zeros((257, EMBED))}
    dd = g[:, None] * w["out"]
    share = (f == most[doc]).astype(float)  # chunks overlap, so a maximum often lies in two of them
    share /= np.add.reduceat(share, at)[doc]
    df = dd[doc, :2 * FILTERS] / size[doc][:, None] + dd[doc, 2 * FILTERS:] * share
    for a in blocks:
        if len(blocks) > 1:  # a single block is still at hand
            ids = _chunk_bytes(raw, start[a:a + block], end[a:a + block])
            p, r = _rectified(w, ids)
        d = df[a:a + block]
        dz = np.broadcast_to(d[:, None, FILTERS:] / r.shape[1], r.shape).astype(np.float32)
        dz[np.arange(len(ids))[:, None], top[a:a + block], np.arange(FILTERS)] += d[:, :FILTERS]
        dz = (dz * (r > 0)).reshape(-1, FILTERS)
        grad["conv"] += p.T @ dz
        grad["bias"] += dz.sum(0)
        # a filter's bytes in steps of STRIDE, which is what neighbouring positions are apart
        dp = (dz @ w["conv"].T).reshape(len(ids), -1, WIDTH // STRIDE, STRIDE * EMBED)
        de = np.zeros((len(ids), CHUNK // STRIDE, STRIDE * EMBED), np.float32)
        for j in range(WIDTH // STRIDE):
            de[:, j:j + dp.shape[1]] += dp[:, :, j]
        de = de.reshape(len(ids), CHUNK, EMBED)
        flat = ids.reshape(-1)
        grad["embed"] += np.stack([np.bincount(flat, de[:, :, e].reshape(-1), 257) for e in range(EMBED)], 1)
    grad["embed"][_PAD] = 0
    return grad


def _fit(raw: np.ndarray, offsets: np.ndarray, label: np.ndarray, seed: int = 5) -> Network:
    """Adam on the logistic loss over all chunks of the texts ``raw[offsets[i]:offsets[i + 1]]``."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    w = {
        "embed": rng.normal(0, 0.5, (257, EMBED)).astype(f32), "conv": rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(f32),
        "bias": np.zeros(FILTERS, f32), "out": rng.normal(0, 0.1, 4 * FILTERS).astype(f32), "out_bias": np.zeros(1, f32),
    }
    w["embed"][_PAD] = 0
    m1, m2 = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    owner, start, end = _spans(offsets)
    first = np.searchsorted(owner, np.arange(len(label) + 1))
    weight = np.where(label == 1, 0.5 / max((label == 1).mean(), 1e-9), 0.5 / max((label == 0).mean(), 1e-9))
    weight = np.sqrt(weight)  # lean half-way towards balanced classes
    t = 0
    batch = 32
    for epoch in range(EPOCHS):
        order = rng.permutation(len(label))
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for a in range(0, len(order), batch):
            docs = order[a:a + batch]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            grad = _gradient(w, raw, start[rows], end[rows], first[docs + 1] - first[docs], label[docs], weight[docs], FIT_BLOCK)
            t += 1
            for k, v in grad.items():
                v = v.astype(f32)
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.99 * m2[k] + 0.01 * v * v
                w[k] -= (rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.99 ** t)) + 1e-6)).astype(f32)
    return Network(w["embed"], w["conv"], w["bias"], w["out"], float(w["out_bias"][0]))


def draw(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES) -> DataFrame:
    """(key, text, quality): whole texts of about ``rows`` rows of ``docs(doc_id, text)`` that
    ``labels(doc_id, quality)`` marks, half of each label where there are enough, drawn by the hash of
    the id, and in this order as many as hold ``size`` bytes in all (half for each label; an id of
    more is passed over)."""
    labels = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    have = {r.quality: r.n for r in labels.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = {k: min(1.0, rows / 2 / max(have.get(k, 0), 1)) for k in (0, 1)}
    some = labels.where(unit < F.when(F.col("quality") == 1, share[1]).otherwise(share[0]))  # about ``rows`` ids
    picked = stored(docs.join(F.broadcast(some), "doc_id").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"), "quality"), "sample")
    bytes_of = picked.groupBy("key", "quality").agg(F.sum(F.octet_length("text") + 1).alias("size")).where(F.col("size") <= size // 2)
    order = Window.partitionBy("quality").orderBy(F.xxhash64("key"), "key").rowsBetween(Window.unboundedPreceding, 0)
    fitting = bytes_of.withColumn("total", F.sum("size").over(order)).where(F.col("total") <= size // 2).select("key", "quality")
    return picked.join(F.broadcast(fitting), ["key", "quality"]).select("key", "text", "quality")


def train(sample: DataFrame) -> Network | None:
    """Fit on the whole texts of all rows of ``sample(key, text, quality)``, which must be bounded (see
    ``draw``): one task holds them. None if a label is missing."""
    rows = sample.select(F.col("key").cast("long").alias("key"), F.col("quality").cast("int").alias("quality"), F.coalesce("text", F.lit("")).alias("text"))

    def fit(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        got = pa.Table.from_batches(held)
        if len(got["quality"].unique()) < 2:
            return
        got = got.sort_by([(c, "ascending") for c in got.column_names])  # the same network whatever the task order
        net = _fit(*text_bytes(got["text"]), got["quality"].to_numpy().astype(float))
        out = io.BytesIO()
        np.savez(out, embed=net.embed, conv=net.conv, bias=net.bias, out=net.out, out_bias=net.out_bias)
        yield pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary())], ["net"])

    found = rows.repartition(1).mapInArrow(fit, "net binary").collect()
    if not found:
        return None
    with np.load(io.BytesIO(found[0].net)) as got:
        return Network(got["embed"], got["conv"], got["bias"], got["out"], float(got["out_bias"]))


def _scored(net: Network | None, batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batch, each with the scores of its texts (column ``at``)."""
    raw, offsets = text_bytes(batch.column(at))
    for a, b in slices(offsets):
        yield batch.slice(a, b - a), score(net, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])


def predict(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of ``docs(doc_id, text)``; only the text is scored."""

    def run(batches):
        for whole in batches:
            for b, s in _scored(net, whole, whole.schema.get_field_index("text")):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())],
                                                 ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose text scores ``threshold`` or more."""
    at = docs.columns.index("text")

    def run(batches):
        for whole in batches:
            for b, s in _scored(net, whole, at):
                yield b.filter(pa.array(s >= threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learn(spark: SparkSession, sf_dir: str) -> Network | None:
    """Network from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out(F.col("doc_id")))
    return train(draw(table(spark, sf_dir, "documents").select("doc_id", "text"), labels))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents").select("doc_id", "text"), learn(spark, sf_dir))
