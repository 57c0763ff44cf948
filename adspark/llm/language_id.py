"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in Spark (per-task dense counts, summed by language and
bucket); the log-probability matrix (languages x buckets, a fixed size per language) goes to the
tasks with the scoring function. A batch of texts becomes a sparse row-pointer matrix of bucket
ids, whose scores are gathered and summed per row in numpy. Long texts are cut into pieces whose
sums add up; a piece also holds what its last n-grams reach over, so the counts are those of the
uncut text, memory is bounded and whole texts count.

Defined results: a null text or one without a letter is ``und`` with score 0; without any labelled
row every text is ``und``; equal posteriors go to the first language by code point. A null id
counts as held out. Repeated rows are scored row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, table

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Code points that one numpy step works on.
PIECE = 1 << 19
#: Training rows per language (expected number; rows are drawn by the hash of their id).
TRAIN_ROWS = 4000

UND = "und"


@dataclass
class Model:
    """languages in code point order; log_prob[language][bucket]; log_prior[language]."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray


_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.char.isalpha(np.arange(0x110000, dtype=np.uint32).view("U1"))
    return _LETTERS


def _buckets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row ids, row pointers, bucket ids): the n-grams of the given texts, piece by piece.

    Each text is lower-cased, its non-letters become blanks, and it is framed by blanks, so that no
    n-gram crosses texts; n-grams without a letter are left out (bucket ``BUCKETS``)."""
    top = max(ORDERS) - 1
    pending: list[str] = []
    ids: list[int] = []
    total = 0

    def counted():
        code = np.frombuffer(("".join(pending) + " " * top).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.cumsum([0] + [len(t) for t in pending])
        is_letter = _letters()[code]
        c = np.where(is_letter, code, np.uint32(32)).astype(np.uint32)
        n = int(at[-1])
        grams = np.empty((n, len(ORDERS)), np.int32)
        inside = np.ones(n, bool)
        for k in range(1, top + 1):
            inside[at[1:] - k] = False  # n-grams that start here belong to the next piece, or are blank
        h = np.zeros(n, np.uint32)
        some = np.zeros(n, bool)
        for k in range(top + 1):
            h = (h ^ c[k:k + n]) * np.uint32(0x01000193) + np.uint32(0x9E3779B9)
            some |= is_letter[k:k + n]
            if k + 1 in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                g = (mixed >> np.uint32(17)).astype(np.int32)
                grams[:, ORDERS.index(k + 1)] = np.where(some & inside, g, BUCKETS)
        return np.array(ids), at[:-1] * len(ORDERS), grams.reshape(-1)

    for i, t in enumerate(texts):
        framed = " " + t.lower() + " " * top
        for a in range(0, len(framed) - top, PIECE):
            part = framed[a:a + PIECE + top]  # PIECE starts and what they reach over
            pending.append(part)
            ids.append(i)
            total += len(part)
            if total >= PIECE:
                yield counted()
                pending, ids, total = [], [], 0
    if pending:
        yield counted()


def train(labelled: DataFrame, rows_per_language: int = TRAIN_ROWS) -> Model:
    """Fit on a sample of ``labelled(key, text, lang)`` of about ``rows_per_language`` rows for each
    language, drawn by the hash of the key. The matrix has one row of BUCKETS doubles a language."""
    rows = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(rows)
    if not languages:
        return Model([], np.zeros((0, BUCKETS + 1)), np.zeros(0))
    share = F.create_map([x for lang, n in rows.items() for x in (F.lit(lang), F.lit(min(1.0, rows_per_language / n)))])
    unit = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / float(1 << 30)
    index = {lang: i for i, lang in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), BUCKETS + 1), np.int64)
        for b in batches:
            lang = np.array([index[x] for x in b.column("lang").to_pylist()], int)
            for ids, at, grams in _buckets(b.column("text").to_pylist()):
                owner = lang[np.repeat(ids, np.diff(np.append(at, len(grams))))]
                total += np.bincount(owner * (BUCKETS + 1) + grams, minlength=total.size).reshape(total.shape)
        i, j = np.nonzero(total[:, :BUCKETS])
        for a in range(0, len(i), 10000):
            p, q = i[a:a + 10000], j[a:a + 10000]
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(q, pa.int32()), pa.array(total[p, q], pa.int64())], ["lang", "bucket", "n"])

    sample = labelled.where(unit < share[F.col("lang")]).select("lang", "text")
    counts = sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    dense = np.ones((len(languages), BUCKETS + 1))  # add-one smoothing
    dense[counts.lang.to_numpy(), counts.bucket.to_numpy()] += counts.n.to_numpy()
    log_prob = np.log(dense) - np.log(dense[:, :BUCKETS].sum(1, keepdims=True))
    log_prob[:, BUCKETS] = 0.0
    prior = np.log(np.array([rows[x] for x in languages], float) / sum(rows.values()))
    return Model(languages, log_prob, prior)


def score(model: Model, texts: list[str]) -> np.ndarray:
    """Log joint probability of each text and language."""
    out = np.tile(model.log_prior, (len(texts), 1))
    for ids, at, grams in _buckets(texts):
        for k, row in enumerate(model.log_prob):
            np.add.at(out[:, k], ids, np.add.reduceat(row[grams], at))
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of ``docs(doc_id, text)``; only the text is scored."""
    languages = [*model.languages, UND]
    und = len(model.languages)

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                has = part.column("has_letter").to_numpy(zero_copy_only=False).astype(bool) & (und > 0)
                best, prob = np.full(len(has), und), np.zeros(len(has))
                if has.any():
                    s = score(model, [t for t, x in zip(part.column("text").to_pylist(), has, strict=True) if x])
                    top = s.max(1, keepdims=True)
                    best[has], prob[has] = s.argmax(1), 1.0 / np.exp(s - top).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array([languages[i] for i in best], pa.string()), pa.array(prob, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").rlike(r"\p{L}").alias("has_letter"), "text")
    rows = rows.withColumn("has_letter", F.coalesce("has_letter", F.lit(False)))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labelled = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return predict(docs, train(labelled.select(F.col("doc_id").alias("key"), "text", "lang")))
