"""Secret scans by corpus-wide ownership frequency.

Fixed patterns find the base spans of every whole text. A span's value counts without the separators
``. = / + -`` at its ends, so that a full stop after it makes no second value. A first pass takes the
distinct shapes (pieces between separators, length) of the base values from LIVE_MIN characters on;
a second one looks for their bare copies: every run of pieces of such a shape outside the base spans
becomes a candidate (a 128-bit hash each), whatever its characters, and the join with the base values
rejects the others. Candidates are aggregated over the whole corpus by distinct owners and
repositories: a value that several owners carry is a widely copied example; one that stays with a
single owner and looks random is a live-looking credential. The method then adds the bare occurrences
of live-looking values.

``source`` stands for the owner and, with ``lang``, for the repository (``owner`` and ``repo`` name
other columns). A null owner is an owner of its own. Null texts are empty; they and texts without
secrets have zero counts, an empty span list and the hash of the empty string. Repeated rows are
scanned row by row (their values still count once per owner). Only slim candidate rows are shuffled,
pre-aggregated by hash and owner; the hot value of a third of the corpus is joined back by a plain
join that adaptive execution can split.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

# The three base kinds in their listing order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 or more: a match takes its whole run
HEX = re.compile(r"[0-9a-f]{24,}")  # [0-9a-f]+ of 24 or more: likewise
ASSIGN_MIN = 6
#: An assignment has one of these in some case; a cheap test before the pattern.
HINTS = ("passw", "secret", "token", "api_key", "apikey")

#: Tokens that may hold a bare copy of a value, the separators in them and the pieces between.
SEPARATORS = ".=/+-"
PIECE = re.compile(r"[A-Za-z0-9_]+", re.ASCII)
ADDED = "owned"
#: From this number of distinct owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
#: Bits per character from which a value looks random, and its least length.
LIVE_BITS = 2.5
LIVE_MIN = 12
TOKEN = re.compile(rf"[A-Za-z0-9+/_.=-]{{{LIVE_MIN},}}")


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind number, end, value start, value end), sorted by start, then kind."""
    out = []
    low = text.lower()
    if any(h in low for h in HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_MIN:
                out.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def looks_live(value: str) -> bool:
    """Long and random enough: entropy per character from LIVE_BITS on."""
    n = len(value)
    return n >= LIVE_MIN and -sum(c / n * log2(c / n) for c in Counter(value).values()) >= LIVE_BITS


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def normal(value: str) -> str:
    """The value without separators at its ends; one of separators only stays."""
    return value.strip(SEPARATORS) or value


def _shapes(batches):
    for b in batches:
        out = set()
        for text in b.column("text").to_pylist():
            for _, _, _, a, e in base_spans(text or ""):
                value = normal(text[a:e])
                if len(value) >= LIVE_MIN:
                    out.add((len(PIECE.findall(value)), len(value)))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int32()) for k in range(2)], ["pieces", "size"])


def bare_spans(text: str, base: list[tuple[int, int, int, int, int]], shapes: dict[int, set[int]]):
    """(start, end) of the runs of pieces in one token that have one of ``shapes`` (lengths by number
    of pieces) and overlap no base span. The work grows with the pieces times the distinct numbers."""
    merged: list[list[int]] = []
    for a, _, e, _, _ in base:
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([a, e])
    starts = [a for a, _ in merged]
    for m in TOKEN.finditer(text):
        pieces = [p.span() for p in PIECE.finditer(text, *m.span())]
        for n, sizes in shapes.items():
            for i in range(len(pieces) - n + 1):
                a, e = pieces[i][0], pieces[i + n - 1][1]
                if e - a in sizes:
                    at = bisect_left(starts, e) - 1  # the last base span that starts before the end
                    if at < 0 or merged[at][1] <= a:
                        yield a, e


_CANDIDATE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("base", pa.bool_()), ("live", pa.bool_())])


def _scan(batches, shapes):
    for b in batches:
        counts, sha, spans, found = [], [], [], []
        for text in b.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            n = [0, 0, 0]
            for s in base:
                n[s[1]] += 1
            counts.append(n)
            said = ",".join(f"{KINDS[k]}:{a}:{e}" for a, k, e, _, _ in base)
            sha.append(hashlib.sha256(said.encode()).hexdigest())
            spans.append([{"start": a, "kind": k, "text": f"{KINDS[k]}:{a}:{e}"} for a, k, e, _, _ in base])
            cands = {(a, e): True for _, _, _, a, e in base} | dict.fromkeys(bare_spans(text, base, shapes), False)
            values = [normal(text[a:e]) for a, e in cands]
            found.append([{"start": a, "end": e, "hash": _digest(v), "base": x, "live": looks_live(v)} for ((a, e), x), v in zip(cands.items(), values, strict=True)])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("owner"), b.column("repo"), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)), pa.array(sha, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("text", pa.string())]))), pa.array(found, pa.list_(_CANDIDATE))],
            ["doc_id", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "base", "found"])


def scan(docs: DataFrame, owner: Column | None = None, repo: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, values): one row per row of ``docs(doc_id, text, ...)`` with its base and added
    spans, and one row per base value: hash, owners, repositories, occurrences, class (``example``,
    ``live`` or ``other``)."""
    owner = F.col("source") if owner is None else owner
    repo = F.concat_ws("/", owner, F.col("lang")) if repo is None else repo
    rows = docs.select("doc_id", "text", owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    shapes: dict[int, set[int]] = {}
    for r in docs.select("text").mapInArrow(_shapes, "pieces int, size int").where("pieces > 0").distinct().collect():  # two small numbers each
        shapes.setdefault(r.pieces, set()).add(r.size)
    rows = rows.mapInArrow(lambda batches: _scan(batches, shapes), "doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                  "base array<struct<start:int,kind:int,text:string>>, "
                                  "found array<struct<start:int,end:int,hash:binary,base:boolean,live:boolean>>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")
    found = rows.where(F.size("found") > 0).select("row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    by_owner = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"), F.sum(F.col("base").cast("long")).alias("n_base"), F.first("live").alias("live"))
    by_owner = by_owner.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"), F.sum("n_base").alias("n_base"), F.first("live").alias("live"))
    values = by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repositories"), F.sum("n").alias("occurrences"),
                                          F.sum("n_base").alias("n_base"), F.first("live").alias("live")).where("n_base > 0")
    kind = F.when(F.col("owners") >= EXAMPLE_OWNERS, "example").when((F.col("owners") == 1) & F.col("live"), "live").otherwise("other")
    values = stored(values.select("hash", "owners", "repositories", "occurrences", kind.alias("class")), "secret-values")

    judged = found.join(values.select("hash", "class"), "hash").select("row", "start", "end", "base", "class")
    added = F.when((F.col("class") == "live") & ~F.col("base"), F.struct("start", F.lit(len(KINDS)).alias("kind"), F.concat_ws(":", F.lit(ADDED), "start", "end").alias("text")))
    per_row = judged.groupBy("row").agg(F.collect_list(added).alias("added"), F.count_if((F.col("class") == "live") & F.col("base")).alias("n_live"),
                                        F.count_if((F.col("class") == "example") & F.col("base")).alias("n_example"))
    no_spans = F.array().cast("array<struct<start:int,kind:int,text:string>>")
    spans = F.array_join(F.transform(F.sort_array(F.concat("base", F.coalesce("added", no_spans))), lambda s: s["text"]), ",")
    zero = F.lit(0).cast("long")
    out = rows.drop("found").join(per_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", spans.alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"))
    return out, values


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs.select("doc_id", "text", "source", "lang"))[0]
