"""Substring dedup by relative Lempel-Ziv parsing.

Every document is a reference block of an index over the whole corpus, and every document is factored
greedily against that index: at a word where a long enough match starts, the factor follows one
reference occurrence as far as it agrees, and the parse goes on after it. The words of factors of
``WINDOW`` words or more are duplicates. Matches that begin inside a factor and cross its boundary
are checked there against the whole index too, so nothing is missed by the greedy cut.

How it is spread: (1) every text is hashed to words and winnowed: of each 28 consecutive 8-word
grams the one with the least hash is an anchor, so equal 35-word windows have an equal anchor at the
same place. Equal word sequences (copies) are one block with a multiplicity. (2) Anchors are sorted
by hash; those seen once are dropped. (3) In blocks with anchors left, every window over such an
anchor gets a 128-bit hash; sorted by it, each window learns one reference occurrence (the first
elsewhere). (4) Per block, the windows in text order are parsed into factors, and their words are
removed. Runs of equal keys are streamed, never gathered: a passage in a third of all documents
costs what its rows cost, and no pairs are made.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null and empty texts have no words and keep the empty
text's hash. Repeated rows are copies of each other. Ids may be null or repeated, as blocks are
told apart by their words. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, list_array, mix, run_hashes, slices, sorted_runs, stored, table, text_bytes

WINDOW = 35
GRAM = 8
SPAN = WINDOW - GRAM + 1  # grams in a window
#: Rows of one run that are held at once.
RUN_ROWS = 50_000


def _gram_hashes(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every gram of ``width`` words, in order."""
    at, text = w.starts_of(width)
    return run_hashes(w.hash, at, at + width, 0), text


def _sliding(x: np.ndarray, span: int, op) -> np.ndarray:
    """op over each ``span`` consecutive values, by doubling."""
    width = 1
    while width * 2 <= span:
        x = op(x[:-width], x[width:])
        width *= 2
    return op(x[:len(x) - (span - width)], x[span - width:]) if span > width else x


def winnow(h: np.ndarray, text: np.ndarray, span: int) -> np.ndarray:
    """Sorted indices such that each ``span`` consecutive grams of one text have one with their least
    hash among them; a text with fewer grams has none, as no window fits. Of many equal least
    hashes in a row (a repeated passage) only every ``span``-th stays."""
    n = len(h)
    if n < span:
        return np.zeros(0, int)
    least = _sliding(h, span, np.minimum)
    least[text[span - 1:] != text[:n - span + 1]] = 0
    pad = np.zeros(span - 1, np.uint64)
    best = _sliding(np.concatenate((pad, least, pad)), span, np.maximum)  # over the windows around each gram
    pick = np.flatnonzero((h == best) & (best > 0))
    if not len(pick):
        return pick
    chain = np.flatnonzero(np.append(True, (h[pick[1:]] != h[pick[:-1]]) | (text[pick[1:]] != text[pick[:-1]])))
    size = np.diff(np.append(chain, len(pick)))
    keep = np.ones(len(pick), bool)
    for a, k in zip(chain[size > 2], size[size > 2], strict=True):
        own = pick[a:a + k]
        keep[a + 1:a + k - 1] = False
        at = 0
        while at < k - 1:
            at = max(at + 1, int(np.searchsorted(own, own[at] + span, "right")) - 1)
            keep[a + at] = True
    return pick[keep]


def _anchors(batches):
    """Per row: words, hash of its kept words, identity of its word sequence, anchors."""
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        n_words, sha, block, hashes, places = [], [], [], [], []
        for p, q in slices(offsets):
            part, off = raw[offsets[p]:offsets[q]], offsets[p:q + 1] - offsets[p]
            w = Words(part, off)
            data = part.tobytes()
            h, text = _gram_hashes(w, GRAM)
            first = np.searchsorted(text, np.arange(q - p + 1))
            pick = winnow(h, text, SPAN)
            cut = np.searchsorted(pick, first)
            for i in range(q - p):
                whole = b" ".join(data[off[i]:off[i + 1]].split())
                n = int(w.at[i + 1] - w.at[i])
                sha.append(hashlib.sha256(whole).hexdigest())
                n_words.append(n)
                mine = pick[cut[i]:cut[i + 1]]
                hashes.append(h[mine].view(np.int64))
                places.append((mine - first[i]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(n_words, pa.int64()), pa.array(sha, pa.string()), list_array(hashes), list_array(places, pa.int32())],
                                         ["doc_id", "text_hash", "n_words", "sha", "hash", "pos"])


def _combine(batches):
    """Map-side combine of (hash, block, pos): a hash that occurs again in the batch is known to be
    repeated, so only one of its rows has to travel. again: repeated here; sent: to be counted."""
    for b in batches:
        h = b.column("hash").to_numpy()
        order = np.argsort(h, kind="stable")
        new = np.append(True, h[order][1:] != h[order][:-1])
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(h)))
        again, sent = np.empty(len(h), bool), np.empty(len(h), bool)
        again[order], sent[order] = np.repeat(n > 1, n), new
        keep = again | sent
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in b.columns] + [pa.array(again[keep]), pa.array(sent[keep])], ["hash", "block", "pos", "again", "sent"])


def _repeated(batches):
    """(block, pos) of the rows (hash, block, pos, again) whose hash occurs again, here for the first time."""
    for cols, _, n, more in sorted_runs(batches, 1, RUN_ROWS):
        keep = np.repeat((n > 1) | (more > 0), n) & ~cols[3].astype(bool)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(cols[1][keep], pa.int64()), pa.array(cols[2][keep], pa.int32())], ["block", "pos"])


_MATCH = "block long, pos int, ref_block long, ref_pos int, length int"
_WINDOW_COLUMNS = ["h1", "h2", "block", "pos", "ref_block", "ref_pos", "length", "done"]


def _rows(h1, h2, block, pos, ref_block, ref_pos, length, done):
    for a in range(0, len(block), 50_000):
        part = slice(a, a + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(c[part], k) for c, k in zip((h1, h2, block, pos, ref_block, ref_pos, length, done), (
            pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()), strict=True)], _WINDOW_COLUMNS)


def _windows(batches):
    """The windows over matched anchors, combined map-side. Windows that start again inside the batch
    are matched here and leave as factors (length: windows in it; h1 and h2 0); of each distinct
    window one row leaves to be compared with other batches (length 0)."""
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        blocks, anchors = b.column("block").to_numpy(), b.column("anchors")
        found = []
        for p, q in slices(offsets):
            w = Words(raw[offsets[p]:offsets[q]], offsets[p:q + 1] - offsets[p])
            mask = np.zeros(len(w.hash) + 1, np.int32)
            last = np.diff(w.at) - WINDOW  # last window start of each text
            for i in range(q - p):
                if last[i] < 0:
                    continue
                a = np.asarray(anchors[p + i].values.to_numpy(zero_copy_only=False), int)
                lo, hi = np.maximum(a - SPAN + 1, 0), np.minimum(a, last[i]) + 1
                ok = lo < hi
                np.add.at(mask, w.at[i] + lo[ok], 1)
                np.add.at(mask, w.at[i] + hi[ok], -1)
            at = np.flatnonzero(np.cumsum(mask)[:-1] > 0)
            text = np.searchsorted(w.at, at, "right") - 1
            h1, h2 = run_hashes(w.hash, at, at + WINDOW, 0), run_hashes(mix(w.hash, 3), at, at + WINDOW, 1)
            found.append((h1.view(np.int64), h2.view(np.int64), blocks[p + text], (at - w.at[text]).astype(np.int32)))
        h1, h2, block, pos = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 4
        n = len(h1)
        if not n:
            continue
        order = np.lexsort((h2, h1))  # stable: equal windows stay in text order
        s1, s2 = h1[order], h2[order]
        new = np.append(True, (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1]))
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, n))
        ref = np.repeat(at, size)
        ref[at[size > 1]] += 1  # the first refers to the second
        refs, again = np.empty(n, int), np.empty(n, bool)
        refs[order], again[order] = order[ref], np.repeat(size > 1, size)
        first = order[at]
        zero = np.zeros(len(first), np.int64)
        yield from _rows(h1[first], h2[first], block[first], pos[first], zero, zero, zero, again[first])
        own = np.flatnonzero(again)
        if len(own):
            start, length = _factors(block[own], pos[own], block[refs[own]], pos[refs[own]], np.ones(len(own), int))
            i = own[start]
            zero = np.zeros(len(i), np.int64)
            yield from _rows(zero, zero, block[i], pos[i], block[refs[i]], pos[refs[i]], length, np.ones(len(i), bool))


def _references(batches):
    """Matches of the windows (h1, h2, block, pos, done) that start in another batch too. The
    reference is the first row of the run (of its first part), for that one itself the second."""
    seen = None  # the first occurrence of a run that comes in parts
    for cols, at, n, more in sorted_runs(batches, 2, RUN_ROWS):
        _, _, block, pos, done = cols
        first = np.repeat(at, n)
        ref_b, ref_p = block[first].copy(), pos[first].copy()
        if more == 1:
            seen = (block[0], pos[0])
        if more == 2 and seen is not None:
            ref_b[:], ref_p[:] = seen
        else:
            two = at[n > 1]
            ref_b[two], ref_p[two] = block[two + 1], pos[two + 1]
        keep = np.repeat((n > 1) | (more > 0), n) & ~done.astype(bool)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(block[keep], pa.int64()), pa.array(pos[keep], pa.int32()), pa.array(ref_b[keep], pa.int64()), pa.array(ref_p[keep], pa.int32()),
                                              pa.array(np.ones(int(keep.sum()), np.int32))], ["block", "pos", "ref_block", "ref_pos", "length"])


def _factors(block, pos, ref_block, ref_pos, length) -> tuple[np.ndarray, np.ndarray]:
    """Greedy parse of matches in text order: (index of each factor's first match, windows in it). A
    factor follows its reference while the next match goes on there; where that ends, the windows
    that cross the boundary start factors of their own."""
    goes_on = (block[1:] == block[:-1]) & (pos[1:] == pos[:-1] + length[:-1]) & (ref_block[1:] == ref_block[:-1]) & (ref_pos[1:] == ref_pos[:-1] + length[:-1])
    first = np.flatnonzero(np.append(True, ~goes_on))
    return first, np.add.reduceat(length, first)


def _sha_without(batches):
    """Per block: factors, removed words and the hash of the words kept."""
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        removed, sha, factors = [], [], []
        for i in range(b.num_rows):
            words = raw[offsets[i]:offsets[i + 1]].tobytes().split()
            m = b.column("m")[i].values
            got = [m.field(k).to_numpy(zero_copy_only=False).astype(int) for k in range(4)]
            order = np.argsort(got[0], kind="stable")
            pos, ref_block, ref_pos, length = (g[order] for g in got)
            first, size = _factors(np.zeros(len(pos), int), pos, ref_block, ref_pos, length)
            found = list(zip(pos[first].tolist(), (pos[first] + size - 1 + WINDOW).tolist(), ref_block[first].tolist(), ref_pos[first].tolist(), strict=True))
            gone = np.zeros(len(words), bool)
            for x, e, _, _ in found:
                gone[x:e] = True
            removed.append(int(gone.sum()))
            sha.append(hashlib.sha256(b" ".join(x for x, g in zip(words, gone, strict=True) if not g)).hexdigest())
            factors.append([{"start": f[0], "end": f[1], "ref_block": f[2], "ref_start": f[3]} for f in found])
        yield pa.RecordBatch.from_arrays([b.column("block"), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                                          pa.array(factors, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("ref_block", pa.int64()), ("ref_start", pa.int32())])))],
                                         ["block", "n_removed", "kept", "factors"])


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, factors) of ``docs(doc_id, text)``: factors are the
    duplicate spans (word start and end) with the block and word they were found at."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    rows = docs.mapInArrow(_anchors, "doc_id long, text_hash long, n_words long, sha string, hash array<long>, pos array<int>")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rlz-anchors")
    # a block is a distinct word sequence; its id is that of its first row
    blocks = stored(rows.groupBy("sha").agg(F.min("row").alias("block"), F.count("*").alias("copies"), F.min("n_words").alias("block_words")), "rlz-blocks")
    own = rows.join(blocks.select("block"), F.col("row") == F.col("block"), "left_semi")
    spread = own.select(F.col("row").alias("block"), F.explode(F.arrays_zip("hash", "pos")).alias("a")).select("a.hash", "block", "a.pos")
    spread = stored(spread.mapInArrow(_combine, "hash long, block long, pos int, again boolean, sent boolean"), "rlz-postings")
    sent = spread.where("sent").select("hash", "block", "pos", "again").repartition("hash").sortWithinPartitions("hash")
    again = sent.mapInArrow(_repeated, "block long, pos int").unionByName(spread.where("again").select("block", "pos"))
    anchors = again.groupBy("block").agg(F.collect_list("pos").alias("anchors"))  # a text's anchors at most
    place = rows.select(F.col("row").alias("block"), F.col("doc_id").alias("b_id"), F.col("text_hash").alias("b_hash"))
    anchored = anchors.join(place, "block")
    texts = docs.join(anchored, (F.col("text_hash") == F.col("b_hash")) & F.col("doc_id").eqNullSafe(F.col("b_id"))).select("block", "text", "anchors")
    texts = stored(texts, "rlz-texts")

    found = stored(texts.mapInArrow(_windows, "h1 long, h2 long, block long, pos int, ref_block long, ref_pos int, length int, done boolean"), "rlz-windows")
    far = found.where("length = 0").select("h1", "h2", "block", "pos", "done").repartition("h1").sortWithinPartitions("h1", "h2", "block", "pos")
    matches = found.where("length > 0").select("block", "pos", "ref_block", "ref_pos", "length").unionByName(far.mapInArrow(_references, _MATCH))
    # copies of a block match each other in all their windows: nothing is left of them
    whole = blocks.where((F.col("copies") > 1) & (F.col("block_words") >= WINDOW))
    single = blocks.where("copies = 1").select("block")
    per_block = matches.groupBy("block").agg(F.collect_list(F.struct("pos", "ref_block", "ref_pos", "length")).alias("m")).join(single, "block", "left_semi")
    cleaned = per_block.join(texts.select("block", "text"), "block").mapInArrow(
        _sha_without, "block long, n_removed long, kept string, factors array<struct<start:int,end:int,ref_block:long,ref_start:int>>")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("block_words").cast("int").alias("end"), F.col("block").alias("ref_block"), F.lit(0).alias("ref_start")))
    gone = whole.select("block", F.col("block_words").alias("n_removed"), empty.alias("kept"), all_of_it.alias("factors")).unionByName(cleaned)
    result = blocks.join(gone, "block", "left").select("sha", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"), "factors")
    return rows.select("doc_id", "n_words", "sha").join(result, "sha").select("doc_id", "n_words", "n_removed", "kept_sha256", "factors")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
