"""Phrase collocations by HAT-trie counting.

Each task counts phrases in a burstable trie: below the id of the first word lies a hash container
of the remaining word ids; a container that outgrows BURST entries becomes a trie level over the
next word with containers of its own. A trie that reaches MAX_ENTRIES spills whole first-word
subtrees, the largest first, as runs sorted by phrase (Parquet in the shared folder). The runs are
merged per prefix partition: ranges of (lang, phrase), whose borders follow the data, so a frequent
first word is cut into more ranges at its second word, and equal phrases are summed.

Counting goes by length. A phrase that is frequent has only frequent parts, so pairs are counted of
frequent words, and phrases of three and four words where all their pairs are frequent; nothing
that could be a candidate is left out. What is frequent reaches the tasks as a bit table of fixed
size (FILTER_BITS): it may let rare phrases pass, which the exact counts then remove, never the
reverse.

Defined results: texts are lower-cased in A-Z, split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``; no phrase crosses a piece. A null text has no words, a null
lang is ``und``. Repeated rows and documents count each time; ids are not used. Texts of any length
are worked on in parts that overlap by the longest phrase. Ties of score and count go to the
phrase that is less in UTF-8 bytes. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter as Container

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, mix, run_hashes, slices, stored, table, text_bytes

LONGEST = 4
MIN_COUNT, TOP = 30, 2000
#: Share (in 100ths) of a phrase's occurrences inside one longer phrase from which it is dropped.
INSIDE = 80
BURST, MAX_ENTRIES, MAX_WORDS = 1 << 15, 1_000_000, 500_000
#: Low bits of a head that share one container until it bursts.
SHARED = 8
FILTER_BITS = 1 << 26
#: Bits of a word id in a packed key; ids stay below MAX_WORDS plus the words of one slice.
ID_BITS = 21
ID_MASK = (1 << ID_BITS) - 1

PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_IS_END = np.zeros(256, bool)
_IS_END[list(PIECE_ENDS)] = True
_IS_GAP = _IS_END.copy()
_IS_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = mix(np.arange(256, dtype=np.uint64), 7)


# ---------------------------------------------------------------------------------------------
# Words of pieces


class Tokens:
    """Words of texts in order: byte range, hash, piece number and text number of each."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = _LOWER[raw]
        inside = ~_IS_GAP[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        begin, finish = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        finish[:-1] &= ~inside[1:] | edge[1:-1]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        self.piece = np.cumsum(_IS_END[raw])[self.start] + self.text
        self.hash = run_hashes(_VALUE[self.raw], self.start, self.end)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]].tobytes()


def _parts(raw: np.ndarray, offsets: np.ndarray):
    """(tokens, first text, words to count from): slices of whole texts; a longer text in parts cut
    between words, each with the words that its last phrases need from the next part."""
    for a, b in slices(offsets, SLICE_BYTES):
        s, e = int(offsets[a]), int(offsets[b])
        if e - s <= 2 * SLICE_BYTES:
            tokens = Tokens(raw[s:e], offsets[a:b + 1] - s)
            yield tokens, a, len(tokens.start)
            continue
        gap = np.flatnonzero(_IS_GAP[raw[s:e]]) + s
        while s < e:
            k = np.searchsorted(gap, s + SLICE_BYTES)
            cut = int(gap[k]) if k < len(gap) else e
            until, words, wide, step = cut, 0, k, 64
            while until < e and words < LONGEST:  # words that end behind the cut
                wide, step = min(wide + step, len(gap)), 2 * step
                until = int(gap[wide - 1]) if wide < len(gap) else e
                words = len(Tokens(raw[cut:until], np.array([0, until - cut])).start)
            tokens = Tokens(raw[s:until], np.array([0, until - s]))
            yield tokens, a, int(np.searchsorted(tokens.start, cut - s))
            s = cut


def _lang_keys(langs: list[str]) -> np.ndarray:
    raw, off = text_bytes(pa.array(langs, pa.large_string()))
    return run_hashes(_VALUE[raw], off[:-1], off[1:], 1)


def _pair_keys(key: np.ndarray) -> np.ndarray:
    """One key per word with the word after it."""
    out = np.zeros(len(key), np.uint64)
    out[:-1] = mix(key[:-1] * np.uint64(0x9E3779B97F4A7C15) + key[1:], 3)
    return out


def _known(bits: np.ndarray | None, key: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(key), bool)
    at = key & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


# ---------------------------------------------------------------------------------------------
# The trie


class Level:
    """Children by word id: hash containers (packed rest: count), or levels where one has burst.

    ``shared``: so many low bits of the head stay in the packed key, so that the containers of a
    level over many rare heads serve several heads each; a burst gives each head its own."""

    __slots__ = ("kids", "shared", "size")

    def __init__(self, shared: int = 0):
        self.kids: dict[int, Container | Level] = {}
        self.size, self.shared = 0, shared

    def add(self, head: np.ndarray, rest: np.ndarray, left: int) -> None:
        """One occurrence each; ``left`` words are packed in ``rest``."""
        if self.shared:
            rest, head, left = rest | (head & ((1 << self.shared) - 1)) << ID_BITS * left, head >> self.shared, left + 1
        order = np.argsort(head)
        head, rest = head[order], rest[order]
        at = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        rests = rest.tolist()
        for h, s, e in zip(head[at].tolist(), at.tolist(), [*at[1:].tolist(), len(rests)], strict=True):
            kid = self.kids.get(h)
            if kid is None:
                kid = self.kids[h] = Container()
            before = kid.size if isinstance(kid, Level) else len(kid)
            if isinstance(kid, Level):
                shift = ID_BITS * (left - 1)
                kid.add(rest[s:e] >> shift, rest[s:e] & ((1 << shift) - 1), left - 1)
                self.size += kid.size - before
                continue
            kid.update(rests[s:e])
            self.size += len(kid) - before
            if len(kid) > BURST and left > 1:
                self.kids[h] = self.burst(kid, left)

    @classmethod
    def burst(cls, kid: Container, left: int) -> Level:
        """A level over the next word with a container for each."""
        r, n = cls.items(kid)
        shift, out = ID_BITS * (left - 1), cls()
        order = np.argsort(r)
        r, n = r[order], n[order]
        head, rest, count = r >> shift, (r & ((1 << shift) - 1)).tolist(), n.tolist()
        at = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        for h, s, e in zip(head[at].tolist(), at.tolist(), [*at[1:].tolist(), len(rest)], strict=True):
            out.kids[h] = Container(dict(zip(rest[s:e], count[s:e], strict=True)))
        out.size = len(rest)
        return out

    @staticmethod
    def items(kid: Container) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(kid.keys(), np.int64, len(kid)), np.fromiter(kid.values(), np.int64, len(kid))

    def rows(self, kid, left: int) -> tuple[np.ndarray, np.ndarray]:
        """(packed rest, count) of one child."""
        if not isinstance(kid, Level):
            return self.items(kid)
        shift, out = ID_BITS * (left - 1), []
        for h, below in kid.kids.items():
            r, n = kid.rows(below, left - 1)
            out.append((r | (h << shift), n))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def take(self, most: int, left: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Removes whole subtrees, the largest first, until at most ``most`` entries are left:
        (head, packed rest, count)."""
        sizes = sorted(((kid.size if isinstance(kid, Level) else len(kid), h) for h, kid in self.kids.items()), reverse=True)
        heads, rests, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, h in sizes:
            if self.size <= most:
                break
            r, c = self.rows(self.kids.pop(h), left + 1 if self.shared else left)
            heads.append(h << self.shared | r >> ID_BITS * left if self.shared else np.full(len(r), h))
            rests.append(r & ((1 << ID_BITS * left) - 1))
            counts.append(c)
            self.size -= n
        return np.concatenate(heads), np.concatenate(rests), np.concatenate(counts)


class Phrases:
    """The trie of one task, its words and its runs. words: phrase lengths (1, 2, or 3 with 4)."""

    def __init__(self, words: int):
        self.words, self.left = words, {1: 0, 2: 1, 3: LONGEST - 1}[words]
        self.clear()

    def clear(self) -> None:
        self.trie, self.ids, self.text, self.lang = Level(SHARED if self.left < 2 else 0), {}, [], []
        self.seen = np.zeros(0, np.int64)  # single words need no trie: a count per id

    def word_ids(self, key: np.ndarray, tokens: Tokens, langs: list[str], use: np.ndarray) -> np.ndarray:
        """Id of each word in ``use`` (of its language), new ones recorded."""
        out = np.zeros(len(key), np.int64)
        unique, first, back = np.unique(key[use], return_index=True, return_inverse=True)
        first = np.flatnonzero(use)[first]
        ids = np.zeros(len(unique), np.int64)
        for i, (k, at) in enumerate(zip(unique.tolist(), first.tolist(), strict=True)):
            have = self.ids.get(k)
            if have is None:
                have = self.ids[k] = len(self.text)
                self.text.append(tokens.word(at))
                self.lang.append(langs[tokens.text[at]])
            ids[i] = have
        out[use] = ids[back]
        return out

    def add_words(self, ids: np.ndarray) -> None:
        more = np.bincount(ids, minlength=len(self.text))
        more[:len(self.seen)] += self.seen
        self.seen = more

    def add(self, head: np.ndarray, rest: np.ndarray) -> None:
        if len(head):
            self.trie.add(head, rest, self.left)

    def runs(self, everything: bool):
        """Sorted runs of spilled subtrees, as batches (lang, phrase, words, n)."""
        if not everything and self.trie.size <= MAX_ENTRIES and len(self.text) <= MAX_WORDS:
            return
        full = everything or len(self.text) > MAX_WORDS
        head, rest, n = self.trie.take(0 if full else MAX_ENTRIES // 2, self.left)
        text, lang = pa.array(self.text, pa.binary()), pa.array(self.lang, pa.string())
        parts = []
        if self.words == 1:
            parts.append((1, np.flatnonzero(self.seen), self.seen[self.seen > 0]))
        elif self.words == 2:
            parts.append((2, head, rest, n))
        else:  # three words: the sum below their node
            second, third, fourth = rest >> 2 * ID_BITS, (rest >> ID_BITS) & ID_MASK, rest & ID_MASK
            order = np.lexsort((third, second, head))
            h, s, t = head[order], second[order], third[order]
            if len(h):
                at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (s[1:] != s[:-1]) | (t[1:] != t[:-1]))))
                parts.append((3, h[at], s[at], t[at], np.add.reduceat(n[order], at)))
            four = fourth > 0
            parts.append((4, head[four], second[four], third[four], fourth[four], n[four]))
        for words, *ids, count in parts:
            some = [text.take(pa.array(ids[0]))] + [text.take(pa.array(i - 1)) for i in ids[1:]]
            phrase = pc.binary_join_element_wise(*some, b" ").cast(pa.string()) if words > 1 else some[0].cast(pa.string())
            run = pa.RecordBatch.from_arrays([lang.take(pa.array(ids[0])), phrase, pa.array(np.full(len(count), words, np.int32)), pa.array(count)], ["lang", "phrase", "words", "n"])
            run = run.sort_by([("lang", "ascending"), ("phrase", "ascending")])
            for a in range(0, run.num_rows, 1 << 16):
                yield run.slice(a, 1 << 16)
        if full:
            self.clear()


def _counted(words: int, one=None, two=None):
    """Runs of the phrases of ``words`` words (3: of three and four); one, two: bit tables of the
    frequent words and pairs."""
    def run(batches):
        counter = Phrases(words)
        known_1, known_2 = (x.value if x is not None else None for x in (one, two))
        for b in batches:
            langs = b.column("lang").to_pylist()
            raw, off = text_bytes(b.column("text"))
            lang_key = _lang_keys(langs)
            for tokens, first, count in _parts(raw, off):
                own = langs[first:]
                key = mix(tokens.hash + lang_key[first + tokens.text], 5)
                n = len(key)
                if not n:
                    continue
                if words == 1:
                    use = np.arange(n) < count
                    counter.add_words(counter.word_ids(key, tokens, own, use)[use])
                else:
                    word = _known(known_1, key)
                    pair = np.zeros(n, bool)
                    pair[:-1] = (tokens.piece[1:] == tokens.piece[:-1]) & word[:-1] & word[1:]
                    if words == 2:
                        use, at = pair, np.flatnonzero(pair & (np.arange(n) < count))
                    else:
                        pair &= _known(known_2, _pair_keys(key))
                        use, at = pair, np.flatnonzero(pair[:-1] & pair[1:] & (np.arange(n - 1) < count))
                    used = use.copy()
                    used[1:] |= use[:-1]
                    ids = counter.word_ids(key, tokens, own, used)
                    rest = ids[at + 1] + 1
                    if words == 3:
                        rest = rest << 2 * ID_BITS | (ids[at + 2] + 1) << ID_BITS
                        more = pair[at + 2]
                        rest[more] |= ids[at[more] + 3] + 1
                    counter.add(ids[at], rest)
                yield from counter.runs(False)
        yield from counter.runs(True)
    return run


def _bits(words: int):
    """(word of the bit table, its bits) of frequent words or pairs."""
    def run(batches):
        for b in batches:
            raw, off = text_bytes(b.column("phrase"))
            tokens = Tokens(raw, off)
            key = mix(tokens.hash + _lang_keys(b.column("lang").to_pylist())[tokens.text], 5)
            if words == 2:
                key = _pair_keys(key)[::2]
            at = (key & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int32)), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], ["at", "bits"])
    return run


def _filter(frequent: DataFrame, words: int):
    """The bit table of ``frequent(lang, phrase)`` as a broadcast of FILTER_BITS bits."""
    rows = frequent.select("lang", "phrase").mapInArrow(_bits(words), "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    got = rows.toArrow()  # FILTER_BITS / 64 rows at most
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bits)


# ---------------------------------------------------------------------------------------------
# Counts, scores, report


def phrase_counts(docs: DataFrame, least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to 4 words that occur ``least`` times or more,
    and (lang, n) with all word occurrences, of ``docs(text, lang)``."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where("text is not null")
    schema = "lang string, phrase string, words int, n long"

    def merged(runs: DataFrame) -> DataFrame:
        ranges = runs.repartitionByRange("lang", "phrase")
        return stored(ranges.groupBy("lang", "phrase").agg(F.min("words").alias("words"), F.sum("n").alias("f")).where(F.col("f") >= least), "phrase-counts")

    runs = stored(texts.mapInArrow(_counted(1), schema), "phrase-runs")
    totals = runs.groupBy("lang").agg(F.sum("n").alias("n"))
    ones = merged(runs)
    one = _filter(ones, 1)
    twos = merged(stored(texts.mapInArrow(_counted(2, one), schema), "phrase-runs"))
    two = _filter(twos, 2)
    more = merged(stored(texts.mapInArrow(_counted(3, one, two), schema), "phrase-runs"))
    return ones.unionByName(twos).unionByName(more), totals


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words by
    the score of their weakest cut, without phrases that mostly occur inside one longer phrase."""
    counts, totals = phrase_counts(docs, least)
    candidates = counts.where("words > 1").withColumnRenamed("f", "a").withColumn("w", F.split("phrase", " "))

    def span(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", span(1, F.col("k")).alias("first"), span(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumn("score", F.expr("cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    parts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda s: F.array_join(F.slice("w", s, m), " ")))))
    longer = candidates.where("words > 2").select("lang", "a", F.explode(parts).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.expr(f"longer is null or cast(longer as decimal(20,0)) * 100 < cast(a as decimal(20,0)) * {int(inside)}"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 strongest phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))
