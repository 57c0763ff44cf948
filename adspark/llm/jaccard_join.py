"""N-gram Jaccard join by the grouped prefix join.

A text's set holds its distinct 5-word shingles (64-bit hashes); two texts link at a Jaccard
similarity of 0.8 or more, which is checked exactly on the sets. A link forces a common shingle
among the first n - ceil(0.8 n) + 1 of both sets in any fixed order of shingles (the prefix), rare
shingles first so that common passages give no candidates.

How it is spread: (1) texts with equal sets collapse into one class. (2) Of each set the shingles
with a hash below LOW of the range are sorted by hash, which gives their document frequency; those
of a single class cannot match and go. The order is: frequency class, then hash; shingles above LOW
come last. (3) Classes with the same prefix and size collapse into one group; only groups have
postings. (4) Candidates come in two rounds. First each posting is paired with one leader of its
shingle and size class only (the one with the least share of shingles of its own), and each group's
members with the group's first; verified links give components. Then the texts that the size and
position filters leave open across components are joined again by prefix, now ordered by the
frequency of all their shingles, and pairs in different components are verified. Pairs inside a
component add nothing to it, so a group of thousands of near copies costs its size, not its
square, and no link between components is lost.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A shorter text's whole word sequence is its one
shingle. Null and empty texts have an empty set and link with nothing. Rows with a null id link
with nothing (component null). Repeated rows and ids are one node each by id. Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_SLICE_BYTES, Words, components, list_array, mix, run_hashes, slices, sorted_runs, stored, table, text_bytes

SHINGLE = 5
#: Hashes below this take part in the frequency count: a little more of the range than a prefix needs.
LOW = 22 * (1 << 64) // 100
#: Rows of one run held at once; longer runs share the highest frequency class.
RUN_ROWS = 50_000


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text."""
    w = Words(raw, offsets, lower=True)
    at, text = w.starts_of(width)
    h = run_hashes(w.hash, at, at + width)
    cut = np.searchsorted(text, np.arange(len(offsets)))
    out = []
    for i in range(len(offsets) - 1):
        a, z = int(w.at[i]), int(w.at[i + 1])
        if z - a >= width:
            s = np.sort(h[cut[i]:cut[i + 1]])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif z > a:  # the whole sequence, told apart by its length
            out.append(mix(run_hashes(w.hash, np.array([a]), np.array([z])), 100 + z - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int) -> int:
    """n - ceil(0.8 n) + 1, 0 for an empty set."""
    return n - (4 * n + 4) // 5 + 1 if n else 0


def _set_rows(batches):
    """Per row: size, 128-bit identity of the set, the low shingles, and as many of the others as the
    prefix needs beyond them."""
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        for p, q in slices(offsets, SMALL_SLICE_BYTES):
            size, h1, h2, low, high = [], [], [], [], []
            for s in shingle_sets(raw[offsets[p]:offsets[q]], offsets[p:q + 1] - offsets[p]):
                n, k = len(s), int(np.searchsorted(s, np.uint64(LOW)))
                size.append(n)
                h1.append(int(mix(s, 21).sum().view(np.int64)))
                h2.append(int(mix(s, 22).sum().view(np.int64)))
                low.append(s[:k].view(np.int64))
                high.append(s[k:max(k, prefix_length(n))].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(p, q - p), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), list_array(low), list_array(high)],
                                             ["doc_id", "n", "h1", "h2", "low", "high"])


def _full_sets(batches):
    for b in batches:
        raw, offsets = text_bytes(b.column("text"))
        for p, q in slices(offsets, SMALL_SLICE_BYTES):
            sets = shingle_sets(raw[offsets[p]:offsets[q]], offsets[p:q + 1] - offsets[p])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(p, q - p), list_array([s.view(np.int64) for s in sets])], ["g", "set"])


def _frequencies(batches):
    """(token, g, level) of the rows (token, g) whose token occurs again; level: log2 of how often."""
    top = RUN_ROWS.bit_length()
    for cols, _, n, more in sorted_runs(batches, 1, RUN_ROWS):
        level = np.minimum(np.log2(n).astype(np.int32) + 1, top) if not more else np.full(len(n), top, np.int32)
        keep = np.repeat((n > 1) | (more > 0), n)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(cols[0][keep]), pa.array(cols[1][keep]), pa.array(np.repeat(level, n)[keep])], ["token", "g", "level"])


def _may_link(a: str, b: str):
    """Size filter, and position filter for postings (n, pos): what can still be common suffices."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (9 * rest >= 4 * (na + nb))


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored (g, set): the full sets of the texts with the given ids(g)."""
    wanted = stored(ids.distinct(), "texts-wanted")
    return stored(docs.join(wanted, F.col("doc_id") == F.col("g"), "left_semi").mapInArrow(_full_sets, "g long, set array<long>"), "full-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sets have a Jaccard similarity of 0.8 or more."""
    a = sets.select(F.col("g").alias("u"), F.col("set").alias("a"))
    b = sets.select(F.col("g").alias("v"), F.col("set").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "u").join(b, "v").where(5 * both >= 4 * (F.size("a") + F.size("b") - both)).select("u", "v").distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def link(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, components) of ``docs(doc_id, text)``: classes(doc_id, n, g) has every row with the id
    of its class (least id with the same set; null without words), components(id, component) the
    classes that link with others."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(docs.mapInArrow(_set_rows, "doc_id long, n long, h1 long, h2 long, low array<long>, high array<long>"), "sets")
    some = rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("g"))
    every = rows.select("doc_id", "n", "h1", "h2").join(classes, ["n", "h1", "h2"], "left")
    every = every.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("g")).alias("g"))
    reps = classes.select(F.col("n").alias("c_n"), F.col("h1").alias("c_1"), F.col("h2").alias("c_2"), F.col("g"))
    own = some.join(reps, (F.col("doc_id") == F.col("g")) & (F.col("n") == F.col("c_n")) & (F.col("h1") == F.col("c_1")) & (F.col("h2") == F.col("c_2")), "left_semi").withColumnRenamed("doc_id", "g")
    spread = own.select(F.explode("low").alias("token"), "g").repartition("token").sortWithinPartitions("token")
    again = spread.mapInArrow(_frequencies, "token long, g long, level int")
    per = again.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("level", "token"))).alias("again"))  # a text's shingles at most

    base = own.select("g", "n", F.size("low").alias("k"), "high").groupBy("g", "n", "k").agg(F.first("high").alias("high"))
    need = F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1
    base = base.join(per, "g", "left").withColumn("again", F.coalesce("again", F.array().cast("array<struct<level:int,token:long>>"))).where("size(again) > 0 or size(high) > 0")
    base = base.withColumn("alone", F.col("k") - F.size("again")).withColumn("take", F.greatest(F.lit(0), F.least(need, F.col("k").cast("long")) - F.col("alone")).cast("int"))
    prefix = F.concat(F.transform(F.slice("again", F.lit(1), F.col("take")), lambda t: t["token"]), "high")
    base = base.select("g", "n", "alone", "k", "take", prefix.alias("prefix")).where("size(prefix) > 0")
    base = base.withColumn("key", F.when(F.col("alone") == 0, F.md5(F.concat_ws(",", "n", F.array_join(F.col("prefix").cast("array<string>"), ",")).cast("binary"))))
    base = stored(base, "prefixes")

    # groups: same prefix and size; a class with a shingle of its own in the prefix is a group alone
    heads = base.where("key is not null").groupBy("key").agg(F.min("g").alias("head"))
    members = base.select("g", "n", "key").join(heads, "key", "left").select("g", F.coalesce("head", "g").alias("head"))
    members = stored(members, "members")
    start = base.join(members.where("g = head").select("g"), "g", "left_semi").select(F.col("g").alias("head"), "n", "alone", "k", "take", F.posexplode("prefix").alias("i", "token"))
    # above LOW, positions go on after all low shingles
    postings = start.select("token", "head", "n", "alone", F.when(F.col("i") < F.col("take"), F.col("alone") + F.col("i")).otherwise(F.col("k") + F.col("i") - F.col("take")).alias("pos"))
    postings = postings.withColumn("bin", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))))
    shared = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    postings = stored(postings.join(shared, "token", "left_semi"), "prefix-postings")

    # first round: leaders
    lead = postings.groupBy("token", "bin").agg(F.min(F.struct((F.col("alone") / F.col("n")).alias("own"), "head", "n", "pos")).alias("l")).select("token", "bin", "l.*")
    got = postings.alias("a").join(lead.alias("b"), ["token", "bin"]).where((F.col("a.head") != F.col("b.head")) & _may_link("a", "b")).select(F.col("a.head").alias("u"), F.col("b.head").alias("v"))
    tested = stored(_ordered(got.union(members.where("g <> head").select(F.col("g").alias("u"), F.col("head").alias("v")))), "pairs")
    links = stored(_verified(tested, _sets_of(docs, tested.select(F.col("u").alias("g")).union(tested.select("v")))), "links")
    parts = stored(components(links), "components")

    # second round: what may still link across components, with all its shingles
    part = stored(members.join(parts, F.col("g") == F.col("id"), "left").select("g", "head", F.coalesce("component", "g").alias("part")), "parts")
    p = postings.join(part.select("head", "part").distinct(), "head").repartition("token")
    kinds = p.groupBy("token", "part").agg(F.max(F.col("n") - F.col("pos")).alias("rest"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    fits = (F.col("a.part") != F.col("b.part")) & (5 * F.col("b.hi") >= 4 * F.col("a.n")) & (5 * F.col("a.n") >= 4 * F.col("b.lo")) & (
        9 * F.least(F.col("a.n") - F.col("a.pos"), F.col("b.rest")) >= 4 * (F.col("a.n") + F.col("b.lo")))
    heads = p.alias("a").join(kinds.alias("b"), (F.col("a.token") == F.col("b.token")) & fits, "left_semi").select("head")
    mixed = part.groupBy("head").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("head")
    sets = _sets_of(docs, part.join(heads.union(mixed).distinct(), "head", "left_semi").select("g"))
    new = _ordered(_between(sets, part.select("g", "part"))).join(tested, ["u", "v"], "left_anti")
    more = stored(_verified(stored(new, "pairs"), sets), "links")
    if not more.isEmpty():
        parts = stored(components(links.union(more)), "components")
    return every, parts


def _between(sets: DataFrame, part: DataFrame) -> DataFrame:
    """Candidate pairs (u, v) of ``sets(g, set)`` in different components, by the prefix join over all
    shingles: the frequency order is that among these sets, and shingles of a single set come first.

    Components are paired by shingle, with the filters at their most lenient over a component's
    postings of the shingle; only where a component has several of them are these looked up."""
    sizes = sets.select("g", F.size("set").cast("long").alias("n")).distinct()
    tokens = sets.select(F.explode("set").alias("token"), "g").repartition("token").sortWithinPartitions("token")
    again = tokens.mapInArrow(_frequencies, "token long, g long, level int").groupBy("g").agg(F.sort_array(F.collect_set(F.struct("level", "token"))).alias("again"))
    prefix = again.join(sizes, "g").join(part, "g").withColumn("alone", F.col("n") - F.size("again"))
    take = F.greatest(F.lit(0).cast("long"), F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1 - F.col("alone")).cast("int")
    p = prefix.select("g", "part", "n", "alone", F.posexplode(F.slice("again", F.lit(1), take)).alias("i", "t")).select("g", "part", "n", F.col("t.token").alias("token"), (F.col("alone") + F.col("i")).alias("pos"))
    p = stored(p.where("9 * (n - pos) >= 4 * (n + 0.8 * n)"), "second-postings")  # else no partner of any size
    spread = p.repartition("token")
    kinds = spread.groupBy("token", "part").agg(F.count("*").alias("c"), F.min("g").alias("g"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    a, b = kinds.alias("a"), kinds.alias("b")
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.part") < F.col("b.part")) & (5 * F.col("a.hi") >= 4 * F.col("b.lo")) & (5 * F.col("b.hi") >= 4 * F.col("a.lo"))
                   & (9 * F.least("a.rest", "b.rest") >= 4 * (F.col("a.lo") + F.col("b.lo"))))
    pairs = pairs.select(F.col("a.token").alias("token"), F.col("a.part").alias("pa"), F.col("b.part").alias("pb"), F.col("a.g").alias("ga"), F.col("b.g").alias("gb"), ((F.col("a.c") == 1) & (F.col("b.c") == 1)).alias("single"))
    plain = pairs.where("single").select(F.col("ga").alias("u"), F.col("gb").alias("v"))
    side = p.select("token", "part", F.struct("g", "n", "pos").alias("x"))
    a = side.select(F.col("token").alias("t1"), F.col("part").alias("part1"), F.col("x").alias("a"))
    b = side.select(F.col("token").alias("t2"), F.col("part").alias("part2"), F.col("x").alias("b"))
    several = pairs.where("not single").join(a, (F.col("token") == F.col("t1")) & (F.col("pa") == F.col("part1"))).join(b, (F.col("token") == F.col("t2")) & (F.col("pb") == F.col("part2")))
    return plain.union(several.where(_may_link("a", "b")).select(F.col("a.g").alias("u"), F.col("b.g").alias("v")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, parts = link(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return every.join(parts, F.col("g") == F.col("id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "g", "doc_id").alias("component_id"))
