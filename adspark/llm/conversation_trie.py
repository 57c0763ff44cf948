"""Prefix trie of conversations, grouped by the digests of blocks of several turns.

A conversation is cut into blocks of BLOCK turns. The digest of everything up to a block's end is a
sum of per-block terms, so it comes from running sums and no conversation need lie in one task.
Conversations are grouped by that digest and the digest of the next block first: one row per
distinct block below a prefix. Where all that go on from a prefix share one block, its turns are
nodes as they stand; only where siblings diverge are the turn boundaries inside the block grouped.

Sums over subtrees need no walk over levels: every node belongs to its smallest member, the nodes
that a conversation owns are the tail of its path, and each conversation's owned sum W is one
number. A subtree holds all of W of its members, but of its owner only the part from its top on.

Running sums (turn numbers, digests, owned sums) range-partition by conversation and position; a
conversation that spans partitions gets the totals of the earlier ones, one row per partition.

Defined results: turns are ordered by ``turn`` (null first), ties by the digest of role and text;
repeated rows are turns of their own; null role or text is empty. Rows without conv_id belong to no
conversation and are ignored. An empty table gives no rows (a root needs a member). Texts are read
once, into a digest and a length, so that their length does not matter later. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, stored, table

BLOCK = 4
#: Turns of another conversation that may be put in front, at most.
HEAD_TURNS = 5
FAMILY = 100
#: conv_ids that are joined to one piece of text before they are hashed.
ID_BITS = 12
ROOT = "0:0:0"


# ---------------------------------------------------------------------------------------------
# Running sums within a group


def _sums(group: str, names: list[str], values: Callable[[pa.RecordBatch], list[np.ndarray]]):
    def run(batches):
        pid, last, carry = TaskContext.get().partitionId(), None, [np.int64(0)] * len(names)
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(group).to_numpy()
            at = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            first = np.repeat(at, np.diff(np.append(at, len(g))))
            out, new = [], []
            with np.errstate(over="ignore"):
                for v, c in zip(values(b), carry, strict=True):
                    total = np.cumsum(v, dtype=np.int64)
                    before = total - v
                    before = before - before[first]
                    if g[0] == last:
                        before[:at[1] if len(at) > 1 else len(g)] += c
                    out += [v, before]
                    new.append(before[-1] + v[-1])
            edge = np.zeros(len(g), bool)
            edge[at] = True
            edge[0] = g[0] != last
            last, carry = g[-1], new
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, out), pa.array(np.full(len(g), pid, np.int32)), pa.array(edge)], [*b.schema.names, *(f"{n}{x}" for n in names for x in ("", "_before")), "pid", "edge"])
    return run


def _carried(group: str, names: list[str], whose: np.ndarray, some: np.ndarray, carry: np.ndarray):
    def run(batches):
        for b in batches:
            pid, g = b.column("pid").to_numpy(), b.column(group).to_numpy()
            more = some[pid] & (whose[pid] == g)
            cols = {n: b.column(n) for n in b.schema.names if n not in ("pid", "edge")}
            with np.errstate(over="ignore"):
                for k, n in enumerate(names):
                    cols[f"{n}_before"] = pa.array(b.column(f"{n}_before").to_numpy() + np.where(more, carry[k][pid], 0))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
    return run


def running(df: DataFrame, group: str, order: list[str], names: list[str], values: Callable, name: str) -> DataFrame:
    """``df`` with, for each of ``names``, a long from ``values(batch)`` and ``_before``, its sum
    (modulo 2**64) over the earlier rows of the group. ``group`` is a column of longs, not null."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    added = ", ".join(f"{n} long, {n}_before long" for n in names)
    ordered = df.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    out = stored(ordered.mapInArrow(_sums(group, names, values), f"{own}, {added}, pid int, edge boolean"), name)
    # of each partition the first group and the last row, which has what its group has come to
    tail = F.max(F.struct(group, *order, *(F.struct(F.col(n), F.col(f"{n}_before")).alias(n) for n in names)))
    rows = out.groupBy("pid").agg(F.min(group).alias("first"), tail.alias("tail")).orderBy("pid").collect()
    whose, some, carry = np.zeros(parts, np.int64), np.zeros(parts, bool), np.zeros((len(names), parts), np.int64)
    held, going = None, [0] * len(names)
    for r in rows:
        whose[r.pid], some[r.pid] = held if held is not None else 0, held is not None
        for k, n in enumerate(names):
            carry[k, r.pid] = _wrap(going[k])
            total = sum(r["tail"][n])
            going[k] = total + (going[k] if held == r["first"] == r["tail"][0] else 0)
        held = r["tail"][0]
    fixed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema if f.name not in ("pid", "edge"))
    return out.mapInArrow(_carried(group, names, whose, some, carry), fixed)


def _wrap(v: int) -> int:
    return (v + (1 << 63)) % (1 << 64) - (1 << 63)


def _ones(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.ones(b.num_rows, np.int64)]


def _power(base: int, exponent: np.ndarray) -> np.ndarray:
    out, b, e = np.ones(len(exponent), np.uint64), base, exponent.astype(np.uint64)
    while e.any():
        out[(e & np.uint64(1)).astype(bool)] *= np.uint64(b)
        b, e = b * b % (1 << 64), e >> np.uint64(1)
    return out


def _terms(b: pa.RecordBatch) -> list[np.ndarray]:
    """Two 64-bit terms of a block: its digest's halves, spread, times a power of its number."""
    halves = np.frombuffer(b"".join(bytes.fromhex(x) for x in b.column("block").to_pylist()), "<u8").reshape(-1, 2)
    j = b.column("j").to_numpy()
    return [(mix(halves[:, k], k + 1) * _power(base, j)).view(np.int64) for k, base in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))]


def _columns(*names: str):
    def values(b: pa.RecordBatch) -> list[np.ndarray]:
        return [b.column(n).to_numpy() for n in names]
    return values


# ---------------------------------------------------------------------------------------------
# Rebuilt conversations


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(c, d, digest, cp) of ``rows(conv_id, turn, role, text)``: turns numbered from 1, each with
    the digest of its role and text and the code points of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"), F.length(text).cast("long").alias("cp"))
    return running(turns, "c", ["turn", "digest"], ["d"], _ones, "trie-turns").select("c", (F.col("d_before") + 1).alias("d"), "digest", "cp")


def rebuilt(turns: DataFrame, head: Column, base: Column) -> tuple[DataFrame, DataFrame]:
    """(c, d, digest, cp) with the first ``head`` turns of conversation ``base`` in place of the own
    first ``head`` (columns over c; head at most HEAD_TURNS), and (c) of all conversations."""
    convs = turns.where("d = 1").select("c", head.alias("h"), base.alias("b"))
    bases = convs.select(F.col("b").alias("c")).distinct()
    fronts = turns.where(F.col("d") <= HEAD_TURNS).join(bases, "c", "left_semi").groupBy("c").agg(F.array_sort(F.collect_list(F.struct("d", "digest", "cp"))).alias("front")).withColumnRenamed("c", "b")
    fronts = stored(fronts, "trie-fronts")
    front = convs.where("h > 0").join(fronts, "b").select("c", F.explode(F.slice("front", 1, F.col("h"))).alias("t")).select("c", "t.d", "t.digest", "t.cp")
    own = turns.withColumn("h", head).where("d > h").withColumn("b", base)
    own = own.join(fronts.select("b", F.size("front").alias("size")), "b", "left")
    own = own.select("c", (F.least(F.col("h"), F.coalesce("size", F.lit(0))) + F.col("d") - F.col("h")).alias("d"), "digest", "cp")
    return front.unionByName(own), convs.select("c")


# ---------------------------------------------------------------------------------------------
# The trie


def _prefix(j, a, b) -> Column:
    return F.concat_ws(":", j.cast("string"), a.cast("string"), b.cast("string"))


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """(c, j, prefix, block, ids, cps): a conversation's blocks, the prefix in front of each, and
    the node ids and text lengths of its turns. The id behind a full block is the next prefix."""
    cut = turns.withColumn("j", F.floor((F.col("d") - 1) / size).cast("long")).groupBy("c", "j").agg(F.array_sort(F.collect_list(F.struct("d", "digest", "cp"))).alias("t"))
    cut = cut.select("c", "j", "t.digest", "t.cp", F.md5(F.array_join("t.digest", "").cast("binary")).alias("block"))
    summed = running(cut, "c", ["j"], ["x", "y"], _terms, "trie-blocks")
    # sums modulo 2**64, without an overflow error
    after = [F.expr(f"cast(pmod(cast({n} as decimal(38,0)) + {n}_before + 9223372036854775808, 18446744073709551616) - 9223372036854775808 as bigint)") for n in ("x", "y")]
    out = summed.select("c", "j", "block", "digest", "cp", _prefix(F.col("j"), F.col("x_before"), F.col("y_before")).alias("prefix"), _prefix(F.col("j") + 1, *after).alias("next"))
    inner = F.transform(F.sequence(F.lit(1), F.size("digest")), lambda t: F.when(t == size, F.col("next")).otherwise(F.md5(F.concat(F.col("prefix"), F.lit("/"), F.array_join(F.slice("digest", F.lit(1), t), "")).cast("binary"))))
    return out.select("c", "j", "prefix", "block", inner.alias("ids"), F.col("cp").alias("cps"))


def _turn_rows(blocks: DataFrame, size: int, *carried: str) -> DataFrame:
    """One row per turn of each block: (id, parent, depth, cp) and what is carried."""
    rows = blocks.select("j", "prefix", "ids", "cps", *carried, F.posexplode("ids").alias("t", "id"))
    return rows.select("id", F.when(F.col("t") == 0, F.col("prefix")).otherwise(F.expr("ids[t - 1]")).alias("parent"), (F.col("j") * size + F.col("t") + 1).alias("depth"), F.expr("cps[t]").alias("cp"), *carried)


def _hashed(batches):
    """SHA-256 of each id's pieces in order; rows are sorted by (id, bin)."""
    going, state = None, None
    for b in batches:
        ids, shas = [], []
        for key, piece in zip(b.column("id").to_pylist(), b.column("piece").to_pylist(), strict=True):
            if key != going:
                if going is not None:
                    ids.append(going)
                    shas.append(state.hexdigest())
                going, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(shas, pa.string())], ["id", "sha"])
    if going is not None:
        yield pa.RecordBatch.from_arrays([pa.array([going]), pa.array([state.hexdigest()])], ["id", "sha"])


def prefix_trie(turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per node of the trie of ``turns(c, d, digest, cp)``; ``convs(c)`` also names the
    conversations without a turn: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256)."""
    convs = stored(convs, "trie-convs")
    blocks = stored(_blocks(turns, size), "trie-prefixes")
    variants = blocks.groupBy("prefix", "block").agg(F.first("j").alias("j"), F.first("ids").alias("ids"), F.first("cps").alias("cps"), F.count("*").alias("n"), F.min("c").alias("least"))
    variants = stored(variants, "trie-variants")
    siblings = variants.groupBy("prefix").agg((F.count("*") > 1).alias("diverge"))
    marked = variants.join(siblings, "prefix")
    same = _turn_rows(marked.where("not diverge"), size, "n", "least")
    split = _turn_rows(marked.where("diverge"), size, "n", "least").groupBy("id").agg(F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("cp").alias("cp"), F.sum("n").alias("n"), F.min("least").alias("least"))
    root = convs.agg(F.count("*").alias("n"), F.min("c").alias("least")).where("n > 0").select(F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("cp"), "n", "least")
    nodes = stored(root.unionByName(same.select(root.columns)).unionByName(split.select(root.columns)), "trie-nodes")

    children = nodes.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "id")
    nodes = nodes.join(children, "id", "left").fillna(0, ["n_children"])
    nodes = nodes.withColumn("f", (F.col("n") - 1) * F.col("cp")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = running(nodes, "least", ["depth"], ["saved", "leaves"], _columns("f", "leaf"), "trie-owned")

    owned = stored(nodes.groupBy("least").agg(F.sum("f").alias("wf"), F.sum("leaf").alias("wl")).withColumnRenamed("least", "c"), "trie-owners")
    inside = blocks.select("c", "prefix", "block", "ids").join(owned, "c", "left").groupBy("prefix", "block").agg(F.first("ids").alias("ids"), F.sum("wf").alias("wf"), F.sum("wl").alias("wl"))
    inside = inside.select(F.explode("ids").alias("id"), "wf", "wl").unionByName(owned.select(F.lit(ROOT).alias("id"), "wf", "wl"))
    inside = inside.groupBy("id").agg(F.sum("wf").alias("wf"), F.sum("wl").alias("wl"))

    last = blocks.groupBy("c").agg(F.max_by(F.element_at("ids", -1), "j").alias("id"))
    ends = convs.join(last, "c", "left").select("c", F.coalesce("id", F.lit(ROOT)).alias("id"))
    pieces = ends.groupBy("id", F.shiftright("c", ID_BITS).alias("bin")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("piece"))
    hashed = pieces.repartition("id").sortWithinPartitions("id", "bin").select("id", "piece").mapInArrow(_hashed, "id string, sha string")

    above = nodes.select(F.col("id").alias("parent"), F.col("least").alias("parent_conv_id"))
    out = nodes.join(inside, "id").join(hashed, "id", "left").join(above, "parent", "left")
    return out.select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", (F.col("wl") - F.col("leaves_before")).alias("n_leaves"),
        (F.col("wf") - F.col("saved_before")).alias("saved_tokens"), F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, each with the first h turns of its family's conversation."""
    turns = numbered_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    c = F.col("c")
    return prefix_trie(*rebuilt(turns, F.crc32(c.cast("string").cast("binary")) % (HEAD_TURNS + 1), c - c % FAMILY))
