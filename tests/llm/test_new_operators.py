"""Top-k search, conversation trie and collocations against plain Python versions, on edge rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adspark.llm import collocations, conversation_trie, pivot_topk
from adspark.llm.collocations import phrase_counts
from adspark.llm.conversation_trie import numbered_turns, prefix_trie, rebuilt
from adspark.llm.pivot_topk import exact_top_k

# ---------------------------------------------------------------------------------------------
# 11


def brute_top_k(rows, k=5):
    good = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if i is None or i % 50:
            continue
        scored = [(-min(max(sum(a * b for a, b in zip(q, x, strict=True)), -2**63), 2**63 - 1), j is None, j or 0, m) for m, j, x in good if m != n and len(x) == len(q)]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def vectors(r, n=400):
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(n)]
    rows += [(i, list(rows[7][1])) for i in range(n, n + 60)]  # copies, also of a query's best
    rows += [(50, list(rows[0][1])), (100, [0.0] * 6), (None, [3.0] * 6), (None, None), (150, None), (200, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (250, [float("nan")] * 6), (300, [float("inf")] * 6),
             (350, [1.0, 2.0]), (351, [2.0, 1.0]), (400, []), (401, []), (450, [3e38] * 6), (451, [-3e38] * 6), (452, [-0.0] * 6), (-50, [0.5] * 6)]
    return rows


def got_top_k(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], "vec_id long, embedding array<float>, label int, row string, c int, q int")
    return sorted(map(tuple, exact_top_k(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def rounded(rows):
    return [(i, None if v is None else [None if x is None else struct_float(x) for x in v]) for i, v in rows]


def struct_float(x):
    import numpy as np
    return float(np.float32(x))


@pytest.mark.parametrize("rings", [2048, 16])
def test_top_k(spark, monkeypatch, rings):
    monkeypatch.setattr(pivot_topk, "CELL_ROWS", rings)
    monkeypatch.setattr(pivot_topk, "CHUNK", 3)
    rows = rounded(vectors(random.Random(rings)))
    assert got_top_k(spark, rows) == brute_top_k(rows)


def test_top_k_small(spark):
    assert got_top_k(spark, []) == []
    assert got_top_k(spark, [(0, [1.0])]) == []
    assert got_top_k(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert got_top_k(spark, [(0, [1.0]), (0, [1.0])]) == [(0, 1, 0, 65536)] * 2


# ---------------------------------------------------------------------------------------------
# 12


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    whole = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in whole.items():
        h, base = zlib.crc32(str(c).encode()) % 6, int(c - math.fmod(c, 100))
        built[c] = tuple(whole.get(base, [])[:h] + ts[h:])
    members = defaultdict(set)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].add(c)
    kids = Counter(k[:-1] for k in members if k)
    out = []
    for k, ms in members.items():
        below = [u for u in members if u[:len(k)] == k]
        ends = sorted(c for c in ms if len(built[c]) == len(k))
        out.append((min(ms), len(k), min(members[k[:-1]]) if k else None, len(ms), kids[k], sum(not kids[u] for u in below),
                    sum((len(members[u]) - 1) * len(u[-1][1]) for u in below if u), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def got_trie(spark, rows, size=conversation_trie.BLOCK):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, digest string, c int, d int")
    c = F.col("c")
    turns, convs = rebuilt(numbered_turns(df), F.crc32(c.cast("string").cast("binary")) % 6, c - c % 100)
    return sorted(map(tuple, prefix_trie(turns, convs, size).select(*COLUMNS).collect()), key=repr)


def conversations(seed):
    r = random.Random(seed)
    say = ["a", "b", "", None, "é漢", "long " * 50]
    rows = [(c, t, r.choice(["user", "assistant", None]) if c % 7 == 0 else "user", r.choice(say[:2 if c % 3 else 6])) for c in range(-3, 230) for t in range(r.randrange(0, 9))]
    rows += [(c, t, "user", "same") for c in range(300, 420) for t in range(11)]  # a group of copies
    rows += [(900, t, "user", f"turn {t % 5}") for t in range(700)]  # spans partitions
    rows += [(901, t, "user", f"turn {t % 5}") for t in range(650)]
    rows += [(5, None, "user", "first"), (5, None, None, None), (6, 0, "x", "tie"), (6, 0, "y", "tie"), (6, 0, "y", "tie"), (None, 0, "user", "lost"), (777, None, None, None)]
    return rows


@pytest.mark.parametrize("size", [4, 7])
def test_trie(spark, size):
    rows = conversations(size)
    assert got_trie(spark, rows, size) == brute_trie(rows)


def test_trie_small(spark):
    assert got_trie(spark, []) == []
    assert got_trie(spark, [(None, 1, "u", "t")]) == []
    for rows in ([(1, 0, "u", "t")], [(2, 0, "u", "t")], [(100, 0, None, None), (101, 0, "u", "x")]):
        assert got_trie(spark, rows) == brute_trie(rows)


def test_trie_spans_many_partitions(spark):
    rows = [(8, t, "user", f"t{t}") for t in range(3000)] + [(9, t, "user", f"t{t}") for t in range(40)]
    assert got_trie(spark, rows) == brute_long(rows)


def brute_long(rows):
    """Two conversations, the second a prefix of the first or split off after some turns."""
    whole = {c: [(r, x) for k, _, r, x in rows if k == c] for c in (8, 9)}
    built = {c: whole[c][zlib.crc32(str(c).encode()) % 6:] for c in whole}  # conversation 0 is absent
    shared = 0
    while shared < min(map(len, built.values())) and built[8][shared] == built[9][shared]:
        shared += 1
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    nodes = []
    saved = [len(built[8][d][1]) for d in range(shared)]
    for d in range(shared + 1):
        ends = [c for c in (8, 9) if len(built[c]) == d]
        children = len({built[c][d] for c in (8, 9) if len(built[c]) > d})
        leaves = len([c for c in (8, 9) if len(built[c]) > shared]) or 1
        nodes.append((8, d, 8 if d else None, 2, children, leaves, sum(saved[max(d - 1, 0):]), sha(ends)))
    for c in (8, 9):
        for d in range(shared + 1, len(built[c]) + 1):
            nodes.append((c, d, 8 if d == shared + 1 else c, 1, int(d < len(built[c])), 1, 0, sha([c] if d == len(built[c]) else [])))
    return sorted(nodes, key=repr)


# ---------------------------------------------------------------------------------------------
# 13

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f["und" if lang is None else lang][tuple(w[i:i + m])] += 1
    return f


def brute_collocations(rows, least, top, inside=80):
    out = []
    for lang, f in brute_counts(rows).items():
        n, c = sum(v for p, v in f.items() if len(p) == 1), {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in c.items():
            if any(100 * b >= inside * a for q, b in c.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n, -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:top])]
    return sorted(out, key=repr)


def texts(seed, n=120):
    r = random.Random(seed)
    words = ["the", "The", "é", "漢", "red", "fox", "a b", "x" * 90, "it's", "0"]
    join = [" ", " ", " ", "\t", ", ", ".\n", " ! ", ":"]
    out = [("".join(r.choice(words) + r.choice(join) for _ in range(r.randrange(0, 120))), r.choice(["en", "fr", None, ""])) for _ in range(n)]
    return out + [(None, "en"), ("", None), (" \t\n.,", "en"), ("one", "xx"), (out[0][0], "en")] + [("new york city hall", "en")] * 40


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, n int, words int, rank int")


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:  # bursts, spills and parts of texts
        for name, value in (("BURST", 8), ("MAX_ENTRIES", 60), ("MAX_WORDS", 6), ("SLICE_BYTES", 100)):
            monkeypatch.setattr(collocations, name, value)
    rows = texts(5)
    got = collocations.collocations(frame(spark, rows), 4, 25).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got), key=repr) == brute_collocations(rows, 4, 25)


def test_phrase_counts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE_BYTES", 64)
    rows = texts(6, 30) + [("word " * 3000 + " ." * 3000 + "end of it", "en")]
    counts, totals = phrase_counts(frame(spark, rows), 2)
    want = {(lang, " ".join(p), len(p), a) for lang, f in brute_counts(rows).items() for p, a in f.items() if a >= 2}
    assert set(map(tuple, counts.select("lang", "phrase", "words", "f").collect())) == want
    assert dict(totals.collect()) == {lang: sum(a for p, a in f.items() if len(p) == 1) for lang, f in brute_counts(rows).items()}


def test_collocations_empty(spark):
    assert collocations.collocations(frame(spark, []).where("doc_id < 0"), 1, 5).count() == 0
