"""The training-data operators against plain Python versions, on edge rows: nulls in any column, empty
and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adspark.llm import common, decontaminate, embedding_dedup, jaccard_join, language_id, mixing, quality, secrets, sharding, substring_dedup, url_filter

from . import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, hash string, sha string, g long, row long"


def text(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{'ÉéA.'[r.randrange(4)]}" for _ in range(n))


def rows():
    base, other = text(1, 200), text(2, 120)
    near = base.split()
    near[50] = "changed"
    far = base.split()[:60] + text(3, 80).split()
    out = [base, base, " ".join(near), base.upper(), other, other + "\n" + text(4, 40), " ".join(far), None, None, "", " \t\n", "one", "ONE", "one two", "the " * 300, "the " * 90,
           text(5, 6000), text(6, 30), "x" * 5000, "!!! ... ---", "Ünïcödé ẞ 漢字 words " * 20, other, "tail " + " ".join(base.split()[100:]), text(7, 36), text(7, 36) + " end"]
    langs = ["en", "fr", None]
    return [(i, t, langs[i % 3], [None, "b", "a", "b"][i % 4], None, 1, "h", "s", i, i) for i, t in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


PAIRS = [(r[0], r[1]) for r in rows()]


def test_jaccard_join(docs, empty):
    every, parts = jaccard_join.link(docs)
    got = every.join(parts, F.col("g") == F.col("id"), "left").select("doc_id", "n", F.coalesce("component", "g", "doc_id")).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard_components(PAIRS)
    assert jaccard_join.link(empty)[0].count() == 0


def test_jaccard_join_many_near_copies(spark):
    r = random.Random(3)
    pool = [(0, text(9, 150))]
    for i in range(1, 120):
        w = pool[0][1].split()
        for _ in range(r.randrange(0, 6)):
            w[r.randrange(len(w))] = f"edit{i}_{r.random()}"
        pool.append((i, " ".join(w)))
    every, parts = jaccard_join.link(spark.createDataFrame(pool, "doc_id long, text string"))
    got = every.join(parts, F.col("g") == F.col("id"), "left").select("doc_id", "n", F.coalesce("component", "g", "doc_id")).collect()
    assert {x[0]: (x[1], x[2]) for x in got} == brute.jaccard_components(pool)


def test_jaccard_join_null_and_repeated_ids(spark):
    t = text(1, 50)
    every, _ = jaccard_join.link(spark.createDataFrame([(None, t), (5, t), (5, t), (3, t)], "doc_id long, text string"))
    assert Counter((r.doc_id, r.g) for r in every.collect()) == Counter({(None, None): 1, (5, 3): 2, (3, 3): 1})


def test_substring_dedup(docs, empty):
    got = sorted(tuple(r) for r in substring_dedup.dedup_substrings(docs).drop("factors").collect())
    assert got == sorted(brute.substring_dedup(PAIRS))
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_substring_dedup_null_ids(spark):
    t = [(None, text(1, 40)), (None, text(1, 40)), (1, text(1, 20)), (1, None)]
    got = sorted((tuple(r) for r in substring_dedup.dedup_substrings(spark.createDataFrame(t, "doc_id long, text string")).drop("factors").collect()), key=str)
    assert got == sorted(brute.substring_dedup(t), key=str)


def test_winnow_covers_each_window():
    r = np.random.default_rng(1)
    for h in (r.integers(1, 1 << 60, 500), r.integers(1, 4, 500), np.ones(500, int)):
        h = h.astype(np.uint64)
        pick = substring_dedup.winnow(h, np.zeros(500, int), 28)
        for i in range(500 - 27):
            inside = pick[(pick >= i) & (pick < i + 28)]
            assert h[i:i + 28].min() in h[inside]


def test_contamination(spark, docs, empty):
    w = PAIRS[0][1].split()
    items = [(1, " ".join(w[20:45])), (2, "one"), (3, None), (4, "..."), (5, "no such words here"), (6, PAIRS[4][1]), (1, " ".join(w[20:45])), (7, "the the the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.contamination(docs.select("doc_id", "text"), bench).drop("text_hash").collect())
    assert got == sorted(brute.contamination(PAIRS, items))
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    source = {r[0]: r[3] for r in rows()}
    size = {d: len(brute.WORD.findall(t or "")) for d, t in PAIRS}
    assert {r.doc_id: r["size"] for r in got} == size
    total, taken = Counter(), Counter()
    for r in got:
        total[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        assert r.taken <= 2 * r["size"]
    want = brute.targets(total)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == total[s] and abs(r.target - want[s]) < 1e-6
    for s in want:
        assert abs(taken[s] - want[s]) <= max(size[d] for d in size if source[d] == s) / 2 + 1
    assert mixing.mix(empty).count() == 0


def test_sharding(docs, empty):
    for law in ("rows", "bytes"):
        got = sharding.shard(docs.union(docs), law=law).collect()
        assert len(got) == 2 * len(PAIRS)
        count = Counter(r["shard"] for r in got)
        for s in count:
            assert sorted(r.slot for r in got if r["shard"] == s) == list(range(count[s]))
        if law == "rows":
            assert max(count.values()) - min(count.get(s, 0) for s in range(8)) <= 1
    assert sharding.shard(empty).count() == 0


def test_hilbert_index_walks_neighbours(spark):
    n, b = 3, 3
    cells = spark.range(1 << n * b).select(*(F.floor(F.col("id") / (1 << b * i)).cast("int").bitwiseAND(7).alias(c) for i, c in enumerate("xyz")))
    got = sorted((r.h, (r.x, r.y, r.z)) for r in cells.withColumn("h", sharding.hilbert_index([F.col(c) for c in "xyz"], b)).collect())
    assert [h for h, _ in got] == list(range(1 << n * b))
    assert all(sum(abs(p - q) for p, q in zip(a, z, strict=True)) == 1 for (_, a), (_, z) in zip(got, got[1:]))


def test_secrets(spark, empty):
    live, seen = "q8Zr7Lk2Wm5Tn3Xv", "a1b2c3d4e5f6a7b8c9d0e1f2a3b4"
    texts = [f"token = {live} end", f"just {live} here", f"password: '{seen}'", f"PASSWD={seen}", f"secret={seen}", "AKIA" + "A1B2" * 4, "token=token:abcdefghijkl api_key : x", None, "", "ſecret=longvalue1", "ÄÖ token=abc.def=ghi"]
    docs = spark.createDataFrame([(i, t, "s" + str(i) if i > 1 else "s0", None, 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, lang string, row long")
    out, values = secrets.scan(docs)
    got = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate(texts):
        want = brute.base_spans(t)
        spans = [f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in want]
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, k, _ in want) for x in range(3)]
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("owned")] == spans
    assert got[1].spans == "owned:5:21"
    assert {r["class"] for r in values.collect()} >= {"live", "example"}
    assert secrets.scan(empty)[0].count() == 0


def test_secrets_bare_copies(spark):
    short, letters, parts, copied, low = "q8Zr7Lk2Wm5T", "QzkWnBvXtRpLmD", "Ab3/Zx9+Kq7.Lw2", "m4Nv8Bx2Cz6L", "aaaaaaaaaaaaaaaa"
    texts = [f"token = {short} end", f"bare {short}. In /path/{short}/x or key={short}, x{short} and {short}y {short}_ not", f"secret={letters}.", f"see {letters}, a-{letters}-b",
             f"api_key: {parts}", f"url/{parts}=/x {parts}+{parts} Ab3/Zx9+Kq7", f"token={copied}.", f"{copied}", f"/{copied}/", f"password={low}", f"{low} token=x.{short} {short}"]
    owners = ["a", "a", "b", "b", "c", "c", "d", "e", "f", "g", "a"]
    docs = spark.createDataFrame([(i, t, o, None) for i, (t, o) in enumerate(zip(texts, owners, strict=True))], "doc_id long, text string, source string, lang string")
    out, values = secrets.scan(docs)
    got = {r.doc_id: r.spans for r in out.collect()}
    separators = ".=/+-"
    base = {i: brute.base_spans(t) for i, t in enumerate(texts)}
    for i, t in enumerate(texts):
        want = [(a, k, f"{secrets.KINDS[k]}:{a}:{e}") for a, k, e in base[i]]
        for v in (short, letters, parts):
            for a in range(len(t) - len(v) + 1):
                e = a + len(v)
                free = (not a or not (t[a - 1].isalnum() or t[a - 1] == "_")) and (e == len(t) or not (t[e].isalnum() or t[e] == "_"))
                if t.startswith(v, a) and free and not any(x < e and a < y for x, _, y in base[i]):
                    want.append((a, len(secrets.KINDS), f"owned:{a}:{e}"))
        assert got[i] == ",".join(x for _, _, x in sorted(want)), (i, t)
    kinds = {bytes(r.hash): r["class"] for r in values.collect()}
    assert kinds[secrets._digest(copied)] == "example" and kinds[secrets._digest(short)] == "live"
    assert not any(got[i] for i in (7, 8)) and secrets.normal(copied + ".") == copied and separators == secrets.SEPARATORS


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://Adult-X.example.net/en/1?x", "https://a.example.org/es/1", "https://a.example.org/en/12", "http://org", "http://org/", "x://notorg/", "http://b.com/de/", "http://b.com/fr/1#y", "http://ü.net/é", "a://b://c/d?e#f", "http://h.net/en/1"]
    pages = spark.createDataFrame([(i, u, "<p>adult news example</p>" * 5, "x") for i, u in enumerate(urls)], "page_id long, url string, html string, rule string")
    rows = url_filter.judged(pages)
    hosts = url_filter.host_words(rows, url_filter.word_counts(pages))
    got = url_filter.judge(rows, url_filter.learn(rows.where("ruled is not null"), hosts)).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path) == brute.url_parts(urls[r.page_id])
        assert r["rule"] == brute.url_rule(r.host, r.path)
        assert r.verdict == dict(brute.RULES).get(r["rule"], r.verdict) and r.verdict in ("allow", "block")
    none = rows.limit(0)
    hosts = url_filter.host_words(none, url_filter.word_counts(pages.limit(0)))
    model = url_filter.learn(none, hosts)
    assert url_filter.judge(none, model).count() == 0
    # words and labels, but no judged page: every page without a rule is allowed
    assert {r.verdict for r in url_filter.judge(rows, url_filter.learn(none, url_filter.host_words(rows, url_filter.word_counts(pages)))).where("rule is null").collect()} == {"allow"}
    assert url_filter.split("helloworld", {"hello": 50, "world": 40, "hell": 5, "o": 3}, 99) == ["hello", "world"]


def test_url_filter_against_brute_force(spark):
    r = random.Random(11)
    vocabulary = ["news", "new", "shop", "the", "ring", "string", "casino", "farm", "spam", "ab", "abc", "c" * 40, "c" * 24 + "dd", "long" * 9]
    label = lambda: "".join(r.choice([*vocabulary, "q", "zz", "7", "-", "ü"]) for _ in range(r.randrange(1, 5)))
    hosts = [f"{label()}.{label()}.{tld}" for tld in ("net", "com", "org", "example.org") for _ in range(12)] + ["x" * 300 + "news.com", ""]
    paths = ["", "/", "/es/1", "/en/12", "/de/shop/Casino", "/fr/news", "/" + "spam" * 200, "/é/9x"]
    urls = [None, "none"] + [f"https://{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '?q=1', '#a'])}" for _ in range(400)] + [f"http://Hot.com{r.choice(paths)}" for _ in range(200)]
    html = [None, "", "<p class=news>"] + ["<b>" + " ".join(r.choice(vocabulary) for _ in range(30)).upper() + "</b> x" for _ in range(len(urls) - 3)]
    ids = [None if i % 50 == 0 else i // 2 for i in range(len(urls))]
    data = [(i, u, h, "x", 1) for i, u, h in zip(ids, urls, html, strict=True)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, words string, weight int")
    rows = url_filter.judged(pages)
    found = url_filter.host_words(rows, url_filter.word_counts(pages))
    got = url_filter.judge(rows, url_filter.learn(rows.where("ruled is not null"), found))
    key = lambda x: tuple((v is None, v) for v in x)
    want = brute.url_filter(ids, urls, html)
    assert sorted(((*r[:5], r["words"], round(r["score"], 4)) for r in got.collect()), key=key) == sorted(((*w[:6], round(w[6], 4)) for w in want), key=key)
    assert {w[4] for w in want if w[3] is None} == {"allow", "block"}


def test_language_id_pieces_are_the_whole_text(monkeypatch):
    texts = ["", "Σίσυφος ΟΔΟΣ" * 9, "a", "ab", "x y", "The İstanbul cat, " * 40]
    whole = [np.bincount(np.concatenate([g for i, _, g in language_id._buckets([t])]), minlength=language_id.BUCKETS + 1)[:-1] for t in texts]
    for piece in (1, 2, 3, 7, 50):
        monkeypatch.setattr(language_id, "PIECE", piece)
        total = np.zeros((len(texts), language_id.BUCKETS + 1), np.int64)
        for ids, at, grams in language_id._buckets(texts):
            np.add.at(total, (np.repeat(ids, np.diff(np.append(at, len(grams)))), grams), 1)
        assert (total[:, :-1] == np.array(whole)).all()


def test_language_id(spark, docs, empty):
    train = spark.createDataFrame([(i, t, x) for i in range(30) for t, x in (("the cat and the dog", "en"), ("le chat et le chien", "fr"))], "key long, text string, lang string")
    model = language_id.train(train)
    test = [(0, "the dog"), (1, "LE CHIEN"), (2, None), (3, "12 !!"), (4, "the cat " * 200_000), (None, "chat")]
    got = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(test, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in range(5)] == ["en", "fr", "und", "und", "en"]
    assert got[2].score == 0 and 0 <= got[0].score <= 1 and got[None].held_out
    assert all(got[i].held_out == brute.held_out(i) for i in range(5))
    nothing = language_id.train(train.limit(0))
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0


def test_quality(spark, docs, empty):
    good = [(i, text(i, 60), 1) for i in range(60)]
    bad = [(100 + i, " ".join(w + "!!" for w in text(i, 40).upper().split()), 0) for i in range(60)]
    net = quality.train(spark.createDataFrame(good + bad, "key long, text string, quality int"))
    test = [(i, text(1000 + i, 60)) for i in range(20)] + [(100 + i, " ".join(w + "!!" for w in text(2000 + i, 40).upper().split())) for i in range(20)]
    got = {r.doc_id: r for r in quality.predict(spark.createDataFrame(test, "doc_id long, text string"), net).collect()}
    assert all(got[i].predicted == 1 for i in range(20)) and all(got[100 + i].predicted == 0 for i in range(20))
    every = quality.predict(docs, net).collect()
    assert len(every) == len(PAIRS) and all(0 <= r.score <= 1 for r in every)
    kept = quality.keep_good(docs, net)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in every if r.predicted}
    assert quality.predict(empty, net).count() == 0
    assert quality.train(spark.createDataFrame(good, "key long, text string, quality int")) is None


def test_quality_learns_from_whole_texts(spark):
    def long(seed, bad):
        t = text(seed, 4000)[:19_500]  # 51 chunks; the bad passage lies in chunks 4 to 6
        return t[:2000] + "#!$%&*" * 100 + t[2600:] if bad else t

    net = quality.train(spark.createDataFrame([(i, long(i, i % 2), 1 - i % 2) for i in range(80)], "key long, text string, quality int"))
    got = quality.predict(spark.createDataFrame([(i, long(1000 + i, i % 2)) for i in range(20)], "doc_id long, text string"), net, 0.5).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_quality_gradient_in_blocks():
    r = np.random.default_rng(3)
    raw, offsets = common.text_bytes(pa.array([text(1, 900), "", text(2, 20), text(3, 400)]))
    doc, start, end = quality._spans(offsets)
    w = {"embed": r.normal(0, 0.5, (257, quality.EMBED)), "conv": r.normal(0, 0.2, (quality.WIDTH * quality.EMBED, quality.FILTERS)), "bias": r.normal(0, 0.1, quality.FILTERS),
         "out": r.normal(0, 0.1, 4 * quality.FILTERS), "out_bias": np.zeros(1)}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    whole, parts = (quality._gradient(w, raw, start, end, np.bincount(doc), np.array([1.0, 0, 1, 0]), np.ones(4), n) for n in (1000, 3))
    assert all(np.allclose(whole[k], parts[k], rtol=1e-3, atol=1e-6) for k in w)


def test_embedding_dedup(spark):
    r = np.random.default_rng(2)
    out = []
    for c in range(30):
        center = r.normal(size=16)
        for _ in range(8):
            out.append((len(out), [float(np.float32(x)) for x in center + r.normal(size=16) * 0.03 * (c % 4)], c % 3))
    n = len(out)
    out += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [1.0, None] * 8, 1), (n + 4, [float("nan")] * 16, 1), (n + 5, out[0][1], None), (n + 6, out[0][1], 0), (n + 7, [1.0, 2.0], 0), (n + 8, [2.0, 4.0], 0)]
    vectors = spark.createDataFrame(out, "vec_id long, embedding array<float>, label int")
    got = {x.vec_id: (x.n_links, x.component_id) for x in embedding_dedup.near_duplicates(vectors).collect()}
    want = brute.cosine_links(out)
    missed = sum(want[i][0] - got[i][0] for i in want)
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    assert missed <= 0.1 * sum(x[0] for x in want.values())
    assert embedding_dedup.near_duplicates(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.8])
def test_embedding_tables_reach_the_target(shared):
    """Pairs at the threshold meet also where all vectors share a direction (average cosine ``shared``)."""
    r = np.random.default_rng(3)
    x = r.normal(size=(3000, 32))
    x = np.sqrt(1 - shared) * x / np.linalg.norm(x, axis=1, keepdims=True)
    x[:, 0] += np.sqrt(shared)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for n in (500, 1_000_000):
        codes = embedding_dedup.Codes(x[:2000], *embedding_dedup.plan_tables(n))
        u = x[2000:]
        way = r.normal(size=u.shape)
        way -= (way * u).sum(1, keepdims=True) * u
        v = 0.9801 * u + np.sqrt(1 - 0.9801 ** 2) * way / np.linalg.norm(way, axis=1, keepdims=True)
        assert (codes.keys(u) == codes.keys(v)).any(1).mean() >= 0.99
        assert codes.keys(u).shape[1] == codes.tables


def test_embedding_tables_of_few_vectors():
    for x in (np.ones((1, 1)), np.array([[1.0], [-1.0]]), np.ones((3, 2)) / np.sqrt(2), np.zeros((0, 5)), np.eye(4)):
        codes = embedding_dedup.Codes(x, *embedding_dedup.plan_tables(len(x)))
        assert codes.keys(x).shape == (len(x), codes.tables)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {x.id: x.component for x in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = brute.roots({x for e in edges for x in e}, edges)
    assert all(got.get(x, x) == root[x] for x in root)


def test_quality_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * (100 + i)) for i in range(400)] + [(900, "y" * 5000), (5, "again"), (None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] * 2 + [(900, 1), (7, 0), (None, 1), (8, None), (9, 3)], "doc_id long, quality int")
    every = quality.draw(docs, labels, 10_000, 1 << 20).collect()
    assert len(every) == 400 + 2 + 1 and {r.quality for r in every if r.key == 7} == {0, 1}
    part = quality.draw(docs, labels, 10_000, 9000).collect()
    for label in (0, 1):
        size = sum(len(r.text) + 1 for r in part if r.quality == label)
        assert 4500 - 600 < size <= 4500
    assert 900 not in {r.key for r in part} and all(set(r.text) <= {"x"} or r.text == "again" for r in part)
    assert quality.train(quality.draw(docs.limit(0), labels)) is None and quality.train(quality.draw(docs, labels.limit(0))) is None


def test_quality_scoring_memory_does_not_grow_with_the_text():
    import tracemalloc
    from adspark.llm import quality as Q
    rng = np.random.default_rng(1)
    net = Q.Network(rng.normal(size=(257, Q.EMBED)).astype(np.float32), rng.normal(size=(Q.WIDTH * Q.EMBED, Q.FILTERS)).astype(np.float32), np.zeros(Q.FILTERS, np.float32),
                    rng.normal(size=4 * Q.FILTERS), 0.0)
    raw, offsets = rng.integers(0, 256, 600_000).astype(np.uint8), np.array([0, 10, 10, 590_000, 600_000])
    tracemalloc.start()
    got = Q.score(net, raw, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 4 and ((got >= 0) & (got <= 1)).all() and peak < 60e6
