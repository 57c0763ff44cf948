"""Benchmark decontamination by a distributed positional inverted index, in DataFrame operations
only.

The index holds a posting (term, document, position) for every training word that is a test term.
A test phrase is looked up from its rarest terms: the postings of the rarest give candidate starts
(position less the term's offset), the next rarest list, adjusted by its own offset, is
intersected, and the candidates left are checked against the lists of all other offsets. Exact
phrase matches and proximity matches (all terms of a phrase within a span) come from the same index.

Terms are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A document is told apart
by its id and the hash of its text, so null and repeated ids are safe. Null and empty texts have no
words and are clean; items without words have no phrase. Other columns are ignored. Test terms are
joined, not collected: Spark broadcasts them while they are under its size threshold, and shuffles
beyond. Frequent terms' postings are never joined to each other, only to candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

#: What lies between words before lower-casing (A-Z still stand for their small letters).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Contaminated from one hit word in so many.
LEAST_SHARE = 20


def pieces(text: Column) -> Column:
    """Words of a text as written; a first and a last piece may be empty (no per-word lambda, as this
    runs over the whole corpus)."""
    return F.split(F.coalesce(text, F.lit("")), BETWEEN)


def lower_word(w: Column) -> Column:
    """A-Z in lower case; the slow mapping only runs for words that any lower-casing changes."""
    return F.when(w == F.lower(w), w).otherwise(lower_ascii(w))


def words(text: Column) -> Column:
    """Array of the words of a text, empty for null."""
    return F.filter(F.transform(pieces(text), lower_word), lambda w: w != "")


def word_count(text: Column) -> Column:
    p = pieces(text)
    return F.size(p) - (F.get(p, F.lit(0)) == "").cast("int") - ((F.size(p) > 1) & (F.element_at(p, -1) == "")).cast("int")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def phrases(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(terms, owners): terms(phrase, length, offset, term) of every distinct phrase, and the items
    of each. A phrase is a window of an item, or a whole shorter item; its id is its md5."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    w = w.select("item_id", "w", F.explode(starts).alias("a")).select("item_id", F.slice("w", F.col("a") + 1, window).alias("w"))
    w = stored(w.select("item_id", F.md5(F.array_join("w", " ").cast("binary")).alias("phrase"), "w"), "phrases")
    terms = w.groupBy("phrase").agg(F.first("w").alias("w")).select("phrase", F.size("w").alias("length"), F.posexplode("w").alias("offset", "term"))
    return terms, w.select("phrase", "item_id").distinct()


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Stored postings (term, doc_id, text_hash, pos) of ``docs(doc_id, text)`` for the test terms. A
    document's positions count from 0, or from 1 if it starts with something between words."""
    vocabulary = stored(terms.select(F.col("term").alias("t")).distinct(), "test-terms")
    spread = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.posexplode(pieces(F.col("text"))).alias("pos", "piece"))
    spread = spread.select(lower_word(F.col("piece")).alias("term"), "doc_id", "text_hash", "pos")
    return stored(spread.join(vocabulary, F.col("term") == F.col("t"), "left_semi"), "postings")


def _same_doc(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def _ranked(index: DataFrame, terms: DataFrame) -> DataFrame:
    """terms with rank: 1 for the rarest term of each phrase (one offset of a repeated term)."""
    df = index.groupBy("term").agg(F.count("*").alias("df"))
    rarest = Window.partitionBy("phrase").orderBy("df", "term", "offset")
    known = terms.join(df, "term", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    # a phrase with a term that no document has matches nowhere
    alive = known.groupBy("phrase").agg(F.min("df").alias("least")).where("least > 0").select("phrase")
    return known.join(alive, "phrase").withColumn("rank", F.row_number().over(rarest))


def phrase_matches(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(phrase, length, doc_id, text_hash, start): all exact occurrences, once each."""
    ranked = stored(_ranked(index, terms), "ranked")
    # the lists of the two rarest terms of each phrase: a small part of the index
    rare_terms = stored(ranked.where("rank <= 2").select(F.col("term").alias("t")).distinct(), "rare-terms")
    rare = stored(index.join(rare_terms, F.col("term") == F.col("t"), "left_semi").distinct(), "rare-postings")
    first = ranked.where("rank = 1").select("phrase", "length", "offset", "term")
    cand = rare.join(first, "term").select("phrase", "length", "doc_id", "text_hash", (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")
    second = ranked.where("rank = 2").select("phrase", F.col("term").alias("term2"), F.col("offset").alias("offset2"))
    cand = cand.join(second, "phrase", "left").withColumn("pos2", F.col("start") + F.coalesce("offset2", F.lit(0)))
    both = cand.alias("c").join(rare.alias("i"), (F.col("c.term2") == F.col("i.term")) & (F.col("c.pos2") == F.col("i.pos")) & _same_doc("c", "i"), "left_semi")
    cand = stored(cand.where("term2 is null").unionByName(both).select("phrase", "length", "doc_id", "text_hash", "start").distinct(), "candidates")
    # every other offset, against the candidates' documents only
    rest = ranked.where("rank > 2").select("phrase", "offset", "term")
    want = cand.join(rest, "phrase").select("phrase", "doc_id", "text_hash", "start", "term", (F.col("start") + F.col("offset")).alias("pos"))
    docs = stored(cand.select("doc_id", "text_hash").distinct(), "candidate-documents")
    near = index.alias("i").join(docs.alias("d"), _same_doc("i", "d"), "left_semi").distinct()
    got = want.alias("w").join(near.alias("i"), (F.col("w.term") == F.col("i.term")) & (F.col("w.pos") == F.col("i.pos")) & _same_doc("w", "i"), "left_semi")
    got = got.groupBy("phrase", "doc_id", "text_hash", "start").agg(F.count("*").alias("got"))
    full = cand.where("length <= 2").unionByName(cand.alias("c").join(got.alias("g"), (F.col("c.phrase") == F.col("g.phrase")) & (F.col("c.start") == F.col("g.start")) & _same_doc("c", "g")
                                                 & (F.col("g.got") == F.col("c.length") - 2), "left_semi"))
    return full


def proximity_matches(index: DataFrame, terms: DataFrame, slop: int) -> DataFrame:
    """(phrase, doc_id, text_hash, pos): postings of a phrase's rarest term that have all its other
    terms, in any order, within length + slop words."""
    ranked = stored(_ranked(index, terms.groupBy("phrase", "length", "term").agg(F.min("offset").alias("offset"))), "ranked")
    first = ranked.where("rank = 1").select("phrase", "length", "term")
    cand = index.distinct().join(first, "term").select("phrase", "length", "doc_id", "text_hash", "pos")
    need = ranked.groupBy("phrase").agg((F.count("*") - 1).alias("need"))
    cand = cand.join(need, "phrase")
    rest = ranked.where("rank > 1").select("phrase", F.col("term").alias("other"))
    docs = cand.select("doc_id", "text_hash").distinct()
    near = index.alias("i").join(docs.alias("d"), _same_doc("i", "d"), "left_semi")
    want = cand.join(rest, "phrase")
    got = want.alias("w").join(near.alias("i"), (F.col("w.other") == F.col("i.term")) & _same_doc("w", "i")).where(F.abs(F.col("w.pos") - F.col("i.pos")) < F.col("w.length") + slop)
    got = got.groupBy("w.phrase", "w.doc_id", "w.text_hash", "w.pos", "w.need").agg(F.count_distinct("w.other").alias("got")).where("got = need")
    return got.select("phrase", "doc_id", "text_hash", "pos").unionByName(cand.where("need = 0").select("phrase", "doc_id", "text_hash", "pos"))


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, share: int = LEAST_SHARE) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of
    ``docs(doc_id, text)``."""
    terms, owners = phrases(items, window)
    terms = stored(terms, "terms")
    found = stored(phrase_matches(build_index(docs, terms), terms), "matches")
    hit = found.select("doc_id", "text_hash", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    hit = hit.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_hit"))
    whose = found.select("doc_id", "text_hash", "phrase").distinct().join(owners, "phrase").select("doc_id", "text_hash", F.col("item_id").cast("string").alias("item")).distinct()
    whose = whose.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    hit = hit.alias("h").join(whose.alias("o"), _same_doc("h", "o")).select("h.doc_id", "h.text_hash", "n_hit", "n_items", "items")
    rows = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), word_count(F.col("text")).cast("long").alias("n_words"))
    out = rows.alias("r").join(hit.alias("h"), _same_doc("r", "h"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("r.doc_id", "r.text_hash", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"), ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    return contamination(docs, items).drop("text_hash")
