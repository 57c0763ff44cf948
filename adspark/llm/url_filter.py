"""URL filters: host word segmentation by unigram Viterbi, then multinomial naive Bayes.

Hosts and paths are cut out and the fixed rules applied with column expressions. The letter runs of
the distinct hosts are split into words by a unigram Viterbi search; its word counts come from the
texts of all pages, reduced to the words that occur in a host (a join on the words' first letters).
Each distinct run is segmented once, in tasks. A multinomial naive Bayes model then learns from the
pages that a rule judges: the words of their hosts and of their paths are counted per verdict over
all such pages, and the log odds of all tokens stay a table that is joined to the words of each
distinct host and path and summed there. No count, word or token is sampled, cut or dropped, and
nothing but a few totals reaches the driver. Joins on hosts, paths, runs and tokens are spread by a
salt of the many-rows side, so a key that holds a third of all rows is shared by many tasks.

Log odds are whole numbers of MICRO parts, so sums do not depend on their order.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule, and
gets the verdict of the model's prior; a token that no judged page holds says nothing; equal odds
allow, so without any judged page every other page is allowed. Of equally likely splits the one with the
longest last word counts. Null texts hold no words. Repeated rows and null ids are judged row by
row; other columns are ignored; empty tables give no rows. Long hosts, paths and texts count whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

# The rules, as (rule, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

MICRO = 1_000_000
#: What a letter of an unknown word costs, in natural-log units.
LETTER_COST = 2.5
#: Letters by which words and host runs are joined; longer words are compared whole after it.
KEY_LETTERS = 24
#: Tasks that share one hot key.
SALTS = 64
#: Runs of letters, of digits and of other code points beyond ASCII.
PIECES = r"[a-z]+|[0-9]+|[^\x00-\x7f]+"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return lower_ascii(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # a longer one overrules
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def split(run: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a run of letters: a word of ``counts`` costs the log of its share of
    ``total``, any other string one count in total and LETTER_COST a letter. Linear in the run's
    length for each word length: an unknown word grows letter by letter."""
    new, letter = round(MICRO * log(1 / total)), round(MICRO * LETTER_COST)
    known = {w: round(MICRO * log(n / total)) for w, n in counts.items()}
    lengths = sorted({len(w) for w in known}, reverse=True)
    best, back = [0], [0]
    open_value, open_start = None, 0  # the best split whose last word is unknown
    for e in range(1, len(run) + 1):
        start_here = best[e - 1] + new - letter
        if open_value is None or start_here > open_value - letter:
            open_value, open_start = start_here, e - 1
        else:
            open_value -= letter
        value, start = open_value, open_start
        for n in lengths:
            if n <= e:
                p = known.get(run[e - n:e])
                if p is not None and (best[e - n] + p, n - e) > (value, -start):
                    value, start = best[e - n] + p, e - n
        best.append(value)
        back.append(start)
    words, e = [], len(run)
    while e:
        words.append(run[back[e]:e])
        e = back[e]
    return words[::-1]


def spread_join(left: DataFrame, right: DataFrame, key: str, salt: Column) -> DataFrame:
    """Left join on ``key``, which is unique in ``right``. A key of many left rows is spread over up to
    SALTS tasks; ``right`` is repeated only for the salts that its key has."""
    left = left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(SALTS)))
    right = left.select(key, "_salt").distinct().join(right, key)
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def word_counts(pages: DataFrame) -> DataFrame:
    """(w, n): how often each run of two letters or more stands in the texts of ``pages(html)``,
    lower-cased and without tags."""
    text = lower_ascii(F.regexp_replace(F.col("html"), r"<[^>]*>", " "))
    runs = pages.select(F.explode(F.regexp_extract_all(text, F.lit("[a-z]{2,}"), F.lit(0))).alias("w"))
    return runs.groupBy("w").agg(F.count("*").alias("n"))


def _letter_runs(hosts: DataFrame) -> DataFrame:
    """(host, i, piece) of ``hosts(host)``, in order."""
    return hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(PIECES), F.lit(0))).alias("i", "piece"))


def segment(pieces: DataFrame, words: DataFrame) -> DataFrame:
    """(piece, words): distinct ``pieces(piece)`` split by the counts ``words(w, n)``. A run of digits
    is the word ``#``, other code points are one word."""
    words = stored(words, "words")
    total = (words.agg(F.sum("n")).first()[0] or 0) + 1
    letters = pieces.where(F.col("piece").rlike(r"\A[a-z]"))
    size = F.length("piece")
    at = letters.select("piece", F.explode(F.sequence(F.lit(1), size)).alias("p"))
    at = at.select("piece", "p", F.explode(F.sequence(F.lit(1), F.least(F.lit(KEY_LETTERS), size - F.col("p") + 1))).alias("m"))
    parts = at.select("piece", F.expr("substring(piece, p, m)").alias("key"), "p")
    keyed = words.withColumn("key", F.substring("w", 1, KEY_LETTERS))
    # long words share a first part: their piece is compared whole
    inside = parts.join(keyed, "key").where((F.length("w") <= KEY_LETTERS) | F.expr("substring(piece, p, length(w)) = w"))
    inside = inside.groupBy("piece").agg(F.collect_set(F.struct("w", "n")).alias("known"))

    def run(batches):
        for b in batches:
            out = [split(p, {k["w"]: k["n"] for k in known or []}, total) for p, known in zip(b.column("piece").to_pylist(), b.column("known").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("piece"), pa.array(out, pa.list_(pa.string()))], ["piece", "words"])

    cut = letters.join(inside, "piece", "left").mapInArrow(run, "piece string, words array<string>")
    word = F.when(F.col("piece").rlike(r"\A[0-9]"), F.lit("#")).otherwise(F.col("piece"))
    return cut.union(pieces.where(~F.col("piece").rlike(r"\A[a-z]")).select("piece", F.array(word)))


def judged(pages: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, ruled) of ``pages(page_id, url)``; ruled: allow, block or null."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path")))
    verdict = F.create_map([F.lit(x) for r in RULES for x in r])
    return rows.withColumn("ruled", verdict[F.col("rule")])


def host_words(pages: DataFrame, words: DataFrame) -> DataFrame:
    """(host, words) of each distinct host of ``pages(host)``, split by the counts ``words(w, n)``."""
    hosts = stored(pages.select("host").distinct(), "hosts")
    runs = _letter_runs(hosts)
    cut = stored(segment(runs.select("piece").distinct(), words), "segments")
    rows = spread_join(runs, cut, "piece", F.col("host")).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("i", "words"))).alias("s"))
    out = hosts.join(rows, "host", "left").select("host", F.coalesce(F.flatten("s.words"), F.array().cast("array<string>")).alias("words"))
    return stored(out, "host_words")


def _path_tokens(path: Column) -> Column:
    return F.transform(F.regexp_extract_all(lower_ascii(path), F.lit(PIECES), F.lit(0)), lambda p: F.concat(F.lit("p:"), F.when(p.rlike(r"\A[0-9]"), F.lit("#")).otherwise(p)))


def _host_tokens(words: Column) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit("h:"), w))


@dataclass
class Model:
    """hosts(host, words); odds(token, weight): log odds of block in MICRO parts; the prior's odds."""

    hosts: DataFrame
    odds: DataFrame
    prior: int


def _odds(block: Column, allow: Column) -> Column:
    return F.round(F.lit(float(MICRO)) * (F.log(block) - F.log(allow))).cast("long")


def learn(known: DataFrame, hosts: DataFrame) -> Model:
    """Naive Bayes with add-one smoothing over the tokens of ``known(host, path, ruled)``, the pages
    that a rule judges. Pages are counted per distinct host and path first, tokens after."""
    allow, block = (F.sum((F.col("ruled") == v).cast("long")).alias(v) for v in ("allow", "block"))
    by_host = known.groupBy("host").agg(allow, block).join(hosts, "host").select(F.explode(_host_tokens(F.col("words"))).alias("token"), "allow", "block")
    by_path = known.groupBy("path").agg(allow, block).select(F.explode(_path_tokens(F.col("path"))).alias("token"), "allow", "block")
    tokens = stored(by_host.union(by_path).groupBy("token").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")), "tokens")
    t = tokens.agg(F.count("*").alias("n"), F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    seen = {r.ruled: r.n for r in known.groupBy("ruled").agg(F.count("*").alias("n")).collect()}
    base_allow, base_block = (float((t[v] or 0) + max(t.n, 1)) for v in ("allow", "block"))
    odds = tokens.select("token", _odds((F.col("block") + 1) / F.lit(base_block), (F.col("allow") + 1) / F.lit(base_allow)).alias("weight"))
    prior = round(MICRO * (log(seen.get("block", 0) + 1) - log(seen.get("allow", 0) + 1)))
    return Model(hosts, odds, prior)


def _summed(rows: DataFrame, key: str, tokens: Column, odds: DataFrame, out: str) -> DataFrame:
    """(key, out): the odds of each distinct key's tokens, summed."""
    each = rows.select(key, F.explode(tokens).alias("token"))
    return spread_join(each, odds, "token", F.col(key)).groupBy(key).agg(F.sum("weight").alias(out))


def judge(rows: DataFrame, model: Model) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words) of ``rows(page_id, host, path, rule, ruled)``;
    score: the model's log odds of block; words: the segmented host."""
    hosts = model.hosts.join(_summed(model.hosts, "host", _host_tokens(F.col("words")), model.odds, "h"), "host", "left")
    paths = _summed(rows.select("path").distinct(), "path", _path_tokens(F.col("path")), model.odds, "p")
    out = spread_join(spread_join(rows, hosts, "host", F.col("page_id")), paths, "path", F.col("page_id"))
    score = F.lit(model.prior) + F.coalesce("h", F.lit(0)) + F.coalesce("p", F.lit(0))
    verdict = F.coalesce("ruled", F.when(score > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), (score / F.lit(float(MICRO))).alias("score"), F.array_join("words", " ").alias("words"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rows = stored(judged(pages.select("page_id", "url")), "judged")
    hosts = host_words(rows, word_counts(pages.select("html")))
    return judge(rows, learn(rows.where("ruled is not null"), hosts))
