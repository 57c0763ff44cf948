"""The corpus pipeline on edge rows: every stage's decisions take effect."""

import corpus_pipeline
from adspark.llm.common import stored

from . import brute
from .test_operators import DOCS, rows


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(rows() + [(None, "null id", None, None, 1, 1, "h", "s", 1, 1), (0, rows()[0][1], "en", None, 1, 1, "h", "s", 1, 1)], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(3)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    w = rows()[4][1].split()
    spark.createDataFrame([(1, " ".join(w[10:60]))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = now.select("doc_id", "text").collect()
        now = stored(stage(spark, now, str(tmp_path)), name)
        if name != "sharding":
            assert now.columns == docs.columns
        ids = [r.doc_id for r in now.collect()]
        if name == "near_duplicates":
            want = brute.jaccard_components([(r.doc_id, r.text) for r in before if r.doc_id is not None])
            assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if i == c) and None in ids
        if name == "decontamination":
            bad = {r[0] for r in brute.contamination([(r.doc_id, r.text) for r in before], [(1, " ".join(w[10:60]))]) if r[5]}
            assert bad and set(ids) == {r.doc_id for r in before} - bad
    assert now.count() == len(before)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_texts_that_share_an_id_stay(spark):
    """Each distinct text is a document of its own, also where rows share an id."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, a), (1, b), (2, b), (3, a), (4, a + " seven"), (5, "alone"), (5, "alone"), (None, a)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "1L n_chars", "1 node", "2 row", "3 nth")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.text, r.doc_id or 0) for r in kept.collect())
    assert [t for t, _ in got] == ["alone", a, a, a + " seven", b] and (a, 0) in got and (b, 2) in got


def test_mix_writes_the_copies_taken(spark):
    from pyspark.sql import functions as F
    from adspark.llm.decontaminate import text_hash
    from adspark.llm.mixing import mix
    rows = [(i, f"word{i} " * (1 + i % 5), ["a", "b", None][i % 3]) for i in range(60)] + [(None, "same text", "b")] * 7 + [(3, "same text", "b")] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"copies": F.lit(1), "hash": F.lit("x"), "row": F.lit(2)})
    want = mix(docs.select("doc_id", "text", "source", text_hash(F.col("text")).alias("hash")), carry=("hash",)).agg(F.sum("copies")).first()[0]
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.columns == docs.columns and out.count() == want


def test_python_steps_hold_little_of_a_batch():
    """Memory of a step follows neither the batch nor the words of 2 MB; what leaves is in small batches."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from adspark.llm import common, jaccard_join, quality

    texts = [f"some words of text {i} and {i * 7} more, " * 60 for i in range(3000)]  # about 6 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    size = sum(map(len, texts))
    common._POWERS.clear()
    tracemalloc.start()
    rows = largest = 0
    for out in jaccard_join._set_rows(iter([batch])):
        rows, largest = rows + out.num_rows, max(largest, out.num_rows)
    assert rows == len(texts) and largest < 500
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.stop()

    rng = np.random.default_rng(1)
    net = quality.Network(rng.normal(0, 0.5, (257, 6)), rng.normal(0, 0.1, (48, 32)), np.zeros(32), rng.normal(0, 0.1, 128), 0.0)
    few = batch.slice(0, 1500)
    parts = list(quality._scored(net, few, 1))
    assert [i for b, s in parts for i in b.column("doc_id").to_pylist()] == list(range(1500)) and max(b.num_rows for b, _ in parts) < 1200
    raw, offsets = common.text_bytes(few.column("text"))
    assert np.allclose(np.concatenate([s for _, s in parts]), quality.score(net, raw, offsets))
    assert size > 5e6


def test_batches_to_python_are_bounded(spark):
    """A batch that goes to Python has about BATCH_BYTES, not all rows of a task."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    from adspark.llm.common import BATCH_BYTES, BATCH_CONF, bounded_batches

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    docs = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("word "), 800).alias("text"))  # 24 MB
    spark.conf.unset(BATCH_CONF)  # a stage that ran before has set it
    try:
        bounded_batches(spark)
        got = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
        assert len(got) >= 4 and max(got) < 2 * BATCH_BYTES
        spark.conf.set(BATCH_CONF, "1000000")  # a session's own limit stays
        bounded_batches(spark)
        assert spark.conf.get(BATCH_CONF) == "1000000"
    finally:
        spark.conf.unset(BATCH_CONF)
