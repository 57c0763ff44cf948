"""Properties of SURVEY 5.3: idempotent loads, gap-free ids, nothing to re-send after an accepted
run, input order irrelevant."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adspark.operators import changes as K
from adspark.operators import load as L
from adspark.plans.sync import apply_feed, fold_staged, plan_feed

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["p1", "p2"]),
                          st.integers(0, 3)), max_size=12)


def _set(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(target=rows, stage=rows)
def test_upsert_and_snapshot_idempotent(spark, target, stage):
    schema = "k string, p string, v int"
    t = spark.createDataFrame(target, schema)
    # one row per key in the stage (conflicts are a separate, raising case)
    s = spark.createDataFrame(list({k: (k, p, v) for k, p, v in stage}.values()), schema)
    once = L.merge_upsert(t, s, ["k"])
    assert _set(L.merge_upsert(once, s, ["k"])) == _set(once)
    snap = L.delete_insert(t, s, ["p"])
    assert _set(L.delete_insert(snap, s, ["p"])) == _set(snap)


@SETTINGS
@given(sizes=st.lists(st.integers(1, 40), min_size=1, max_size=5), parts=st.integers(1, 9))
def test_message_ids_gap_free(spark, sizes, parts):
    data = [(f"s{i}", f"k{j:03d}", "DELETE" if j % 3 == 0 else "UPDATE") for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(data, "seller_id string, sku string, kind string").repartition(parts)
    got = {}
    for r in K.message_ids(df, num_partitions=parts).collect():
        got.setdefault(r["seller_id"], []).append(r["message_id"])
    assert {k: sorted(v) for k, v in got.items()} == {f"s{i}": list(range(1, n + 1)) for i, n in enumerate(sizes)}


def _now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_nothing_to_resend_after_accepted_run(spark):
    cols = ("seller_id string, sku string, title string, brand string, cost string, fulfillment_cost string, "
            "requested_margin string, retail_price string, map_price string, quantity string, uom string, "
            "push_to_marketplace string, push_to_site string")
    products = spark.createDataFrame([("s1", s, "T" + s, "B", "8", "10", "0.2", "5", "", "3", "1", "Yes", "Yes")
                                      for s in ("A", "B", "C")], cols)
    ids = spark.createDataFrame([(s, f"B00000000{i}", "0.15") for i, s in enumerate("ABC")],
                                "sku string, asin string, referral_fee string")
    empty_hist = spark.createDataFrame([], "seller_id string, sku string, status string, product_hash string, ended_at timestamp")
    live = spark.createDataFrame([("s1", "A")], "seller_id string, sku string")
    plan = plan_feed(products, ids, None, None, None, empty_hist, live, batch_id="B1", now=_now(), seed="x",
                     keep_share=0.0, max_delete_share=None)
    history = fold_staged(spark.createDataFrame([], plan.staged.drop("kind").schema), plan.staged)
    accepted = spark.createDataFrame(
        [("s1", "B1", "f1", '{"header": {}, "issues": [], "summary": {"messagesProcessed": 3, "messagesAccepted": 3}}')],
        "seller_id string, batch_id string, feed_id string, value string")
    batches = spark.createDataFrame([("B1", "s1", None, "processing", None, None, None, None)],
                                    "batch_id string, seller_id string, total_messages bigint, status string, "
                                    "failed_message string, successful_messages bigint, started_at timestamp, ended_at timestamp")
    history, batches, _ = apply_feed(history, batches, accepted, plan.messages, batch_id="B1", now=_now())
    assert {r["status"] for r in history.collect()} == {"processed"}
    assert batches.first()["status"] == "completed"
    again = plan_feed(products, ids, None, None, None, history, live, batch_id="B2",
                      now=F.lit("2024-06-02 00:00:00").cast("timestamp"), seed="y", keep_share=0.0,
                      max_delete_share=None)
    assert again.annotated.filter("reason <> 'unchanged'").count() == 0
    assert again.messages.count() == 0
