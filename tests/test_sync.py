"""Catalog sync: overrides, brand rules, prices, change detection, ids, feed results (FIXTURES 1.4)."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from adspark.functions import list_price, map_floor, target_price
from adspark.operators import aggregates as A
from adspark.operators import changes as K
from adspark.operators import feed as FD
from adspark.operators import joins as J
from adspark.operators import pricing as P
from adspark.plans.sync import apply_feed, fold_staged, plan_feed



def _now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")


def test_cell_overrides_latest_valid(spark):
    products = spark.createDataFrame([("s1", "A", "t", "b"), ("s1", "B", "t2", "b2")], "seller_id string, sku string, title string, brand string")
    ov = spark.createDataFrame([("s1", "A", 1, "new", "x"), ("s1", "A", 2, "nan", None), ("s1", "Z", 1, "ghost", "g")],
                               "seller_id string, sku string, seq int, title string, brand string")
    out = {r["sku"]: (r["title"], r["brand"]) for r in P.cell_overrides(products, ov, ["seller_id", "sku"], seq="seq").collect()}
    assert out == {"A": ("new", "x"), "B": ("t2", "b2")}


def test_brand_rules_cases(spark):
    products = spark.createDataFrame([
        ("1", " Acme ", "100", "10", "Yes", None), ("2", "ACME", "200", None, "No", "Yes"),
        ("3", "other", "50", "5", "Yes", "Yes"), ("4", "Beta", "80", "8", "Yes", "Yes")],
        "sku string, brand string, retail_price string, map_price string, push_to_marketplace string, push_to_site string")
    rules = spark.createDataFrame([(1, "acme", "0.2", "No", ""), (2, "beta ", None, "", "No")],
                                  "id int, brand_name string, map_fraction string, push_to_marketplace string, push_to_site string")
    out = {r["sku"]: (r["push_to_marketplace"], r["push_to_site"], r["map_price"]) for r in P.brand_rules(products, rules).collect()}
    assert out["1"] == ("No", None, 80.0)
    assert out["2"] == ("No", "Yes", 160.0)
    assert out["3"] == ("Yes", "Yes", 5.0)
    assert out["4"] == ("Yes", "No", 8.0)
    dup = rules.unionByName(rules)
    with pytest.raises(ValueError):
        P.brand_rules(products, dup)


def test_prices(spark):
    df = spark.createDataFrame([("0", "0.1", "0.2"), ("10", "0.5", "0.5"), ("abc", "0.1", "0.1"), ("10", "0.15", "0.35")],
                               "c string, f string, m string")
    got = [r[0] for r in df.select(target_price("c", "f", "m")).collect()]
    assert got == [None, None, None, 20.0]
    m = spark.createDataFrame([(20.0, "25"), (20.0, "15"), (None, "5"), (20.0, "-1")], "p double, m string")
    assert [r[0] for r in m.select(map_floor("p", "m")).collect()] == [25.0, 20.0, None, 20.0]
    lp = spark.createDataFrame([("10.004", "12.345"), ("x", "1")], "p string, r string")
    assert [r[0] for r in lp.select(list_price("p", "r")).collect()] == [12.35, None]


def test_pack_price(spark):
    base = dict(cost="10", fulfillment_cost="12", referral_fee="0.15", requested_margin="0.35", retail_price="1")
    rows = [dict(sku="pack", number_of_items="4", uom="2", price_to_push="24", **base),
            dict(sku="unit0", number_of_items="4", uom="0", price_to_push="24", **base),
            dict(sku="nopack", number_of_items=None, uom="1", price_to_push="24", **base),
            dict(sku="smaller", number_of_items="1", uom="2", price_to_push="24", **base)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in rows[0]))
    out = {r["sku"]: (r["price_to_push"], r["pack_price_applied"]) for r in P.pack_price(df).collect()}
    # pack: cost 10 * 2 + (12 - 10) = 22 -> 22 / 0.5 = 44
    assert out == {"pack": (44.0, True), "unit0": (24.0, False), "nopack": (24.0, False), "smaller": (24.0, False)}


def test_changed_rows_history_cases(spark):
    now = datetime.datetime(2024, 6, 1)
    products = spark.createDataFrame([(s, "h") for s in ["new", "d9", "d10", "d11", "hash", "success", "failed", "noend"]],
                                     "sku string, product_hash string")
    day = datetime.timedelta(days=1)
    history = spark.createDataFrame([
        ("d9", "processed", "h", now - 9 * day), ("d10", "processed", "h", now - 10 * day),
        ("d11", "processed", "h", now - 11 * day), ("hash", "processed", "other", now - day),
        ("success", "success", "h", now - day), ("failed", "failed", "h", now - day), ("noend", "processed", "h", None)],
        "sku string, status string, product_hash string, ended_at timestamp")
    ann = K.annotate_changes(products, history, "sku", now=_now(), keep_share=0.0, seed="x")
    got = {r["sku"]: r["reason"] for r in ann.collect()}
    assert got == {"new": "new", "d9": "unchanged", "d10": "stale", "d11": "stale", "hash": "hash_changed",
                   "success": "not_processed", "failed": "not_processed", "noend": "stale"}
    stats = A.change_stats(ann).first().asDict()
    assert stats == {"total": 8, "kept": 7, "filtered_out": 1, "changed": 2, "unchanged_kept": 5}
    all_kept = K.changed_rows(products, history, "sku", now=_now(), keep_share=1.0, seed="x")
    assert all_kept.count() == 8


def test_message_ids_skewed_seller(spark):
    rows = [("big", f"s{i:05d}", "UPDATE" if i % 4 else "DELETE") for i in range(3000)]
    rows += [(f"small{j}", f"s{i}", "UPDATE") for j in range(200) for i in range(3)]
    df = spark.createDataFrame(rows, "seller_id string, sku string, kind string").repartition(7)
    ids = K.message_ids(df, num_partitions=16)
    big = ids.filter("seller_id = 'big'").orderBy("message_id").collect()
    assert [r["message_id"] for r in big] == list(range(1, 3001))
    kinds = [r["kind"] for r in big]
    assert kinds == sorted(kinds, key=lambda k: k == "DELETE")
    updates = [r["sku"] for r in big if r["kind"] == "UPDATE"]
    assert updates == sorted(updates)
    small = ids.filter("seller_id = 'small7'").collect()
    assert sorted(r["message_id"] for r in small) == [1, 2, 3]
    chunks = FD.chunk_messages(ids, size=1000).filter("seller_id = 'big'").groupBy("chunk_id").count().collect()
    assert sorted(r["count"] for r in chunks) == [1000, 1000, 1000]


def _issue_doc(issues, **summary):
    doc = {"header": {"sellerId": "S"}, "issues": issues}
    if summary:
        doc["summary"] = summary
    return json.dumps(doc)


def test_feed_results(spark):
    docs = [
        ("s1", "b1", "f1", _issue_doc([
            {"messageId": 1, "message": "no severity"},
            {"messageId": 2, "severity": "ERROR", "message": "first"},
            {"messageId": 2, "severity": "WARNING", "attributeName": "x", "message": "warn"},
            {"messageId": 2, "severity": "ERROR", "attributeName": "price"},
            {"messageId": 3, "severity": "WARNING", "attributeName": "w", "message": "only warn"},
            {"messageId": 99, "severity": "ERROR", "attributeName": "a", "message": "unknown id"}],
            messagesProcessed=4, messagesAccepted=2, messagesInvalid=2)),
        ("s1", "b1", "f2", json.dumps({"header": {}})),
    ]
    raw = spark.createDataFrame(docs, "seller_id string, batch_id string, feed_id string, value string")
    issues, summary, errors = FD.parse_feed_result(raw)
    assert errors.count() == 1
    per = {r["messageId"]: (r["status"], r["errorMessage"]) for r in
           A.feed_result_by_message(issues, group=("seller_id", "batch_id")).collect()}
    assert per[1] == ("SUCCESS", "")
    assert per[2] == ("ERROR", "Unknown attribute: first; price: No message")
    assert per[3] == ("SUCCESS", "")
    msgs = spark.createDataFrame([("s1", "b1", 1, "A"), ("s1", "b1", 2, "B"), ("s1", "b1", 3, "C")],
                                 "seller_id string, batch_id string, messageId int, sku string")
    with_sku = {r["messageId"]: r["sku"] for r in J.issues_to_messages(
        A.feed_result_by_message(issues, group=("seller_id", "batch_id")), msgs, ("seller_id", "batch_id", "messageId")).collect()}
    assert with_sku[99] is None and with_sku[2] == "B"
    s = A.feed_summary(summary).first()
    assert (s["total_messages"], s["successful_messages"], s["failed_messages"], s["status"]) == (4, 2, 2, "completed_with_errors")


def test_apply_feed_results_only_this_batch(spark):
    hist = spark.createDataFrame([("A", "b1", "processing", None, None), ("A2", "b1", "processing", None, None),
                                  ("B", "b0", "processed", None, None)],
                                 "sku string, batch_id string, status string, error_description string, ended_at timestamp")
    res = spark.createDataFrame([("A", "ERROR", "x: bad"), ("B", "SUCCESS", "")], "sku string, status string, errorMessage string")
    out = {r["sku"]: (r["status"], r["error_description"], r["ended_at"] is not None)
           for r in FD.apply_feed_results(hist, res, batch_id="b1", now=_now()).collect()}
    assert out == {"A": ("failed", "x: bad", True), "A2": ("processed", None, True), "B": ("processed", None, False)}


def test_skus_to_delete_guard(spark):
    live = spark.createDataFrame([("a",), ("b",)], "sku string")
    none = spark.createDataFrame([], "sku string")
    with pytest.raises(ValueError):
        J.skus_to_delete(live, none, "sku", max_share=0.5)
    assert J.skus_to_delete(live, none, "sku", max_share=0.5, force=True).count() == 2
    sl = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "c"), ("s2", "d")], "seller_id string, sku string")
    prods = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "c")], "seller_id string, sku string")
    assert J.skus_to_delete(sl, prods, ["seller_id", "sku"], max_share=0.5, by=["seller_id"]).count() == 1
    lazy = J.skus_to_delete(sl, prods.filter("seller_id = 's1'"), ["seller_id", "sku"], max_share=0.5, by=["seller_id"])
    with pytest.raises(Exception):
        lazy.collect()


BATCHES = ("batch_id string, seller_id string, total_messages bigint, status string, failed_message string, "
           "successful_messages bigint, started_at timestamp, ended_at timestamp")


def _sync_inputs(spark):
    cols = ("seller_id string, sku string, title string, brand string, cost string, fulfillment_cost string, "
            "requested_margin string, retail_price string, map_price string, quantity string, uom string, "
            "push_to_marketplace string, push_to_site string")
    products = spark.createDataFrame([
        ("s1", "A", "Alpha", "Acme", "8", "10", "0.2", "30", "", "5", "1", "Yes", "Yes"),
        ("s1", "B", "Beta", "acme ", "8", "10", "0.2", "5", "40", "2", "1", "Yes", "Yes"),
        ("s1", "C", "Gamma", "Other", "8", "10", "0.2", "5", "None", "1", "1", "No", "Yes"),
        ("s2", "A", "Alpha2", "Other", "0", "0", "0.2", "5", "", "x", "1", "Yes", "Yes"),
        ("s2", "D", "Delta", "Other", "8", "10", "0.2", "5", "", "3", "1", "Yes", "Yes"),
    ], cols)
    ids = spark.createDataFrame([("A", "B000000001", "0.15", "true", "4"), ("B", "B000000002", "0.15", "FALSE", None),
                                 ("C", "B000000003", "0.15", None, None), ("D", "NOTAVAILABLE", "0.15", None, None)],
                                "sku string, asin string, referral_fee string, mpn_match string, number_of_items string")
    ov = spark.createDataFrame([("s1", "A", 1, "Alpha!", "50", None)],
                               "seller_id string, sku string, seq int, title string, map_price string, price_to_push string")
    history = spark.createDataFrame([("s1", "X", "processed", "h", datetime.datetime(2024, 5, 1))],
                                    "seller_id string, sku string, status string, product_hash string, ended_at timestamp")
    live = spark.createDataFrame([("s1", "A"), ("s1", "X"), ("s2", "A"), ("s2", "D")], "seller_id string, sku string")
    return products, ids, ov, history, live


def test_plan_and_apply_feed(spark):
    products, ids, ov, history, live = _sync_inputs(spark)
    plan = plan_feed(products, ids, ov, None, None, history, live, batch_id="B1", now=_now(), seed="x", keep_share=0.0,
                     max_delete_share=None)
    priced = {(r["seller_id"], r["sku"]): r["price_to_push"] for r in plan.priced.collect()}
    # s1/A: override title and MAP 50 > target 10/(1-0.15-0.2)=15.3846 -> 50; s1/B blocked by MPN false;
    # s1/C push No; s2/A cost 0 -> no price (rejected, still offered); s2/D identifier NOTAVAILABLE,
    # so its live listing is deleted.
    assert priced == {("s1", "A"): 50.0}
    assert plan.rejected.count() == 1
    staged = {(r["seller_id"], r["sku"]): (r["status"], r["kind"]) for r in plan.staged.collect()}
    assert staged == {("s1", "A"): ("processing", "UPDATE"), ("s1", "X"): ("pending_delete", "DELETE"),
                      ("s2", "D"): ("pending_delete", "DELETE")}
    msgs = {(r["seller_id"], r["sku"]): (r["message_id"], json.loads(r["message_json"])) for r in plan.messages.collect()}
    assert msgs[("s1", "A")][0] == 1 and msgs[("s1", "X")][0] == 2
    upd = msgs[("s1", "A")][1]
    assert upd["operationType"] == "UPDATE" and upd["attributes"]["merchant_suggested_asin"] == [{"value": "B000000001"}]
    assert upd["attributes"]["fulfillment_availability"][0]["quantity"] == 5
    docs = plan.documents.filter("seller_id = 's1'").collect()
    assert plan.documents.count() == 2
    assert len(docs) == 1 and [m["messageId"] for m in json.loads(docs[0]["document"])["messages"]] == [1, 2]
    hist0 = spark.createDataFrame([], plan.staged.drop("kind").schema)
    hist1 = fold_staged(hist0, plan.staged)
    assert hist1.count() == 3
    raw = spark.createDataFrame([("s1", "B1", "f1", _issue_doc([{"messageId": 1, "severity": "ERROR", "message": "bad"}],
                                                                messagesProcessed=2, messagesAccepted=1, messagesInvalid=1))],
                                "seller_id string, batch_id string, feed_id string, value string")
    batches = spark.createDataFrame([("B1", "s1", None, "processing", None, None, datetime.datetime(2024, 6, 1), None)],
                                    "batch_id string, seller_id string, total_messages bigint, status string, "
                                    "failed_message string, successful_messages bigint, started_at timestamp, ended_at timestamp")
    h2, b2, err = apply_feed(hist1, batches, raw, plan.messages, batch_id="B1", now=_now())
    st = {r["sku"]: (r["status"], r["error_description"]) for r in h2.collect()}
    assert st == {"A": ("failed", "Unknown attribute: bad"), "X": ("processed", None), "D": ("processed", None)}
    b = b2.first()
    assert (b["total_messages"], b["failed_message"], b["status"]) == (2, "1", "completed_with_errors")
    assert err.count() == 0


def test_input_order_does_not_change_output(spark):
    products, ids, ov, history, live = _sync_inputs(spark)
    a = plan_feed(products, ids, ov, None, None, history, live, batch_id="B1", now=_now(), seed="x", max_delete_share=None)
    b = plan_feed(products.orderBy(F.desc("sku")).repartition(3), ids.orderBy(F.desc("sku")), ov, None, None,
                  history, live.orderBy("sku"), batch_id="B1", now=_now(), seed="x", max_delete_share=None)
    key = lambda r: (r["seller_id"], r["sku"])
    assert sorted(map(tuple, a.messages.collect()), key=str) == sorted(map(tuple, b.messages.collect()), key=str)


def test_store_history_rewrites_only_touched_buckets(spark, tmpdir_path):
    import os
    from adspark.plans.sync import load_history, store_history
    path, staging = os.path.join(tmpdir_path, "hist"), os.path.join(tmpdir_path, "staging")
    rows = [(f"s{i}", f"k{j}", "processed") for i in range(6) for j in range(3)]
    hist = spark.createDataFrame(rows, "seller_id string, sku string, status string")
    store_history(hist, path, staging_root=staging, buckets=4)
    before = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("_bucket=")}
    current = load_history(spark, path, hist.schema)
    touched = spark.createDataFrame([("s1",)], "seller_id string")
    updated = current.withColumn("status", F.when(F.col("seller_id") == "s1", F.lit("failed")).otherwise(F.col("status")))
    store_history(updated, path, staging_root=staging, touched_sellers=touched, buckets=4)
    after = {d: sorted(os.listdir(os.path.join(path, d))) for d in os.listdir(path) if d.startswith("_bucket=")}
    changed = [d for d in before if before[d] != after.get(d)]
    assert len(changed) == 1
    got = {(r["seller_id"], r["sku"]): r["status"] for r in load_history(spark, path, hist.schema).collect()}
    assert len(got) == 18 and all((v == "failed") == (k[0] == "s1") for k, v in got.items())


def test_store_batch_history(spark, tmpdir_path):
    import os
    from adspark.plans.sync import load_history, store_history
    path, staging = os.path.join(tmpdir_path, "batches"), os.path.join(tmpdir_path, "staging")
    b = spark.createDataFrame([("B1", "s1", "processing"), ("B1", "s2", "processing")],
                              "batch_id string, seller_id string, status string")
    store_history(b, path, staging_root=staging)
    done = load_history(spark, path, b.schema).withColumn("status", F.lit("completed"))
    store_history(done, path, staging_root=staging, touched_sellers=b.select("seller_id"))
    assert {r["status"] for r in load_history(spark, path, b.schema).collect()} == {"completed"}


def test_run_plan_and_apply_jobs(spark, tmpdir_path):
    import os
    from adspark.plans.sync import load_history, run_apply_feed, run_plan_feed
    products, ids, ov, history, live = _sync_inputs(spark)
    root = tmpdir_path
    hist_schema = ("sku string, batch_id string, seller_id string, asin string, title string, price double, "
                   "status string, started_at timestamp, ended_at timestamp, error_description string, product_hash string")
    from pyspark.sql.types import _parse_datatype_string
    hschema = _parse_datatype_string(hist_schema)
    plan = run_plan_feed(products, ids, ov, None, None, live, history_path=os.path.join(root, "hist"),
                         history_schema=hschema, feed_path=os.path.join(root, "feed"),
                         staging_root=os.path.join(root, "stg"), batch_id="B1", now=_now(), seed="x",
                         keep_share=0.0, max_delete_share=None, batches_path=os.path.join(root, "batches"),
                         batches_schema=_parse_datatype_string(BATCHES))
    docs = spark.read.text(os.path.join(root, "feed", "batch_id=B1")).collect()
    assert len(docs) == 2  # s1: update and delete; s2: only a delete (one product unpriced, one without identifier)
    stored = {(r["seller_id"], r["sku"]): r["status"] for r in load_history(spark, os.path.join(root, "hist"), hschema).collect()}
    assert stored == {("s1", "A"): "processing"}  # sent deletes leave the history
    res_dir = os.path.join(root, "results", "seller_id=s1")
    os.makedirs(res_dir)
    with open(os.path.join(res_dir, "r1.json"), "w") as f:
        f.write(_issue_doc([{"messageId": 1, "severity": "ERROR", "attributeName": "price", "message": "low"}],
                           messagesProcessed=2, messagesAccepted=1, messagesInvalid=1))
    bschema = _parse_datatype_string(BATCHES)
    errors = run_apply_feed(spark, os.path.join(root, "results"), plan.messages, history_path=os.path.join(root, "hist"),
                            history_schema=hschema, batches_path=os.path.join(root, "batches"), batches_schema=bschema,
                            staging_root=os.path.join(root, "stg"), batch_id="B1", now=_now())
    assert errors.count() == 0
    after = {(r["seller_id"], r["sku"]): (r["status"], r["error_description"])
             for r in load_history(spark, os.path.join(root, "hist"), hschema).collect()}
    assert after[("s1", "A")] == ("failed", "price: low")
    assert set(after) == {("s1", "A")}
    rows = {r["seller_id"]: (r["status"], r["total_messages"]) for r in load_history(spark, os.path.join(root, "batches"), bschema).collect()}
    assert rows == {"s1": ("completed_with_errors", 2), "s2": ("processing", None)}


def test_message_ids_null_group(spark):
    df = spark.createDataFrame([(None, "a", "UPDATE"), (None, "b", "DELETE"), ("s", "c", "UPDATE")],
                               "seller_id string, sku string, kind string")
    got = sorted((r["seller_id"] or "", r["sku"], r["message_id"]) for r in K.message_ids(df, num_partitions=3).collect())
    assert got == [("", "a", 1), ("", "b", 2), ("s", "c", 1)]


def test_batch_totals_per_seller(spark):
    batches = spark.createDataFrame([("B1", "s1", None, "processing", None, None, None, None),
                                     ("B1", "s2", None, "processing", None, None, None, None),
                                     ("B1", "s3", None, "processing", None, None, None, None)], BATCHES)
    totals = spark.createDataFrame([("s1", "B1", 3, 3, 0, "completed"), ("s2", "B1", 5, 1, 4, "completed_with_errors")],
                                   "seller_id string, batch_id string, total_messages bigint, successful_messages bigint, "
                                   "failed_messages bigint, status string")
    out = FD.batch_totals(batches, totals, now=_now())
    assert out.columns == batches.columns
    assert {r["seller_id"]: (r["total_messages"], r["failed_message"], r["status"]) for r in out.collect()} == {
        "s1": (3, "0", "completed"), "s2": (5, "4", "completed_with_errors"), "s3": (None, None, "processing")}


def test_duplicate_skus_are_not_sent(spark):
    products, ids, ov, history, live = _sync_inputs(spark)
    two = ids.unionByName(spark.createDataFrame([("A", "B000000009", "0.15", "true", "4")], ids.schema))
    plan = plan_feed(products, two, ov, None, None, history, live, batch_id="B1", now=_now(), seed="x", max_delete_share=None)
    assert plan.duplicates.count() == 2 and plan.messages.filter("sku = 'A'").count() == 0
    same = plan_feed(products, ids.unionByName(ids), ov, None, None, history, live, batch_id="B1", now=_now(), seed="x",
                     max_delete_share=None)
    assert same.duplicates.count() == 0 and same.messages.filter("sku = 'A'").count() == 1


def test_retain_offered_only_for_sellers_of_the_run(spark):
    from adspark.plans.sync import retain_offered
    hist = spark.createDataFrame([("s1", "a"), ("s1", "old"), ("s2", "b")], "seller_id string, sku string")
    cur = spark.createDataFrame([("s1", "a"), ("s1", "a")], "seller_id string, sku string")
    assert sorted(map(tuple, retain_offered(hist, cur).collect())) == [("s1", "a"), ("s2", "b")]


def test_emptied_bucket_and_bucket_count(spark, tmpdir_path):
    import os
    from adspark.plans.sync import load_history, store_history
    path, staging = os.path.join(tmpdir_path, "h"), os.path.join(tmpdir_path, "s")
    hist = spark.createDataFrame([("s1", "a"), ("s2", "b"), ("s5", "c")], "seller_id string, sku string")
    store_history(hist, path, staging_root=staging, buckets=256)
    left = load_history(spark, path, hist.schema).filter("seller_id <> 's1'")
    store_history(left, path, staging_root=staging, buckets=256, touched_sellers=spark.createDataFrame([("s1",)], "seller_id string"))
    assert sorted(map(tuple, load_history(spark, path, hist.schema).collect())) == [("s2", "b"), ("s5", "c")]
    assert not os.path.exists(staging) or not os.listdir(staging)
    with pytest.raises(ValueError):
        store_history(left, path, staging_root=staging, buckets=8)


def test_eligible_sellers_blank_partner_and_unknown_standing(spark):
    users = spark.createDataFrame([(1, False), (2, False), (3, None), (4, True)], "id int, is_superuser boolean")
    oauth = spark.createDataFrame([(i, "a", "r") for i in (1, 2, 3, 4)], "user_id int, access_token string, refresh_token string")
    channels = spark.createDataFrame([(1, "P"), (2, " "), (3, "P"), (4, "P")], "user_id int, selling_partner_id string")
    ok, bad = J.eligible_sellers(users, oauth, channels)
    assert [r["id"] for r in ok.collect()] == [1] and [r["id"] for r in bad.collect()] == [2]


def test_update_message_needs_list_price(spark):
    df = spark.createDataFrame([("A", "t", "B000000001", "3", "10", 1, "12.5"), ("B", "t", "B000000002", "3", "10", 2, None)],
                               "sku string, title string, asin string, quantity string, price_to_push string, message_id int, list_price string")
    out, rejects = FD.update_messages(df)
    assert [r["sku"] for r in out.collect()] == ["A"]
    assert [(r["sku"], r["reject_reason"]) for r in rejects.collect()] == [("B", "no_list_price")]


def _two_sellers_more(spark):
    """The sync inputs with a seller past the delete guard, one with two rules for a brand, one without
    a token, one superuser and one without any product."""
    products, ids, ov, history, live = _sync_inputs(spark)
    more = products.filter("seller_id = 's1'")
    for s in ("gone", "rules", "token", "root"):
        products = products.unionByName(more.withColumn("seller_id", F.lit(s)))
    live = spark.createDataFrame([("s1", "A"), ("gone", "A"), ("gone", "X"), ("gone", "Y"), ("rules", "Z"), ("token", "A"), ("root", "A")],
                                 "seller_id string, sku string")
    rules = spark.createDataFrame([("rules", "acme", None), ("rules", " ACME", None), ("s1", "acme", None), ("gone", "acme", None)],
                                  "seller_id string, brand_name string, map_fraction string") \
        .withColumns({"push_to_marketplace": F.lit(None).cast("string"), "push_to_site": F.lit(None).cast("string")})
    return products, ids, ov, rules, history, live


def test_quarantined_sellers_do_not_stop_the_others(spark):
    products, ids, ov, rules, history, live = _two_sellers_more(spark)
    kw = dict(batch_id="B1", now=_now(), seed="x", keep_share=0.0)
    plan = plan_feed(products, ids, ov, rules, None, history, live, quarantine=True, **kw)
    assert {(r.seller_id, r.error) for r in plan.errors.collect()} == {
        ("gone", "refusing to delete 2 of 3 live SKUs"), ("rules", "more than one brand rule for acme")}
    sent = {(r.seller_id, r.sku) for r in plan.messages.collect()}
    assert sent == {("s1", "A"), ("token", "A"), ("root", "A")}
    for part in (plan.current, plan.staged, plan.documents, plan.rejected):
        assert not {"gone", "rules"} & {r.seller_id for r in part.select("seller_id").collect()}
    # without any bad seller nothing changes
    fine = products.filter("seller_id = 's1'")
    a = plan_feed(fine, ids, ov, rules.filter("seller_id = 's1'"), None, history, live.filter("seller_id = 's1'"), quarantine=True, **kw)
    b = plan_feed(fine, ids, ov, rules.filter("seller_id = 's1'"), None, history, live.filter("seller_id = 's1'"), **kw)
    assert a.errors.count() == 0 and sorted(a.messages.collect()) == sorted(b.messages.collect())
    with pytest.raises(ValueError):
        plan_feed(products, ids, ov, rules, None, history, live, **kw)


def test_run_table(spark, tmpdir_path):
    import os
    from pyspark.sql.types import _parse_datatype_string
    from adspark.plans.sync import read_run, run_apply_feed, run_plan_feed
    products, ids, ov, rules, _, live = _two_sellers_more(spark)
    live = live.unionByName(spark.createDataFrame([("wait", "A"), ("bad", "A")], "seller_id string, sku string"))
    for s in ("wait", "bad"):
        products = products.unionByName(products.filter("seller_id = 's1'").withColumn("seller_id", F.lit(s)))
    users = spark.createDataFrame([(s, s == "root") for s in ("s1", "gone", "rules", "token", "root", "idle", "wait", "bad")], "id string, is_superuser boolean")
    oauth = spark.createDataFrame([(s, "a", None if s == "token" else "r") for s in ("s1", "gone", "rules", "token", "root", "idle", "wait", "bad")],
                                  "user_id string, access_token string, refresh_token string")
    channels = spark.createDataFrame([(s, p) for s in ("s1", "gone", "rules", "root", "idle", "wait", "bad") for p in ("", "P")],
                                     "user_id string, selling_partner_id string")
    hschema = _parse_datatype_string("sku string, batch_id string, seller_id string, asin string, title string, price double, "
                                     "status string, started_at timestamp, ended_at timestamp, error_description string, product_hash string")
    bschema = _parse_datatype_string(BATCHES)
    paths = {k: os.path.join(tmpdir_path, k) for k in ("hist", "feed", "stg", "batches", "runs")}
    plan = run_plan_feed(products, ids, ov, rules, None, live, history_path=paths["hist"], history_schema=hschema, feed_path=paths["feed"],
                         staging_root=paths["stg"], batch_id="B1", now=_now(), seed="x", keep_share=0.0, batches_path=paths["batches"],
                         batches_schema=bschema, sellers=(users, oauth, channels), runs_path=paths["runs"])
    state = lambda: {r.seller_id: (r.status, r.error) for r in read_run(spark, paths["runs"], "B1").collect()}
    want = {"s1": ("running", None), "wait": ("running", None), "bad": ("running", None), "idle": ("no_data", None),
            "gone": ("error", "refusing to delete 2 of 3 live SKUs"), "rules": ("error", "more than one brand rule for acme"),
            "token": ("incomplete", "missing: refresh_token, selling_partner_id")}
    assert state() == want
    assert {r.seller_id for r in plan.messages.collect()} == {"s1", "wait", "bad"}
    for s, doc in (("s1", _issue_doc([], messagesProcessed=1, messagesAccepted=1, messagesInvalid=0)), ("bad", "{")):
        os.makedirs(os.path.join(tmpdir_path, "results", f"seller_id={s}"))
        with open(os.path.join(tmpdir_path, "results", f"seller_id={s}", "r.json"), "w") as f:
            f.write(doc)
    for _ in range(2):  # a repeated step changes nothing
        run_apply_feed(spark, os.path.join(tmpdir_path, "results"), plan.messages, history_path=paths["hist"], history_schema=hschema,
                       batches_path=paths["batches"], batches_schema=bschema, staging_root=paths["stg"], batch_id="B1", now=_now(),
                       runs_path=paths["runs"])
        assert state() == want | {"s1": ("completed", None), "bad": ("error", "unexpected result structure")}
    counted = A.run_outcomes(read_run(spark, paths["runs"], "B1").filter("status <> 'incomplete'")).first().asDict()
    assert counted == {"sellers_total": 6, "completed": 1, "error": 3, "no_data": 1}


def test_feed_files_do_not_grow_with_sellers(spark, tmpdir_path):
    import glob
    import os
    rows = spark.range(300).select(F.concat(F.lit("0"), F.col("id").cast("string")).alias("seller_id"), F.lit("a/b \"c\"\n").alias("sku"),
                                   F.lit(1).alias("message_id")).unionByName(
        spark.createDataFrame([(None, "x", 1), ("", "y", 10001)], "seller_id string, sku string, message_id int"))
    messages = FD.delete_messages(FD.chunk_messages(rows))
    path = os.path.join(tmpdir_path, "feed")
    FD.write_feed(messages, path)
    want = {tuple(r) for r in FD.feed_documents(messages).collect()}
    assert len(want) == 302 and {tuple(r) for r in FD.read_documents(spark, path).collect()} == want
    assert len(glob.glob(f"{path}/**/part-*", recursive=True)) <= 16


def test_result_files_do_not_grow_with_sellers(spark, tmpdir_path):
    import glob
    import os
    raw = spark.range(300).select(F.concat(F.lit("0"), F.col("id").cast("string")).alias("seller_id"), F.lit("f").alias("feed_id"),
                                  F.lit('{"header": {}, "issues": []}\n').alias("value"))
    path = os.path.join(tmpdir_path, "results")
    FD.store_results(raw, path)
    assert sorted(map(tuple, FD.read_results(spark, path).collect())) == sorted(map(tuple, raw.collect()))
    assert len(glob.glob(f"{path}/**/part-*", recursive=True)) <= 16


def test_priced_rows_are_dealt_by_their_key_once(spark, monkeypatch):
    import re
    seen = []
    annotate = K.annotate_changes
    monkeypatch.setattr(K, "annotate_changes", lambda *a, **kw: seen.append(annotate(*a, **kw)) or seen[-1])
    one = {"title": "t", "brand": "b", "cost": "8", "fulfillment_cost": "10", "requested_margin": "0.2", "retail_price": "5", "map_price": "", "quantity": "3",
           "uom": "1", "push_to_marketplace": "Yes", "push_to_site": "Yes"}
    names = ["seller_id", "sku", *one]
    rows = [("s1", "A", *one.values()), ("s1", "A", *one.values()), ("s1", "B", *one.values()), ("s1", "B", "u", *list(one.values())[1:])]
    products = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    ids = spark.createDataFrame([("A", "B000000001", "0.15"), ("B", "B000000002", "0.15")], "sku string, asin string, referral_fee string")
    history = spark.createDataFrame([], "seller_id string, sku string, status string, product_hash string, ended_at timestamp")
    plan = plan_feed(products, ids, None, None, None, history, products.select("seller_id", "sku"), batch_id="B", now=_now(), seed="x")
    assert [(r["sku"], r["message_id"]) for r in plan.messages.collect()] == [("A", 1)] and plan.duplicates.count() == 2
    dealt = re.findall(r"hashpartitioning\((.*?), \d+\), (?:ENSURE|REPARTITION)", seen[0]._jdf.queryExecution().executedPlan().toString())
    assert dealt and max(len(d.split(",")) for d in dealt) <= 2


def test_plan_runs_the_product_chain_once(spark):
    """what the plan returns reads the kept rows; nothing joins the products again."""
    products, ids, ov, history, live = _sync_inputs(spark)
    plan = plan_feed(products, ids, ov, None, None, history, live, batch_id="B1", now=_now(), seed="x", keep_share=0.0,
                     max_delete_share=None)
    for frame in (plan.priced, plan.rejected, plan.current, plan.annotated):
        assert "Join" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_plan_keys_that_come_more_than_once(spark):
    """Equal rows count once; several different rows of a key, or several history rows, are duplicates."""
    products, ids, ov, history, live = _sync_inputs(spark)
    more = products.filter("sku = 'A' AND seller_id = 's1'")
    products = products.union(more).union(more.withColumn("sku", F.lit("T"))).union(more.withColumn("sku", F.lit("H"))) \
        .union(more.withColumn("sku", F.lit(None).cast("string")))
    ids = ids.union(spark.createDataFrame([("T", "B000000005", "0.15", None, None), ("T", "B000000006", "0.15", None, None),
                                           ("H", "B000000007", "0.15", None, None)], ids.schema))
    old = datetime.datetime(2024, 5, 1)
    history = history.union(spark.createDataFrame([("s1", "H", "processed", "h", old), ("s1", "H", "processed", "h", old)], history.schema))
    live = live.union(spark.createDataFrame([("s1", None), ("s1", None), ("s1", "T")], live.schema))
    plan = plan_feed(products, ids, ov, None, None, history, live, batch_id="B1", now=_now(), seed="x", keep_share=0.0,
                     max_delete_share=None)
    assert sorted((r["sku"], r["reject_reason"]) for r in plan.duplicates.collect()) == [(k, "duplicate_sku") for k in "HHTT"]
    assert [r["sku"] for r in plan.annotated.collect()] == ["A"]
    assert sorted(r["sku"] for r in plan.current.collect() if r["sku"]) == ["A", "A", "A", "H", "T", "T"]
    assert sorted(((r["sku"] or "-"), r["kind"]) for r in plan.staged.collect()) == \
        [("-", "DELETE"), ("A", "UPDATE"), ("D", "DELETE"), ("X", "DELETE")]


def _shuffle_files(spark) -> int:
    import glob
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(len(glob.glob(f"{d}/**/shuffle_*.data", recursive=True)) for d in dirs)


def test_kept_tables_release_their_shuffles(spark):
    """the shuffle files of a step go when its table is written, not when the driver collects garbage."""
    from adspark.session import kept_table
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count().withColumn("none", F.lit(None))
    kept = kept_table(rows)
    assert _shuffle_files(spark) <= before and spark.conf.get(setting) == was
    assert kept.columns == rows.columns and sorted(kept.collect()) == sorted(rows.collect())


def test_message_ids_are_kept_compressed(spark, tmpdir_path, monkeypatch):
    """ids and feed documents leave small files."""
    import glob
    import os
    from adspark.operators import changes
    kept = []
    monkeypatch.setattr(changes, "kept_table", lambda df, name: kept.append(name) or df.checkpoint())
    rows = spark.range(200).select(F.lit("s").alias("seller_id"), F.format_string("%05d", "id").alias("sku"), F.lit("DELETE").alias("kind"))
    ids = K.message_ids(rows, num_partitions=3)
    assert [r["message_id"] for r in ids.orderBy("sku").collect()] == list(range(1, 201)) and kept == ["ids", "ids"]
    path = os.path.join(tmpdir_path, "feed")
    FD.write_feed(FD.delete_messages(FD.chunk_messages(ids)), path)
    text = FD.read_documents(spark, path).first()["document"]
    assert text.count("DELETE") == 200 and sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*")) < len(text) / 3


def test_run_folds_history_in_rounds(spark, tmpdir_path, monkeypatch):
    """a large history is rewritten some buckets at a time, with the same rows as at once."""
    import os
    from pyspark.sql.types import _parse_datatype_string
    from adspark.plans import sync
    products, ids, ov, rules, _, live = _two_sellers_more(spark)
    hschema = _parse_datatype_string("sku string, batch_id string, seller_id string, asin string, title string, price double, "
                                     "status string, started_at timestamp, ended_at timestamp, error_description string, product_hash string")
    bschema = _parse_datatype_string(BATCHES)
    stored = []
    for n, most in enumerate((1_000_000, 3)):
        monkeypatch.setattr(sync, "ROWS_PER_ROUND", most)
        at = {k: os.path.join(tmpdir_path, f"{n}", k) for k in ("hist", "feed", "stg", "batches", "results")}
        old = [("A", "B0", "s1", "old"), ("Z", "B0", "s1", "no longer offered"), ("X", "B0", "other", "stays")]
        sync.store_history(spark.createDataFrame(old, "sku string, batch_id string, seller_id string, title string").select(
            *[(F.col(f.name) if f.name in ("sku", "batch_id", "seller_id", "title") else F.lit(None).cast(f.dataType)).alias(f.name)
              for f in hschema.fields]), at["hist"], staging_root=at["stg"])
        kw = dict(history_path=at["hist"], history_schema=hschema, batches_path=at["batches"], batches_schema=bschema,
                  staging_root=at["stg"], batch_id="B1", now=_now())
        plan = sync.run_plan_feed(products, ids, ov, rules, None, live, feed_path=at["feed"], seed="x", keep_share=0.0, quarantine=True, **kw)
        planned = sorted(map(str, sync.load_history(spark, at["hist"], hschema).collect()))
        FD.store_results(spark.createDataFrame([("s1", "f", _issue_doc([], messagesProcessed=1, messagesAccepted=1, messagesInvalid=0))],
                                               "seller_id string, feed_id string, value string"), at["results"])
        sync.run_apply_feed(spark, at["results"], plan.messages, stored=True, **kw)
        stored.append((planned, sorted(map(str, sync.load_history(spark, at["hist"], hschema).collect()))))
    assert len(sync.bucket_rounds(7)) == 3 and sorted(sum(sync.bucket_rounds(7), [])) == list(range(64))
    assert stored[0] == stored[1] and any("'X'" in r for r in stored[0][1]) and not any("'Z'" in r for r in stored[0][1])
    assert any("'A'" in r and "B1" in r for r in stored[0][1])


def test_plan_splits_a_sku_that_many_sellers_offer(spark, monkeypatch):
    """the rows stay dealt by SKU unless a SKU has too many; the messages are the same."""
    from adspark.plans import sync
    from adspark.session import session_conf
    n = 3000
    one = {"title": "t", "brand": "b", "cost": "8", "fulfillment_cost": "10", "requested_margin": "0.2", "retail_price": "5", "map_price": "", "quantity": "3",
           "uom": "1", "push_to_marketplace": "Yes", "push_to_site": "Yes"}
    products = spark.range(n).select(F.col("id").cast("string").alias("seller_id"), F.when(F.col("id") < n - 20, "HOT").otherwise(F.concat(F.lit("K"), "id")).alias("sku"),
                                     *[F.lit(v).alias(k) for k, v in one.items()])
    ids = products.select("sku").distinct().withColumns({"asin": F.lit("B000000001"), "referral_fee": F.lit("0.15")})
    ov = products.filter("seller_id % 2 = 0").select("seller_id", "sku", F.lit(1).alias("seq"), F.concat(F.lit("T"), "seller_id").alias("title"))
    history = products.filter("seller_id % 3 = 0").select("seller_id", "sku", F.lit("processed").alias("status"), F.lit("h").alias("product_hash"),
                                                          F.lit("2024-05-01").cast("timestamp").alias("ended_at"))
    files = []
    for most in (n, 100):
        monkeypatch.setattr(sync, "ROWS_PER_SKU", most)
        with session_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            plan = plan_feed(products, ids, ov, None, None, history, products.select("seller_id", "sku"), batch_id="B", now=_now(), seed="x")
            sent = plan.messages.select("seller_id", "message_id", F.get_json_object("message_json", "$.attributes.item_name[0].value").alias("t")).collect()
        assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
        assert sorted((int(r["seller_id"]), r["message_id"], r["t"]) for r in sent) == [(i, 1, f"T{i}" if i % 2 == 0 else "t") for i in range(n)]
        files.append(plan.annotated.select("sku", F.input_file_name().alias("file")).filter("sku = 'HOT'").distinct().count())
    assert files[0] == 1 < files[1]
