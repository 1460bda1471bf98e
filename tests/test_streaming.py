"""Streaming jobs: several batches, late rows, restarts and repeated batches, against the batch functions."""

import glob
import json
import os

import pytest
from helpers import Landing, finish, messages, rows
from pyspark.sql import functions as F

from tallywharf.functions import clock
from tallywharf.operators import alerts, decode, devices, ingest, sales
from tallywharf.schemas import CHANGE, COUPON_ALERT, DAU_ROW, MESSAGE
from tallywharf.sources import keyed, topics
from tallywharf.sources.workspace import fresh_folder
from tallywharf.streaming import jobs

TS = 1622208592  # 2021-05-28 21:29:52 in Shanghai
DAY = 24 * 3600
LOG = "log_date string, mid string, ts bigint, log_hour string"


@pytest.fixture
def landing(spark, folder):
    return Landing(spark, f"{folder}/landing")


def logs(spark, *items):
    return spark.createDataFrame([(d, m, t, "0") for d, m, t in items], LOG)


# Devices -----------------------------------------------------------------------------------------------------------


def test_dau_over_batches_and_restarts(spark, folder, landing):
    table, checkpoint = f"{folder}/dau", f"{folder}/checkpoint"

    def run():
        finish(jobs.dau(landing.stream(LOG), table, checkpoint, LOG, interval=None))
        return rows(keyed.read_batches(spark, table, LOG), "log_date", "mid", "ts")

    landing.add(logs(spark, ("d1", "a", 2), ("d1", "a", 1), ("d1", None, 1)))
    assert run() == [("d1", "a", 1), ("d1", None, 1)]
    # The same device later that day and the next; the restart continues behind the first file.
    landing.add(logs(spark, ("d1", "a", 3), ("d2", "a", 4), ("d1", None, 9)))
    # A late row of a device already seen yesterday, and one not seen yet.
    landing.add(logs(spark, ("d1", "a", 0), ("d1", "b", 5)))
    after = [("d1", "a", 1), ("d1", "b", 5), ("d1", None, 1), ("d2", "a", 4)]
    assert run() == after
    assert run() == after


@pytest.mark.parametrize("limit", [jobs.BROADCAST_KEYS, 0])
def test_dau_batch_run_again_changes_nothing(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", limit)
    sink = jobs.dau_sink(f"{folder}/dau", LOG)
    batches = [logs(spark, ("d1", "a", 1)), logs(spark, ("d1", "a", 2), ("d1", "b", 3)), logs(spark, ("d2", "b", 4))]
    for batch_id in (0, 1, 1, 2, 2):
        sink(batches[batch_id], batch_id)
    stored = rows(keyed.read_batches(spark, f"{folder}/dau", LOG), "log_date", "mid", "ts", "batch_id")
    assert stored == [("d1", "a", 1, 0), ("d1", "b", 3, 1), ("d2", "b", 4, 2)]


def test_dau_equals_batch_on_ordered_input(spark, folder, landing):
    everything = [("d1" if t < 40 else "d2", "abcde"[t * 7 % 5], t) for t in range(80)]
    for part in range(4):
        landing.add(logs(spark, *everything[part * 20:part * 20 + 20]))
    finish(jobs.dau(landing.stream(LOG), f"{folder}/dau", f"{folder}/checkpoint", LOG, interval=None))
    assert rows(keyed.read_batches(spark, f"{folder}/dau", LOG), "log_date", "mid", "ts") == rows(
        devices.first_per_day(logs(spark, *everything), keep=["ts"]))


def test_dau_from_messages_sets_bad_ones_aside(spark, folder, landing):
    landing.add(messages(spark, {"mid": "m1", "ts": TS}, "{broken"))
    landing.add(messages(spark, {"mid": "m1", "ts": TS + 5}, {"mid": "m2", "ts": TS + 6}, {"mid": "m3"}))
    finish(jobs.dau_from_messages(
        landing.stream(MESSAGE), f"{folder}/dau", f"{folder}/checkpoint", f"{folder}/bad", interval=None))
    assert rows(keyed.read_batches(spark, f"{folder}/dau", DAU_ROW), "mid", "ts", "log_hour") == [
        ("m1", TS, "21"), ("m2", TS + 6, "21")]
    bad = keyed.read_batches(spark, f"{folder}/bad", "value string, reject_reason string, arrived timestamp")
    assert rows(bad, "reject_reason") == [("bad ts",), ("not a JSON object",)]


# Keyed tables --------------------------------------------------------------------------------------------------------


def test_orders_are_upserted(spark, folder, landing):
    def order(i, status, at, day="2021-05-28"):
        return messages(spark, {"id": i, "order_status": status, "total_amount": "1.5", "create_time": day + " 09:00:00"},
                        arrived=at)

    landing.add(order("1", "new", "2021-05-28 01:00:00").union(order("1", "paid", "2021-05-28 01:00:01")))
    landing.add(order("2", "new", "2021-05-28 01:00:02", "2021-05-29"))
    landing.add(order("1", "sent", "2021-05-28 01:00:03"))
    table = f"{folder}/orders"
    finish(jobs.orders(landing.stream(MESSAGE), table, f"{folder}/checkpoint", f"{folder}/bad", interval=None))
    current = jobs.order_table(spark, table)
    assert rows(current, "id", "order_status", "create_date") == [("1", "sent", "2021-05-28"), ("2", "new", "2021-05-29")]

    # Folded into a fresh table by day; later batches still win.
    folded = f"{folder}/folded"
    keyed.write_settled(current, folded, "create_date")
    assert len(glob.glob(f"{folded}/settled/create_date=*")) == 2
    keyed.write_batch(current.where("id = '2'").withColumn("order_status", F.lit("paid")), folded, 7)
    assert rows(jobs.order_table(spark, folded), "id", "order_status") == [("1", "sent"), ("2", "paid")]

    plan = jobs.order_table(spark, folded).where("create_date = '2021-05-28'")._jdf.queryExecution()
    scans = [line for line in plan.executedPlan().toString().split("\n") if "FileScan" in line]
    assert any("PartitionFilters: [isnotnull(create_date" in scan for scan in scans)
    assert any("EqualTo(create_date,2021-05-28)" in scan for scan in scans)


def test_documents_without_id_get_one(spark, folder):
    frame = spark.createDataFrame([(None, 1), (None, 1), ("x", 2)], "doc_id string, n int")
    keyed.write_batch(frame, f"{folder}/docs", 0)
    ids = [r.doc_id for r in keyed.read_batches(spark, f"{folder}/docs", "doc_id string, n int").collect()]
    assert len(set(ids)) == 3 and None not in ids and "x" in ids


def test_users_keep_the_last_version(spark, folder, landing):
    landing.add(messages(spark, {"id": "u1", "user_level": "1"}, arrived="2021-05-28 01:00:00"))
    landing.add(messages(spark, {"id": "u1", "user_level": "2"}, {"id": "u2", "extra": [1]}, {"x": 1},
                         arrived="2021-05-28 01:00:01"))
    finish(jobs.users(landing.stream(MESSAGE), f"{folder}/users", f"{folder}/checkpoint", f"{folder}/bad", interval=None))
    assert rows(jobs.user_snapshot(spark, f"{folder}/users"), "id", "user_level") == [("u1", "2"), ("u2", None)]
    asked = spark.createDataFrame([("u1",), ("u9",)], "id string")
    assert rows(jobs.user_snapshot(spark, f"{folder}/users", asked), "id", "user_level") == [("u1", "2")]
    raw = keyed.current(keyed.read_batches(spark, f"{folder}/users", jobs.USER_VERSION), ["id"], ["arrived"])
    assert json.loads(raw.where("id = 'u2'").first().value) == {"id": "u2", "extra": [1]}


# Sales -----------------------------------------------------------------------------------------------------------------

ORDER = "id string, order_status string, create_time string, user_id string, create_date string, arrived timestamp"
DETAIL = "id string, order_id string, sku_name string, sku_id string, order_price double, arrived timestamp"
SALE = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
        "sku_id string, sku_price double, sku_name string, dt string, arrived timestamp, user_gender string, "
        "user_age int, user_level string")


def _orders(spark, *items):
    frame = spark.createDataFrame(
        [(i, "1", "2021-05-28 09:00:00", u, "2021-05-28", at) for i, u, at in items],
        ORDER.replace("arrived timestamp", "at bigint"))
    return frame.withColumn("arrived", F.timestamp_seconds("at")).drop("at")


def _details(spark, *items):
    frame = spark.createDataFrame([(i, o, "n", "s", 2.5, at) for i, o, at in items],
                                  DETAIL.replace("arrived timestamp", "at bigint"))
    return frame.withColumn("arrived", F.timestamp_seconds("at")).drop("at")


@pytest.mark.parametrize("limit", [jobs.BROADCAST_KEYS, 0])
def test_sale_join(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", limit)
    left, right = Landing(spark, f"{folder}/o"), Landing(spark, f"{folder}/d")
    users = {"now": [("u1", "1991-06-01", "F", "3")]}

    def snapshot(ids):
        frame = spark.createDataFrame(users["now"], "id string, birthday string, gender string, user_level string")
        return frame.join(ids, "id", "left_semi")

    def run():
        finish(jobs.sale_details(
            left.stream(ORDER), right.stream(DETAIL), f"{folder}/sales", f"{folder}/checkpoint", snapshot,
            lambda: clock.wall_clock("2021-06-01 00:00:00"), interval=None))

    t = 1_000_000
    orders = [("o1", "u1", t), ("o2", "u9", t + 300)]
    # Same time, 5 s and 500 s late, before its order, and for no known order.
    details = [("d1", "o1", t), ("d2", "o1", t + 5), ("d3", "o2", t + 200), ("d4", "o1", t + 500), ("d5", "ox", t)]
    left.add(_orders(spark, orders[0]))
    right.add(_details(spark, *details[:3]))
    run()
    users["now"] = [("u1", "1991-06-01", "F", "4")]
    left.add(_orders(spark, orders[1]))
    right.add(_details(spark, *details[3:]))
    run()
    late = ("d6", "o1", t + 901)
    right.add(_details(spark, late))
    run()
    # Delivered twice: the document is written over.
    right.add(_details(spark, ("d4", "o1", t + 500)))
    run()
    documents = jobs.sale_documents(spark, f"{folder}/sales", SALE)
    assert rows(documents, "order_detail_id", "user_age", "user_gender", "user_level") == [
        ("d1", 30, "F", "3"), ("d2", 30, "F", "3"), ("d3", 0, None, None), ("d4", 30, "F", "4")]
    batch = sales.join_sales(_orders(spark, *orders), _details(spark, *details, late), "10 minutes")
    assert rows(batch, "order_detail_id", "order_id", "sku_price") == rows(
        documents, "order_detail_id", "order_id", "sku_price")


# Alerts ----------------------------------------------------------------------------------------------------------------

EVENT = "mid string, uid string, evid string, itemid string, ts bigint"


def test_alerts_equal_batch(spark, folder, landing):
    first = [("m", u, "coupon", "x", TS + i) for i, u in enumerate("ab")]
    second = [("m", u, "coupon", "y", TS + 20 + i) for i, u in enumerate("cd")]
    third = [("m", "a", "clickItem", "z", TS + 120), ("n", "a", "coupon", "q", TS + 130)]
    close = [("far", "z", "addCart", None, TS + DAY)]
    for part in (first, second, third, close):
        landing.add(spark.createDataFrame(part, EVENT))
    table = f"{folder}/alerts"
    finish(jobs.coupon_alerts(landing.stream(EVENT), table, f"{folder}/checkpoint", interval=None))
    documents = jobs.alert_documents(spark, table, COUPON_ALERT)
    batch = alerts.batch_alerts(spark.createDataFrame(first + second + third, EVENT), slide_seconds=10)
    got = rows(documents, *COUPON_ALERT.fieldNames())
    assert got == rows(batch, *COUPON_ALERT.fieldNames())
    # Windows from the fourth coupon up to the click.
    assert sorted({r[0] for r in got}) == ["m 2021-05-28 21:30", "m 2021-05-28 21:31"]


def test_last_window_of_a_minute_wins_with_all_its_rows(spark, folder):
    def doc(ts, value):
        return ("m t", "m", "t", "event", value, 1, ts)

    keyed.write_batch(spark.createDataFrame([doc(1, "a"), doc(1, "b")], COUPON_ALERT), f"{folder}/a", 0)
    keyed.write_batch(spark.createDataFrame([doc(2, "c")], COUPON_ALERT), f"{folder}/a", 1)
    assert rows(jobs.alert_documents(spark, f"{folder}/a", COUPON_ALERT), "value", "ts") == [("c", 2)]


# Ingest ----------------------------------------------------------------------------------------------------------------


def test_logs_travel_from_lines_to_the_dau_table(spark, folder):
    os.makedirs(f"{folder}/lines")
    with open(f"{folder}/lines/a.txt", "w") as f:
        f.write('{"type":"startup","mid":"m1","ts":1}\n{"mid":"m2"}\n{"type":"event","mid":"m1","evid":"coupon"}\nno\n')
    arrived = 1622208592
    os.utime(f"{folder}/lines/a.txt", (arrived, arrived))
    finish(jobs.route_logs(
        topics.read_files(spark, f"{folder}/lines"), f"{folder}/topics", f"{folder}/c1", f"{folder}/bad",
        f"{folder}/days", interval=None))
    assert len(glob.glob(f"{folder}/days/batch_id=0/day=2021-05-28/*.txt")) >= 1
    assert rows(keyed.read_batches(spark, f"{folder}/bad", MESSAGE), "value") == [("no",)]
    startups = topics.read_files(spark, topics.topic_path(f"{folder}/topics", "startup"))
    finish(jobs.dau_from_messages(startups, f"{folder}/dau", f"{folder}/c2", f"{folder}/bad2", interval=None))
    assert rows(keyed.read_batches(spark, f"{folder}/dau", DAU_ROW), "mid", "ts", "log_date") == [
        ("m1", arrived, "2021-05-28"), ("m2", arrived, "2021-05-28")]
    events = spark.read.text(topics.topic_path(f"{folder}/topics", "event"))
    decoded = decode.accepted(decode.event_logs(events))
    assert rows(decoded, "mid", "evid", "ts") == [("m1", "coupon", arrived)]


def test_changes_are_routed_to_topics(spark, folder, landing):
    landing.add(spark.createDataFrame([
        ("ROWDATA", "shop", "order_info", "INSERT", {"id": "1"}), ("ROWDATA", "shop", "order_info", "DELETE", {"id": "2"}),
        ("ROWDATA", "shop", "user_info", "UPDATE", {"id": "3"})], CHANGE))
    finish(jobs.route_changes(landing.stream(CHANGE), f"{folder}/topics", f"{folder}/c", interval=None))
    assert rows(spark.read.text(topics.topic_path(f"{folder}/topics", "order_info"))) == [('{"id":"1"}',)]
    assert rows(spark.read.text(topics.topic_path(f"{folder}/topics", "user_info"))) == [('{"id":"3"}',)]


def test_workspace_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = fresh_folder(spark, "x")
    assert folder.startswith(shared or "/tmp/run-") and folder != fresh_folder(spark, "x")


# What must not be lost or stop a batch --------------------------------------------------------------------------------


def test_repeated_keys_of_a_line(spark):
    lines = messages(
        spark, '{"type":"event","a":1,"a":2}', '{"ts":5,"ts":6,"type":"startup","type":"event"}', '{"a":{"b":1},"c":null}')
    got = {r.value: r.topic for r in ingest.route_logs(ingest.stamp(lines, F.col("arrived"))).collect()}
    at = int(lines.first().arrived.timestamp())
    assert {(json.dumps(json.loads(k), sort_keys=True), v) for k, v in got.items()} == {
        (json.dumps({"type": "event", "a": 2, "ts": at}, sort_keys=True), "event"),
        (json.dumps({"type": "event", "ts": at}, sort_keys=True), "event"),
        (json.dumps({"a": {"b": 1}, "c": None, "ts": at}, sort_keys=True), "startup"),
    }


def test_orders_without_id_are_set_aside(spark, folder, landing):
    def order(amount, **more):
        return {"total_amount": amount, "create_time": "2021-05-28 09:00:00", **more}

    landing.add(messages(spark, order("10.0"), order("20.0"), order("5.0", id="1")))
    finish(jobs.orders(landing.stream(MESSAGE), f"{folder}/t", f"{folder}/c", f"{folder}/bad", interval=None))
    assert rows(jobs.order_table(spark, f"{folder}/t"), "id", "total_amount") == [("1", 5.0)]
    bad = keyed.read_batches(spark, f"{folder}/bad", "value string, reject_reason string, arrived timestamp")
    assert rows(bad, "reject_reason") == [("no id",), ("no id",)]


def test_lines_without_id_get_one_that_stays(spark):
    lines = messages(spark, {"order_id": "1", "order_price": "2.5"}, {"order_id": "1", "order_price": "3.5"}, {"order_price": "1"})
    decoded = decode.order_details(lines)
    ids = [r.id for r in decode.accepted(decoded).collect()]
    assert len(set(ids)) == 2 and ids == [r.id for r in decode.accepted(decode.order_details(lines)).collect()]
    assert rows(decode.rejected(decoded), "reject_reason") == [("no order_id",)]


def test_whole_numbers_in_any_notation(spark):
    logs_ = messages(spark, {"mid": "a", "ts": 1622208592.0}, '{"mid":"b","ts":1.622208592e9}', {"mid": "c", "ts": 1.5},
                     {"mid": "d", "ts": "1622208592"})
    decoded = decode.startup_logs(logs_)
    assert rows(decode.accepted(decoded), "mid", "ts") == [("a", TS), ("b", TS), ("d", TS)]


def test_sums_over_orders_read_what_they_need(spark, folder):
    layout = "id string, create_date string, total_amount double, consignee string, trade_body string, arrived timestamp"
    frame = spark.sql("SELECT '1' id, '2021-05-28' create_date, 1.5D total_amount, 'c' consignee, 'b' trade_body, timestamp_seconds(0) arrived")
    keyed.write_batch(frame, f"{folder}/t", 0)
    current = keyed.current(keyed.read_batches(spark, f"{folder}/t", layout), ["create_date", "id"], ["arrived"])
    plan = current.agg(F.sum("total_amount"))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and not any("consignee" in x or "trade_body" in x for x in scans)
