"""Stored tables that last, messages that come again, and windows over panes."""

import os
import random

import pytest
from helpers import Landing, finish, messages, rows
from pyspark.sql import functions as F

from tallywharf.operators import alerts, search
from tallywharf.schemas import COUPON_ALERT, MESSAGE
from tallywharf.sources import documents, keyed, topics
from tallywharf.streaming import jobs

LOG = "log_date string, mid string, ts bigint"
EVENT = "mid string, uid string, evid string, itemid string, ts bigint"
TS = 1622208600


@pytest.fixture
def landing(spark, folder):
    return Landing(spark, f"{folder}/landing")


# Folding ---------------------------------------------------------------------------------------------------------------


def test_folders_stay_few_and_rows_stay_the_same(spark, folder):
    table, want, most = f"{folder}/t", {}, 0
    for n in range(44):
        keyed.fold(spark, table, n, ("id",), ("v",), fan=4)
        frame = spark.createDataFrame([(f"k{n % 7}", n // 3, n), (f"only{n}", n, n)], "id string, v int, at int").coalesce(1)
        keyed.write_batch(frame, table, n)
        want[f"k{n % 7}"], want[f"only{n}"] = n, n
        most = max(most, len(keyed.folders(spark, table)))
    assert most <= 4 * 4
    # What is listed also holds what the last fold replaced.
    assert len(keyed._all_folders(spark, table)) <= 3 * 4 * 4
    current = keyed.current(keyed.read_batches(spark, table, "id string, v int, at int"), ["id"], ["v"])
    assert {r.id: r.at for r in current.collect()} == want
    # The batch that began with the fold runs again.
    before = keyed.folders(spark, table)
    keyed.fold(spark, table, 40, ("id",), ("v",), fan=4)
    assert keyed.folders(spark, table) == before
    old = keyed.current(keyed.read_batches(spark, table, "id string, v int, at int", before=42), ["id"], ["v"])
    assert {r.id: r.at for r in old.collect()} == {k: v for k, v in want.items() if v < 42} | {"k0": 35, "k1": 36}


def test_a_fold_that_broke_off_is_not_read(spark, folder):
    table = f"{folder}/t"
    for n in range(4):
        keyed.write_batch(spark.createDataFrame([(n,)], "n int"), table, n)
    spark.createDataFrame([(99, 0)], "n int, batch_id bigint").write.parquet(f"{table}/folded/0-3")
    os.remove(f"{table}/folded/0-3/_SUCCESS")
    assert rows(keyed.read_batches(spark, table, "n int"), "n") == [(0,), (1,), (2,), (3,)]
    keyed.fold(spark, table, 4, fan=4)
    assert keyed.folders(spark, table) == [(0, 3, True)]
    assert rows(keyed.read_batches(spark, table, "n int"), "n", "batch_id") == [(n, n) for n in range(4)]


def test_devices_count_once_over_folds(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed.fold, "__defaults__", ((), (), None, 3, ()))
    sink = jobs.dau_sink(f"{folder}/dau", LOG, ("ts",), f"{folder}/first")
    rnd, seen, first = random.Random(1), {}, {}
    for n in range(10):
        batch = [(f"d{rnd.randrange(4)}", rnd.choice(["a", "b", "c", None, f"m{n}"]), n * 10 + k) for k in range(4)]
        for _ in range(1 + n % 2):
            sink(spark.createDataFrame(batch, LOG), n)
        for day, mid, ts in batch:
            seen[day, mid] = seen.get((day, mid), ts)
            if mid is not None:
                first[mid] = min(first.get(mid, day), day)
    got = keyed.read_batches(spark, f"{folder}/dau", LOG)
    assert rows(got, "log_date", "mid", "ts") == sorted(((d, m, t) for (d, m), t in seen.items()), key=repr)
    unknown = [(None, d) for d, m in seen if m is None]
    table = jobs.first_seen_table(spark, f"{folder}/first", "mid string, log_date string")
    assert rows(table, "mid", "log_date") == sorted([*first.items(), *unknown], key=repr)


def test_a_few_devices_are_looked_up_without_reading_their_day(spark, folder):
    frame = spark.range(200_000).select(
        F.lit("d1").alias("log_date"), F.sha2(F.col("id").cast("string"), 256).alias("mid"), F.col("id").alias("ts")
    )
    frame = frame.repartition(40, "ts")
    keyed.write_settled(frame, f"{folder}/dau", lookup=("mid",))
    batch = frame.where("ts IN (5, 77)").unionByName(spark.createDataFrame([("d1", "new", 9)], LOG).select("log_date", "mid", "ts"))
    stored = keyed.read_batches(spark, f"{folder}/dau", LOG)
    days = [type("Day", (), {"n": 3})]
    asked = jobs._asked(stored, batch, days).select("mid")
    assert asked.count() == 2
    plan = asked._jdf.queryExecution().executedPlan()
    asked._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    read = sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))
    assert 2 <= read < 40_000, read


# Versions ----------------------------------------------------------------------------------------------------------------


def test_the_last_line_of_a_file_wins(spark, folder):
    os.makedirs(f"{folder}/lines")

    def run(lines):
        name = f"{folder}/lines/{len(os.listdir(f'{folder}/lines'))}.txt"
        with open(name, "w") as f:
            f.writelines(line + "\n" for line in lines)
        os.utime(name, (TS, TS))
        finish(jobs.users(
            topics.read_files(spark, f"{folder}/lines"), f"{folder}/users", f"{folder}/c", f"{folder}/bad", interval=None))
        return rows(jobs.user_snapshot(spark, f"{folder}/users"), "id", "user_level")

    assert run(['{"id":"u","user_level":"9"}', '{"id":"u","user_level":"10"}']) == [("u", "10")]
    # The next batch arrives in the same second.
    assert run(['{"id":"u","user_level":"8"}', '{"id":"v","user_level":"1"}']) == [("u", "8"), ("v", "1")]


def test_a_corrected_order_is_on_one_day(spark, folder, landing):
    def order(day, amount, at):
        return messages(spark, {"id": "1", "total_amount": amount, "create_time": f"2021-05-{day} 09:00:00"},
                        arrived=f"2021-05-28 01:00:0{at}")

    def run(*frames):
        for frame in frames:
            landing.add(frame)
        finish(jobs.orders(landing.stream(MESSAGE), f"{folder}/t", f"{folder}/c", f"{folder}/bad", interval=None))
        table = jobs.order_table(spark, f"{folder}/t")
        days = {d: table.where(F.col("create_date") == f"2021-05-{d}").agg(F.sum("total_amount")).first()[0] for d in (27, 28, 29)}
        assert rows(table, "total_amount") == rows(spark.createDataFrame([(v,) for v in days.values() if v], "v double"))
        return days

    assert run(order(28, 1, 1)) == {27: None, 28: 1.0, 29: None}
    assert run(order(29, 2, 2)) == {27: None, 28: None, 29: 2.0}
    # An older version that comes late, then back to a day it has left.
    assert run(order(27, 3, 0)) == {27: None, 28: None, 29: 2.0}
    assert run(order(28, 4, 3), order(28, 5, 4)) == {27: None, 28: 5.0, 29: None}


# Alerts ------------------------------------------------------------------------------------------------------------------


def coupons(seed, n, seconds):
    rnd = random.Random(seed)
    return [(
        f"m{rnd.randrange(3)}", rnd.choice(["a", "b", "c", "d", "e", "f", None]),
        rnd.choice(["coupon"] * 5 + ["addCart", "addCart", "clickItem", None]), rnd.choice(["x", "y", None]), TS + rnd.randrange(seconds),
    ) for _ in range(n)]


def plain_alerts(events, window, slide, offset=0, before=None, more=3):
    """Window by window, minute by minute."""
    found = {}
    first = min(e[4] for e in events) // slide * slide - window
    for start in range(first - first % slide + offset % slide - slide, max(e[4] for e in events) + slide, slide):
        end = start + window
        if before is not None and end >= before:
            continue
        inside = [e for e in events if start <= e[4] < end]
        for mid in {e[0] for e in inside}:
            own = [e for e in inside if e[0] == mid]
            bad = {e[1] for e in own if e[2] == "coupon"} - {e[1] for e in own if e[2] == "clickItem"}
            if len(bad) > more:
                counts = {}
                for e in own:
                    if e[1] in bad:
                        for kind, value in (("account", e[1]), ("item", e[3]), ("event", e[2])):
                            if value is not None:
                                counts[kind, value] = counts.get((kind, value), 0) + 1
                found[mid, end // 60] = (end, counts)
    return sorted((mid, end * 1000, k, v, n) for (mid, _), (end, counts) in found.items() for (k, v), n in counts.items())


@pytest.mark.parametrize("window, slide, offset", [(300, 10, 0), (90, 60, 7), (40, 15, 3)])
def test_pane_alerts_against_every_window(spark, window, slide, offset):
    events = coupons(window, 260, 1500)
    got = alerts.batch_alerts(spark.createDataFrame(events, EVENT).repartition(3), window, slide, offset)
    want = plain_alerts(events, window, slide, offset)
    assert rows(got, "mid", "ts", "kind", "value", "n") == sorted(want, key=repr)
    assert want


def test_nothing_is_copied_into_the_panes_of_a_window(spark):
    plan = alerts.batch_alerts(spark.createDataFrame(coupons(1, 10, 100), EVENT), 300, 10)._jdf.queryExecution().toString()
    assert "sequence" in plan
    assert not any("explode(sequence" in x and "pane_start" in x for x in plan.split("\n"))


def test_sliding_stream_writes_each_alert_once(spark, folder, landing):
    events = sorted(coupons(9, 400, 1200), key=lambda e: e[4])
    for part in range(5):
        landing.add(spark.createDataFrame(events[part * 80:part * 80 + 80], EVENT))

    def run():
        finish(jobs.sliding_alerts(landing.stream(EVENT), f"{folder}/panes", f"{folder}/alerts", f"{folder}/c", interval=None))
        return keyed.read_batches(spark, f"{folder}/alerts", COUPON_ALERT)

    got = run()
    closed = max(e[4] // 10 * 10 + 10 for e in events if e[4] // 10 * 10 + 70 <= events[-1][4])
    want = plain_alerts(events, 300, 10, before=alerts.open_end(closed, 300, 10))
    assert rows(got, "mid", "ts", "kind", "value", "n") == sorted(want, key=repr)
    # Each alert is in one batch, and panes hold each event once.
    assert got.groupBy("doc_id").agg(F.countDistinct("batch_id").alias("n")).where("n > 1").count() == 0
    panes = keyed.read_batches(spark, f"{folder}/panes", jobs.PANE)
    assert panes.agg(F.sum("n")).first()[0] == sum(e[4] // 10 * 10 + 10 <= closed for e in events)
    assert run().count() == got.count()


def test_state_holds_pane_facts(spark, folder, landing):
    landing.add(spark.createDataFrame([("m", "u", "coupon", "x", TS + k) for k in range(25)], EVENT))
    query = jobs.sliding_alerts(landing.stream(EVENT), f"{folder}/p", f"{folder}/a", f"{folder}/c", interval=None)
    finish(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) == 3


def test_files_written_twice_count_once(spark, folder):
    events = sorted(coupons(4, 300, 900), key=lambda e: e[4])
    frame = spark.createDataFrame(events, EVENT).select(F.lit("event").alias("topic"), F.to_json(F.struct("*")).alias("value"), "ts")
    for batch, part in enumerate((frame.where(f"ts < {TS + 450}"), frame.where(f"ts >= {TS + 450}"))):
        for partitions in (1, 3):
            topics.write_topics(part.repartition(partitions), f"{folder}/topics", batch, marked=True)
            stream = topics.read_files(spark, topics.topic_path(f"{folder}/topics", "event"), marked=True)
            finish(jobs.sliding_alerts_from_messages(
                stream, f"{folder}/panes", f"{folder}/alerts", f"{folder}/c", once=("mark",), interval=None))
    closed = max(e[4] // 10 * 10 + 10 for e in events if e[4] // 10 * 10 + 70 <= events[-1][4])
    want = plain_alerts(events, 300, 10, before=alerts.open_end(closed, 300, 10))
    got = keyed.read_batches(spark, f"{folder}/alerts", COUPON_ALERT)
    assert rows(got, "mid", "ts", "kind", "value", "n") == sorted(want, key=repr)
    assert want


def test_a_stream_runs_by_a_clock_until_it_is_stopped(spark, folder, landing):
    landing.add(messages(spark, {"id": "u1", "user_level": "1"}, "{bad"))
    query = jobs.users(landing.stream(MESSAGE), f"{folder}/users", f"{folder}/c", f"{folder}/bad", interval="1 second")
    try:
        query.processAllAvailable()
        landing.add(messages(spark, {"id": "u1", "user_level": "2"}, arrived="2021-05-29 00:00:00"))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert rows(jobs.user_snapshot(spark, f"{folder}/users"), "id", "user_level") == [("u1", "2")]


def test_rejected_messages_of_a_joining_job_are_set_aside(spark, folder, landing):
    from tallywharf.operators import decode

    landing.add(messages(spark, {"id": "1", "create_time": "2021-05-28 09:00:00"}, "{bad"))
    finish(jobs.set_aside(landing.stream(MESSAGE), decode.orders, f"{folder}/bad", f"{folder}/c", interval=None))
    bad = keyed.read_batches(spark, f"{folder}/bad", "value string, reject_reason string, arrived timestamp")
    assert rows(bad, "value", "reject_reason") == [("{bad", "not a JSON object")]


# Search ------------------------------------------------------------------------------------------------------------------


def shop(spark):
    rnd = random.Random(3)
    words = ["red", "bolt", "blue", "nut", "红", "Bolt"]
    found = [(
        f"d{k:04d}", f"2021-05-{28 + k % 2}", " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 5))), float(k),
    ) for k in range(600)]
    return spark.createDataFrame(found, "order_detail_id string, dt string, sku_name string, sku_price double")


@pytest.mark.parametrize("day", [None, "2021-05-28"])
def test_postings_find_what_names_match(spark, folder, day):
    sales = shop(spark)
    docs, words = documents.write(sales, f"{folder}/t")
    got = search.posted(docs, words, "RED bolt 红x", day)
    want = search.matches(sales if day is None else sales.where(F.col("dt") == day), "RED bolt 红x")
    assert rows(got, *want.columns) == rows(want)
    assert search.posted(docs, words, "", day).count() == 0
    plan = search.posted(docs, words, "red", day).select("order_detail_id", "score")._jdf.queryExecution().executedPlan().toString()
    assert "In(word" in plan or "EqualTo(word" in plan
    assert not any("sku_name" in x for x in plan.split("\n") if "FileScan" in x)


def test_pages_cut_through_equal_keys(spark):
    hits = shop(spark).withColumn("score", F.lit(1)).withColumn("order_detail_id", F.expr("CAST(sku_price / 7 AS INT)").cast("string"))
    seen = []
    for number in range(1, 13):
        for paging in (search.page, search.far_page) if number in (1, 2, 9) else (search.page,):
            got = [r.sku_price for r in paging(hits, number, 10).collect()]
            assert len(got) == 10
        seen += got
    assert len(set(seen)) == len(seen) == 120


def test_far_pages_are_the_pages(spark):
    hits = search.matches(shop(spark), "red bolt nut")
    for number in (1, 9, 40, 500):
        assert [tuple(r) for r in search.far_page(hits, number, 7).collect()] == [tuple(r) for r in search.page(hits, number, 7).collect()]
