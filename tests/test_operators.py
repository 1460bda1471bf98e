"""Transformations on small cases with the expected rows written out."""

import json
import random

import pytest
from helpers import messages, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywharf.functions import clock, shares
from tallywharf.operators import alerts, decode, devices, ingest, newest, sales, search
from tallywharf.plans import reports

TS = 1622208592  # 2021-05-28 21:29:52 in Shanghai
DAY = 24 * 3600


# Decoding --------------------------------------------------------------------------------------------------------


def test_logs_are_decoded_and_bad_ones_set_aside(spark):
    decoded = decode.startup_logs(messages(
        spark, {"mid": "m1", "uid": 7, "type": "startup", "ts": TS}, {"mid": "m2", "ts": str(TS)}, "{broken", None,
        "[1]", {"mid": "m3"}, {"mid": "m4", "ts": "soon"}, {"mid": "m5", "ts": 10**17},
    ))
    assert rows(decode.accepted(decoded), "mid", "uid", "ts", "log_date", "log_hour") == [
        ("m1", "7", TS, "2021-05-28", "21"), ("m2", None, TS, "2021-05-28", "21"),
    ]
    assert rows(decode.rejected(decoded), "reject_reason") == [
        ("bad ts",), ("bad ts",), ("bad ts",), ("not a JSON object",), ("not a JSON object",), ("not a JSON object",),
    ]


def test_event_fields_written_as_numbers_become_text(spark):
    decoded = decode.event_logs(messages(spark, {"mid": "m", "evid": "coupon", "pgid": 3, "itemid": 9, "ts": TS}))
    assert rows(decode.accepted(decoded), "evid", "pgid", "npgid", "itemid") == [("coupon", "3", None, "9")]


def test_orders(spark):
    decoded = decode.orders(messages(
        spark,
        {"id": "1", "total_amount": "12.5", "consignee_tel": "13812345678", "create_time": "2021-05-28 09:08:07"},
        {"id": "2", "total_amount": 3, "consignee_tel": None, "create_time": "2021-05-28 00:00:00"},
        {"id": "3", "total_amount": "much", "create_time": "2021-05-28 00:00:00"},
        {"id": "4", "total_amount": "1", "create_time": "28.5.2021"},
    ))
    assert rows(decode.accepted(decoded), "id", "total_amount", "consignee_tel", "create_date", "create_hour") == [
        ("1", 12.5, "138****5678", "2021-05-28", "9"), ("2", 3.0, None, "2021-05-28", "0"),
    ]
    assert rows(decode.rejected(decoded), "reject_reason") == [("bad create_time",), ("bad total_amount",)]


def test_messages_are_parsed_once(spark):
    plan = decode.accepted(decode.orders(messages(spark, {"id": "1"})))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


# Ingest ----------------------------------------------------------------------------------------------------------


def test_log_route(spark):
    lines = messages(
        spark, {"type": "event", "pgid": 3, "deep": {"a": [1, 2.5]}}, {"type": "startup", "ts": 5}, {"mid": "m"},
        {"type": None}, {"type": 5}, "nothing",
    )
    stamped = ingest.stamp(lines, F.col("arrived"))
    at = 1622208600
    got = [(r.topic, json.loads(r.value)) for r in ingest.route_logs(stamped).collect()]
    assert got == [
        ("event", {"type": "event", "pgid": 3, "deep": {"a": [1, 2.5]}, "ts": at}),
        ("startup", {"type": "startup", "ts": at}),
        ("startup", {"mid": "m", "ts": at}),
        ("startup", {"type": None, "ts": at}),
        ("startup", {"type": 5, "ts": at}),
    ]
    assert rows(stamped.where(~F.col("usable")), "raw") == [("nothing",)]


def test_change_route(spark):
    tables = ("order_info", "order_detail", "user_info", "sku_info")
    changes = [("ROWDATA", "shop", t, e, {"id": t + e, "note": None})
               for t in tables for e in ("INSERT", "UPDATE", "DELETE")]
    changes += [("TRANSACTIONBEGIN", "shop", "order_info", "INSERT", {"id": "x"}),
                ("ROWDATA", "other", "order_info", "INSERT", {"id": "y"})]
    frame = spark.createDataFrame(
        changes, "entry_type string, db_name string, table_name string, event_type string, after map<string,string>"
    )
    routed = ingest.route_changes(frame, db_pattern=r"shop\..*")
    got = sorted((r.topic, json.loads(r.value)["id"]) for r in routed.collect())
    assert got == [
        ("order_detail", "order_detailINSERT"), ("order_info", "order_infoINSERT"),
        ("user_info", "user_infoINSERT"), ("user_info", "user_infoUPDATE"),
    ]
    assert all(json.loads(r.value)["note"] is None for r in routed.collect())
    everything = ingest.route_changes(frame, routes=[("sku_info", ("DELETE",), "gone")])
    assert [r.topic for r in everything.collect()] == ["gone"]


# Devices ---------------------------------------------------------------------------------------------------------

LOG = "log_date string, mid string, ts bigint, log_hour string"


def test_first_per_day(spark):
    logs = spark.createDataFrame(
        [("d1", "a", 3, "3"), ("d1", "a", 1, "1"), ("d1", "a", 2, "2"), ("d2", "a", 9, "9"), ("d1", None, 5, "5"),
         ("d1", None, 4, "4")], LOG)
    want = [("d1", "a", 1, "1"), ("d1", None, 4, "4"), ("d2", "a", 9, "9")]
    assert rows(devices.first_per_day(logs), "log_date", "mid", "ts", "log_hour") == want
    assert rows(devices.first_per_day(logs, keep=["ts"])) == [w[:3] for w in want]
    again = devices.first_per_day(logs)
    assert rows(devices.first_per_day(again)) == rows(again)


def test_first_per_day_reduces_before_the_shuffle(spark):
    plan = devices.first_per_day(spark.createDataFrame([("d", "a", 1, "1")], LOG))._jdf.queryExecution()
    assert "WindowGroupLimit [log_date" in plan.executedPlan().toString() and "Partial" in plan.executedPlan().toString()


def test_unseen(spark):
    firsts = spark.createDataFrame([("d1", "a", 1, "1"), ("d2", "a", 1, "1"), ("d1", None, 1, "1")], LOG)
    seen = spark.createDataFrame([("d1", "a"), ("d1", None), ("d3", "q")], "log_date string, mid string")
    for broadcast in (True, False):
        known = devices.seen_among(firsts, seen, broadcast)
        assert rows(known) == [("d1", "a"), ("d1", None)]
        assert rows(devices.unseen(firsts, known), "log_date", "mid") == [("d2", "a")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["a", "b", None]), st.integers(0, 5),
                          st.sampled_from(["0", "1"])), min_size=1, max_size=30), st.randoms())
def test_first_per_day_does_not_depend_on_order(spark, logs, rnd):
    want = {}
    for row in logs:
        want[row[:2]] = min(want.get(row[:2], row), row, key=lambda r: r[2:])
    rnd.shuffle(logs)
    got = devices.first_per_day(spark.createDataFrame(logs, LOG)).select("log_date", "mid", "ts", "log_hour")
    assert rows(got) == sorted(want.values(), key=repr)


# Users and upserts -------------------------------------------------------------------------------------------------


def test_latest_by_key(spark):
    versions = spark.createDataFrame([(1, 1, "old"), (1, 2, "b"), (1, 2, "c"), (2, 1, "x")], "id int, v int, what string")
    assert rows(newest.latest_by_key(versions, ["id"], ["v"])) == [(1, 2, "c"), (2, 1, "x")]
    assert rows(newest.newest_version_rows(versions, ["id"], "v")) == [(1, 2, "b"), (1, 2, "c"), (2, 1, "x")]


# Sales -------------------------------------------------------------------------------------------------------------


def _orders(spark, *ids, arrived=None):
    frame = spark.createDataFrame(
        [(i, "1", "2021-05-28 09:00:00", u, "2021-05-28") for i, u in ids],
        "id string, order_status string, create_time string, user_id string, create_date string")
    return frame if arrived is None else frame.withColumn("arrived", F.timestamp_seconds(F.lit(arrived)))


def _details(spark, *details):
    return spark.createDataFrame(
        [(d, o, f"sku {d}", "s", 2.5, a) for d, o, a in details],
        "id string, order_id string, sku_name string, sku_id string, order_price double, at bigint",
    ).withColumn("arrived", F.timestamp_seconds("at")).drop("at")


@pytest.mark.parametrize("salts", [1, 4])
def test_join_sales(spark, salts):
    orders = _orders(spark, ("o1", "u1"), ("o2", "u1"), arrived=1000)
    details = _details(spark, ("d1", "o1", 1000), ("d2", "o1", 1500), ("d3", "o1", 1601), ("d4", "o2", 400),
                       ("d5", "o9", 1000), ("d6", "o2", 1600))
    timed = sales.join_sales(orders, details, "10 minutes", salts)
    assert rows(timed, "order_detail_id", "order_id", "sku_price", "dt") == [
        (d, o, 2.5, "2021-05-28") for d, o in (("d1", "o1"), ("d2", "o1"), ("d4", "o2"), ("d6", "o2"))
    ]
    assert [r[0] for r in rows(sales.join_sales(orders, details, salts=salts), "order_detail_id")] == [
        "d1", "d2", "d3", "d4", "d6"]


@pytest.mark.parametrize("salts", [1, 4])
def test_enrich(spark, salts):
    pairs = sales.join_sales(_orders(spark, ("o1", "u1"), ("o2", "u2"), ("o3", "u3")),
                             _details(spark, ("d1", "o1", 0), ("d2", "o2", 0), ("d3", "o3", 0)))
    users = spark.createDataFrame([("u1", "l", "3", "1991-06-01", "F"), ("u2", "l", "1", None, "M")],
                                  "id string, login_name string, user_level string, birthday string, gender string")
    got = sales.enrich(pairs, users, clock.wall_clock("2021-06-01 00:00:00"), salts)
    assert rows(got, "order_detail_id", "user_id", "user_age", "user_gender", "user_level") == [
        ("d1", "u1", 30, "F", "3"), ("d2", "u2", 0, "M", "1"), ("d3", "u3", 0, None, None),
    ]


# Search ------------------------------------------------------------------------------------------------------------


def _documents(spark, people):
    return spark.createDataFrame(
        [(f"d{i}", "red bolt" if i % 2 else "Red ring", g, a, "2021-05-28") for i, (g, a) in enumerate(people)],
        "order_detail_id string, sku_name string, user_gender string, user_age int, dt string")


PEOPLE = [("F", 19), ("M", 20), (None, 29), ("x", 30), ("F", 19), ("F", 19)]


def test_shares(spark):
    found = search.summary(search.matches(_documents(spark, PEOPLE[:4]), "red"))
    assert rows(search.option_rows(found, "ages")) == sorted([
        (shares.UNDER_20, 25.0), (shares.FROM_20_TO_29, 50.0), (shares.FROM_30, 25.0)], key=repr)
    assert rows(search.option_rows(found, "genders")) == sorted(
        [(shares.MALE, 66.67), (shares.FEMALE, 33.33)], key=repr)


def test_shares_of_nothing(spark):
    found = search.summary(search.matches(_documents(spark, PEOPLE), "absent"))
    assert found.first().total == 0
    assert {v for _, v in rows(search.option_rows(found, "ages"))} == {None}
    assert {v for _, v in rows(search.option_rows(found, "genders"))} == {None}


def test_pages(spark):
    hits = search.matches(_documents(spark, PEOPLE), "red bolt")
    assert [r.es_metadata_id for r in search.page(hits, 1, 4).collect()] == ["d1", "d3", "d5", "d0"]
    assert [r.es_metadata_id for r in search.page(hits, 2, 4).collect()] == ["d2", "d4"]
    assert search.page(hits, 3, 4).count() == 0


def test_deep_pages(spark):
    people = spark.range(500).repartition(7).selectExpr(
        "'d' || id AS order_detail_id", "IF(id % 3 = 0, 'red bolt', 'red ring') AS sku_name")
    hits = search.matches(people, "red bolt")
    pages = [(1, 20), (4, 50), (9, 50), (10, 60), (50, 10), (51, 10)]
    ranked = [r.order_detail_id for r in sorted(hits.collect(), key=lambda r: (-r.score, r.order_detail_id))]
    got = [[r.order_detail_id for r in search.page(hits, *p).collect()] for p in pages]
    assert got == [ranked[(n - 1) * size : n * size] for n, size in pages]
    assert [len(p) for p in got] == [20, 50, 50, 0, 10, 0]
    last, walked = None, []
    while found := search.page_after(hits, last, 130).collect():
        walked += [r.order_detail_id for r in found]
        last = (found[-1].score, found[-1].order_detail_id)
    assert walked == ranked


def test_top_terms(spark):
    hits = _documents(spark, PEOPLE)
    assert [tuple(r) for r in search.terms(hits, "user_age", 2).collect()] == [(19, 3), (20, 1)]
    assert [tuple(r) for r in search.terms(hits, "user_gender", 9).collect()] == [("F", 3), ("M", 1), ("x", 1)]


def test_shares_count_every_hit(spark):
    people = [(f"g{i % 14}" if i % 2 else "F", i) for i in range(400)]
    got = search.summary(search.matches(_documents(spark, people), "red"))
    assert dict(rows(search.option_rows(got, "ages"))) == {shares.UNDER_20: 5.0, shares.FROM_20_TO_29: 2.5, shares.FROM_30: 92.5}
    assert dict(rows(search.option_rows(got, "genders"))) == {shares.MALE: 50.0, shares.FEMALE: 50.0}


def test_search_report(spark):
    got = reports.sale_search(_documents(spark, PEOPLE), "2021-05-28", "bolt", 1, 2).first()
    assert got.total == 3
    assert [d.es_metadata_id for d in got.detail] == ["d1", "d3"]
    assert [s.title for s in got.stat] == [shares.AGE_TITLE, shares.GENDER_TITLE]
    nothing = reports.sale_search(_documents(spark, PEOPLE), "2021-05-29", "bolt", 1, 2).first()
    assert (nothing.total, nothing.detail) == (0, [])


# Alerts ------------------------------------------------------------------------------------------------------------

EVENT = "mid string, uid string, evid string, itemid string, ts bigint"


def _coupons(mid, accounts, at=TS, click=()):
    logs = [(mid, u, "coupon", f"i{u}", at) for u in accounts]
    return logs + [(mid, u, "clickItem", f"c{u}", at + 1) for u in click]


ALERT_LOGS = (
    _coupons("four", "abcd") + _coupons("three", "abc") + _coupons("clicked", "abcd", click="d")
    + _coupons(None, "abcd") + _coupons("mixed", "abcde", click="e") + [("mixed", "a", "addCart", None, TS)]
    + _coupons("unknown", ["a", "b", "c", None])
)


def _lists(found):
    """The long rows of alerts as {(mid, minute, ts): (accounts, items, events)}."""
    out = {}
    for r in found:
        lists = out.setdefault((r.mid, r.minute, r.ts), ([], [], []))
        kind = (alerts.ACCOUNT, alerts.ITEM, alerts.EVENT).index(r.kind)
        lists[kind].extend([r.value] * (r.n if kind == 2 else 1))
    return {k: tuple(tuple(sorted(x)) for x in v) for k, v in out.items()}


def _listed(frame):
    return {(mid, minute, *lists) for (mid, minute, _), lists in _lists(frame.collect()).items()}


FOUR = ("coupon",) * 4
EXPECTED = {
    ("four", tuple("abcd"), ("ia", "ib", "ic", "id"), FOUR),
    ("mixed", tuple("abcd"), ("ia", "ib", "ic", "id"), ("addCart",) + FOUR),
    ("unknown", tuple("abc"), ("iNone", "ia", "ib", "ic"), FOUR),
}


def test_alerts_tumbling(spark):
    logs = spark.createDataFrame(ALERT_LOGS, EVENT)
    got = _listed(alerts.batch_alerts(logs))
    assert got == {(m, "2021-05-28 21:30", u, i, e) for m, u, i, e in EXPECTED}


def test_alerts_sliding(spark):
    """Thirty windows hold the events; they end in five minutes, and each minute keeps its last."""
    logs = spark.createDataFrame(ALERT_LOGS, EVENT)
    found = alerts.batch_alerts(logs, slide_seconds=10)
    assert {r.ts // 1000 % 60 for r in found.where("mid = 'four'").collect()} == {50}
    assert found.where("mid = 'four'").select("doc_id").distinct().count() == 5
    assert _listed(found) == {
        (m, f"2021-05-28 21:{minute}", u, i, e) for m, u, i, e in EXPECTED for minute in (30, 31, 32, 33, 34)
    }


def _brute(logs, window, slide):
    """Alerts by plain counting: {(mid, window end): (uids, items, events)}."""
    ends = {(s // slide - k) * slide + window for *_, s in logs for k in range(-(-window // slide))}
    found = {}
    for end in ends:
        inside = [r for r in logs if r[0] is not None and end - window <= r[4] < end]
        for mid in {r[0] for r in inside}:
            mine = [r for r in inside if r[0] == mid]
            good = {
                u for u in {r[1] for r in mine}
                if any(r[1] == u and r[2] == "coupon" for r in mine)
                and not any(r[1] == u and r[2] == "clickItem" for r in mine)
            }
            if len(good) > 3:
                evidence = [r for r in mine if r[1] in good]
                found[mid, end] = (
                    sorted({r[1] for r in evidence if r[1] is not None}),
                    sorted({r[3] for r in evidence if r[3] is not None}),
                    sorted((r[2] for r in evidence), key=repr),
                )
    return found


@pytest.mark.parametrize("window, slide", [(60, 60), (60, 10), (50, 20)])
def test_alerts_against_brute_force(spark, window, slide):
    rnd = random.Random(window + slide)
    logs = [
        (rnd.choice(["a", "b", None]), rnd.choice([*"123456789", None]),
         rnd.choices(["coupon", "addCart", "clickItem", None], [60, 20, 8, 2])[0], rnd.choice(["x", "y", None]),
         TS + int(rnd.expovariate(1 / 60)))
        for _ in range(260)
    ]
    found = alerts.batch_alerts(spark.createDataFrame(logs, EVENT), window, None if slide == window else slide)
    got = {(mid, ts // 1000): lists for (mid, _, ts), lists in _lists(found.collect()).items()}
    last = {}
    for (mid, end), lists in sorted(_brute(logs, window, slide).items()):
        last[mid, end // 60] = (end, lists)
    want = {
        (mid, end): tuple(tuple(sorted(v for v in x if v is not None)) for x in lists) for (mid, _), (end, lists) in last.items()
    }
    assert got == want


def test_an_alert_has_one_form_at_every_size(spark):
    many = spark.range(20_000).selectExpr("'m' AS mid", "'a' AS uid", "'addCart' AS evid", "'x' AS itemid", f"{TS}L AS ts")
    logs = spark.createDataFrame(_coupons("m", "abcd"), EVENT).union(many)
    found = _lists(alerts.batch_alerts(logs).collect())
    assert [tuple(map(len, v)) for v in found.values()] == [(4, 5, 20_004)]


def test_alert_plan_reads_the_events_twice(spark, folder):
    spark.createDataFrame(ALERT_LOGS, EVENT).write.parquet(f"{folder}/logs")
    found = alerts.batch_alerts(spark.read.parquet(f"{folder}/logs"), 60, 30)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 2 or plan.count("FileScan") <= 3


# Reports -----------------------------------------------------------------------------------------------------------


@pytest.fixture
def dau(spark):
    return spark.createDataFrame(
        [("2021-05-27", "a", "9"), ("2021-05-27", None, "9"), ("2021-05-28", "a", "9"), ("2021-05-28", "b", "10"),
         ("2021-05-28", None, "9"), ("2021-05-29", "c", "0")], "log_date string, mid string, log_hour string")


@pytest.fixture
def order_table(spark):
    return spark.createDataFrame(
        [("2021-05-27", "9", 1.0), ("2021-05-28", "10", 2.5), ("2021-05-28", "10", 1.5), ("2021-05-28", "9", 1.0)],
        "create_date string, create_hour string, total_amount double")


def test_device_reports(dau):
    assert reports.dau_total(dau, "2021-05-28").first().dau == 3
    assert reports.new_device_count(dau, "2021-05-28").first().new_mid == 2
    assert rows(reports.dau_by_hour(dau, "2021-05-28")) == [("10", 1), ("9", 2)]
    assert rows(reports.hours_compare(dau, None, "2021-05-28", "dau")) == [
        ("today", "10", 1), ("today", "9", 2), ("yesterday", "9", 2)]


def test_amount_reports(order_table):
    assert reports.gmv_total(order_table, "2021-05-28").first().gmv == 5.0
    assert reports.gmv_total(order_table, "2021-01-01").first().gmv is None
    assert rows(reports.gmv_by_hour(order_table, "2021-01-01")) == []
    assert rows(reports.hours_compare(None, order_table, "2021-05-28", "order_amount")) == [
        ("today", "10", 4.0), ("today", "9", 1.0), ("yesterday", "9", 1.0)]


def test_kpi_totals(dau, order_table):
    assert rows(reports.kpi_totals(dau, order_table, "2021-05-28")) == sorted([
        ("dau", "新增日活", 3.0), ("new_mid", "新增设备", 2.0), ("order_amount", "新增交易额", 5.0)], key=repr)
    assert [r.value for r in reports.kpi_totals(dau, order_table, "2020-01-01").collect()] == [0.0, 0.0, None]


def test_hours_map(dau):
    got = reports.hours_map(reports.dau_hours_compare(dau, "2021-05-28")).first()
    assert list(got.today.items()) == [("9", 2), ("10", 1)] and got.yesterday == {"9": 2}
