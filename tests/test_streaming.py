import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quaymark.functions import labels as L
from quaymark.plans import serving
from quaymark.sinks import state
from quaymark.sources import events, kafka, progress
from quaymark.streaming import aggregates, runner

PAID = L.VALID_STATUSES[0]


def order(key, when, category="food", amount=1.5, status=PAID, **extra):
    return {
        "order_id": key, "user_id": "u", "order_time": when, "province": "p", "city": "c", "category": category,
        "pay_amount": amount, "order_status": status, "channel": "APP", **extra,
    }


def put(folder: Path, name: str, messages) -> None:
    folder.mkdir(exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m, ensure_ascii=False) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def box(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")


def drain(df, writer, checkpoint, mode="update"):
    assert runner.await_end(runner.start(df, writer, checkpoint, mode), timeout=120)


def test_validation_reasons(spark, rows, tmp_path):
    missing = order("o2", "2025-01-01 10:00:00")
    del missing["channel"], missing["city"]
    put(tmp_path, "a.jsonl", [order("o1", "2025-01-01 10:00:00"), "{broken", missing, "", "   ", order("o3", None)])
    good, bad = events.split_events(spark.read.text(str(tmp_path)))
    assert sorted(r["order_id"] for r in rows(good)) == ["o1", "o3"]
    assert sorted(r["reason"] for r in rows(bad)) == ["invalid json", "missing channel, city"]


def test_order_events_filters_and_defaults(spark, rows, tmp_path):
    put(tmp_path, "a.jsonl", [
        order("o1", "2025-01-01 10:00:00", amount=None),
        order(None, "2025-01-01 10:00:00"),
        order("o2", "when?"),
        order("o3", "2025-01-01 10:00:00", category=None),
        order("o4", "2025-01-01 10:00:00", status="已取消"),
        "{broken",
    ])
    got = rows(events.order_events(spark.read.text(str(tmp_path))))
    assert [(r["order_id"], r["pay_amount"]) for r in got] == [("o1", 0.0)]
    now = rows(events.at_current_time(events.order_events(spark.read.text(str(tmp_path)))))[0]["order_time"]
    assert now[:4] >= "2025" and now != "2025-01-01 10:00:00"


def sales_stream(spark, folder, **kwargs):
    lines = kafka.read_message_files(spark, str(folder))
    return aggregates.category_window_sales(events.order_events(lines), **kwargs)


def test_sliding_windows_equal_the_batch_result(spark, box):
    folder, out, checkpoint = box
    put(folder, "a.jsonl", [order(f"o{i}", f"2025-01-01 10:{i:02d}:{(i * 7) % 60:02d}", "ab"[i % 2]) for i in range(40)])
    drain(sales_stream(spark, folder), runner.change_log(out), checkpoint)
    got = runner.latest_rows(spark, out, ["window_start", "window_end", "category"]).drop("batch_id")
    want = aggregates.category_window_sales(events.order_events(spark.read.text(str(folder))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # Each order falls into two windows of one minute sliding by half a minute.
    assert got.agg(F.sum("order_count")).first()[0] == 80


def test_tumbling_windows(spark, box):
    folder, out, checkpoint = box
    put(folder, "a.jsonl", [order("o1", "2025-01-01 10:00:10"), order("o2", "2025-01-01 10:00:50")])
    drain(sales_stream(spark, folder, slide=None), runner.change_log(out), checkpoint)
    assert [r["order_count"] for r in runner.latest_rows(spark, out, ["window_start", "category"]).collect()] == [2]


def test_later_batches_update_windows_and_late_orders_are_dropped(spark, box):
    folder, out, checkpoint = box
    keys = ["window_start", "window_end", "category"]
    put(folder, "a.jsonl", [order("o1", "2025-01-01 10:00:10")])
    drain(sales_stream(spark, folder, slide=None), runner.change_log(out), checkpoint)
    put(folder, "b.jsonl", [order("o2", "2025-01-01 10:00:20"), order("o3", "2025-01-01 11:00:00")])
    drain(sales_stream(spark, folder, slide=None), runner.change_log(out), checkpoint)
    put(folder, "c.jsonl", [order("late", "2025-01-01 10:00:30"), order("o4", "2025-01-01 11:30:00")])
    drain(sales_stream(spark, folder, slide=None), runner.change_log(out), checkpoint)
    put(folder, "d.jsonl", [order("late2", "2025-01-01 10:00:40"), order("o5", "2025-01-01 11:31:00")])
    drain(sales_stream(spark, folder, slide=None), runner.change_log(out), checkpoint)
    got = {r["window_start"].strftime("%H:%M"): r["order_count"] for r in runner.latest_rows(spark, out, keys).collect()}
    assert got == {"10:00": 2, "11:00": 1, "11:30": 1, "11:31": 1}


def test_a_compacted_log_gives_the_same_rows(spark, box):
    folder, out, checkpoint = box
    keys = ["window_start", "window_end", "category"]
    for n in range(4):
        put(folder, f"{n}.jsonl", [order(f"o{n}", "2025-01-01 10:00:10"), order(f"p{n}", f"2025-01-01 10:0{n}:10", "toys")])
        drain(sales_stream(spark, folder, slide=None, watermark=None), runner.change_log(out, keys, compact_every=3), checkpoint)
    got = runner.latest_rows(spark, out, keys)
    assert len(list(Path(out).glob("place=*"))) < 4 and (Path(out) / "_base").exists()
    counts = {(r["window_start"].minute, r["category"]): r["order_count"] for r in got.collect()}
    assert counts == {(0, "food"): 4, (0, "toys"): 1, (1, "toys"): 1, (2, "toys"): 1, (3, "toys"): 1}
    runner.compact(spark, out, keys)
    again = {(r["window_start"].minute, r["category"]): r["order_count"] for r in runner.latest_rows(spark, out, keys).collect()}
    assert again == counts and len(list((Path(out) / "_base").glob("upto=*"))) == 1


def test_complete_mode_keeps_every_window(spark, box):
    folder, out, checkpoint = box
    for name, when in (("a", "10:00:10"), ("b", "12:00:10"), ("c", "14:00:10")):
        put(folder, f"{name}.jsonl", [order(name, f"2025-01-01 {when}")])
        drain(sales_stream(spark, folder, slide=None), runner.snapshots(out), checkpoint, "complete")
    latest = runner.latest_snapshot(spark, out)
    assert latest.count() == 3
    assert len(list(Path(out).glob("place=*"))) == 2


def item(key, price=10.0, owners=1000, pos=9, neg=1, when="2025-01-01 10:00:00", genres="[RPG, Indie]"):
    return {"app_id": key, "name": "n", "price": price, "genres": genres, "estimated_owners": owners,
            "positive": pos, "negative": neg, "timestamp": when}


def test_cumulative_figures_survive_a_restart(spark, box):
    folder, out, checkpoint = box

    def run():
        lines = kafka.read_message_files(spark, str(folder))
        kpis = aggregates.cumulative_kpis(events.decode(lines, events.ITEM_EVENT, "app_id"))
        drain(kpis, runner.snapshots(out), checkpoint, "complete")
        return runner.latest_snapshot(spark, out).first()

    put(folder, "a.jsonl", [item(1), item(2, price=None, owners=None, pos=None, neg=None), item(None)])
    first = run()
    assert (first["new_games_count"], float(first["avg_price"]), first["avg_owners"]) == (2, 10.0, 1000)
    assert float(first["avg_positive_rate"]) == 81.8
    put(folder, "b.jsonl", [item(3, price=20.0, owners=2001, pos=0, neg=10)])
    second = run()
    assert (second["new_games_count"], float(second["avg_price"]), second["avg_owners"]) == (3, 15.0, 1500)
    assert float(second["avg_positive_rate"]) == 42.9


def test_genre_and_kpi_windows(spark, box):
    folder, out, checkpoint = box
    put(folder, "a.jsonl", [item(1), item(2, genres="[RPG]"), item(3, when="2025-01-01 11:30:00")])
    decoded = events.decode(kafka.read_message_files(spark, str(folder)), events.ITEM_EVENT, "app_id")
    drain(aggregates.genre_window_counts(decoded, "1 hour", watermark="2 minutes"), runner.change_log(out), checkpoint)
    counts = runner.latest_rows(spark, out, ["genre", "window_start", "window_end"])
    top = serving.top_genres(counts, 1).first()
    assert (top["genre"], top["count"]) == ("RPG", 2)
    batch = events.decode(spark.read.text(str(folder)), events.ITEM_EVENT, "app_id")
    assert [r["new_games_count"] for r in aggregates.windowed_kpis(batch, "1 hour").orderBy("window_start").collect()] == [2, 1]


def message(community, price, batch=1):
    return {"community": community, "price_per_sqm": price, "checkid": batch}


def merge_stream(spark, folder):
    return events.decode(kafka.read_message_files(spark, str(folder)), events.PRICE_MESSAGE, "community")


def test_stream_merge_adds_each_batch_once(spark, box):
    folder, out, checkpoint = box
    put(folder, "a.jsonl", [message("x", 100), message("x", 101), message("y", 7), message("", 1), "{broken"])
    drain(merge_stream(spark, folder), runner.additive_merge(out), checkpoint, "append")
    put(folder, "b.jsonl", [message("x", 200, 2)])
    drain(merge_stream(spark, folder), runner.additive_merge(out), checkpoint, "append")
    drain(merge_stream(spark, folder), runner.additive_merge(out), checkpoint, "append")
    got = {r["community"]: (r["number"], r["averageprice"]) for r in runner.community_means(spark, out).collect()}
    assert got == {"x": (3, 133), "y": (1, 7)}
    # A batch delivered a second time under its old id changes nothing.
    again = spark.createDataFrame([("x", 1, 999)], "community string, number bigint, price_sum bigint")
    stream = runner.stream_id(spark, checkpoint)
    assert state.apply_once(again, out, ["community"], ["number", "price_sum"], 0, stream=stream) is False
    assert state.apply_once(again, out, ["community"], ["number", "price_sum"], 77, stream=stream) is True
    assert state.read_state(spark, out).filter("community = 'x'").first()["number"] == 4


def test_an_uncommitted_version_is_ignored_and_replaced(spark, tmp_path):
    out = str(tmp_path / "state")
    one = spark.createDataFrame([("x", 1, 5)], "community string, number bigint, price_sum bigint")
    args = (["community"], ["number", "price_sum"])
    state.apply_once(one, out, *args, 0)
    # As if the writer had been lost between state and ledger.
    spark.createDataFrame([("x", 99, 99)], one.schema).write.parquet(f"{out}/v=1/state")
    assert state.versions(spark, out) == [0]
    assert state.read_state(spark, out).first()["number"] == 1
    assert state.apply_once(one, out, *args, 1)
    assert state.read_state(spark, out).first()["number"] == 2
    for batch in range(2, 5):
        state.apply_once(one, out, *args, batch)
    assert state.versions(spark, out) == [3, 4]
    assert [tuple(r) for r in state.applied_batches(spark, out).collect()] == [("", 4)]


def test_a_second_stream_adds_to_the_same_state(spark, tmp_path):
    out = str(tmp_path / "state")
    one = spark.createDataFrame([("x", 1, 5)], "community string, number bigint, price_sum bigint")
    args = (["community"], ["number", "price_sum"])
    assert state.apply_once(one, out, *args, 0, stream="a") and state.apply_once(one, out, *args, 0, stream="b")
    assert not state.apply_once(one, out, *args, 0, stream="a")
    assert state.read_state(spark, out).first()["number"] == 2


def test_a_new_checkpoint_loses_nothing(spark, box, tmp_path):
    """Two runs with checkpoints of their own into one merge state, one log and one compacted log."""
    folder, out, _ = box
    for n in (1, 2):
        inbox = tmp_path / f"prices{n}"
        inbox.mkdir()
        put(inbox, "a.jsonl", [message("x", 10 * n, n)])
        drain(merge_stream(spark, inbox), runner.additive_merge(f"{out}/state"), f"{tmp_path}/c-state{n}", "append")
    assert runner.community_means(spark, f"{out}/state").first()["number"] == 2
    keys = ["window_start", "window_end", "category"]
    for n, category in ((1, "food"), (2, "toys"), (3, "toys")):
        inbox = tmp_path / f"orders{n}"
        inbox.mkdir()
        put(inbox, "a.jsonl", [order(f"o{n}", f"2025-01-01 1{n}:00:10", category)])
        for log, every in (("plain", None), ("folded", 2)):
            writer = runner.change_log(f"{out}/{log}", keys, compact_every=every)
            drain(sales_stream(spark, inbox, slide=None), writer, f"{tmp_path}/c-{log}{n}")
        for log in ("plain", "folded"):
            hours = sorted(r["window_start"].hour for r in runner.latest_rows(spark, f"{out}/{log}", keys).collect())
            assert hours == [10 + k for k in range(1, n + 1)]


def test_a_replayed_batch_replaces_itself_or_its_part_of_the_base(spark, tmp_path):
    out = str(tmp_path / "log")
    rows = lambda v: spark.createDataFrame([("k", v)], "key string, v int")
    save = runner.change_log(out, ["key"], compact_every=3)
    save(rows(1), 0, "s")
    save(rows(2), 1, "s")
    save(rows(3), 1, "s")
    assert len(list(Path(out).glob("place=*"))) == 2 and runner.latest_rows(spark, out, ["key"]).first()["v"] == 3
    save(rows(4), 2, "s")
    save(rows(9), 2, "s")
    assert runner.latest_rows(spark, out, ["key"]).first()["v"] == 4
    save(rows(5), 0, "t")
    assert runner.latest_rows(spark, out, ["key"]).first()["v"] == 5


def test_progress_mark(spark, tmp_path):
    path = str(tmp_path / "mark")
    assert progress.last_processed(spark, path) == 0
    progress.save_processed(spark, path, 1)
    progress.save_processed(spark, path, 2)
    progress.save_processed(spark, path, 2)
    assert progress.last_processed(spark, path) == 2
    df = spark.createDataFrame([(1,), (3,)], "checkid int")
    assert progress.pull_batch(df, 3).count() == 1
    assert [progress.next_batch(df, mark) for mark in (0, 1, 3)] == [1, 3, None]


def test_window_reports(spark, rows):
    at = lambda h: dt.datetime(2025, 1, 1, h)
    data = [(at(1), at(2), "a", 1, 5.0, 0), (at(2), at(3), "a", 2, 1.0, 1), (at(2), at(3), "b", 1, 4.0, 1)]
    df = spark.createDataFrame(data, "window_start timestamp, window_end timestamp, category string, order_count bigint, pay_amount double, batch_id bigint")
    assert rows(serving.window_summary(df)) == [{"latest_window_end": at(3), "latest_batch_id": 1}]
    assert [r["category"] for r in rows(serving.latest_window(df))] == ["b", "a"]
    assert [r["category"] for r in rows(serving.recent_windows(df, 1))] == ["b"]
    assert [r["pay_amount"] for r in rows(serving.window_trend(df))] == [5.0, 5.0]
    assert serving.latest_window(df.filter("false")).collect() == []
    df.createOrReplaceTempView("rt_windows")
    assert serving.latest_rows(spark, "rt_windows", 2).count() == 2
    missing = serving.latest_rows(spark, "no_such_view")
    assert not serving.has_rows(missing)


KEYS = ["window_start", "window_end", "category"]


def damaged_sales(spark, folder, **kwargs):
    lines = kafka.read_message_files(spark, str(folder))
    good, bad = events.accepted_and_rejected(lines, events.ORDER_EVENT, "order_id", events.ORDER_FAULTS)
    return runner.with_rejects(aggregates.category_window_sales(events.valid_order_events(good), **kwargs), bad)


def test_every_message_is_accepted_or_rejected_with_a_reason(spark, rows, tmp_path):
    lost = order("o9", "2025-01-01 10:00:00")
    del lost["order_id"]
    put(tmp_path, "a.jsonl", [
        order("o1", "2025-01-01 10:00:00"), "{broken", "", "  ", "[1]", '{"order_id": "x"} tail', lost, order(None, "2025-01-01 10:00:00"),
        order("o2", "when?"), order("o3", "2025-01-01 10:00:00", category=None), order("o4", "2025-01-01 10:00:00", amount="much"),
    ])
    good, bad = events.accepted_and_rejected(spark.read.text(str(tmp_path)), events.ORDER_EVENT, "order_id", events.ORDER_FAULTS)
    assert [r["order_id"] for r in rows(good)] == ["o1"]
    assert sorted(r["reason"] for r in rows(bad)) == sorted(
        ["invalid json"] * 3 + ["missing order_id", "null order_id", "unreadable order_time", "null category", "wrong type pay_amount"]
    )


@pytest.mark.parametrize("mode", ["update", "complete", "append"])
def test_rejects_are_a_second_output_of_the_same_batches(spark, box, mode):
    folder, out, checkpoint = box
    log = runner.snapshots(f"{out}/sales") if mode == "complete" else runner.change_log(f"{out}/sales")
    writer = runner.two_outputs(log, f"{out}/rejects")
    put(folder, "a.jsonl", [order("o1", "2025-01-01 10:00:10"), "{broken"])
    drain(damaged_sales(spark, folder, slide=None), writer, checkpoint, mode)
    put(folder, "b.jsonl", [order("o2", "2025-01-01 12:00:10"), "{worse", order("o3", "when?")])
    drain(damaged_sales(spark, folder, slide=None), writer, checkpoint, mode)
    drain(damaged_sales(spark, folder, slide=None), writer, checkpoint, mode)
    bad = runner.rejected_messages(spark, f"{out}/rejects").collect()
    assert sorted((r["value"][:6], r["reason"]) for r in bad if r["reason"] == "invalid json") == [("{broke", "invalid json"), ("{worse", "invalid json")]
    assert sorted(r["reason"] for r in bad) == ["invalid json", "invalid json", "unreadable order_time"]
    assert {r["stream"] for r in bad} == {runner.stream_id(spark, checkpoint)}
    if mode == "complete":
        assert runner.latest_snapshot(spark, f"{out}/sales").count() == 2
    elif mode == "update":
        assert runner.latest_rows(spark, f"{out}/sales", KEYS).count() == 2
    else:  # only the first window is closed
        assert [r["window_start"].hour for r in runner.closed_rows(spark, f"{out}/sales").collect()] == [10]


def test_a_replayed_batch_stores_its_rejects_once(spark, tmp_path):
    out = str(tmp_path)
    result = spark.createDataFrame([("k", 1)], "key string, v int")
    bad = spark.createDataFrame([("{x", "invalid json")], "value string, reason string")
    save = runner.two_outputs(runner.change_log(f"{out}/log"), f"{out}/rejects")

    def lost(*_):
        raise OSError("lost between the two outputs")

    with pytest.raises(OSError):
        runner.two_outputs(lost, f"{out}/rejects")(runner.with_rejects(result, bad), 4, "s")
    save(runner.with_rejects(result, bad), 4, "s")
    save(runner.with_rejects(result, bad), 4, "s")
    save(runner.with_rejects(result, bad.limit(0)), 5, "s")
    assert [tuple(r) for r in runner.rejected_messages(spark, f"{out}/rejects").collect()] == [("{x", "invalid json", "s", 4)]
    assert [tuple(r)[:2] for r in runner.latest_rows(spark, f"{out}/log", ["key"]).collect()] == [("k", 1)]


def test_append_emits_closed_windows_once_and_drops_late_orders(spark, box):
    folder, out, checkpoint = box
    batches = [
        [order("o1", "2025-01-01 10:00:10"), order("o2", "2025-01-01 10:00:40")],
        [order("o3", "2025-01-01 10:00:50"), order("o4", "2025-01-01 11:00:00")],
        [order("late", "2025-01-01 10:00:30"), order("o5", "2025-01-01 11:00:30"), order("o6", "2025-01-01 12:00:00")],
        [order("late2", "2025-01-01 11:00:59"), order("o7", "2025-01-01 12:00:01")],
    ]
    emitted = []
    for n, messages in enumerate(batches):
        put(folder, f"{n}.jsonl", messages)
        drain(sales_stream(spark, folder, slide=None), runner.closed_windows(out), checkpoint, "append")
        emitted.append(sorted((r["window_start"].strftime("%H:%M"), r["order_count"]) for r in runner.closed_rows(spark, out).collect()))
    assert emitted == [[], [("10:00", 3)], [("10:00", 3), ("11:00", 2)], [("10:00", 3), ("11:00", 2)]]


class TwoTables:
    """Stands in for a database table and its staging table; the transaction can be made to fail."""

    def __init__(self, spark, rows, schema):
        self.spark, self.schema, self.rows, self.staged, self.fails = spark, schema, rows, [], 0

    def frame(self):
        return self.spark.createDataFrame(self.rows, self.schema)

    def stage(self, df, target, table, writers=None):
        assert table == "t_staging"
        self.staged = [tuple(r) for r in df.select(*[f.split()[0] for f in self.schema.split(", ")]).collect()]

    def transaction(self, spark, target, statements):
        assert statements[0] == "DELETE FROM t WHERE window_end IN (SELECT DISTINCT window_end FROM t_staging)"
        assert statements[1].startswith("INSERT INTO t (") and statements[1].endswith(" FROM t_staging")
        if self.fails:
            self.fails -= 1
            raise OSError("connection lost; nothing is committed")
        ends = {r[1] for r in self.staged}
        self.rows = [r for r in self.rows if r[1] not in ends] + self.staged


def test_a_replay_after_a_failed_replacement_keeps_unchanged_categories(spark, monkeypatch):
    at = lambda m: dt.datetime(2025, 1, 1, 10, m)
    schema = "window_start timestamp, window_end timestamp, category string, order_count bigint, batch_id bigint, update_time timestamp"
    old = [(at(0), at(1), "food", 2, 0, at(5)), (at(0), at(1), "toys", 7, 0, at(5)), (at(1), at(2), "food", 1, 0, at(5))]
    tables = TwoTables(spark, list(old), schema)
    monkeypatch.setattr(runner.jdbc, "overwrite", tables.stage)
    monkeypatch.setattr(runner.jdbc, "run_in_transaction", tables.transaction)
    monkeypatch.setattr(runner, "read_table", lambda *a, **k: tables.frame())
    save = runner.table_changes(runner.jdbc.JdbcTarget("jdbc:x"), "t", KEYS)
    changed = spark.createDataFrame([(at(0), at(1), "food", 3)], "window_start timestamp, window_end timestamp, category string, order_count bigint")
    tables.fails = 1
    with pytest.raises(OSError):
        save(changed, 1, "s")
    assert tables.rows == old
    for _ in range(2):  # the replay, and a replay of what was committed
        save(changed, 1, "s")
        assert sorted((r[1].minute, r[2], r[3], r[4]) for r in tables.rows) == [(1, "food", 3, 1), (1, "toys", 7, 0), (2, "food", 1, 0)]
    save(changed.limit(0), 2, "s")
    assert len(tables.rows) == 3


def totals_stream(spark, folder, **limits):
    lines = kafka.read_message_files(spark, str(folder), **limits)
    from quaymark.operators.merge import running_totals

    return running_totals(events.decode(lines, events.PRICE_MESSAGE, "community"))


def test_totals_in_stream_state_write_only_their_batch(spark, box, tmp_path):
    folder, out, checkpoint = box
    put(folder, "a.jsonl", [message(f"c{i}", i) for i in range(200)] + [message("", 1), "{broken"])
    drain(totals_stream(spark, folder), runner.keyed_totals(out), checkpoint)
    put(folder, "b.jsonl", [message("c7", 13, 2)])
    drain(totals_stream(spark, folder), runner.keyed_totals(out), checkpoint)
    drain(totals_stream(spark, folder), runner.keyed_totals(out), checkpoint)
    # The second micro-batch, after a restart, wrote the one total that changed.
    second = spark.read.parquet(f"{out}/place=1")
    assert [(r["community"], r["number"], r["price_sum"]) for r in second.collect()] == [("c7", 2, 20)]
    got = {r["community"]: (r["number"], r["averageprice"]) for r in runner.community_means(spark, out).collect()}
    assert len(got) == 200 and got["c7"] == (2, 10) and got["c8"] == (1, 8)
    # Another stream into the same totals adds to them.
    other = tmp_path / "other"
    put(other, "a.jsonl", [message("c7", 70), message("new", 1)])
    drain(totals_stream(spark, other), runner.keyed_totals(out), f"{checkpoint}-2")
    got = {r["community"]: (r["number"], r["averageprice"]) for r in runner.community_means(spark, out).collect()}
    assert got["c7"] == (3, 30) and got["new"] == (1, 1) and len(got) == 201


def test_a_rate_limit_makes_several_batches_of_one_run(spark, box):
    folder, out, checkpoint = box
    for n in range(5):
        put(folder, f"{n}.jsonl", [message("x", n)])
    query = runner.start(totals_stream(spark, folder, max_files=2), runner.keyed_totals(out, compact_every=2), checkpoint)
    assert runner.await_end(query, timeout=120)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]
    assert [tuple(r) for r in runner.community_means(spark, out).collect()] == [("x", 5, 2)]
