import json
from dataclasses import replace
from types import SimpleNamespace

import pytest

from quaymark.config import JobConfig
from quaymark.plans import jobs
from quaymark.streaming import runner


def write(folder, name, header, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


@pytest.fixture
def commerce_root(tmp_path):
    root = tmp_path / "commerce"
    write(root, "users.csv", "user_id,user_name,gender,age,province,city,member_level,register_date",
          [f"u{i},n,f,{20 + i},p,c,黄金,2024-01-0{i + 1}" for i in range(3)])
    write(root, "products.csv", "product_id,product_name,category,brand,price,cost",
          ["p1,n,food,b,1.0,0.5", "p2,n,toys,b,2.0,0.5"])
    write(root, "orders.csv",
          "order_id,user_id,order_time,pay_time,province,city,channel,order_status,total_amount,discount_amount,pay_amount",
          [f"o{i},u{i % 3},2025-01-0{i + 1} 1{i}:00:00,,p,c,APP,{'已支付' if i else '已取消'},10.0,1.0,9.0" for i in range(6)])
    write(root, "order_items.csv", "item_id,order_id,product_id,category,quantity,price,amount",
          [f"i{i}{p},o{i},{p},x,1,1.0,{1 + i}.0" for i in range(6) for p in ("p1", "p2")])
    return root


def test_commerce_job(spark, commerce_root, tmp_path):
    config = JobConfig(job="commerce", input=str(commerce_root), output=str(tmp_path / "out"))
    timings = jobs.run_commerce(spark, config)
    assert set(timings) >= {"ads_sales_time_trend", "ads_user_value_level"}
    read = lambda name: spark.read.parquet(f"{tmp_path}/out/{name}")
    assert read("ads_sales_time_trend").count() == 5
    assert read("ads_category_sales_rank").count() == 10
    assert read("ads_user_value_level").count() == 3
    rules = read("ads_category_association_rules")
    assert rules.count() == 2 and rules.first()["total_basket_count"] == 5
    assert dict(rules.dtypes)["lift"] == "decimal(10,6)" and "update_time" in rules.columns


def test_commerce_job_stops_on_empty_input(spark, commerce_root, tmp_path):
    write(commerce_root, "users.csv", "user_id,user_name,gender,age,province,city,member_level,register_date", [])
    with pytest.raises(ValueError, match="users"):
        jobs.run_commerce(spark, JobConfig(input=str(commerce_root), output=str(tmp_path / "out")))


def test_a_result_needs_a_destination(spark):
    with pytest.raises(ValueError, match="output"):
        jobs.store(JobConfig(), "t", spark.range(1))
    jobs.store(JobConfig(dry_run=True), "t", spark.range(1))


def test_listing_job_reruns_without_duplicates(spark, tmp_path):
    header = "市区,小区,户型,朝向,楼层,装修情况,电梯,面积(㎡),价格(万元),年份"
    write(tmp_path, "l.csv", header, [f"海淀,a,{i}室1厅,南,3,精装,有电梯,{60 + 40 * i},500,200{i}" for i in range(1, 5)])
    root = str(tmp_path / "out")
    for batch in (1, 1, 2):
        jobs.run_listings(spark, JobConfig(job="listings", input=str(tmp_path / "l.csv"), output=root, batch_id=batch))
    registry = jobs.report_registry(spark, root)
    assert registry.get("district").count() == 2 and registry.get("community").count() == 2
    assert registry.get("area").count() == 4
    assert spark.read.parquet(f"{root}/house_info_clean_checkid").count() == 8
    with pytest.raises(KeyError):
        registry.get("users; drop")


def test_catalogue_job_and_reports(spark, tmp_path):
    header = (
        "AppID,Name,Release date,Estimated owners,Price,Average playtime forever,Recommendations,Positive,Negative,"
        "Metacritic score,Genres,Tags,Developers,Publishers,Windows,Mac,Linux"
    )
    lines = [
        f"{i},\"Game \"\"{i}\"\"\",\"Oct 21, 20{10 + i % 3}\",0 - {i}000,{i}.99,5,6000,90,5,80,\"['RPG', 'Indie']\",\"['a', 'b']\",D{i % 2},P,True,False,False"
        for i in range(1, 9)
    ]
    write(tmp_path, "games.csv", header, lines)
    root = str(tmp_path / "out")
    timings = jobs.run_catalogue(spark, JobConfig(job="catalogue", input=str(tmp_path / "games.csv"), output=root))
    assert "frequent_tags" in timings
    registry = jobs.report_registry(spark, root)
    market = jobs.bundle(registry, "market")
    assert market["market/trend"].count() == 3 and market["market/summary"].first()["peak_count"] == 3
    overview = jobs.bundle(registry, "overview")
    assert overview["overview/overview"].first()["total_games"] == 8
    assert overview["developer/summary"].first()["top_dev"] == "D0"
    assert jobs.bundle(registry, "genres")["genres/tags"].count() == 2
    with pytest.raises(KeyError):
        jobs.bundle(registry, "nothing")


def test_stream_jobs_drain_message_files(spark, tmp_path):
    inbox = tmp_path / "in"
    order = {"order_id": "o", "user_id": "u", "order_time": "2025-01-01 10:00:00", "province": "p", "city": "c",
             "category": "food", "pay_amount": 2.5, "order_status": "已支付", "channel": "APP"}
    write(inbox, "a.jsonl", json.dumps(order, ensure_ascii=False), [])
    base = dict(input=str(inbox), output=str(tmp_path / "out"), drain=True)
    for mode in ("update", "complete"):
        own = {**base, "output": str(tmp_path / mode)}
        config = JobConfig(job="category-stream", checkpoint=str(tmp_path / f"c-{mode}"), output_mode=mode, **own)
        runner.await_end(jobs.start_category_stream(spark, config))
        assert spark.read.parquet(f"{tmp_path}/{mode}/rt_category_window_sales").count() == 2
    items = tmp_path / "items"
    write(items, "a.jsonl", json.dumps({"app_id": 1, "price": 3.0, "positive": 1, "negative": 0, "estimated_owners": 5}), [])
    config = JobConfig(job="item-stream", checkpoint=str(tmp_path / "c3"), **{**base, "input": str(items)})
    runner.await_end(jobs.start_item_stream(spark, config))
    assert runner.latest_snapshot(spark, f"{tmp_path}/out/realtime_game_stats").first()["new_games_count"] == 1
    prices = tmp_path / "prices"
    write(prices, "a.jsonl", json.dumps({"community": "x", "price_per_sqm": 5, "checkid": 1}), [])
    config = JobConfig(job="community-stream", checkpoint=str(tmp_path / "c4"), **{**base, "input": str(prices)})
    runner.await_end(jobs.start_community_stream(spark, config))
    assert jobs.report_registry(spark, str(tmp_path / "out")).get("certain").first()["averageprice"] == 5


def test_a_running_stream_can_be_stopped(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, "a.jsonl", "{}", [])
    config = JobConfig(job="community-stream", input=str(inbox), output=str(tmp_path / "out"),
                       checkpoint=str(tmp_path / "c"), trigger_seconds=1)
    query = jobs.start_community_stream(spark, config)
    assert runner.await_end(query, timeout=3) is False
    assert not query.isActive


def test_each_flow_has_its_own_lasting_checkpoint(spark, tmp_path):
    def session(folder):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder))

    flow = JobConfig(job="community-stream", input=str(tmp_path / "in"), output=str(tmp_path / "a"))
    with pytest.raises(ValueError):
        jobs._checkpoint(session(None), flow)
    lasting = session(str(tmp_path / "lasting"))
    assert jobs._checkpoint(lasting, flow) == jobs._checkpoint(lasting, replace(flow, drain=True))
    write(tmp_path / "in", "a.jsonl", json.dumps({"community": "x", "price_per_sqm": 5, "checkid": 1}), [])
    for output in ("a", "b"):
        own = replace(flow, output=str(tmp_path / output), drain=True)
        own = replace(own, checkpoint=jobs._checkpoint(lasting, own))
        for _ in range(2):
            runner.await_end(jobs.start_community_stream(spark, own))
        assert runner.community_means(spark, f"{tmp_path}/{output}/certain_analysis").first()["number"] == 1


def test_publish_orders_sets_bad_lines_aside(spark, tmp_path):
    order = {"order_id": "o", "user_id": "u", "order_time": "2025-01-01 10:00:00", "province": "p", "city": "c",
             "category": "food", "pay_amount": 2.5, "order_status": "已支付", "channel": "APP"}
    write(tmp_path / "in", "a.jsonl", json.dumps(order, ensure_ascii=False), ["{broken", "", json.dumps({"order_id": "x"})])
    config = JobConfig(job="publish-orders", input=str(tmp_path / "in"), output=str(tmp_path / "out"), current_time=True)
    jobs.run_publish_orders(spark, config)
    sent = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/out/messages").collect()]
    assert [m["order_id"] for m in sent] == ["o"] and sent[0]["order_time"] != order["order_time"]
    assert spark.read.json(f"{tmp_path}/out/rejected").count() == 2


def test_publish_prices_resumes_after_the_mark(spark, tmp_path):
    schema = "checkid int, district string, community string, area int, price_per_sqm int"
    rows = [(1, "海淀", "a", 100, 5), (1, "海淀", "b", 80, 5), (2, "海淀", "a", 90, 7), (2, "x", "a", 90, 7), (4, "海淀", "a", 90, 9)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "clean"))
    config = JobConfig(job="publish-prices", input=str(tmp_path / "clean"), output=str(tmp_path / "out"))
    assert list(jobs.run_publish_prices(spark, config)) == ["batch 1", "batch 2", "batch 4"]
    assert jobs.run_publish_prices(spark, config) == {}
    sent = sorted(r["value"] for r in spark.read.text(f"{tmp_path}/out/messages").collect())
    assert sent == [f'{{"checkid":{n},"community":"a","price_per_sqm":{p}}}' for n, p in ((1, 5), (2, 7), (4, 9))]


@pytest.mark.parametrize("job,schema_key", [("category-stream", "order_id"), ("item-stream", "app_id"), ("item-window-stream", "app_id"), ("genre-stream", "app_id"), ("community-stream", "community")])
def test_every_stream_job_stores_its_rejects(spark, tmp_path, job, schema_key):
    good = {
        "order_id": json.dumps({"order_id": "o", "order_time": "2025-01-01 10:00:00", "category": "food", "pay_amount": 2.5, "order_status": "已支付"}, ensure_ascii=False),
        "app_id": json.dumps({"app_id": 1, "price": 3.0, "genres": "[RPG]", "timestamp": "2025-01-01 10:00:00"}),
        "community": json.dumps({"community": "x", "price_per_sqm": 5, "checkid": 1}),
    }[schema_key]
    for n in range(3):
        write(tmp_path / "in", f"{n}.jsonl", good, ["{broken", '{"other": 1}', ""])
    config = JobConfig(job=job, input=str(tmp_path / "in"), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "c"), drain=True, max_files=1)
    for _ in range(2):
        query = jobs.STREAM_JOBS[job](spark, config)
        runner.await_end(query)
    bad = runner.rejected_messages(spark, jobs.rejects_path(spark, config)).collect()
    assert sorted(r["reason"] for r in bad) == ["invalid json"] * 3 + [f"missing {schema_key}"] * 3
    assert len({r["batch_id"] for r in bad}) == 3


def test_append_job_stores_closed_windows(spark, tmp_path):
    def order(minute):
        return json.dumps({"order_id": "o", "order_time": f"2025-01-01 10:{minute}:00", "category": "food", "pay_amount": 2.5, "order_status": "已支付"}, ensure_ascii=False)

    for n, minute in enumerate(("00", "30")):
        write(tmp_path / "in", f"{n}.jsonl", order(minute), [])
    config = JobConfig(job="category-stream", input=str(tmp_path / "in"), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "c"),
                       drain=True, max_files=1, output_mode="append", slide_duration="1 minute")
    runner.await_end(jobs.start_category_stream(spark, config))
    closed = runner.closed_rows(spark, f"{tmp_path}/out/rt_category_window_sales").collect()
    assert [(r["window_start"].minute, r["order_count"]) for r in closed] == [(0, 1)]
    with pytest.raises(ValueError):
        JobConfig(output_mode="other")
