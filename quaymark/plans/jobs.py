"""Batch and streaming jobs: read, clean, analyse, store.

Run as ``python -m quaymark.plans.jobs <job> [options]``.
A failing step raises and ends the job; later steps do not run.
"""

from __future__ import annotations

import hashlib
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quaymark.config import JobConfig, parse
from quaymark.functions import labels as L
from quaymark.operators import baskets, catalogue, cleaning, commerce, listings, merge
from quaymark.operators.ranking import top_k
from quaymark.plans import serving
from quaymark.session import build_session, drop_scratch, materialize, size_shuffles
from quaymark.sinks import files as file_sinks, jdbc
from quaymark.sinks.contracts import AUDIT_COLUMNS, CONTRACTS, checked
from quaymark.sources import events, files, kafka, progress
from quaymark.streaming import aggregates, runner

Timings = dict[str, float]


def timed(timings: Timings, name: str, step: Callable[[], object]):
    begin = time.perf_counter()
    result = step()
    timings[name] = time.perf_counter() - begin
    return result


def target_of(config: JobConfig) -> jdbc.JdbcTarget | None:
    if config.jdbc_url is None:
        return None
    return jdbc.JdbcTarget(config.jdbc_url, config.jdbc_user, config.jdbc_password, config.jdbc_driver)


def prepared(name: str, df: DataFrame) -> DataFrame:
    """Checked against its contract, if it has one, with the table's load-time columns."""
    if name in CONTRACTS:
        df = checked(df, CONTRACTS[name])
    times, dates = AUDIT_COLUMNS.get(name, (("update_time",), ()))
    return cleaning.with_audit(df, times, dates)


def _write(
    config: JobConfig,
    name: str,
    df: DataFrame,
    to_table: Callable[[DataFrame, jdbc.JdbcTarget], None],
    to_folder: Callable[[DataFrame, str], None],
) -> None:
    df = prepared(name, df)
    target = target_of(config)
    if config.dry_run:
        df.show(20, truncate=False)
    elif target is not None:
        to_table(df, target)
    elif config.output:
        to_folder(df, f"{config.output}/{name}")
    else:
        raise ValueError("give --output, --jdbc-url or --dry-run")


def _in_files(df: DataFrame, files: int | None) -> DataFrame:
    return df if files is None else df.repartition(files)


def store(config: JobConfig, name: str, df: DataFrame) -> None:
    """Full refresh of one result table, in the database or below the output folder."""
    _write(
        config,
        name,
        df,
        lambda rows, target: jdbc.full_refresh(rows, target, name, config.write_partitions),
        lambda rows, path: _in_files(rows, config.write_partitions).write.mode("overwrite").parquet(path),
    )


def store_batch(config: JobConfig, name: str, df: DataFrame) -> None:
    """Replace the batches present in ``df``; a rerun leaves no duplicates."""
    _write(
        config,
        name,
        df,
        lambda rows, target: jdbc.replace_in_transaction(rows, target, name, writers=config.write_partitions),
        file_sinks.replace_batches,
    )


def run_catalogue(spark: SparkSession, config: JobConfig) -> Timings:
    """Clean the catalogue once into columnar form, then four analyses from that table."""
    timings: Timings = {}
    raw = files.read_catalogue_csv(spark, config.input)
    items = timed(timings, "clean", lambda: materialize(cleaning.clean_catalogue(raw), "catalogue"))
    files.require_non_empty(items, config.input)
    steps = {
        "analysis_market_trend": lambda: catalogue.market_trend(items),
        "analysis_pricing_review": lambda: catalogue.price_review(items),
        "analysis_genre_tags": lambda: catalogue.tag_distribution(items),
        "analysis_developer_ecosystem": lambda: catalogue.developer_ecosystem(items),
        "best_value_items": lambda: catalogue.best_value(items),
        "genre_distribution": lambda: catalogue.genre_distribution(items),
        "top_selling_genres": lambda: catalogue.top_selling_genres(items),
        "publisher_ranking": lambda: catalogue.publisher_ranking(items),
        "platform_categories": lambda: catalogue.platform_categories(items),
        "developer_classes": lambda: catalogue.developer_classes(items),
        "catalogue_overview": lambda: catalogue.overview(items),
    }
    for name, step in steps.items():
        timed(timings, name, lambda: store(config, name, step()))
    tagged = baskets.tag_baskets(items)
    if not tagged.isEmpty():
        model = timed(timings, "frequent_tags", lambda: baskets.fit_frequent_items(tagged))
        store(config, "frequent_tags", baskets.frequent_itemsets(model))
        store(config, "tag_rules", baskets.association_rules(model))
    return timings


def run_commerce(spark: SparkSession, config: JobConfig) -> Timings:
    """Read, validate, keep paid and completed orders, four analyses."""
    timings: Timings = {}
    tables = files.read_commerce(spark, config.input)
    for name, df in tables.items():
        files.require_non_empty(df, name)
    valid = timed(
        timings, "valid_orders", lambda: materialize(cleaning.valid_orders(tables["orders"]), "valid-orders")
    )
    files.require_non_empty(valid, "paid or completed orders")
    # Two of the analyses need each line's category: parsed and joined once.
    lines = commerce.attach_category(tables["order_items"], tables["products"]).select(
        "order_id", "final_category", "quantity", "amount"
    )
    items = timed(timings, "lines", lambda: materialize(lines, "categorised-lines"))
    steps = {
        "ads_sales_time_trend": lambda: commerce.sales_time_trend(valid),
        "ads_category_sales_rank": lambda: commerce.ranked_category_sales(valid, items, config.top_n),
        "ads_user_value_level": lambda: commerce.user_value(valid, tables["users"]),
        "ads_category_association_rules": lambda: baskets.pair_rules(
            baskets.baskets_of(valid, items), config.min_support, config.min_confidence, require_baskets=True
        ),
    }
    for name, step in steps.items():
        timed(timings, name, lambda: store(config, name, step()))
    return timings


def run_listings(spark: SparkSession, config: JobConfig) -> Timings:
    """Raw to clean to four result tables, for one batch id, in one session."""
    timings: Timings = {}
    raw, rejected = files.read_listings_with_rejects(spark, config.input)
    if config.output and not config.dry_run:
        rejects = f"{config.output}/rejected/checkid={config.batch_id}"
        timed(timings, "rejected", lambda: rejected.write.mode("overwrite").text(rejects))
    stored_raw = raw.withColumn("checkid", F.lit(config.batch_id))
    timed(timings, "house_info_checkid", lambda: store_batch(config, "house_info_checkid", stored_raw))
    clean = materialize(cleaning.clean_listings(raw, batch_id=config.batch_id), "clean-listings")
    timed(timings, "house_info_clean_checkid", lambda: store_batch(config, "house_info_clean_checkid", clean))
    steps = {
        "area_price_analysis": listings.area_price,
        "community_price_analysis": listings.community_price,
        "district_house_price_analysis": listings.district_price,
        "house_year_analysis": listings.year_layout,
    }
    for name, analyse in steps.items():
        timed(timings, name, lambda: store_batch(config, name, analyse(clean)))
    return timings


# --- publishing --------------------------------------------------------------
def _send(config: JobConfig, df: DataFrame, key: str | None) -> None:
    """To the configured topic, or as message files below ``--output``."""
    if config.kafka_bootstrap:
        file_sinks.publish(df, key, config.kafka_bootstrap, config.topic)
    else:
        file_sinks.save_messages(df, f"{config.output}/messages")


def run_publish_orders(spark: SparkSession, config: JobConfig) -> Timings:
    """Valid order events from JSON lines as keyed messages; the others go aside with their reason."""
    timings: Timings = {}
    good, bad = events.split_events(spark.read.text(config.input))
    if config.current_time:
        good = events.at_current_time(good)
    if config.dry_run:
        good.show(20, truncate=False)
        return timings
    timed(timings, "messages", lambda: _send(config, good, "order_id"))
    timed(timings, "rejected", lambda: bad.write.mode("append").json(f"{config.output}/rejected"))
    return timings


def run_publish_prices(spark: SparkSession, config: JobConfig) -> Timings:
    """Price messages of every clean-listing batch after the progress mark, in batch order.

    The mark moves after a batch is sent, so a batch cut short is sent again;
    each message names its batch.
    """
    timings: Timings = {}
    table = spark.read.parquet(config.input)
    marks = config.checkpoint or f"{config.output}/progress"
    while (batch_id := progress.next_batch(table, progress.last_processed(spark, marks))) is not None:
        prices = listings.watched_messages(
            progress.pull_batch(table, batch_id), config.district or L.WATCHED_DISTRICT
        )
        timed(timings, f"batch {batch_id}", lambda: _send(config, prices, None))
        progress.save_processed(spark, marks, batch_id)
    return timings


# --- streams -----------------------------------------------------------------
def messages_of(spark: SparkSession, config: JobConfig, **options) -> DataFrame:
    """The configured topic, or message files below ``--input``."""
    if config.kafka_bootstrap:
        return kafka.read_topic(
            spark,
            servers=config.kafka_bootstrap,
            topic=config.topic,
            max_offsets=config.max_offsets,
            fail_on_data_loss=not config.tolerate_data_loss,
            **options,
        )
    return kafka.read_message_files(spark, config.input, config.max_files)


def _checkpoint(spark: SparkSession, config: JobConfig) -> str:
    """The given checkpoint, or one of this job, source and target below ``spark.checkpoint.dir``.

    A folder that ends with the application would let the next run start over.
    """
    if config.checkpoint:
        return config.checkpoint
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("a stream needs --checkpoint or spark.checkpoint.dir")
    source = f"{config.kafka_bootstrap}/{config.topic}" if config.kafka_bootstrap else config.input
    flow = "\n".join([config.job, source, str(config.output), str(config.jdbc_url), config.output_mode])
    return f"{root.rstrip('/')}/checkpoints/{config.job}-{hashlib.sha256(flow.encode()).hexdigest()[:16]}"


def _trigger(config: JobConfig) -> int | None:
    return None if config.drain else config.trigger_seconds


def rejects_path(spark: SparkSession, config: JobConfig) -> str:
    """Where a stream job stores the messages it rejects."""
    return f"{config.output}/rejected_{config.job}" if config.output else f"{_checkpoint(spark, config)}-rejected"


def _start(
    spark: SparkSession, config: JobConfig, result: DataFrame, rejected: DataFrame, writer: runner.BatchWriter, mode: str
) -> StreamingQuery:
    """The result and, from the same micro-batches, the rejected messages."""
    both = runner.with_rejects(result, rejected)
    stored = runner.two_outputs(writer, rejects_path(spark, config))
    return runner.start(both, stored, _checkpoint(spark, config), mode, _trigger(config))


WINDOW_KEYS = ("window_start", "window_end", "category")


def start_category_stream(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Sliding-window sales per category.

    Changed windows are stored (bounded state), in files or a database, unless the
    ``complete`` result is asked for on every trigger, or (``append``) each window once,
    when no more orders can come to it.
    """
    good, bad = events.accepted_and_rejected(
        messages_of(spark, config), events.ORDER_EVENT, "order_id", events.ORDER_FAULTS
    )
    sales = aggregates.category_window_sales(
        events.valid_order_events(good), config.window_duration, config.slide_duration
    )
    target, mode = target_of(config), config.output_mode
    path = f"{config.output}/rt_category_window_sales"
    if target is not None and mode == "complete":
        writer = runner.table_refresh(target, "rt_category_window_sales")
    elif target is not None:
        # A closed window is complete, so it replaces its rows like a changed one.
        writer = runner.table_changes(target, "rt_category_window_sales", WINDOW_KEYS)
    elif mode == "complete":
        writer = runner.snapshots(path)
    elif mode == "append":
        writer = runner.closed_windows(path)
    else:
        writer = runner.change_log(path, WINDOW_KEYS, compact_every=100)
    return _start(spark, config, sales, bad, writer, mode)


def _item_messages(spark: SparkSession, config: JobConfig) -> tuple[DataFrame, DataFrame]:
    return events.accepted_and_rejected(messages_of(spark, config), events.ITEM_EVENT, "app_id")


def start_item_stream(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Cumulative item figures, replaced on every trigger."""
    good, bad = _item_messages(spark, config)
    target = target_of(config)
    writer = (
        runner.table_refresh(target, "realtime_game_stats")
        if target is not None
        else runner.snapshots(f"{config.output}/realtime_game_stats")
    )
    return _start(spark, config, aggregates.cumulative_kpis(good), bad, writer, "complete")


def _start_windowed(
    spark: SparkSession, config: JobConfig, name: str, keys: tuple[str, ...], build: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Windows of item events kept as a change log, or stored once closed: their state ends with the watermark."""
    good, bad = _item_messages(spark, config)
    path = f"{config.output}/{name}"
    if config.output_mode == "append":
        return _start(spark, config, build(good), bad, runner.closed_windows(path), "append")
    return _start(spark, config, build(good), bad, runner.change_log(path, keys, compact_every=100), "update")


def start_item_window_stream(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Item figures per event-time window."""
    return _start_windowed(
        spark,
        config,
        "realtime_game_windows",
        ("window_start", "window_end"),
        lambda items: aggregates.windowed_kpis(items, config.window_duration, config.slide_duration, "2 minutes"),
    )


def start_genre_stream(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Items per genre and event-time window."""
    return _start_windowed(
        spark,
        config,
        "realtime_genre_counts",
        ("genre", "window_start", "window_end"),
        lambda items: aggregates.genre_window_counts(
            items, config.window_duration, config.slide_duration, "2 minutes"
        ),
    )


def start_community_stream(spark: SparkSession, config: JobConfig) -> StreamingQuery:
    """Price messages added to running community totals in the stream's own state.

    A micro-batch stores the totals of its own communities, whatever the number of all.
    """
    lines = messages_of(spark, config, starting="earliest")
    good, bad = events.accepted_and_rejected(lines, events.PRICE_MESSAGE, "community")
    writer = runner.keyed_totals(f"{config.output}/certain_analysis")
    return _start(spark, config, merge.running_totals(good), bad, writer, "update")


BATCH_JOBS = {
    "catalogue": run_catalogue,
    "commerce": run_commerce,
    "listings": run_listings,
    "publish-orders": run_publish_orders,
    "publish-prices": run_publish_prices,
}
STREAM_JOBS = {
    "category-stream": start_category_stream,
    "item-stream": start_item_stream,
    "community-stream": start_community_stream,
    "item-window-stream": start_item_window_stream,
    "genre-stream": start_genre_stream,
}


# --- reports over stored results ---------------------------------------------
LISTING_ALIASES = {
    "area": "area_price_analysis",
    "district": "district_house_price_analysis",
    "year": "house_year_analysis",
    "community": "community_price_analysis",
}


def with_last_update(report: DataFrame, stored: DataFrame) -> DataFrame:
    """A report with the load time of the table it was read from."""
    return report.withColumn("last_update", stored.agg(F.max("update_time").alias("t")).scalar())


def report_registry(spark: SparkSession, root: str) -> serving.Registry:
    """Result tables below ``root`` under their public names, and the reports over them."""
    registry = serving.Registry()

    def table(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{root}/{name}")

    for alias, name in LISTING_ALIASES.items():
        registry.add(alias, table(name))
    registry.add("certain", lambda: merge.watched_result(runner.community_means(spark, f"{root}/certain_analysis")))
    trends, ranks = table("ads_sales_time_trend"), table("ads_category_sales_rank")
    users, rules = table("ads_user_value_level"), table("ads_category_association_rules")
    registry.add("sales/summary", lambda: with_last_update(serving.sales_summary(trends()), trends()))
    registry.add("sales/daily", lambda: serving.sales_daily(trends()))
    registry.add("sales/hourly", lambda: serving.sales_hourly(trends()))
    registry.add("category/top", lambda: with_last_update(serving.category_top(ranks()), ranks()))
    registry.add("user/summary", lambda: with_last_update(serving.user_value_summary(users()), users()))
    registry.add("user/levels", lambda: serving.user_levels(users()))
    registry.add("user/members", lambda: serving.member_matrix(users()))
    registry.add("rules/top", lambda: serving.top_rules(rules()))

    def log(name: str, keys: tuple[str, ...]) -> Callable[[], DataFrame]:
        return lambda: runner.latest_rows(spark, f"{root}/{name}", keys)

    sales = log("rt_category_window_sales", WINDOW_KEYS)
    registry.add("realtime/windows", lambda: serving.latest_window(sales()))
    registry.add("realtime/recent", lambda: serving.recent_windows(sales()))
    registry.add("realtime/trend", lambda: serving.window_trend(sales()))
    figures = log("realtime_game_windows", ("window_start", "window_end"))
    registry.add("realtime/items", lambda: top_k(figures(), [F.desc("window_end")], 1))
    genres = log("realtime_genre_counts", ("genre", "window_start", "window_end"))
    registry.add("realtime/genres", lambda: serving.top_genres(genres()))
    trend, prices = table("analysis_market_trend"), table("analysis_pricing_review")
    tags, developers = table("analysis_genre_tags"), table("analysis_developer_ecosystem")
    registry.add("market/trend", lambda: serving.market_trend_listing(trend()))
    registry.add("market/summary", lambda: serving.market_trend_summary(trend()))
    registry.add("pricing/data", lambda: serving.pricing_listing(prices()))
    registry.add("genres/tags", lambda: serving.tag_listing(tags()))
    registry.add("genres/top", lambda: serving.tags_by_owners(tags()))
    registry.add("developer/data", lambda: serving.developer_listing(developers()))
    registry.add("developer/summary", lambda: serving.developer_summary(developers()))
    registry.add("overview/overview", table("catalogue_overview"))
    return registry


def bundle(registry: serving.Registry, topic: str) -> dict[str, DataFrame]:
    """All reports of one topic: market, pricing, genres, developer or overview."""
    names = [n for n in registry.names() if n.startswith(topic + "/")]
    if topic == "overview":
        names += ["market/summary", "developer/summary"]
    if not names:
        raise KeyError(f"unknown topic {topic!r}")
    return registry.bundle(*names)


def main(arguments: list[str]) -> None:
    config = parse(arguments)
    spark = build_session(
        f"quaymark-{config.job}", shuffle_partitions=config.shuffle_partitions, time_zone=config.time_zone
    )
    spark.sparkContext.setLogLevel(config.log_level)
    try:
        if config.job in BATCH_JOBS:
            if config.shuffle_partitions is None:
                size_shuffles(spark, config.input)
            for name, seconds in BATCH_JOBS[config.job](spark, config).items():
                print(f"{name}: {seconds:.1f}s")
        else:
            runner.await_end(STREAM_JOBS[config.job](spark, config))
    finally:
        drop_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
