"""Named queries: each analysis and report over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    IntegerType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from quaymark.config import JobConfig
from quaymark.functions import labels as L
from quaymark.operators import baskets, catalogue, cleaning, commerce, listings, merge
from quaymark.plans import bindings as B, jobs, serving
from quaymark.session import materialize, scratch_path, small_tasks
from quaymark.sinks import contracts, files as file_sinks
from quaymark.sources import events, files, kafka, progress
from quaymark.streaming import aggregates, runner

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as longs, dates, times and arrays as text."""
    columns = []
    for field in df.schema.fields:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (IntegerType, ShortType)):
            value = value.cast("bigint")
        elif isinstance(kind, DateType):
            value = F.date_format(value, L.DATE_FORMAT)
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            value = F.date_format(value, L.TIME_FORMAT)
        elif isinstance(kind, ArrayType):
            value = F.array_join(value, ",")
        columns.append(value.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(spark, sf_dir))

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return run


# --- commerce ----------------------------------------------------------------
def _trend(spark, sf):
    return commerce.sales_time_trend(cleaning.valid_orders(B.hourly_orders(spark, sf), B.EVENT_STATUSES))


def _ranked(spark, sf):
    return commerce.category_sales_rank(
        B.valid_orders(spark, sf), B.order_items(spark, sf), B.products(spark, sf), top_n=3
    )


def _user_value(spark, sf):
    return commerce.user_value(B.valid_orders(spark, sf), B.users(spark, sf))


def _rules(spark, sf):
    return baskets.category_rules(
        B.valid_orders(spark, sf), B.order_items(spark, sf), B.products(spark, sf)
    )


@query
def sales_time_trend(spark, sf):
    return _trend(spark, sf)


@query
def sales_daily(spark, sf):
    return serving.sales_daily(_trend(spark, sf))


@query
def sales_hourly(spark, sf):
    return serving.sales_hourly(_trend(spark, sf))


@query
def sales_summary(spark, sf):
    return serving.sales_summary(_trend(spark, sf))


@query
def sales_distinct_users(spark, sf):
    return serving.distinct_users(cleaning.valid_orders(B.hourly_orders(spark, sf), B.EVENT_STATUSES))


@query
def category_sales_rank(spark, sf):
    return _ranked(spark, sf)


@query
def category_top(spark, sf):
    return serving.category_top(_ranked(spark, sf))


@query
def rfm_user_value(spark, sf):
    return _user_value(spark, sf)


@query
def rfm_summary(spark, sf):
    return serving.user_value_summary(_user_value(spark, sf))


@query
def rfm_levels(spark, sf):
    return serving.user_levels(_user_value(spark, sf))


@query
def rfm_member_levels(spark, sf):
    return serving.member_levels(_user_value(spark, sf))


@query
def rfm_member_matrix(spark, sf):
    return serving.member_matrix(_user_value(spark, sf))


@query
def category_pair_rules(spark, sf):
    return _rules(spark, sf)


@query
def category_top_rules(spark, sf):
    return serving.top_rules(_rules(spark, sf), 10)


@query
def rule_graph_nodes(spark, sf):
    return baskets.rule_nodes(serving.top_rules(_rules(spark, sf), 10))


@query
def rule_graph_links(spark, sf):
    return baskets.rule_links(serving.top_rules(_rules(spark, sf), 10))


def _order_events(spark, sf):
    valid = B.valid_orders(spark, sf).join(
        B.users(spark, sf).select("user_id", "province", "city"), "user_id", "left"
    )
    return commerce.order_events(valid, B.order_items(spark, sf), B.products(spark, sf))


@query
def order_events(spark, sf):
    return _order_events(spark, sf)


@query
def order_event_messages(spark, sf):
    """Events as keyed JSON, stored as lines, read back, validated and decoded."""
    path = scratch_path(spark, "order-messages")
    file_sinks.save_messages(_order_events(spark, sf).withColumn("order_id", F.col("order_id").cast("string")), path)
    good, _ = events.split_events(spark.read.text(path))
    return good.select("order_id", "user_id", "order_time", "category", "pay_amount", "order_status")


@query
def event_json_validation(spark, sf):
    """Messages by rejection reason.

    Some event types arrive cut short, incomplete or blank; of the others, some with
    text after the object, a second object or an amount that is no number.
    """
    kind, number = F.col("event_type"), F.col("event_id") % 7
    text = F.col("value")
    damaged = (
        F.when(kind == "error", F.substring(text, 1, 40))
        .when(kind == "view", F.regexp_replace(text, '"channel":"web"', '"c":"web"'))
        .when(kind == "click", F.lit("  "))
        .when(number == 1, F.concat(text, F.lit(" trailing")))
        .when(number == 2, F.concat(text, text))
        .when(number == 3, F.concat(text, F.lit("] x")))
        .when(number == 4, F.concat(text, F.lit("} x")))
        .when(number == 5, F.regexp_replace(text, '"pay_amount":[^,]*', '"pay_amount":"abc"'))
        .otherwise(text)
    )
    lines = B.order_messages(B.table(spark, sf, "events")).select(damaged.alias("value"))
    reason = F.coalesce("reason", F.lit("valid"))
    return events.with_reason(lines).groupBy(reason.alias("reason")).agg(F.count("*").alias("messages"))


# --- catalogue ---------------------------------------------------------------
@query
def catalogue_clean(spark, sf):
    return B.catalogue(spark, sf).select("AppID", "Name", "release_year", "owners_numeric", "Price")


def _market(spark, sf):
    return catalogue.market_trend(B.catalogue(spark, sf))


def _prices(spark, sf):
    return catalogue.price_review(B.catalogue(spark, sf))


def _ecosystem(spark, sf):
    # Twenty of the brands, so that the cut of the ranking shows.
    return catalogue.developer_ecosystem(B.catalogue(spark, sf), 20)


def _tags(spark, sf):
    return catalogue.tag_distribution(B.catalogue(spark, sf))


@query
def market_trend_yoy(spark, sf):
    return _market(spark, sf)


@query
def market_trend_listing(spark, sf):
    return serving.market_trend_listing(_market(spark, sf))


@query
def market_trend_summary(spark, sf):
    return serving.market_trend_summary(_market(spark, sf))


@query
def price_bucket_review(spark, sf):
    return _prices(spark, sf)


@query
def price_listing(spark, sf):
    return serving.pricing_listing(_prices(spark, sf))


@query
def best_value_items(spark, sf):
    chosen = catalogue.best_value(
        B.catalogue(spark, sf), min_rate=0.5, min_recommendations=100, max_price=49.99, min_reviews=5
    )
    return chosen.select("AppID", "Name", "positive_rate", "Recommendations", "Price", "total_reviews")


@query
def genre_distribution(spark, sf):
    return catalogue.genre_distribution(B.catalogue(spark, sf))


@query
def top_selling_genres(spark, sf):
    return catalogue.top_selling_genres(B.catalogue(spark, sf))


@query
def tag_distribution(spark, sf):
    return _tags(spark, sf)


@query
def tag_listing(spark, sf):
    return serving.tag_listing(_tags(spark, sf), 10)


@query
def tags_by_owners(spark, sf):
    return serving.tags_by_owners(_tags(spark, sf), 5)


@query
def fp_itemsets(spark, sf):
    model = baskets.fit_frequent_items(baskets.tag_baskets(B.catalogue(spark, sf)), 0.01, 0.1)
    return baskets.frequent_itemsets(model)


@query
def fp_rules(spark, sf):
    model = baskets.fit_frequent_items(baskets.tag_baskets(B.catalogue(spark, sf)), 0.01, 0.1)
    return baskets.association_rules(model).select(
        "antecedent",
        "consequent",
        F.round("confidence", 6).alias("confidence"),
        F.round("lift", 6).alias("lift"),
        F.round("support", 6).alias("support"),
    )


def _order_categories(spark, sf):
    """Frequent sets of the categories of one order, of any size."""
    pairs = baskets.order_baskets(B.valid_orders(spark, sf), B.order_items(spark, sf), B.products(spark, sf))
    return baskets.fit_frequent_items(baskets.item_lists(pairs, "order_id", "category"), 0.002, 0.05)


@query
def order_itemsets(spark, sf):
    return baskets.frequent_itemsets(_order_categories(spark, sf))


@query
def order_itemset_rules(spark, sf):
    return baskets.rules_of(_order_categories(spark, sf))


@query
def developer_ranking(spark, sf):
    return _ecosystem(spark, sf)


@query
def developer_listing(spark, sf):
    return serving.developer_listing(_ecosystem(spark, sf), 10)


@query
def developer_summary(spark, sf):
    return serving.developer_summary(_ecosystem(spark, sf))


@query
def developer_hhi(spark, sf):
    """Concentration over all developers, not only the listed ones."""
    return catalogue.concentration(catalogue.developer_totals(B.catalogue(spark, sf)))


@query
def developer_genre_count(spark, sf):
    return catalogue.developer_genres(B.catalogue(spark, sf))


@query
def publisher_ranking(spark, sf):
    return catalogue.publisher_ranking(B.catalogue(spark, sf))


@query
def publisher_hhi(spark, sf):
    return catalogue.concentration(catalogue.publisher_ranking(B.catalogue(spark, sf)))


@query
def platform_categories(spark, sf):
    return catalogue.platform_categories(B.catalogue(spark, sf))


@query
def developer_classes(spark, sf):
    return catalogue.developer_classes(B.developers_by_customer(spark, sf))


@query
def catalogue_overview(spark, sf):
    return catalogue.overview(B.catalogue(spark, sf))


# --- listings ----------------------------------------------------------------
@query
def listing_clean(spark, sf):
    return B.listings(spark, sf)


@query
def area_price(spark, sf):
    return listings.area_price(B.listing_facts(spark, sf))


@query
def area_level_matrix(spark, sf):
    return listings.area_level_matrix(listings.area_price(B.listing_facts(spark, sf)))


@query
def district_price(spark, sf):
    return listings.district_price(B.listing_facts(spark, sf))


@query
def community_price(spark, sf):
    return listings.community_price(B.listing_facts(spark, sf))


@query
def community_top20(spark, sf):
    return listings.community_top(listings.community_price(B.listing_facts(spark, sf)))


@query
def year_layout(spark, sf):
    return listings.year_layout(B.listing_facts(spark, sf))


@query
def year_layout_share(spark, sf):
    return listings.layout_share(listings.year_layout(B.listing_facts(spark, sf)))


# --- merging -----------------------------------------------------------------
def _watched(spark, sf):
    return listings.watched_messages(B.listing_facts(spark, sf), district=None)


@query
def weighted_merge(spark, sf):
    """Truncated means of batch 1 merged with those of all later batches by their counts."""
    per_batch = _watched(spark, sf).groupBy("checkid", "community").agg(
        F.count("*").alias("number"),
        F.floor(F.try_divide(F.sum("price_per_sqm").cast("decimal(28,0)"), F.count("*"))).cast("bigint").alias(
            "averageprice"
        ),
    )
    old, new = (per_batch.filter(batches).drop("checkid") for batches in ("checkid = 1", "checkid > 1"))
    return serving.communities_by_mean(merge.weighted_merge(old, new))


@query
def incremental_merge(spark, sf):
    """Batches above the progress mark published as messages in their order, merged by one run of a stream."""
    stored = scratch_path(spark, "watched")
    _watched(spark, sf).write.partitionBy("checkid").parquet(stored)
    inbox, marks = scratch_path(spark, "inbox"), scratch_path(spark, "progress")
    state, checkpoint = scratch_path(spark, "totals"), scratch_path(spark, "checkpoint")
    table = spark.read.parquet(stored)
    while (batch_id := progress.next_batch(table, progress.last_processed(spark, marks))) is not None:
        file_sinks.save_messages(progress.pull_batch(table, batch_id), inbox)
        progress.save_processed(spark, marks, batch_id)
    messages = events.decode(kafka.read_message_files(spark, inbox, max_files=4), events.PRICE_MESSAGE, "community")
    runner.await_end(runner.start(merge.running_totals(messages), runner.keyed_totals(state), checkpoint))
    return serving.communities_by_mean(runner.community_means(spark, state))


# --- streams -----------------------------------------------------------------
def _drain_in_slices(spark, sf, build, writer, mode="update"):
    """Events arrive in slices; after each the stream is started again from its checkpoint and drained.

    Every slice is at least one micro-batch, so state is carried, windows that span two
    slices are updated, and the watermark moves.
    """
    folder, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    for part in B.event_slices(spark, sf):
        B.arrive(part, folder, sf)
        frame = build(B.event_stream(spark, folder, part.schema))
        runner.await_end(runner.start(frame, writer, checkpoint, mode=mode))


def _window_sales(spark, sf):
    path = scratch_path(spark, "window-sales")

    def build(rows):
        messages = B.order_messages(rows).select("value")
        return aggregates.category_window_sales(
            events.order_events(messages, B.EVENT_STATUSES), "1 hour", "30 minutes"
        )

    _drain_in_slices(spark, sf, build, runner.change_log(path))
    return runner.latest_rows(spark, path, ["window_start", "window_end", "category"])


def _item_events(rows):
    return events.decode(B.item_messages(rows), events.ITEM_EVENT, "app_id")


@query
def stream_sliding_sales(spark, sf):
    return _window_sales(spark, sf).drop("batch_id")


@query
def stream_window_summary(spark, sf):
    return serving.window_summary(_window_sales(spark, sf)).select("latest_window_end")


@query
def stream_latest_window(spark, sf):
    return serving.latest_window(_window_sales(spark, sf)).drop("batch_id")


@query
def stream_recent_windows(spark, sf):
    return serving.recent_windows(_window_sales(spark, sf)).drop("batch_id")


@query
def stream_window_trend(spark, sf):
    return serving.window_trend(_window_sales(spark, sf))


@query
def stream_kpis(spark, sf):
    path = scratch_path(spark, "kpis")
    _drain_in_slices(
        spark, sf, lambda rows: aggregates.cumulative_kpis(_item_events(rows)), runner.snapshots(path), "complete"
    )
    return runner.latest_snapshot(spark, path).drop("batch_id")


@query
def stream_windowed_kpis(spark, sf):
    path = scratch_path(spark, "window-kpis")
    _drain_in_slices(
        spark,
        sf,
        lambda rows: aggregates.windowed_kpis(_item_events(rows), "1 hour", watermark="2 minutes"),
        runner.change_log(path),
    )
    return runner.latest_rows(spark, path, ["window_start", "window_end"]).drop("batch_id")


def _genre_counts(spark, sf):
    path = scratch_path(spark, "genre-counts")
    _drain_in_slices(
        spark,
        sf,
        lambda rows: aggregates.genre_window_counts(_item_events(rows), "1 hour", watermark="2 minutes"),
        runner.change_log(path),
    )
    return runner.latest_rows(spark, path, ["genre", "window_start", "window_end"]).drop("batch_id")


@query
def stream_genre_counts(spark, sf):
    return _genre_counts(spark, sf)


@query
def stream_top_genres(spark, sf):
    return serving.top_genres(_genre_counts(spark, sf))


def _damaged(rows: DataFrame) -> DataFrame:
    """Order messages, some of them damaged in one way or another, see ``event_json_validation``."""
    messages, number = B.order_messages(rows), F.col("event_id") % 11
    text = F.col("value")
    damaged = (
        F.when(F.col("event_type") == "error", F.substring(text, 1, 40))
        .when(number == 1, F.concat(text, F.lit(" trailing")))
        .when(number == 2, F.regexp_replace(text, '"pay_amount":[^,]*', '"pay_amount":"abc"'))
        .when(number == 3, F.regexp_replace(text, '"order_id":"[0-9]*"', '"order_id":null'))
        .when(number == 4, F.regexp_replace(text, '"order_id":"[0-9]*",', ""))
        .when(number == 5, F.regexp_replace(text, '"order_time":"[^"]*"', '"order_time":"when?"'))
        .when(number == 6, F.lit("   "))
        .otherwise(text)
    )
    return messages.select(damaged.alias("value"))


@query
def stream_rejected_messages(spark, sf):
    """Both outputs of one damaged stream: orders in its hourly windows, and rejected messages by reason.

    The stream is restarted after each slice of events; every message is stored once, as an
    order or as a reject with its reason.
    """
    path, rejects = scratch_path(spark, "window-sales"), scratch_path(spark, "rejects")

    def build(rows):
        good, bad = events.accepted_and_rejected(_damaged(rows), events.ORDER_EVENT, "order_id", events.ORDER_FAULTS)
        every = [r[0] for r in B.table(spark, sf, "events").select("event_type").distinct().collect()]
        sales = aggregates.category_window_sales(events.valid_order_events(good, every), "1 hour", None)
        return runner.with_rejects(sales, bad)

    _drain_in_slices(spark, sf, build, runner.two_outputs(runner.change_log(path), rejects))
    kept = runner.latest_rows(spark, path, ["window_start", "window_end", "category"])
    accepted = kept.agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("messages")).select(F.lit("accepted").alias("outcome"), "messages")
    bad = runner.rejected_messages(spark, rejects).groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("messages"))
    return accepted.union(bad)


def _drain_with_late_rows(spark, sf, build, writer, mode):
    """Slices as in ``_drain_in_slices``, but some events of the first slice arrive with the last one."""
    folder, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    parts = B.event_slices(spark, sf)
    late = F.col("event_id") % 10 == 3
    arriving = [parts[0].filter(~late), *parts[1:-1], parts[-1].unionByName(parts[0].filter(late))] if len(parts) > 1 else parts
    for part in arriving:
        B.arrive(part, folder, sf)
        frame = build(B.event_stream(spark, folder, part.schema))
        runner.await_end(runner.start(frame, writer, checkpoint, mode=mode))


@query
def stream_closed_windows(spark, sf):
    """Windows that the watermark has closed, each emitted once; orders that come after that are dropped."""
    path = scratch_path(spark, "closed-windows")

    def build(rows):
        messages = B.order_messages(rows).select("value")
        return aggregates.category_window_sales(events.order_events(messages, B.EVENT_STATUSES), "1 hour", "30 minutes")

    _drain_with_late_rows(spark, sf, build, runner.closed_windows(path), "append")
    return runner.closed_rows(spark, path).drop("batch_id")


@query
def stream_late_orders(spark, sf):
    """Orders of the open and closed windows of a stream with late rows, in update mode."""
    path = scratch_path(spark, "late-orders")

    def build(rows):
        messages = B.order_messages(rows).select("value")
        return aggregates.category_window_sales(events.order_events(messages, B.EVENT_STATUSES), "1 hour", None)

    _drain_with_late_rows(spark, sf, build, runner.change_log(path), "update")
    return runner.latest_rows(spark, path, ["window_start", "window_end", "category"]).drop("batch_id")


@query
def stream_rate_limited(spark, sf):
    """Cumulative item figures from very many files, a few at a time, in one run without restarts."""
    folder, path = scratch_path(spark, "arriving"), scratch_path(spark, "kpis")
    rows = B.table(spark, sf, "events")
    rows.repartition(8, "event_id").write.parquet(folder)
    kpis = aggregates.cumulative_kpis(_item_events(B.event_stream(spark, folder, rows.schema, max_files=3)))
    query = runner.start(kpis, runner.snapshots(path), scratch_path(spark, "checkpoint"), "complete")
    runner.await_end(query)
    batches = sum(p["numInputRows"] > 0 for p in query.recentProgress)
    return runner.latest_snapshot(spark, path).drop("batch_id").withColumn("several_batches", F.lit(batches > 1))


# --- SQL over registered views -----------------------------------------------
def _stored(spark, results) -> str:
    """A result folder as the batch jobs leave it."""
    root = scratch_path(spark, "results")
    for name, (store, df) in results.items():
        store(JobConfig(output=root), name, df)
    return root


@query
def sql_category_days(spark, sf):
    """Days on which a category was ranked, and was best, from stored ranks: SQL text with bound values over views."""
    root = _stored(spark, {"ads_category_sales_rank": (jobs.store, _ranked(spark, sf))})
    files.register_views({"ranks": spark.read.parquet(f"{root}/ads_category_sales_rank"), "members": B.users(spark, sf)})
    return serving.sql_report(
        spark,
        """SELECT category, count(*) AS days, count_if(category_rank <= :best) AS days_best, sum(amount_sum) AS amount_sum,
                  (SELECT count(DISTINCT member_level) FROM members) AS member_levels
           FROM ranks WHERE order_count >= :orders GROUP BY category""",
        best=1,
        orders=1,
    )


@query
def sql_listing_aliases(spark, sf):
    """The listing results under their public aliases, each as a view: rows, batches and listings counted in SQL."""
    facts = materialize(B.listing_facts(spark, sf), "facts")
    results = {
        "area_price_analysis": listings.area_price,
        "district_house_price_analysis": listings.district_price,
        "house_year_analysis": listings.year_layout,
        "community_price_analysis": listings.community_price,
    }
    registry = jobs.report_registry(spark, _stored(spark, {n: (jobs.store_batch, f(facts)) for n, f in results.items()}))
    views = registry.register(*jobs.LISTING_ALIASES)
    parts = [
        serving.sql_report(
            spark,
            f"SELECT :alias AS alias, count(*) AS result_rows, count(DISTINCT checkid) AS batches, sum(house_count) AS listings FROM {view}",
            alias=alias,
        )
        for alias, view in views.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def sql_report_bundles(spark, sf):
    """Rows of every report of the catalogue topics, from stored results through the bundles."""
    results = {
        "analysis_market_trend": _market,
        "analysis_pricing_review": _prices,
        "analysis_genre_tags": _tags,
        "analysis_developer_ecosystem": _ecosystem,
        "catalogue_overview": lambda spark, sf: catalogue.overview(B.catalogue(spark, sf)),
    }
    registry = jobs.report_registry(spark, _stored(spark, {n: (jobs.store, f(spark, sf)) for n, f in results.items()}))
    parts = []
    for topic in ("market", "pricing", "genres", "developer", "overview"):
        files.register_views({f"{topic}__{name.replace('/', '__')}": df for name, df in jobs.bundle(registry, topic).items()})
        parts += [
            serving.sql_report(spark, f"SELECT :topic AS topic, :report AS report, count(*) AS result_rows FROM {topic}__{name.replace('/', '__')}", topic=topic, report=name)
            for name in jobs.bundle(registry, topic)
        ]
    return reduce(DataFrame.unionByName, parts)


@query
def sql_latest_windows(spark, sf):
    """The last 20 window rows of a stream, read from a registered view by its sort column."""
    files.register_views({"window_sales": _window_sales(spark, sf)})
    return serving.latest_rows(spark, "window_sales", serving.bounded_limit("20", 10, 100), None, "window_end", "window_start", "category").drop("batch_id")


# --- sources and sinks -------------------------------------------------------
@query
def commerce_csv_roundtrip(spark, sf):
    """Orders written as CSV in the raw layout, read typed and cleaned."""
    path = scratch_path(spark, "orders-csv")
    raw = B.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.date_format("o_orderdate", L.TIME_FORMAT).alias("order_time"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(
            F.date_format("o_orderdate", L.TIME_FORMAT)
        ).alias("pay_time"),
        F.lit("p").alias("province"),
        F.lit("c").alias("city"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit(None).cast("double").alias("discount_amount"),
        F.col("o_totalprice").alias("pay_amount"),
    )
    file_sinks.save_csv(raw, path, files=None)
    return cleaning.clean_orders(files.read_typed_csv(spark, path, files.ORDERS)).select(
        "order_id", "user_id", "stat_date", "stat_hour", "pay_ts", "channel", "discount_amount", "pay_amount"
    )


@query
def catalogue_csv_roundtrip(spark, sf):
    """Items whose names hold quotes and line breaks, through multi-line CSV."""
    path = scratch_path(spark, "catalogue-csv")
    raw = B.catalogue_raw(spark, sf).withColumn("Name", F.concat_ws('"\n', F.split("Name", " ")))
    file_sinks.save_csv(raw, path, files=None)
    back = files.read_catalogue_csv(spark, path, raw.schema)
    return cleaning.clean_catalogue(back).select(
        "AppID", F.regexp_replace("Name", '"\n', "/").alias("Name"), "release_year", "owners_numeric", "Price"
    )


@query
def listing_csv_roundtrip(spark, sf):
    """Listings through CSV with the original headers."""
    path = scratch_path(spark, "listings-csv")
    raw = B.listings_raw(spark, sf).select(*L.LISTING_HEADERS.values())
    file_sinks.save_csv(raw.toDF(*L.LISTING_HEADERS), path, files=None)
    return (
        files.read_listings_csv(spark, path)
        .groupBy("district", "elevator")
        .agg(
            F.count("*").alias("listings"),
            F.sum("area").alias("area"),
            F.sum("price").alias("price"),
            F.countDistinct("layout", "orientation", "floor_num", "decoration", "build_year").alias("shapes"),
        )
    )


@query
def format_roundtrip(spark, sf):
    """Orders through every file format; each must give the same totals."""
    rows = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
    stored = {}
    for kind, options in (("csv", {"sep": ";", "header": "true"}), ("json", {}), ("orc", {}), ("parquet", {})):
        path = scratch_path(spark, f"orders-{kind}")
        rows.write.format(kind).options(**options).save(path)
        stored[kind] = files.read_any(spark, path, kind, schema, **options)
    path = scratch_path(spark, "orders-text")
    rows.select(F.concat_ws(", ", *rows.columns).alias("value")).write.text(path)
    columns = {f.split()[0]: f.split()[1] for f in schema.split(", ")}
    stored["text"] = files.read_delimited_text(spark, path, columns, ",")
    totals = [
        df.agg(
            F.count("*").alias("rows"),
            F.sum("o_orderkey").alias("keys"),
            F.sum("o_custkey").alias("customers"),
            F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        ).withColumn("format", F.lit(kind))
        for kind, df in stored.items()
    ]
    return reduce(DataFrame.unionByName, totals)


@query
def batch_replace_roundtrip(spark, sf):
    """Community results written by batch, batch 1 written again: still one row per key."""
    path = scratch_path(spark, "community-batches")
    result = materialize(listings.community_price(B.listing_facts(spark, sf)), "community")
    file_sinks.replace_batches(result, path)
    file_sinks.replace_batches(result.filter("checkid = 1"), path)
    return spark.read.parquet(path).select(*result.columns)


@query
def district_merged_medians(spark, sf):
    """Price quartiles per district from sketches stored by batch, batch 1 written again: exact counts, ranks within the error."""
    facts = materialize(B.listing_facts(spark, sf).filter("district <> ''"), "facts")
    path = scratch_path(spark, "price-sketches")
    for batch in (1, 2, 3, 1):
        file_sinks.replace_batches(listings.price_sketches(facts.filter(F.col("checkid") == batch)), path)
    asked = [0.25, 0.5, 0.75]
    merged = listings.merged_quantiles(spark.read.parquet(path), probabilities=asked)
    wanted = F.element_at(F.array(*map(F.lit, asked)), F.col("quartile"))
    found = merged.select("district", "house_count", F.posexplode("price_quantiles").alias("quartile", "price")).withColumn("quartile", F.col("quartile") + 1)
    ranked = materialize(found, "quartiles")
    ranks = listings.price_ranks(facts, ranked.select("district", "price").distinct())
    near = (F.col("share_below") <= wanted + listings.RANK_ERROR) & (F.col("share_upto") >= wanted - listings.RANK_ERROR)
    return ranked.join(ranks, ["district", "price"]).select("district", F.col("quartile").cast("bigint").alias("quartile"), "house_count", near.alias("within_error"))


@query
def contract_trend(spark, sf):
    """Sales trend conformed to its result-table contract, key checked."""
    return contracts.checked(_trend(spark, sf), contracts.CONTRACTS["ads_sales_time_trend"])


@query
def result_table_counts(spark, sf):
    """Rows of each result table, counted in tasks whose share of the input does not grow with it."""
    counts = serving.table_counts(
        {
            "ads_sales_time_trend": _trend(spark, sf),
            "ads_category_sales_rank": _ranked(spark, sf),
            "ads_user_value_level": _user_value(spark, sf),
            "ads_category_association_rules": _rules(spark, sf),
        }
    )
    with small_tasks(spark, counts):
        return materialize(counts, "table-counts")
