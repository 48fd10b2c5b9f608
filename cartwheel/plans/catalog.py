"""

Every plan reads whole driver tables (or frames Spark derives from them) and
returns a DataFrame with explicitly aliased columns that match the DuckDB
oracle in ``cartwheel.plans.oracle``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonfmt import map_as_text, to_json_row
from ..functions.text import word_tokens
from ..operators import cdc, keywords, logsplit, routing, stats, visits, wide
from ..operators.joins import lookup
from ..session import ensure_checkpoint_dir
from ..sinks import dimstore
from ..sinks.writers import upsert_dim
from ..sources import driver
from ..sources.driver import SCALE
from .inputs import Inputs

GMV_DAY = 19950315

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _repaired_page(i: Inputs) -> DataFrame:
    return logsplit.repair_new_visitor(i.page_log, "mid", "is_new", "ts", "seq")


# ------------------------------------------------------------------ click logs

@query("log_dirty")
def log_dirty(spark, sf):
    return logsplit.dirty_lines(Inputs(spark, sf).raw_log).select("seq", "value")


@query("log_page")
def log_page(spark, sf):
    return logsplit.flatten_page(Inputs(spark, sf).parsed_log)


@query("log_start")
def log_start(spark, sf):
    p = logsplit.start_log(Inputs(spark, sf).parsed_log)
    return p.select(F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
                    F.col("start")["entry"].alias("entry"),
                    F.col("start")["loading_time"].cast("bigint").alias("loading_time"), "ts", "seq")


def _display_cols(d: DataFrame, with_ts: bool) -> DataFrame:
    return d.select(F.col("display")["item"].alias("item"), F.col("display")["item_type"].alias("item_type"),
                    F.col("display")["order"].alias("display_order"), "page_id", *(["ts"] if with_ts else []))


@query("log_display")
def log_display(spark, sf):
    return _display_cols(Inputs(spark, sf).display_log, True)


@query("log_display_no_ts")
def log_display_no_ts(spark, sf):
    return _display_cols(logsplit.display_log(Inputs(spark, sf).parsed_log, with_ts=False), False)


@query("to_json_rows")
def to_json_rows(spark, sf):
    d = _display_cols(Inputs(spark, sf).display_log, True)
    return d.select(to_json_row("item", "item_type", "page_id", "ts").alias("json"))


@query("new_visitor_repair")
def new_visitor_repair(spark, sf):
    return _repaired_page(Inputs(spark, sf))


@query("unique_visit")
def unique_visit(spark, sf):
    return visits.unique_visit(Inputs(spark, sf).page_log)


@query("unique_visit_strict")
def unique_visit_strict(spark, sf):
    return visits.unique_visit_strict(Inputs(spark, sf).page_log)


@query("user_jump")
def user_jump(spark, sf):
    return visits.user_jump(Inputs(spark, sf).page_log, SCALE["jump_within_ms"])


@query("user_jump_match")
def user_jump_match(spark, sf):
    return user_jump(spark, sf).filter(F.col("kind") == "match").drop("kind")


@query("user_jump_timeout")
def user_jump_timeout(spark, sf):
    return user_jump(spark, sf).filter(F.col("kind") == "timeout").drop("kind")


@query("pattern_funnel")
def pattern_funnel(spark, sf):
    """X8 with three steps: a view, directly followed by a click and a purchase of the device."""
    steps = [F.col("page_id") == p for p in ("view", "click", "purchase")]
    return visits.pattern(Inputs(spark, sf).page_log, steps, SCALE["jump_within_ms"]).select("mid", "ts", "seq", "kind", "matched", "last_ts")


@query("tumble_counts")
def tumble_counts(spark, sf):
    return stats.tumble_counts(Inputs(spark, sf).page_log, "ts", "1 hour", keys=["page_id"])


def _flagged(i: Inputs) -> DataFrame:
    return visits.visit_flags(i.page_log, SCALE["jump_within_ms"])


@query("visitor_union")
def visitor_union(spark, sf):
    return stats.visitor_union(_flagged(Inputs(spark, sf)))


@query("visitor_stats")
def visitor_stats(spark, sf):
    return stats.visitor_stats(stats.visitor_measures(_flagged(Inputs(spark, sf))), SCALE["visitor_window"])


# ------------------------------------------------------------------ orders

@query("order_time_parts")
def order_time_parts(spark, sf):
    return wide.order_time_parts(Inputs(spark, sf).order_info)


def _joined(i: Inputs, order_info: DataFrame | None = None) -> DataFrame:
    return wide.order_interval_join(i.order_info if order_info is None else order_info, i.order_detail, -SCALE["order_detail_ms"], SCALE["order_detail_ms"])


@query("order_interval_join")
def order_interval_join(spark, sf):
    return _joined(Inputs(spark, sf)).select("detail_id", "order_id", "sku_id", "sku_num", "order_status",
                                             "user_id", "province_id", "split_total_amount", "total_amount",
                                             "create_time", "create_date", "create_hour")


@query("lookup_user_age")
def lookup_user_age(spark, sf):
    i = Inputs(spark, sf)
    return wide.lookup_user(_joined(i), i.dims["user"], i.as_of_ms).select(
        "detail_id", "order_id", "user_id", "user_gender", "user_age")


@query("lookup_province")
def lookup_province(spark, sf):
    i = Inputs(spark, sf)
    return wide.lookup_province(_joined(i), i.dims["province"]).select(
        "detail_id", "order_id", "province_id", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code")


@query("lookup_sku")
def lookup_sku(spark, sf):
    i = Inputs(spark, sf)
    return wide.lookup_sku(_joined(i), i.dims["sku"]).select(
        "detail_id", "order_id", "sku_id", "sku_name", "spu_id", "tm_id", "category3_id")


@query("lookup_snowflake")
def lookup_snowflake(spark, sf):
    i = Inputs(spark, sf)
    ow = wide.lookup_sku(_joined(i), i.dims["sku"])
    return wide.lookup_snowflake(ow, i.dims["spu"], i.dims["trademark"], i.dims["category3"]).select(
        "detail_id", "order_id", "sku_id", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id",
        "category3_name")


def _order_wide(i: Inputs) -> DataFrame:
    return wide.order_wide(i.order_info, i.order_detail, i.dims, -SCALE["order_detail_ms"],
                           SCALE["order_detail_ms"], i.as_of_ms)


@query("order_wide")
def order_wide(spark, sf):
    return _order_wide(Inputs(spark, sf))


def _payment_wide(i: Inputs, ow: DataFrame) -> DataFrame:
    return wide.payment_interval_join(i.payment_info, ow, SCALE["payment_lower_ms"], SCALE["payment_upper_ms"])


@query("payment_interval_join")
def payment_interval_join(spark, sf):
    i = Inputs(spark, sf)
    return _payment_wide(i, _joined(i)).select("payment_id", "order_id", "detail_id", "payment_create_time",
                                               "order_create_time", "total_amount", "split_total_amount")


@query("payment_wide")
def payment_wide(spark, sf):
    i = Inputs(spark, sf)
    return _payment_wide(i, _order_wide(i))


@query("order_wide_merge")
def order_wide_merge(spark, sf):
    i = Inputs(spark, sf)
    return wide.merge_partial_wide(wide.partial_from_order(i.order_info), wide.partial_from_detail(i.order_detail))


@query("province_rows")
def province_rows(spark, sf):
    i = Inputs(spark, sf)
    return wide.province_rows(wide.lookup_province(_joined(i), i.dims["province"]))


@query("province_stats")
def province_stats(spark, sf):
    i = Inputs(spark, sf)
    return stats.province_stats(_joined(i), i.dims["province"], SCALE["stats_window"])


# ------------------------------------------------------------------ products

def _feeds(i: Inputs) -> list[DataFrame]:
    # orders and payments need no dimension: lookups come after the aggregate
    joined = _joined(i, i.order_amounts).select("order_id", "sku_id", "sku_num", "split_total_amount", "create_time")
    return [
        stats.product_clicks(i.page_log, click_page_id="click"),
        stats.product_displays(i.display_log),
        stats.product_favors(driver.favor_info(i.t.events)),
        stats.product_carts(driver.cart_info(i.t.events)),
        stats.product_orders_and_payments(joined, i.payment_info, SCALE["payment_lower_ms"], SCALE["payment_upper_ms"]),
        stats.product_refunds(driver.refund_info(i.t.lineitem)),
        stats.product_comments(driver.comment_info(i.t.labels)),
    ]


@query("product_clicks")
def product_clicks(spark, sf):
    return stats.product_clicks(Inputs(spark, sf).page_log, click_page_id="click").select("sku_id", "click_ct", "ts")


@query("product_displays")
def product_displays(spark, sf):
    return stats.product_displays(Inputs(spark, sf).display_log).select("sku_id", "display_ct", "ts")


@query("comment_counts")
def comment_counts(spark, sf):
    return stats.product_comments(driver.comment_info(Inputs(spark, sf).t.labels)).select(
        "sku_id", "comment_ct", "good_comment_ct", "ts")


@query("product_union")
def product_union(spark, sf):
    return stats.product_union(*_feeds(Inputs(spark, sf)))


@query("product_stats")
def product_stats(spark, sf):
    return stats.product_aggregate(stats.product_union(*_feeds(Inputs(spark, sf))), SCALE["stats_window"])


def _product_stats_full(i: Inputs) -> DataFrame:
    agg = stats.product_aggregate(stats.product_union(*_feeds(i)), SCALE["stats_window"])
    return stats.product_dims(agg, i.dims)


@query("product_stats_dims")
def product_stats_dims(spark, sf):
    return _product_stats_full(Inputs(spark, sf))


@query("gmv_by_day")
def gmv_by_day(spark, sf):
    return stats.gmv_from_feeds(*_feeds(Inputs(spark, sf)))


@query("gmv_daily")
def gmv_daily(spark, sf):
    """Totals by day kept in a stored table, in two batches that share days."""
    from ..streaming.jobs import add_daily_gmv
    i = Inputs(spark, sf)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/gmv_daily"
    dimstore.drop(spark, path)
    feeds = [f.select("sku_id", "ts", "order_amount") for f in _feeds(i)]
    for batch in (0, 1):
        days = stats.gmv_from_feeds(*[f.filter(F.coalesce(F.pmod("sku_id", F.lit(2)), F.lit(0)) == batch) for f in feeds])
        add_daily_gmv(spark, path, days, batch)
    return dimstore.read(spark, path)


@query("gmv_day")
def gmv_day(spark, sf):
    return stats.gmv(product_stats(spark, sf), GMV_DAY)


# ------------------------------------------------------------------ keywords

@query("keyword_filter")
def keyword_filter(spark, sf):
    found = stats.keyword_filter(logsplit.page_lines(Inputs(spark, sf).parsed_log))
    return found.select("full_word", F.date_format("rt", "yyyy-MM-dd HH:mm:ss").alias("rt"))


def _keyword_words(i: Inputs) -> DataFrame:
    return keywords.keyword_explode(driver.keyword_source(i.t.documents))


@query("keyword_explode")
def keyword_explode(spark, sf):
    return _keyword_words(Inputs(spark, sf)).select(
        F.date_format("rt", "yyyy-MM-dd HH:mm:ss").alias("rt"), "word")


@query("keyword_stats")
def keyword_stats(spark, sf):
    return stats.keyword_stats(_keyword_words(Inputs(spark, sf)), SCALE["stats_window"])


def _dictionary(i: Inputs) -> DataFrame:
    """The longer words of the benchmark passages."""
    words = i.t.benchmark.select(F.explode(word_tokens("text")).alias("word"))
    return words.filter(F.length("word") >= 4).distinct()


def _segmented(i: Inputs, longest: bool) -> DataFrame:
    texts = i.t.documents.select("doc_id", F.lower("text").alias("full_word"))
    found = keywords.dictionary_words(texts, _dictionary(i), keep=("doc_id",), longest=longest)
    return found.groupBy("word").agg(F.count("*").alias("ct"), F.count_distinct("doc_id").alias("texts"))


@query("keyword_dictionary")
def keyword_dictionary(spark, sf):
    """Dictionary words in the whole texts, wherever they stand, and how often."""
    return _segmented(Inputs(spark, sf), False)


@query("keyword_dictionary_longest")
def keyword_dictionary_longest(spark, sf):
    """The same without words inside longer ones."""
    return _segmented(Inputs(spark, sf), True)


# ------------------------------------------------------------------ change records

def _change_cols(c: DataFrame) -> DataFrame:
    return c.select("database", "tableName", "type", map_as_text("before").alias("before_text"),
                    map_as_text("after").alias("after_text"), "key", "version")


@query("cdc_normalize")
def cdc_normalize(spark, sf):
    return _change_cols(Inputs(spark, sf).changes)


@query("filter_not_delete")
def filter_not_delete(spark, sf):
    return _change_cols(cdc.drop_deletes(Inputs(spark, sf).changes))


ORDER_STATE = {"id": "bigint", "user_id": "bigint", "order_status": "string",
               "total_amount": "decimal(16,2)", "create_time": "string"}


@query("cdc_current_state")
def cdc_current_state(spark, sf):
    c = cdc.for_tables(Inputs(spark, sf).changes, driver.DATABASE, ["order_info"])
    return cdc.typed_after(cdc.current_state(c, "id", "version"), ORDER_STATE)


def _route_cols(r: DataFrame) -> DataFrame:
    return r.select("tableName", "type", "sinkType", "sinkTable", "pk",
                    map_as_text("after").alias("after_text"), "key", "version")


@query("route_fact")
def route_fact(spark, sf):
    i = Inputs(spark, sf)
    return _route_cols(routing.route_fact(i.changes, i.config))


@query("route_dim")
def route_dim(spark, sf):
    i = Inputs(spark, sf)
    return _route_cols(routing.route_dim(i.changes, i.config))


@query("route_prune_columns")
def route_prune_columns(spark, sf):
    i = Inputs(spark, sf)
    return _route_cols(routing.route(i.changes, i.config))


@query("route_unmatched")
def route_unmatched(spark, sf):
    i = Inputs(spark, sf)
    return _change_cols(routing.unmatched(i.changes, i.config))


@query("route_as_of")
def route_as_of(spark, sf):
    """T4: each change by the rule that held at its position in the log; the place of an order's changes is its key."""
    i = Inputs(spark, sf)
    placed = i.changes.withColumn("position", F.col("key").cast("bigint"))
    routed = routing.route(placed, routing.rule_history(driver.rule_changes(spark)), at="position")
    return _route_cols(routed)


def _status_dim(i: Inputs) -> DataFrame:
    base = i.order_info.select(F.col("id").cast("string").alias("id"), "order_status")
    ch = routing.route_dim(i.changes, i.config).select(
        F.col("after")["id"].alias("id"), F.col("after")["order_status"].alias("order_status"), "version")
    return upsert_dim(base, ch, "id", "version")


@query("dim_upsert")
def dim_upsert(spark, sf):
    return _status_dim(Inputs(spark, sf))


@query("dim_latest_version")
def dim_latest_version(spark, sf):
    i = Inputs(spark, sf)
    dim = _status_dim(i).withColumnRenamed("id", "ID")
    return lookup(i.order_detail.select(F.col("id").alias("detail_id"), "order_id", "sku_id"), dim,
                  "order_id", {"order_status": "order_status"})


def _stored_status_dim(i: Inputs) -> str:
    """The statuses as a stored dimension: a first batch, then the routed changes as the next one."""
    spark = i.spark
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/dim_order_status"
    base = i.order_info.select(F.col("id").cast("string").alias("id"), "order_status")
    routed = routing.route_dim(i.changes, i.config)
    dimstore.drop(spark, path)
    dimstore.create(spark, path, base.schema, "id")
    dimstore.upsert(spark, path, base, 0)
    dimstore.upsert(spark, path, routed.select(F.col("after")["id"].alias("id"), F.col("after")["order_status"].alias("order_status"), "version"),
                    1, "version")
    return path


@query("dim_store")
def dim_store(spark, sf):
    return dimstore.read(spark, _stored_status_dim(Inputs(spark, sf)))


@query("dim_key_read")
def dim_key_read(spark, sf):
    """The row of one key, the greatest."""
    path = _stored_status_dim(Inputs(spark, sf))
    return dimstore.read_key(spark, path, dimstore.read(spark, path).agg(F.max("id")).first()[0])


@query("dim_point_lookup")
def dim_point_lookup(spark, sf):
    i = Inputs(spark, sf)
    return lookup(i.order_info.select("id", "user_id"), i.dims["user"], "user_id",
                  {"gender": "GENDER", "birthday": "BIRTHDAY"}, how="inner")


@query("rename_snake_to_camel")
def rename_snake_to_camel(spark, sf):
    from ..functions.names import rename_columns_camel
    return rename_columns_camel(Inputs(spark, sf).order_info)


@query("decode_codes")
def decode_codes(spark, sf):
    from ..functions.codes import decode
    o = Inputs(spark, sf).t.orders
    status = (F.lit(1001) + F.col("o_orderkey") % 6).cast("string")
    kind = (F.lit(1101) + F.col("o_orderkey") % 4).cast("string")  # the fourth has no name
    return o.select(F.col("o_orderkey").alias("order_id"), status.alias("order_status"), decode(status).alias("order_status_name"),
                    kind.alias("payment_type"), decode(kind).alias("payment_type_name"))


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
