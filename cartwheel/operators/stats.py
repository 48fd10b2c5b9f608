"""Windowed statistics.

All are partial + final hash aggregates keyed by (window, keys): Spark
combines map-side before the shuffle, so a hot key sends one partial row per
task.  Dimension lookups come *after* the aggregate (J11): they run per
window result, not per event.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import COMMERCE_TZ, TEXT_FORMAT, day_int, ms_to_text, ms_to_wallclock, text_to_ms, wallclock_to_ms
from ..functions.codes import APPRAISE_GOOD
from .joins import lookup

MONEY_SUM = "decimal(18,2)"


def _windowed(df: DataFrame, ts_ms, size: str, watermark: str | None = None) -> DataFrame:
    """Add ``_w`` = tumbling window over the instant ``timestamp_millis(ts_ms)``.

    Tumbling windows align to the epoch, so bounds do not depend on any zone;
    a streaming caller passes ``watermark`` (late rows behind it are dropped,
    W2-W4, W7) and the same function serves batch and stream.
    """
    ms = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    d = df.withColumn("_et", F.timestamp_millis(ms))
    if watermark is not None:
        d = d.withWatermark("_et", watermark)
    return d.withColumn("_w", F.window("_et", size))


def _again(windows: DataFrame, size: str, streaming: bool) -> DataFrame:
    """Rows of a windowed aggregate, to be aggregated by the same windows once more.

    A stream takes the window again from the event time of the closed one, which carries the watermark on."""
    if not streaming:
        return windows
    return windows.withColumn("_t", F.window_time("_w")).drop("_w").withColumn("_w", F.window("_t", size)).drop("_t")


def _stt_edt(tz: str = "UTC", fmt: str = TEXT_FORMAT):
    return [ms_to_text(F.unix_millis(F.col("_w.start")), tz, fmt).alias("stt"),
            ms_to_text(F.unix_millis(F.col("_w.end")), tz, fmt).alias("edt")]


def tumble_counts(df: DataFrame, ts_ms: str, size: str, keys=(), tz: str = "UTC",
                  watermark: str | None = None) -> DataFrame:
    """Rows per tumbling window (and keys), with ``stt``/``edt`` text."""
    keys = list(keys)
    return (_windowed(df, ts_ms, size, watermark).groupBy("_w", *keys)
            .agg(F.count(F.lit(1)).alias("ct"), F.min(ts_ms).alias("ts"))
            .select(*_stt_edt(tz), *keys, "ct", "ts"))


# ---------------------------------------------------------------- visitors

VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]
VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def visitor_rows(page: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    """P19 + U1: page, unique-visit and bounce rows as one measure stream."""
    def rows(df, uv_ct, pv_ct, sv_ct, uj_ct, dur):
        return df.select(*VISITOR_KEYS, F.lit(uv_ct).cast("bigint").alias("uv_ct"),
                         F.lit(pv_ct).cast("bigint").alias("pv_ct"), sv_ct.cast("bigint").alias("sv_ct"),
                         F.lit(uj_ct).cast("bigint").alias("uj_ct"), dur.cast("bigint").alias("dur_sum"), "ts")
    pv = rows(page, 0, 1, F.when(F.col("last_page_id").isNull(), 1).otherwise(0), 0,
              F.coalesce(F.col("during_time"), F.lit(0)))  # Q15: NULL duration adds 0
    return reduce(DataFrame.unionByName, [rows(uv, 1, 0, F.lit(0), 0, F.lit(0)), rows(uj, 0, 0, F.lit(0), 1, F.lit(0)), pv])


def visitor_measures(flagged: DataFrame) -> DataFrame:
    """P19 from ``visits.visit_flags``: the measures of a page row and its
    visit and bounce rows, which share its keys and time, as one row."""
    return flagged.select(*VISITOR_KEYS, F.col("uv").cast("bigint").alias("uv_ct"), F.lit(1).cast("bigint").alias("pv_ct"),
                          F.col("last_page_id").isNull().cast("bigint").alias("sv_ct"),
                          F.col("uj").cast("bigint").alias("uj_ct"),
                          F.coalesce(F.col("during_time"), F.lit(0)).cast("bigint").alias("dur_sum"), "ts")


def visitor_union(flagged: DataFrame) -> DataFrame:
    """U1 from ``visits.visit_flags``: page, unique-visit and bounce rows, out of one pass."""
    m = visitor_measures(flagged)
    zero = F.lit(0).cast("bigint")

    def kind(uv, pv, sv, uj, dur):
        return F.struct(*[c.alias(n) for n, c in zip(VISITOR_MEASURES, (uv, pv, sv, uj, dur))])

    rows = F.array_compact(F.array(
        kind(zero, F.col("pv_ct"), F.col("sv_ct"), zero, F.col("dur_sum")),
        F.when(F.col("uv_ct") == 1, kind(F.col("uv_ct"), zero, zero, zero, zero)),
        F.when(F.col("uj_ct") == 1, kind(zero, zero, zero, F.col("uj_ct"), zero))))
    return m.select(*VISITOR_KEYS, "ts", F.explode(rows).alias("m")).select(*VISITOR_KEYS, "m.*", "ts")


def visitor_stats(rows: DataFrame, size: str = "10 seconds", tz: str = "UTC",
                  watermark: str | None = None) -> DataFrame:
    """5 sums per (window, ar, ch, vc, is_new); ``ts`` = earliest row.
    Streams: ``watermark="14 seconds"`` as the reference (W3)."""
    return (_windowed(rows, "ts", size, watermark).groupBy("_w", "ar", "ch", "vc", "is_new")
            .agg(*[F.sum(m).alias(m) for m in VISITOR_MEASURES], F.min("ts").alias("ts"))
            .select(*_stt_edt(tz), *VISITOR_KEYS, *VISITOR_MEASURES, "ts"))


# ---------------------------------------------------------------- products

PRODUCT_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
PRODUCT_SETS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id", "refund_order_ct": "refund_order_id"}
# Fixed value: the column order of the table.
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
    "order_amount", "order_ct", "payment_amount", "paid_order_ct", "refund_order_ct", "refund_amount",
    "comment_ct", "good_comment_ct", "ts",
]


def _feed_columns(sku, ts, **measures) -> list:
    """The columns of a product-stats feed row: zero for every measure not given."""
    cols = [F.col(sku).cast("bigint").alias("sku_id") if isinstance(sku, str) else sku.cast("bigint").alias("sku_id")]
    for m in PRODUCT_COUNTS:
        cols.append((measures[m] if m in measures else F.lit(0)).cast("bigint").alias(m))
    for m in PRODUCT_AMOUNTS:
        cols.append((measures[m] if m in measures else F.lit(0)).cast("decimal(16,2)").alias(m))
    for s in PRODUCT_SETS.values():
        cols.append((measures[s] if s in measures else F.lit(None)).cast("bigint").alias(s))
    return cols + [ts.alias("ts")]


def _feed(df: DataFrame, sku, ts, **measures) -> DataFrame:
    return df.select(*_feed_columns(sku, ts, **measures))


def product_clicks(page: DataFrame, click_page_id: str = "good_detail", item_type: str = "sku_id") -> DataFrame:
    """P20: detail-page clicks."""
    f = page.filter((F.col("item_type") == item_type) & (F.col("page_id") == click_page_id))
    return _feed(f, "item", F.col("ts"), click_ct=F.lit(1))


def product_displays(displays: DataFrame, item_type: str = "sku_id", type_field: str = "item_type") -> DataFrame:
    """Displays of SKUs (the type field name is a parameter, Q7)."""
    f = displays.filter(F.col("display")[type_field] == item_type)
    return _feed(f, F.col("display")["item"], F.col("ts"), display_ct=F.lit(1))


def product_favors(favor: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P23 (favor; reads ``create_time``, fixing Q6)."""
    return _feed(favor, "sku_id", text_to_ms("create_time", tz), favor_ct=F.lit(1))


def product_carts(cart: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P23 (cart)."""
    return _feed(cart, "sku_id", text_to_ms("create_time", tz), cart_ct=F.lit(1))


def product_orders(ow: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P24 (orders, from order-wide, fixing Q5)."""
    return _feed(ow, "sku_id", text_to_ms("create_time", tz), order_sku_num=F.col("sku_num"),
                 order_amount=F.col("split_total_amount"), order_id=F.col("order_id"))


def product_payments(pw: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P24 (payments)."""
    return _feed(pw, "sku_id", text_to_ms("payment_create_time", tz),
                 payment_amount=F.col("split_total_amount"), paid_order_id=F.col("order_id"))


def product_orders_and_payments(ow: DataFrame, payment_info: DataFrame, lower_ms: int, upper_ms: int, tz: str = COMMERCE_TZ) -> DataFrame:
    """P24, batch form: the rows of ``product_orders`` and of ``product_payments`` out of one pass over the joined orders.

    The payments of an order, a few rows, are looked up with it; a row of the order is paid by those whose time
    reaches from ``lower_ms`` before its own to ``upper_ms`` after (J2), and gives a row for itself and for each of them."""
    paid = (payment_info.select(F.col("order_id").alias("_paid"), text_to_ms("create_time", tz).alias("_at"))
            .filter(F.col("_at").isNotNull()).groupBy("_paid").agg(F.collect_list("_at").alias("_payments")))
    at = text_to_ms("create_time", tz)
    mine = F.filter("_payments", lambda p: (at >= p - lower_ms) & (at <= p + upper_ms))
    # no payment time for the row itself, then one for each payment; only times are exploded
    times = F.concat(F.array(F.lit(None).cast("bigint")), F.coalesce(mine, F.array().cast("array<bigint>")))
    rows = ow.join(paid, F.col("order_id") == F.col("_paid"), "left").withColumn("_pay", F.explode(times))
    own = F.col("_pay").isNull()

    def order(c, other=0):
        return F.when(own, F.col(c)).otherwise(F.lit(other))

    return _feed(rows, "sku_id", F.coalesce("_pay", at), order_sku_num=order("sku_num"), order_amount=order("split_total_amount"),
                 order_id=order("order_id", None), payment_amount=F.when(own, F.lit(0)).otherwise(F.col("split_total_amount")),
                 paid_order_id=F.when(~own, F.col("order_id")))


def product_refunds(refund: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P24 (refunds)."""
    return _feed(refund, "sku_id", text_to_ms("create_time", tz),
                 refund_amount=F.col("refund_amount"), refund_order_id=F.col("order_id"))


def product_comments(comment: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P25: comments and good comments."""
    good = F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0)
    return _feed(comment, "sku_id", text_to_ms("create_time", tz), comment_ct=F.lit(1), good_comment_ct=good)


def product_union(*feeds: DataFrame) -> DataFrame:
    """Union of the feeds (all share the measure layout of ``_feed``)."""
    return reduce(DataFrame.unionByName, feeds)


def product_aggregate(feeds: DataFrame, size: str = "10 seconds", tz: str = "UTC",
                      streaming: bool = False, watermark: str | None = None) -> DataFrame:
    """Sums, and distinct order counts per role, per (window, SKU).

    Every feed row carries at most one order id (of one role: order, paid,
    refund).  A first aggregate keyed by (window, SKU, role, id) pre-sums the
    measures and makes ids unique; a second keyed by (window, SKU) adds the
    partial sums and counts ids per role.  Two partial+final aggregates, no
    per-group sets and no row expansion (three ``count(DISTINCT ...)`` would
    expand every row four times).  On streams the second runs on the closed
    windows of the first, by their event time (``_again``), in append mode.
    """
    w = _windowed(feeds, "ts", size, watermark)
    sums = [F.sum(m).alias(m) for m in PRODUCT_COUNTS + PRODUCT_AMOUNTS]
    roles = list(PRODUCT_SETS.values())
    role = None
    for k, c in enumerate(roles):
        role = (F.when(F.col(c).isNotNull(), k) if role is None else role.when(F.col(c).isNotNull(), k))
    step1 = (w.withColumn("_role", role).withColumn("_id", F.coalesce(*[F.col(c) for c in roles]))
              .groupBy("_w", "sku_id", "_role", "_id").agg(*sums, F.min("ts").alias("ts")))
    agg = (_again(step1, size, streaming).groupBy("_w", "sku_id")
           .agg(*sums, *[F.count(F.when(F.col("_role") == k, F.col("_id"))).alias(n) for k, n in enumerate(PRODUCT_SETS.keys())],
                F.min("ts").alias("ts")))
    return agg.select(*_stt_edt(tz), "sku_id", *[F.col(m).cast("bigint").alias(m) for m in PRODUCT_COUNTS],
                      *[F.col(m).cast(MONEY_SUM).alias(m) for m in PRODUCT_AMOUNTS],
                      *[F.col(n).cast("bigint").alias(n) for n in PRODUCT_SETS], "ts")


def product_dims(stats: DataFrame, dims: dict, how: str = "left") -> DataFrame:
    """SKU (incl. price), SPU, category and trademark after the aggregate."""
    j = lookup(stats, dims["sku"], "sku_id", {
        "sku_name": "SKU_NAME", "sku_price": ("PRICE", "decimal(16,2)"), "spu_id": ("SPU_ID", "bigint"),
        "tm_id": ("TM_ID", "bigint"), "category3_id": ("CATEGORY3_ID", "bigint")}, how=how)
    j = lookup(j, dims["spu"], "spu_id", {"spu_name": "SPU_NAME"}, how=how)
    j = lookup(j, dims["category3"], "category3_id", {"category3_name": "NAME"}, how=how)
    j = lookup(j, dims["trademark"], "tm_id", {"tm_name": "TM_NAME"}, how=how)
    return j.select(*PRODUCT_STATS_COLUMNS)


# ---------------------------------------------------------------- provinces

PROVINCE_COLUMNS = {"province_name": "NAME", "province_area_code": "AREA_CODE", "province_iso_code": "ISO_CODE",
                    "province_3166_2_code": "ISO_3166_2"}


def province_windows(ow: DataFrame, size: str = "10 seconds", streaming: bool = False,
                     watermark: str | None = None) -> DataFrame:
    """A1: amount and distinct orders per (window, province id); event time is
    the wall-clock ``create_time`` text (P6/F11, read as UTC so window text
    equals the input text); money keeps its cents (Q9).  Orders are made unique
    by a first aggregate, in batch and on streams alike."""
    d = ow.withColumn("_ms", text_to_ms("create_time", "UTC"))
    orders = (_windowed(d, "_ms", size, watermark).groupBy("_w", "province_id", "order_id")
              .agg(F.sum("split_total_amount").alias("order_amount"), F.min("_ms").alias("ts")))
    return (_again(orders, size, streaming).groupBy("_w", "province_id")
            .agg(F.sum("order_amount").cast(MONEY_SUM).alias("order_amount"), F.count("order_id").alias("order_count"), F.min("ts").alias("ts"))
            .select(*_stt_edt(), "province_id", "order_amount", "order_count", "ts"))


def province_names(windows: DataFrame, dim_province: DataFrame) -> DataFrame:
    """J6 after the aggregate."""
    return lookup(windows, dim_province, "province_id", PROVINCE_COLUMNS).select(
        "stt", "edt", "province_id", *PROVINCE_COLUMNS, "order_amount", "order_count", "ts")


def province_stats(ow: DataFrame, dim_province: DataFrame, size: str = "10 seconds") -> DataFrame:
    """A1 with the province looked up after the aggregate."""
    return province_names(province_windows(ow, size), dim_province)


# ---------------------------------------------------------------- keywords

def keyword_filter(page: DataFrame) -> DataFrame:
    """Search pages with a phrase: ``page['item_type']='keyword'``."""
    return (page.filter((F.col("page")["item_type"] == "keyword") & F.col("page")["item"].isNotNull())
                .select(F.col("page")["item"].alias("full_word"),
                        ms_to_wallclock("ts").alias("rt")))


def keyword_stats(words: DataFrame, size: str = "10 seconds", source: str = "search",
                  watermark: str | None = None) -> DataFrame:
    """A2 + P27: ``count(*)`` per (window, word); ``ts`` = first event.
    ``rt`` is wall-clock (NTZ, read as UTC)."""
    d = words.withColumn("_ms", wallclock_to_ms("rt", "UTC"))
    return (_windowed(d, "_ms", size, watermark).groupBy("_w", "word")
            .agg(F.count(F.lit(1)).alias("ct"), F.min("_ms").alias("ts"))
            .select(F.col("word").alias("keyword"), "ct", F.lit(source).alias("source"), *_stt_edt(), "ts"))


# ---------------------------------------------------------------- serving

def day_range(day: int | None = None) -> tuple[str, str]:
    """Texts of a day ``yyyyMMdd`` and of the next one; 0 or None is today (UTC)."""
    d = _dt.datetime.strptime(str(day), "%Y%m%d").date() if day else _dt.datetime.now(_dt.timezone.utc).date()
    return d.isoformat(), (d + _dt.timedelta(days=1)).isoformat()


def gmv(stats: DataFrame, day: int | None = None) -> DataFrame:
    """GMV of one day, the sum of ``order_amount``; NULL without rows.

    The day is a range of the ``stt`` text, a plain comparison that reaches
    the scan of a stored table."""
    lo, hi = day_range(day)
    return stats.filter((F.col("stt") >= lo) & (F.col("stt") < hi)).agg(F.sum("order_amount").cast(MONEY_SUM).alias("gmv"))


def gmv_by_day(stats: DataFrame) -> DataFrame:
    """A8 for every day of the statistics."""
    day = F.regexp_replace(F.substring("stt", 1, 10), "-", "").cast("int")
    return stats.groupBy(day.alias("day")).agg(F.sum("order_amount").cast(MONEY_SUM).alias("gmv"))


def add_to_days(totals: DataFrame, days: DataFrame) -> DataFrame:
    """A8 kept up to date: of the days in ``days`` (``day``, ``gmv``) alone, their totals with what is added."""
    before = totals.select("day", F.col("gmv").alias("_before"))
    return days.join(before, "day", "left").select(
        "day", (F.coalesce("_before", F.lit(0)) + F.coalesce("gmv", F.lit(0))).cast(MONEY_SUM).alias("gmv"))


def gmv_from_feeds(*feeds: DataFrame, tz: str = "UTC") -> DataFrame:
    """A8 for every day straight from the product feeds: the windows of the
    statistics lie inside days, so their sums per day need no windows.  Days
    with other feeds only have 0."""
    rows = product_union(*[f.select("ts", "order_amount") for f in feeds]).filter(F.col("ts").isNotNull())
    return rows.groupBy(day_int(ms_to_wallclock("ts", tz)).alias("day")).agg(
        F.sum("order_amount").cast(MONEY_SUM).alias("gmv"))
