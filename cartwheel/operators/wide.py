"""Order-wide and payment-wide facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import COMMERCE_TZ, split_text_time, text_to_ms, text_to_ms_or
from .joins import age_years, interval_join, lookup

# Row layouts.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
    "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "expire_time", "create_time", "operate_time", "create_date", "create_hour",
    "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]

PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time",
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
    "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "split_feight_fee", "split_activity_amount", "split_coupon_amount", "split_total_amount",
    "order_create_time", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code",
    "user_age", "user_gender", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]


def order_time_parts(order_info: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """P5: ``create_date``, ``create_hour``, ``create_ts`` from ``create_time``."""
    d, h = split_text_time(F.col("create_time"))
    return (order_info.withColumn("create_date", d).withColumn("create_hour", h)
                      .withColumn("create_ts", text_to_ms("create_time", tz)))


def detail_time(order_detail: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    return order_detail.withColumn("create_ts", text_to_ms("create_time", tz))


def order_interval_join(order_info: DataFrame, order_detail: DataFrame, lower_ms: int, upper_ms: int,
                        tz: str = COMMERCE_TZ, watermark: str | None = None) -> DataFrame:
    """J1 + P15: order ⋈ detail on ``id = order_id`` within the interval -> wide row
    (dimension columns still NULL)."""
    o = order_time_parts(order_info, tz).select(
        *[F.col(c).alias(f"o_{c}") for c in order_time_parts(order_info, tz).columns])
    d = detail_time(order_detail, tz).select(*[F.col(c).alias(f"d_{c}") for c in detail_time(order_detail, tz).columns])
    j = interval_join(o, d, "o_id", "d_order_id", "o_create_ts", "d_create_ts", lower_ms, upper_ms,
                      watermark=watermark)
    null_s, null_l, null_i = F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(None).cast("int")
    mapping = {
        "detail_id": F.col("d_id"), "order_id": F.col("o_id"), "sku_id": F.col("d_sku_id"),
        "order_price": F.col("d_order_price"), "sku_num": F.col("d_sku_num"), "sku_name": F.col("d_sku_name"),
        "province_id": F.col("o_province_id"), "order_status": F.col("o_order_status"),
        "user_id": F.col("o_user_id"), "total_amount": F.col("o_total_amount"),
        "activity_reduce_amount": F.col("o_activity_reduce_amount"),
        "coupon_reduce_amount": F.col("o_coupon_reduce_amount"),
        "original_total_amount": F.col("o_original_total_amount"), "feight_fee": F.col("o_feight_fee"),
        # Declared but never filled in the reference (Q10): freight share stays NULL.
        "split_feight_fee": F.lit(None).cast("decimal(16,2)"),
        "split_activity_amount": F.col("d_split_activity_amount"),
        "split_coupon_amount": F.col("d_split_coupon_amount"),
        "split_total_amount": F.col("d_split_total_amount"),
        "expire_time": F.col("o_expire_time"), "create_time": F.col("o_create_time"),
        "operate_time": F.col("o_operate_time"), "create_date": F.col("o_create_date"),
        "create_hour": F.col("o_create_hour"),
        "province_name": null_s, "province_area_code": null_s, "province_iso_code": null_s,
        "province_3166_2_code": null_s, "user_age": null_i, "user_gender": null_s,
        "spu_id": null_l, "tm_id": null_l, "category3_id": null_l,
        "spu_name": null_s, "tm_name": null_s, "category3_name": null_s,
    }
    return j.select(*[mapping[c].alias(c) for c in ORDER_WIDE_COLUMNS])


def lookup_user(ow: DataFrame, dim_user: DataFrame, as_of_ms, how: str = "left", tz: str = "UTC") -> DataFrame:
    """Gender and age in whole 365-day years at ``as_of_ms`` (F14 made injectable)."""
    j = lookup(ow, dim_user, "user_id", {"user_gender": "GENDER", "_birthday": "BIRTHDAY"}, how=how)
    asof = as_of_ms if not isinstance(as_of_ms, int) else F.lit(as_of_ms)
    return j.withColumn("user_age", age_years(F.col("_birthday"), asof, tz)).drop("_birthday").select(*ow.columns)


def lookup_province(ow: DataFrame, dim_province: DataFrame, how: str = "left") -> DataFrame:
    """J6."""
    return lookup(ow, dim_province, "province_id", {
        "province_name": "NAME", "province_area_code": "AREA_CODE",
        "province_iso_code": "ISO_CODE", "province_3166_2_code": "ISO_3166_2"}, how=how).select(*ow.columns)


def lookup_sku(ow: DataFrame, dim_sku: DataFrame, how: str = "left") -> DataFrame:
    """SKU name and the SPU / trademark / category keys of the snowflake."""
    return lookup(ow, dim_sku, "sku_id", {
        "sku_name": "SKU_NAME", "spu_id": ("SPU_ID", "bigint"), "tm_id": ("TM_ID", "bigint"),
        "category3_id": ("CATEGORY3_ID", "bigint")}, how=how).select(*ow.columns)


def lookup_snowflake(ow: DataFrame, dim_spu: DataFrame, dim_tm: DataFrame, dim_c3: DataFrame,
                     how: str = "left") -> DataFrame:
    """Names of SPU, trademark and category (keys come from J7)."""
    j = lookup(ow, dim_spu, "spu_id", {"spu_name": "SPU_NAME"}, how=how)
    j = lookup(j, dim_tm, "tm_id", {"tm_name": "TM_NAME"}, how=how)
    j = lookup(j, dim_c3, "category3_id", {"category3_name": "NAME"}, how=how)
    return j.select(*ow.columns)


def order_wide(order_info: DataFrame, order_detail: DataFrame, dims: dict, lower_ms: int, upper_ms: int,
               as_of_ms, how: str = "left", tz: str = COMMERCE_TZ, age_tz: str = "UTC") -> DataFrame:
    """Order-wide job: interval join then six lookups.

    ``dims``: ``user, province, sku, spu, trademark, category3`` DataFrames.
    """
    return wide_lookups(order_interval_join(order_info, order_detail, lower_ms, upper_ms, tz), dims, as_of_ms, how, age_tz)


def wide_lookups(ow: DataFrame, dims: dict, as_of_ms, how: str = "left", age_tz: str = "UTC") -> DataFrame:
    """J5-J10 on joined order rows."""
    ow = lookup_user(ow, dims["user"], as_of_ms, how, age_tz)
    ow = lookup_province(ow, dims["province"], how)
    ow = lookup_sku(ow, dims["sku"], how)
    return lookup_snowflake(ow, dims["spu"], dims["trademark"], dims["category3"], how)


def payment_interval_join(payment_info: DataFrame, ow: DataFrame, lower_ms: int, upper_ms: int,
                          tz: str = COMMERCE_TZ, record_ts: str | None = None,
                          watermark: str | None = None) -> DataFrame:
    """J2 + P16: payment ⋈ order-wide, order time in [pay + lower, pay + upper].

    Same-named columns take the payment's value (``order_id``, ``user_id``,
    ``total_amount``); the two create times keep their own names.  A payment
    time that does not parse falls back to the time of its record, the epoch
    milliseconds in column ``record_ts`` of ``payment_info`` (F17); without
    that column such a payment has no time and joins nothing.
    """
    p = payment_info.select(*[F.col(c).alias(f"p_{c}") for c in payment_info.columns])
    o = ow.withColumn("_ow_ts", text_to_ms("create_time", tz))
    pay_ts = text_to_ms_or("p_create_time", f"p_{record_ts}", tz) if record_ts else text_to_ms("p_create_time", tz)
    j = interval_join(p.withColumn("_pay_ts", pay_ts), o, "p_order_id", "order_id", "_pay_ts", "_ow_ts", -lower_ms, upper_ms,
                      watermark=watermark)
    from_payment = {"payment_id": "p_id", "subject": "p_subject", "payment_type": "p_payment_type",
                    "payment_create_time": "p_create_time", "callback_time": "p_callback_time",
                    "order_id": "p_order_id", "user_id": "p_user_id", "total_amount": "p_total_amount"}
    sel = []
    for c in PAYMENT_WIDE_COLUMNS:
        if c in from_payment:
            sel.append(F.col(from_payment[c]).alias(c))
        elif c == "order_create_time":
            sel.append(F.col("create_time").alias(c))
        elif c in ow.columns:
            sel.append(F.col(c))
    return j.select(*sel)


def merge_partial_wide(a: DataFrame, b: DataFrame, keys=("order_id",)) -> DataFrame:
    """Full-outer join of two partial wide rows, first non-NULL per column
    (all three split amounts take either side, fixing Q11)."""
    keys = list(keys)
    cols = [c for c in ORDER_WIDE_COLUMNS if c not in keys]
    aa = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols])
    bb = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols])
    j = aa.join(bb, keys, "full")
    return j.select(*[F.col(k) for k in keys],
                    *[F.coalesce(F.col(f"a_{c}"), F.col(f"b_{c}")).alias(c) for c in cols]) \
            .select(*ORDER_WIDE_COLUMNS)


def partial_from_order(order_info: DataFrame, tz: str = COMMERCE_TZ) -> DataFrame:
    """Order-only partial wide row (detail columns NULL)."""
    o = order_time_parts(order_info, tz)
    have = {"order_id": F.col("id")}
    for c in ("province_id", "order_status", "user_id", "total_amount", "activity_reduce_amount",
              "coupon_reduce_amount", "original_total_amount", "feight_fee", "expire_time", "create_time",
              "operate_time", "create_date", "create_hour"):
        have[c] = F.col(c)
    return _fill(o, have)


def partial_from_detail(order_detail: DataFrame) -> DataFrame:
    """Detail-only partial wide row (order columns NULL)."""
    have = {"detail_id": F.col("id"), "order_id": F.col("order_id")}
    for c in ("sku_id", "order_price", "sku_num", "sku_name", "split_activity_amount",
              "split_coupon_amount", "split_total_amount"):
        have[c] = F.col(c)
    return _fill(order_detail, have)


_TYPES = {"detail_id": "bigint", "order_id": "bigint", "sku_id": "bigint", "sku_num": "bigint",
          "province_id": "bigint", "user_id": "bigint", "user_age": "int", "spu_id": "bigint",
          "tm_id": "bigint", "category3_id": "bigint"}


def _fill(df: DataFrame, have: dict) -> DataFrame:
    money = {"order_price", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
             "original_total_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
             "split_coupon_amount", "split_total_amount"}
    out = []
    for c in ORDER_WIDE_COLUMNS:
        t = _TYPES.get(c, "decimal(16,2)" if c in money else "string")
        out.append((have[c] if c in have else F.lit(None)).cast(t).alias(c))
    return df.select(*out)


def province_rows(ow: DataFrame) -> DataFrame:
    """Order-wide -> province measure row with ``order_count = 1``."""
    return ow.select("province_id", "province_name", "province_area_code", "province_iso_code",
                     "province_3166_2_code", F.col("split_total_amount").alias("order_amount"),
                     F.lit(1).cast("bigint").alias("order_count"), "order_id", "create_time")
