"""JSON helpers: validity, typed parse, field set/remove, serialisation.

Schema-free objects from the reference become ``MAP<STRING,STRING>``; a number
inside such a map keeps its JSON text (``6550`` -> ``"6550"``) and is cast on
use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STR_MAP = T.MapType(T.StringType(), T.StringType())

# Typed rows of the order, order detail and payment topics.
ORDER_INFO_SCHEMA = ("id bigint, province_id bigint, order_status string, user_id bigint, total_amount decimal(16,2), "
                     "activity_reduce_amount decimal(16,2), coupon_reduce_amount decimal(16,2), "
                     "original_total_amount decimal(16,2), feight_fee decimal(16,2), expire_time string, "
                     "create_time string, operate_time string")
ORDER_DETAIL_SCHEMA = ("id bigint, order_id bigint, sku_id bigint, order_price decimal(16,2), sku_num bigint, "
                       "sku_name string, create_time string, split_total_amount decimal(16,2), "
                       "split_activity_amount decimal(16,2), split_coupon_amount decimal(16,2)")
PAYMENT_INFO_SCHEMA = ("id bigint, order_id bigint, user_id bigint, total_amount decimal(16,2), subject string, "
                       "payment_type string, create_time string, callback_time string")

# Parsed shape of one app log line (common / page / start / displays / ts).
LOG_SCHEMA = T.StructType([
    T.StructField("common", STR_MAP),
    T.StructField("page", STR_MAP),
    T.StructField("start", STR_MAP),
    T.StructField("displays", T.ArrayType(STR_MAP)),
    T.StructField("ts", T.LongType()),
])


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed value: key of the object that marks the end of a wrapped line.
END_MARK = "#end#"


def wrapped_line(text) -> Column:
    """``array<map<string,string>>`` of the line and an end mark between brackets.

    A second object, a tail or a broken end change the size of the array, or
    break it, and so does an array or a scalar in place of the object: see
    ``wrapped_object``."""
    return F.from_json(F.concat(F.lit("["), _c(text), F.lit(f',{{"{END_MARK}":1}}]')), T.ArrayType(STR_MAP))


def wrapped_object(array: Column) -> Column:
    """The line's object as a map of JSON texts, or NULL unless the line is one
    JSON object and nothing else (P2, the only rule for it)."""
    whole = (F.size(array) == 2) & F.map_contains_key(F.get(array, F.lit(1)), F.lit(END_MARK))
    return F.when(whole, F.get(array, F.lit(0)))


def is_json_object(text) -> Column:
    """True when ``text`` is one JSON object and nothing else; NULL is not."""
    return wrapped_object(wrapped_line(text)).isNotNull()


def parse_strict(text, schema) -> Column:
    """JSON text -> typed struct; a bad text fails the job."""
    return F.from_json(_c(text), schema, {"mode": "FAILFAST"})


def parse_row(text, schema) -> Column:
    """JSON text -> typed struct (P3); fields that do not fit are NULL."""
    return F.from_json(_c(text), schema)


def typed_field(raw: Column, kind: T.DataType) -> Column:
    """One field of a parsed object from its JSON text: nested kinds are parsed,
    others cast; a value of another kind is NULL and spoils no other field."""
    nested = isinstance(kind, (T.MapType, T.ArrayType, T.StructType))
    return F.from_json(raw, kind) if nested else raw.try_cast(kind)


def set_field(m, key: str, value: Column) -> Column:
    """``put(key, value)`` on a string map."""
    return F.map_concat(F.map_filter(_c(m), lambda k, v: k != F.lit(key)),
                        F.create_map(F.lit(key), value.cast("string")))


def keep_fields(m, csv_columns) -> Column:
    """Remove keys not listed in a comma-separated column list.

    ``csv_columns`` may be a literal or a column (config-driven); split on
    ``,`` without trimming, as the reference does.
    """
    cols = F.split(csv_columns if isinstance(csv_columns, Column) else F.lit(csv_columns), ",")
    return F.map_filter(_c(m), lambda k, v: F.array_contains(cols, k))


def map_as_text(m) -> Column:
    """Order-independent text form of a string map: sorted ``k=v`` joined by ``,``.

    Maps keep insertion order; this gives one stable text for comparisons.
    """
    return F.array_join(F.array_sort(F.transform(F.map_entries(_c(m)),
                                                 lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))), ",")


def to_json_row(*cols) -> Column:
    """Row -> JSON text (P28); nulls are left out, as in the reference."""
    return F.to_json(F.struct(*cols))


def envelope(data: Column, status: int = 0, msg: str = "") -> Column:
    """``{"status":0,"msg":"","data":...}`` response text."""
    return F.to_json(F.struct(F.lit(status).alias("status"), F.lit(msg).alias("msg"), data.alias("data")))
