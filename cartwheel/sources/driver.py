"""Map the driver's TPC-H-like tables onto the commerce warehouse model.

The warehouse reads click logs and database rows that the test tables do not
hold, so each input is derived from a test table by a fixed rule (FIXTURES.md
section 3).  Every rule is a projection, filter or join that Spark runs over
the whole table; the DuckDB oracle in ``cartwheel.plans.oracle`` states the
same rules in SQL.  Business intervals are scaled because the test data is
sparse (see ``SCALE``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import TEXT_FORMAT, wallclock_to_ms
from ..functions.jsonfmt import STR_MAP

MONEY = "decimal(16,2)"

# Fixed values of the mapping (shared with the SQL oracle).
DATABASE = "shop"
CDC_TOPIC_PREFIX = "mysql_binlog"
DIRTY_EVERY = 50            # every 50th log line gets a broken tail
DIRTY_TAIL = '{"cut'
BIRTHDAY_BASE = "1960-01-01"
AGE_AS_OF = "2024-01-01 00:00:00"
COMMENT_BASE = "2024-01-01 00:00:00"
KEYWORD_BASE = "2024-01-01 00:00:00"

# Scaled business intervals (reference value -> driver value).
SCALE = {
    "order_detail_ms": 30 * 86_400_000,            # +-5 s
    "payment_lower_ms": 15 * 86_400_000,           # -15 min
    "payment_upper_ms": 5 * 86_400_000,            # +5 s
    "jump_within_ms": 6 * 3_600_000,               # 10 s
    "visitor_window": "1 day",                     # 10 s
    "stats_window": "10 seconds",
}


def _ntz_ms(c) -> Column:
    return wallclock_to_ms(F.col(c) if isinstance(c, str) else c, "UTC")


def page_log(events: DataFrame) -> DataFrame:
    """Flat page log: one row per event (mid, ar, ch, vc, is_new, page fields, ts)."""
    et = F.col("event_type")
    return events.select(
        F.col("user_id").cast("string").alias("mid"),
        (F.col("user_id") % 7).cast("string").alias("ar"),
        (F.col("user_id") % 5).cast("string").alias("ch"),
        (F.col("user_id") % 3).cast("string").alias("vc"),
        F.when(et == "signup", "1").otherwise("0").alias("is_new"),
        et.alias("page_id"),
        F.when(et.isin("signup", "view"), F.lit(None).cast("string"))
         .when(et == "error", "").otherwise(et).alias("last_page_id"),
        F.get_json_object("props", "$.k").alias("item"),
        F.when(et == "error", "keyword").otherwise("sku_id").alias("item_type"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        _ntz_ms("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def raw_log(events: DataFrame) -> DataFrame:
    """App log lines as JSON text, the input of the log split.

    ``signup`` events are start logs; the rest are page logs, and ``view``
    pages carry two displays.  Every ``DIRTY_EVERY``-th line has a second,
    broken object behind it, as two appends that collided leave it.
    """
    p = page_log(events)
    common = F.create_map(*[x for k in ("ar", "ch", "is_new", "mid", "vc") for x in (F.lit(k), F.col(k))])
    page = F.create_map(F.lit("page_id"), F.col("page_id"), F.lit("last_page_id"), F.col("last_page_id"),
                        F.lit("item"), F.col("item"), F.lit("item_type"), F.col("item_type"),
                        F.lit("during_time"), F.col("during_time").cast("string"))
    start = F.create_map(F.lit("entry"), F.lit("icon"), F.lit("loading_time"), F.col("during_time").cast("string"))
    displays = F.array(
        F.create_map(F.lit("item"), F.col("item"), F.lit("item_type"), F.lit("sku_id"), F.lit("order"), F.lit("1")),
        F.create_map(F.lit("item"), F.col("mid"), F.lit("item_type"), F.lit("activity_id"), F.lit("order"), F.lit("2")))
    is_start = F.col("page_id") == "signup"
    line = F.to_json(F.struct(
        common.alias("common"),
        F.when(~is_start, page).alias("page"),
        F.when(is_start, start).alias("start"),
        F.when(F.col("page_id") == "view", displays).alias("displays"),
        F.col("ts").alias("ts")))
    # one element to explode, so that a reader's filters do not write the text once more
    return p.select(F.col("seq"), F.explode(F.array(
        F.when(F.col("seq") % DIRTY_EVERY == 0, F.concat(line, F.lit(DIRTY_TAIL))).otherwise(line))).alias("value"))


def order_info(orders: DataFrame, customer: DataFrame | None) -> DataFrame:
    """order_info rows; province is the customer's nation, NULL without ``customer``,
    for readers that need no province."""
    if customer is None:
        o = orders.withColumn("c_nationkey", F.lit(None).cast("int"))
    else:
        o = orders.join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    total = F.col("o_totalprice").cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"),
        total.alias("original_total_amount"),
        zero.alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        F.date_format("o_orderdate", TEXT_FORMAT).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def order_detail(lineitem: DataFrame) -> DataFrame:
    """order_detail rows (``id`` is not unique: lineitem has no unique key)."""
    amount = F.col("l_extendedprice").cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        amount.alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        F.date_format("l_shipdate", TEXT_FORMAT).alias("create_time"),
        amount.alias("split_total_amount"),
        zero.alias("split_activity_amount"),
        zero.alias("split_coupon_amount"),
    )


def payment_info(orders: DataFrame) -> DataFrame:
    """Payments of finished orders, paid 0..39 days after ordering."""
    f = orders.filter(F.col("o_orderstatus") == "F")
    paid_at = F.timestamp_add("DAY", F.col("o_orderkey") % 40, F.col("o_orderdate"))
    return f.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("subject"),
        (F.lit(1101) + F.col("o_orderkey") % 3).cast("string").alias("payment_type"),
        F.date_format(paid_at, TEXT_FORMAT).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"),
    )


def refund_info(lineitem: DataFrame) -> DataFrame:
    """Refunds: returned lines."""
    return lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
        F.date_format("l_shipdate", TEXT_FORMAT).alias("create_time"),
    )


def _event_action(events: DataFrame, event_type: str) -> DataFrame:
    return events.filter(F.col("event_type") == event_type).select(
        F.get_json_object("props", "$.k").cast("bigint").alias("sku_id"),
        F.date_format("ts", TEXT_FORMAT).alias("create_time"))


def favor_info(events: DataFrame) -> DataFrame:
    return _event_action(events, "view")


def cart_info(events: DataFrame) -> DataFrame:
    return _event_action(events, "click")


def comment_info(labels: DataFrame) -> DataFrame:
    """Comments: one per labelled document; good when quality is 1."""
    return labels.select(
        F.col("doc_id").alias("sku_id"),
        F.when(F.col("quality") == 1, "1201").otherwise("1203").alias("appraise"),
        F.date_format(F.timestamp_add("SECOND", F.col("doc_id"), F.expr(f"TIMESTAMP_NTZ'{COMMENT_BASE}'")),
                      TEXT_FORMAT).alias("create_time"))


# ---------------------------------------------------------------- dimensions
# All dimension columns are strings at rest, as in the reference.

def dim_user_info(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").cast("string").alias("ID"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("GENDER"),
        F.date_format(F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), (F.col("c_custkey") % 15000).cast("int")),
                      "yyyy-MM-dd").alias("BIRTHDAY"))


def dim_base_province(nation: DataFrame, region: DataFrame) -> DataFrame:
    r = region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return nation.join(r, "n_regionkey", "left").select(
        F.col("n_nationkey").cast("string").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.concat(F.lit("A"), F.col("n_regionkey").cast("string")).alias("AREA_CODE"),
        F.concat(F.lit("CN-"), F.col("n_nationkey").cast("string")).alias("ISO_CODE"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_nationkey").cast("string")).alias("ISO_3166_2"))


def _brand_id(c="p_brand") -> Column:
    return F.regexp_extract(F.col(c), r"#(\d+)", 1)


def _category_id(c="p_type") -> Column:
    """A category's id from its name alone: 48 bits of its digest, as a number.
    No order over all names is needed."""
    return F.conv(F.substring(F.md5(F.col(c)), 1, 12), 16, 10)


def dim_base_category3(part: DataFrame) -> DataFrame:
    return part.select(_category_id().alias("ID"), F.col("p_type").alias("NAME")).distinct()


def dim_sku_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("ID"),
        F.col("p_name").alias("SKU_NAME"),
        F.col("p_retailprice").cast(MONEY).cast("string").alias("PRICE"),
        F.col("p_size").cast("string").alias("SPU_ID"),
        _brand_id().alias("TM_ID"),
        _category_id().alias("CATEGORY3_ID"))


def dim_spu_info(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_size").cast("string").alias("ID")).distinct().select(
        "ID", F.concat(F.lit("spu-"), F.col("ID")).alias("SPU_NAME"))


def dim_base_trademark(part: DataFrame) -> DataFrame:
    return part.select(_brand_id().alias("ID"), F.col("p_brand").alias("TM_NAME")).distinct()


# ------------------------------------------------------------ change records

def _order_row_map(status: Column) -> Column:
    return F.create_map(
        F.lit("id"), F.col("o_orderkey").cast("string"),
        F.lit("user_id"), F.col("o_custkey").cast("string"),
        F.lit("order_status"), status,
        F.lit("total_amount"), F.col("o_totalprice").cast(MONEY).cast("string"),
        F.lit("create_time"), F.date_format("o_orderdate", TEXT_FORMAT))


def debezium_changes(orders: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    """Raw change records as a capture connector emits them.

    ``orders``: insert for every row (op ``c``), update when key mod 3 = 0
    (status becomes ``U``), delete when key mod 10 = 0; per-key version 0/1/2.
    ``lineitem`` (optional): snapshot reads (op ``r``) of ``order_detail``,
    for which no routing rule exists.
    """
    topic = F.lit(f"{CDC_TOPIC_PREFIX}.{DATABASE}.order_info")
    base = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    null_map = F.lit(None).cast(STR_MAP)
    k = F.col("o_orderkey")
    first, last = F.col("o_orderstatus"), F.when(k % 3 == 0, F.lit("U")).otherwise(F.col("o_orderstatus"))

    def change(op: str, before: Column, after: Column, version: int) -> Column:
        return F.struct(F.lit(op).alias("op"), before.alias("before"), after.alias("after"), F.lit(version).alias("version"))

    # one scan: the changes of an order are an array of its row
    history = F.array_compact(F.array(
        change("c", null_map, _order_row_map(first), 0),
        F.when(k % 3 == 0, change("u", _order_row_map(first), _order_row_map(F.lit("U")), 1)),
        F.when(k % 10 == 0, change("d", _order_row_map(last), null_map, 2))))
    out = base.select(topic.alias("topic"), k.alias("key"), F.explode(history).alias("c")).select(
        "topic", "c.op", "c.before", "c.after", "key", "c.version")
    if lineitem is not None:
        dt = F.lit(f"{CDC_TOPIC_PREFIX}.{DATABASE}.order_detail")
        det = lineitem.select(
            dt.alias("topic"), F.lit("r").alias("op"), null_map.alias("before"),
            F.create_map(F.lit("order_id"), F.col("l_orderkey").cast("string"),
                         F.lit("sku_id"), F.col("l_partkey").cast("string"),
                         F.lit("sku_num"), F.col("l_quantity").cast("bigint").cast("string")).alias("after"),
            F.col("l_orderkey").alias("key"), F.lit(0).alias("version"))
        out = out.unionByName(det)
    return out


def table_process_config(spark) -> DataFrame:
    """Routing rules (``table_process``): a handful of rows by nature."""
    rows = [
        ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,order_status,total_amount,create_time", "id", None),
        ("order_info", "update", "hbase", "dim_order_status", "id,order_status", "id", None),
        ("base_trademark", "update", "hbase", "dim_base_trademark", "id,tm_name", "id", " SALT_BUCKETS = 3"),
    ]
    return spark.createDataFrame(rows, "sourceTable string, operateType string, sinkType string, sinkTable string, "
                                       "sinkColumns string, sinkPk string, sinkExtend string")


def rule_changes(spark) -> DataFrame:
    """Change records of the routing rules: a handful of rows by nature.  The rule for inserted orders changes its
    topic and columns, is deleted, and comes back; the one for updates is deleted."""
    cols = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk"]
    first = ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id", "id")
    second = ("order_info", "insert", "kafka", "dwd_order_paid", "id,order_status,total_amount", "id")
    update = ("order_info", "update", "hbase", "dim_order_status", "id,order_status", "id")
    rows = [({}, first, "insert", 0), ({}, update, "insert", 0), (first, second, "update", 1_000), (second, {}, "delete", 2_500),
            (update, {}, "delete", 3_000), ({}, first, "insert", 4_000)]
    named = [(dict(zip(cols, b)) if b else {}, dict(zip(cols, a)) if a else {}, kind, at) for b, a, kind, at in rows]
    return spark.createDataFrame(named, "before map<string,string>, after map<string,string>, type string, version long")


def keyword_source(documents: DataFrame) -> DataFrame:
    """Search phrases: each document text, searched at base + doc_id seconds."""
    return documents.select(
        F.col("text").alias("full_word"),
        F.timestamp_add("SECOND", F.col("doc_id"), F.expr(f"TIMESTAMP_NTZ'{KEYWORD_BASE}'")).alias("rt"))
