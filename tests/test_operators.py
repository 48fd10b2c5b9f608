"""Exact answers on small inputs (FIXTURES.md section 2)."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from cartwheel.functions import jsonfmt, timefmt
from cartwheel.functions.names import rename_columns_camel, snake_to_camel
from cartwheel.operators import cdc, keywords, logsplit, routing, stats, visits, wide
from cartwheel.operators.joins import interval_join, lookup
from cartwheel.sinks.writers import positional, upsert_dim

from fixtures import BOUNCE_ANSWER, BOUNCE_FLUSH, BOUNCE_ROWS, page_df


def test_dirty_split(spark):
    lines = ['{"a":1}', 'bad{', '', '[1]', '"x"', 'null', '{"a":1} tail', None]
    df = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    assert sorted(r.seq for r in logsplit.parse_lines(df).collect()) == [0]
    assert sorted(r.seq for r in logsplit.dirty_lines(df).collect()) == [1, 2, 3, 4, 5, 6, 7]
    v = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [r.ok for r in v.select(jsonfmt.is_json_object("value").alias("ok")).collect()] == \
        [True] + [False] * 7


def test_dirty_split_of_mistyped_and_doubled_lines(spark):
    good = ['{"common":{"mid":"1"},"ts":"1600000000000"}', '{"common":{"mid":"1"},"displays":{},"ts":5}', '{"page":"x","ts":{}}', ' {"a":[1]} ']
    bad = ['{"a":1}{"b":2}', '{"a":1} junk }', '{"a":1},{"b":2}', '{"a":1}, ', '{"a":1', '[{"a":1}]', '1', 'true', '{"a":1}]', '{"a":1}]}', '{"a":1}}', '],[']
    df = spark.createDataFrame(list(enumerate(good + bad)), "seq long, value string")
    rows = {r.seq: r for r in logsplit.parse_lines(df).collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert rows[0].ts == 1600000000000 and rows[0].common == {"mid": "1"}
    assert rows[1].ts == 5 and rows[1].displays is None and rows[1].common == {"mid": "1"}
    assert rows[2].page is None and rows[2].ts is None
    assert sorted(r.value for r in logsplit.dirty_lines(df).collect()) == sorted(bad)


def test_parse_strict_and_typed_rows(spark):
    import pytest
    from cartwheel.streaming.jobs import snapshot_then_changes, typed_rows
    lines = spark.createDataFrame([('{"id":7,"order_id":1,"total_amount":"9.50","create_time":"2024-01-01 00:00:00"}',)], "value string")
    r = typed_rows(lines, jsonfmt.PAYMENT_INFO_SCHEMA, strict=True).first()
    assert (r.id, r.order_id, r.total_amount, r.subject) == (7, 1, Decimal("9.50"), None)
    for schema in (jsonfmt.ORDER_INFO_SCHEMA, jsonfmt.ORDER_DETAIL_SCHEMA):
        assert typed_rows(lines, schema).first().id == 7
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        typed_rows(spark.createDataFrame([("{broken",)], "value string"), jsonfmt.PAYMENT_INFO_SCHEMA, strict=True).collect()
    snap = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    ch = spark.createDataFrame([("db", "t", {}, {"id": "1", "v": "z"}, "update", 1, 0)],
                               "database string, tableName string, before map<string,string>, after map<string,string>, type string, key long, version int")
    state = cdc.typed_after(cdc.current_state(snapshot_then_changes(snap, ch, "db", "t", "id")), {"id": "int", "v": "string"})
    assert sorted(tuple(r) for r in state.collect()) == [(1, "z"), (2, "b")]


def test_rows_without_a_device(spark):
    rows = [("m", 0, None, "1"), ("m", 5, None, "1"), (None, 1, None, "1"), (None, 2, None, "1")]
    df = page_df(spark, rows)
    fixed = logsplit.repair_new_visitor(df, "mid", "is_new", "ts", "seq")
    assert sorted((r.mid or "", r.ts, r.is_new) for r in fixed.collect()) == [("", 1, "1"), ("", 2, "1"), ("m", 0, "1"), ("m", 5, "0")]
    flags = {(r.mid, r.ts): (r.is_new, r.uv, r.uj) for r in visits.visit_flags(df, 10_000).collect()}
    assert flags == {("m", 0): ("1", True, True), ("m", 5): ("0", False, True), (None, 1): ("1", False, False), (None, 2): ("1", False, False)}
    assert {r.mid for r in visits.unique_visit(df).collect()} == {"m"}


def test_repair_of_lines(spark):
    """Lines are repaired as their parsed rows are, however the flag is written."""
    flags = ['"is_new":"1"', '"is_new" : 1', "'is_new':'1'", '"is\\u005fnew":"1"', '"is_new":"\\u0031"', '"is_new":"0"', '"is_new":10', '"x":"is_new 1"']
    lines = [(k, f'{{"common":{{"mid":"{k % 2}",{f}}},"page":{{"page_id":"is_new"}},"ts":{100 - k}}}') for k, f in enumerate(flags * 2)]
    lines += [(98, "broken is_new 1"), (99, None)]
    raw = spark.createDataFrame(lines, "seq long, value string")
    got = logsplit.repaired_lines(raw)
    want = logsplit.repair_parsed(logsplit.parse_lines(raw))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(r.seq for r in got.collect() if r.common.get("is_new") == "1") == [11, 12]


def test_visit_flags_equal_the_single_operators(spark):
    import random
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(3 * 86_400_000), rng.choice([None, "", "x"]), rng.choice("01")) for _ in range(300)]
    df = page_df(spark, rows)
    flags = visits.visit_flags(df, 3_600_000).cache()
    repaired = logsplit.repair_new_visitor(df, "mid", "is_new", "ts", "seq")
    assert {(r.seq, r.is_new) for r in flags.collect()} == {(r.seq, r.is_new) for r in repaired.collect()}
    assert {r.seq for r in flags.filter("uv").collect()} == {r.seq for r in visits.unique_visit(df).collect()}
    assert {r.seq for r in flags.filter("uj").collect()} == {r.seq for r in visits.user_jump(df, 3_600_000).collect()}
    union = stats.visitor_union(flags)
    three = stats.visitor_rows(repaired, visits.unique_visit(repaired), visits.user_jump(repaired, 3_600_000).drop("kind"))
    assert sorted(map(tuple, union.select(*three.columns).collect())) == sorted(map(tuple, three.collect()))


def test_payment_time_falls_back_to_the_record(spark):
    oi, od = _order_rows(spark)
    ow = wide.order_interval_join(oi, od, -5000, 5000)
    at = 1_704_074_700_000  # 2024-01-01 10:05:00 +08:00
    pay = spark.createDataFrame([(7, 1, 9, Decimal("90.00"), "s", "1101", "not a time", None, at)],
                                "id long, order_id long, user_id long, total_amount decimal(16,2), subject string, "
                                "payment_type string, create_time string, callback_time string, record_ts long")
    assert wide.payment_interval_join(pay, ow, 15 * 60_000, 5000, record_ts="record_ts").count() == 2
    assert wide.payment_interval_join(pay.drop("record_ts"), ow, 15 * 60_000, 5000).count() == 0


def test_missing_dimension_rows(spark):
    """A brand above 20 is missing from this trademark dimension: a left lookup keeps the row, an inner one drops it."""
    from cartwheel.sources import driver
    part = spark.createDataFrame([(1, "p", "Brand#7", "T", 3, 1.5), (2, "q", "Brand#25", "T", 4, 1.5)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    tm = driver.dim_base_trademark(part).filter("cast(ID as int) <= 20")
    facts = driver.dim_sku_info(part).select(F.col("TM_ID").cast("bigint").alias("tm_id"))
    assert sorted(r.n or "" for r in lookup(facts, tm, "tm_id", {"n": "TM_NAME"}).collect()) == ["", "Brand#7"]
    assert lookup(facts, tm, "tm_id", {"n": "TM_NAME"}, how="inner").count() == 1


def test_codes(spark):
    from cartwheel.functions.codes import CODES, decode
    df = spark.createDataFrame([(c,) for c in [*CODES, "9999", None]], "c string")
    assert [r.n for r in df.select(decode(F.col("c")).alias("n")).collect()] == [*CODES.values(), None, None]


def test_writers_replay_without_duplicates(spark, tmp):
    from cartwheel.sinks import writers
    df = spark.createDataFrame([("a", "x", "2024-01-01"), ("b", "y", "2024-01-02")], "sinkTable string, value string, day string")
    for _ in range(2):  # the same batch twice
        writers.write_topic_folder(df, f"{tmp}/t", 3)
        writers.write_dead_letters(df, f"{tmp}/d", F.col("day"), 3)
        writers.write_daily_text(df, f"{tmp}/l", F.col("day"), 3)
    assert [spark.read.json(f"{tmp}/{k}").count() for k in "td"] == [2, 2]
    assert sorted(r.value for r in spark.read.text(f"{tmp}/l/batch_id=3/dt=2024-01-01").collect()) == ["x"]
    writers.ensure_dim_table(spark, f"{tmp}/dim", "id,name", None, " SALT = 3")
    writers.ensure_dim_table(spark, f"{tmp}/dim", "id,name", None, "other")
    one = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 1)], "id string, name string, v int")
    for batch, rows in ((0, one), (1, one.filter("id = 2").withColumn("name", F.lit("z"))), (1, one.filter("id = 2").withColumn("name", F.lit("w")))):
        writers.upsert_dim_table(spark, f"{tmp}/dim", rows, batch, "v")
    dim = writers.read_dim(spark, f"{tmp}/dim")
    assert sorted(map(tuple, dim.collect())) == [("1", "b"), ("2", "w")]
    assert writers.dim_properties(dim) == ("id", " SALT = 3")
    assert sorted(map(tuple, writers.read_dim(spark, f"{tmp}/dim", before=2).collect())) == [("1", "b"), ("2", "c")]


def test_new_visitor_repair(spark):
    rows = [("m", i * 10, "p", f) for i, f in enumerate("01101")]
    out = logsplit.repair_new_visitor(page_df(spark, rows), "mid", "is_new", "ts", "seq")
    assert [r.is_new for r in out.orderBy("ts").collect()] == list("01000")


def test_log_split_outputs(spark):
    lines = ['{"common":{"mid":"1","is_new":"1"},"start":{"entry":"icon"},"ts":1}',
             '{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"home"},"displays":[{"item":"7","item_type":"sku_id"},{"item":"8","item_type":"activity_id"}],"ts":2}',
             '{"common":{"mid":"1","is_new":"0"},"displays":[{"item":"9","item_type":"sku_id"}],"ts":3}']
    raw = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    parsed = logsplit.repair_parsed(logsplit.parse_lines(raw))
    assert logsplit.start_log(parsed).count() == 1
    page = logsplit.flatten_page(parsed).orderBy("ts").collect()
    assert [r.is_new for r in page] == ["0", "0"]  # start line kept the first '1'
    d = logsplit.display_log(parsed).orderBy("ts", F.col("display")["item"]).collect()
    assert [(r.display["item"], r.page_id, r.ts) for r in d] == [("7", "home", 2), ("8", "home", 2), ("9", None, 3)]
    d2 = logsplit.display_log(parsed, with_ts=False)
    assert "ts" not in d2.columns


def test_unique_visit(spark):
    day = 86_400_000
    rows = [("m", 0, None), ("m", 1000, None), ("m", 2000, "x"), ("m", day + 5, ""), ("m", 3000, None)]
    # arrival order = list order; the last row is a late day-1 entry
    df = page_df(spark, rows)
    assert sorted(r.ts for r in visits.unique_visit(df).collect()) == [0, day + 5]
    assert sorted(r.ts for r in visits.unique_visit_strict(df, bucket_rows=2).collect()) == [0, 3000, day + 5]


def test_user_jump_batch(spark):
    df = page_df(spark, BOUNCE_ROWS + BOUNCE_FLUSH)
    got = {(r.mid, r.ts, r.kind) for r in visits.user_jump(df, 10_000).collect() if r.mid != "z"}
    assert got == BOUNCE_ANSWER


def test_user_jump_bucket_edges(spark):
    # rows straddling bucket borders must still see their next row
    rows = [("e", 9_999, None), ("e", 10_001, None), ("f", 19_999, None), ("f", 29_998, "x")]
    got = {(r.mid, r.ts, r.kind) for r in visits.user_jump(page_df(spark, rows), 10_000).collect()}
    assert got == {("e", 9_999, "match"), ("e", 10_001, "timeout")}


def test_interval_join_bounds(spark):
    o = spark.createDataFrame([(1, 100_000)], "oid long, ots long")
    d = spark.createDataFrame([(1, 100_000 + k * 1000) for k in (-6, -5, 0, 5, 6)], "order_id long, dts long")
    got = sorted(r.dts - 100_000 for r in interval_join(o, d, "oid", "order_id", "ots", "dts", -5000, 5000).collect())
    assert got == [-5000, 0, 5000]
    p = spark.createDataFrame([(1, 10_000_000)], "pid long, pts long")
    w = spark.createDataFrame([(1, 10_000_000 + k) for k in (-900_000, -901_000, 5000, 6000)], "order_id long, wts long")
    got = sorted(r.wts - 10_000_000 for r in interval_join(p, w, "pid", "order_id", "pts", "wts", -900_000, 5000).collect())
    assert got == [-900_000, 5000]


def _order_rows(spark):
    oi = spark.createDataFrame([(1, 3, "1001", 9, Decimal("100.00"), "2024-01-01 10:00:00")],
                               "id long, province_id long, order_status string, user_id long, "
                               "total_amount decimal(16,2), create_time string")
    for c in ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee"):
        oi = oi.withColumn(c, F.lit(0).cast("decimal(16,2)"))
    oi = oi.withColumn("expire_time", F.lit(None).cast("string")).withColumn("operate_time", F.lit(None).cast("string"))
    od = spark.createDataFrame([(11, 1, 5, 2, "2024-01-01 10:00:03", Decimal("0.40")),
                                (12, 1, 5, 1, "2024-01-01 10:00:04", Decimal("0.40"))],
                               "id long, order_id long, sku_id long, sku_num long, create_time string, "
                               "split_total_amount decimal(16,2)")
    od = (od.withColumn("order_price", F.col("split_total_amount")).withColumn("sku_name", F.lit("n"))
            .withColumn("split_activity_amount", F.lit(0).cast("decimal(16,2)"))
            .withColumn("split_coupon_amount", F.lit(0).cast("decimal(16,2)")))
    return oi, od


def test_order_wide_payment_precedence(spark):
    oi, od = _order_rows(spark)
    ow = wide.order_interval_join(oi, od, -5000, 5000)
    assert ow.count() == 2
    row = ow.orderBy("detail_id").first()
    assert (row.create_date, row.create_hour) == ("2024-01-01", "10")
    pay = spark.createDataFrame([(7, 1, 9, Decimal("90.00"), "s", "1101", "2024-01-01 10:05:00", None)],
                                "id long, order_id long, user_id long, total_amount decimal(16,2), subject string, "
                                "payment_type string, create_time string, callback_time string")
    pw = wide.payment_interval_join(pay, ow, 15 * 60_000, 5000).orderBy("detail_id").first()
    assert pw.total_amount == Decimal("90.00")
    assert (pw.payment_create_time, pw.order_create_time) == ("2024-01-01 10:05:00", "2024-01-01 10:00:00")


def test_province_keeps_cents(spark):
    oi, od = _order_rows(spark)
    ow = wide.order_interval_join(oi, od, -5000, 5000)
    dim = spark.createDataFrame([("3", "n", "a", "i", "x")], "ID string, NAME string, AREA_CODE string, ISO_CODE string, ISO_3166_2 string")
    r = stats.province_stats(ow, dim, "10 seconds").first()
    assert r.province_name == "n" and r.order_amount == Decimal("0.80") and r.order_count == 1


def test_product_stats_one_order(spark):
    oi, od = _order_rows(spark)
    ow = wide.order_interval_join(oi, od, -5000, 5000)
    r = stats.product_aggregate(stats.product_orders(ow), "10 seconds").first()
    assert (r.order_sku_num, r.order_ct, r.order_amount) == (3, 1, Decimal("0.80"))


def test_lookup_left_inner_and_age(spark):
    facts = spark.createDataFrame([(1, 10), (2, 99)], "fid long, user_id long")
    dim = spark.createDataFrame([("10", "F", "2023-01-01")], "ID string, GENDER string, BIRTHDAY string")
    left = lookup(facts, dim, "user_id", {"g": "GENDER"}).orderBy("fid").collect()
    assert [r.g for r in left] == ["F", None]
    assert lookup(facts, dim, "user_id", {"g": "GENDER"}, how="inner").count() == 1
    as_of = timefmt.text_to_ms(F.lit("2024-01-01 00:00:00"), "UTC")  # 365 days after 2023-01-01
    ow = facts.withColumn("user_gender", F.lit(None).cast("string")).withColumn("user_age", F.lit(None).cast("int"))
    r = wide.lookup_user(ow, dim, as_of).orderBy("fid").first()
    assert r.user_age == 1
    as_of2 = timefmt.text_to_ms(F.lit("2023-12-31 00:00:00"), "UTC")
    assert wide.lookup_user(ow, dim, as_of2).orderBy("fid").first().user_age == 0


def test_routing(spark):
    cfg = spark.createDataFrame([
        ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id", "id", None),
        ("base_trademark", "update", "hbase", "dim_base_trademark", "id,tm_name", "id", None)],
        ", ".join(f"{c} string" for c in routing.CONFIG_COLUMNS))
    ch = spark.createDataFrame([
        ("order_info", "insert", {"id": "1", "user_id": "2", "x": "3"}, 0),
        ("order_info", "update", {"id": "1", "user_id": "2"}, 1),
        ("base_trademark", "update", {"id": "5", "tm_name": "t", "logo": "l"}, 2),
        ("order_info", "delete", {}, 3),
        ("order_info", None, {"id": "1"}, 4)], "tableName string, type string, after map<string,string>, n int")
    fact = routing.route_fact(ch, cfg).collect()
    assert [(r.n, r.sinkTable, dict(r.after)) for r in fact] == [(0, "dwd_order_info", {"id": "1", "user_id": "2"})]
    dim = routing.route_dim(ch, cfg).collect()
    assert [(r.n, dict(r.after)) for r in dim] == [(2, {"id": "5", "tm_name": "t"})]
    assert sorted(r.n for r in routing.unmatched(ch, cfg).collect()) == [1, 4]
    schema, pk = routing.dim_schema("id,tm_name", None)
    assert pk == "id" and [f.name for f in schema] == ["id", "tm_name"]
    rows = routing.dim_schema_rows(cfg).collect()
    assert {(r.sinkTable, r.column, r.is_pk) for r in rows} == {("dim_base_trademark", "id", True),
                                                              ("dim_base_trademark", "tm_name", False)}


def test_cdc_normalize_and_state(spark):
    raw = spark.createDataFrame([
        ("srv.db.t", "c", None, {"id": "1", "v": "a"}, 0),
        ("srv.db.t", "u", {"id": "1", "v": "a"}, {"id": "1", "v": "b"}, 1),
        ("srv.db.t", "c", None, {"id": "2", "v": "x"}, 0),
        ("srv.db.t", "d", {"id": "2", "v": "x"}, None, 1),
        ("srv.db.t", "r", None, {"id": "3", "v": "r"}, 0)],
        "topic string, op string, before map<string,string>, after map<string,string>, version int")
    n = cdc.normalize_changes(raw, keep=("version",))
    rows = n.collect()
    assert [r.type for r in rows] == ["insert", "update", "insert", "delete", "read"]
    assert rows[0].database == "db" and rows[0].tableName == "t" and rows[0].before == {}
    assert cdc.drop_deletes(n).count() == 4
    cur = cdc.typed_after(cdc.current_state(n, "id", "version"), {"id": "int", "v": "string"})
    assert sorted((r.id, r.v) for r in cur.collect()) == [(1, "b"), (3, "r")]


def test_dim_upsert(spark):
    old = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, name string, other string")
    ch = spark.createDataFrame([("2", "B", 1), ("2", "C", 2), ("3", None, 1)], "id string, name string, v int")
    got = sorted(tuple(r) for r in upsert_dim(old, ch, "id", "v").collect())
    assert got == [("1", "a", "x"), ("2", "C", "y"), ("3", None, None)]


def test_keywords(spark):
    df = spark.createDataFrame([("Flink and SPARK, spark 3.5", 1), ("", 2), ("实时数仓", 3)], "full_word string, rt int")
    words = [r.word for r in keywords.keyword_explode(df).collect()]
    assert words == ["flink", "and", "spark", "spark", "3", "5", "实时数仓"]
    many = spark.createDataFrame([("Éçan où, naïve Ünß 日本 x1", 1)], "full_word string, rt int")
    assert [r.word for r in keywords.keyword_explode(many).collect()] == ["éçan", "où", "naïve", "ünß", "日本", "x1"]
    cjk = [r.word for r in keywords.keyword_explode(df.filter("rt = 3"), cjk=True).collect()]
    assert cjk == ["实时", "时数", "数仓"]
    dic = spark.createDataFrame([("spark",), ("and",)], "word string")
    got = sorted((r.pos, r.word) for r in keywords.dictionary_words(
        df.select(F.lower("full_word").alias("full_word"), "rt"), dic).collect())
    assert got == [(7, "and"), (11, "spark"), (18, "spark")]
    long = spark.createDataFrame([("extraordinarily",)], "word string")
    found = keywords.dictionary_words(spark.createDataFrame([("an extraordinarily long word", 1)], "full_word string, rt int"), long)
    assert [r.pos for r in found.collect()] == [4]  # words longer than six characters are found


def test_orders_and_payments_in_one_pass(spark):
    """The same rows as of the two feeds, with none, one or several payments, in and out of the interval."""
    ow = spark.createDataFrame([(o, 10 * o + k, 2, Decimal("1.25"), f"2024-01-01 10:{o:02d}:00") for o in range(6) for k in range(2)] + [(7, 1, 1, Decimal("3"), None)],
                               "order_id long, sku_id long, sku_num long, split_total_amount decimal(16,2), create_time string")
    pay = spark.createDataFrame([(1, 0, "2024-01-01 10:00:30"), (2, 1, "2024-01-01 10:01:10"), (3, 1, "2024-01-01 10:03:00"), (4, 2, "2024-01-01 12:00:00"),
                                 (5, 3, "2024-01-01 10:02:55"), (6, 4, None), (7, 5, "bad"), (8, 99, "2024-01-01 10:00:30"), (9, 7, "2024-01-01 10:00:30")],
                                "id long, order_id long, create_time string")
    for c in ("user_id", "total_amount", "subject", "payment_type", "callback_time"):
        pay = pay.withColumn(c, F.lit(None).cast("string"))
    joined = wide.payment_interval_join(pay, ow, 15 * 60_000, 5_000)
    want = stats.product_union(stats.product_orders(ow), stats.product_payments(joined))
    got = stats.product_orders_and_payments(ow, pay, 15 * 60_000, 5_000)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 13 + 2 + 4 + 2


def test_dictionary_levels_and_longest_words(spark, monkeypatch):
    monkeypatch.setattr(keywords, "CHUNK", 7)  # words lie across the pieces of a text
    words = ["实时", "实时数仓", "数仓", "ab", "abc", "bcd", "abcdefghijkl", "kl", "zz"]
    texts = [(1, "Flink实时数仓"), (2, "abcdefghijklabcd ab"), (3, ""), (4, None), (5, "xabcdefghijk"), (2 ** 40, "实" * 30 + "时数仓")]
    dic = spark.createDataFrame([(w,) for w in [*words, "ab", ""]], "word string")
    df = spark.createDataFrame(texts, "rt long, full_word string")
    want = sorted((k, p + 1, w) for k, t in texts if t for p in range(len(t)) for w in words if t.startswith(w, p))
    assert sorted((r.rt, r.pos, r.word) for r in keywords.dictionary_words(df, dic).collect()) == want
    inside = lambda a, b: a[0] == b[0] and a != b and b[1] <= a[1] and a[1] + len(a[2]) <= b[1] + len(b[2])
    best = [a for a in want if not any(inside(a, b) for b in want)]
    assert sorted((r.rt, r.pos, r.word) for r in keywords.dictionary_words(df, dic, longest=True).collect()) == best
    none = spark.createDataFrame([], "word string")
    assert keywords.dictionary_words(df, none).count() == keywords.dictionary_words(df.limit(0), dic).count() == 0


def test_dictionary_candidates_follow_the_prefixes(spark):
    """Positions whose prefix no word has are dropped before anything is shuffled."""
    text = "x" * 20_000 + "needle" + "y" * 20_000 + "nothing"
    df = spark.createDataFrame([(1, text)], "rt long, full_word string")
    dic = spark.createDataFrame([("needle",), ("needles",), ("nail",)], "word string")
    found = keywords.dictionary_words(df, dic)
    assert [(r.pos, r.word) for r in found.collect()] == [(20_001, "needle")]
    plan = found._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    stems = next(k for k, x in enumerate(plan) if "Join" in x and "_stem" in x)
    chars = next(k for k, x in enumerate(plan) if "BroadcastHashJoin" in x and "LeftSemi" in x and "first" in x)
    assert chars > stems and depth(plan[chars]) > depth(plan[stems])


def test_only_positions_of_words_become_rows(spark, monkeypatch):
    """Other positions are left out before they are rows, and no word is missed, whatever its characters."""
    rng = random.Random(7)
    letters = "ab\0é数𝒳 "
    words = sorted({"".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(60)})
    texts = ["".join(rng.choices(letters, k=n)) for n in (0, 1, 2, 30, 63, 400)] + [None]
    for chunk in (5, 1000):
        monkeypatch.setattr(keywords, "CHUNK", chunk)
        df = spark.createDataFrame(list(enumerate(texts)), "rt int, full_word string")
        found = keywords.dictionary_words(df, spark.createDataFrame([(w,) for w in words], "word string"))
        want = sorted((d, i + 1, w) for d, t in enumerate(texts) for w in words for i in range(len(t or "")) if (t or "").startswith(w, i))
        assert sorted((r.rt, r.pos, r.word) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "transform(sequence(1," not in plan
    text = "x" * 5_000 + "needle"
    marked = keywords.word_slots(spark.createDataFrame([("needle",), ("nail",)], "word string"), 4)
    piece, at = keywords.likely_words([text, "nai", "l nail"], 6_000, 4, 6, marked)
    assert {(0, 5_000), (2, 2)} <= set(zip(piece.tolist(), at.tolist())) and len(at) < 50


def test_longest_words_are_shuffled_once(spark):
    """The words of a text meet in one shuffle; of words of one place in texts alike in ``keep`` the greatest stays."""
    df = spark.createDataFrame([("abcd", 1), ("abce", 1), ("abce", 1), ("xbcd", None)], "full_word string, rt int")
    dic = spark.createDataFrame([("ab",), ("abcd",), ("abce",), ("bcd",)], "word string")
    found = keywords.dictionary_words(df, dic, longest=True)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(rt") == 1
    assert sorted((r.rt or 0, r.pos, r.word) for r in found.collect()) == [(0, 2, "bcd"), (1, 1, "abce")]


def test_udtf_lateral(spark):
    keywords.register_split_udtf(spark, "SplitWords")
    spark.createDataFrame([("a b", 1)], "t string, k int").createOrReplaceTempView("kw_src")
    got = spark.sql("SELECT k, word FROM kw_src, LATERAL SplitWords(t)").collect()
    assert sorted(r.word for r in got) == ["a", "b"]


def test_gmv_and_envelope(spark):
    st = spark.createDataFrame([("2024-01-02 00:00:00", Decimal("1.50")), ("2024-01-02 10:00:00", Decimal("2.00"))],
                               "stt string, order_amount decimal(18,2)")
    assert stats.gmv(st, 20240102).first().gmv == Decimal("3.50")
    assert stats.gmv(st, 20240103).first().gmv is None
    assert [(r.day, r.gmv) for r in stats.gmv_by_day(st).collect()] == [(20240102, Decimal("3.50"))]
    lo, hi = stats.day_range(20240229)
    assert (lo, hi) == ("2024-02-29", "2024-03-01")
    import datetime
    today = datetime.datetime.now(datetime.timezone.utc).date()
    assert stats.day_range(0)[0] in (today.isoformat(), (today - datetime.timedelta(days=1)).isoformat())
    env = st.limit(1).select(jsonfmt.envelope(F.lit(Decimal("3.50"))).alias("j")).first().j
    assert env == '{"status":0,"msg":"","data":3.50}'


def test_time_helpers(spark):
    r = spark.range(1).select(
        timefmt.text_to_ms(F.lit("1970-01-01 08:00:00")).alias("a"),
        timefmt.ms_to_text(F.lit(0), "+08:00").alias("b"),
        timefmt.text_to_ms_or(F.lit("bad"), F.lit(7)).alias("c"),
        timefmt.day_int(F.lit("2024-03-05 01:02:03").cast("timestamp_ntz")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (0, "1970-01-01 08:00:00", 7, 20240305)


def test_names_and_helpers(spark):
    assert snake_to_camel("split_total_amount") == "splitTotalAmount"
    df = spark.createDataFrame([(1, "a_b_c")], "user_id int, s string")
    assert rename_columns_camel(df).columns == ["userId", "s"]
    from cartwheel.functions.names import snake_to_camel_col
    assert df.select(snake_to_camel_col("s").alias("x")).first().x == "aBC"
    assert positional(df.withColumn("t", F.lit(1)), ["s", "user_id"], transient=["t"]).columns == ["s", "user_id"]
    m = df.select(jsonfmt.keep_fields(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), "a").alias("m"))
    assert m.first().m == {"a": "1"}


def test_visitor_stats_rows(spark):
    page = page_df(spark, [("m", 0, None), ("m", 1000, "x")])
    uv = visits.unique_visit(page)
    uj = visits.user_jump(page, 10_000).drop("kind")
    out = stats.visitor_stats(stats.visitor_rows(page, uv, uj), "10 seconds").first()
    assert (out.uv_ct, out.pv_ct, out.sv_ct, out.uj_ct, out.dur_sum) == (1, 2, 1, 0, 2000)
    assert (out.stt, out.edt) == ("1970-01-01 00:00:00", "1970-01-01 00:00:10")


def test_followed_by_generic(spark):
    df = page_df(spark, [("m", 0, "a"), ("m", 1000, "b"), ("m", 5000, "a"), ("m", 20000, "b")])
    got = {(r.ts, r.kind) for r in visits.followed_by(df, F.col("last_page_id") == "a",
                                                       F.col("last_page_id") == "b", 10_000).collect()}
    assert got == {(0, "match"), (5000, "timeout")}
    assert spark.range(1).select(timefmt.processing_time_ms(42).alias("t")).first().t == 42
