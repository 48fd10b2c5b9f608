"""Batch = stream: replay rows as several files, one file per trigger."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import keywords, logsplit, routing, stats, visits, wide
from cartwheel.sinks import writers
from cartwheel.streaming import jobs, state
from cartwheel.streaming.state import PAGE_SCHEMA

from fixtures import BOUNCE_ANSWER, BOUNCE_FLUSH, BOUNCE_ROWS, page_df, page_rows


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Tiny streams: two state stores per operator are enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _replay(spark, tmp, rows, n_files, name="in"):
    path = os.path.join(tmp, name)
    pdf = spark.createDataFrame(page_rows(rows), PAGE_SCHEMA).toPandas()
    chunk = -(-len(pdf) // n_files)
    for i in range(n_files):
        part = pdf.iloc[i * chunk:(i + 1) * chunk]
        if len(part):
            spark.createDataFrame(part, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return jobs.parquet_stream(spark, path, PAGE_SCHEMA, max_files_per_trigger=1)


BASE = 1_000_000  # rows at or behind the watermark (0 at start) are dropped


def test_bounce_stream_equals_batch(spark, tmp):
    # replay in event-time order: a row arriving behind the watermark is late
    # and dropped by the stream, as in the reference
    rows = sorted([(m, t + BASE, lp) for m, t, lp in BOUNCE_ROWS + BOUNCE_FLUSH], key=lambda r: r[1])
    s = jobs.with_event_time(_replay(spark, tmp, rows, 4), delay="0 seconds")
    jobs.to_memory(state.user_jump_stream(s, 10_000), "jump_out", os.path.join(tmp, "ck"))
    got = {(r.mid, r.ts - BASE, r.kind) for r in spark.sql("select * from jump_out").collect() if r.mid != "z"}
    assert got == BOUNCE_ANSWER
    batch = {(r.mid, r.ts - BASE, r.kind) for r in visits.user_jump(page_df(spark, rows), 10_000)
             .collect() if r.mid != "z"}
    assert got == batch


def test_repair_stream_equals_batch(spark, tmp):
    rows = [("m", i * 10, "p", f) for i, f in enumerate("01101")] + [("n", 5, "p", "1")]
    s = _replay(spark, tmp, rows, 3)
    jobs.to_memory(state.repair_new_visitor_stream(s), "rep_out", os.path.join(tmp, "ck"))
    got = sorted((r.mid, r.ts, r.is_new) for r in spark.sql("select * from rep_out").collect())
    batch = sorted((r.mid, r.ts, r.is_new) for r in
                   logsplit.repair_new_visitor(page_df(spark, rows), "mid", "is_new", "ts", "seq").collect())
    assert got == batch


def test_unique_visit_stream_equals_batch(spark, tmp):
    day = 86_400_000
    rows = [("m", 0, None), ("m", 1000, None), ("m", 2000, "x"), ("m", day + 5, ""), ("k", 7, "")]
    s = _replay(spark, tmp, rows, 3)
    jobs.to_memory(state.unique_visit_stream(s, ttl_ms=None), "uv_out", os.path.join(tmp, "ck"))
    got = sorted((r.mid, r.ts) for r in spark.sql("select * from uv_out").collect())
    batch = sorted((r.mid, r.ts) for r in visits.unique_visit(page_df(spark, rows)).collect())
    assert got == batch


def test_rows_without_a_device(spark, tmp):
    """They are no visit and no bounce, keep their flag, and do not meet in one state, as in batch."""
    rows = [(None, 1_000_000, None, "1"), ("m", 1_001_000, None, "1"), (None, 1_002_000, None, "1"), ("m", 1_003_000, None, "1"), ("z", 1_090_000, "x"), ("z", 1_200_000, "x")]
    page = page_df(spark, rows)
    key = lambda r: (r.mid or "", r.ts)
    jobs.to_memory(state.unique_visit_stream(_replay(spark, tmp, rows, 3), ttl_ms=None), "nd_uv", os.path.join(tmp, "c1"))
    for batch in (visits.unique_visit(page), visits.unique_visit_strict(page)):
        assert sorted(map(key, spark.table("nd_uv").collect())) == sorted(map(key, batch.collect())) == [("m", 1_001_000)]
    s = jobs.with_event_time(_replay(spark, tmp, rows, 3, "in2"))
    jobs.to_memory(state.user_jump_stream(s, 10_000), "nd_uj", os.path.join(tmp, "c2"))
    got = sorted((*key(r), r.kind) for r in spark.table("nd_uj").collect())
    assert got == sorted((*key(r), r.kind) for r in visits.user_jump(page, 10_000).collect()) and {g[0] for g in got} == {"m"}
    jobs.to_memory(state.repair_new_visitor_stream(_replay(spark, tmp, rows, 3, "in3")), "nd_rep", os.path.join(tmp, "c3"))
    want = logsplit.repair_new_visitor(page, "mid", "is_new", "ts", "seq")
    assert sorted((*key(r), r.is_new) for r in spark.table("nd_rep").collect()) == sorted((*key(r), r.is_new) for r in want.collect())


def _stream(spark, tmp, name, df, n_files=3):
    """``df`` (ordered) replayed as ``n_files`` files, one per trigger."""
    path = os.path.join(tmp, name)
    rows = df.collect()
    chunk = max(1, -(-len(rows) // n_files))
    for i in range(0, len(rows), chunk):
        spark.createDataFrame(rows[i:i + chunk], df.schema).coalesce(1).write.mode("append").parquet(path)
    return jobs.parquet_stream(spark, path, df.schema, max_files_per_trigger=1)


def _ran(tmp, job, *args, name, **kw):
    out = os.path.join(tmp, f"out_{name}")
    q = job(*args, out=out, name=name, trigger={"availableNow": True}, checkpoint=os.path.join(tmp, f"ck_{name}"), **kw)
    q.awaitTermination()
    return out, q


def _tuples(df, *cols):
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


def test_visitor_stats_job_equals_batch(spark, tmp):
    rows = [("m", 1000, None, "1"), ("m", 4000, "x", "1"), ("k", 12000, None), ("k", 13000, None), ("m", 25000, None)]
    flush = [("z", 90_000, "x")]  # closes the earlier windows
    page = page_df(spark, rows)
    uv, uj = visits.unique_visit(page), visits.user_jump(page, 10_000).drop("kind")
    streams = []
    for k, d in (("p", page), ("u", uv), ("j", uj)):  # the rows in a first file, the flush row in a second
        d.orderBy("ts").coalesce(1).write.parquet(f"{tmp}/{k}")
        page_df(spark, flush).coalesce(1).write.mode("append").parquet(f"{tmp}/{k}")
        streams.append(jobs.parquet_stream(spark, f"{tmp}/{k}", page.schema, max_files_per_trigger=1))
    out, _ = _ran(tmp, jobs.visitor_stats_job, *streams, name="vs", delay="2 seconds")
    cols = ["stt", "edt", *stats.VISITOR_KEYS, *stats.VISITOR_MEASURES, "ts"]
    got = [r for r in _tuples(spark.read.parquet(out), *cols) if "00:01:" not in r]
    want = _tuples(stats.visitor_stats(stats.visitor_rows(page, uv, uj), "10 seconds"), *cols)
    assert got == want and len(got) == 3
    assert sum(r.uj_ct for r in spark.read.parquet(out).filter("stt < '1970-01-01 00:01:00'").collect()) == uj.count() > 0


def _shop(spark):
    day = "2024-01-01 10:"
    orders = spark.createDataFrame([(i, i % 3, "1001", i, Decimal("10.00"), f"{day}0{i}:00") for i in range(6)],
                                   "id long, province_id long, order_status string, user_id long, total_amount decimal(16,2), create_time string")
    for c in ("activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee"):
        orders = orders.withColumn(c, F.lit(0).cast("decimal(16,2)"))
    orders = orders.withColumn("expire_time", F.lit(None).cast("string")).withColumn("operate_time", F.lit(None).cast("string"))
    details = spark.createDataFrame([(10 * i + k, i, 5 + k, 2, f"{day}0{i}:0{k + 2}", Decimal("0.40")) for i in range(6) for k in (0, 2, 5)],
                                    "id long, order_id long, sku_id long, sku_num long, create_time string, split_total_amount decimal(16,2)")
    details = (details.withColumn("order_price", F.col("split_total_amount")).withColumn("sku_name", F.lit("n"))
               .withColumn("split_activity_amount", F.lit(0).cast("decimal(16,2)")).withColumn("split_coupon_amount", F.lit(0).cast("decimal(16,2)")))
    pay = spark.createDataFrame([(100 + i, i, i, Decimal("9.00"), "s", "1101", f"{day}0{i}:30" if i else "bad", None, 1_704_074_430_000) for i in range(6)],
                                "id long, order_id long, user_id long, total_amount decimal(16,2), subject string, payment_type string, "
                                "create_time string, callback_time string, record_ts long")
    text = lambda n, cols: spark.createDataFrame([(str(i), *(f"{c}{i}" for c in cols)) for i in range(n)], ", ".join(f"{c} string" for c in ["ID", *cols]))
    sku = spark.createDataFrame([("5", "s5", "1.50", "0", "0", "0")], "ID string, SKU_NAME string, PRICE string, SPU_ID string, TM_ID string, CATEGORY3_ID string")
    dims = {"user": spark.createDataFrame([(str(i), "F", "2000-01-01") for i in range(6)], "ID string, GENDER string, BIRTHDAY string"),
            "province": text(3, ["NAME", "AREA_CODE", "ISO_CODE", "ISO_3166_2"]), "sku": sku, "spu": text(1, ["SPU_NAME"]),
            "trademark": text(1, ["TM_NAME"]), "category3": text(1, ["NAME"])}
    return orders, details, pay, dims


def test_wide_jobs_equal_batch_and_drop_state(spark, tmp):
    orders, details, pay, dims = _shop(spark)
    as_of = F.lit(1_704_074_400_000)
    want = wide.order_wide(orders, details, dims, -5000, 5000, as_of)
    s = [_stream(spark, tmp, k, d.orderBy("create_time"), 3) for k, d in (("o", orders), ("d", details))]
    out, q = _ran(tmp, jobs.order_wide_job, *s, lambda: dims, as_of, name="ow")
    got = spark.read.parquet(out)
    assert _tuples(got, *wide.ORDER_WIDE_COLUMNS) == _tuples(want, *wide.ORDER_WIDE_COLUMNS) and got.count() == 12
    # the state is bounded by the interval: it shrinks when the watermark has passed
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert kept[-1] < 24 and kept[-1] <= max(kept) < orders.count() + details.count()
    ow = got.select(*wide.ORDER_WIDE_COLUMNS).orderBy("create_time")
    s = [_stream(spark, tmp, "pay", pay.orderBy("id"), 3), _stream(spark, tmp, "oww", ow, 3)]
    out, _ = _ran(tmp, jobs.payment_wide_job, *s, name="pw", record_ts="record_ts")
    want = wide.payment_interval_join(pay, ow, 15 * 60_000, 5000, record_ts="record_ts")
    assert _tuples(spark.read.parquet(out), *want.columns) == _tuples(want, *want.columns) and want.count() == 12


def test_interval_join_state_has_a_bound_on_both_sides(spark, tmp):
    orders, details, *_ = _shop(spark)
    s = [_stream(spark, tmp, k, d) for k, d in (("o", orders), ("d", details))]
    q = jobs.order_wide_stream(*s).writeStream.format("noop").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    plan = q._jsq.explainInternal(True) if hasattr(q._jsq, "explainInternal") else q._jsq.streamingQuery().explainInternal(True)
    assert "state cleanup [ left" in plan and "left = null" not in plan and "right = null" not in plan


def test_product_and_province_jobs_equal_batch(spark, tmp):
    orders, details, pay, dims = _shop(spark)
    ow = wide.order_interval_join(orders, details, -5000, 5000)
    flush = ow.limit(1).withColumn("create_time", F.lit("2024-01-02 00:00:00"))
    s = _stream(spark, tmp, "ow", ow.unionByName(flush).orderBy("create_time"))
    out, _ = _ran(tmp, jobs.product_stats_job, [stats.product_orders(s)], lambda: dims, name="ps")
    want = stats.product_dims(stats.product_aggregate(stats.product_orders(ow), "10 seconds"), dims)
    assert _tuples(spark.read.parquet(out), *want.columns) == _tuples(want, *want.columns) and want.count() == 12
    out, _ = _ran(tmp, jobs.province_stats_job, s, lambda: dims, name="prov")
    want = stats.province_stats(ow, dims["province"])
    assert _tuples(spark.read.parquet(out), *want.columns) == _tuples(want, *want.columns)


def test_stream_aggregates_keep_no_sets(spark, tmp):
    """A1, A4, A5: distinct orders by two chained aggregates; late and repeated rows of an order over many batches."""
    orders, details, *_ = _shop(spark)
    ow = wide.order_interval_join(orders, details, -5000, 5000)
    ow = ow.unionByName(ow.withColumn("sku_num", F.col("sku_num") + 1)).unionByName(ow.filter("order_id % 2 = 0"))  # ids come again
    flush = ow.limit(1).withColumn("create_time", F.lit("2024-01-02 00:00:00"))
    s = _stream(spark, tmp, "ow", ow.orderBy("create_time", "sku_id", "sku_num").unionByName(flush), 7)
    out = {}
    for name, df in (("prod", stats.product_aggregate(stats.product_orders(s), "1 hour", streaming=True, watermark="2 seconds")),
                     ("prov", stats.province_windows(s, "1 hour", streaming=True, watermark="2 seconds"))):
        q = df.writeStream.format("memory").queryName(f"nosets_{name}").outputMode("append").option("checkpointLocation", f"{tmp}/ck{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        plan = q._jsq.streamingQuery().explainInternal(True) if hasattr(q._jsq, "streamingQuery") else q._jsq.explainInternal(True)
        assert "collect_set" not in plan and plan.count("StateStoreSave") >= 2
        out[name] = spark.table(f"nosets_{name}")
    want = stats.product_aggregate(stats.product_orders(ow), "1 hour")
    assert _tuples(out["prod"], *want.columns) == _tuples(want, *want.columns) and want.agg(F.max("order_ct")).first()[0] == 6
    want = stats.province_windows(ow, "1 hour")
    assert _tuples(out["prov"], *want.columns) == _tuples(want, *want.columns)


def test_keyword_job_equals_batch(spark, tmp):
    page = spark.createDataFrame([({"item_type": "keyword", "item": "Éclair au café 实时"}, 1000), ({"item_type": "sku_id", "item": "x"}, 2000),
                                  ({"item_type": "keyword", "item": "café"}, 3000), ({"item_type": "keyword", "item": "z"}, 900_000)],
                                 "page map<string,string>, ts long")
    out, _ = _ran(tmp, jobs.keyword_stats_job, _stream(spark, tmp, "kw", page), name="kw")
    got = {(r.keyword, r.ct) for r in spark.read.parquet(out).collect()}
    assert got == {("éclair", 1), ("au", 1), ("café", 2), ("实时", 1)}
    batch = stats.keyword_stats(keywords.keyword_explode(stats.keyword_filter(page.filter("ts < 900000")), cjk=True))
    assert {(r.keyword, r.ct) for r in batch.collect()} == got


def test_visit_jobs_equal_batch(spark, tmp):
    rows = [("m", 1_000_000, None), ("m", 1_003_000, None), ("m", 1_050_000, "x"), ("k", 1_060_000, ""), ("z", 1_200_000, "x"), ("z", 1_400_000, "x")]
    page = page_df(spark, rows)
    s = _stream(spark, tmp, "pages", page, 6)
    out, _ = _ran(tmp, jobs.unique_visit_job, s, name="uvj", ttl_ms=None)
    assert _tuples(spark.read.parquet(out), "mid", "ts") == _tuples(visits.unique_visit(page), "mid", "ts")
    out, _ = _ran(tmp, jobs.user_jump_job, s, name="ujj")
    assert _tuples(spark.read.parquet(out), "mid", "ts", "kind") == _tuples(visits.user_jump(page, 10_000), "mid", "ts", "kind")


def test_routing_job_reads_rules_again(spark, tmp):
    cols = ", ".join(f"{c} string" for c in routing.CONFIG_COLUMNS)
    rule = lambda cols_: ("t", "update", "hbase", "dim_t", cols_, "id", " X")
    versions = [[("o", "insert", "kafka", "facts_o", "id", "id", None), rule("id,name")],
                [("o", "insert", "kafka", "other_o", "id", "id", None), rule("id,name")]]
    calls = []

    def rules():
        calls.append(1)
        return spark.createDataFrame(versions[min(len(calls), 2) - 1], cols)

    ch = spark.createDataFrame([("o", "insert", {"id": "1", "x": "2"}, 0), ("t", "update", {"id": "5", "name": "a"}, 1), ("q", "insert", {"id": "9"}, 0),
                                ("o", "insert", {"id": "2"}, 0), ("t", "update", {"id": "5", "name": "b"}, 2)],
                               "tableName string, type string, after map<string,string>, version int")
    s = _stream(spark, tmp, "ch", ch, 2)
    out, _ = _ran(tmp, jobs.routing_job, s, rules, name="route", dims=f"{tmp}/dims")
    topics = {r.topic for r in spark.read.json(f"{out}/facts").collect()}
    assert topics == {"facts_o", "other_o"} and spark.read.json(f"{out}/unmatched").count() == 1
    assert [tuple(r) for r in writers.read_dim(spark, f"{tmp}/dims/dim_t").collect()] == [("5", "b")]


def test_state_time_to_live(spark, tmp):
    """T5: the state store forgets the day a fixed time after it was written; a restart keeps it until then."""
    import time
    src, n = os.path.join(tmp, "in"), 0

    def run(ttl):
        nonlocal n
        row = page_rows([("m", 1000 + n, None)])
        spark.createDataFrame(row, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        n += 1
        out = os.path.join(tmp, f"out{ttl}")
        q = jobs.unique_visit_job(jobs.parquet_stream(spark, src, PAGE_SCHEMA), out, ttl_ms=ttl, name=f"ttl{ttl}{n}",
                                  trigger={"availableNow": True}, checkpoint=os.path.join(tmp, f"ck{ttl}"))
        assert q.awaitTermination(120)  # such a query ends by itself
        return spark.read.schema(PAGE_SCHEMA).parquet(out).count()

    assert [run(3_600_000), run(3_600_000), run(3_600_000)] == [1, 1, 1]  # each run is a restart
    first = run(3_000)
    time.sleep(3.5)
    assert run(3_000) == first + 1  # the same day counts again


def test_sql_view_console_and_daily_logs(spark, tmp):
    src = os.path.join(tmp, "logs")
    os.makedirs(src)
    with open(os.path.join(src, "app.2024-05-06.log"), "w") as f:
        f.write('{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n')
    lines = jobs.log_folder_stream(spark, src)
    jobs.sql_table(lines, "a int, b string", "log_view", keep=["day"])
    jobs.to_memory(spark.sql("SELECT a, upper(b) AS b, day FROM log_view WHERE a > 1"), "log_out", os.path.join(tmp, "ck"))
    assert [tuple(r) for r in spark.sql("select * from log_out").collect()] == [(2, "Y", "2024-05-06")]
    q = jobs.to_console(lines, "console", checkpoint=os.path.join(tmp, "ck2"), trigger={"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_late_row_dropped(spark, tmp):
    # Spark drops a row behind the watermark of the *previous* micro-batch
    # (W7: its watermark moves between batches only), so the late row comes
    # two files after the one that moved the watermark to 48 s.
    rows = [("m", 50000, "x"), ("y", 52000, "x"), ("m", 10000, "x"), ("z", 200000, "x")]
    s = _replay(spark, tmp, rows, 4)
    jobs.to_memory(stats.tumble_counts(s, "ts", "10 seconds", watermark="2 seconds"), "late_out",
                   os.path.join(tmp, "ck"))
    got = sorted(r.stt for r in spark.sql("select * from late_out").collect())
    assert got == ["1970-01-01 00:00:50"]


def test_log_split_job(spark, tmp):
    src = os.path.join(tmp, "raw")
    os.makedirs(src)
    page = '{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"h"},"displays":[{"item":"7"}],"ts":%d}'
    for k, lines in enumerate((['{"common":{"mid":"1","is_new":"1"},"start":{"entry":"icon"},"ts":1}', "bad{", page % 2], [page % 3, "{}{}"])):
        with open(os.path.join(src, f"{k}.log"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src, f"{k}.log"), (1_700_000_000 + k, 1_700_000_000 + k))  # the order they are read in
    out = os.path.join(tmp, "out")
    q = jobs.log_split_job(jobs.text_stream(spark, src, 1), out, trigger={"availableNow": True}, checkpoint=os.path.join(tmp, "ckpt"))
    q.awaitTermination()
    counts = {k: spark.read.json(os.path.join(out, k)).count() for k in ("dirty", "start", "page", "display")}
    assert counts == {"dirty": 2, "start": 1, "page": 2, "display": 2}
    # the start line keeps the first '1'; the repair reaches across batches
    assert {r.common.is_new for r in spark.read.json(f"{out}/page").collect()} == {"0"}
    assert {r.common.is_new for r in spark.read.json(f"{out}/start").collect()} == {"1"}
    before = sorted(map(str, spark.read.json(f"{out}/page").drop("batch_id").collect()))
    writers.write_log_split(logsplit.split_lines(spark.createDataFrame([(page % 3, "0")], "value string, _is_new string")), out, 1)  # batch 1 again
    assert sorted(map(str, spark.read.json(f"{out}/page").drop("batch_id").collect())) == before


def test_lines_of_one_time_are_in_the_order_of_their_positions(spark, tmp):
    line = '{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"%s"},"ts":5}'
    raw = _stream(spark, tmp, "pos", spark.createDataFrame([(line % p, pos) for p, pos in (("c", 3), ("a", 1), ("b", 2))], "value string, pos long"), 1)
    out, _ = _ran(tmp, jobs.log_split_job, raw, name="pos")
    got = {r.page.page_id: r.common.is_new for r in spark.read.json(f"{out}/page").collect()}
    assert got == {"a": "1", "b": "0", "c": "0"}


def test_checkpoint_dir_from_session(spark):
    d = jobs.checkpoint_path(spark, "q")
    assert d.endswith("/q") and d.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_checkpoint_dir_has_to_be_set_on_a_cluster():
    """Without the setting a cluster's session is refused; one process gets a folder of its own."""
    from cartwheel.session import ensure_checkpoint_dir

    class Context:
        dir = None
        def __init__(self, master): self.master = master
        def getCheckpointDir(self): return self.dir
        def setCheckpointDir(self, d): self.dir = d

    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)
        def __init__(self, master): self.sparkContext = Context(master)

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(Session(master))
    for master in ("local", "local[4]"):
        s = Session(master)
        assert ensure_checkpoint_dir(s) == s.sparkContext.dir
