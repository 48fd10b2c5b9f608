"""Streaming jobs: sources, watermarks, and one job per step of the warehouse.

A job is ``readStream -> the batch operators or state functions ->
foreachBatch``.  Every batch is written to a folder of its own id
(``sinks.writers.write_batch``), so a batch that runs again replaces its
output.  Dimensions and routing rules are passed as functions and read again
for every batch, so a batch sees their latest version (J3, J13).  State and
offsets live in a checkpoint folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonfmt import parse_row, parse_strict
from ..operators import keywords, logsplit, routing, stats, wide
from ..session import ensure_checkpoint_dir
from ..sinks import dimstore, writers
from . import state

Frames = Callable[[], dict]


# ---------------------------------------------------------------- sources

def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1/S8 over a folder: one line per record in ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def log_folder_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Daily log files; ``day`` is the date in the file's name."""
    day = F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})[^/]*$", 1)
    return text_stream(spark, path, max_files_per_trigger).select("value", F.when(day != "", day).alias("day"))


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """S1/S2/S4 from a topic (needs the Kafka connector on the classpath);
    ``starting="earliest"`` reads a compacted topic's snapshot, then its
    changes.  Offsets live in the query checkpoint."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).load()
            .select(F.col("value").cast("string").alias("value"), F.unix_millis("timestamp").alias("record_ts"), F.col("offset").alias("pos")))


def parquet_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def typed_rows(lines: DataFrame, schema: str, strict: bool = False, keep=()) -> DataFrame:
    """JSON lines as typed rows; ``strict`` fails the job on a broken line."""
    parse = parse_strict if strict else parse_row
    return lines.select(*keep, parse("value", schema).alias("r")).filter(F.col("r").isNotNull()).select("r.*", *keep)


def sql_table(lines: DataFrame, schema: str, name: str, keep=()) -> DataFrame:
    """JSON lines as a SQL view of typed columns."""
    df = typed_rows(lines, schema, keep=keep)
    df.createOrReplaceTempView(name)
    return df


def snapshot_changes(snapshot: DataFrame, changes: DataFrame, database: str, table: str, key: str, version: str = "version",
                     as_of: str | None = None) -> DataFrame:
    """Rows of a table as ``read`` changes, of the version in column ``as_of``, or of version -1."""
    row = F.create_map(*[x for c in snapshot.columns if c != as_of for x in (F.lit(c), F.col(c).cast("string"))])
    at = F.lit(-1) if as_of is None else F.col(as_of)
    return snapshot.select(F.lit(database).alias("database"), F.lit(table).alias("tableName"),
                           F.create_map().cast("map<string,string>").alias("before"), row.alias("after"), F.lit("read").alias("type"),
                           F.col(key).cast(changes.schema["key"].dataType).alias("key"), at.cast(changes.schema[version].dataType).alias(version))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, database: str, table: str, key: str, version: str = "version",
                          as_of: str | None = None) -> DataFrame:
    """S4 as frames: the snapshot's rows, then the changes.  Changes that the snapshot holds have no higher version
    than its rows, so ``cdc.current_state`` passes them over."""
    first = snapshot_changes(snapshot, changes, database, table, key, version, as_of)
    return first.unionByName(changes.select(*first.columns))


def jdbc_query(spark: SparkSession, url: str, sql: str, camel: bool = True, props: dict | None = None) -> DataFrame:
    """A query over JDBC with columns in camel case (untested here: no driver)."""
    from ..functions.names import rename_columns_camel
    df = spark.read.format("jdbc").option("url", url).option("query", sql).options(**(props or {})).load()
    return rename_columns_camel(df) if camel else df


def with_event_time(df: DataFrame, ts_ms: str = "ts", delay: str = "0 seconds", col: str = "_et") -> DataFrame:
    """Event-time column from epoch ms plus a watermark
    (``0 seconds`` = ascending timestamps)."""
    return df.withColumn(col, F.timestamp_millis(F.col(ts_ms))).withWatermark(col, delay)


# ---------------------------------------------------------------- running

def checkpoint_path(spark: SparkSession, name: str) -> str:
    """Per-query checkpoint folder under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def run(df: DataFrame, write: Callable[[DataFrame, int], None], name: str, trigger: dict | None = None,
        checkpoint: str | None = None, mode: str = "append"):
    """Start a query that hands every batch and its id to ``write``."""
    w = (df.writeStream.foreachBatch(write).outputMode(mode).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_path(df.sparkSession, name)))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def to_console(df: DataFrame, name: str, rows: int = 20, checkpoint: str | None = None, trigger: dict | None = None):
    """K7: print every batch."""
    w = (df.writeStream.format("console").option("numRows", rows).option("truncate", False).queryName(name)
         .option("checkpointLocation", checkpoint or checkpoint_path(df.sparkSession, name)))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def to_memory(df: DataFrame, name: str, ckpt: str, mode: str = "append", available_now: bool = True):
    """Run a streaming query to completion into an in-memory table (tests)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", ckpt)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    q.awaitTermination()
    return q


def _to_folder(out: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, batch_id: writers.write_batch(batch, out, batch_id, "parquet")


# ------------------------------------------------------------------- jobs

def log_split_job(raw: DataFrame, out: str, name: str = "log_split", **how):
    """Log split (T1, T6, K8, P2, P12-P14): new-visitor repair, then dirty,
    start, page and display folders.

    A line is parsed for its device and flag before the state step, and once
    more, for all four outputs together, after it."""
    pos = [c for c in raw.columns if c == "pos"]  # decides between lines of one time
    p = logsplit.split_lines(raw.select("value", *pos))
    common = F.from_json(F.col("_p")["common"], "map<string,string>")
    flat = p.select("value", *pos, common["mid"].alias("mid"), common["is_new"].alias("is_new"), F.col("_p")["ts"].try_cast("bigint").alias("ts"))

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.write_log_split(logsplit.split_lines(batch.select("value", F.col("is_new").alias("_is_new"))), out, batch_id)

    return run(state.repair_lines_stream(flat), write, name, **how)


def routing_job(changes: DataFrame, rules: Callable[[], DataFrame], out: str, dims: str, name: str = "routing",
                pk: str = "id", version: str | None = "version", **how):
    """Routing (J3, P4, P9-P11, K2-K4): facts to topic folders, dimensions to
    stored tables, rows without a rule to dead letters.  ``rules`` is read
    again for every batch; a table without rows in the batch is not touched."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        try:
            current = rules()
            writers.write_topic_folder(routing.route_fact(batch, current).select("sinkTable", "after"), f"{out}/facts", batch_id)
            writers.write_batch(routing.unmatched(batch, current), f"{out}/unmatched", batch_id)
            routed = routing.route_dim(batch, current)
            touched = {r.sinkTable for r in routed.select("sinkTable").distinct().collect()}
            tables: dict[str, list] = {}
            for rule in current.filter(F.col("sinkType") == routing.SINK_HBASE).collect():  # few by nature
                tables.setdefault(rule.sinkTable, []).append(rule)
            for table, of in tables.items():  # rules of several sources or kinds of change can feed one table
                columns = list(dict.fromkeys(c for r in of for c in r.sinkColumns.split(",")))
                writers.ensure_dim_table(spark, f"{dims}/{table}", ",".join(columns), of[0].sinkPk or pk, of[0].sinkExtend)
                if table in touched:
                    rows = routed.filter(F.col("sinkTable") == table).select(
                        *[F.col("after")[c].alias(c) for c in columns], F.map_keys("after").alias("_sets"), *([version] if version else []))
                    writers.upsert_dim_table(spark, f"{dims}/{table}", rows, batch_id, version, "_sets" if version and len(of) > 1 else None)
        finally:
            batch.unpersist()

    return run(changes, write, name, **how)


def routing_as_of_job(changes: DataFrame, rule_changes: DataFrame, out: str, rules: str, name: str = "routing_as_of", version: str = "version", **how):
    """Routing by rules that are a stream of changes themselves (T4): facts and dead letters, each change by the rule
    that held at its version.

    ``changes`` and ``rule_changes`` have the columns of normalised changes and share one order, ``version``, as the
    changes of one database do.  They run as one query.  The rule changes of a batch are stored first, in a folder of the batch,
    then its rows are joined as of their versions with all rules stored so far; so a rule and the rows it routes may
    come in one batch, in any order."""
    kind = "_rule"
    both = changes.withColumn(kind, F.lit(False)).unionByName(rule_changes.withColumn(kind, F.lit(True)))
    schema = rule_changes.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        try:
            new = batch.filter(kind).drop(kind)
            if not new.isEmpty():
                writers.write_batch(new, f"{rules}/changes", batch_id, "parquet")
            rows = batch.filter(~F.col(kind)).drop(kind)
            stored = spark.read.schema(schema).parquet(f"{rules}/changes") if dimstore.has_files(spark, f"{rules}/changes") else new
            history = routing.rule_history(stored, version)
            writers.write_topic_folder(routing.route_fact(rows, history, version).select("sinkTable", "after"), f"{out}/facts", batch_id)
            writers.write_batch(routing.unmatched(rows, history, version), f"{out}/unmatched", batch_id)
        finally:
            batch.unpersist()

    return run(both, write, name, **how)


def topic_job(rows: DataFrame, servers: str | None, name: str, topic_col: str = "sinkTable",
              write: Callable[[DataFrame, str | None, str], None] = writers.write_topics, **how):
    """K1/K2: a stream of rows into topics, the topic chosen per row.

    ``write`` is ``writers.write_topics``, Spark's Kafka sink (needs the connector); a batch that runs again is sent
    again, so the receiver keys on the row."""
    return run(rows, lambda batch, batch_id: write(batch, servers, topic_col), name, **how)


def snapshot_then_changes_job(snapshot: DataFrame, changes: DataFrame, database: str, table: str, key: str, as_of: str, out: str,
                              name: str = "snapshot_then_changes", version: str = "version", **how):
    """The snapshot as a first batch, then the changes that it does not hold.

    ``snapshot`` is a table with the version up to which each row goes in ``as_of``.  It is written once, before the
    stream starts; the stream's marks are read from what was written, so both are of one moment.  Changes may overlap
    the snapshot, and may come again: each is written once."""
    spark = changes.sparkSession
    first = snapshot_changes(snapshot, changes, database, table, key, version, as_of)
    path = f"{out}/batch_id=snapshot"
    if not dimstore.has_files(spark, path, "_SUCCESS"):
        writers.write_batch(first, out, "snapshot", "parquet")
    marks = spark.read.parquet(path).select("key", version)
    mine = changes.select(*first.columns).filter((F.col("database") == database) & (F.col("tableName") == table))
    return run(state.changes_after_snapshot(mine, marks, "key", version), _to_folder(out), name, **how)


def unique_visit_job(page: DataFrame, out: str, ttl_ms: int | None = 86_400_000, name: str = "unique_visit", **how):
    """T2 with T5: the state store forgets a day ``ttl_ms`` after it was written."""
    return run(state.unique_visit_stream(page, ttl_ms), _to_folder(out), name, **how)


def user_jump_job(page: DataFrame, out: str, within_ms: int = 10_000, delay: str = "0 seconds", name: str = "user_jump", **how):
    """T3 with both outputs."""
    return run(state.user_jump_stream(with_event_time(page, delay=delay), within_ms), _to_folder(out), name, **how)


def order_wide_stream(order_info: DataFrame, order_detail: DataFrame, lower_ms: int = -5_000, upper_ms: int = 5_000,
                      delay: str = "2 seconds") -> DataFrame:
    """J1 + P15 on streams; the state of both sides ends with the interval and the delay."""
    return wide.order_interval_join(order_info, order_detail, lower_ms, upper_ms, watermark=delay)


def order_wide_job(order_info: DataFrame, order_detail: DataFrame, dims: Frames, as_of_ms, out: str, lower_ms: int = -5_000,
                   upper_ms: int = 5_000, delay: str = "2 seconds", name: str = "order_wide", **how):
    """Order-wide."""
    def write(batch: DataFrame, batch_id: int) -> None:
        writers.write_batch(wide.wide_lookups(batch, dims(), as_of_ms), out, batch_id, "parquet")
    return run(order_wide_stream(order_info, order_detail, lower_ms, upper_ms, delay), write, name, **how)


def payment_wide_stream(payment_info: DataFrame, order_wide: DataFrame, lower_ms: int = 15 * 60_000, upper_ms: int = 5_000,
                        delay: str = "2 seconds", record_ts: str | None = None) -> DataFrame:
    """J2 + P16 on streams."""
    return wide.payment_interval_join(payment_info, order_wide, lower_ms, upper_ms, record_ts=record_ts, watermark=delay)


def payment_wide_job(payment_info: DataFrame, order_wide: DataFrame, out: str, lower_ms: int = 15 * 60_000, upper_ms: int = 5_000,
                     delay: str = "2 seconds", record_ts: str | None = None, name: str = "payment_wide", **how):
    """Payment-wide."""
    return run(payment_wide_stream(payment_info, order_wide, lower_ms, upper_ms, delay, record_ts), _to_folder(out), name, **how)


def visitor_stats_job(page: DataFrame, uv: DataFrame, uj: DataFrame, out: str, size: str = "10 seconds",
                      delay: str = "14 seconds", name: str = "visitor_stats", **how):
    """A3 over the page, unique-visit and bounce streams."""
    rows = stats.visitor_rows(page, uv, uj)
    return run(stats.visitor_stats(rows, size, watermark=delay), _to_folder(out), name, **how)


def product_stats_job(feeds: list[DataFrame], dims: Frames, out: str, size: str = "10 seconds", delay: str = "2 seconds",
                      name: str = "product_stats", **how):
    """A4 over the feeds (U2), then J11 on the finished windows."""
    agg = stats.product_aggregate(stats.product_union(*feeds), size, streaming=True, watermark=delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.write_batch(stats.product_dims(batch, dims()), out, batch_id, "parquet")
    return run(agg, write, name, **how)


DAILY_SCHEMA = "day int, gmv decimal(18,2)"


def add_daily_gmv(spark: SparkSession, path: str, days: DataFrame, batch_id: int) -> bool:
    """Add a batch's sums of days (``day``, ``gmv``) to the stored totals at ``path``.

    The table is a ``dimstore`` keyed by day: only the buckets of the batch's days are written, a batch without rows
    writes nothing, and a batch that runs again adds to the state before it, so nothing counts twice."""
    schema = spark.createDataFrame([], DAILY_SCHEMA).schema
    dimstore.create(spark, path, schema, "day", buckets=8)  # days are few
    return dimstore.upsert(spark, path, stats.add_to_days(dimstore.read(spark, path, before=batch_id), days), batch_id)


def daily_gmv_job(windows: DataFrame, totals: str, name: str = "daily_gmv", **how):
    """A8/P29 on the stream of finished product windows (``stt``, ``order_amount``): totals by day, kept up to date."""
    def write(batch: DataFrame, batch_id: int) -> None:
        add_daily_gmv(batch.sparkSession, totals, stats.gmv_by_day(batch), batch_id)
    return run(windows, write, name, **how)


def daily_gmv(spark: SparkSession, totals: str, day: int | None = None) -> DataFrame:
    """``gmv`` of a day ``yyyyMMdd`` (0 or None is today), read by its key; NULL without rows."""
    day = day or int(stats.day_range()[0].replace("-", ""))
    return dimstore.read_key(spark, totals, day).agg(F.max("gmv").alias("gmv"))


def province_stats_job(order_wide: DataFrame, dims: Frames, out: str, size: str = "10 seconds", delay: str = "2 seconds",
                       name: str = "province_stats", **how):
    """A1 on the order-wide stream, then the province of the finished windows."""
    agg = stats.province_windows(order_wide, size, streaming=True, watermark=delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        writers.write_batch(stats.province_names(batch, dims()["province"]), out, batch_id, "parquet")
    return run(agg, write, name, **how)


def keyword_stats_job(page: DataFrame, out: str, size: str = "10 seconds", delay: str = "2 seconds", cjk: bool = True,
                      name: str = "keyword_stats", **how):
    """A2: search pages of the page log (P7, P8), their words, counts per window."""
    words = keywords.keyword_explode(stats.keyword_filter(page), cjk=cjk)
    return run(stats.keyword_stats(words, size, watermark=delay), _to_folder(out), name, **how)
