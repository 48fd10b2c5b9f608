"""Sinks (K1-K10).

Folder sinks take a batch id and write one folder per batch, overwritten when a
batch is run again, so a replay leaves no duplicate; ``batch`` names a one-off
run.  Days come from the data, never from the clock, so a replay writes to the
same day.  No Kafka connector, JDBC driver or HBase client ships with this
image: the topic and JDBC writers below are thin calls of Spark's own sinks,
untested here.  Both may see a batch twice after a failure; the receiver has to
key on ``batch_id`` or on the row's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsonfmt import to_json_row
from . import dimstore


# ---------------------------------------------------------------- topics

def as_topic_records(df: DataFrame, topic_col: str = "sinkTable", value_cols=None) -> DataFrame:
    """K1/K2: ``topic``, ``value`` columns for Spark's Kafka sink; the topic is
    chosen per row."""
    cols = value_cols or [c for c in df.columns if c != topic_col]
    return df.select(F.col(topic_col).alias("topic"), to_json_row(*cols).alias("value"))


def write_topics(df: DataFrame, servers: str | None, topic_col: str = "sinkTable") -> None:
    """K1/K2 into Kafka, topic per row (needs the connector on the classpath)."""
    as_topic_records(df, topic_col).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_batch(df: DataFrame, path: str, batch_id: int | str, fmt: str = "json", partition: str | None = None) -> None:
    """One folder per batch; a batch that is run again replaces its own output."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).format(fmt).save(f"{path}/batch_id={batch_id}")


def write_topic_folder(df: DataFrame, path: str, batch_id: int | str = "batch", topic_col: str = "sinkTable") -> None:
    """K2 against a folder: JSON lines, one sub-folder per topic of the batch."""
    write_batch(as_topic_records(df, topic_col), path, batch_id, "json", "topic")


# ------------------------------------------------------------ dimensions

def upsert_dim(existing: DataFrame, changes: DataFrame, pk: str = "id", version: str | None = None) -> DataFrame:
    """K3: dimension rows after applying a batch of upserts, as frames.

    ``changes`` hold the new column values (typed, NULL stays NULL, Q19); the
    latest change per key wins (``version``, unique per key; without one, the
    greatest by a hash of its values, so a repeated run picks the same), then a
    full outer join keeps untouched rows and replaces changed ones.  A stored
    table takes ``upsert_dim_table``, which writes only what changed.
    """
    cols = existing.columns
    ch = dimstore.last_changes(changes.select(*[c for c in cols if c in changes.columns], *([version] if version else [])), pk, version)
    e = existing.select(pk, *[F.col(c).alias(f"_o_{c}") for c in cols if c != pk])
    n = ch.select(pk, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in ch.columns if c != pk])
    j = e.join(n, pk, "full")
    out = []
    for c in cols:
        if c == pk:
            out.append(F.col(pk))
        elif f"_n_{c}" in n.columns:
            out.append(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(f"_o_{c}")).alias(c))
        else:
            out.append(F.col(f"_o_{c}").alias(c))
    return j.select(*out)


def read_dim(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The dimension as of its last version, or the last one below ``before``.

    Version 0 is the empty table, batch ``n`` makes version ``n + 1``."""
    pk, extend = dimstore.properties(spark, path)
    dim = dimstore.read(spark, path, None if before is None else before - 1)
    return dim.select(*[F.col(c).alias(c, metadata={"pk": True, "extend": extend}) if c == pk else F.col(c) for c in dim.columns])


def ensure_dim_table(spark: SparkSession, path: str, sink_columns: str, sink_pk: str | None = None, extend: str | None = None) -> None:
    """K4: an empty dimension of text columns, if there is none, with its key and table properties (``dim_properties``)."""
    from ..operators.routing import dim_schema
    schema, pk = dim_schema(sink_columns, sink_pk)
    dimstore.create(spark, path, schema, pk, extend or "")


def dim_properties(dim: DataFrame) -> tuple[str | None, str]:
    """Key column and table properties of a dimension read by ``read_dim``."""
    for f in dim.schema:
        if f.metadata.get("pk"):
            return f.name, f.metadata.get("extend", "")
    return None, ""


def upsert_dim_table(spark: SparkSession, path: str, changes: DataFrame, batch_id: int, version: str | None = None,
                     sets: str | None = None) -> bool:
    """K3 as a table: what a batch writes follows the batch, not the table (``dimstore``); a replay replaces itself."""
    return dimstore.upsert(spark, path, changes, batch_id, version, sets)


# ---------------------------------------------------------------- tables

def positional(df: DataFrame, columns, transient=()) -> DataFrame:
    """K5/K6: drop working columns, then order columns for a positional insert."""
    return df.drop(*transient).select(*columns)


def jdbc_append(df: DataFrame, url: str, table: str, columns, batchsize: int = 10_000, props=None) -> None:
    """K5: batched JDBC insert (the reference used batches of 5)."""
    positional(df, columns).write.mode("append").option("batchsize", batchsize).jdbc(url, table, properties=props or {})


# ----------------------------------------------------------------- lines

def write_dead_letters(dirty: DataFrame, path: str, day: Column, batch_id: int | str = "batch") -> None:
    """K8: broken lines of a batch by day; ``day`` comes from the record or its file name."""
    write_batch(dirty.withColumn("dt", day), path, batch_id, "json", "dt")


def write_daily_text(lines: DataFrame, path: str, day: Column, batch_id: int | str = "batch", value: str = "value") -> None:
    """Daily text files."""
    write_batch(lines.select(F.col(value).alias("value"), day.alias("dt")), path, batch_id, "text", "dt")


def write_log_split(split: DataFrame, path: str, batch_id: int | str = "batch") -> None:
    """Lines of ``logsplit.split_lines``, parsed once, into dirty, start, page and display folders."""
    from ..operators.logsplit import display_log, page_lines, start_log, typed_lines
    split = split.persist()
    try:
        typed = typed_lines(split, keep=[c for c in split.columns if c not in ("value", "_p")])
        if "_is_new" in typed.columns:  # the flag that the repair has decided on
            from ..functions.jsonfmt import set_field
            typed = typed.withColumn("common", F.when(F.col("_is_new").isNotNull(), set_field("common", "is_new", F.col("_is_new")))
                                     .otherwise(F.col("common"))).drop("_is_new")
        for kind, df in (("dirty", split.filter(F.col("_p").isNull()).select("value")), ("start", start_log(typed)),
                         ("page", page_lines(typed)), ("display", display_log(typed))):
            write_batch(df, f"{path}/{kind}", batch_id)
    finally:
        split.unpersist()
