"""Config-driven routing of change records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.jsonfmt import keep_fields
from .cdc import drop_deletes

# Sink types of a routing rule.
SINK_KAFKA, SINK_HBASE, SINK_CLICKHOUSE = "kafka", "hbase", "clickhouse"

CONFIG_COLUMNS = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk", "sinkExtend"]


def rule_history(rule_changes: DataFrame, version: str = "version") -> DataFrame:
    """T4: change records of the config table as rules with the time they hold: ``valid_from`` and, where a later
    change ends it, ``valid_to`` (exclusive), both in ``version``.

    A deleted rule ends without a successor (fixes Q17).  Changes of one rule have different versions; of repeated
    ones with the same version one counts.  Rules are few by nature, so a rule's changes are ordered in one task."""
    key = [F.coalesce(F.col("after")[c], F.col("before")[c]).alias(c) for c in CONFIG_COLUMNS[:2]]
    rows = rule_changes.select(*key, F.col("type").alias("_type"), *[F.col("after")[c].alias(c) for c in CONFIG_COLUMNS[2:]],
                               F.col(version).alias("valid_from")).dropDuplicates([*CONFIG_COLUMNS[:2], "valid_from"])
    later = F.lead("valid_from").over(Window.partitionBy(*CONFIG_COLUMNS[:2]).orderBy("valid_from"))
    return rows.withColumn("valid_to", later).filter(~F.col("_type").eqNullSafe("delete")).drop("_type")


def current_rules(history: DataFrame) -> DataFrame:
    """The rules of ``rule_history`` that hold now."""
    return history.filter(F.col("valid_to").isNull()).select(*CONFIG_COLUMNS)


def _rule_of(at: str | None):
    """Whether a rule is the one of a change: by table and kind of change and, with ``at``, by the time it holds."""
    cond = (F.col("tableName") == F.col("_st")) & (F.col("type") == F.col("_ot"))
    if at is not None:
        cond = cond & (F.col("_from") <= F.col(at)) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return cond


def _rules(config: DataFrame, at: str | None, *columns) -> DataFrame:
    """The keys of the rules and ``columns``, sent to every task: rules are few by nature, and so are the tables and kinds of
    change they are joined by, so a shuffle by these would bring all changes of a table into one task."""
    out = [F.col("sourceTable").alias("_st"), F.col("operateType").alias("_ot")]
    out += [F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to")] if at is not None else []
    return F.broadcast(config.select(*out, *columns))


def route(changes: DataFrame, config: DataFrame, at: str | None = None) -> DataFrame:
    """J3 + P9 + P10: drop deletes, join the rule of (tableName, type), prune
    ``after`` to ``sinkColumns`` and add ``sinkTable``/``pk``/``sinkType``.

    ``at``: the change's version column; ``config`` is then a ``rule_history``
    and each change is routed by the rule that held at its version (T4).
    Rows without a rule are dropped here (see ``unmatched``).
    """
    cfg = _rules(config, at, "sinkType", "sinkTable", "sinkColumns", F.col("sinkPk").alias("pk"))
    j = drop_deletes(changes).join(cfg, _rule_of(at), "inner")
    return (j.withColumn("after", keep_fields("after", F.col("sinkColumns")))
             .drop("_st", "_ot", "_from", "_to", "sinkColumns"))


def route_fact(changes: DataFrame, config: DataFrame, at: str | None = None) -> DataFrame:
    """Rows for topics (``sinkType = 'kafka'``); K2 picks the topic per row."""
    return route(changes, config, at).filter(F.col("sinkType") == SINK_KAFKA)


def route_dim(changes: DataFrame, config: DataFrame, at: str | None = None) -> DataFrame:
    """Rows for dimension tables (``sinkType = 'hbase'``)."""
    return route(changes, config, at).filter(F.col("sinkType") == SINK_HBASE)


def unmatched(changes: DataFrame, config: DataFrame, at: str | None = None) -> DataFrame:
    """Q18: non-delete rows without a rule (a dead letter instead of a print)."""
    return drop_deletes(changes).join(_rules(config, at), _rule_of(at), "left_anti")


def dim_schema(sink_columns: str, sink_pk: str | None = None) -> tuple[T.StructType, str]:
    """K4: all-text schema of a dimension table and its key (default ``id``).

    Columns split on ``,`` without trimming, as the reference does."""
    pk = sink_pk if sink_pk else "id"
    cols = sink_columns.split(",")
    return T.StructType([T.StructField(c, T.StringType(), c != pk) for c in cols]), pk


def dim_schema_rows(config: DataFrame) -> DataFrame:
    """K4 as a table: one row per (dimension table, column) with key flag and
    the table-properties clause; rules for other sink types are skipped."""
    h = config.filter(F.col("sinkType") == SINK_HBASE)
    pk = F.when((F.col("sinkPk").isNull()) | (F.col("sinkPk") == ""), "id").otherwise(F.col("sinkPk"))
    return (h.select("sinkTable", pk.alias("pk"), F.coalesce("sinkExtend", F.lit("")).alias("extend"),
                     F.posexplode(F.split("sinkColumns", ",")).alias("position", "column"))
             .select("sinkTable", "position", "column", (F.col("column") == F.col("pk")).alias("is_pk"),
                     F.lit("string").alias("type"), "extend"))
