"""Change records: normalise, drop deletes, current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonfmt import STR_MAP


def _empty_map():
    return F.create_map().cast(STR_MAP)

# Capture operation codes -> change type.
OP_TYPES = {"c": "insert", "u": "update", "d": "delete", "r": "read"}


def normalize_changes(raw: DataFrame, topic: str = "topic", op: str = "op", keep=()) -> DataFrame:
    """``server.database.table`` topic -> database, tableName; missing
    before/after -> empty map; op code -> lower-case type, create -> insert."""
    parts = F.split(F.col(topic), r"\.")
    typ = None
    for code, name in OP_TYPES.items():
        cond = F.lower(F.col(op)).isin(code, name if name != "insert" else "create")
        typ = F.when(cond, name) if typ is None else typ.when(cond, name)
    typ = typ.otherwise(F.lower(F.col(op)))
    return raw.select(
        parts.getItem(1).alias("database"), parts.getItem(2).alias("tableName"),
        F.coalesce(F.col("before"), _empty_map()).alias("before"),
        F.coalesce(F.col("after"), _empty_map()).alias("after"),
        typ.alias("type"), *keep)


def for_tables(changes: DataFrame, database: str | None = None, tables=None) -> DataFrame:
    """S3: keep one database and optionally listed tables."""
    c = changes
    if database is not None:
        c = c.filter(F.col("database") == database)
    if tables:
        c = c.filter(F.col("tableName").isin(list(tables)))
    return c


def drop_deletes(changes: DataFrame, type_col: str = "type") -> DataFrame:
    """Drop ``delete`` rows; a NULL type is kept."""
    return changes.filter(~F.col(type_col).eqNullSafe("delete"))


def current_state(changes: DataFrame, pk: str = "id", version: str = "version") -> DataFrame:
    """The last change per key (by ``version``, unique per key), deletes removed.

    The last version per key is a hash aggregate over two narrow columns,
    combined before the shuffle, and is joined back; a hot key never piles up
    in one task.  The key is read from ``after`` or, for deletes, ``before``.
    """
    keyed = changes.withColumn("_pk", F.coalesce(F.col("after")[pk], F.col("before")[pk]))
    last = keyed.groupBy("_pk").agg(F.max(version).alias("_last"))
    return (keyed.join(last, (keyed["_pk"] == last["_pk"]) & (keyed[version] == last["_last"]), "left_semi").drop("_pk")
            .filter(~F.col("type").eqNullSafe("delete")))


def typed_after(changes: DataFrame, schema: dict) -> DataFrame:
    """S5 projection: ``after`` map -> typed columns ``{name: type}``."""
    return changes.select(*[F.col("after")[c].cast(t).alias(c) for c, t in schema.items()])
