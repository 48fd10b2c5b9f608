"""Dimension tables kept as a base and per-batch deltas.

A table is a folder.  Rows are dealt by a hash of their key into buckets:

* ``base/<name>/bucket=<b>``: the rows of a bucket, each key once.
* ``delta/<name>/bucket=<b>``: the last change per key of one batch, with the
  batch's id and the columns it sets.
* ``manifest/<version>.json``: which folders make up the table, a state per
  version.  It is written under another name and renamed, so a reader sees the
  old state or the new one, and a batch that fails half-way changes nothing.

A batch writes its own rows and a manifest; a batch without rows writes
nothing.  Where the deltas of a bucket outgrow SHARE of its base, or are more
than DELTAS, that bucket alone is rewritten.  The last KEEP states stay
readable; folders that none of them names are removed.

Reading joins the base with the keys of the deltas, which are few: where they
are small enough to broadcast, the base is not shuffled.  One key is read from
one bucket, with the equality pushed to the scan; files are sorted by key, and
those of the base carry a bloom filter for it.

One query writes a table (a second writer fails at the rename).  A bucket is
rewritten by one task, so ``buckets`` has to suit the table's size;
``rebucket`` changes it.  Rows without a key are no dimension rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 32
SHARE = 0.5    # of a bucket's base that its deltas may reach
DELTAS = 64    # of one bucket
KEEP = 3       # states that stay readable
_BATCH, _SET, _BUCKET = "_batch", "_set", "bucket"


# ------------------------------------------------------------------ files

class _Files:
    """The file system of a table's folder, by Hadoop's interface, as Spark itself sees it."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._path = root.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def size(self, name: str) -> int:
        return self._fs.getContentSummary(self.path(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """All of ``text`` under a new ``name``, or nothing."""
        part = self.path(f"{name}.{uuid.uuid4().hex}.part")
        out = self._fs.create(part)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(self.path(name)) or not self._fs.rename(part, self.path(name)):
            self._fs.delete(part, False)
            raise RuntimeError(f"{self.root}/{name} was written by somebody else")

    def remove(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


def has_files(spark: SparkSession, folder: str, name: str | None = None) -> bool:
    """Whether a folder has anything in it, or ``name``."""
    names = _Files(spark, folder).names("")
    return bool(names) if name is None else name in names


# ----------------------------------------------------------------- states

def _states(files: _Files) -> list[int]:
    return sorted(int(n[:-5]) for n in files.names("manifest") if n.endswith(".json"))


def _state(files: _Files, before: int | None = None) -> dict | None:
    """The last state, or the last one of a batch below ``before``."""
    for v in reversed(_states(files)):
        state = json.loads(files.read(f"manifest/{v:012d}.json"))
        if before is None or state["batch"] < before:
            return state
    return None


def _schema(state: dict) -> T.StructType:
    return T.StructType.fromJson(state["schema"])


def _commit(files: _Files, state: dict) -> None:
    """List ``state`` as the newest, then remove what no kept state names."""
    versions = _states(files)
    state["version"] = versions[-1] + 1 if versions else 0
    files.put(f"manifest/{state['version']:012d}.json", json.dumps(state))
    for v in versions[:max(0, len(versions) + 1 - KEEP)]:
        files.remove(f"manifest/{v:012d}.json")
    used = set()
    for v in _states(files):
        s = json.loads(files.read(f"manifest/{v:012d}.json"))
        used |= {b["folder"] for b in s["base"].values()} | {d["folder"] for d in s["deltas"]}
    for kind in ("base", "delta"):
        for name in files.names(kind):
            if f"{kind}/{name}" not in used:
                files.remove(f"{kind}/{name}")


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_states(_Files(spark, path)))


def create(spark: SparkSession, path: str, schema: T.StructType, pk: str = "id", extend: str = "", buckets: int = BUCKETS) -> None:
    """K4: an empty table, if there is none.  ``extend`` is the text of further table properties."""
    files = _Files(spark, path)
    if not _states(files):
        _commit(files, {"batch": -1, "pk": pk, "extend": extend or "", "buckets": buckets, "schema": schema.jsonValue(), "base": {}, "deltas": []})


def drop(spark: SparkSession, path: str) -> None:
    """Remove the table."""
    files = _Files(spark, path)
    for part in ("manifest", "delta", "base"):
        files.remove(part)


def properties(spark: SparkSession, path: str) -> tuple[str, str]:
    """Key column and table properties."""
    state = _state(_Files(spark, path))
    return state["pk"], state["extend"]


# ---------------------------------------------------------------- reading

def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _rows(spark: SparkSession, path: str, state: dict, buckets=None, key: Column | None = None) -> DataFrame:
    """The rows of a state, of some ``buckets`` only, with a filter on the key before anything else."""
    schema, pk = T.StructType([T.StructField(f.name, f.dataType) for f in _schema(state).fields]), state["pk"]
    wanted = None if buckets is None else {str(b) for b in buckets}
    here = [b for b in state["base"] if wanted is None or b in wanted]
    base = _read(spark, [f"{path}/{state['base'][b]['folder']}/{_BUCKET}={b}" for b in here], schema)
    deltas = [(d, b) for d in state["deltas"] for b in d["bytes"] if wanted is None or b in wanted]
    if key is not None:
        base = base.filter(key)
    if not deltas:
        return base
    extra = T.StructType(schema.fields + [T.StructField(_BATCH, T.LongType()), T.StructField(_SET, T.ArrayType(T.StringType()))])
    changes = _read(spark, [f"{path}/{d['folder']}/{_BUCKET}={b}" for d, b in deltas], extra)
    if key is not None:
        changes = changes.filter(key)
    others = [c for c in schema.names if c != pk]
    # per column the last batch that sets it; a set NULL is a value
    last = changes.groupBy(pk).agg(F.max(_BATCH).alias(_BATCH), *[
        F.max_by(F.struct(c), F.when(F.array_contains(_SET, c), F.col(_BATCH))).alias(c) for c in others])
    kept = base.join(last.select(pk), pk, "left_anti")
    if all(set(d["columns"]) == set(schema.names) for d, _ in deltas):
        new = last.select(pk, *[F.col(c)[c].alias(c) for c in others])
    else:
        old = base.join(last.select(pk), pk, "left_semi").select(pk, *[F.col(c).alias(f"_old_{c}") for c in others])
        new = last.join(old, pk, "left").select(pk, *[F.when(F.col(c).isNotNull(), F.col(c)[c]).otherwise(F.col(f"_old_{c}")).alias(c) for c in others])
    return kept.select(*schema.names).unionByName(new.select(*schema.names))


def read(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table as of its last batch, or the last one below ``before`` (of the KEEP last states)."""
    state = _state(_Files(spark, path), before)
    if state is None:
        raise ValueError(f"no state of {path}" + ("" if before is None else f" before batch {before}"))
    return _rows(spark, path.rstrip("/"), state)


def read_key(spark: SparkSession, path: str, key) -> DataFrame:
    """The row of one key, read from its bucket alone."""
    state = _state(_Files(spark, path))
    kind = _schema(state)[state["pk"]].dataType
    bucket = spark.range(1).select(bucket_of(F.lit(key).cast(kind), state["buckets"])).first()[0]
    return _rows(spark, path.rstrip("/"), state, [bucket], F.col(state["pk"]) == F.lit(key).cast(kind))


# ---------------------------------------------------------------- writing

def last_changes(changes: DataFrame, pk: str, version: str | None = None) -> DataFrame:
    """The last change per key, without ``version``, which is unique per key; without one the greatest by a hash of its values."""
    ch = changes
    if version is None:
        ch, version = ch.distinct().withColumn("_version", F.xxhash64(*ch.columns)), "_version"
    last = ch.groupBy(F.col(pk).alias("_pk")).agg(F.max(version).alias("_last"))
    return ch.join(last, (F.col(pk) == F.col("_pk")) & (F.col(version) == F.col("_last")), "left_semi").drop(version)


def _write(files: _Files, rows: DataFrame, folder: str, pk: str) -> dict[str, int]:
    """``rows`` by bucket; the bytes of each bucket.  A base carries bloom filters, as large as its keys need."""
    w = rows.repartition(_BUCKET).sortWithinPartitions(_BUCKET, pk).write.mode("overwrite").partitionBy(_BUCKET)
    if folder.startswith("base/"):
        w = w.option(f"parquet.bloom.filter.enabled#{pk}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    w.parquet(f"{files.root}/{folder}")
    return {n.split("=")[1]: files.size(f"{folder}/{n}") for n in files.names(folder) if n.startswith(f"{_BUCKET}=")}


def _compacted(spark: SparkSession, files: _Files, state: dict, buckets: list[str]) -> None:
    """Rewrite the bases of ``buckets``, and take their rows out of the deltas."""
    rows = _rows(spark, files.root, state, buckets).withColumn(_BUCKET, bucket_of(F.col(state["pk"]), state["buckets"]))
    folder = f"base/{state['batch']}-{uuid.uuid4().hex[:12]}"
    sizes = _write(files, rows, folder, state["pk"])
    for b in buckets:
        state["base"][b] = {"folder": folder, "bytes": sizes[b]}
        for d in state["deltas"]:
            d["bytes"].pop(b, None)
    state["deltas"] = [d for d in state["deltas"] if d["bytes"]]


def _merged(given: DataFrame, pk: str, columns: list[str], sets: str, version: str) -> DataFrame:
    """Per key and column the last value that a change sets, and in ``sets`` the columns set by any."""
    last = given.groupBy(pk).agg(*[F.max_by(F.struct(c), F.when(F.array_contains(sets, c), F.col(version))).alias(c) for c in columns if c != pk])
    names = F.array_compact(F.array(F.lit(pk), *[F.when(F.col(c).isNotNull(), F.lit(c)) for c in columns if c != pk]))
    return last.select(pk, *[F.col(c)[c].alias(c) for c in columns if c != pk], names.alias(sets))


def upsert(spark: SparkSession, path: str, changes: DataFrame, batch_id: int, version: str | None = None, sets: str | None = None) -> bool:
    """K3: apply a batch of new column values; whether anything was written.

    The last change per key by ``version`` counts.  Columns that ``changes``
    lack keep their values; ``sets`` names an array column with the columns
    that a single change sets, and then the last change per key and column
    counts.  The newest batch may run again and replaces what it wrote; an
    older one has been applied already."""
    files = _Files(spark, path)
    newest = _state(files)
    if newest["batch"] > batch_id:
        return False
    state = _state(files, before=batch_id)
    if state is None:
        raise ValueError(f"the state of {path} before batch {batch_id} is not kept any more")
    schema, pk = _schema(state), state["pk"]
    columns = [f.name for f in schema.fields if f.name in changes.columns]
    given = changes.filter(F.col(pk).isNotNull()).select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in columns],
                                                              *[c for c in (version, sets) if c])
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in columns]
    if sets is None:
        given = last_changes(given, pk, version)
    else:
        given = _merged(given, pk, columns, sets, version)
    rows = given.select("*", *missing).select(
        *schema.names, F.lit(batch_id).cast("bigint").alias(_BATCH), (F.lit(columns) if sets is None else F.col(sets)).alias(_SET),
        bucket_of(F.col(pk), state["buckets"]).alias(_BUCKET))
    folder = f"delta/{batch_id}-{uuid.uuid4().hex[:12]}"
    sizes = _write(files, rows, folder, pk)
    if not sizes:
        files.remove(folder)
        if newest["batch"] == batch_id:  # the batch had rows when it ran before
            _commit(files, state | {"batch": batch_id})
            return True
        return False
    state["batch"] = batch_id
    state["deltas"].append({"folder": folder, "batch": batch_id, "columns": columns if sets is None else [], "bytes": sizes})
    grown: dict[str, list[int]] = {}
    for d in state["deltas"]:
        for b, n in d["bytes"].items():
            grown.setdefault(b, []).append(n)
    full = [b for b, n in grown.items() if sum(n) > SHARE * state["base"].get(b, {"bytes": 0})["bytes"] or len(n) > DELTAS]
    if full:
        _compacted(spark, files, state, full)
    _commit(files, state)
    return True


def rebucket(spark: SparkSession, path: str, buckets: int) -> None:
    """Deal the whole table into another number of buckets."""
    files = _Files(spark, path)
    state = _state(files)
    rows = _rows(spark, files.root, state).withColumn(_BUCKET, bucket_of(F.col(state["pk"]), buckets))
    folder = f"base/{state['batch']}-{uuid.uuid4().hex[:12]}"
    sizes = _write(files, rows, folder, state["pk"])
    _commit(files, state | {"buckets": buckets, "deltas": [], "base": {b: {"folder": folder, "bytes": n} for b, n in sizes.items()}})
