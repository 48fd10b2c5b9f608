"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ship_package

# Text handed to one numpy or tokenizer step, in bytes.  A longer document is a
# step of its own: texts are never cut here.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share; an error on a cluster without the setting."""
    return ensure_checkpoint_dir(spark)


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage; the files are in the shared folder, so a lost executor
    costs only its running tasks."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def stored(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a Parquet table in the shared folder, removed at the end of the block.

    What is derived from it has to be computed, and cut from it, inside the block."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    try:
        yield spark.read.parquet(path)
    finally:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def steps(batch: pa.RecordBatch, text: str = "text", most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``most`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              text: str = "text", most: int = STEP_BYTES) -> DataFrame:
    """``mapInArrow`` whose ``fn`` sees slices of bounded size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in steps(b, text, most):
                yield fn(s)
    return map_batches(df, run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with this package made importable on the executors."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
