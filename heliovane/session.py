"""Where intermediate tables go, how lineage is cut, and how such tables are removed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
import uuid

from pyspark.sql import DataFrame, SparkSession


# The tables settled since the innermost `cleared` block of this thread began.
_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the session names; executors and driver must share it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A path nobody has used yet inside the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write the frame once and read it back: later jobs start from files.

    Used where one result feeds many jobs (fits, sweeps).  Parquet keeps column
    pruning for the readers, and lost executors cost a re-read, not a recompute.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.settled_at = path
    if (made := _made.get()) is not None:
        made.append(table)
    return table


@contextmanager
def cleared() -> Iterator[list[DataFrame]]:
    """Remove, when the block ends or fails, every table settled inside it but those put into the list.

    What stays belongs to the block around this one, if there is any.
    """
    made: list[DataFrame] = []
    kept: list[DataFrame] = []
    outer = _made.get()
    token = _made.set(made)
    try:
        yield kept
    except BaseException:
        kept.clear()
        raise
    finally:
        _made.reset(token)
        staying = {table.settled_at for table in kept}
        discard(*[table for table in made if table.settled_at not in staying])
        if outer is not None:
            outer.extend(kept)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, wherever Spark reads it from."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no frame in use reads any more."""
    for table in tables:
        remove(table.sparkSession, table.settled_at)
