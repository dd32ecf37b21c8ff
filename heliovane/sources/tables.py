"""Tables by key under one folder, and the report files."""

from __future__ import annotations

from functools import reduce
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a table's commits lie (readers of files skip names that begin with an underscore), and a commit's last line.
COMMITS, COMPLETE = "_commits", "complete"


class TableStore:
    """Parquet tables under one folder, addressed by key.

    A table is what its commits add up to: each is a small file that names one written folder, which
    replaces all before it or is appended to them.  Commits are ordered by a number and a random
    suffix, so two writers never make the same file and neither has to read what the other wrote;
    of two at the same time either may count as the earlier.  One that lacks its last line was cut
    short and counts for nothing.  Writing happens before committing: until then readers
    see the table as it was.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _files(self, *parts: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _commits(self, key: str) -> list[tuple[str, str, str]]:
        """(name, kind, folder) of the complete commits in their order."""
        where, files = self._files(key, COMMITS)
        if not files.exists(where):
            return []
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString
        found = []
        for path in (status.getPath() for status in files.listStatus(where)):
            try:
                stream = files.open(path)
            except Py4JJavaError:
                if files.exists(path):
                    raise
                continue  # another writer has just cleaned it away
            try:
                lines = text(stream, "UTF-8").split("\n")
            finally:
                stream.close()
            if lines[2:] == [COMPLETE]:
                found.append((path.getName(), *lines[:2]))
        return sorted(found)

    def _commit(self, key: str, folder: str, kind: str) -> str:
        """Count the folder in from now on; the commit's name."""
        numbers = [int(name.split("-")[0]) for name, *_ in self._commits(key)]
        name = f"{max(numbers, default=0) + 1:012d}-{uuid.uuid4().hex}"
        where, files = self._files(key, COMMITS, name)
        stream = files.create(where, False)
        try:
            stream.write(bytearray("\n".join([kind, folder, COMPLETE]).encode()))
        finally:
            stream.close()
        return name

    def _write(self, df: DataFrame, key: str, partition_by: str | None) -> str:
        folder = f"{uuid.uuid4().hex}.parquet"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.folder}/{key}/{folder}")
        return folder

    def save(self, df: DataFrame, key: str, partition_by: str | None = None) -> None:
        """Write the table, replacing what was stored under the key.

        The frame may read the table it replaces, and a failing write changes nothing.  What the table
        was before stays for frames still reading it; folders of older commits are removed, but
        nothing that no commit names, as another writer may be at it.
        """
        self._clean(key, self._commit(key, self._write(df, key, partition_by), "replace"))

    def append(self, df: DataFrame, key: str, partition_by: str | None = None) -> None:
        """Add rows to what is stored under the key, without reading or rewriting it."""
        self._commit(key, self._write(df, key, partition_by), "append")

    def _clean(self, key: str, last: str) -> None:
        """Remove commits, and their folders, before the last replacement that comes before `last`."""
        before = [c for c in self._commits(key) if c[0] < last]
        replaced = [i for i, (_, kind, _) in enumerate(before) if kind == "replace"]
        for name, _, folder in before[: replaced[-1]] if replaced else []:
            for parts in ((key, COMMITS, name), (key, folder)):
                where, files = self._files(*parts)
                files.delete(where, True)

    def paths(self, key: str) -> list[str]:
        """The folders that make up the table."""
        folders: list[str] = []
        for _, kind, folder in self._commits(key):
            folders = [*(folders if kind == "append" else []), f"{self.folder}/{key}/{folder}"]
        return folders

    def load(self, key: str) -> DataFrame:
        paths = self.paths(key)
        if not paths:
            raise KeyError(f"no table {key!r} in {self.folder}")
        # One by one, so that partition folders below each of them are found.
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.spark.read.parquet(path) for path in paths])

    def exists(self, key: str) -> bool:
        return bool(self.paths(key))

    def describe(self, key: str) -> DataFrame:
        """One row: column names, row count, size in MB.

        The count reads no columns, and sizes come from the file listing alone.
        """
        table = self.load(key)
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(self.paths(key))
        )
        size = files.agg((F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024)).alias("mb")).scalar()
        return table.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.array(*[F.lit(c) for c in table.columns]).alias("columns"),
            "num_rows",
            size.alias("file_size_mb"),
        )

    def metadata(self, key: str) -> dict:
        """The same as a dictionary; empty if there is no such table."""
        return self.describe(key).first().asDict() if self.exists(key) else {}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """Nested columns stay nested; NULL fields are written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_profile_csv(profiles: DataFrame, path: str) -> None:
    """Identity, text, size and centroid of each cluster."""
    write_csv(profiles.select("cluster_id", "label", "description", "size", "centroid.*"), path)
