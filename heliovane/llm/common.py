"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A-Z become a-z, every other ASCII character that is no letter or digit becomes a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: A-Z become a-z, nothing else changes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_and_text(df: DataFrame, key: str, text: str, carry: bool = False) -> DataFrame:
    """Only the two columns an operator reads, so other columns can have any name.

    With `carry` the whole row comes along as one struct column, `row`.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")] if carry else []
    return df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), *kept)


def crc_remainder(key: Column, n: int) -> Column:
    """The CRC-32 of the key as text, modulo n; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % n, F.lit(-1))


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time; null is empty."""
    large = pa.types.is_large_string(column.type)
    for value in column.cast(pa.large_binary() if large else pa.binary()):
        yield value.as_py() or b""


def folded_words(raw: bytes) -> list[bytes]:
    """Words of letters and digits, A-Z in lower case; any non-ASCII character belongs to a word."""
    return raw.translate(FOLD).split()


def map_texts(
    df: DataFrame, key: str, text: str, start: Callable[[], Callable[[list[bytes]], list[pa.Array]]], ddl: str, carry: bool = False
) -> DataFrame:
    """doc_id and the columns that a function makes of each Arrow batch's texts.

    `start` is called once per task and returns that function.  Rows keep their order and
    number, nothing is shuffled, and a task holds one batch at a time.
    """
    rows = key_and_text(df, key, text, carry)
    head = [T.StructField("doc_id", T.LongType()), *([rows.schema["row"]] if carry else [])]
    fields = T.StructType.fromDDL(ddl).fields
    names = [f.name for f in head + fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            kept = [batch.column("key"), *([batch.column("row")] if carry else [])]
            yield pa.RecordBatch.from_arrays(kept + make(list(raw_texts(batch.column("text")))), names=names)

    return rows.mapInArrow(run, T.StructType(head + fields))


def columns(rows: Iterable[tuple], *types: pa.DataType) -> list[pa.Array]:
    """Arrow columns of a list of tuples."""
    rows = list(rows)
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]


class Memo(dict):
    """A dictionary that computes what it lacks and holds at most `limit` keys.

    When half of that is new, the older half is dropped; what is still in use comes back from
    it without being computed.  Keys longer than `longest` are never kept.
    """

    def __init__(self, compute: Callable, limit: int = 1 << 19, longest: int = 64):
        super().__init__()
        self.compute, self.half, self.longest = compute, limit // 2, longest
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.half:
                self.older = self.copy()
                self.clear()
            self[key] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of all words of a line of folded bytes, without a Python step per word."""

    base = 0x9E3779B97F4A7C15

    def __init__(self):
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _prepare(self, n: int) -> None:
        """Powers of the base and of its inverse modulo 2**64, for lines up to n bytes."""
        if len(self.powers) < n:
            inverse = pow(self.base, -1, 1 << 64)
            self.powers, self.inverses = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, f, np.uint64)]), dtype=np.uint64) for f in (self.base, inverse)
            )

    def __call__(self, line: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word starts, and its hash (a polynomial in its bytes, scrambled)."""
        self._prepare(len(line) + 1)
        signs = np.frombuffer(line, np.uint8)
        inside = np.concatenate([[False], signs != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(signs * self.powers[: len(signs)], dtype=np.uint64)])
        return starts, mix((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))
