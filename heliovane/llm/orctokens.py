"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are put in ascending id order (a range partitioning and a sort inside partitions), so
each file and each stripe holds a narrow range of ids.  A row is (doc_id, part, row, n_tokens,
local_start, ids): `local_start` counts the ids of the rows before it in its partition.  ORC
keeps integers as run-length stripes with minima, maxima and a Bloom filter for every
`INDEX_STRIDE` rows, so a lookup by id reads few stripes, and readers can share a file by stripe.

Encoding keeps a bounded table of distinct words per worker.  The tokenizer never joins
characters across white space, and within a word of plain Latin letters, digits and ASCII signs
its own splitting rule says where pre-tokens end; each distinct pre-token is encoded once by the
library, and any other word is handed to the library whole.

Defined cases: null is the empty text, which has the end id only; equal ids are ordered by
length and text, null ids come first; an empty table gives an empty file set and no rows;
repeated rows each get their own place; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliovane.llm.common import Memo, key_and_text, raw_texts

END_ID = 2
INDEX_STRIDE = 1000
STRIPE_BYTES = 8 << 20
ID = np.dtype("<i4")
_LATIN = "a-zß-öø-ÿ"
#: What the tokenizer's own rule makes of such a word, once it is in lower case.
_PLAIN = re.compile(f"[!-~{_LATIN}À-ÖØ-Þ]+")
#: Packing of that many ids.
_PACKED = [struct.Struct(f"<{n}i").pack for n in range(32)]
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^0-9{_LATIN}]+")


class WordEncoder:
    """Ids of white-space separated words, distinct pre-tokens encoded once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        spell = self.tokenizer.pre_tokenizer
        #: How the tokenizer spells each plain character for its model (one sign for each byte).
        self.spelling = {ord(c): "".join(p for p, _ in spell.pre_tokenize_str(c)) for c in map(chr, [*range(33, 127), *range(0xDF, 0x100)])}
        self.pretokens = Memo(self._pretoken, limit=1 << 20)
        self.words = Memo(self._word)

    def _pretoken(self, text: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.spelling))]
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else np.array(ids, ID).tobytes()

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if word.isalpha():  # letters a-z only: one pre-token
            return self.pretokens[text.lower()]
        if "<|" in text or not _PLAIN.fullmatch(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, ID).tobytes()
        return b"".join(map(self.pretokens.__getitem__, _SPLIT.findall(text.lower())))

    def encode(self, raw: bytes) -> bytes:
        """The library's ids of the whole text, as packed 32-bit integers."""
        return b"".join(map(self.words.__getitem__, raw.split()))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_ids(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every text, append the end id, and write ORC files in ascending id order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row, total, end = word_encoder(vocabulary), 0, 0, np.array([end_id], ID).tobytes()
        for batch in batches:
            packed = [known.encode(raw) + end for raw in raw_texts(batch.column("text"))]
            n, ends = len(packed), np.concatenate([[0], np.cumsum([len(p) // ID.itemsize for p in packed], dtype=np.int64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("part"), pa.array(np.arange(row, row + n, dtype=np.int64)), pa.array(np.diff(ends)), pa.array(total + ends[:-1]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), ID)))],
                names=["doc_id", "part", "row", "n_tokens", "local_start", "ids"],
            )
            row, total = row + n, total + int(ends[-1])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = key_and_text(docs, key, text).withColumn("size", F.length("text"))
    placed = rows.repartitionByRange(parts, "key", "size").sortWithinPartitions("key", "size", "text").withColumn("part", F.spark_partition_id())
    (
        placed.select("key", "text", "part")
        .mapInArrow(run, "doc_id long, part int, row long, n_tokens long, local_start long, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; filters on doc_id reach the stripes' statistics and Bloom filters."""
    return spark.read.schema("doc_id long, part int, row long, n_tokens long, local_start long, ids array<int>").orc(path)


def with_start(rows: DataFrame) -> DataFrame:
    """Add `start`, the number of ids before a document in all files.

    One total per written partition is summed up in order; documents only look theirs up.
    """
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("local_start"))


def checked_rows(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, ends = ids.flatten().to_numpy().astype("<u4"), np.asarray(ids.offsets)
            ends = ends - ends[0]
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = with_start(read_ids(spark, path)).select("doc_id", "start", "ids")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
