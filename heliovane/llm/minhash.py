"""Document fingerprints: one-permutation MinHash with optimal densification and packed low bits.

Each 5-word shingle of a text is hashed once.  The top bits of the hash choose one of `BINS`
bins and the rest is the value; a bin keeps its smallest value.  An empty bin takes the value
of the first non-empty bin in a fixed random order of its own, the same for every text, which
makes the share of equal bins an unbiased estimate of the Jaccard similarity.  Of each value
the lowest `BITS` bits are kept; two unequal values agree in those with probability 2**-BITS,
which `likeness` takes out again.

Words are runs of letters and digits with A-Z in lower case.  A text with fewer than five words
is one shingle of all of them.

Defined cases: a null or wordless text has the fingerprint ''; two of those are alike (1), one
of them and any other text are not (0); equal texts have equal fingerprints; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliovane.llm.common import FOLD, WordHashes, columns, key_and_text, map_texts, mix

SHINGLE = 5
BINS = 256
BITS = 8
CHUNK_BYTES = 1 << 20
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class Fingerprinter:
    """Fingerprints of many texts at once; `bins` is a power of two, `bits` 1, 2, 4 or 8."""

    def __init__(self, bins: int = BINS, bits: int = BITS, shingle: int = SHINGLE, seed: int = 1):
        if bins & (bins - 1) or bins < 8 or bits not in (1, 2, 4, 8):
            raise ValueError("bins must be a power of two, at least 8, and bits 1, 2, 4 or 8")
        self.bins, self.bits, self.shingle = bins, bits, shingle
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 63, shingle, np.uint64) * np.uint64(2) + np.uint64(1)
        self.order = np.stack([rng.permutation(bins) for _ in range(bins)])
        self.hashes = WordHashes()

    def shingles(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles, and the number of the text each belongs to."""
        line = b" ".join(raws).translate(FOLD)
        starts, words = self.hashes(line)
        begins = np.cumsum([0, *(len(r) + 1 for r in raws)])
        owner = np.searchsorted(begins, starts, "right") - 1
        first = np.searchsorted(owner, np.arange(len(raws)))
        n = np.bincount(owner, minlength=len(raws))
        place = np.arange(len(words)) - first[owner]
        whole = place <= np.maximum(n[owner] - self.shingle, 0)
        at, total = np.flatnonzero(whole), np.zeros(int(whole.sum()), np.uint64)
        padded = np.concatenate([words, np.zeros(self.shingle, np.uint64)])
        for j in range(self.shingle):
            total += np.where(place[at] + j < n[owner[at]], padded[at + j], np.uint64(0)) * self.factors[j]
        return mix(total), owner[at]

    def bits_of(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(texts x bins) low bits of the densified minima, and which texts have any word."""
        out, has = np.zeros((len(raws), self.bins), np.uint8), np.zeros(len(raws), bool)
        at = 0
        while at < len(raws):
            end, size = at, 0
            while end < len(raws) and (end == at or size + len(raws[end]) <= CHUNK_BYTES):
                size += len(raws[end])
                end += 1
            hashes, owner = self.shingles(raws[at:end])
            width = np.uint64(self.bins.bit_length() - 1)
            least = np.full((end - at) * self.bins, _EMPTY)
            np.minimum.at(least, owner * self.bins + (hashes >> (np.uint64(64) - width)).astype(np.int64), hashes & (_EMPTY >> width))
            least = least.reshape(end - at, self.bins)
            full = least != _EMPTY
            has[at:end] = full.any(axis=1)
            rows, empty = np.nonzero(~full & has[at:end, None])
            for t in range(self.bins):
                if not len(rows):
                    break
                source = self.order[empty, t]
                found = full[rows, source]
                least[rows[found], empty[found]] = least[rows[found], source[found]]
                rows, empty = rows[~found], empty[~found]
            out[at:end] = (least & np.uint64((1 << self.bits) - 1)).astype(np.uint8)
            at = end
        return out, has

    def texts(self, bits: np.ndarray, has: np.ndarray) -> list[str]:
        """Fingerprints as hex, low-order bits packed side by side; '' for wordless texts."""
        flags = (bits[:, :, None] >> np.arange(self.bits - 1, -1, -1, dtype=np.uint8)) & 1 if self.bits < 8 else None
        packed = bits if flags is None else np.packbits(flags.reshape(len(bits), -1), axis=1)
        return [row.tobytes().hex() if ok else "" for row, ok in zip(packed, has, strict=True)]

    def likeness(self, a: np.ndarray, has_a: np.ndarray, b: np.ndarray, has_b: np.ndarray) -> np.ndarray:
        """Estimated Jaccard similarities, row by row, chance agreement of the kept bits taken out."""
        chance = 0.5**self.bits
        estimate = np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)
        return np.where(has_a & has_b, estimate, (has_a == has_b).astype(float))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", bins: int = BINS, bits: int = BITS, carry: bool = False) -> DataFrame:
    """Per document: doc_id, fingerprint.  No shuffle."""

    def start():
        maker = Fingerprinter(bins, bits)
        return lambda raws: [pa.array(maker.texts(*maker.bits_of(raws)), pa.string())]

    return map_texts(docs, key, text, start, "fingerprint string", carry)


def in_key_order(docs: DataFrame, key: str, text: str, piece_rows: int = 1024) -> DataFrame:
    """(piece, key, text, ahead): rows dealt into pieces of neighbouring keys, each piece in order.

    The last row of a piece, marked `ahead`, is a copy of the first row of the next one (after
    the last piece: of the first), so every row's successor is in its own piece.  Cut points
    come from key quantiles; there are at most a few for each shuffle partition.
    """
    rows = key_and_text(docs, key, text)
    spark = docs.sparkSession
    most = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(1, min(rows.count() // piece_rows, most))
    cuts = rows.agg(F.percentile_approx("key", [i / pieces for i in range(1, pieces)] or [0.5], 10 * most).alias("c")).first()["c"] or []
    splits = [-np.inf, *sorted({float(c) for c in cuts} or {0.0}), np.inf]
    numbered = rows.withColumn("as_double", F.coalesce(F.col("key").cast("double"), F.lit(float("-inf"))))
    numbered = Bucketizer(splits=splits, inputCol="as_double", outputCol="piece", handleInvalid="keep").transform(numbered)
    firsts = [
        (r["piece"], r["least"])
        for r in numbered.select("piece", "key").groupBy("piece").agg(F.when(F.count("key") == F.count(F.lit(1)), F.min("key")).alias("least")).orderBy("piece").collect()
    ]
    heads = spark.createDataFrame([(least, firsts[i - 1][0]) for i, (_, least) in enumerate(firsts)], "least long, before double")
    found = numbered.join(F.broadcast(heads), F.col("key").eqNullSafe(F.col("least")), "left")
    home = F.struct(F.col("piece").alias("piece"), F.lit(False).alias("ahead"))
    away = F.struct(F.col("before").alias("piece"), F.lit(True).alias("ahead"))
    both = found.select("key", "text", F.explode(F.when(F.col("before").isNull(), F.array(home)).otherwise(F.array(home, away))).alias("at"))
    dealt = both.select("at.piece", "at.ahead", "key", "text").repartition("piece")
    return dealt.sortWithinPartitions("piece", "ahead", "key", F.length("text"), "text")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many of the following text."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Per document, in ascending key order: its fingerprint, that of its edited text, and likenesses.

    The edited text takes its second half from the next document (after the last: the first).
    Equal keys are ordered by length and text, null keys come first.  One shuffle of the texts.
    """
    ordered = in_key_order(docs, key, text)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def compared(maker: Fingerprinter, rows: list[tuple[float, bool, int | None, str]]) -> list[tuple]:
        """Results of all rows but the last, each with the row after it."""
        pairs = [(a, b) for a, b in zip(rows[:-1], rows[1:], strict=True) if not a[1]]
        bits_, has = maker.bits_of([r[3].encode() for r in rows])
        place = [i for i, a in enumerate(rows[:-1]) if not a[1]]
        changed = [edited(a[3], b[3]) for a, b in pairs]
        raw = [c.encode() for c in changed]
        other, other_has = maker.bits_of(raw)
        mine, mine_has = bits_[place], has[place]
        after = [i + 1 for i in place]
        return list(
            zip(
                [a[2] for a, _ in pairs], [len(a[3]) for a, _ in pairs], [hashlib.sha256(r).hexdigest() for r in raw],
                maker.texts(mine, mine_has), maker.texts(other, other_has),
                maker.likeness(mine, mine_has, other, other_has).tolist(),
                maker.likeness(mine, mine_has, bits_[after], has[after]).tolist(), strict=True,
            )
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, waiting, volume = Fingerprinter(bins, bits), [], 0
        for batch in batches:
            for piece, ahead, k, t in zip(*(batch.column(i) for i in range(4)), strict=True):
                if waiting and (volume > CHUNK_BYTES or len(waiting) > 1000):
                    made, waiting, volume = waiting, waiting[-1:], 0
                    yield pa.RecordBatch.from_arrays(columns(compared(maker, made), *kinds), names=names)
                waiting.append((piece.as_py(), ahead.as_py(), k.as_py(), t.as_py() or ""))
                volume += len(waiting[-1][3])
        if len(waiting) > 1:
            yield pa.RecordBatch.from_arrays(columns(compared(maker, waiting), *kinds), names=names)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(run, schema)
