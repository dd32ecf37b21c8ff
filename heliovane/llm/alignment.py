"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes.

A is a byte-level BPE over a space and the text, B a SentencePiece model that puts the space itself.
Both give their tokens' bytes, so byte offsets where tokens of both end cut a text into groups, and
an A token is linked to each B token whose bytes overlap its own.

Neither tokenizer joins characters over a space that follows something else than white space: A starts
a pre-token there and pieces of B hold markers at their start only.  So a text is cut at such
spaces, each distinct chunk is tokenized and aligned once per worker (`common.Memo`), and a text's
tokens, groups and links are those of its chunks.

How many documents hold a linked pair of ids is known once all are aligned.  So the texts are read once:
a task writes each document's distinct pairs, in 4 bytes each, and the counts of its own distinct
pairs to the shared folder.  The pairs get a minimal perfect hash (built in Spark by shards of at most
`SHARD_KEYS` or so), every task adds its counts into dense vectors indexed by it, and these are summed
slice by slice.  Then the documents' pairs are read back and looked up, each checked
against the key at its index.  Hash, keys and counts are broadcast, so they hold at most
`DENSE_KEYS` pairs: those in the most documents.  Pairs beyond them travel once for each document
that holds them and meet their counts in a join; none of them can be a hot key, as each is in at most
a `DENSE_KEYS`-th of all (document, pair) rows.

Defined cases: null and empty texts, and texts whose tokens do not spell the space and the text (one
with U+2581, which B reads as a space), have no tokens: zeros, and '' for the groups.  Special
tokens' strings are plain text.  Repeated rows count as documents of their own; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
import hashlib
from itertools import chain, repeat
import json
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
import tiktoken

from heliovane.llm.common import Memo, key_and_text, map_texts, raw_texts
from heliovane.llm.perfecthash import PerfectHash, ShardedHash
from heliovane.llm.sentencepieces import pieces
from heliovane.session import cleared, settle

DENSE_KEYS = 1 << 22
SHARD_KEYS = 1 << 19
#: Counts in one row of a dense vector.
SLICE = 1 << 14
#: A task emits its pairs when it holds this many.
HELD_PAIRS = 1 << 21
#: Pairs that are looked up at a time.
LOOKED_UP = 1 << 18
#: How byte-level BPE splits text before merging (fixed values of this kind of tokenizer).
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CHUNK = re.compile(rb" +[^ ]*(?:(?<=[\t-\r]) +[^ ]*)*")
_MARKER = "\u2581".encode()
#: White space beyond ASCII, or what such signs begin with; it may join a run of spaces.
_WIDE_SPACE = [s.encode() for s in "\x85\xa0\u1680\u205f\u3000"] + [b"\xe2\x80"]
#: Texts of about this size together are looked up at a time.
BUNCH_BYTES = 1 << 20
#: (tokens of A, tokens of B, groups, packed links: A id * B's vocabulary + B id, groups in text form with a ';' after each)
Aligned = tuple[int, int, int, bytes, bytes]


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Tokens, groups and links of a text under a byte-level BPE (A) and a SentencePiece model (B)."""

    def __init__(self, a_path: str, b_path: str, with_text: bool = True):
        spec, signs = json.load(open(a_path, encoding="utf-8")), byte_signs()
        split = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True):
            raise ValueError("A must be a byte-level BPE that neither changes its input nor adds a space")
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(signs.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("byte-level", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
        self.a_sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.a_bytes = {i: token for token, i in ranks.items()}
        self.a_sizes[list(self.a_bytes)] = list(map(len, self.a_bytes.values()))
        model = pieces(b_path)  # refuses models whose pieces cross markers
        self.b, self.marker = model.sp, model.marker
        names = map(self.b.id_to_piece, range(self.b.vocab_size()))
        self.b_bytes = [bytes([int(n[3:-1], 16)]) if self.b.is_byte(i) else n.replace("\u2581", " ").encode() for i, n in enumerate(names)]
        self.width = len(self.b_bytes)
        self.b_sizes = np.array(list(map(len, self.b_bytes)))
        self.with_text, self.fresh = with_text, {}
        self.written = [f"{i}{sign}".encode() for i in range(max(self.width, len(self.a_sizes))) for sign in ",|;"] if with_text else []
        self.chunks = Memo(lambda c: self.fresh[c] if c in self.fresh else self._aligned([c])[0], limit=1 << 19)

    def tokens(self, chunk: bytes) -> tuple[list[int], list[int]]:
        """Ids of both for bytes that begin with a space."""
        text = chunk.decode()
        return self.a.encode_ordinary(text), self.b.encode(text[1:]) if len(text) > 1 else [self.marker]

    def spelled(self, chunk: bytes, a: list[int], b: list[int]) -> bool:
        """Whether both tokenizers' tokens have the bytes of the chunk."""
        return b"".join(map(self.a_bytes.__getitem__, a)) == chunk and b"".join(map(self.b_bytes.__getitem__, b)) == chunk

    def _aligned(self, chunks: list[bytes]) -> list[Aligned | None]:
        """Chunks of a few bytes each, tokenized in one call and aligned in whole arrays."""
        whole = b"".join(chunks)
        joins = [c[-1] > 32 for c in chunks]
        if any(s in whole for s in _WIDE_SPACE):
            joins = [ok and not any(s in c for s in _WIDE_SPACE) for c, ok in zip(chunks, joins, strict=True)]
        if len(chunks) > 1 and not all(joins):
            together = iter(self._aligned([c for c, ok in zip(chunks, joins, strict=True) if ok]))
            return [next(together) if ok else self._aligned([c])[0] for c, ok in zip(chunks, joins, strict=True)]
        if not chunks:
            return []
        a = np.array(self.a.encode_ordinary(whole.decode()), np.int64)  # a chunk's space starts a pre-token here as in its text
        b = self.b.encode([c[1:].decode() for c in chunks], num_threads=1) if chunks != [b" "] else [[self.marker]]
        n_b = [len(x) for x in b]
        b = np.fromiter(chain.from_iterable(b), np.int64, sum(n_b))
        a_ends, b_ends, chunk_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]), np.cumsum([len(c) for c in chunks])
        cuts = np.searchsorted(a_ends, chunk_ends)
        n_a = np.diff(cuts, prepend=-1).tolist()
        fits = np.array_equal(a_ends[np.minimum(cuts, len(a) - 1)], chunk_ends) and np.array_equal(b_ends[np.cumsum(n_b) - 1], chunk_ends)
        if not fits or not self.spelled(whole, a.tolist(), b.tolist()):
            return [self._aligned([c])[0] for c in chunks] if len(chunks) > 1 else [None]
        size = len(whole) + 1
        in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
        in_a[a_ends], in_b[b_ends] = True, True
        ends, both = np.flatnonzero(in_a | in_b), np.flatnonzero(in_a & in_b)
        links = a[np.searchsorted(a_ends, ends)] * self.width + b[np.searchsorted(b_ends, ends)]
        link_cuts = (np.concatenate([[0], np.searchsorted(ends, chunk_ends) + 1]) * links.itemsize).tolist()
        group_cuts = np.concatenate([[0], np.searchsorted(both, chunk_ends) + 1])
        packed, n_groups = links.tobytes(), np.diff(group_cuts).tolist()
        links = [packed[i:j] for i, j in zip(link_cuts, link_cuts[1:])]
        if not self.with_text:
            return list(zip(n_a, n_b, n_groups, links, repeat(b"")))
        # Tokens in the order of the text form: by group, A before B, each with the sign that follows it.
        side = np.concatenate([np.searchsorted(both, a_ends) * 2, np.searchsorted(both, b_ends) * 2 + 1])
        order = np.argsort(side, kind="stable")
        side = np.concatenate([side[order], [-1]])
        sign = np.where(side[1:] == side[:-1], 0, 1 + (side[:-1] & 1))
        written = list(map(self.written.__getitem__, (np.concatenate([a, b])[order] * 3 + sign).tolist()))
        cuts = np.concatenate([[0], np.cumsum(n_a) + np.cumsum(n_b)]).tolist()
        return list(zip(n_a, n_b, n_groups, links, [b"".join(written[i:j]) for i, j in zip(cuts, cuts[1:])]))

    def groups(self, chunk: bytes) -> list[tuple[list[int], list[int]]] | None:
        """The ids of both in each group of a chunk; None where the tokens' bytes are not the chunk's."""
        a, b = self.tokens(chunk)
        if not self.spelled(chunk, a, b):
            return None
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        both = np.intersect1d(a_ends, b_ends)
        a_cuts, b_cuts = ([0, *(np.searchsorted(e, both) + 1).tolist()] for e in (a_ends, b_ends))
        return [(a[i:j], b[k:m]) for i, j, k, m in zip(a_cuts, a_cuts[1:], b_cuts, b_cuts[1:])]

    def parts(self, raw: bytes) -> list[bytes]:
        """Chunks of a space and the text that both tokenizers handle apart; none for a text without tokens."""
        if not raw or _MARKER in raw:
            return []
        whole = b" " + raw
        return [whole] if any(s in raw for s in _WIDE_SPACE) else _CHUNK.findall(whole)

    def __call__(self, raws: list[bytes]) -> list[list[Aligned]]:
        """The aligned chunks of each text, in order; chunks that no text had before are aligned together."""
        parts = list(map(self.parts, raws))
        known, older = self.chunks, self.chunks.older
        fresh = [c for c in set(chain.from_iterable(parts)) if c not in known and c not in older]
        self.fresh = dict(zip(fresh, self._aligned(fresh), strict=True))
        found = [list(map(self.chunks.__getitem__, p)) for p in parts]
        return [[] if None in f else f for f in found]


def bunches(raws: Iterable[bytes]) -> Iterator[list[bytes]]:
    """Some texts at a time, and a long one alone or nearly so."""
    held, size = [], 0
    for raw in raws:
        held.append(raw)
        size += len(raw)
        if size > BUNCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str, with_text: bool = True) -> Aligner:
    return Aligner(a_path, b_path, with_text)


def vocabulary_size(b_path: str) -> int:
    return pieces(b_path).sp.vocab_size()


def links_of(chunks: list[Aligned]) -> np.ndarray:
    return np.frombuffer(b"".join([c[3] for c in chunks]), np.int64)


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and groups: an array of (a, b), the ids of both tokenizers for the same bytes."""

    def start():
        known = aligner(a_path, b_path)

        def groups(raw: bytes) -> list[dict]:
            found = [known.groups(part) for part in known.parts(raw)]
            return [] if None in found else [{"a": a, "b": b} for part in found for a, b in part]

        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        return lambda raws: [pa.array([groups(raw) for raw in raws], kind)]

    return map_texts(docs, key, text, start, "groups array<struct<a: array<int>, b: array<int>>>")


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sums of their counts."""
    pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
    return pairs, np.bincount(at, weights=np.concatenate(counts), minlength=len(pairs)).astype(np.int64)


class PairCounts:
    """The documents of each pair so far, emitted as batches (pair, docs) of bounded size."""

    def __init__(self):
        self._start(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _start(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts, self.held = [keys], [counts], len(keys)

    def rest(self) -> list[pa.Array]:
        found = [pa.array(x) for x in _counted(self.keys, self.counts)]
        self._start(np.zeros(0, np.int64), np.zeros(0, np.int64))
        return found

    def add(self, distinct: list[np.ndarray]) -> Iterator[list[pa.Array]]:
        """Some documents' distinct pairs."""
        pairs, count = np.unique(np.concatenate(distinct), return_counts=True)
        self.keys.append(pairs)
        self.counts.append(count)
        self.held += len(pairs)
        if self.held > HELD_PAIRS:
            self._start(*_counted(self.keys, self.counts))
            if self.held > HELD_PAIRS // 2:
                yield self.rest()


def pair_runs(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(pair, docs): the documents of a part of a task in which a pair is linked."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = aligner(a_path, b_path, with_text=False), PairCounts()
        for batch in batches:
            for raws in bunches(raw_texts(batch.column("text"))):
                for found in held.add([np.unique(links_of(chunks)) for chunks in known(raws)]):
                    yield pa.RecordBatch.from_arrays(found, names=["pair", "docs"])
        yield pa.RecordBatch.from_arrays(held.rest(), names=["pair", "docs"])

    return docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "pair long, docs long")


#: What a document's own tokens give, then its distinct pairs in 4 or 8 bytes each and how often it links them.
_OWN = "doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string, distinct: long, pairs: binary, times: binary"


def aligned_rows(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row with `own` for each document, and the rows (pair, docs) of `pair_runs`, in one pass over the texts."""
    names, kinds = [f.split(":")[0].strip() for f in _OWN.split(",")], [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.binary(), pa.binary()]
    kind = pa.struct(list(zip(names, kinds, strict=True)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = aligner(a_path, b_path), PairCounts()
        packed = np.dtype(np.uint32 if len(known.a_sizes) * known.width <= 1 << 32 else np.int64)

        def counted(found: list[pa.Array]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*found, pa.nulls(len(found[0]), kind)], names=["pair", "docs", "own"])

        for batch in batches:
            ids = iter(batch.column("key").to_pylist())
            for raws in bunches(raw_texts(batch.column("text"))):
                texts, rows, distinct = known(raws), [], []
                for chunks in texts:
                    pairs, times = np.unique(links_of(chunks), return_counts=True)
                    distinct.append(pairs)
                    n_a, n_b, n_groups, _, written = zip(*chunks) if chunks else ((), (), (), (), ())
                    digest = hashlib.sha256(b"".join(written)[:-1]).hexdigest() if chunks else ""
                    times = times.astype(np.min_scalar_type(times.max(initial=0)))
                    rows.append((next(ids), sum(n_a), sum(n_b), sum(n_groups), digest, len(pairs), pairs.astype(packed).tobytes(), times.tobytes()))
                own = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.int64()), pa.nulls(len(own), pa.int64()), own], names=["pair", "docs", "own"])
                yield from map(counted, held.add(distinct))
        yield counted(held.rest())

    return key_and_text(docs, key, text).mapInArrow(run, f"pair long, docs long, own struct<{_OWN}>")


def _some_pairs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch's documents, of about LOOKED_UP pairs together at a time."""
    group = np.cumsum(batch.column("distinct").to_numpy()) // LOOKED_UP
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for i, n in zip(starts.tolist(), np.diff(starts, append=len(group)).tolist(), strict=True):
        yield batch.slice(i, n)


def _numbers(blobs: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The unsigned numbers of binary values with so many each."""
    found = [np.frombuffer(b.as_buffer(), f"u{len(b.as_buffer()) // n}") for b, n in zip(blobs, sizes.tolist(), strict=True) if n]
    return np.concatenate([np.zeros(0, np.int64), *[f.astype(np.int64) for f in found]])


def hashed(keys: DataFrame, n: int) -> ShardedHash:
    """A minimal perfect hash of the distinct `pair`s of a frame of n rows, its shards built in Spark."""
    shards = max(1, -(-n // SHARD_KEYS))

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = ShardedHash.shard_of(batch.column("pair").to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(shard.astype(np.int32))], names=["pair", "shard"])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            pair, shard = batch.column("pair").to_numpy(), batch.column("shard").to_numpy()
            for s in np.unique(shard):
                held.setdefault(int(s), []).append(pair[shard == s])
        built = [(s, pickle.dumps(PerfectHash(np.sort(np.concatenate(found))))) for s, found in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in built], pa.int32()), pa.array([b for _, b in built], pa.binary())], names=["shard", "hash"])

    rows = keys.mapInArrow(number, "pair long, shard int").repartition(shards, "shard").mapInArrow(build, "shard int, hash binary").collect()
    found = {r["shard"]: pickle.loads(r["hash"]) for r in rows}
    none = PerfectHash(np.zeros(0, np.int64))
    return ShardedHash([found.get(s, none) for s in range(shards)])


def dense_counts(runs: DataFrame, index: ShardedHash) -> np.ndarray:
    """The documents of each hashed pair: every task's dense vector, summed slice by slice."""
    spark, n = runs.sparkSession, len(index.keys)
    known = spark.sparkContext.broadcast(index)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in batches:
            at = known.value.find(batch.column("pair").to_numpy())
            total += np.bincount(at[at >= 0], weights=batch.column("docs").to_numpy()[at >= 0], minlength=n).astype(np.int64)
        slices = [(i, total[i : i + SLICE]) for i in range(0, n, SLICE)]
        slices = [(i // SLICE, zlib.compress(part.tobytes(), 1)) for i, part in slices if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in slices], pa.int32()), pa.array([b for _, b in slices], pa.binary())], names=["slice", "counts"])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                part = np.frombuffer(zlib.decompress(blob.as_buffer()), np.int64)
                sums[i] = sums[i] + part if i in sums else part
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["slice", "counts"])

    kind = "slice int, counts binary"
    parts = min(-(-n // SLICE), int(spark.conf.get("spark.sql.shuffle.partitions"))) or 1
    counts = np.zeros(n, np.int64)
    for row in runs.mapInArrow(add, kind).repartition(parts, "slice").mapInArrow(merge, kind).collect():
        part = np.frombuffer(row["counts"], np.int64)
        counts[row["slice"] * SLICE :][: len(part)] = part
    known.unpersist()
    return counts


def link_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(a, b, docs): every pair of ids that a document holds linked, and how many do."""
    width = vocabulary_size(b_path)
    pairs = pair_runs(docs, a_path, b_path, text).groupBy("pair").agg(F.sum("docs").alias("docs"))
    return pairs.select(F.call_function("div", F.col("pair"), F.lit(width)).cast("int").alias("a"), (F.col("pair") % width).cast("int").alias("b"), "docs")


_HEAD = "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, n_best: long, count_sum: long, groups_sha256: string"


def summarize(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", dense_keys: int = DENSE_KEYS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark, width = docs.sparkSession, vocabulary_size(b_path)
    with cleared() as staying:
        both = settle(aligned_rows(docs, a_path, b_path, key, text))
        runs = both.where("pair is not null").select("pair", "docs")
        keys, rest = settle(runs.select("pair").distinct()), None
        n = keys.count()
        if n > dense_keys:
            # Above this many documents there can be at most dense_keys pairs; the others meet their counts in a join.
            totals = settle(runs.groupBy("pair").agg(F.sum("docs").alias("docs")))
            often = totals.agg(F.sum("docs")).first()[0] // dense_keys
            keys, rest = totals.where(F.col("docs") > often), totals.where(F.col("docs") <= often)
            n = keys.count()
        index = hashed(keys.select("pair"), n)
        counts = dense_counts(runs, index)
        a_best = np.zeros(int(index.keys.max(initial=0)) // width + 1, np.int64)
        np.maximum.at(a_best, index.keys // width, counts)
        if rest is not None:
            of_a = rest.groupBy(F.call_function("div", F.col("pair"), F.lit(width)).alias("a")).agg(F.max("docs").alias("docs")).collect()
            a_best = np.concatenate([a_best, np.zeros(max([r["a"] + 1 for r in of_a] + [0]), np.int64)])
            np.maximum.at(a_best, [r["a"] for r in of_a], [r["docs"] for r in of_a])
        table = spark.sparkContext.broadcast((index, counts, a_best))

        def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (index, counts, a_best), row = table.value, TaskContext.get().partitionId() << 33
            for batch in chain.from_iterable(map(_some_pairs, batches)):
                sizes = batch.column("distinct").to_numpy()
                of = np.repeat(np.arange(len(sizes)), sizes)
                pairs, times = _numbers(batch.column("pairs"), sizes), _numbers(batch.column("times"), sizes)
                at = index.find(pairs)
                count = np.where(at >= 0, counts[at], 0) if len(counts) else np.zeros(len(at), np.int64)
                best = (count == a_best[pairs // width]) & (at >= 0) if len(pairs) else at
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[cuts]) for x in (times, times * best, times * count)]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
                head = [pa.array(sums[names.index(c) - 4]) if c in names[4:7] else batch.column(c) for c in names]
                open_, n = np.flatnonzero(at < 0), len(sizes)
                yield _rows(row + np.arange(n), pa.StructArray.from_arrays(head, names), row + of[open_], pairs[open_], times[open_])
                row += n

        own = both.where("own is not null").select("own.*")
        rows = own.mapInArrow(look_up, f"row long, pair long, times long, head struct<{_HEAD}>")
        if rest is None:
            staying.append(result := settle(rows.select("head.*")))
            return result
        rows = settle(rows)  # read twice, and the row numbers must be the same ones
        found = rows.where("pair is not null").join(rest, "pair")
        a = F.call_function("div", F.col("pair"), F.lit(width))
        bests = spark.createDataFrame([(i, int(b)) for i, b in enumerate(a_best)], "a long, best long")  # one row per id of A
        found = found.withColumn("a", a).join(bests, "a")
        sums = found.groupBy("row").agg(F.sum(F.col("docs") * F.col("times")).alias("more"), F.sum(F.expr("if(docs = best, times, 0)")).alias("more_best"))
        whole = rows.where("head is not null").join(sums, "row", "left")
        result = settle(
            whole.select("head.*", F.coalesce("more", F.lit(0)).alias("more"), F.coalesce("more_best", F.lit(0)).alias("more_best"))
            .withColumn("n_best", F.col("n_best") + F.col("more_best")).withColumn("count_sum", F.col("count_sum") + F.col("more")).drop("more", "more_best")
        )
        staying.append(result)
    return result


def _rows(row: np.ndarray, heads: pa.StructArray, rows: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    """One row with `head` for each document, and one with `pair` and `times` for each pair that still needs its count."""
    none = pa.nulls(len(heads), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([row, rows])), pa.concat_arrays([none, pa.array(pairs)]), pa.concat_arrays([none, pa.array(times)]), pa.concat_arrays([heads, pa.nulls(len(pairs), heads.type)])],
        names=["row", "pair", "times", "head"],
    )
