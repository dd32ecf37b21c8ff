"""Toxicity from two class-conditional Kneser-Ney models of how words are spelled.

Every word is read as signs between boundaries; a model of order n predicts each sign and the
closing boundary.  Each class has its own n-gram counts, discounted absolutely; the mass so won
goes to the lower orders, which both classes share and which are Kneser-Ney continuation counts
(in how many contexts a sign was seen, not how often).  So an expression rare in one class is
smoothed by what spelling in general is like, and the two models differ only where the class
counts do.

Even a toxic text consists mostly of ordinary words.  So the toxic likelihood of a word is the
toxic model's with weight `SHARE` and the ordinary model's with the rest: words that the two
models spell about equally well, in whatever language, move the sum little.  A text's statistic
is the difference of its log-likelihoods, divided by its length in words.

`fit` uses order `LONG`, so that a beginning or ending of several letters which many otherwise
different words share is told from those that differ in a letter; order 4 can't.  The alphabet has
`SIGNS` signs (boundary, a-z, one digit, other letters folded into 20).

All n-grams of all labelled texts count, in both classes.  Nothing that grows with them is collected:
distinct words are counted and dealt by their beginning into slices; a slice's n-grams are dealt by the
`LOW` signs before their last into blocks.  A block holds all n-grams that share a context of `LOW` signs or
more, so it works out their probabilities alone but for those after shorter contexts, a table of fixed
size.  The values go back to the slices, which make of them one difference for each word (in units of
1 / `UNIT`, so that sums don't depend on their order).  A word that makes up a `FREQUENT`-th or more of all words is
broadcast (there are at most `FREQUENT`), any other meets its difference in a join.

The statistic becomes a probability by a logistic curve.  It is fitted on statistics that each
half of the learned documents gets from a model of the other half, counted into narrow bins.

Defined cases: null, empty and wordless texts have statistic 0 and that score; labels are one
per id (toxic if any repetition is), null labels and ids are not learned from; without both
classes in the learned rows every score is the share of toxic labels (0 without any label);
repeated documents count each time; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovane.llm.common import folded_words, key_and_text, mix, raw_texts
from heliovane.session import cleared, settle

SIGNS = 48
ORDER = 4
LONG = 10  # SIGNS**LONG is below 2**63
DISCOUNT = 0.75
SHARE = 0.005
BIN = 0.002
THRESHOLD = 0.3
MARKS = 1 << 26
#: Signs before the last that n-grams of a block share.
LOW = 3
#: Distinct words of a slice, and how much of their beginning they share.
SLICE, BEGINNING = 1 << 15, 5
FREQUENT = 1 << 23
UNIT = 1 << 32
#: Distinct words that a task counts before it sends them on.
HELD = 1 << 18
#: How often a word or n-gram occurs in each half of the learned texts, by class.
TALLIES = ("ordinary_0", "toxic_0", "ordinary_1", "toxic_1")
#: The columns of TALLIES that a model learns from: all, the first half, the second.
WHOLE, PARTS = [(0, 1, 2, 3)], [(0, 1), (2, 3)]


def _alphabet() -> np.ndarray:
    """The sign of every code point: 0 boundary, 1-26 letters, 27 digits, others folded by a hash."""
    points = np.arange(0x110000, dtype=np.uint64)
    for point in range(0x80, 0x600):
        low = chr(point).lower()
        points[point] = ord(low[0])
    signs = (28 + ((points * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(SIGNS - 28))).astype(np.uint8)
    signs[:128] = 0
    signs[48:58] = 27
    signs[97:123] = np.arange(1, 27)
    return signs


_SIGN = _alphabet()


def grams(words: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram codes of all words in a row, and where each word's codes begin."""
    line = b" ".join(words) + b" "
    signs = _SIGN[np.frombuffer(line.decode().encode("utf-32-le"), np.uint32)].astype(np.int64)
    ends = np.flatnonzero(signs == 0)
    begins = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(signs)) - np.repeat(begins, ends - begins + 1)
    codes = signs.copy()
    for back in range(1, order):
        earlier = np.concatenate([np.zeros(back, np.int64), signs])[: len(signs)]
        codes += np.where(place >= back, earlier, 0) * SIGNS**back
    return codes, begins


def low_chances(n: np.ndarray) -> np.ndarray:
    """The shared probability of the last of `LOW` signs, from how many signs stand before each such n-gram (0: not seen)."""
    counts = [n]
    for length in range(LOW - 1, 0, -1):
        counts.append((counts[-1] > 0).reshape(SIGNS, SIGNS**length).sum(0))
    chance = np.full(1, 1.0 / SIGNS)
    for found in reversed(counts):
        found = found.reshape(-1, SIGNS)
        total = np.maximum(found.sum(1, keepdims=True), 1)
        below = np.resize(chance, found.size).reshape(found.shape)
        chance = (np.maximum(found - DISCOUNT, 0) / total + DISCOUNT * (found > 0).sum(1, keepdims=True) / total * below).ravel()
    return chance


def low_kinds(codes: np.ndarray) -> np.ndarray:
    """The distinct n-grams of `LOW` + 1 signs that distinct n-grams end with."""
    return np.unique(codes % SIGNS ** (LOW + 1))


@dataclass
class Spelling:
    """Log-likelihood differences (toxic minus ordinary) of n-grams, and of unseen ones by context."""

    codes: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    unseen: np.ndarray
    order: int = ORDER

    @classmethod
    def fit(cls, codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, order: int = ORDER, low: np.ndarray | None = None) -> Spelling:
        """From the counts of all distinct n-grams, or of a block of them and `low_chances` of all; codes ascending."""
        if low is None:
            low = low_chances(np.bincount(low_kinds(codes) % SIGNS**LOW, minlength=SIGNS**LOW))
        lower = cls._shared(codes, order, low)
        contexts, at = np.unique(codes // SIGNS, return_inverse=True)
        logs, spare = [], []
        for counts in (toxic.astype(float), ordinary.astype(float)):
            total = np.bincount(at, counts, len(contexts))
            kinds = np.bincount(at, counts > 0, len(contexts))
            rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            logs.append(np.log(np.maximum(counts - DISCOUNT, 0) / np.maximum(total[at], 1) + rest[at] * lower))
            spare.append(np.log(rest))
        return cls(codes, logs[0] - logs[1], contexts, spare[0] - spare[1], order)

    @staticmethod
    def _shared(codes: np.ndarray, order: int, low: np.ndarray) -> np.ndarray:
        """The shared probability of each n-gram's last sign after its shorter context, `low` where that has fewer than `LOW` signs."""
        suffixes = np.unique(codes % SIGNS**LOW)
        chance = low[suffixes]
        for length in range(LOW + 1, order):
            base = SIGNS**length
            kinds = np.unique(codes % (base * SIGNS))  # distinct left extensions of each n-gram
            grams_, n = np.unique(kinds % base, return_counts=True)
            context, at = np.unique(grams_ // SIGNS, return_inverse=True)
            total, distinct = np.bincount(at, n), np.bincount(at)
            below = chance[np.searchsorted(suffixes, grams_ % (base // SIGNS))]
            chance = np.maximum(n - DISCOUNT, 0) / total[at] + DISCOUNT * (distinct / total)[at] * below
            suffixes = grams_
        return chance[np.searchsorted(suffixes, codes % SIGNS ** (order - 1))]

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The difference of n-grams: of unseen ones that of their context, 0 where that is unseen too."""
        if not len(self.codes):
            return np.zeros(len(codes))
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        before = np.minimum(np.searchsorted(self.contexts, codes // SIGNS), len(self.contexts) - 1)
        other = np.where(self.contexts[before] == codes // SIGNS, self.unseen[before], 0.0)
        return np.where(self.codes[place] == codes, self.values[place], other)

    def differences(self, words: list[bytes]) -> np.ndarray:
        """The log-likelihood difference of each word, toxic (a mixture) minus ordinary."""
        codes, begins = grams(words, self.order)
        return mixture(np.add.reduceat(self.of(codes), begins))


def mixture(spelled: np.ndarray) -> np.ndarray:
    return np.logaddexp(np.log1p(-SHARE), np.log(SHARE) + spelled)


@dataclass
class ToxicityModel:
    """The counts of all learned words and the logistic curve over the statistic; without counts, a constant."""

    spelling: DataFrame | None
    slope: float
    offset: float
    order: int = LONG

    def scores(self, raws: list[bytes], known: dict | None = None) -> np.ndarray:
        """The scores of a few texts."""
        docs = SparkSession.active().createDataFrame([(i, raw.decode()) for i, raw in enumerate(raws)], "doc_id long, text string")
        return np.array([r["score"] for r in score(docs, self).orderBy("doc_id").collect()])

    def curve(self, statistic: Column) -> Column:
        z = F.least(F.greatest(F.lit(self.slope) * statistic + F.lit(self.offset), F.lit(-30.0)), F.lit(30.0))
        return 1 / (1 + F.exp(-z))


def logistic(x: np.ndarray, n: np.ndarray, positive: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of the most likely logistic curve over weighted points (Newton steps)."""
    scale = float(np.sqrt(np.average(x * x, weights=n))) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (positive - n * p) - ridge * n.sum() * np.array([w[0], 0.0]) / 1e3
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + np.diag([ridge * n.sum() / 1e3, 1e-6])
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def count_words(rows: DataFrame, kind: Column) -> DataFrame:
    """(word, kind, n): how often each word stands in the `text`s of a kind, summed in part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, Counter] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for kind, found in counts.items():
                columns = [pa.array(list(found), pa.binary()), pa.array(np.full(len(found), kind, np.int32)), pa.array(np.fromiter(found.values(), np.int64, len(found)))]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "kind", "n"])
            counts.clear()

        for batch in batches:
            for kind, raw in zip(batch.column("kind").to_pylist(), raw_texts(batch.column("text")), strict=True):
                counts.setdefault(kind, Counter()).update(folded_words(raw))
                if len(counts[kind]) > HELD:
                    yield from sent()
        yield from sent()

    return rows.select(kind.alias("kind"), "text").mapInArrow(run, "word binary, kind int, n long")


def learned_words(learned: DataFrame) -> DataFrame:
    return count_words(learned, F.col("half") * 2 + F.col("toxic"))


def word_table(counted: DataFrame) -> DataFrame:
    """(word, n, *TALLIES) of counts by kind: places in TALLIES, and -1 for `n`, how often the word stands in the texts to be scored."""
    sums = [F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(name) for kind, name in enumerate(("n", *TALLIES), -1)]
    return counted.groupBy("word").agg(*sums)


def _sliced(words: DataFrame) -> tuple[DataFrame, int]:
    """The words with their slice, and how many slices there are."""
    n = max(1, words.count() // SLICE)
    return words.withColumn("slice", F.pmod(F.xxhash64(F.substring("word", 1, BEGINNING)), F.lit(n)).cast("int")), n


def _coded(words: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of a slice; the place among them of every n-gram of every word; where each word's begin."""
    codes, begins = grams(words.column("word").to_pylist(), order)
    return *np.unique(codes, return_inverse=True), begins


def _tallied(words: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a slice and a row of counts for each of TALLIES."""
    codes, at, begins = _coded(words, order)
    sizes = np.diff(np.append(begins, len(at)))
    return codes, np.stack([np.bincount(at, np.repeat(words.column(c).to_numpy(), sizes), len(codes)) for c in TALLIES]).astype(np.int64)


def _by_block(codes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts n-grams side by side by block, and where each block ends."""
    block = (mix((codes // SIGNS % SIGNS**LOW).astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)
    return np.argsort(block, kind="stable"), np.cumsum(np.bincount(block, minlength=blocks))


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def gram_blocks(sliced: DataFrame, blocks: int, order: int) -> DataFrame:
    """(block, slice, codes, counts): the n-grams of each slice with their tallies, dealt into blocks."""

    def run(key: tuple, words: pa.Table) -> pa.Table:
        codes, counts = _tallied(words, order)
        places, ends = _by_block(codes, blocks)
        rows = []
        for block, at in enumerate(np.split(places, ends[:-1])):
            if len(at):
                rows.append((block, key[0].as_py(), _packed(np.diff(codes[at], prepend=0)), _packed(counts[:, at])))
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "slice", "codes", "counts"])

    return sliced.groupBy("slice").applyInArrow(run, "block int, slice int, codes binary, counts binary")


def _merged(part: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct n-grams of a block, a row of counts for each of TALLIES, and the places of every slice's n-grams."""
    codes = [np.cumsum(np.frombuffer(zlib.decompress(c), np.int64)) for c in part.column("codes").to_pylist()]
    counts = np.concatenate([np.frombuffer(zlib.decompress(c), np.int64).reshape(len(TALLIES), -1) for c in part.column("counts").to_pylist()], axis=1)
    found, at = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.stack([np.bincount(at, row, len(found)) for row in counts]).astype(np.int64)
    return found, sums, np.split(at, np.cumsum([len(c) for c in codes])[:-1])


def count_grams(learned: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, toxic, ordinary): how often each n-gram occurs in the labelled texts (half, toxic, text)."""
    sliced, slices = _sliced(word_table(learned_words(learned)))

    def run(part: pa.Table) -> pa.Table:
        codes, counts, _ = _merged(part)
        return pa.Table.from_arrays([pa.array(codes), pa.array(counts[1] + counts[3]), pa.array(counts[0] + counts[2])], names=["code", "toxic", "ordinary"])

    return gram_blocks(sliced, slices, order).groupBy("block").applyInArrow(run, "code long, toxic long, ordinary long")


def _lows(sliced: DataFrame, models: list[tuple], order: int) -> list[np.ndarray]:
    """`low_chances` of each model.  At most SIGNS ** LOW counts for each come to the driver."""

    def run(words: pa.Table) -> pa.Table:
        codes, counts = _tallied(words, order)
        kinds, at = np.unique(codes % SIGNS ** (LOW + 1), return_inverse=True)
        seen = np.zeros(len(kinds), np.int32)
        for i, which in enumerate(models):
            seen |= (np.bincount(at, counts[list(which)].sum(0), len(kinds)) > 0).astype(np.int32) << i
        return pa.Table.from_arrays([pa.array(kinds), pa.array(seen)], names=["kind", "seen"])

    kinds = sliced.groupBy("slice").applyInArrow(run, "kind long, seen int").groupBy("kind").agg(F.bit_or("seen").alias("seen"))
    sums = [F.sum(F.getbit("seen", F.lit(i)).cast("long")).alias(f"n{i}") for i in range(len(models))]
    found = kinds.groupBy((F.col("kind") % SIGNS**LOW).alias("low")).agg(*sums).toArrow()
    at = found.column("low").to_numpy()
    return [low_chances(np.bincount(at, found.column(f"n{i}").to_numpy(), SIGNS**LOW).astype(np.int64)) for i in range(len(models))]


def word_values(words: DataFrame, models: list[tuple], order: int) -> DataFrame:
    """(word, n, v0, v1, ...): the difference of every word of a settled `word_table` under each of the models.

    Models after the first only value words of learned texts; those of other words are 0.
    """
    sliced, slices = _sliced(words)
    lows = sliced.sparkSession.sparkContext.broadcast(_lows(sliced, models, order))

    def valued(part: pa.Table) -> pa.Table:
        codes, counts, places = _merged(part)
        values = []
        for which, low in zip(models, lows.value, strict=True):
            own = counts[list(which)]
            seen = own.sum(0) > 0
            fitted = Spelling.fit(codes[seen], own[1::2].sum(0)[seen], own[::2].sum(0)[seen], order, low)
            values.append(fitted.of(codes).astype(np.float32))
        learned = counts.sum(0) > 0
        blobs = []
        for at in places:
            own = learned[at]
            more = [*[v[at[own]] for v in values[1:]], own.astype(np.float32)] if len(values) > 1 else []
            blobs.append(_packed(np.concatenate([values[0][at], *more])))
        return pa.Table.from_arrays([part.column("slice").combine_chunks(), part.column("block").combine_chunks(), pa.array(blobs, pa.binary())], names=["slice", "block", "values"])

    def summed(own: pa.Table, blobs: pa.Table) -> pa.Table:
        codes, at, begins = _coded(own, order)
        places, ends = _by_block(codes, slices)
        begin = np.concatenate([[0], ends])
        values = np.zeros((len(models), len(codes)), np.float32)
        for block, blob in zip(blobs.column("block").to_pylist(), blobs.column("values").to_pylist(), strict=True):
            here, given = places[begin[block] : begin[block + 1]], np.frombuffer(zlib.decompress(blob), np.float32)
            values[0, here] = given[: len(here)]
            if len(models) > 1:
                values[1:, here[given[-len(here) :] > 0]] = given[len(here) : -len(here)].reshape(len(models) - 1, -1)
        out = [np.rint(mixture(np.add.reduceat(v[at].astype(float), begins)) * UNIT).astype(np.int64) for v in values]
        return pa.Table.from_arrays([own.column("word"), own.column("n"), *map(pa.array, out)], names=["word", "n", *[f"v{i}" for i in range(len(out))]])

    back = gram_blocks(sliced, slices, order).groupBy("block").applyInArrow(valued, "slice int, block int, values binary")
    ddl = ", ".join(["word binary, n long", *[f"v{i} long" for i in range(len(models))]])
    return sliced.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(summed, ddl)


def statistics(rows: DataFrame, values: DataFrame, *uses: str, frequent: int | None = None) -> DataFrame:
    """Of rows (key, mark, half, text), in any order: (key, mark, x0, ...), the statistics by the settled `word_values` named.

    `half` of a row stands for the name "other": the model of the other half, v1 or v2.
    """
    frequent = frequent or FREQUENT
    tokens = values.agg(F.sum("n")).first()[0] or 0
    often = values.where(F.col("n") * frequent >= tokens).drop("n").toArrow()
    names = often.column_names[1:]
    sent = rows.sparkSession.sparkContext.broadcast((often.column("word").to_pylist(), [np.append(often.column(c).to_numpy(), 0) for c in names]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = sent.value
        place, row = dict(zip(words, range(len(words)))), TaskContext.get().partitionId() << 33
        for batch in batches:
            heads, raws = batch.select(["key", "mark", "half"]), raw_texts(batch.column("text"))
            for first in range(0, len(heads), 256):
                own = heads.slice(first, 256)
                lines = [folded_words(raw) for _, raw in zip(range(len(own)), raws)]
                sizes = np.array([len(line) for line in lines])
                every = [w for line in lines for w in line]
                at = np.fromiter(map(place.get, every, repeat(-1)), np.int64, len(every))
                of = np.repeat(np.arange(len(lines)), sizes)
                half = own.column("half").to_numpy(zero_copy_only=False)
                sums = []
                for use in uses:
                    found = np.where(half[of] == 0, known[names.index("v2")][at], known[names.index("v1")][at]) if use == "other" else known[names.index(use)][at]
                    sums.append(np.add.reduceat(np.append(found, 0), np.cumsum(sizes) - sizes) * (sizes > 0))
                rare = np.flatnonzero(at < 0)
                ids = row + np.arange(len(lines))
                row += len(lines)
                # A text's own row bears a word of no text, so that it passes the join.
                kept = [pa.array(np.append(ids, ids[of[rare]])), pa.array([*[b"\0%d" % i for i in ids], *[every[i] for i in rare]], pa.binary())]
                kept += [pa.concat_arrays([own.column(c), own.column(c).take(pa.array(of[rare])) if c == "half" else pa.nulls(len(rare), own.column(c).type)]) for c in ("key", "mark", "half")]
                kept += [pa.array(np.append(x, np.zeros(len(rare), np.int64))) for x in (sizes, *sums)]
                yield pa.RecordBatch.from_arrays(kept, names=["row", "word", "key", "mark", "half", "words", *[f"s{i}" for i in range(len(uses))]])

    ddl = ", ".join(["row long, word binary, key long, mark long, half int, words long", *[f"s{i} long" for i in range(len(uses))]])
    met = rows.select("key", "mark", "half", "text").mapInArrow(run, ddl)
    rest = values.where(F.col("n") * frequent < tokens).drop("n")
    met = met.join(rest.hint("merge"), "word", "left")
    more = [F.expr("if(half = 0, v2, v1)") if use == "other" else F.col(use) for use in uses]
    sums = [F.sum(F.col(f"s{i}") + F.coalesce(v, F.lit(0))).alias(f"s{i}") for i, v in enumerate(more)]
    whole = met.groupBy("row").agg(F.max("key").alias("key"), F.max("mark").alias("mark"), F.max("half").alias("half"), F.sum("words").alias("words"), *sums)
    return whole.select("key", "mark", "half", *[F.when(F.col("words") > 0, F.col(f"s{i}") / F.lit(float(UNIT)) / F.col("words")).otherwise(0.0).alias(f"x{i}") for i in range(len(uses))])


def with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows that can have a mark: those whose `id` shares a slot of `MARKS` bits with a `label_id`, so no marked row is lost.

    The bits are at most `MARKS` / 8 bytes, whatever the number of marks, and are broadcast; the more marks, the
    more rows pass without having one.
    """
    slot = F.pmod(F.xxhash64("label_id"), F.lit(MARKS))
    bits = marks.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    own = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    place = F.bitmap_bit_position("slot")
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    packed = rows.select(F.struct("*").alias("row"), own.alias("slot"))
    near = packed.withColumn("bucket", F.bitmap_bucket_number("slot")).join(F.broadcast(bits), "bucket")
    return near.where(F.getbit(byte, (place % 8).cast("int")) == 1).select("row.*")


def _fitted(table: np.ndarray, order: int = ORDER) -> Spelling | None:
    """A model of rows (code, toxic, ordinary), summed by code; None without both classes."""
    if not len(table) or not table[:, 1].sum() or not table[:, 2].sum():
        return None
    codes, at = np.unique(table[:, 0], return_inverse=True)
    return Spelling.fit(codes, np.bincount(at, table[:, 1]), np.bincount(at, table[:, 2]), order)


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column, key: str, text: str, label_key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """The labels, one for each id; the texts (half, toxic, text) that are learned from, each moved once by id."""
    marks = labels.where(F.col(label).isNotNull() & F.col(label_key).isNotNull()).groupBy(F.col(label_key).cast("long").alias("label_id"))
    marks = marks.agg(F.max((F.col(label) != 0).cast("int")).alias("toxic"))
    rows = docs.where(learn & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    # One kind of join at every size; only texts that may be learned from move.
    met = with_marks(rows, marks).hint("merge").join(marks, F.col("id") == F.col("label_id"))
    return marks, met.select(_half("id"), "toxic", "text")


def _half(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(2)).cast("int").alias("half")


def _curve(points: DataFrame, spelling: DataFrame | None, order: int) -> ToxicityModel:
    """The model with a curve through the learned statistics (x, toxic); without counts a constant."""
    binned = points.groupBy(F.rint(F.col("x") / BIN).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).orderBy("bin").toArrow()
    x, n, toxic = (binned.column(c).to_numpy().astype(float) for c in ("bin", "n", "toxic"))
    if spelling is not None:
        slope, offset = logistic(x * BIN, n, toxic)
        if slope > 0:
            return ToxicityModel(spelling, slope, offset, order)
    prior = toxic.sum() / n.sum() if len(n) else 0.0
    return ToxicityModel(None, 0.0, float(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12))))


def _models(words: DataFrame) -> list[tuple]:
    """What to learn: all, and each half where it has words of both classes (else all); none without both classes."""
    sums = words.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in TALLIES]).first()
    if not sums[0] + sums[2] or not sums[1] + sums[3]:
        return []
    return WHOLE + [part if sums[part[0]] and sums[part[1]] else WHOLE[0] for part in PARTS]


def fit(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "toxic", order: int = LONG) -> ToxicityModel:
    """Learn from the documents that `learn` (a condition on the key) admits and that have a label."""
    with cleared() as staying:
        learned = settle(_labelled(docs, labels, learn, key, text, label_key, label)[1])
        counted = learned_words(learned)
        spelling = settle(word_table(counted.union(counted.select("word", F.lit(-1), "n"))))
        models = _models(spelling)
        points = learned.select(F.lit(0.0).alias("x"), "toxic")
        if models:
            rows = learned.select(F.lit(None).cast("long").alias("key"), F.col("toxic").cast("long").alias("mark"), "half", "text")
            points = statistics(rows, settle(word_values(spelling, models, order)), "other").select(F.col("x0").alias("x"), F.col("mark").alias("toxic"))
        model = _curve(points, spelling if models else None, order)
        staying += [spelling] if model.spelling is not None else []
    return model


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, mark, half, text): the mark is a hash of the text."""
    return key_and_text(docs, key, text).select("key", F.xxhash64("text").alias("mark"), _half("key"), "text")


def _scored(docs: DataFrame, model: ToxicityModel, found: DataFrame | None, statistic: str, key: str, text: str, threshold: float, carry: bool) -> DataFrame:
    """doc_id, score, predicted from statistics by key and mark, which equal texts of equal id share; with `carry` also the rows."""
    if found is None:
        rows = key_and_text(docs, key, text, carry).drop("text").withColumn("score", model.curve(F.lit(0.0)))
    elif carry:
        rows = key_and_text(docs, key, text, carry).select("key", F.xxhash64("text").alias("mark"), "row").alias("d")
        one = found.groupBy("key", "mark").agg(F.max(statistic).alias(statistic)).alias("f")
        rows = rows.join(one, F.col("d.key").eqNullSafe(F.col("f.key")) & (F.col("d.mark") == F.col("f.mark"))).select("d.key", "d.row", model.curve(F.col(statistic)).alias("score"))
    else:
        rows = found.select("key", model.curve(F.col(statistic)).alias("score"))
    return rows.select(F.col("key").alias("doc_id"), *(["row"] if carry else []), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """Per document: doc_id, score, predicted."""
    if model.spelling is None:
        return _scored(docs, model, None, "x0", key, text, threshold, carry)
    rows = _rows(docs, key, text)
    with cleared() as staying:
        words = model.spelling.withColumn("n", F.lit(0).cast("long"))
        words = words.union(word_table(count_words(rows, F.lit(-1)))).groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", *TALLIES)])
        values = settle(word_values(settle(words), WHOLE, model.order))
        found = settle(statistics(rows, values, "v0"))
        staying.append(found)
    return _scored(docs, model, found, "x0", key, text, threshold, carry)


def fit_and_score(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "toxic", order: int = LONG, threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """`score` of the documents by a `fit` on them: words are valued, and texts looked up, only once."""
    rows = _rows(docs, key, text)
    with cleared() as staying:
        marks, learned = _labelled(docs, labels, learn, key, text, label_key, label)
        words = settle(word_table(learned_words(learned).union(count_words(rows, F.lit(-1)))))
        models = _models(words)
        found = rows.select("key", "mark", F.lit(0.0).alias("x0"), F.lit(0.0).alias("x1"))
        if models:
            found = settle(statistics(rows, settle(word_values(words, models, order)), "v0", "other"))
            staying.append(found)
        points = found.withColumnRenamed("key", key).where(learn).join(marks, F.col(key) == F.col("label_id")).select(F.col("x1").alias("x"), "toxic")
        model = _curve(points, words if models else None, order)
    return _scored(docs, model, found if model.spelling is not None else None, "x0", key, text, threshold, carry)
