"""Exact Euclidean silhouette over block pairs, and an estimate from a sample of points."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliovane.session import settle

#: Tables of fewer points are measured in one task; pairs that a task measures at most, if that leaves enough tasks.
BLOCK_ROWS, TASK_PAIRS = 2048, 1 << 33
#: Numbers (features and sums by label) that a task holds of its near block.
HELD = 1 << 23
#: Pairs whose distances are worked out at a time, and of how many far points.
TILE, FAR = 1 << 17, 2048
#: From this many features on squares come from norms and products; pairs nearer than CLOSE of their norms are measured by differences.
WIDE, CLOSE = 16, 1e-5
#: Points that an estimate may measure everything against.
SAMPLED = 1 << 14

_SUMS = "labelling string, point_id bigint, own_label bigint, label bigint, distance_sum double, n_points bigint"


def _tile_distances(near: np.ndarray, far: np.ndarray, columns: list[np.ndarray], norms: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """All distances of some near points to some far ones; without norms by differences."""
    if norms is None:
        squares, difference = np.zeros((len(near), len(far))), np.empty((len(near), len(far)))
        for axis, column in enumerate(columns):
            np.subtract(near[:, axis, None], column, out=difference)
            np.multiply(difference, difference, out=difference)
            np.add(squares, difference, out=squares)
        return np.sqrt(squares, out=squares)
    both = np.add(norms[0][:, None], norms[1])
    squares = near @ far.T
    squares *= -2
    squares += both
    both *= CLOSE
    # Where little is left of the norms, rounding would show.
    row, column = np.nonzero(squares < both)
    for i in range(0, len(row), TILE // 8):
        r, c = row[i : i + TILE // 8], column[i : i + TILE // 8]
        squares[r, c] = ((near[r] - far[c]) ** 2).sum(1)
    return np.sqrt(squares, out=squares)


class _Block:
    """The near points of a task, and by labelling and label the sums of their distances to the far ones seen so far."""

    def __init__(self, batches: list[pa.RecordBatch], width: int, names: list[str]):
        self.ids = pa.concat_arrays([b.column("id") for b in batches])
        self.points, (self.labels, self.unlabelled) = _points(batches, width), _labels(batches, len(names))
        self.names, self.centre = names, None
        self.sums: list[dict[int | None, list]] = [{} for _ in names]  # label to distances and number
        self.finite = bool(np.isfinite(self.points).all())
        if width >= WIDE and self.finite:
            self.centre = self.points.mean(0)
            self.points = self.points - self.centre
            self.norms = np.einsum("ij,ij->i", self.points, self.points)

    def add(self, far: np.ndarray, labels: np.ndarray, unlabelled: np.ndarray) -> None:
        near, norms = self.points, None
        if self.centre is not None:
            moved = far - self.centre
            norms = np.einsum("ij,ij->i", moved, moved)
            if np.isfinite(norms).all() and np.isfinite(self.norms).all():
                far = moved
            else:
                near, norms = self.points + self.centre, None
        # For every labelling its labels and which far points have them, in a row.
        groups = []
        for i in range(len(self.names)):
            order = np.lexsort((labels[:, i], unlabelled[:, i]))
            own, none = labels[order, i], unlabelled[order, i]
            first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) & ~none[1:] | (none[1:] != none[:-1])]))
            groups.append((order, first, [None if none[f] else int(own[f]) for f in first], np.diff(first, append=len(own))))
        totals = [np.empty((len(near), len(seen))) for _, _, seen, _ in groups]
        columns = [np.ascontiguousarray(column) for column in far.T] if norms is None else []
        hot = [self._hot(len(far), *group) for group in groups]
        step, odd = max(1, TILE // len(far)), not (self.finite and np.isfinite(far).all())
        for start in range(0, len(near), step):
            tile = slice(start, start + step)
            distances = _tile_distances(near[tile], far, columns, None if norms is None else (self.norms[tile], norms))
            for total, one, (order, first, _, _) in zip(totals, hot, groups):
                total[tile] = np.add.reduceat(distances.take(order, axis=1), first, axis=1) if one is None else distances @ one
                if one is None and odd:  # as in a product, what is no number shows in the sums of all labels
                    total[tile] += distances.sum(1, keepdims=True) * 0
        for held, total, (_, _, seen, count) in zip(self.sums, totals, groups):
            for at, (label, n) in enumerate(zip(seen, count.tolist())):
                if label in held:
                    held[label][0] += total[:, at]
                    held[label][1] += n
                else:
                    held[label] = [total[:, at].copy(), n]

    @staticmethod
    def _hot(n: int, order: np.ndarray, first: np.ndarray, seen: list, count: np.ndarray) -> np.ndarray | None:
        """Which far point has which label, for few labels."""
        if len(seen) > 32:
            return None
        one = np.zeros((n, len(seen)))
        one[order, np.repeat(np.arange(len(seen)), count)] = 1
        return one

    def rows(self) -> Iterator[pa.RecordBatch]:
        n = len(self.ids)
        for i, (name, held) in enumerate(zip(self.names, self.sums)):
            own = pa.array(self.labels[:, i], pa.int64(), mask=self.unlabelled[:, i])
            for label, (total, count) in held.items():
                columns = [pa.repeat(pa.scalar(name), n), self.ids, own, pa.repeat(pa.scalar(label, pa.int64()), n), pa.array(total, from_pandas=True), pa.repeat(pa.scalar(count, pa.int64()), n)]
                yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in _SUMS.split(", ")])


def _points(batches: list[pa.RecordBatch], width: int) -> np.ndarray:
    return np.concatenate([b.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) for b in batches])


def _labels(batches: list[pa.RecordBatch], names: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels, and which of them are missing."""
    flat = pa.concat_arrays([b.column("labels").flatten() for b in batches])
    return flat.fill_null(0).to_numpy(zero_copy_only=False).reshape(-1, names), flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, names)


def _distance_sums(pairs: DataFrame, labellings: Sequence[str], width: int) -> DataFrame:
    """Per point and label: summed distance to that label's points, and their number.

    Of every task the near points come first, and are held; the far ones pass by.
    """
    names = list(labellings)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, block = None, [], None
        for batch in batches:
            tasks, far = batch.column("task").to_numpy(), batch.column("far").to_numpy()
            cuts = [0, *(np.flatnonzero((tasks[1:] != tasks[:-1]) | (far[1:] != far[:-1])) + 1).tolist(), len(tasks)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if tasks[start] != task:
                    if block is not None:
                        yield from block.rows()
                    task, held, block = tasks[start], [], None
                part = batch.slice(start, end - start)
                if not far[start]:
                    held.append(part)
                elif held or block is not None:  # without near points there is nothing to measure
                    if block is None:
                        block, held = _Block(held, width, names), []
                    for i in range(0, end - start, FAR):
                        some = [part.slice(i, FAR)]
                        block.add(_points(some, width), *_labels(some, len(names)))
        if block is not None:
            yield from block.rows()

    return pairs.select("task", "far", "id", "point", "labels").mapInArrow(sums, _SUMS)


def _deal(points: int, numbers: int, width: int, labels: int, block_rows: int | None) -> tuple[int, int]:
    """Into how many near blocks and far slices points are dealt: a task for every two of them.

    A task holds its block; both together are copied for each other, so about as many of each cost least.
    """
    if block_rows is not None:
        blocks = max(1, -(-points // block_rows))
        return blocks, min(blocks, -(-numbers // blocks))
    tasks = max(1, min(max(numbers, -(-points * points // TASK_PAIRS)), (-(-points // BLOCK_ROWS)) ** 2))
    slices = max(1, int((tasks * width / (width + 4 * labels)) ** 0.5))
    most = max(64, HELD // (width + 2 * labels))
    return max(-(-tasks // slices), -(-points // most)), slices


def silhouette_values(
    df: DataFrame,
    features: Sequence[str],
    labellings: Sequence[str],
    id_col: str = "point_id",
    block_rows: int | None = None,
) -> DataFrame:
    """Silhouette of every point under every labelling column: exact, no sampling.

    ``id_col`` is unique.  Points are dealt into near blocks and far slices by
    hashes of the id, so that they do not follow clusters and none is larger than the
    rest.  A task holds one block (of about ``block_rows`` points, if that is given) and
    reads one slice row by row, for all labellings at once, and only keeps per-point sums
    by label.  Rows moved: points x (blocks + slices), never points x points.
    """
    names, axes = list(labellings), list(features)
    # Written once: the table is counted and then read for both sides.
    table = settle(
        df.select(
            F.col(id_col).cast("bigint").alias("id"),
            F.array(*[F.col(f).cast("double") for f in axes]).alias("point"),
            F.array(*[F.col(c).cast("bigint") for c in names]).alias("labels"),
        )
    )
    size = table.agg(F.count(F.lit(1)), *[F.approx_count_distinct(F.get("labels", F.lit(i))) for i in range(len(names))]).first()
    blocks, slices = _deal(size[0], 4 * df.sparkSession.sparkContext.defaultParallelism, len(axes), sum(size[1:]), block_rows)
    block, slice_ = F.pmod(F.xxhash64("id"), F.lit(blocks)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(slices))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    near = table.withColumn("other", every(slices)).withColumn("task", (block * slices + F.col("other")).cast("int"))
    far = table.withColumn("other", every(blocks)).withColumn("task", (F.col("other") * slices + slice_).cast("int"))
    pairs = (
        near.withColumn("far", F.lit(0)).unionByName(far.withColumn("far", F.lit(1)))
        .repartitionById(blocks * slices, "task")
        .sortWithinPartitions("task", "far")
    )
    by_label = (
        _distance_sums(pairs, names, len(axes))
        .repartition("labelling", "point_id")
        .groupBy("labelling", "point_id", "own_label", "label")
        .agg(F.sum("distance_sum").alias("distance_sum"), F.sum("n_points").alias("n_points"))
    )
    own = F.col("label") == F.col("own_label")
    inner = F.max(F.when(own & (F.col("n_points") > 1), F.col("distance_sum") / (F.col("n_points") - 1)))
    outer = F.min(F.when(~own, F.col("distance_sum") / F.col("n_points")))
    per_point = by_label.groupBy("labelling", "point_id", "own_label").agg(inner.alias("a"), outer.alias("b"))
    widest = F.greatest("a", "b")
    # Alone in its label (a is NULL), or all distances zero: 0.  One label only: NULL.
    value = (
        F.when(F.col("b").isNull(), F.lit(None).cast("double"))
        .when(F.col("a").isNull() | (widest == 0), F.lit(0.0))
        .otherwise((F.col("b") - F.col("a")) / widest)
    )
    return per_point.select("labelling", "point_id", F.col("own_label").alias("label"), value.alias("silhouette"))


def silhouette(
    df: DataFrame,
    features: Sequence[str],
    labellings: Sequence[str],
    id_col: str = "point_id",
    block_rows: int | None = None,
) -> DataFrame:
    """Mean silhouette per labelling; NULL where the labelling has one label only."""
    return (
        silhouette_values(df, features, labellings, id_col, block_rows)
        .groupBy("labelling")
        .agg(F.avg("silhouette").alias("silhouette"))
    )


def silhouette_estimate(df: DataFrame, features: Sequence[str], label: str, id_col: str = "point_id", per_label: int = 256, at_most: int = SAMPLED) -> DataFrame:
    """An estimate of the mean silhouette with its standard error, for tables where every pair is too much work.

    One row: silhouette, standard_error, n_sampled, n_points, n_labels.  Of each label the ``per_label``
    points with the smallest md5 of their id are taken, so a sample depends on no order.  Their
    silhouettes are exact: every point meets the sample once, in the task that reads it, and a
    task hands on sums by sampled point and label.  So the work and the bytes grow with the points, not with
    their square.  The mean weighs labels by their size, and its error follows from the spread within
    the labels; a label taken whole adds none.  Points without a label are left out, a point alone in its
    label counts 0, and a table with one label or none has NULL for both numbers.  The sample, which is
    broadcast, may hold ``at_most`` points over all labels; more are refused.
    """
    if per_label < 2:
        raise ValueError("an error needs two points of each label")
    axes = list(features)
    table = settle(
        df.where(F.col(label).isNotNull()).select(
            F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.array(*[F.col(f).cast("double") for f in axes]).alias("point")
        )
    )
    sizes = {r["label"]: r["n"] for r in table.groupBy("label").agg(F.count("*").alias("n")).orderBy("label").limit(at_most + 1).collect()}
    if sum(min(n, per_label) for n in sizes.values()) > at_most:
        raise ValueError(f"{len(sizes)} labels with {per_label} points each are more than {at_most} sampled points")
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.md5(F.col("id").cast("string")), "id"))
    sample = table.withColumn("place", place).where(F.col("place") <= per_label).orderBy("label", "place").collect()
    names = {value: i for i, value in enumerate(sorted(sizes))}
    kept = table.sparkSession.sparkContext.broadcast(np.array([r["point"] for r in sample], float).reshape(len(sample), len(axes)))

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = kept.value
        total = np.zeros((len(names), len(chosen)))
        for batch in batches:
            points = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(axes))
            labels = np.array([names[v] for v in batch.column("label").to_pylist()], np.int64)
            rows = max(1, (1 << 21) // max(1, len(chosen)))
            for i in range(0, len(points), rows):
                squares = np.zeros((len(points[i : i + rows]), len(chosen)))
                for axis in range(len(axes)):
                    squares += (points[i : i + rows, axis, None] - chosen[:, axis]) ** 2
                squares, here = np.sqrt(squares), labels[i : i + rows]
                for one in np.unique(here):
                    total[one] += squares[here == one].sum(0)
        found = np.argwhere(total > 0)
        columns = [pa.array(found[:, 1].astype(np.int32)), pa.array(found[:, 0].astype(np.int32)), pa.array(total[found[:, 0], found[:, 1]])]
        yield pa.RecordBatch.from_arrays(columns, names=["chosen", "label_no", "distance"])

    distance = np.zeros((len(sample), len(names)))
    found = table.select("label", "point").mapInArrow(sums, "chosen int, label_no int, distance double")
    for row in found.groupBy("chosen", "label_no").agg(F.sum("distance").alias("distance")).toArrow().to_pylist():
        distance[row["chosen"], row["label_no"]] = row["distance"]
    count, own = np.array([sizes[v] for v in sorted(sizes)], float), np.array([names[r["label"]] for r in sample], np.int64)
    mean = error = None
    if len(names) > 1:
        rows = np.arange(len(sample))
        a = distance[rows, own] / np.maximum(count[own] - 1, 1)
        others = distance / count
        others[rows, own] = np.inf
        b = others.min(1)
        widest = np.maximum(a, b)
        values = np.where((count[own] > 1) & (widest > 0), (b - a) / np.where(widest > 0, widest, 1), 0.0)
        share, mean, error = count / count.sum(), 0.0, 0.0
        for i, n in enumerate(count):
            mine = values[own == i]
            mean += share[i] * mine.mean()
            if 1 < len(mine) < n:
                error += share[i] ** 2 * mine.var(ddof=1) / len(mine) * (1 - len(mine) / n)
        mean, error = float(mean), float(error**0.5)
    return df.sparkSession.createDataFrame(
        [(mean, error, len(sample), int(count.sum()), len(names))], "silhouette DOUBLE, standard_error DOUBLE, n_sampled BIGINT, n_points BIGINT, n_labels INT"
    )
