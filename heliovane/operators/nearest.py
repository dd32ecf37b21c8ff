"""The nearest of many centroids: a k-d tree over arrays, searched for many points side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Centroids of a leaf; pairs of a point and a node that are looked at together.
LEAF, PAIRS = 16, 1 << 15
# A node is left out only if its bound is above the best distance by more than rounding.
_MARGIN = 1e-9
_NONE = np.iinfo(np.int64).max


class Tree(NamedTuple):
    """Centroids in the order of their ids, and of the finite ones the leaves and, by node, the bounds of every axis.

    Node 1 is the root, 2i and 2i + 1 are the children of i, and the second half of the nodes are the leaves.  Leaves
    are filled up with centroids that are in others too.
    """

    centroids: np.ndarray
    places: np.ndarray
    axes: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]


def grow(centroids: np.ndarray) -> Tree:
    """The tree of (centroids, features): halved along the widest axis until leaves are left."""
    finite = np.flatnonzero(np.isfinite(centroids).all(1))
    if not len(finite):
        return Tree(centroids, np.zeros((0, LEAF), np.int64), [], [], [])
    leaves = 1 << max(0, int(np.ceil(np.log2(len(finite) / LEAF))))
    order = np.resize(finite, leaves * LEAF)
    nodes = 1
    while nodes < leaves:
        order = order.reshape(nodes, -1)
        held = centroids[order]
        widest = (held.max(1) - held.min(1)).argmax(1)
        keys = np.take_along_axis(held, widest[:, None, None], 2)[:, :, 0]
        order = np.take_along_axis(order, np.argpartition(keys, order.shape[1] // 2, axis=1), 1)
        nodes *= 2
    places = order.reshape(leaves, LEAF)
    held = centroids[places]
    low, high = np.empty((2 * leaves, held.shape[2])), np.empty((2 * leaves, held.shape[2]))
    low[leaves:], high[leaves:] = held.min(1), held.max(1)
    while leaves > 1:
        leaves //= 2
        below = slice(2 * leaves, 4 * leaves)
        low[leaves : 2 * leaves] = low[below].reshape(leaves, 2, -1).min(1)
        high[leaves : 2 * leaves] = high[below].reshape(leaves, 2, -1).max(1)
    by_axis = lambda a: [np.ascontiguousarray(a[..., i]) for i in range(a.shape[-1])]
    return Tree(centroids, places, by_axis(held), by_axis(low), by_axis(high))


class Found(NamedTuple):
    """Of every point the squared distance and the place of its nearest centroid, and how many it was compared with."""

    distance2: np.ndarray
    place: np.ndarray
    compared: np.ndarray


def search(tree: Tree, points: Sequence[np.ndarray], bound: np.ndarray) -> Found:
    """The nearest centroid of every point, one array for each axis; ties go to the lower place.

    Where none is as near as ``bound``, the place is ``_NONE``.  NaN is farther than everything.
    """
    n, leaves = len(bound), len(tree.places)
    best = np.where(np.isnan(bound), np.inf, bound)
    found = Found(best, np.full(n, _NONE), np.zeros(n, np.int64))
    finite = np.logical_and.reduce([np.isfinite(x) for x in points])
    if leaves:
        rows = np.flatnonzero(finite)
        node = np.ones(len(rows), np.int64)
        while len(node) and node[0] < leaves:
            left, right = (_gaps(tree, points, rows, child) for child in (2 * node, 2 * node + 1))
            node = 2 * node + (right < left)
        own = np.zeros(n, np.int64)
        own[rows] = node
        for i in range(0, len(rows), PAIRS):
            _visit(tree, points, rows[i : i + PAIRS], node[i : i + PAIRS] - leaves, found)
        # Node by node from the root, all points at once; those in the same entry are on one level.
        held = [(rows, np.ones(len(rows), np.int64))]
        while held:
            rows, node = held.pop()
            if len(rows) > PAIRS:
                half = len(rows) // 2
                held += [(rows[half:], node[half:]), (rows[:half], node[:half])]
                continue
            near = _gaps(tree, points, rows, node) <= best[rows] * (1 + _MARGIN) + 1e-300
            if len(node) and node[0] >= leaves:
                near &= node != own[rows]
            rows, node = rows[near], node[near]
            if not len(rows):
                continue
            if node[0] >= leaves:
                _visit(tree, points, rows, node - leaves, found)
            else:
                held.append((np.concatenate([rows, rows]), np.concatenate([2 * node, 2 * node + 1])))
    if len(tree.centroids):
        # What is left has no finite distance here: its point is not finite, or the centroids or their distances are not.
        for row in np.flatnonzero((found.place == _NONE) & ~np.isfinite(best)):
            _compare(tree, [x[row] for x in points], int(row), found)
    return found


def _gaps(tree: Tree, points: Sequence[np.ndarray], rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Squared distance of points to the bounds of nodes."""
    total = np.zeros(len(rows))
    for x, low, high in zip(points, tree.low, tree.high):
        x = x.take(rows)
        gap = np.maximum(low.take(node) - x, x - high.take(node))
        np.maximum(gap, 0, out=gap)
        gap *= gap
        total += gap
    return total


def _visit(tree: Tree, points: Sequence[np.ndarray], rows: np.ndarray, leaf: np.ndarray, found: Found) -> None:
    """Compare points with all centroids of leaves."""
    total = None
    for x, values in zip(points, tree.axes):
        gap = values.take(leaf, axis=0)
        gap -= x.take(rows)[:, None]
        gap *= gap
        total = gap if total is None else np.add(total, gap, out=total)
    nearest = total.min(1)
    place = np.where(total == nearest[:, None], tree.places.take(leaf, axis=0), _NONE).min(1)
    order = np.lexsort((place, nearest, rows))
    rows, nearest, place = rows[order], nearest[order], place[order]
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    found.compared[rows[first]] += LEAF * np.diff(first, append=len(rows))
    rows, nearest, place = rows[first], nearest[first], place[first]
    closer = (nearest < found.distance2[rows]) | (nearest == found.distance2[rows]) & (place < found.place[rows]) & np.isfinite(nearest)
    found.distance2[rows[closer]], found.place[rows[closer]] = nearest[closer], place[closer]


def _compare(tree: Tree, point: list[float], row: int, found: Found) -> None:
    """Compare one point with all centroids."""
    place, nearest = 0, np.nan
    if not np.isnan(point).any():
        with np.errstate(invalid="ignore", over="ignore"):
            total = sum((tree.centroids[:, i] - x) ** 2 for i, x in enumerate(point))
        found.compared[row] += len(total)
        if not np.isnan(total).all():
            nearest = np.nanmin(total)
            place = int(np.argmax(total == nearest))
    found.distance2[row], found.place[row] = nearest, place


def finder(centroids: DataFrame, features: Sequence[str]) -> Callable[..., Column]:
    """A column function from the features, and the best distance so far if there is one, to (distance2, cluster_id, compared).

    ``centroids`` (cluster_id, features) is bounded: it is gathered and broadcast.
    """
    rows = centroids.orderBy("cluster_id").toArrow()
    tree = grow(np.column_stack([rows.column(f).to_numpy() for f in features]).astype(float))
    known = centroids.sparkSession.sparkContext.broadcast((tree, rows.column("cluster_id").combine_chunks()))
    kind = T.StructType(
        [T.StructField("distance2", T.DoubleType()), T.StructField("cluster_id", centroids.schema["cluster_id"].dataType), T.StructField("compared", T.LongType())]
    )

    def nearest(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        tree, ids = known.value
        for *columns, bound in batches:
            found = search(tree, [c.to_numpy(zero_copy_only=False) for c in columns], bound.fill_null(np.inf).to_numpy(zero_copy_only=False))
            none = found.place == _NONE
            taken = ids.take(pa.array(np.where(none, 0, found.place), mask=none))
            yield pa.StructArray.from_arrays([pa.array(found.distance2, mask=none), taken, pa.array(found.compared)], names=kind.names)

    run = F.arrow_udf(nearest, kind)
    return lambda best=None: run(*[F.col(f) for f in features], F.lit(None).cast("double") if best is None else best)
