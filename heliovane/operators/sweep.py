"""Many K-Means fits over one shared scan of the points in each round."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovane.operators.features import Scaling
from heliovane.operators.kmeans import ClusterModel

#: Distinct points, those of the smallest hashes, among which starting centers are chosen.
START_POINTS = 4096


def center_sums(scaled: DataFrame, features: Sequence[str], centers: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each model's centers: points, sums of the features and squared distances of each label, from one scan.

    A task adds up its points for all models in arrays and hands on one row for each center.
    A point goes to the nearest center, the one listed first if several are.
    """
    names = list(features)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros((len(c), len(names) + 2)) for c in centers]
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in names])
            for total, own in zip(found, centers, strict=True):
                distances = np.stack([((x - c) ** 2).sum(1) for c in own], axis=1)
                label = distances.argmin(1)
                measures = [np.ones(len(x)), *x.T, distances[np.arange(len(x)), label]]
                total += np.stack([np.bincount(label, weights=m, minlength=len(own)) for m in measures], axis=1)
        rows = [(i, j, row.tolist()) for i, total in enumerate(found) for j, row in enumerate(total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
            names=["model", "label", "sums"],
        )

    parts = scaled.select(*[F.col(f).cast("double").alias(f) for f in names]).mapInArrow(add, "model int, label int, sums array<double>")
    totals = parts.groupBy("model", "label").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(len(names) + 2)]).alias("sums")).collect()
    found = [np.zeros((len(c), len(names) + 2)) for c in centers]
    for row in totals:
        found[row["model"]][row["label"]] = row["sums"]
    return [(t[:, 0], t[:, 1:-1], t[:, -1]) for t in found]


def fit_together(
    scaled: DataFrame, scaling: Scaling, starts: Sequence[Sequence[Sequence[float]]], max_iter: int = 300, tol: float = 1e-4
) -> tuple[list[ClusterModel], int]:
    """One model for each list of starting centers, and how many scans of the table all of them took.

    In a round every model that still moves is advanced by the same scan; one whose centers'
    squared movements add up to at most ``tol`` drops out, so the scans are those of the slowest
    model, and one for the final squared distances.  A center without points stays where it is.
    """
    centers = [np.array(s, float) for s in starts]
    moving = [i for i, _ in enumerate(centers) if max_iter > 0]
    scans = 0
    while moving and scans < max_iter:
        scans += 1
        sums = center_sums(scaled, scaling.features, [centers[i] for i in moving])
        going_on = []
        for i, (n, total, _) in zip(moving, sums, strict=True):
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centers[i])
            if ((moved - centers[i]) ** 2).sum() > tol:
                going_on.append(i)
            centers[i] = moved
        moving = going_on
    last = center_sums(scaled, scaling.features, centers)
    models = [ClusterModel(scaling, tuple(sorted(tuple(map(float, c)) for c in own)), float(cost.sum())) for own, (_, _, cost) in zip(centers, last, strict=True)]
    return models, scans + 1


def starting_centers(scaled: DataFrame, features: Sequence[str], settings: Sequence[tuple[int, int]], n_points: int = START_POINTS) -> list[np.ndarray]:
    """Spread out starting centers for each (k, seed): greedy k-means++ among a sample of the distinct points.

    The sample is the ``n_points`` distinct points with the smallest hashes, whatever the order of
    the table.  Fewer distinct points than k give fewer centers.
    """
    names = list(features)
    rows = scaled.select(*names).distinct().orderBy(F.xxhash64(*names), *names).limit(n_points).collect()
    sample = np.array([tuple(r) for r in rows], float)
    found = []
    for k, seed in settings:
        rng = np.random.default_rng(seed)
        chosen = [sample[rng.integers(len(sample))]]
        nearest = ((sample - chosen[0]) ** 2).sum(1)
        while len(chosen) < k and nearest.sum() > 0:
            tried = sample[rng.choice(len(sample), size=2 + int(np.log(k)), p=nearest / nearest.sum())]
            left = [np.minimum(nearest, ((sample - t) ** 2).sum(1)) for t in tried]
            best = int(np.argmin([d.sum() for d in left]))
            chosen.append(tried[best])
            nearest = left[best]
        found.append(np.array(chosen))
    return found


def fit_settings(scaled: DataFrame, scaling: Scaling, settings: Sequence[tuple[int, int]], n_init: int = 1) -> list[ClusterModel]:
    """The model of each (k, seed); with ``n_init`` > 1 the best of seeds seed, seed + 1, ... by inertia."""
    for k, _ in settings:
        if k < 1:
            raise ValueError("k must be at least 1")
        if k > scaling.rows:
            raise ValueError(f"{scaling.rows} points cannot form {k} clusters")
    tried = [(k, seed + attempt) for k, seed in settings for attempt in range(n_init)]
    models, _ = fit_together(scaled, scaling, starting_centers(scaled, scaling.features, tried))
    return [min(models[i : i + n_init], key=lambda m: m.inertia) for i in range(0, len(models), n_init)]
