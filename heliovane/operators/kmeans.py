"""K-Means on standardised features, assignment to given centroids, inertia."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.operators.features import Scaling, feature_columns, fit_scaling
from heliovane.operators.nearest import finder
from heliovane.schema import DEFAULT_SEED, MEAN_COLUMNS
from heliovane.session import cleared, settle

# About how many centroids one pass over the points compares them with in an array.
CENTROIDS = 1 << 16


def squared_distance(features: Sequence[str], center: Column) -> Column:
    """Squared Euclidean distance from feature columns to a struct of the same names."""
    parts = [(F.col(f) - center[f]) * (F.col(f) - center[f]) for f in features]
    return reduce(lambda a, b: a + b, parts)


def _nearest(features: Sequence[str], centers: Column) -> Column:
    """Struct (distance2, cluster_id) of the closest entry; ties go to the lower id."""
    return F.array_min(
        F.transform(
            centers,
            lambda c: F.struct(squared_distance(features, c).alias("distance2"), c["cluster_id"].alias("cluster_id")),
        )
    )


# From this many centroids on they are searched in a tree, of about so many values a pass.
GROUPED = 64
VALUES = 1 << 22


def assign_nearest(
    df: DataFrame,
    centroids: DataFrame,
    features: Sequence[str],
    at_once: int | None = None,
    grouped_from: int = GROUPED,
    compared: str | None = None,
) -> DataFrame:
    """Add ``cluster_id`` and ``distance2`` of the nearest row of a centroid table.

    The points are not shuffled.  A few centroids become an array through a scalar subquery and
    are searched in place; from ``grouped_from`` on (if all features are doubles) they are
    broadcast as a tree, most of which the best distance so far rules out; the result is the
    same.  Centroids are counted first and dealt by hash into passes of about ``at_once``
    (``CENTROIDS`` in an array, ``VALUES`` feature values in a tree); beyond one pass each further
    one is over a written table that carries the nearest so far.  ``compared`` names a column for
    how many centroids a row was compared with.  A row with a NULL feature gets NULLs.
    """
    rows = centroids.select("cluster_id", *features)
    number = rows.count()
    doubles = {kind for frame in (df, rows) for _, kind in frame.select(*features).dtypes} == {"double"}
    in_tree = number >= grouped_from and doubles
    at_once = at_once or (max(1, VALUES // len(features)) if in_tree else CENTROIDS)
    passes = max(1, -(-number // at_once))
    dealt = F.pmod(F.xxhash64("cluster_id", *features), F.lit(passes))
    known = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])
    written = settle(rows.where(known)) if in_tree else rows

    def with_nearest(to: DataFrame, block: int) -> DataFrame:
        mine = written.where(dealt == block)
        if in_tree:
            found = finder(mine, features)
            return to.withColumn("_next", F.when(known, found(F.col("_near.distance2") if block else None)))
        held = to.withColumn("_centers", mine.agg(F.sort_array(F.collect_set(F.struct("cluster_id", *features))).alias("centers")).scalar())
        plain = _nearest(features, F.col("_centers"))
        near = F.struct(plain["distance2"].alias("distance2"), plain["cluster_id"].alias("cluster_id"), F.size("_centers").cast("bigint").alias("compared"))
        return held.withColumn("_next", near).drop("_centers")

    def nearer() -> Column:
        if not in_tree:
            return F.least("_near", "_next")
        # A search that found nothing as near has a NULL distance.
        return F.when(F.col("_next.distance2").isNull(), F.col("_near")).when(F.col("_near.distance2").isNull(), F.col("_next")).otherwise(F.least("_near", "_next"))

    found = with_nearest(df, 0).withColumnRenamed("_next", "_near")
    for block in range(1, passes):
        both = with_nearest(settle(found), block)
        total = F.col("_near.compared") + F.col("_next.compared")
        found = both.withColumn("_near", nearer().withField("compared", total)).drop("_next")
    added = {"cluster_id": F.col("_near.cluster_id"), "distance2": F.col("_near.distance2")}
    if compared is not None:
        added[compared] = F.col("_near.compared")
    return found.withColumns(added).drop("_near")


def inertia(assigned: DataFrame) -> DataFrame:
    """Sum of squared distances to the own centroid."""
    return assigned.agg(F.coalesce(F.sum("distance2"), F.lit(0.0)).alias("inertia"))


def label_centroids(scaled: DataFrame, scaling: Scaling, label: str = "cluster_id") -> DataFrame:
    """Mean of the scaled features per label, in original units."""
    centers = scaled.groupBy(label).agg(*[F.avg(f).alias(f) for f in scaling.features])
    return scaling.original_columns(centers)


@dataclass(frozen=True)
class ClusterModel:
    """Fitted clusters: scaled centers in id order, the scaling, the fit's inertia."""

    scaling: Scaling
    centers: tuple[tuple[float, ...], ...]
    inertia: float

    @property
    def features(self) -> tuple[str, ...]:
        return self.scaling.features

    def label_column(self) -> Column:
        """Cluster id of a row from its scaled feature columns."""
        listed = [
            F.struct(F.lit(i).alias("cluster_id"), *[F.lit(v).alias(f) for f, v in zip(self.features, center)])
            for i, center in enumerate(self.centers)
        ]
        return _nearest(self.features, F.array(*listed))["cluster_id"]

    def labels(self, df: DataFrame, out: str = "cluster_id") -> DataFrame:
        """The frame with its cluster id added; no shuffle, other columns untouched."""
        kept = {f: F.col(f) for f in self.features}
        held = df.withColumns({f"_own_{f}": c for f, c in kept.items()})
        labelled = self.scaling.standardize(held).withColumn(out, self.label_column())
        return labelled.select(*[F.col(f"_own_{c}").alias(c) if c in kept else c for c in df.columns], out)

    def centroids(self, df: DataFrame) -> DataFrame:
        """(cluster_id, features in original units)."""
        rows = [(i, *self.scaling.original(c)) for i, c in enumerate(self.centers)]
        fields = ", ".join(f"`{f}` DOUBLE" for f in self.features)
        return df.sparkSession.createDataFrame(rows, f"cluster_id INT, {fields}")


def fit_kmeans(
    scaled: DataFrame,
    scaling: Scaling,
    k: int,
    seed: int = DEFAULT_SEED,
    n_init: int = 1,
    max_iter: int = 300,
    tol: float = 1e-4,
) -> ClusterModel:
    """Fit k clusters on an already scaled table.

    Ids follow the centers in ascending feature order, so they do not depend on the
    seed's numbering.  With ``n_init`` > 1 seeds seed, seed+1, ... are tried and the
    lowest inertia wins.  Fewer distinct points than k give fewer clusters.

    A fit ends when the squared movements of all centers add up to at most ``tol``
    (features have variance 1); MLlib limits the distance each center moves.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if k > scaling.rows:
        raise ValueError(f"{scaling.rows} points cannot form {k} clusters")
    names = list(scaling.features)
    if k == 1:
        squares = reduce(lambda a, b: a + b, [F.var_pop(f) for f in names])
        row = scaled.agg(F.count(F.lit(1)), squares, *[F.avg(f) for f in names]).first()
        return ClusterModel(scaling, (tuple(row[2:]),), float(row[0] * row[1]))
    vectors = VectorAssembler(inputCols=names, outputCol="_v").transform(scaled).select("_v")
    best = None
    for attempt in range(n_init):
        trainer = KMeans(k=k, seed=seed + attempt, maxIter=max_iter, tol=(tol / k) ** 0.5, featuresCol="_v")
        model = trainer.fit(vectors)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    centers = sorted(tuple(float(v) for v in c) for c in best.clusterCenters())
    return ClusterModel(scaling, tuple(centers), float(best.summary.trainingCost))


class Clustering(Protocol):
    """Any clustering: a fit on (rows, feature names) that returns a ClusterModel-like."""

    def fit(self, df: DataFrame, features: Sequence[str]) -> ClusterModel: ...


@dataclass(frozen=True)
class KMeansClustering:
    """The default clustering: impute, standardise, K-Means."""

    k: int = 4
    seed: int = DEFAULT_SEED
    n_init: int = 1

    def fit(self, df: DataFrame, features: Sequence[str] = ()) -> ClusterModel:
        names = list(features) or feature_columns(df, MEAN_COLUMNS)
        with cleared():
            table = settle(df.select(*names))
            scaling = fit_scaling(table, names)
            return fit_kmeans(scaling.standardize(table), scaling, self.k, self.seed, self.n_init)
