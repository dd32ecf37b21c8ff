"""Fitted clusterings that outlive their session: stages of Spark ML with a writer and a reader."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, MLWritable
from pyspark.sql import DataFrame, SparkSession

from heliovane.operators.features import Scaling
from heliovane.operators.kmeans import ClusterModel

_HERE = Params._dummy()


class ClusterLabels(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the cluster id of a fitted model; what was fitted are its params, so it is stored with any pipeline.

    Numbers are stored as their shortest exact text: a loaded model labels as the saved one did.
    """

    rows = Param(_HERE, "rows", "rows of the table the scaling was fitted on", TypeConverters.toInt)
    features = Param(_HERE, "features", "feature columns in the order of the centers' values", TypeConverters.toListString)
    medians = Param(_HERE, "medians", "value that replaces a missing one, by feature", TypeConverters.toListFloat)
    means = Param(_HERE, "means", "mean by feature", TypeConverters.toListFloat)
    deviations = Param(_HERE, "deviations", "population deviation by feature", TypeConverters.toListFloat)
    centers = Param(_HERE, "centers", "scaled centers in id order", TypeConverters.toList)
    inertia = Param(_HERE, "inertia", "the fit's inertia", TypeConverters.toFloat)
    outputCol = Param(_HERE, "outputCol", "column of the cluster id", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, rows=0, features=(), medians=(), means=(), deviations=(), centers=(), inertia=0.0, outputCol="cluster_id"):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, model: ClusterModel, out: str = "cluster_id") -> ClusterLabels:
        s = model.scaling
        return cls(
            rows=s.rows, features=list(s.features), medians=list(s.medians), means=list(s.means), deviations=list(s.deviations),
            centers=[list(c) for c in model.centers], inertia=model.inertia, outputCol=out,
        )

    def model(self) -> ClusterModel:
        value = self.getOrDefault
        fitted = [tuple(value(p)) for p in (self.features, self.medians, self.means, self.deviations)]
        return ClusterModel(Scaling(value(self.rows), *fitted), tuple(map(tuple, value(self.centers))), value(self.inertia))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model().labels(dataset, self.getOrDefault(self.outputCol))


def save_model(model, path: str, overwrite: bool = False) -> None:
    """Store a fitted clustering: a `ClusterModel`, or a user's own stage that Spark ML can write."""
    stage = ClusterLabels.of(model) if isinstance(model, ClusterModel) else model
    if not isinstance(stage, MLWritable):
        raise TypeError(f"{type(model).__name__} is neither a ClusterModel nor a writable stage of Spark ML")
    writer = stage.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(spark: SparkSession, path: str):
    """What `save_model` stored: a `ClusterModel` again, or the user's stage."""
    stage = DefaultParamsReader.loadParamsInstance(path, spark)
    return stage.model() if type(stage) is ClusterLabels else stage
