"""Two-dimensional coordinates for the cluster map."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METHOD = "pca"


def project_2d(vectors: DataFrame) -> DataFrame:
    """``id, x, y, method``: the first two principal components.

    The method is named in the data. Each axis is turned so that its loading of
    largest size is positive, which fixes the sign.
    """
    ready = vectors.select("id", array_to_vector("embedding").alias("features"))
    model = PCA(k=2, inputCol="features", outputCol="axes").fit(ready)
    loadings = model.pc.toArray()
    turn = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    axes = vector_to_array("axes")
    return model.transform(ready).select(
        "id",
        (F.get(axes, F.lit(0)) * turn[0]).alias("x"),
        (F.get(axes, F.lit(1)) * turn[1]).alias("y"),
        F.lit(METHOD).alias("method"),
    )
