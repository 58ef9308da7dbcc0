"""Clusters and principal components of equally shaped features."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_shape(df: DataFrame, column: str, shape: str | None = None) -> None:
    """An error unless all features have one shape (a column, or the size of their values): only such can be compared."""
    found = df.select((F.col(shape) if shape else F.size(column)).alias("shape")).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"features of several shapes: {', '.join(str(r['shape']) for r in found)}")


def with_vector(df: DataFrame, column: str) -> DataFrame:
    one_shape(df, column, "shape" if "shape" in df.columns else None)
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def clusters(df: DataFrame, column: str, k: int = 6, seed: int = 0) -> DataFrame:
    """df with cluster."""
    data = with_vector(df, column)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)
    return model.transform(data).drop("features")


def nearest_centroid(df: DataFrame, column: str, centroids: list[list[float]]) -> DataFrame:
    """df with cluster: the first of the nearest given centroids."""
    def distance(c):
        return F.aggregate(F.zip_with(column, F.array(*map(F.lit, c)), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, b: a + b)

    all_ = F.array(*[distance([float(v) for v in c]) for c in centroids])
    return df.withColumn("cluster", (F.array_position(all_, F.array_min(all_)) - 1).cast("int"))


def lloyd_step(df: DataFrame, column: str, centroids: list[list[float]]) -> DataFrame:
    """cluster, n, centroid: the means of the rows nearest to each given centroid, summed where the rows are."""
    dealt = nearest_centroid(df, column, centroids).select("cluster", F.posexplode(column).alias("k", "v"))
    means = dealt.groupBy("cluster", "k").agg(F.avg(F.col("v").cast("double")).alias("v"), F.count("*").alias("n"))
    return means.groupBy("cluster").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("k", "v"))).alias("c")).select("cluster", "n", F.col("c.v").alias("centroid"))


def components(df: DataFrame, column: str, k: int = 3) -> DataFrame:
    """df with pc1..pck, centred; the largest loading of each component is positive."""
    data = with_vector(df, column)
    model = PCA(k=k, inputCol="features", outputCol="pcs").fit(data)
    loadings, mean = model.pc.toArray(), data.agg(Summarizer.mean(F.col("features"))).first()[0].toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] > 0 else -1.0 for j in range(k)]
    shift = mean @ loadings
    out = model.transform(data).withColumn("pcs", vector_to_array("pcs"))
    return out.select(*df.columns, *[((F.get("pcs", j) - float(shift[j])) * signs[j]).alias(f"pc{j + 1}") for j in range(k)])


def analysis_frame(df: DataFrame, label: str, column: str, k: int = 6, seed: int = 0) -> DataFrame:
    """class, cluster and the components of the one-, two- and three-component views."""
    out = components(clusters(df, column, k, seed), column, 3)
    one, two, three = (F.col(f"pc{j}") for j in (1, 2, 3))
    return out.select(F.col(label).alias("class"), "cluster", one.alias("pc1_1d"), one.alias("pc1_2d"), two.alias("pc2_2d"), one.alias("pc1_3d"), two.alias("pc2_3d"), three.alias("pc3_3d"))
