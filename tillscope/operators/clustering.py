"""K-means customer segments on Spark ML: fit, choice of K, quality, centres, projection."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tillscope.functions.columns import clean_double
from tillscope.operators import cleaning, ranking
from tillscope.session import materialize

# Range of K, restarts and iterations of a fit.
K_RANGE = (2, 10)
RESTARTS = 10
MAX_ITERATIONS = 300
PARALLEL_FITS = 4
MAX_CLUSTERS = 1000


@dataclass(frozen=True)
class ClusterModel:
    """A fitted segmentation: fill values, scaling, centres, and how K was chosen."""

    columns: tuple[str, ...]
    fill: dict[str, float]
    scaler: cleaning.Scaler
    model: KMeansModel
    selection: list[tuple[int, float, float]] = field(default_factory=list)

    @property
    def k(self) -> int:
        return len(self.model.clusterCenters())

    def vectors(self, df: DataFrame) -> DataFrame:
        """Add ``_features``: filled with the training medians, scaled, assembled."""
        return _vectors(df, self.columns, self.fill, self.scaler)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``cluster``. New rows are filled and scaled with the training figures."""
        return self.model.transform(self.vectors(df)).drop("_features")

    def centers(self, spark) -> DataFrame:
        """Cluster centres in original units."""
        rows = [(i, *[float(v) * self.scaler.scale[c] + self.scaler.center[c] for c, v in zip(self.columns, center)]) for i, center in enumerate(self.model.clusterCenters())]
        return spark.createDataFrame(rows, "cluster long, " + ", ".join(f"`{c}` double" for c in self.columns))

    def selection_table(self, spark) -> DataFrame:
        """(k, inertia, silhouette) of the tried values; empty when K was given."""
        return spark.createDataFrame(self.selection, "k long, inertia double, silhouette double")


def save(model: ClusterModel, spark, path: str) -> None:
    """The Spark ML model next to a table of fill values and scaling."""
    model.model.write().overwrite().save(f"{path}/kmeans")
    rows = [(i, c, model.fill[c], model.scaler.center[c], model.scaler.scale[c]) for i, c in enumerate(model.columns)]
    spark.createDataFrame(rows, "place int, column string, fill double, center double, scale double").write.mode("overwrite").parquet(f"{path}/columns")


def load(spark, path: str) -> ClusterModel:
    rows = sorted(spark.read.parquet(f"{path}/columns").collect(), key=lambda r: r["place"])
    scaler = cleaning.Scaler("stored", {r["column"]: r["center"] for r in rows}, {r["column"]: r["scale"] for r in rows})
    return ClusterModel(tuple(r["column"] for r in rows), {r["column"]: r["fill"] for r in rows}, scaler, KMeansModel.load(f"{path}/kmeans"))


def _vectors(df: DataFrame, columns: Sequence[str], fill: dict[str, float], scaler: cleaning.Scaler) -> DataFrame:
    scaled = {f"_s_{i}": (F.coalesce(clean_double(c), F.lit(fill[c])) - F.lit(scaler.center[c])) / F.lit(scaler.scale[c]) for i, c in enumerate(columns)}
    wide = df.withColumns(scaled)
    return VectorAssembler(inputCols=list(scaled), outputCol="_features").transform(wide).drop(*scaled)


def _best_fit(data: DataFrame, k: int, restarts: int, iterations: int, seed: int, init: str) -> KMeansModel:
    def one(attempt: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + attempt, maxIter=iterations, initMode=init, featuresCol="_features", predictionCol="cluster").fit(data)

    with ThreadPoolExecutor(min(PARALLEL_FITS, restarts)) as pool:
        models = list(pool.map(one, range(restarts)))
    return min(models, key=lambda m: m.summary.trainingCost)


def silhouette(assigned: DataFrame) -> float:
    """Spark's silhouette: squared Euclidean distance, linear in the rows."""
    return ClusteringEvaluator(featuresCol="_features", predictionCol="cluster").evaluate(assigned)


def elbow(points: Sequence[tuple[int, float]]) -> int:
    """K farthest from the straight line between the first and the last point."""
    xy = np.array(points, dtype=float)
    along = xy[-1] - xy[0]
    length = float(np.hypot(*along))
    if length == 0:
        return int(xy[0, 0])
    away = np.abs(along[0] * (xy[:, 1] - xy[0, 1]) - along[1] * (xy[:, 0] - xy[0, 0])) / length
    return int(xy[int(np.argmax(away)), 0])


def fit(
    df: DataFrame,
    columns: Sequence[str],
    k: int | None = None,
    k_range: tuple[int, int] = K_RANGE,
    restarts: int = RESTARTS,
    iterations: int = MAX_ITERATIONS,
    seed: int = 42,
    scaling: str = "standard",
    init: str = "k-means||",
) -> ClusterModel:
    """Median fill, scaling, then K-means. Without ``k`` the mean of elbow and best silhouette is taken.

    The scaled vectors are written once, since every iteration of every fit reads them.
    """
    columns = list(columns)
    fill = {c: v[0] if v[0] is not None else 0.0 for c, v in ranking.column_quantiles(df, columns, [0.5]).items()}
    filled = df.select(*[F.coalesce(clean_double(c), F.lit(fill[c])).alias(c) for c in columns])
    scaler = cleaning.fit_scaler(filled, columns, scaling)
    data = materialize(_vectors(filled, columns, fill, scaler).select("_features"))
    selection: list[tuple[int, float, float]] = []
    if k is None:

        def attempt(n: int) -> tuple[int, float, float]:
            m = _best_fit(data, n, max(1, restarts // 5), iterations, seed, init)
            return n, float(m.summary.trainingCost), silhouette(m.transform(data))

        with ThreadPoolExecutor(PARALLEL_FITS) as pool:
            selection = list(pool.map(attempt, range(k_range[0], k_range[1] + 1)))
        by_silhouette = max(selection, key=lambda s: s[2])[0]
        k = int(round((elbow([s[:2] for s in selection]) + by_silhouette) / 2))
    return ClusterModel(tuple(columns), fill, scaler, _best_fit(data, k, restarts, iterations, seed, init), selection)


def spread_metrics(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Calinski-Harabasz and Davies-Bouldin of any assignment, from two aggregates over the rows.

    The first gives sizes and means per cluster, the second the distances to those means; the final
    ratio is arithmetic on one row per cluster.
    """
    xs = [clean_double(c) for c in columns]
    known = df.where(F.col(cluster).isNotNull())
    stats = known.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)])
    both = known.select(cluster, *[x.alias(f"x{i}") for i, x in enumerate(xs)]).join(F.broadcast(stats), cluster)  # one row per cluster
    square = sum(((F.col(f"x{i}") - F.col(f"m{i}")) ** 2 for i in range(len(xs))), F.lit(0.0))
    rows = both.groupBy(cluster, "n", *[f"m{i}" for i in range(len(xs))]).agg(F.sum(square).alias("ss"), F.avg(F.sqrt(square)).alias("dist")).limit(MAX_CLUSTERS + 1).collect()
    k = len(rows)
    if k > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    n = np.array([r["n"] for r in rows], float)
    m = np.array([[r[f"m{i}"] for i in range(len(xs))] for r in rows])
    within, dist = sum(r["ss"] for r in rows), np.array([r["dist"] for r in rows])
    ch = db = None
    if k > 1 and n.sum() > k:
        between = float((n[:, None] * (m - (n @ m) / n.sum()) ** 2).sum())
        ch = float(between * (n.sum() - k) / (within * (k - 1))) if within > 0 else 1.0
        gap = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(gap > 0, (dist[:, None] + dist[None]) / gap, 0.0)
        db = float(ratio.max(1).mean())
    return df.sparkSession.createDataFrame([(k, ch, db)], "n_clusters long, calinski_harabasz double, davies_bouldin double")


def quality(fitted: ClusterModel, df: DataFrame) -> DataFrame:
    """Number of clusters, inertia, silhouette and the two spread metrics, one row."""
    data = materialize(fitted.model.transform(fitted.vectors(df)).select("_features", "cluster"))
    parts = vector_to_array("_features")
    wide = data.select("cluster", *[parts[i].alias(f"f{i}") for i in range(len(fitted.columns))])
    s = silhouette(data) if fitted.k > 1 else None
    out = spread_metrics(wide, "cluster", [f"f{i}" for i in range(len(fitted.columns))])
    return out.withColumn("inertia", F.lit(float(fitted.model.summary.trainingCost) if fitted.model.hasSummary else None)).withColumn("silhouette_squared", F.lit(s))


def project(fitted: ClusterModel, df: DataFrame, components: int = 2) -> DataFrame:
    """Principal components of the scaled, centred columns; the largest loading is positive."""
    data = fitted.assign(df).withColumn("_cluster", F.col("cluster")).drop("cluster")
    vectors = fitted.vectors(data)
    parts = vector_to_array("_features")
    width = len(fitted.columns)
    mean = vectors.agg(*[F.avg(parts[i]).alias(f"m{i}") for i in range(width)]).first()
    centred = vectors.withColumns({f"_c{i}": parts[i] - F.lit(mean[i]) for i in range(width)})
    centred = VectorAssembler(inputCols=[f"_c{i}" for i in range(width)], outputCol="_centred").transform(centred)
    pca = PCA(k=components, inputCol="_centred", outputCol="_pc").fit(centred)
    loadings = pca.pc.toArray()
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, j])), j] >= 0 else -1.0 for j in range(components)]
    out = pca.transform(centred).withColumn("_pc", vector_to_array("_pc"))
    return out.select(*df.columns, *[(F.col("_pc")[j] * signs[j]).alias(f"PC{j + 1}") for j in range(components)], F.col("_cluster").cast("long").alias("cluster"))
