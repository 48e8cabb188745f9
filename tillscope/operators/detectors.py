"""Two more outlier detectors and the vote of several: local outlier factor, one-class margin, ensemble."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillscope.functions.columns import finite_or_zero
from tillscope.operators import cleaning, forest as forests, neighbours, ranking
from tillscope.session import materialize

# Neighbours of the local factor, reference rows, random features, descent steps.
NEIGHBOURS = 20
REFERENCE_ROWS = 2_000
RANDOM_FEATURES = 64
STEPS = 25
FEATURE_ROWS = 256  # rows whose random features are held at once: they stay in the processor's cache
_SINE = [(-1) ** j * (2 * math.pi) ** (2 * j + 1) / math.factorial(2 * j + 1) for j in range(11)]


def _scaled(df: DataFrame, columns: Sequence[str], scaler: cleaning.Scaler) -> list:
    return [(finite_or_zero(c) - F.lit(scaler.center[c])) / F.lit(scaler.scale[c]) for c in columns]


def _nearest(x: np.ndarray, reference: np.ndarray, k: int, skip_self: bool = False) -> tuple[np.ndarray, np.ndarray]:
    square = np.maximum((x**2).sum(1)[:, None] + (reference**2).sum(1)[None] - 2 * x @ reference.T, 0)
    if skip_self:
        np.fill_diagonal(square, np.inf)
    near = np.argpartition(square, min(k, square.shape[1]) - 1, axis=1)[:, :k]
    return near, np.sqrt(np.take_along_axis(square, near, 1))


@dataclass(frozen=True)
class LocalFactor:
    """Local outlier factor against a reference sample (Breunig et al. 2000; on a subsample: Zimek et al. 2013).

    The reference rows, their k-distances and densities have a fixed maximum size, so they travel to
    the tasks; with no more rows than that, the reference is the whole table.
    """

    columns: tuple[str, ...]
    scaler: cleaning.Scaler
    reference: np.ndarray
    reach: np.ndarray
    density: np.ndarray
    k: int

    def score(self, df: DataFrame, output: str) -> DataFrame:
        """Add minus the factor: lower is more unusual."""
        shared = df.sparkSession.sparkContext.broadcast((self.reference, self.reach, self.density, self.k))

        @F.pandas_udf("double")
        def factor(*features: pd.Series) -> pd.Series:
            reference, reach, density, k = shared.value
            x = np.column_stack([f.to_numpy("float64") for f in features])
            out = np.empty(len(x))
            for start in range(0, len(x), 1000):  # bounds the distance matrix
                near, distance = _nearest(x[start : start + 1000], reference, k)
                own = 1.0 / (np.maximum(distance, reach[near]).mean(1) + 1e-10)
                out[start : start + 1000] = -(density[near].mean(1) / own)
            return pd.Series(out)

        return df.withColumn(output, factor(*_scaled(df, self.columns, self.scaler)))


@dataclass(frozen=True)
class ExactLocalFactor:
    """Local outlier factor of every row against all rows of the frame it scores: exact neighbours by a
    distributed grid search (operators/neighbours.py), no sample, nothing on the driver."""

    columns: tuple[str, ...]
    scaler: cleaning.Scaler
    key: str
    k: int

    def score(self, df: DataFrame, output: str) -> DataFrame:
        """Add minus the factor: lower is more unusual (a frame of one row: -1)."""
        names = [f"_lof{i}" for i in range(len(self.columns))]
        scaled = df.select(F.col(self.key).cast("long").alias("_lof_key"), *[e.alias(n) for e, n in zip(_scaled(df, self.columns, self.scaler), names)])
        found = neighbours.local_outlier_factor(scaled, "_lof_key", names, self.k).select("_lof_key", (-F.coalesce(F.col("lof"), F.lit(1.0))).alias(output))
        return df.join(found, F.col(self.key).cast("long") == F.col("_lof_key"), "left").drop("_lof_key")


def fit_local_factor(df: DataFrame, columns: Sequence[str], key: str, scaler: cleaning.Scaler, neighbours: int = NEIGHBOURS, reference_rows: int = REFERENCE_ROWS, seed: int = 42) -> LocalFactor:
    h = F.xxhash64(F.lit(seed), F.col(key))
    sample = df.select(h.alias("_h"), F.array(*_scaled(df, columns, scaler)).alias("_x")).orderBy("_h").limit(reference_rows).toPandas()
    x = np.stack(sample._x.to_numpy())
    k = min(neighbours, max(1, len(x) - 1))
    near, distance = _nearest(x, x, k, skip_self=True)
    reach = distance.max(1)
    density = 1.0 / (np.maximum(distance, reach[near]).mean(1) + 1e-10)
    return LocalFactor(tuple(columns), scaler, x, reach, density, k)


def _cosine(turns: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """cos(2 pi turns) to about 1e-15, in ``spare``; both arrays are overwritten. Several times faster than np.cos."""
    np.rint(turns, out=spare)
    turns -= spare
    np.subtract(0.25, np.abs(turns, out=turns), out=turns)  # cos(2 pi t) = sin(2 pi (1/4 - |t|)), within a quarter turn
    square = turns * turns
    np.multiply(square, _SINE[-1], out=spare)
    for c in _SINE[-2:0:-1]:
        spare += c
        spare *= square
    spare += _SINE[0]
    spare *= turns
    return spare


def _cosine_features(x: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> Iterator[np.ndarray]:
    """cos(x directions + phases), FEATURE_ROWS rows at a time; an array is valid until the next one."""
    turn, start = directions / (2 * np.pi), phases / (2 * np.pi)
    held = np.empty((2, min(FEATURE_ROWS, len(x)), len(phases)))
    for i in range(0, len(x), FEATURE_ROWS):
        part = x[i : i + FEATURE_ROWS]
        turns, spare = held[:, : len(part)]
        np.matmul(part, turn, out=turns)
        turns += start
        yield _cosine(turns, spare)


@dataclass(frozen=True)
class OneClass:
    """One-class margin on random cosine features (Rahimi, Recht 2007) of an RBF kernel."""

    columns: tuple[str, ...]
    scaler: cleaning.Scaler
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    margin: float

    def score(self, df: DataFrame, output: str) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((self.directions, self.phases, self.weights, self.margin))

        @F.pandas_udf("double")
        def side(*features: pd.Series) -> pd.Series:
            directions, phases, weights, margin = shared.value
            x = np.column_stack([f.to_numpy("float64") for f in features])
            scaled = weights * np.sqrt(2.0 / len(phases))
            return pd.Series(np.concatenate([np.zeros(0), *(z @ scaled for z in _cosine_features(x, directions, phases))]) - margin)

        return df.withColumn(output, side(*_scaled(df, self.columns, self.scaler)))


def fit_one_class(df: DataFrame, columns: Sequence[str], scaler: cleaning.Scaler, nu: float = forests.CONTAMINATION, features: int = RANDOM_FEATURES, steps: int = STEPS, seed: int = 42) -> OneClass:
    """Subgradient descent on the primal; every step is one distributed sum over all rows."""
    rng = np.random.default_rng(seed)
    width = len(columns)
    gamma = 1.0 / width  # the inputs are scaled to unit variance
    directions = rng.normal(0, np.sqrt(2 * gamma), (width, features))
    phases = rng.uniform(0, 2 * np.pi, features)
    data = materialize(df.select(*[c.alias(f"f{i}") for i, c in enumerate(_scaled(df, columns, scaler))]))
    total = data.count()
    context = df.sparkSession.sparkContext

    def sums(weights: np.ndarray, margin: float, everything: bool) -> tuple[np.ndarray, int]:
        shared = context.broadcast((directions, phases, weights, margin))

        def partial(batches):
            d, p, w, m = shared.value
            height = np.sqrt(2.0 / len(p))
            vector, count, scaled = np.zeros(len(p)), 0, w * height
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                for z in _cosine_features(x, d, p):
                    hit = np.ones(len(z)) if everything else (z @ scaled < m).astype("float64")
                    vector, count = vector + hit @ z, count + int(hit.sum())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(p) + 1), pa.int32()), pa.array(np.append(vector * height, count))], ["place", "part"])

        rows = data.mapInArrow(partial, "place int, part double").groupBy("place").agg(F.sum("part").alias("s")).collect()
        out = np.zeros(len(phases) + 1)
        for r in rows:
            out[r["place"]] = r["s"]
        return out[:-1], int(out[-1])

    mean, _ = sums(np.zeros(features), 0.0, True)
    weights = mean / max(total, 1)  # start at the mean direction
    margin = float(weights @ weights)
    for step in range(1, steps + 1):
        pull, below = sums(weights, margin, False)
        rate = 0.5 / step
        weights = weights - rate * (weights - pull / (nu * max(total, 1)))
        margin = margin - rate * 0.1 * (below / (nu * max(total, 1)) - 1.0)
    return OneClass(tuple(columns), scaler, directions, phases, weights, margin)


@dataclass(frozen=True)
class Ensemble:
    """Fitted detectors and, per score column, the offset and range on the training rows.

    The training frame keeps its scores: they are not computed again when it is judged itself.
    """

    models: dict[str, object]
    offsets: dict[str, float]
    ranges: dict[str, tuple[float, float]]
    trained: DataFrame | None = None
    scored: DataFrame | None = None

    def decisions(self, df: DataFrame) -> DataFrame:
        """Add one decision column per detector; below 0 is an outlier."""
        if df is self.trained:
            return self.scored.withColumns({f"_d_{n}": F.col(f"_d_{n}") - F.lit(self.offsets[n]) for n in self.models})
        for name, model in self.models.items():
            df = model.score(df, f"_d_{name}").withColumn(f"_d_{name}", F.col(f"_d_{name}") - F.lit(self.offsets[name]))
        return df


def fit_ensemble(df: DataFrame, columns: Sequence[str], key: str, methods: Sequence[str] = ("isolation_forest", "lof"), contamination: float = forests.CONTAMINATION, seed: int = 42) -> Ensemble:
    scaler = cleaning.fit_scaler(df, columns, "standard", nulls_as_zero=True)
    models: dict[str, object] = {}
    for m in methods:
        if m == "isolation_forest":
            models[m] = forests.fit(df, columns, key, contamination=contamination, seed=seed)
        elif m == "lof":
            models[m] = ExactLocalFactor(tuple(columns), scaler, key, NEIGHBOURS)
        elif m == "ocsvm":
            models[m] = fit_one_class(df, columns, scaler, contamination, seed=seed)
        else:
            raise ValueError(f"unknown method: {m}")
    scored = df
    for name, model in models.items():
        scored = model.score(scored, f"_d_{name}")
    scored = materialize(scored)
    q = ranking.column_quantiles(scored, [f"_d_{n}" for n in models], [0.0, contamination, 1.0])
    offsets = {n: q[f"_d_{n}"][1] for n in models}
    return Ensemble(models, offsets, {n: (q[f"_d_{n}"][0] - offsets[n], q[f"_d_{n}"][2] - offsets[n]) for n in models}, df, scored)


def vote(df: DataFrame, names: Sequence[str], ranges: dict[str, tuple[float, float]] | None = None, voting: str = "soft") -> DataFrame:
    """Add ``prediction`` (-1/1) and ``confidence`` from decision columns ``_d_{name}``.

    Hard: sign of the summed votes, a tie counts as outlier. Soft: mean of the min-max scaled
    decisions against one half. Without ``ranges`` the minimum and maximum of this batch are used.
    """
    columns = [f"_d_{n}" for n in names]
    if voting == "hard":
        votes = sum((F.when(F.col(c) < 0, -1).otherwise(1) for c in columns[1:]), F.when(F.col(columns[0]) < 0, -1).otherwise(1))
        out = df.withColumn("_v", votes)
        return out.withColumn("prediction", F.when(F.col("_v") > 0, 1).otherwise(-1).cast("long")).withColumn("confidence", F.abs("_v") / len(columns)).drop("_v")
    if voting != "soft":
        raise ValueError(f"unknown voting: {voting}")
    if ranges is None:
        row = df.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("lo", F.min), ("hi", F.max))]).first()
        ranges = {n: (row[f"lo{i}"], row[f"hi{i}"]) for i, n in enumerate(names)}
    scaled = [(F.col(f"_d_{n}") - F.lit(ranges[n][0])) / F.lit(ranges[n][1] - ranges[n][0] + 1e-10) for n in names]
    mean = sum(scaled[1:], scaled[0]) / len(scaled)
    out = df.withColumn("_v", mean)
    return out.withColumn("prediction", F.when(F.col("_v") < 0.5, -1).otherwise(1).cast("long")).withColumn("confidence", F.abs(F.col("_v") - 0.5) * 2).drop("_v")
