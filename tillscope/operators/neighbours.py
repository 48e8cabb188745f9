"""Exact k nearest neighbours of every row among all rows, and the local outlier factor on them.

Plan (two rounds, exact at any size):
1. Locations. Rows equal in all coordinates are one location: it is searched once, and of its keys only
   the k + 1 smallest can be anybody's neighbour, so heavy groups of equal rows stay linear.
2. Cells. Median cuts of the widest coordinate, in all coordinates in turn, from a hash sample of about
   SAMPLE_PER_CELL locations per cell (at most MAX_CELLS cells). The cuts only spread the work; every
   row is in a cell and the least and largest coordinates of a cell (its box) come from all its rows.
3. Radius. Inside its own cell each location takes its (k + 1)-th smallest distance: an upper bound of the
   true one (unbounded when the cell holds fewer).
4. Search. Each location goes, as a query, to every cell whose box lies within its radius; per location,
   the k + 1 nearest of all visited cells remain. Each row then leaves out its own key. Ties are broken
   by the key.

In a cell, rows and queries are put in blocks by the same median cuts; the blocks nearest to a block of
queries bound their distances, then each block of rows meets the queries that reach its box by one matrix
product, which only sorts out what is too far: the distances of what remains are computed from the differences.

LOF (Breunig et al. 2000): reach(p, o) = max(k-distance(o), d(p, o)); lrd(p) = 1 / (mean reach + 1e-10);
lof(p) = mean lrd(o) / lrd(p) over p's k neighbours, all by joins and aggregates.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillscope.session import materialize

CELL_ROWS = 8_000
MAX_CELLS = 4_096
MANY_CELLS, LARGE_CELL = 256, 4  # from so many cells on, a cell grows to so many times its rows before there are more
SAMPLE_PER_CELL = 64
BLOCK = 128
FIRST_BLOCKS = 4  # blocks of points that give a first bound
ASKED_BLOCKS = 32  # blocks of queries that meet the points together
PRODUCT_ROWS = 16_384  # queries that one matrix product takes
FOUND = "_loc long, _near array<struct<d:double,o:bigint,w:bigint>>"
_LAST = np.iinfo(np.int64).max


def _halves(x: np.ndarray) -> tuple[int, float] | None:
    """Column and value of a cut near the median of the widest column; None if all rows are equal."""
    spread = x.std(0)
    for c in np.argsort(-spread, kind="stable"):
        column = x[:, c]
        cut = np.median(column)
        if cut >= column.max():  # the upper half is one value: cut below it
            below = column[column < cut]
            if not len(below):
                continue
            cut = below.max()
        return int(c), float(cut)
    return None


def _cuts(x: np.ndarray, cells: int) -> tuple[np.ndarray, ...]:
    """A tree of median cuts with about ``cells`` leaves: column (-1: a leaf), cut, left, right, number of the leaf."""
    nodes: list[list] = [[-1, 0.0, 0, 0, 0]]
    todo, leaves = [(0, x, cells)], 0
    while todo:
        at, rows, parts = todo.pop()
        half = _halves(rows) if parts > 1 and len(rows) > 1 else None
        if half is None:
            nodes[at][4], leaves = leaves, leaves + 1
            continue
        low = rows[:, half[0]] <= half[1]
        nodes[at][:4] = [*half, len(nodes), len(nodes) + 1]
        todo += [(len(nodes), rows[low], parts - parts // 2), (len(nodes) + 1, rows[~low], parts // 2)]
        nodes += [[-1, 0.0, 0, 0, 0], [-1, 0.0, 0, 0, 0]]
    return tuple(np.array(v, t) for v, t in zip(zip(*nodes), ("int64", "float64", "int64", "int64", "int64")))


def _cell_of(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    column, cut, left, right, leaf = tree
    at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        inner = column[at] >= 0
        if not inner.any():
            return leaf[at]
        low = x[rows, np.maximum(column[at], 0)] <= cut[at]
        at = np.where(inner, np.where(low, left[at], right[at]), at)


def _blocks(x: np.ndarray) -> list[np.ndarray]:
    """Row numbers in blocks of at most BLOCK rows (more only where rows are equal), near rows together."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        half = _halves(x[rows]) if len(rows) > BLOCK else None
        if half is None:
            out += [rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK)]
            continue
        low = x[rows, half[0]] <= half[1]
        todo += [rows[~low], rows[low]]
    return out


def _box_distance(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every box."""
    out = np.zeros((len(x), len(low)))
    for c in range(x.shape[1]):
        v = x[:, c, None]
        gap = np.maximum(np.maximum(low[None, :, c] - v, v - high[None, :, c]), 0)
        out += gap * gap
    return out


class _Leaves:
    """Points in blocks with their boxes: which of them lie how near to queries, by matrix products around the centre of each block."""

    def __init__(self, points: np.ndarray):
        self.points, self.blocks = points, _blocks(points)
        self.low, self.high = (np.array([f(points[b], axis=0) for b in self.blocks]) for f in (np.min, np.max))
        self.sizes = np.array([len(b) for b in self.blocks])

    def gaps(self, queries: np.ndarray) -> np.ndarray:
        return _box_distance(queries, self.low, self.high)

    def _product(self, queries: np.ndarray, rows: np.ndarray, center: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of queries and points, and how far they can be off (per query)."""
        q, p = queries - center, self.points[rows] - center
        own, square = (q * q).sum(1), (p * p).sum(1)
        return own[:, None] + square[None] - 2 * (q @ p.T), 1e-12 * (own + square.max())

    def bound(self, queries: np.ndarray, gaps: np.ndarray, k: int) -> tuple[np.ndarray | None, bool]:
        """An upper bound of each k-th distance from the blocks nearest to all the queries (None: fewer than k points); whether these are all blocks."""
        order = np.argsort(gaps.min(0), kind="stable")
        first = order[: max(FIRST_BLOCKS, int(np.searchsorted(np.cumsum(self.sizes[order]), k)) + 1)]
        rows = np.concatenate([self.blocks[b] for b in first])
        if len(rows) < k:
            return None, len(first) == len(self.blocks)
        square, off = self._product(queries, rows, queries.mean(0))
        return np.sqrt(np.maximum(np.partition(square, k - 1, axis=1)[:, k - 1], 0) + off) * (1 + 1e-12), len(first) == len(self.blocks)

    def within(self, queries: np.ndarray, gaps: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, distance) of all pairs within the bound of the query; a block meets the queries that reach its box."""
        reach = bound**2 * (1 + 1e-12)
        block, asks = np.nonzero((gaps <= reach[:, None]).T)
        edges = np.searchsorted(block, np.arange(len(self.blocks) + 1))
        found = []
        for b in np.flatnonzero(np.diff(edges)):
            rows = self.blocks[b]
            center = (self.low[b] + self.high[b]) / 2
            for start in range(edges[b], edges[b + 1], PRODUCT_ROWS):
                q = asks[start : min(start + PRODUCT_ROWS, edges[b + 1])]
                square, off = self._product(queries[q], rows, center)
                qi, pi = np.nonzero(square <= (reach[q] + off)[:, None])
                found.append((q[qi], rows[pi]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        qi, pi = (np.concatenate(v) for v in zip(*found))
        d = np.sqrt(((queries[qi] - self.points[pi]) ** 2).sum(-1))
        ok = d <= bound[qi]
        return qi[ok], pi[ok], d[ok]


def _met(points: np.ndarray, queries: np.ndarray, radius: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By part of the queries: their numbers; pairs (place in the part, point, distance) that hold all within the radius and the k-th distance."""
    if not len(points) or not len(queries):
        return
    leaves, blocks = _Leaves(points), _blocks(queries)
    for start in range(0, len(blocks), ASKED_BLOCKS):
        part = blocks[start : start + ASKED_BLOCKS]
        gaps, bounds = [], []
        for q in part:
            gaps.append(leaves.gaps(queries[q]))
            near, _ = leaves.bound(queries[q], gaps[-1], k)
            bounds.append(radius[q] if near is None else np.minimum(radius[q], near))
        q = np.concatenate(part)
        yield q, *leaves.within(queries[q], np.concatenate(gaps), np.concatenate(bounds))


def _nearest_in(points: np.ndarray, keys: np.ndarray, queries: np.ndarray, radius: np.ndarray, k: int, distances_only: bool = False):
    """The k nearest points of each query that lie within its radius, ties by key.

    Gives (query, point, distance) sorted by query, distance and key; with ``distances_only`` the smaller of
    each query's radius and its k-th smallest distance (the radius with fewer than k points).
    """
    bound = radius.astype("float64").copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for q, qi, pi, d in _met(points, queries, bound, k):
        order = np.lexsort((d, qi) if distances_only else (keys[pi], d, qi))
        qi, pi, d = qi[order], pi[order], d[order]
        begin = np.searchsorted(qi, np.arange(len(q)))
        place = np.arange(len(qi)) - begin[qi]
        if distances_only:
            last = place == k - 1
            bound[q[qi[last]]] = np.minimum(bound[q[qi[last]]], d[last])
        else:
            ok = (place < k) & np.isfinite(d)
            found.append((q[qi[ok]], pi[ok], d[ok]))
    if distances_only:
        return bound
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    qi, pi, d = (np.concatenate(v) for v in zip(*found))
    order = np.argsort(qi, kind="stable")
    return qi[order], pi[order], d[order]


def _matrix(table: pa.Table | pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([table.column(n).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(n).to_numpy() for n in names])


def _split(table: pa.Table, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table, np.ndarray]:
    """The points, keys and weights of a cell; its queries and their coordinates."""
    asks = table.column("_loc").is_valid().to_numpy()
    points, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
    keys = points.column("_key").fill_null(int(_LAST)).to_numpy()
    return _matrix(points, names), keys, points.column("_w").to_numpy(), queries, _matrix(queries, names)


def _same_cell(names: Sequence[str], k: int):
    def radius(table: pa.Table) -> pa.Table:
        points, keys, _, queries, x = _split(table, names)
        r = _nearest_in(points, keys, x, np.full(len(x), np.inf), k, distances_only=True)
        return pa.table({"_loc": queries.column("_loc"), **{n: queries.column(n) for n in names}, "_r": pa.array(r, pa.float64())})

    return radius


def _send(names: Sequence[str], boxes):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = boxes.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                r = batch.column("_r").to_numpy(zero_copy_only=False)
                row, cell = np.nonzero(_box_distance(_matrix(batch, names), low, high) <= (r**2 * (1 + 1e-12))[:, None])
                sent = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cells[cell], pa.int64()), *sent.columns], ["_cell", *sent.schema.names])

    return send


def _found(names: Sequence[str], k: int):
    def search(table: pa.Table) -> pa.Table:
        points, keys, weights, queries, x = _split(table, names)
        q, p, d = _nearest_in(points, keys, x, queries.column("_r").to_numpy(), k)
        edges = np.searchsorted(q, np.arange(len(x) + 1))
        o = pa.array(keys[p], pa.int64(), mask=keys[p] == _LAST)
        near = pa.StructArray.from_arrays([pa.array(d, pa.float64()), o, pa.array(weights[p], pa.int64())], ["d", "o", "w"])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), near)
        return pa.table({"_loc": queries.column("_loc").combine_chunks(), "_near": lists}).filter(pa.array(np.diff(edges) > 0))

    return search


def _coordinate(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(0.0)) + F.lit(0.0)


def _finite(column: str) -> Column:
    return ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))


def cell_count(n: int, cell_rows: int) -> int:
    """Cells of ``cell_rows`` locations; larger ones, with fewer borders, where there are enough of them."""
    return min(MAX_CELLS, max(min(MANY_CELLS, math.ceil(n / cell_rows)), math.ceil(n / (LARGE_CELL * cell_rows))))


def cell_column(points: DataFrame, names: Sequence[str], n: int, cells: int) -> Column:
    """The number of a row's cell; the cuts come from a hash sample of the ``n`` points."""
    if cells == 1:
        return F.lit(0).cast("long")
    unit = F.pmod(F.xxhash64(*names), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = points.where(unit <= min(1.0, SAMPLE_PER_CELL * cells / n)).select(*names).distinct().sort(*names)
    tree = points.sparkSession.sparkContext.broadcast(_cuts(sample.toPandas().to_numpy("float64"), cells))

    @F.pandas_udf("long")
    def cell_of(*values: pd.Series) -> pd.Series:
        return pd.Series(_cell_of(np.column_stack([v.to_numpy("float64") for v in values]), tree.value))

    return cell_of(*names)


def cell_boxes(points: DataFrame, names: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, least and largest coordinates of every cell: at most MAX_CELLS rows."""
    box = points.groupBy("_cell").agg(*[f(n).alias(f"{s}{n}") for s, f in (("l", F.min), ("h", F.max)) for n in names]).collect()
    low, high = (np.array([[r[f"{s}{n}"] for n in names] for r in box]) for s in "lh")
    return np.array([r["_cell"] for r in box]), low, high


def nearest(df: DataFrame, key: str, columns: Sequence[str], k: int, cell_rows: int = CELL_ROWS, donors: DataFrame | None = None, apart: bool = False) -> DataFrame:
    """(q, o, d, rank): the k nearest rows o of every row q (Euclidean over ``columns``, nulls as 0), exact.

    o ranges over ``donors`` when given (same key and columns), else over ``df``; a row is never its own
    neighbour (same key), unless the keys of the donors are of another kind (``apart``). Keys are bigint; a key that m rows share counts m times on either side, and a
    null key asks for nothing. Rows with a coordinate that is not finite have no neighbours and are
    nobody's. Fewer than k candidates: all of them.
    """
    names = [f"_x{i}" for i in range(len(columns))]
    x = [_coordinate(c).alias(n) for c, n in zip(columns, names)]
    usable = [_finite(n) for n in names]

    def read(frame: DataFrame) -> DataFrame:
        rows = frame.select(F.col(key).cast("long").alias("_key"), *x)
        for test in usable:
            rows = rows.where(test)
        return rows

    asked = materialize(read(df))
    given = asked if donors is None else materialize(read(donors))
    spark = asked.sparkSession
    # of equal rows only the k + 1 smallest keys can be neighbours
    small = F.row_number().over(Window.partitionBy(*names).orderBy(F.col("_key").asc_nulls_last()))
    points = materialize(given.groupBy("_key", *names).agg(F.count(F.lit(1)).alias("_w")).withColumn("_place", small).where(F.col("_place") <= k + 1).drop("_place"))
    asked = asked.where(F.col("_key").isNotNull())
    locations = asked.select(*names).distinct().withColumn("_loc", F.monotonically_increasing_id())

    n = points.count()
    empty = spark.createDataFrame([], "q long, o long, d double, rank int")
    if n == 0:
        return empty
    cells = min(MAX_CELLS, math.ceil(n / cell_rows))
    points = points.withColumn("_loc", F.lit(None).cast("long")).withColumn("_r", F.lit(None).cast("double"))
    locations = locations.withColumn("_key", F.lit(None).cast("long")).withColumn("_w", F.lit(None).cast("long")).withColumn("_r", F.lit(float("inf")))
    coordinates = ", ".join(f"{n} double" for n in names)
    if cells == 1:
        locations = materialize(locations.withColumn("_cell", F.lit(0)))
        found = points.withColumn("_cell", F.lit(0)).unionByName(locations).groupBy("_cell").applyInArrow(_found(names, k + 1), FOUND)
    else:
        cell_of = cell_column(points, names, n, cells)
        points, locations = (materialize(t.withColumn("_cell", cell_of)) for t in (points, locations))
        boxes = spark.sparkContext.broadcast(cell_boxes(points, names))
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(cells, 2_000))

        def dealt(queries: DataFrame):
            """Points and queries of a cell together; a fixed number of partitions, since the work does not lie in their bytes."""
            return points.unionByName(queries).repartition(parts, "_cell").groupBy("_cell")

        radii = dealt(locations).applyInArrow(_same_cell(names, k + 1), f"_loc long, {coordinates}, _r double")
        sent = radii.mapInArrow(_send(names, boxes), f"_cell long, _loc long, {coordinates}, _r double")
        found = dealt(sent.withColumn("_key", F.lit(None).cast("long")).withColumn("_w", F.lit(None).cast("long"))).applyInArrow(_found(names, k + 1), FOUND)
    merged = found.groupBy("_loc").agg(F.slice(F.array_sort(F.flatten(F.collect_list("_near"))), 1, k + 1).alias("_near"))
    near = merged.join(locations.select("_loc", *names), "_loc").drop("_loc")
    others = F.col("_near") if apart else F.filter("_near", lambda a: ~F.col("_key").eqNullSafe(a["o"]))
    lists = asked.join(near, names).select(F.col("_key").alias("q"), others.alias("_near"))

    shared = asked.groupBy("_key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    if shared.isEmpty() and points.where("_w > 1").isEmpty():
        ranked = lists.select("q", F.posexplode(F.slice("_near", 1, k)).alias("_at", "_n"))
        return ranked.select("q", "_n.o", "_n.d", (F.col("_at") + 1).alias("rank"))
    # a key on several rows: each counts once for every one of them, as a neighbour and as a query
    counted = lists.join(shared.withColumnRenamed("_key", "q"), "q", "left").withColumn("_m", F.coalesce("_m", F.lit(1)))
    times = F.least(F.col("_n.w") * F.col("_m"), F.lit(k)).cast("int")
    rows = counted.select("q", "_m", F.explode("_near").alias("_n")).select("q", "_n.o", "_n.d", F.explode(F.sequence(F.lit(1), times)).alias("_t"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "o")))
    return ranked.where(F.col("rank") <= k).select("q", "o", "d", "rank")


def fill_nearest(df: DataFrame, key: str, columns: Sequence[str], k: int = 5, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Fill nulls of ``columns`` with the mean of the k nearest donors under the nan-Euclidean distance, exactly, at any size.

    Distance of two rows: sqrt(len(columns) / shared * sum over shared known columns of squared differences);
    no shared column: no distance. Donors of a column are the other rows where it is known; ties by key.
    A column without any donor in reach gets the column mean (null for an all-null column). Rows are
    grouped by their pattern of known columns (at most 2^len(columns) patterns; only those that occur);
    for each pair of query and donor patterns the search runs in the shared columns, scaled, and the k best
    per pattern pair are merged per missing column. Rows that agree in all known columns are one query: work
    beyond reading, grouping and one join grows with the distinct rows. Keys should be unique and not null.
    """
    columns = list(columns)
    flags = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns]
    pattern = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(flags)), F.lit(0))
    rows = materialize(df.select(F.col(key).cast("long").alias(key), *[F.when(f, F.col(c).cast("double")).alias(c) for f, c in zip(flags, columns)]).withColumn("_p", pattern))
    full = (1 << len(columns)) - 1
    found = [r["_p"] for r in rows.select("_p").distinct().collect()]
    means = rows.agg(*[F.avg(c).alias(c) for c in columns]).first()
    donors = rows.select(F.col(key).alias("o"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)])

    def filled(queries: DataFrame, patterns: Sequence[int], apart: bool) -> DataFrame | None:
        """Per key of ``queries`` as ``_q``: the fill of each column (``_f0``, ``_f1``, ...) where it has one."""
        cands = None
        for qp in patterns:
            missing = [i for i in range(len(columns)) if not qp >> i & 1]
            for dp in found if qp and missing else []:
                shared = [columns[i] for i in range(len(columns)) if qp >> i & 1 and dp >> i & 1]
                if not shared or not any(dp >> i & 1 for i in missing):
                    continue
                scale = math.sqrt(len(columns) / len(shared))
                pairs = nearest(queries.where(F.col("_p") == qp), key, shared, k, cell_rows, rows.where(F.col("_p") == dp), apart)
                part = pairs.select(F.col("q").alias("_q"), "o", (F.col("d") * scale).alias("d"), F.lit(dp).alias("_dp"))
                cands = part if cands is None else cands.unionByName(part)
        if cands is None:
            return None
        cands = materialize(cands.join(donors, "o"))
        fills = None
        for i in range(len(columns)):
            usable = cands.where(F.col("_dp").bitwiseAND(1 << i) != 0)
            best = usable.withColumn("_r", F.row_number().over(Window.partitionBy("_q").orderBy("d", "o"))).where(F.col("_r") <= k)
            fill = best.groupBy("_q").agg(F.avg(f"_v{i}").alias(f"_f{i}"))
            fills = fill if fills is None else fills.join(fill, "_q", "full")
        return materialize(fills)

    # rows with equal known columns take the same fills, which are searched once; a key on several rows leaves itself out, so it asks alone
    again = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col(key).isNotNull()).select(key))
    repeats = not again.isEmpty()
    single = rows.join(again, key, "left_anti") if repeats else rows
    asking = single.where(F.col(key).isNotNull() & (F.col("_p") != full) & (F.col("_p") != 0))
    places = materialize(asking.select(*columns, "_p").distinct().withColumn(key, F.monotonically_increasing_id()))
    known = [F.coalesce(F.col(c), F.lit(0.0)).alias(f"_c{i}") for i, c in enumerate(columns)]
    on = ["_p", *[f"_c{i}" for i in range(len(columns))]]

    def complete(held: DataFrame, fills: DataFrame, by: Sequence[str]) -> DataFrame:
        """The rows with their fills, then with the means."""
        met = held.join(fills, list(by), "left") if by else held
        return met.select(key, *[F.coalesce(F.col(c), *([F.col(f"_f{i}")] if by else []), F.lit(means[c])).alias(c) for i, c in enumerate(columns)])

    def finished(held: DataFrame, queries: DataFrame, apart: bool) -> DataFrame:
        patterns = [r["_p"] for r in queries.select("_p").distinct().collect()]
        fills = filled(queries, patterns, apart)
        if fills is None:
            return complete(held, held, [])
        if not apart:
            return complete(held, fills.withColumnRenamed("_q", key), [key])
        fills = queries.select(F.col(key).alias("_q"), "_p", *known).join(fills, "_q").drop("_q")
        out = complete(held.where(F.col(key).isNotNull() & (F.col("_p") != full)).select("*", *known), fills, on)
        return out.unionByName(complete(held.where(F.col(key).isNull() | (F.col("_p") == full)), held, []))

    out = finished(single, places, True)
    return out.unionByName(finished(*[rows.join(again, key, "left_semi")] * 2, False)) if repeats else out


def local_outlier_factor(df: DataFrame, key: str, columns: Sequence[str], k: int = 20, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, k_distance, lrd, lof) of every row against all other rows; lof near 1 is usual, larger is unusual.

    A table of one row gives lof null for it (no neighbours). Duplicates are neighbours at distance 0.
    """
    from tillscope.operators import local_factor

    names = [f"_x{i}" for i in range(len(columns))]
    rows = materialize(df.select(F.col(key).cast("long").alias("_key"), *[_coordinate(c).alias(n) for c, n in zip(columns, names)]))
    finite = functools.reduce(Column.__and__, [_finite(n) for n in names], F.lit(True))
    if rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_m")).where("_key is null or _m > 1").isEmpty():
        found = local_factor.by_location(rows.where(finite), names, k, cell_rows)
        rest = rows.where(~finite).select("_key", *[F.lit(None).cast("double").alias(c) for c in found.columns[1:]])
        return found.unionByName(rest).withColumnRenamed("_key", key)
    # a key on several rows, or none: neighbours by key
    pairs = materialize(nearest(df, key, columns, k, cell_rows))
    kdist = pairs.groupBy("q").agg(F.max("d").alias("k_distance"))
    reach = pairs.join(kdist.withColumnRenamed("q", "o").withColumnRenamed("k_distance", "_ko"), "o").withColumn("_reach", F.greatest("d", "_ko"))
    lrd = materialize(reach.groupBy("q").agg((1.0 / (F.avg("_reach") + F.lit(1e-10))).alias("lrd")).join(kdist, "q"))
    lof = pairs.join(lrd.select(F.col("q").alias("o"), F.col("lrd").alias("_lo")), "o").groupBy("q").agg(F.avg("_lo").alias("_mean"))
    out = lrd.join(lof, "q").select(F.col("q").alias(key), "k_distance", "lrd", (F.col("_mean") / F.col("lrd")).alias("lof"))
    keys = df.select(F.col(key).cast("long").alias(key))
    return keys.join(out, key, "left")
