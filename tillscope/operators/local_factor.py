"""Local outlier factor of rows with unique keys: the exact neighbours of each location, and all that follows from them, cell by cell.

Equal rows are one location, since they have equal neighbours, distances and densities. Cells are those of
``neighbours``. A cell's locations, the queries it gets and the values it asks for travel as packed arrays, one row for
each pair of cells, so no pair of neighbours is ever a row of its own:

1. ``_start``: nearest locations inside the own cell; queries go to the other cells whose box lies within their distance.
2. ``_visit``: a cell answers the queries of other cells and notes who met which of its locations.
3. ``_merge``: the k nearest rows of each location, its k-distance; the latter goes to the cells that met the location.
4. ``_dense``: local density, sent likewise. 5. ``_factor``: the factor.

Of equally far rows the smallest keys are neighbours; a location brings its k + 1 smallest keys for that.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillscope.operators.neighbours import _box_distance, _matrix, _met, cell_boxes, cell_column, cell_count
from tillscope.session import materialize

POINTS, QUERIES, ANSWER, MET, LISTS, VALUES = range(6)
MESSAGE = "_cell long, _kind int, _from long, _data binary"
RESULT = "_key long, _n long, k_distance double, lrd double, lof double"
Messages = Iterator[tuple[int, int, int, tuple]]


def _mailed(messages: Messages) -> pa.Table:
    cell, kind, origin, data = zip(*((c, k, o, pickle.dumps(arrays, 5)) for c, k, o, arrays in messages))
    return pa.table([pa.array(cell, pa.int64()), pa.array(kind, pa.int32()), pa.array(origin, pa.int64()), pa.array(data, pa.binary())], ["_cell", "_kind", "_from", "_data"])


def _step(work: Callable[[int, dict], pa.Table | Messages]):
    """An Arrow group function from one that takes a cell and, by kind, its messages as (origin, arrays) in order of their origin."""

    def step(table: pa.Table) -> pa.Table:
        post: dict[int, list] = {k: [] for k in range(VALUES + 1)}
        for kind, origin, data in sorted(zip(*(table.column(c).to_pylist() for c in ("_kind", "_from", "_data"))), key=lambda m: m[:2]):
            post[kind].append((origin, pickle.loads(data)))
        out = work(table.column("_cell")[0].as_py(), post)
        return out if isinstance(out, pa.Table) else _mailed(out)

    return step


def _picked(lens: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of the values of the lists ``at``, of lists that stand one after the other."""
    begin, some = np.cumsum(lens) - lens, lens[at]
    return np.repeat(begin[at] - (np.cumsum(some) - some), some) + np.arange(some.sum())


def _ranks(q: np.ndarray, d: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries sorted by query and distance: where the entries of the same distance begin, and how many rows of the query are nearer."""
    at, before = np.arange(len(q)), np.cumsum(n) - n
    other = np.append(True, q[1:] != q[:-1])
    query = np.maximum.accumulate(np.where(other, at, 0))
    tie = np.maximum.accumulate(np.where(other | np.append(True, d[1:] != d[:-1]), at, 0))
    return tie, before[tie] - before[query]


def _pairs(points: np.ndarray, queries: np.ndarray, radius: np.ndarray, n: np.ndarray, first: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, distance), sorted by query: the locations that can hold one of the ``need`` nearest rows of a query."""
    parts = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for q, qi, pi, d in _met(points, queries, radius, need):
        ok = np.isfinite(d)
        qi, pi, d = qi[ok], pi[ok], d[ok]
        if not len(qi):
            continue
        order = np.lexsort((first[pi], d, qi))
        qi, pi, d = qi[order], pi[order], d[order]
        tie, nearer = _ranks(qi, d, n[pi])
        kept = np.arange(len(qi)) - tie < need - nearer
        parts.append((q[qi[kept]], pi[kept], d[kept]))
    q, p, d = (np.concatenate(v) for v in zip(*parts))
    order = np.argsort(q, kind="stable")
    return q[order], p[order], d[order]


def _answer(q: np.ndarray, p: np.ndarray, d: np.ndarray, n: np.ndarray, lens: np.ndarray, keys: np.ndarray) -> tuple:
    """Queries with their numbers of entries; the entries; the locations that they name."""
    asked, entries = np.unique(q, return_counts=True)
    named, place = np.unique(p, return_inverse=True)
    return asked.astype("int32"), entries.astype("int32"), place.astype("int32"), d, named.astype("int32"), n[named], lens[named], keys[_picked(lens, named)]


def _start(names: Sequence[str], need: int, boxes):
    def start(table: pa.Table) -> pa.Table:
        cell = table.column("_cell")[0].as_py()
        x = _matrix(table, names)
        order = np.lexsort(x.T)  # places in a cell depend on its rows alone
        x, table = x[order], table.take(pa.array(order))
        n, lists = np.minimum(table.column("_n").to_numpy(), need), table.column("_keys").combine_chunks()
        lens, keys = np.diff(lists.offsets.to_numpy()).astype("int32"), lists.flatten().to_numpy()
        first = keys[np.cumsum(lens) - lens]
        q, p, d = _pairs(x, x, np.full(len(x), np.inf), n, first, need)
        radius, last = np.full(len(x), np.inf), np.append(q[1:] != q[:-1], True)
        radius[q[last]] = np.where(np.bincount(q, n[p], len(x))[q[last]] >= need, d[last], np.inf)

        def messages() -> Messages:
            yield cell, POINTS, cell, (x, n, lens, keys)
            yield cell, ANSWER, cell, (*_answer(q, p, d, n, lens, keys), table.column("_n").to_numpy())
            cells, low, high = boxes.value
            hits = []
            for start in range(0, len(x), 1024):
                near = _box_distance(x[start : start + 1024], low, high) <= (radius[start : start + 1024] ** 2 * (1 + 1e-12))[:, None]
                row, box = np.nonzero(near & (cells != cell))
                hits.append((row + start, box))
            row, box = (np.concatenate(v) for v in zip(*hits))
            for b in np.unique(box):
                sent = row[box == b]
                yield int(cells[b]), QUERIES, cell, (sent.astype("int32"), x[sent], radius[sent])

        return _mailed(messages())

    return start


def _visit(need: int):
    def visit(cell: int, post: dict) -> Messages:
        x, n, lens, keys = post[POINTS][0][1]
        for origin, arrays in post[ANSWER]:
            yield cell, ANSWER, origin, arrays
        if not post[QUERIES]:
            return
        queries, radius = (np.concatenate([m[1][i] for m in post[QUERIES]]) for i in (1, 2))
        q, p, d = _pairs(x, queries, radius, n, keys[np.cumsum(lens) - lens], need)
        begin = 0
        for origin, (rows, _, _) in post[QUERIES]:
            a, b = np.searchsorted(q, (begin, begin + len(rows)))
            if b > a:
                answer = _answer(rows[q[a:b] - begin], p[a:b], d[a:b], n, lens, keys)
                yield origin, ANSWER, cell, answer
                yield cell, MET, origin, (answer[4],)
            begin += len(rows)

    return _step(visit)


def _taken(q: np.ndarray, d: np.ndarray, at: np.ndarray, n: np.ndarray, lens: np.ndarray, keys: np.ndarray, need: int) -> np.ndarray:
    """How many rows of each entry are among the ``need`` nearest of its query; of equally far rows the smallest keys are."""
    tie, nearer = _ranks(q, d, n[at])
    free, group = need - nearer, np.cumsum(np.append(True, tie[1:] != tie[:-1])) - 1
    members = np.bincount(group)[group]
    fits = np.bincount(group, n[at])[group] <= free
    taken = np.where(free <= 0, 0, np.where(fits, n[at], np.where(members == 1, np.minimum(free, n[at]), 0)))
    torn = np.flatnonzero((free > 0) & ~fits & (members > 1))
    entry, key = np.repeat(torn, lens[at[torn]]), keys[_picked(lens, at[torn])]
    entry = entry[np.lexsort((key, group[entry]))]
    begin = np.searchsorted(group[entry], group[entry])
    entry = entry[np.arange(len(entry)) - begin < free[entry]]
    return taken + np.bincount(entry, minlength=len(q))


def _shared(cell: int, post: dict, value: np.ndarray) -> Messages:
    """The values of the cell's locations to the cells that met them."""
    for origin, (named,) in post[MET]:
        yield origin, VALUES, cell, (value[named],)


def _merge(need: int):
    def merge(cell: int, post: dict) -> Messages:
        parts, base = [], 0
        for origin, a in post[ANSWER]:
            asked, entries, place, d, named, n, lens, keys = a[:8]
            parts.append((np.repeat(asked.astype("int64"), entries), d, place.astype("int64") + base, n, lens, keys))
            base += len(named)
            if origin == cell:
                _, _, _, _, _, _, own_lens, own_keys, own_n = a
                own = base - len(named)
        q, d, at, n, lens, keys = (np.concatenate(v) for v in zip(*parts))
        first = keys[np.cumsum(lens) - lens]
        order = np.lexsort((first[at], d, q))
        q, d, at = q[order], d[order], at[order]
        taken = _taken(q, d, at, n, lens, keys, need) - (at == own + q)  # a row is not its own neighbour
        ok = taken > 0
        q, d, at, taken = q[ok], d[ok], at[ok], taken[ok].astype("int32")
        distance, last = np.full(len(own_n), np.nan), np.append(q[1:] != q[:-1], True)[: len(q)]
        distance[q[last]] = d[last]
        entries = np.bincount(q, minlength=len(own_n)).astype("int32")
        yield cell, LISTS, cell, (own_n, own_lens, own_keys, distance, entries, at.astype("int32"), taken, d)
        yield from _shared(cell, post, distance)
        for origin, named in post[MET]:
            yield cell, MET, origin, named

    return _step(merge)


def _of_all(cell: int, post: dict, value: np.ndarray) -> np.ndarray:
    """The values of all locations that the cell's lists name, in the order of the answers."""
    return np.concatenate([v for _, v in sorted([(cell, value), *((origin, a[0]) for origin, a in post[VALUES])], key=lambda m: m[0])])


def _mean(value: np.ndarray, entries: np.ndarray, weight: np.ndarray) -> np.ndarray:
    place = np.repeat(np.arange(len(entries)), entries)
    with np.errstate(invalid="ignore"):
        return np.bincount(place, value * weight, len(entries)) / np.bincount(place, weight, len(entries))


def _dense(cell: int, post: dict) -> Messages:
    n, lens, keys, distance, entries, at, taken, d = post[LISTS][0][1]
    reach = np.maximum(_of_all(cell, post, distance)[at], d)
    density = 1.0 / (_mean(reach, entries, taken) + 1e-10)
    yield cell, LISTS, cell, (n, lens, keys, distance, density, entries, at, taken)
    yield from _shared(cell, post, density)


def _factor(need: int):
    def factor(cell: int, post: dict) -> pa.Table:
        n, lens, keys, distance, density, entries, at, taken = post[LISTS][0][1]
        factor = _mean(_of_all(cell, post, density)[at], entries, taken) / density
        # locations of more rows than the keys that travel are named by their first key
        some = np.where(n <= need, lens, 1)
        key = keys[np.repeat(np.cumsum(lens) - lens - (np.cumsum(some) - some), some) + np.arange(some.sum())]
        columns = [pa.array(np.repeat(v, some), from_pandas=True) for v in (distance, density, factor)]
        return pa.table([pa.array(key), pa.array(np.repeat(n, some)), *columns], ["_key", "_n", "k_distance", "lrd", "lof"])

    return _step(factor)


def by_location(rows: DataFrame, names: Sequence[str], k: int, cell_rows: int) -> DataFrame:
    """(_key, k_distance, lrd, lof) of every row; ``rows`` are written, their ``_key`` is unique and not null, their coordinates are finite."""
    spark, names, need = rows.sparkSession, list(names), k + 1
    places = materialize(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_first")))
    single = places.where("_n = 1").select(*names, "_n", F.array("_first").alias("_keys"))
    several = places.where("_n > 1").drop("_first")
    if not several.isEmpty():
        small = F.row_number().over(Window.partitionBy(*names).orderBy("_key"))
        lists = rows.join(several.select(*names), names, "left_semi").withColumn("_at", small).where(F.col("_at") <= need).groupBy(*names).agg(F.sort_array(F.collect_list("_key")).alias("_keys"))
        single = single.unionByName(several.join(lists, names))
    n = places.count()
    if n == 0:
        return spark.createDataFrame([], "_key long, k_distance double, lrd double, lof double")
    cells = cell_count(n, cell_rows)
    placed = materialize(single.withColumn("_cell", cell_column(places, names, n, cells)))
    boxes = spark.sparkContext.broadcast(cell_boxes(placed, names))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(cells, 2_000))
    mail = placed.repartition(parts, "_cell").groupBy("_cell").applyInArrow(_start(names, need, boxes), MESSAGE)
    for work, kind in ((_visit(need), MESSAGE), (_merge(need), MESSAGE), (_step(_dense), MESSAGE), (_factor(need), RESULT)):
        mail = mail.repartition(parts, "_cell").groupBy("_cell").applyInArrow(work, kind)
    found = materialize(mail)
    few = found.where(F.col("_n") <= need).drop("_n")
    many = found.where(F.col("_n") > need).drop("_n")
    if many.isEmpty():
        return few
    where = placed.where(F.col("_n") > need).select(F.col("_keys")[0].alias("_key"), *names)
    spread = rows.join(where.join(many, "_key").drop("_key"), names)
    return few.unionByName(spread.select(*few.columns))
