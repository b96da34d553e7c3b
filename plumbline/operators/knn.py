"""Exact k-nearest-neighbour join and regressor over an index of cells, which can be stored.

The training rows are dealt to cells: a sample of the rows gives the centres, every row goes to its nearest one. A query first
looks into the cells nearest to it until they hold k rows; the k-th distance found there bounds the answer, and only cells
that can hold a closer row (by the triangle inequality on the cell's centre and radius) are searched afterwards. No candidate
is left out, so the result is exact whatever the cells. The number of cells grows with the rows, beyond 16 million of them
with their square root, so centres stay small enough to be in every task. A cell is cut into blocks of bounded size; a task
holds one block of rows and streams the queries past it, so no row is copied, and returns k rows per query, never all pairs.
Inside a block one matrix product tells which rows can be among the k nearest, with a margin for its rounding; only for those
the distance is taken, from differences. Cells searched afterwards return no row beyond the distance found before.
Joins by a row's id merge: Spark takes what was read from a small compressed file for small, and a broadcast of all rows would
pass through the driver. Only cells are broadcast.

:func:`approximate_join` is the separate, inexact way: random projections, with its recall to be measured.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import materialised

BLOCK_ROWS = 16_384
ROWS_PER_CELL = 8_192
SHELF_CELLS = 64           # cells per folder of a stored index
DISTANCES_AT_ONCE = 1 << 20    # from rows to centres, or from queries to a block's rows
DIFFERENCES_AT_ONCE = 1 << 22  # numbers


@dataclass
class NeighbourIndex:
    """Training rows by cell: ``rows`` (tid, tx, cell, and y where a target is kept)."""

    features: list[str]
    centres: np.ndarray
    radii: np.ndarray
    sizes: np.ndarray
    rows: DataFrame

    def cells(self) -> DataFrame:
        """One row per cell, at most as many as the square root of the rows beyond 16 million."""
        table = pd.DataFrame({"cell": np.arange(len(self.sizes), dtype=np.int32), "n": self.sizes.astype(np.int64),
                              "radius": self.radii, "centre": [c.tolist() for c in self.centres]})
        return self.rows.sparkSession.createDataFrame(table, "cell int, n long, radius double, centre array<double>")

    def save(self, path: str) -> None:
        """Rows by shelf of cells and in the order of cells, the cells with centres and radii, and the features' names."""
        base = str(path).rstrip("/")
        shelf = F.floor(F.col("cell") / SHELF_CELLS).cast("int")
        (self.rows.withColumn("shelf", shelf).repartition("shelf", F.pmod(F.xxhash64("tid"), F.lit(8))).sortWithinPartitions("shelf", "cell")
         .write.mode("overwrite").partitionBy("shelf").parquet(f"{base}/rows"))
        self.cells().coalesce(1).write.mode("overwrite").parquet(f"{base}/cells")
        head = [(json.dumps(self.features),)]
        self.rows.sparkSession.createDataFrame(head, "features string").coalesce(1).write.mode("overwrite").json(f"{base}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NeighbourIndex:
        base = str(path).rstrip("/")
        cells = spark.read.parquet(f"{base}/cells").orderBy("cell").toPandas()
        features = json.loads(spark.read.json(f"{base}/features").head()["features"])
        return cls(features, np.array(cells["centre"].tolist(), float).reshape(len(cells), len(features)), cells["radius"].to_numpy(float),
                   cells["n"].to_numpy(float), spark.read.parquet(f"{base}/rows").drop("shelf"))

    def search(self, queries: DataFrame, query_id: str, k: int, train_id: str = "tid") -> DataFrame:
        """``query_id, train_id, distance``: the k nearest training rows, ties by the smaller id."""
        q = queries.select(F.col(query_id).alias("qid"), F.array(*[F.col(c).cast("double") for c in self.features]).alias("qx"))
        centres, radii, sizes = self.centres, self.radii, self.sizes

        def near_cells(batches):
            """The fewest nearest cells that hold k rows between them."""
            for pdf in _in_slices(batches, len(centres)):
                d = _distances(np.stack(pdf["qx"].to_numpy()), centres) if len(pdf) else np.zeros((0, len(centres)))
                order = np.argsort(d, axis=1, kind="stable")
                enough = np.cumsum(sizes[order], axis=1) >= k
                stop = np.where(enough.any(axis=1), enough.argmax(axis=1), len(centres) - 1)
                yield pd.DataFrame({"qid": pdf["qid"], "qx": pdf["qx"],
                                    "cells": [o[:s + 1].astype(np.int32) for o, s in zip(order, stop)]})

        def far_cells(batches):
            """The other cells that may hold a row within the distance found so far."""
            for pdf in _in_slices(batches, len(centres)):
                d = _distances(np.stack(pdf["qx"].to_numpy()), centres) if len(pdf) else np.zeros((0, len(centres)))
                limit = pdf["reach"].fillna(np.inf).to_numpy()[:, None]
                wanted = (d - radii <= limit * (1 + 1e-9) + 1e-9) & (sizes > 0)
                for row, seen in enumerate(pdf["cells"]):
                    wanted[row, np.asarray(seen, dtype=int)] = False
                yield pd.DataFrame({"qid": pdf["qid"], "qx": pdf["qx"],
                                    "cells": [np.flatnonzero(w).astype(np.int32) for w in wanted], "reach": pdf["reach"]})

        shape = f"qid {dict(q.dtypes)['qid']}, qx array<double>, cells array<int>"
        cells = self.cells().select("cell", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")).filter("blocks > 0")
        first = q.mapInPandas(near_cells, shape)
        near = materialised(_search(first, self.rows, cells, k))   # k rows per query, read twice
        reach = near.groupBy("qid").agg(F.count(F.lit(1)).alias("found"), F.max("distance").alias("far"))
        bounded = first.join(reach.hint("merge"), "qid", "left").select(
            "qid", "qx", "cells", F.when(F.col("found") >= k, F.col("far")).alias("reach"))
        second = bounded.mapInPandas(far_cells, f"{shape}, reach double").filter(F.size("cells") > 0)
        best = _top_k(near.unionByName(_search(second, self.rows, cells, k)), k)
        return best.select(F.col("qid").alias(query_id), F.col("tid").alias(train_id if train_id != query_id else "neighbour_id"), "distance")

    def regress(self, queries: DataFrame, query_id: str, k: int = 15) -> DataFrame:
        """``query_id, prediction``: neighbours weighted by 1/distance; exact matches alone if there are any."""
        if "y" not in self.rows.columns:
            raise ValueError("the index keeps no target")
        targets = self.rows.select(F.col("tid").alias("__tid"), "y")
        values = self.search(queries, query_id, k, "__tid").join(targets.hint("merge"), "__tid")
        zero, inverse = F.col("distance") == 0, F.try_divide(F.lit(1.0), F.col("distance"))
        sums = values.groupBy(query_id).agg(F.avg(F.when(zero, F.col("y"))).alias("same"),
                                            (F.sum(inverse * F.col("y")) / F.sum(inverse)).alias("weighted"))
        return sums.select(query_id, F.coalesce("same", "weighted").alias("prediction"))


def build_index(train: DataFrame, features: Sequence[str], train_id: str, target: str | None = None, cells: int | None = None,
                seed: int = 42) -> NeighbourIndex:
    """The training rows by cell. ``train_id`` should be unique; a row with a missing feature fails."""
    features = list(features)
    vector = F.array(*[F.col(c).cast("double") for c in features])
    rows = train.select(F.col(train_id).alias("tid"), vector.alias("tx"), *([F.col(target).cast("double").alias("y")] if target else []))
    n = rows.count()
    if cells is None:
        cells = max(8, min(n // ROWS_PER_CELL, int(n ** 0.5)))
    # the centres only steer the search, so a sample is enough to find them; every row gets a cell
    chosen = rows.select("tx").orderBy(F.xxhash64(F.lit(seed), "tid")).limit(max(1, min(cells, n))).collect()
    centres = np.unique(np.array([r["tx"] for r in chosen], float).reshape(len(chosen), len(features)), axis=0)
    if np.isnan(centres).any():
        raise ValueError("k-NN needs complete rows")
    kinds = dict(rows.dtypes)

    def place(batches):
        for pdf in _in_slices(batches, len(centres)):
            if len(pdf):
                d = _distances(np.stack(pdf["tx"].to_numpy()), centres)
                if np.isnan(d).any():
                    raise ValueError("k-NN needs complete rows")
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype(np.int32), gap=d[np.arange(len(cell)), cell])

    extra = ", y double" if target else ""
    placed = materialised(rows.mapInPandas(place, f"tid {kinds['tid']}, tx array<double>{extra}, cell int, gap double"))
    sizes, radii = np.zeros(len(centres)), np.zeros(len(centres))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect():     # one row per cell
        sizes[r["cell"]], radii[r["cell"]] = r["n"], r["radius"]
    return NeighbourIndex(features, centres, radii, sizes, placed.drop("gap"))


def knn_join(queries: DataFrame, train: DataFrame, features: Sequence[str], query_id: str, train_id: str,
             k: int = 15, cells: int | None = None, seed: int = 42) -> DataFrame:
    """``query_id, train_id, distance``: the k nearest training rows, ties by the smaller id."""
    return build_index(train, features, train_id, None, cells, seed).search(queries, query_id, k, train_id)


def _in_slices(batches: Iterable[pd.DataFrame], centres: int) -> Iterator[pd.DataFrame]:
    """The rows, so few at once that their distances to all centres stay small however many centres there are."""
    most = max(1, DISTANCES_AT_ONCE // max(1, centres))
    for pdf in batches:
        for start in range(0, len(pdf), most):
            yield pdf.iloc[start:start + most].reset_index(drop=True)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    for j in range(len(b)):   # differences, not the expanded square: no cancellation
        delta = a - b[j]
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", delta, delta))
    return out


def _search(queries: DataFrame, rows: DataFrame, cells: DataFrame, k: int, once: bool = False, bits: int = 0) -> DataFrame:
    """Top k per query over the listed cells: each block of a cell's rows stays in one task, where its queries stream by.

    ``once``: a row may lie in several cells and counts once. ``reach``, where the queries have it: no row beyond it is wanted.
    ``code``, where both sides have it: only rows that share a key of ``bits`` bits with the query are wanted.
    """
    types = {**dict(queries.dtypes), **dict(rows.dtypes)}
    more = {"reach": "double"} if "reach" in queries.columns else {}
    coded = {"code": "array<bigint>"} if bits else {}
    wanted = queries.select("qid", "qx", *more, *coded, F.explode("cells").alias("cell"))
    some = F.broadcast(cells)                            # one row of two numbers per cell
    asked = materialised(wanted.select("cell").distinct())
    left = (rows.join(F.broadcast(asked), "cell", "left_semi").join(some, "cell")
            .select("cell", F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("side"), "tid",
                    F.lit(None).cast(types["qid"]).alias("qid"), F.col("tx").alias("x"),
                    *[F.lit(None).cast(t).alias(c) for c, t in more.items()], *coded))
    right = (wanted.join(some, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cell", "block", F.lit(1).alias("side"), F.lit(None).cast(types["tid"]).alias("tid"), "qid", F.col("qx").alias("x"),
                     *more, *coded))
    both = left.unionByName(right).repartition("cell", "block").sortWithinPartitions("cell", "block", "side")

    def wide(part, column, kind):
        return np.asarray(part.column(column).flatten(), kind).reshape(len(part), -1)

    def nearest(batches):
        key, held = None, []
        for batch in batches:
            cell, block, side = (np.asarray(batch.column(c)) for c in ("cell", "block", "side"))
            change = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(side) != 0)) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows], strict=True):
                if a == b:
                    continue
                if key != (cell[a], block[a]):
                    key, held, shelf = (cell[a], block[a]), [], None
                part = batch.slice(a, b - a)
                x, code = wide(part, "x", float), wide(part, "code", np.int64) if coded else None
                if side[a] == 0:
                    held.append((part.column("tid"), x, code))
                elif held:
                    shelf = shelf or _Shelf.of(held, bits, once)
                    reach = np.asarray(part.column("reach"), float) if more else None
                    step = max(1, DISTANCES_AT_ONCE // len(shelf.x))
                    for i in range(0, len(x), step):
                        take = slice(i, i + step)
                        row, pick, d = shelf.closest(x[take], k, None if reach is None else reach[take], None if code is None else code[take])
                        yield pa.RecordBatch.from_arrays([part.column("qid").slice(i, step).take(pa.array(row)), shelf.ids.take(pa.array(pick)),
                                                          pa.array(d)], names=["qid", "tid", "distance"])

    pairs = both.mapInArrow(nearest, f"qid {types['qid']}, tid {types['tid']}, distance double")
    return _top_k(pairs.groupBy("qid", "tid").agg(F.min("distance").alias("distance")) if once else pairs, k)


@dataclass
class _Shelf:
    """A block's rows, ready to be compared with queries."""

    ids: pa.Array
    rank: np.ndarray           # of the ids
    x: np.ndarray
    product: np.ndarray        # [features + 1, rows]: the rows, and their squared lengths
    longest: float             # greatest squared length
    code: np.ndarray | None
    bits: int
    once: bool                 # an id counts once

    @classmethod
    def of(cls, held: list[tuple[pa.Array, np.ndarray, np.ndarray | None]], bits: int, once: bool) -> _Shelf:
        ids = pa.concat_arrays([h[0] for h in held])
        x = np.concatenate([h[1] for h in held])
        with np.errstate(over="ignore"):
            squares = np.einsum("ij,ij->i", x, x)
        numbers = np.array(ids.to_pylist())
        rank = np.unique(numbers, return_inverse=True)[1] if once else np.argsort(np.argsort(numbers, kind="stable"), kind="stable")
        return cls(ids, rank, x, np.concatenate((x.T, squares[None])), float(squares.max()),
                   np.concatenate([h[2] for h in held]) if bits else None, bits, once)

    def closest(self, x: np.ndarray, k: int, reach: np.ndarray | None, code: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and distance of the k nearest rows of each query, ties by the smaller id."""
        if np.isnan(x).any():
            raise ValueError("k-NN needs complete rows")
        limit, count = np.full(len(x), np.inf), len(self.x)
        with np.errstate(over="ignore", invalid="ignore"):
            own = np.einsum("ij,ij->i", x, x)
            near = np.concatenate((-2 * x, np.ones((len(x), 1))), axis=1) @ self.product      # squared distance less the query's own square
            blur = 32 * (x.shape[1] + 8) * np.finfo(float).eps * (own + self.longest)         # above what rounding makes of it
            if not (np.isfinite(near).all() and np.isfinite(blur).all()):
                near, blur, own = _distances(x, self.x), np.zeros(len(x)), None
            if reach is not None:
                limit = np.where(np.isnan(reach), np.inf, reach if own is None else reach * reach - own + blur)
        todo, most, found = np.arange(len(x)), min(count, k * (2 if self.bits or self.once else 1)), []
        while len(todo):
            part, worst = near if len(todo) == len(x) else near[todo], limit[todo]
            many = np.flatnonzero((part <= worst[:, None]).sum(axis=1) > most)
            if len(many):
                worst[many] = np.minimum(worst[many], _at_least(part if len(many) == len(part) else part[many], most))
            row, pick = np.nonzero(part <= (worst + 2 * blur[todo])[:, None])
            if self.bits:
                shares = self._shares(code[todo[row]], pick)
                row, pick = row[shares], pick[shares]
            sure = part[row, pick] <= worst[row]
            seen = np.unique(row[sure] * count + self.rank[pick[sure]]) // count
            done = (np.bincount(seen, minlength=len(todo)) >= min(k, count)) | (worst >= limit[todo])
            settled = done[row]
            found.append((todo[row[settled]], pick[settled]))
            todo, most = todo[~done], min(count, most * 4)
        row, pick = (np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
        step = max(1, DIFFERENCES_AT_ONCE // max(1, x.shape[1]))
        d = np.concatenate([np.zeros(0), *[_gaps(x[row[i:i + step]], self.x[pick[i:i + step]]) for i in range(0, len(row), step)]])
        if reach is not None:
            inside = ~(d > reach[row])
            row, pick, d = row[inside], pick[inside], d[inside]
        order = np.lexsort((self.rank[pick], d, row))
        if self.once:
            first = np.unique(row[order] * count + self.rank[pick[order]], return_index=True)[1]
            order = order[np.sort(first)]
        row, pick, d = row[order], pick[order], d[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return row[keep], pick[keep], d[keep]

    def _shares(self, code: np.ndarray, pick: np.ndarray) -> np.ndarray:
        """Whether the query's key of some table is the row's, or differs in one bit that the query probes."""
        out = np.zeros(len(pick), bool)
        for i in range(0, len(pick), DIFFERENCES_AT_ONCE // code.shape[1]):
            part = slice(i, i + DIFFERENCES_AT_ONCE // code.shape[1])
            differ = (code[part] ^ self.code[pick[part]]) & ((1 << self.bits) - 1)
            out[part] = ((differ & (differ - 1) == 0) & (differ & ~(code[part] >> self.bits) == 0)).any(axis=1)
        return out


def _at_least(near: np.ndarray, most: int) -> np.ndarray:
    """Per line a value that at least ``most`` numbers do not exceed, and not many more: of groups only the least is sorted."""
    groups = near.shape[1] // 16
    if groups >= 8 * most:
        near = near[:, :groups * 16].reshape(len(near), 16, groups).min(axis=1)
    return np.partition(near, most - 1, axis=1)[:, most - 1]


def _gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    delta = a - b
    return np.sqrt(np.einsum("ij,ij->i", delta, delta))


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    # Each block returned k rows per query, so a query's group stays small.
    order = Window.partitionBy("qid").orderBy("distance", "tid")
    return pairs.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def knn_regress(queries: DataFrame, train: DataFrame, features: Sequence[str], query_id: str, train_id: str,
                target: str, k: int = 15) -> DataFrame:
    """``query_id, prediction``: neighbours weighted by 1/distance; exact matches alone if there are any."""
    return build_index(train, features, train_id, target).regress(queries, query_id, k)


def approximate_join(queries: DataFrame, train: DataFrame, features: Sequence[str], query_id: str, train_id: str, k: int = 15,
                     tables: int = 12, bits: int = 6, probes: int = 6, seed: int = 42) -> DataFrame:
    """``query_id, train_id, distance`` of the k nearest among rows that fall on the query's side of random planes.

    Random-projection hashing: in each of ``tables`` tables a row's key is the sign pattern of ``bits`` projections of the
    centred features; a query looks at its own key and at those that differ in one of the ``probes`` projections nearest to
    zero. Not exact: recall depends on the data and should be measured against :func:`knn_join`. Keys that hold many rows are
    cut into blocks like cells. Where the tables together would look at more pairs than there are, every pair is looked at once
    instead, and counts if it shares a key in some table: the same pairs.
    """
    features = list(features)
    means = train.agg(*[F.avg(F.col(c).cast("double")) for c in features]).first()
    planes = np.random.default_rng(seed).normal(size=(tables, len(features), bits))
    centre = np.array(list(means), float)
    powers = 1 << np.arange(bits)

    def keys(values: np.ndarray, query: bool) -> tuple[list[list[int]], np.ndarray]:
        """The keys looked at, and per table the own key with the probed bits above it."""
        out, code = [[] for _ in values], np.zeros((len(values), tables), np.int64)
        for number, plane in enumerate(planes):
            side = (values - centre) @ plane
            base = (side > 0) @ powers
            near = np.argsort(np.abs(side), axis=1)[:, :probes] if query else np.zeros((len(values), 0), int)
            code[:, number] = base | (powers[near].sum(axis=1) << bits)
            for i, b in enumerate(base.tolist()):
                out[i] += [number << bits | b, *(number << bits | (b ^ (1 << int(p))) for p in near[i])]
        return out, code

    vector = F.array(*[F.col(c).cast("double") for c in features])
    q = queries.select(F.col(query_id).alias("qid"), vector.alias("qx"))
    t = train.select(F.col(train_id).alias("tid"), vector.alias("tx"))

    def keyed(column: str, query: bool):
        def run(batches):
            for pdf in batches:
                if len(pdf):
                    cells, code = keys(np.stack(pdf[column].to_numpy()), query)
                    yield pdf.assign(cells=[np.array(c, np.int32) for c in cells], code=list(code))
        return run

    shape = "cells array<int>, code array<bigint>"
    asked = materialised(q.mapInPandas(keyed("qx", True), f"qid {dict(q.dtypes)['qid']}, qx array<double>, {shape}"))
    placed = materialised(t.mapInPandas(keyed("tx", False), f"tid {dict(t.dtypes)['tid']}, tx array<double>, {shape}"))
    counts = lambda df: df.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("n"))        # noqa: E731
    sizes = counts(placed)                                                                          # at most tables * 2^bits
    looks = sizes.join(counts(asked).withColumnRenamed("n", "asks"), "cell").agg(F.sum(F.col("n").cast("double") * F.col("asks"))).first()[0] or 0.0
    n = placed.count()
    if looks > float(n) * asked.count():
        whole = F.array(F.lit(0))
        cells = placed.sparkSession.createDataFrame([(0, -(-n // BLOCK_ROWS))], "cell int, blocks int")
        near = _search(asked.withColumn("cells", whole), placed.drop("cells").withColumn("cell", F.lit(0)), cells, k, True, bits)
    else:
        cells = sizes.select("cell", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
        near = _search(asked, placed.select("tid", "tx", F.explode("cells").alias("cell")), cells, k, once=True)
    return near.select(F.col("qid").alias(query_id), F.col("tid").alias(train_id if train_id != query_id else "neighbour_id"), "distance")
