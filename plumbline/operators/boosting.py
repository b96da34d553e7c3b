"""Gradient-boosted trees from histograms: second-order gains, a leaf penalty, rows and columns sampled per tree.

Features are cut into at most ``bins`` quantile bins once. Rows then live as blocks (bin numbers, label, fold and the margins
of all models), dealt evenly over tasks. Up to ``TASK_ROWS`` rows a model is one task, models of the folds side by side. Beyond,
a level of a tree is one short job for the models of all folds: each task adds the gradients and curvatures of its blocks up
per open node, feature and bin, and the driver adds the tasks' sums, whose size follows from nodes and bins, not from rows.
Where those sums are wide, those of one feature meet in one task instead, which returns that feature's best split per node. No
row is shuffled once the blocks are dealt; margins are carried from round to round in executors' memory, as arrays that a task
takes as they are, and settled every ``SETTLE`` rounds.
"""

from __future__ import annotations

import gc
import json
import pickle
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import materialised, side_by_side

BLOCK_ROWS = 1 << 16
TASK_ROWS = 1 << 18        # a model of at most so many rows grows in one task
GATHERED_BYTES = 32 << 20  # of sums that the driver adds up per level
SETTLE = 16                # rounds between writing margins
# Blocks are read by every level job: they are held neither compressed nor serialised again, which a read would undo each time.
AS_ARRAYS = StorageLevel.MEMORY_AND_DISK_DESER
MASKED_LEAVES = 64         # of a tree whose rows are placed by masks of one word
MASKED_FEATURES = 16
SKETCH = 100_000           # accuracy of the quantile sketch: exact ranks for up to about that many distinct values


@dataclass(frozen=True)
class BoostSettings:
    """``columns``: share of the features a tree may use; ``penalty``: added to a leaf's curvature; ``least``: smallest
    curvature (rows, for squared loss) of a child; ``gain``: smallest gain of a split. ``loss``: squared or logistic."""

    rounds: int = 300
    rate: float = 0.05
    depth: int = 6
    subsample: float = 0.8
    columns: float = 0.8
    penalty: float = 1.0
    least: float = 1.0
    gain: float = 0.0
    bins: int = 256
    loss: str = "squared"
    seed: int = 42

    def __post_init__(self):
        if self.loss not in ("squared", "logistic"):
            raise ValueError("loss must be 'squared' or 'logistic'")
        if not 2 <= self.bins <= 256:
            raise ValueError("bins must be between 2 and 256")
        if not (0 < self.subsample <= 1 and 0 < self.columns <= 1):
            raise ValueError("subsample and columns are shares above 0")


@dataclass
class Trees:
    """Trees as complete binary heaps: child of node i are 2 i + 1 and 2 i + 2. A leaf has feature -1."""

    feature: np.ndarray        # [trees, nodes] int32
    bin: np.ndarray            # rows whose bin is at most this go left
    value: np.ndarray          # float64, of leaves

    @classmethod
    def empty(cls, depth: int) -> Trees:
        nodes = 2 ** (depth + 1) - 1
        return cls(np.zeros((0, nodes), np.int32), np.zeros((0, nodes), np.int32), np.zeros((0, nodes)))

    def with_tree(self, feature: np.ndarray, bin_: np.ndarray, value: np.ndarray) -> Trees:
        return Trees(*(np.concatenate((a, b[None])) for a, b in ((self.feature, feature), (self.bin, bin_), (self.value, value))))

    def last(self, count: int) -> Trees:
        start = max(0, len(self.feature) - count) if count else len(self.feature)
        return Trees(self.feature[start:], self.bin[start:], self.value[start:])

    def margins(self, bins: np.ndarray) -> np.ndarray:
        """Sum of all trees for rows of bin numbers [features, rows]."""
        total = np.zeros(bins.shape[1])
        for feature, cut, value in zip(self.feature, self.bin, self.value, strict=True):
            total += value[leaf_of(feature, cut, bins)]
        return total


def leaf_of(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The node where each row stops."""
    if len(feature) < 2 * MASKED_LEAVES and len(np.unique(feature[feature >= 0])) <= MASKED_FEATURES:
        return _leaf_by_masks(feature, cut, bins)
    rows, nodes = bins.shape[1], np.arange(len(feature))
    at, place = np.zeros(rows, np.int64), np.arange(rows)
    inner = feature >= 0
    following = np.where(inner, [2 * nodes + 1, 2 * nodes + 2], nodes).T.ravel()     # of a leaf itself
    start, flat = np.where(inner, feature, 0).astype(np.int64) * rows, np.ascontiguousarray(bins).ravel()
    level = nodes[:1]
    while inner[level].any():
        at = following.take(2 * at + (flat.take(start.take(at) + place) > cut.take(at)))
        level = np.unique(following[2 * level[inner[level], None] + [0, 1]])
    return at


def _leaf_by_masks(feature: np.ndarray, cut: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The same for few leaves and features: bit i of a row's mask tells that it can still reach the i-th leaf from the left; a
    bin above a node's cut rules out the leaves on its left. The first leaf left is the one, so depth costs nothing per row."""
    spans, leaves = {}, []

    def walk(node: int) -> None:
        start = len(leaves)
        if feature[node] < 0:
            leaves.append(node)
        else:
            walk(2 * node + 1)
            spans[node] = (start, len(leaves))
            walk(2 * node + 2)

    walk(0)
    if not spans:
        return np.zeros(bins.shape[1], np.int64)
    found = None
    for f in sorted({int(feature[n]) for n in spans}):
        table = np.full(256, 2**len(leaves) - 1, np.uint64)
        for n, (start, end) in spans.items():
            if feature[n] == f:
                table[max(0, int(cut[n]) + 1):] &= np.uint64((2**64 - 1) ^ (2**end - 2**start))
        mask = table.take(bins[f])
        found = mask if found is None else np.bitwise_and(found, mask, out=found)
    first = (found & (~found + np.uint64(1))).astype(np.float64).view(np.int64)      # a power of two: its exponent is the place
    return np.array(leaves).take((first >> 52) - 1023)


@dataclass
class Ensemble:
    """A fitted model: cuts per feature (a value's bin is the number of cuts below it), trees and the starting margin."""

    features: list[str]
    cuts: list[list[float]]
    base: float
    loss: str
    trees: Trees = field(default_factory=lambda: Trees.empty(0))

    def binned(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(cut, np.asarray(x, np.float64), side="left") for cut, x in zip(self.cuts, columns, strict=True)])

    def margins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        return self.base + self.trees.margins(self.binned(columns))

    def predicted(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """The value, or the likelier class (0 or 1)."""
        m = self.margins(columns)
        return m if self.loss == "squared" else (m > 0).astype(np.float64)

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "cuts": self.cuts, "base": self.base, "loss": self.loss,
                           "feature": self.trees.feature.tolist(), "bin": self.trees.bin.tolist(), "value": self.trees.value.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Ensemble:
        d = json.loads(text)
        nodes = len(d["feature"][0]) if d["feature"] else 1
        shaped = lambda name, kind: np.array(d[name], kind).reshape(-1, nodes)          # noqa: E731
        return cls(d["features"], d["cuts"], d["base"], d["loss"],
                   Trees(shaped("feature", np.int32), shaped("bin", np.int32), shaped("value", np.float64)))


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble as a pipeline stage that adds ``prediction``; saved and loaded with the pipeline."""

    ensemble = Param(Params._dummy(), "ensemble", "the ensemble as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, ensemble: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    def model(self) -> Ensemble:
        return Ensemble.from_json(self.getOrDefault(self.ensemble))

    def _transform(self, df: DataFrame) -> DataFrame:
        found = self.model()

        @F.pandas_udf("double")
        def score(rows: pd.DataFrame) -> pd.Series:
            return pd.Series(found.predicted([rows[f"f{i}"].to_numpy() for i in range(len(found.features))]))

        return df.withColumn("prediction", score(F.struct(*[
            F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(found.features)])))


# ---- fitting ----------------------------------------------------------------------------------------------------------

def fit_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Ascending cuts per feature: values of it, all but the greatest if they are few, else quantiles."""
    points = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), points, SKETCH).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [sorted({x for x in row[f"q{i}"] or [] if x < row[f"m{i}"]}) for i in range(len(features))]


BLOCK_SCHEMA = "block long, blob binary"


def _packed(**arrays: np.ndarray) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays.values()], names=list(arrays))
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


@dataclass
class Block:
    bins: np.ndarray           # [features, rows] uint8
    y: np.ndarray
    fold: np.ndarray           # int32; 0 for none
    margins: np.ndarray        # [models, rows]

    def pack(self) -> bytes:
        return _packed(bins=self.bins, y=self.y, fold=self.fold, margins=self.margins)

    @classmethod
    def unpack(cls, blob: bytes, features: int) -> Block:
        row = pa.ipc.open_stream(blob).read_all().to_pylist()[0]
        y = np.frombuffer(row["y"])
        return cls(np.frombuffer(row["bins"], np.uint8).reshape(features, len(y)), y, np.frombuffer(row["fold"], np.int32),
                   np.frombuffer(row["margins"]).reshape(-1, len(y)))


def _blocks(df: DataFrame, features: Sequence[str], label: str, fold: str | None, cuts: list[list[float]],
            base: np.ndarray) -> DataFrame:
    """Rows as packed blocks; a row without a label or with a missing feature fails."""
    chosen = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                       F.col(label).cast("double").alias("y"), (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))

    def run(batches):
        from pyspark import TaskContext

        made, held, rows = TaskContext.get().partitionId() << 32, [], 0

        def close():
            table = pa.Table.from_batches(held)
            if any(table.column(i).null_count for i in range(len(cuts) + 1)):
                raise ValueError("boosted trees are fitted on complete rows")
            columns = [np.asarray(table.column(i), np.float64) for i in range(len(cuts))]
            bins = np.stack([np.searchsorted(c, x, side="left").astype(np.uint8) for c, x in zip(cuts, columns, strict=True)])
            y = np.asarray(table.column("y"), np.float64)
            return Block(bins, y, np.asarray(table.column("fold"), np.int32), np.repeat(base[:, None], len(y), axis=1)).pack()

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                if rows + part.num_rows > BLOCK_ROWS and held:
                    yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([close()], pa.binary())], names=["block", "blob"])
                    made, held, rows = made + 1, [], 0
                if part.num_rows:
                    held.append(part)
                    rows += part.num_rows
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([made]), pa.array([close()], pa.binary())], names=["block", "blob"])

    return chosen.mapInArrow(run, BLOCK_SCHEMA)


def gradients(block: Block, margins: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss by the margin, [models, rows]."""
    if loss == "squared":
        return margins - block.y, np.ones_like(margins)
    p = 1 / (1 + np.exp(-margins))
    return p - block.y, np.maximum(p * (1 - p), 1e-16)


@dataclass
class _Growing:
    """A tree of one model in this round: nodes that were split, and those that may be."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    columns: list[int]
    open: list[int]


def _sampled(settings: BoostSettings, round_: int, block: int, rows: int) -> np.ndarray:
    """The rows of a block that the trees of a round see; the same ones for all models."""
    if settings.subsample >= 1:
        return np.ones(rows, bool)
    return np.random.default_rng([settings.seed, round_, block]).random(rows) < settings.subsample


def _add_sums(total: dict[tuple[int, int], np.ndarray], number: int, block: Block, growing: list[_Growing], round_: int,
              settings: BoostSettings, folds: bool, widths: list[int]) -> None:
    """Add a block's gradients and curvatures per open node and bin, [2, open, bins] by (model, feature), to ``total``."""
    sampled = _sampled(settings, round_, number, len(block.y))
    for m, tree in enumerate(growing):
        if tree.open:
            rows = _ModelRows(number, block, m, folds)
            rows.sample(sampled, tree.columns, settings)
            rows.find(tree)
            sums = [total.setdefault((m, f), np.zeros((2, len(tree.open), widths[f]))) for f in tree.columns]
            rows.add(sums, settings)


def _best_of(m: int, f: int, sums: np.ndarray, settings: BoostSettings) -> dict:
    """A feature's best split per open node: gain, bin, and gradient and curvature of the left side and of the node."""
    g, h = sums
    gl, hl = g.cumsum(axis=1), h.cumsum(axis=1)
    gt, ht = gl[:, -1:], hl[:, -1:]
    gr, hr, p = gt - gl, ht - hl, settings.penalty
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (gl * gl / (hl + p) + gr * gr / (hr + p) - gt * gt / (ht + p))
    gain = np.where((hl >= settings.least) & (hr >= settings.least), gain, -np.inf)
    best, row = gain.argmax(axis=1), np.arange(len(gain))
    return {"model": m, "feature": f, "gain": gain[row, best].tolist(), "bin": best.astype(float).tolist(), "gl": gl[row, best].tolist(),
            "hl": hl[row, best].tolist(), "gt": gt[:, 0].tolist(), "ht": ht[:, 0].tolist()}


def _level_sums(kept: RDD, growing: list[_Growing], round_: int, settings: BoostSettings, folds: bool,
                widths: list[int]) -> RDD:
    """((model, feature), sums) of each task's blocks."""
    def sums(rows):
        _set_aside()
        total: dict[tuple[int, int], np.ndarray] = {}
        for number, block in rows:
            _add_sums(total, number, block, growing, round_, settings, folds, widths)
        yield from ((key, s.tobytes()) for key, s in total.items())

    return kept.mapPartitions(sums)


def _set_aside() -> None:
    """What a worker has loaded is left out of the sweep for cycles that follows each of its tasks: levels are many short jobs."""
    if not gc.get_freeze_count():
        gc.collect()
        gc.freeze()


def _added(growing: list[_Growing], widths: list[int]) -> Callable:
    def add(total: dict[tuple[int, int], np.ndarray], key: tuple[int, int], sums: bytes) -> None:
        s = np.frombuffer(sums).reshape(2, len(growing[key[0]].open), widths[key[1]])
        total[key] = total[key] + s if key in total else s

    return add


def _sums_to_driver(kept: RDD, growing: list[_Growing], round_: int, settings: BoostSettings, folds: bool, widths: list[int]) -> list:
    """One job: what :func:`_best_of` finds over all blocks, per model and feature."""
    total, add = {}, _added(growing, widths)
    for key, sums in _level_sums(kept, growing, round_, settings, folds, widths).collect():    # at most GATHERED_BYTES
        add(total, key, sums)
    return [_best_of(m, f, s, settings) for (m, f), s in total.items()]


def _sums_meet(kept: RDD, growing: list[_Growing], round_: int, settings: BoostSettings, folds: bool, widths: list[int]) -> list:
    """The same for wide sums: those of a model and feature are added in one task, which returns its best splits."""
    add = _added(growing, widths)

    def best(rows):
        total: dict[tuple[int, int], np.ndarray] = {}
        for key, sums in rows:
            add(total, key, sums)
        return [_best_of(m, f, s, settings) for (m, f), s in total.items()]

    return _level_sums(kept, growing, round_, settings, folds, widths).partitionBy(
        max(1, min(kept.getNumPartitions(), len(growing) * len(widths)))).mapPartitions(best).collect()


def _split_level(tree: _Growing, rows: list, settings: BoostSettings, last: bool) -> None:
    """Split the open nodes where a feature gains; children stay open unless the tree is as deep as it may be."""
    weight = lambda g, h: -settings.rate * g / (h + settings.penalty) if h + settings.penalty > 0 else 0.0      # noqa: E731
    rows = sorted(rows, key=lambda r: r["feature"])
    following = []
    for i, node in enumerate(tree.open):
        if not rows:
            continue
        best = max(rows, key=lambda r: r["gain"][i])           # of equal gains the first feature
        g, h = best["gt"][i], best["ht"][i]
        tree.value[node] = weight(g, h)
        if not best["gain"][i] > max(settings.gain, 1e-12):
            continue
        gl, hl = best["gl"][i], best["hl"][i]
        left, right = 2 * node + 1, 2 * node + 2
        tree.feature[node], tree.bin[node], tree.value[node] = best["feature"], int(best["bin"][i]), 0.0
        tree.value[left], tree.value[right] = weight(gl, hl), weight(g - gl, h - hl)
        if not last:
            following += [left, right]
    tree.open = following


def fit_boosted(df: DataFrame, features: Sequence[str], label: str, settings: BoostSettings, fold: str | None = None,
                folds: int = 0) -> list[Ensemble]:
    """A model of all rows, and for each fold 1..``folds`` (column ``fold``) one of the rows outside it.

    Which rows a tree sees follows from the seed, the round and a row's place in its block, so results repeat for the same
    partitioning of the input. Of splits with equal gains the first feature and the lowest cut are taken.
    """
    features, models = list(features), folds + 1
    if not features:
        raise ValueError("no features")
    y = F.col(label).cast("double")
    inside = [F.lit(True), *[F.col(fold) != i for i in range(1, models)]] if folds else [F.lit(True)]
    *means, rows = df.agg(*[F.avg(F.when(c, y)).alias(f"m{i}") for i, c in enumerate(inside)], F.count(F.lit(1))).first()
    if any(m is None for m in means):
        raise ValueError("no rows to fit on")
    base = np.array(means, np.float64)
    if settings.loss == "logistic":
        base = np.clip(base, 1e-6, 1 - 1e-6)
        base = np.log(base / (1 - base))
    cuts = fit_cuts(df, features, settings.bins)
    parts = max(1, -(-rows // BLOCK_ROWS))
    dealt = df.coalesce(parts) if df.rdd.getNumPartitions() > parts else df
    blocks = materialised(_blocks(dealt, features, label, fold, cuts, base), spread=False)
    ensembles = lambda found: [Ensemble(features, cuts, float(b), settings.loss, t) for b, t in zip(base, found, strict=True)]     # noqa: E731
    widths = [len(c) + 1 for c in cuts]
    if rows <= TASK_ROWS:
        one = blocks.coalesce(1)
        return ensembles(side_by_side([partial(_in_a_task, one, len(features), m, settings, folds > 0, widths) for m in range(models)], df,
                                      max(1, min(models, df.sparkSession.sparkContext.defaultParallelism))))
    held = sorted((r["block"], r["bytes"]) for r in blocks.select("block", F.length("blob").alias("bytes")).collect())   # two numbers a block
    tasks = max(1, min(len(held), df.sparkSession.sparkContext.defaultParallelism))
    kept = _unpacked(_dealt(blocks, held, tasks), len(features)).persist(AS_ARRAYS)
    widest = sum(sorted(widths, reverse=True)[:_count(settings, len(cuts))])
    narrow = tasks * models * 2 ** max(0, settings.depth - 1) * widest * 16 <= GATHERED_BYTES
    best = _sums_to_driver if narrow else _sums_meet
    trees, first = [Trees.empty(settings.depth) for _ in range(models)], kept
    for round_ in range(settings.rounds):
        before = kept
        if round_:
            kept = _carried(first, kept, trees, round_)
        trees = _grown(trees, round_, settings, len(features), lambda growing, kept=kept, round_=round_: best(
            kept, growing, round_, settings, folds > 0, widths))
        if before is not kept and before is not first:
            before.unpersist()
    kept.unpersist()
    first.unpersist()
    return ensembles(trees)


def _unpacked(dealt: DataFrame, features: int) -> RDD:
    """(number, block) by number in each task."""
    def run(rows):
        for number, blob in sorted((r["block"], bytes(r["blob"])) for r in rows):
            yield number, Block.unpack(blob, features)

    return dealt.rdd.mapPartitions(run)


def _carried(first: RDD, kept: RDD, trees: list[Trees], round_: int) -> RDD:
    """The blocks with the margins after the newest trees, computed by the next job; now and then written or made from the first ones."""
    settle, folder = round_ % SETTLE == 0, first.context.getCheckpointDir()
    start, more = (first, trees) if settle and folder is None else (kept, [t.last(1) for t in trees])

    def run(rows):
        for number, block in rows:
            block.margins = block.margins + np.stack([t.margins(block.bins) for t in more])
            yield number, block

    out = start.mapPartitions(run).persist(AS_ARRAYS)
    if settle and folder is not None:
        out.checkpoint()
    return out


def _dealt(blocks: DataFrame, held: list[tuple[int, int]], tasks: int) -> DataFrame:
    """The blocks in ``tasks`` partitions of about the same size."""
    load, task_of = [0] * tasks, {}
    for block, size in sorted(held, key=lambda b: (-b[1], b[0])):
        task_of[block] = load.index(min(load))
        load[task_of[block]] += size
    numbers = F.create_map(*[F.lit(x) for pair in task_of.items() for x in pair])
    return blocks.repartitionById(tasks, F.element_at(numbers, F.col("block")))


def _count(settings: BoostSettings, features: int) -> int:
    """Features that a tree may use."""
    return max(1, int(settings.columns * features))


def _seedling(settings: BoostSettings, round_: int, model: int, features: int) -> _Growing:
    """A tree of its root, with the features it may use."""
    nodes = 2 ** (settings.depth + 1) - 1
    chosen = np.random.default_rng([settings.seed, round_, model]).choice(features, _count(settings, features), replace=False)
    return _Growing(np.full(nodes, -1, np.int32), np.zeros(nodes, np.int32), np.zeros(nodes), sorted(chosen.tolist()), [0])


def _grown(trees: list[Trees], round_: int, settings: BoostSettings, features: int, best: Callable[[list[_Growing]], list]) -> list[Trees]:
    """Every model's trees and one more each, split level by level by what ``best`` finds."""
    growing = [_seedling(settings, round_, m, features) for m in range(len(trees))]
    for level in range(settings.depth):
        if not any(t.open for t in growing):
            break
        found = best(growing)
        for m, tree in enumerate(growing):
            _split_level(tree, [r for r in found if r["model"] == m], settings, level == settings.depth - 1)
    return [t.with_tree(g.feature, g.bin, g.value) for t, g in zip(trees, growing, strict=True)]


def _in_a_task(one: DataFrame, features: int, model: int, settings: BoostSettings, folds: bool, widths: list[int]) -> Trees:
    """A model's trees from one task over blocks in one partition, by the same steps."""
    def run(batches):
        held = sorted(((n, Block.unpack(b, features)) for batch in batches
                       for n, b in zip(batch.column("block").to_pylist(), batch.column("blob").to_pylist(), strict=True)), key=lambda x: x[0])
        rows = [_ModelRows(n, b, model, folds) for n, b in held]
        found = []
        for round_ in range(settings.rounds):
            tree = _seedling(settings, round_, model, features)
            for r in rows:
                r.sample(_sampled(settings, round_, r.number, len(r.block.y)), tree.columns, settings)
            for level in range(settings.depth):
                if not tree.open:
                    break
                sums = [np.zeros((2, len(tree.open), widths[f])) for f in tree.columns]
                for r in rows:
                    r.add(sums, settings)
                opened = tree.open
                _split_level(tree, [_best_of(model, f, s, settings) for f, s in zip(tree.columns, sums, strict=True)],
                             settings, level == settings.depth - 1)
                for r in rows:
                    r.follow(tree, opened)
            for r in rows:
                r.margin += tree.value[leaf_of(tree.feature, tree.bin, r.block.bins)]
            found.append((tree.feature, tree.bin, tree.value))
        trees = Trees(*(np.stack(x) for x in zip(*found, strict=True))) if found else Trees.empty(settings.depth)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trees)], pa.binary())], names=["trees"])

    return pickle.loads(one.mapInArrow(run, "trees binary").head()["trees"])


class _ModelRows:
    """A block's rows for one model; of the tree that grows, the sampled rows that lie in open nodes."""

    def __init__(self, number: int, block: Block, model: int, folds: bool):
        self.number, self.block, self.margin = number, block, block.margins[model].copy()
        self.inside = block.fold != model if folds and model else None

    def sample(self, rows: np.ndarray, columns: list[int], settings: BoostSettings) -> None:
        """Take the ``rows`` that the model is fitted on."""
        use = np.flatnonzero(rows if self.inside is None else rows & self.inside)
        self.bins = [self.block.bins[f].take(use) for f in columns]
        part = Block(self.block.bins[:0], self.block.y[use], self.block.fold[:0], self.margin[None, use])
        (self.g,), (self.h,) = gradients(part, part.margins, settings.loss)
        self.at = np.zeros(len(use), np.int64)

    def find(self, tree: _Growing) -> None:
        """The open nodes of a tree that has grown some levels already."""
        if tree.feature[0] < 0:
            return
        local = np.where(tree.feature >= 0, np.searchsorted(tree.columns, tree.feature), -1)
        place = np.full(len(tree.feature), -1)
        place[tree.open] = np.arange(len(tree.open))
        self.at = place[leaf_of(local, tree.bin, np.stack(self.bins))]
        self._stay()

    def add(self, sums: list[np.ndarray], settings: BoostSettings) -> None:
        """Gradients and curvatures per open node and bin, added to the ``sums`` of each column."""
        for bins, total in zip(self.bins, sums, strict=True):
            _, opened, width = total.shape
            cell = self.at * width + bins
            total[0] += np.bincount(cell, self.g, opened * width).reshape(opened, width)
            total[1] += np.bincount(cell, None if settings.loss == "squared" else self.h, opened * width).reshape(opened, width)

    def follow(self, tree: _Growing, opened: list[int]) -> None:
        """Rows of the nodes that were ``opened`` go on to the nodes that are open now; others leave."""
        place = np.full(len(tree.feature), -1)
        place[tree.open] = np.arange(len(tree.open))
        nodes = np.array(opened)
        split = tree.feature[nodes] >= 0
        following = np.where(split, place[np.minimum([2 * nodes + 1, 2 * nodes + 2], len(place) - 1)], -1).T.ravel()
        column = np.where(split, np.searchsorted(tree.columns, tree.feature[nodes]), -1)
        bins, cut, side = np.zeros(len(self.at), np.uint8), tree.bin[nodes], column.take(self.at)
        for i, values in enumerate(self.bins):
            np.copyto(bins, values, where=side == i)
        self.at = following.take(2 * self.at + (bins > cut.take(self.at)))
        if (following < 0).any():
            self._stay()

    def _stay(self) -> None:
        stay = np.flatnonzero(self.at >= 0)
        if len(stay) < len(self.at):
            self.at, self.g, self.h = self.at[stay], self.g[stay], self.h[stay]
            self.bins = [b[stay] for b in self.bins]
