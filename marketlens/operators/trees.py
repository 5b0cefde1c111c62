"""Exact Shapley contributions of tree ensembles and linear models against a set of reference rows.

A leaf is reached by a mixture of a row and a reference if every feature on its path has its conditions met by whichever
of the two supplies it. With A the features of the path whose conditions the row fails and B those the reference fails,
the leaf takes part only if A and B have no feature in common; then each feature of B gains |A|! (|B|-1)! / (|A|+|B|)! of the
leaf's value and each feature of A loses |B|! (|A|-1)! / (|A|+|B|)! of it. This is the mean over all orders of features, so
nothing is drawn and nothing is estimated.

A and B are bit masks, built by one operation per level of a tree for all its nodes and all rows of a batch. At a leaf,
references are counted by mask, the few pairs of masks without a common feature are valued, and each row takes the values
of its mask. Rows for whose failures no reference can stand in leave the leaf alone.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from marketlens.sizing import let_workers_import, shared_folder

#: Rows that a task explains together, masks (leaves times rows) of one tree that it holds at a time, and tasks per core that
#: few rows are dealt to.
ROWS, MASKS, TASKS_PER_CORE = 16_384, 1 << 23, 4


@dataclass
class Tree:
    """Nodes in arrays: feature (-1 at leaves), split number, children, value (times the tree's weight).

    `leaf` numbers the leaves (-1 at inner nodes), `paths` holds the distinct features on the way to each (-1 behind the
    last), and `bit` is the place of an inner node's feature on its own path.
    """

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def __post_init__(self):
        n = len(self.feature)
        self.leaf = np.where(self.feature < 0, np.cumsum(self.feature < 0) - 1, -1)
        self.bit, path, ways = np.zeros(n, np.int64), [()] * n, []
        for node, (f, left, right) in enumerate(zip(self.feature.tolist(), self.left.tolist(), self.right.tolist())):
            # Parents come before their children.
            own = path[node]
            if f < 0:
                ways.append(own)
                continue
            new = own if f in own else (*own, f)
            self.bit[node], path[left], path[right] = new.index(f), new, new
        width = max(map(len, ways))
        self.paths = np.array([[*w, *[-1] * (width - len(w))] for w in ways], np.int64).reshape(len(ways), width)


@dataclass
class Ensemble:
    """Trees and their distinct splits: (feature, threshold or None, categories that go left)."""

    trees: list[Tree]
    splits: list[tuple[int, float | None, frozenset]]

    def goes_left(self, rows: np.ndarray) -> list[np.ndarray]:
        out = []
        for feature, threshold, categories in self.splits:
            column = rows[:, feature]
            out.append(column <= threshold if threshold is not None else np.isin(column, list(categories)))
        return out


def has_exact_contributions(model: Model) -> bool:
    return isinstance(model, (LinearRegressionModel, DecisionTreeRegressionModel, RandomForestRegressionModel, GBTRegressionModel))


def read_ensemble(model: Model) -> Ensemble:
    """The trees of a fitted forest, boosting or single tree, read from its stored form in the shared folder.

    The stored nodes are numbered in depth-first order. An ensemble fits the driver's memory, or it could not be a model.
    """
    spark = SparkSession.active()
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    weights = [1.0]
    if "treeID" in data.columns:
        weights = [float(w) for w in model.treeWeights]
        if isinstance(model, RandomForestRegressionModel):
            weights = [w / sum(weights) for w in weights]
    else:
        data = data.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    node, split = "nodeData.", "nodeData.split."
    table = data.select(
        "treeID", f"{node}id", f"{node}prediction", f"{node}leftChild", f"{node}rightChild", f"{split}featureIndex",
        f"{split}leftCategoriesOrThreshold", f"{split}numCategories").orderBy("treeID", "id").toArrow().combine_chunks()
    tree_id, feature = table["treeID"].to_numpy(), table["featureIndex"].to_numpy().astype(np.int32)
    left, right = table["leftChild"].to_numpy().astype(np.int32), table["rightChild"].to_numpy().astype(np.int32)
    value = table["prediction"].to_numpy()
    known: dict[tuple, int] = {}
    numbers = np.full(len(tree_id), -1, np.int32)
    inner = np.flatnonzero(left >= 0)
    for i, at, count in zip(inner.tolist(), table["leftCategoriesOrThreshold"].take(pa.array(inner)).to_pylist(),
                            table["numCategories"].to_numpy()[inner].tolist()):
        key = (int(feature[i]), at[0], frozenset()) if count < 0 else (int(feature[i]), None, frozenset(at))
        numbers[i] = known.setdefault(key, len(known))
    feature = np.where(left >= 0, feature, -1)
    bounds = np.searchsorted(tree_id, np.arange(len(weights) + 1))
    trees = [Tree(feature[a:b], numbers[a:b], left[a:b], right[a:b], value[a:b] * w) for a, b, w in zip(bounds[:-1], bounds[1:], weights)]
    return Ensemble(trees, list(known))


def contributions(ensemble: Ensemble, rows: np.ndarray, references: np.ndarray) -> np.ndarray:
    """One contribution per row and feature; a row's sum up to its prediction less the references' mean prediction."""
    reference_left, out = np.array(ensemble.goes_left(references)), np.zeros(rows.shape[::-1])
    row_left = np.array(ensemble.goes_left(rows))
    for tree in ensemble.trees:
        against = [np.unique(masks, return_counts=True) for masks in _leaf_masks(tree, reference_left)]
        values, step = tree.value[tree.leaf >= 0] / len(references), max(1024, MASKS // len(tree.paths))
        for start in range(0, len(rows), step):
            part = slice(start, start + step)
            for masks, path, (b, counts), value in zip(_leaf_masks(tree, row_left[:, part]), tree.paths, against, values):
                _add_leaf(out[:, part], masks, path[path >= 0], b, counts * value)
    return out.T


def _leaf_masks(tree: Tree, left: np.ndarray) -> np.ndarray:
    """For every leaf and row the path features whose conditions the row fails, level by level for all nodes at once."""
    kind = np.uint16 if tree.paths.shape[1] <= 16 else np.uint32
    out = np.empty((len(tree.paths), left.shape[1]), kind)
    nodes, masks = np.zeros(1, np.int64), np.zeros((1, left.shape[1]), kind)
    while len(nodes):
        leaf = tree.leaf[nodes]
        out[leaf[leaf >= 0]] = masks[leaf >= 0]
        nodes, masks = nodes[leaf < 0], masks[leaf < 0]
        if len(nodes):
            goes, bit = left[tree.split[nodes]].astype(kind), tree.bit[nodes].astype(kind)[:, None]
            # A row that goes left fails the right branch, and the other way round.
            masks = np.concatenate([masks | ((1 - goes) << bit), masks | (goes << bit)])
            nodes = np.concatenate([tree.left[nodes], tree.right[nodes]])
    return out


def _add_leaf(out: np.ndarray, masks: np.ndarray, path: np.ndarray, b: np.ndarray, weight: np.ndarray) -> None:
    """Adds one leaf's shares to the rows (columns of `out`), given each row's mask and the references' masks with weights."""
    if masks.itemsize > 2:
        a, place = np.unique(masks, return_inverse=True)
    else:
        number = np.zeros(1 << len(path), np.intp)
        number[masks] = 1
        a = np.flatnonzero(number).astype(masks.dtype)
    apart = (a[:, None] & b) == 0
    # Masks that some reference completes; the others share a column of zeros, the last.
    alive = apart.any(axis=1)
    a, apart = a[alive], apart[alive] * weight
    if masks.itemsize > 2:
        place = np.where(alive, np.cumsum(alive) - 1, len(a))[place]
    else:
        number[:] = len(a)
        number[a] = np.arange(len(a))
        place = number.take(masks)
    bits = np.arange(len(path), dtype=masks.dtype)
    s, t = np.bitwise_count(a), np.bitwise_count(b)
    gains = (apart * _SHARES.take(t, axis=1).take(s, axis=0)) @ ((b[:, None] >> bits) & 1).astype(float)
    losses = np.einsum("ij,ij->i", apart, _SHARES.T.take(t, axis=1).take(s, axis=0))[:, None] * ((a[:, None] >> bits) & 1)
    shares = np.zeros((len(path), len(a) + 1))
    shares[:, :-1] = (gains - losses).T
    for feature, share in zip(path.tolist(), shares):
        out[feature] += share.take(place)


def _shares(n: int = 33) -> np.ndarray:
    """[s, t]: s! (t-1)! / (s+t)!, the share of orders in which one of t features closes a set of t after none of s others."""
    out = np.zeros((n, n))
    for s in range(n):
        for t in range(1, n):
            out[s, t] = 1.0 / (t * math.comb(s + t, t))
    return out


_SHARES = _shares()


def predict(ensemble: Ensemble, rows: np.ndarray) -> np.ndarray:
    """The ensemble's output for every row."""
    out, goes_left = np.zeros(len(rows)), ensemble.goes_left(rows)
    for tree in ensemble.trees:
        at = np.zeros(len(rows), np.int64)
        active = np.flatnonzero(tree.feature[at] >= 0)
        while len(active):
            here = at[active]
            left = np.empty(len(active), bool)
            for s in np.unique(tree.split[here]).tolist():
                own = tree.split[here] == s
                left[own] = goes_left[s][active[own]]
            at[active] = np.where(left, tree.left[here], tree.right[here])
            active = active[tree.feature[at[active]] >= 0]
        out += tree.value[at]
    return out


def explain_linear(model: LinearRegressionModel, rows: DataFrame, names: list[str], references: list[list[float]]) -> tuple[DataFrame, float]:
    """The rows, which have their features in `_x`, with the contributions `_c`, in the order of `names`; and the references' mean output."""
    let_workers_import(rows.sparkSession)
    weights, means = np.array(model.coefficients.toArray()), _matrix(references, names).mean(axis=0)
    size = len(names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (_features(batch.column("_x"), size) - means) * weights
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(values)], names=[*batch.schema.names, "_c"])

    return rows.mapInArrow(task, StructType([*rows.schema.fields, StructField("_c", ArrayType(DoubleType()))])), float(means @ weights + model.intercept)


def explain_trees(model: Model, stored: DataFrame, names: list[str], references: list[list[float]]) -> tuple[DataFrame, float]:
    """Per row of the stored column `_x`, which are distinct, its contributions `_c`, and the references' mean output.

    The ensemble and the references are broadcast. What a leaf costs grows little with the rows, so rows go in large
    batches; where these are too few for the cores, each batch goes to several tasks that take a part of the trees each,
    and the parts are added up in their order.
    """
    spark, size = stored.sparkSession, len(names)
    let_workers_import(spark)
    ensemble, against = read_ensemble(model), _matrix(references, names)
    batches = max(1, -(-stored.count() * 4 // (ROWS * 3)))  # a hash fills them unevenly
    parts = max(1, min(len(ensemble.trees), -(-TASKS_PER_CORE * spark.sparkContext.defaultParallelism // batches)))
    shared = spark.sparkContext.broadcast((ensemble, against))

    def task(received: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (held := list(received)):
            return
        rows, (ensemble, against) = pa.Table.from_batches(held), shared.value
        for part in pc.unique(rows["_part"]).to_pylist():
            x = rows.filter(pc.field("_part") == part)["_x"].combine_chunks()
            some = Ensemble(ensemble.trees[part::parts], ensemble.splits)
            values = contributions(some, _features(x, size), against)
            yield pa.RecordBatch.from_arrays([x, pa.array([part] * len(x), pa.int32()), _lists(values)], names=["_x", "_part", "_c"])

    batch = F.pmod(F.xxhash64("_x"), F.lit(batches)).cast("int")
    work = stored.select("_x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    found = work.repartitionById(batches * parts, batch * parts + F.col("_part")).mapInArrow(task, "_x array<double>, _part int, _c array<double>")
    if parts > 1:
        each = F.transform(F.array_sort(F.collect_list(F.struct("_part", "_c"))), lambda p: p["_c"])
        added = F.aggregate(each, F.array_repeat(F.lit(0.0), size), lambda a, c: F.zip_with(a, c, lambda x, y: x + y))
        found = found.groupBy("_x").agg(added.alias("_c"))
    return found.select("_x", "_c"), float(predict(ensemble, against).mean())


def _matrix(references: list[list[float]], names: list[str]) -> np.ndarray:
    return np.array(references, float).reshape(len(references), len(names))


def _features(lists: pa.Array, size: int) -> np.ndarray:
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, size)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel()))
