"""Exact top-k inner products: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz residual bounds.

Vectors become integers, are sorted by descending length over the whole table and cut into blocks. All queries first meet
the block of the longest vectors; each query's k-th score there is its floor. A block of vectors too short for the floors
of a block of queries is not sent to it. Of the others, vectors are dropped by |q||v|; for the rest the leading rotated
coordinates give a partial sum, and the product of the residual lengths bounds what is missing. What may still enter a
query's top k is scored in exact integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.sizing import cut_lineage

BLOCK_ROWS, QUERY_ROWS = 4096, 1024
LEADING = 16


def _integers(batches, scale: float):
    """floor(scale * x) of every valid vector, with its length; others are left out."""
    for batch in batches:
        ids, vectors = batch.column("vec_id"), batch.column("vector")
        bounds = vectors.offsets.to_numpy()
        raw = vectors.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].astype(np.float64)  # null components are NaN
        bounds = bounds - bounds[0]
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(scale * raw)
        wrong = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
        keep = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False) & vectors.is_valid().to_numpy(zero_copy_only=False) & (wrong[bounds[1:]] == wrong[bounds[:-1]]))
        norms, full = np.zeros(len(ids)), np.flatnonzero(np.diff(bounds) > 0)
        if len(full):
            finite = np.where(np.isfinite(x), x, 0.0)
            norms[full] = np.sqrt(np.add.reduceat(finite * finite, bounds[:-1][full]))
        kept = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([ids.take(kept), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)).take(kept), pa.array(norms[keep])],
                                         names=["vec_id", "x", "norm"])


def _gram(batches, width: int):
    total = np.zeros((width, width))
    for batch in batches:
        x = packed(batch.column("x"), width)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])


def dense(vectors, width: int) -> np.ndarray:
    """Rows of one width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[:len(v)] = v
    return out


def packed(column: pa.ListArray, width: int) -> np.ndarray:
    """dense() of an Arrow column, in one step where all rows have the width."""
    bounds = column.offsets.to_numpy()
    if (np.diff(bounds) == width).all():
        return column.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].reshape(-1, width)
    return dense(column.to_pylist(), width)


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of the table, largest first, from its Gram matrix: width x width numbers on the driver."""
    rows = vectors.mapInArrow(lambda batches: _gram(batches, width), "i long, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    gram = np.zeros((width, width))
    for r in cells:
        gram[r["i"], r["j"]] = r["v"]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def exact_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products as longs. Doubles while every sum stays below 2**53, else Python integers."""
    if np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * q.shape[1] < 2.0 ** 53:
        return (q @ v.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q.tolist()], object) @ np.array([[int(x) for x in row] for row in v.tolist()], object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search_block(q_ids, q, v_ids, v, axes, k: int, floors=None, leading: int = LEADING):
    """Scores and ids, k a query, of whatever can be among the k best of a query within the block.

    v is sorted by descending length; slices of it are visited in this order, and a slice that no query can profit from
    ends the search. Scores below a query's floor are of no use to it.
    """
    floors = np.full(len(q), -np.inf) if floors is None else floors
    qn, vn = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    qr, vr = q @ axes, v @ axes
    head_q, head_v = qr[:, :leading], vr[:, :leading]
    rest_q, rest_v = np.sqrt((qr[:, leading:] ** 2).sum(1)), np.sqrt((vr[:, leading:] ** 2).sum(1))
    best = np.full((len(q), k), np.iinfo(np.int64).min)
    best_id = np.full((len(q), k), np.iinfo(np.int64).max)
    slack = 1e-6 * (1 + qn.max(initial=0) * vn.max(initial=0))
    step = 512
    for a in range(0, len(v), step):
        b = min(a + step, len(v))
        kth = np.maximum(best[:, -1].astype(float), floors)
        live = np.flatnonzero(qn * vn[a] + slack >= kth)
        if not len(live):
            break
        bound = head_q[live] @ head_v[a:b].T + rest_q[live, None] * rest_v[None, a:b]
        maybe = (bound + slack >= kth[live, None]) & (q_ids[live, None] != v_ids[None, a:b])
        rows, cols = live[maybe.any(1)], np.flatnonzero(maybe.any(0))
        if not len(rows) or not len(cols):
            continue
        scores = exact_scores(q[rows], v[a + cols])
        ids = np.broadcast_to(v_ids[a + cols], scores.shape)
        own = q_ids[rows, None] == ids
        scores = np.concatenate([best[rows], np.where(own, np.iinfo(np.int64).min, scores)], 1)
        ids = np.concatenate([best_id[rows], np.where(own, np.iinfo(np.int64).max, ids)], 1)
        order = np.lexsort((ids, ~scores))[:, :k]
        best[rows], best_id[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)
    return best, best_id


def _ordered(row, width: int):
    """Ids and vectors of a block, longest first."""
    ids, v = np.asarray(row.v_ids, np.int64), np.asarray(row.v, np.float64).reshape(-1, width)
    order = np.lexsort((ids, -(v * v).sum(1)))
    return ids[order], v[order]


def _search_first(frame: pd.DataFrame, axes: np.ndarray, k: int) -> pd.DataFrame:
    """The query blocks with what they find among the longest vectors, their queries' floors, and `need`, the length
    below which no vector can enter any top k of the block."""
    width, out = axes.shape[0], []
    for row in frame.itertuples():
        q_ids, q = np.asarray(row.q_ids, np.int64), np.asarray(row.q, np.float64).reshape(-1, width)
        v_ids, v = _ordered(row, width)
        best, ids = search_block(q_ids, q, v_ids, v, axes, k)
        floors = np.where(ids[:, -1] != np.iinfo(np.int64).max, best[:, -1].astype(float), -np.inf)
        qn, longest = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1)).max(initial=0)
        need = np.where(floors > 0, (floors - 1e-6 * (1 + qn * longest)) / np.maximum(qn, 1e-300), 0.0).min(initial=np.inf)
        out.append((row.q_block, q_ids, q.ravel(), floors, need, np.repeat(q_ids, k), ids.ravel(), best.ravel()))
    return pd.DataFrame(out, columns=["q_block", "q_ids", "q", "floors", "need", "query_id", "vec_id", "score"])


def _search(frame: pd.DataFrame, axes: np.ndarray, k: int) -> pd.DataFrame:
    width, out = axes.shape[0], []
    for row in frame.itertuples():
        q_ids, q = np.asarray(row.q_ids, np.int64), np.asarray(row.q, np.float64).reshape(-1, width)
        v_ids, v = _ordered(row, width)
        best, ids = search_block(q_ids, q, v_ids, v, axes, k, np.asarray(row.floors, np.float64))
        rows, cols = np.nonzero(ids != np.iinfo(np.int64).max)
        out.append(pd.DataFrame({"query_id": q_ids[rows], "vec_id": ids[rows, cols], "score": best[rows, cols]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def _blocks(rows: DataFrame, size: int, order: list, width: int) -> DataFrame:
    """block, length of the longest, ids and numbers of consecutive rows of a frame sorted over all partitions."""
    def cut(batches):
        from pyspark import TaskContext

        made, ids, xs = TaskContext.get().partitionId() << 32, [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            xs += batch.column("x").to_pylist()
            while len(ids) >= size:
                yield one(made, ids[:size], xs[:size])
                made, ids, xs = made + 1, ids[size:], xs[size:]
        if ids:
            yield one(made, ids, xs)

    def one(number, ids, xs):
        x = dense(xs, width)
        longest = np.sqrt((x * x).sum(1)).max(initial=0)
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([longest]), pa.array([ids], pa.list_(pa.int64())), pa.array([x.ravel()], pa.list_(pa.float64()))],
                                          names=["block", "longest", "ids", "x"])

    return rows.orderBy(*order).mapInArrow(cut, "block long, longest double, ids array<long>, x array<double>")


def top_inner_products(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0,
                       is_query=None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k highest integer inner products, ties to the smaller id.

    `is_query` is a column over vec_id (default: divisible by 50). Null vectors, those with null or non-finite components
    and null ids take no part; vectors of different widths end in zeros; rows that repeat an id are vectors of their own,
    queries and candidates alike, so an id may be ranked more than once; a query's own id is no candidate. Scores beyond a long are clipped to its range. Empty tables give
    no rows; further columns are ignored. Every (query block, vector block) that the floors leave is one row of the join, so
    no task holds more than one of each at a time.
    """
    is_query = F.col("vec_id") % 50 == 0 if is_query is None else is_query
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    valid = rows.mapInArrow(lambda batches: _integers(batches, scale), "vec_id long, x array<double>, norm double")
    table = cut_lineage(valid)
    width = table.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return table.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    axes = rotation(table, width)
    shared = vectors.sparkSession.sparkContext.broadcast(axes)  # width x width
    v_blocks = cut_lineage(_blocks(table, BLOCK_ROWS, [F.desc("norm"), "vec_id"], width))
    q_blocks = cut_lineage(_blocks(table.where(is_query), QUERY_ROWS, [F.desc("norm"), "vec_id"], width))
    # One block, of BLOCK_ROWS vectors at most.
    head = v_blocks.agg(F.min("block")).first()[0]
    longest = v_blocks.where(F.col("block") == head).select(F.col("ids").alias("v_ids"), F.col("x").alias("v"))

    def meet_longest(frames):
        for frame in frames:
            yield _search_first(frame, shared.value, k)

    queries = cut_lineage(q_blocks.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("x").alias("q")).join(F.broadcast(longest)).mapInPandas(
        meet_longest, "q_block long, q_ids array<long>, q array<double>, floors array<double>, need double, query_id array<long>, vec_id array<long>, score array<long>"))
    ahead = queries.select(F.inline(F.arrays_zip("query_id", "vec_id", "score"))).where(F.col("vec_id") != (1 << 63) - 1)
    # Both sides name the pairs of block numbers they take part in, so the join is one by key and evenly dealt.
    v_rest = v_blocks.where(F.col("block") != head).withColumnRenamed("block", "v_block")
    every_v = v_rest.agg(F.collect_list(F.struct("v_block", "longest")).alias("of"))
    every_q = queries.agg(F.collect_list(F.struct("q_block", "need")).alias("of"))
    left = v_rest.join(F.broadcast(every_q)).select(
        "v_block", F.explode(F.expr("transform(filter(of, b -> b.need <= longest), b -> b.q_block)")).alias("q_block"), F.col("ids").alias("v_ids"), F.col("x").alias("v"))
    right = queries.join(F.broadcast(every_v)).select(
        "q_block", F.explode(F.expr("transform(filter(of, b -> need <= b.longest), b -> b.v_block)")).alias("v_block"), "q_ids", "q", "floors")
    pairs = left.join(right, ["v_block", "q_block"])

    def run(frames):
        for frame in frames:
            yield _search(frame, shared.value, k)

    found = ahead.unionByName(pairs.mapInPandas(run, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
