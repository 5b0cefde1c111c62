"""Ranked lexical search by dual trees: the best documents of every query text, exactly.

A document is a vector of term weights, an item the set of its terms, a score their inner product. Both sides get a tree:
nodes of documents hold the greatest weight of every term below them, nodes of items the terms of any item below them. The
product of two nodes bounds every score below the pair; a pair whose bound lies below the weakest k-th score of its items
is dropped whole. What is left is scored exactly, in 64-bit integers.

Items are a stated query set. They are taken in blocks of a bounded number of terms, and each block meets all documents:
its terms go to the tasks, every text is reduced to its occurrences of them (stored), and tasks build trees over some
thousand documents at a time. A bounded sample of documents gives each item a first k-th score; it only saves work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.text import LOWER, blocks, lists, utf8
from marketlens.sizing import cut_lineage

#: (item, term) pairs of a block of items, which a task holds.
BLOCK_PAIRS = 250_000
#: Documents of one tree, and of one of its leaves; children of a node.
TREE_DOCS, TREE_ENTRIES, LEAF, FAN = 4096, 1_000_000, 16, 8
#: Documents that give the first k-th scores.
SEED_DOCS = 20_000
NO_ID = np.iinfo(np.int64).max

#: Bytes of terms: digits, letters, everything outside ASCII.
INK = np.zeros(256, bool)
INK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(column) -> tuple[pa.Array, np.ndarray]:
    """All terms of a column of texts, A-Z lower-cased, and the position of each text's first one."""
    data, bounds = utf8(column)
    ink = INK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[ink]])])
    return column, np.searchsorted(starts, bounds)


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) pairs, stored. Rows that repeat an id are one item with the terms of all its texts."""
    kind = items.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                terms, first = terms_of(batch.column("text"))
                row = np.repeat(np.arange(batch.num_rows), np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(row)), terms.cast(pa.binary())], names=["item_id", "term"])

    return cut_lineage(items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, term binary").distinct())


def occurrences(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """Per document with a term: doc_id, n (all its terms), and the known terms it holds with their numbers, stored."""
    known = vocabulary.cast(pa.large_binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                terms, first = terms_of(batch.column("text"))
                n = np.diff(first)
                at = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), n)
                hit = at >= 0
                pairs, tf = np.unique(row[hit] * len(known) + at[hit], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * len(known))
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), lists((pairs % len(known)).astype(np.int32), ends, pa.int32()),
                     lists(tf.astype(np.int64), ends, pa.int64())], names=["doc_id", "n", "term", "tf"])
                yield out.filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return cut_lineage(rows.mapInArrow(count, "doc_id long, n long, term array<int>, tf array<long>"))


class Nodes:
    """Rows of a sparse matrix: row r has columns `column[start[r]:start[r + 1]]` with their values."""

    def __init__(self, start: np.ndarray, column: np.ndarray, value: np.ndarray | None):
        self.start, self.column, self.value = start, column, value

    def __len__(self) -> int:
        return len(self.start) - 1

    def merged(self, size: int) -> Nodes:
        """One row for each `size` consecutive rows: their columns with the greatest values."""
        row = np.repeat(np.arange(len(self)) // size, np.diff(self.start))
        count = -(-len(self) // size)
        value = np.ones(len(row), np.int64) if self.value is None else self.value
        order = np.lexsort((self.column, row))
        row, column, value = row[order], self.column[order], value[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (column[1:] != column[:-1])
        at = np.flatnonzero(new)
        best = np.maximum.reduceat(value, at) if len(at) else value
        return Nodes(np.searchsorted(row[at], np.arange(count + 1)), column[at], None if self.value is None else best)

    def taken(self, rows: np.ndarray) -> Nodes:
        sizes = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(start[-1]) - np.repeat(start[:-1] - self.start[rows], sizes)
        return Nodes(start, self.column[place], None if self.value is None else self.value[place])


def tree(rows: Nodes, leaf: int) -> list[Nodes]:
    """Levels from the root to the leaves of `leaf` rows each."""
    levels = [rows.merged(leaf) if leaf > 1 else rows]
    while len(levels[0]) > 1:
        levels.insert(0, levels[0].merged(FAN))
    return levels


def _sums(picked: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts along the last axis; integers, so they are exact."""
    total = np.zeros((*picked.shape[:-1], picked.shape[-1] + 1), np.int64)
    np.cumsum(picked, axis=-1, out=total[..., 1:])
    return total[..., start[1:]] - total[..., start[:-1]]


class Search:
    """The k best documents of every item among those added; items and their first k-th scores are given."""

    def __init__(self, items: Nodes, size: int, k: int, floors: np.ndarray):
        # Items with a common rarest term (the last in this order) lie side by side.
        last = np.array([items.column[b - 1] if b > a else -1 for a, b in zip(items.start[:-1], items.start[1:])], np.int64)
        self.order = np.argsort(last, kind="stable")
        self.items, self.size, self.k = items.taken(self.order), size, k
        self.levels = tree(self.items, 1)
        self.best = np.zeros((len(items), k), np.int64)
        self.ids = np.full((len(items), k), NO_ID, np.int64)
        self.floors = np.maximum(floors[self.order], 1)
        self.scored = self.pairs = 0
        self._weakest()

    def _weakest(self) -> None:
        """The lowest score that still counts, for every node of items."""
        self.least = [np.maximum(self.floors, self.best[:, -1])]
        for level in self.levels[-2::-1]:
            below = self.least[0]
            self.least.insert(0, np.minimum.reduceat(below, np.arange(0, len(below), FAN)))
            assert len(self.least[0]) == len(level)

    def add(self, ids: np.ndarray, docs: Nodes) -> None:
        """Search documents, given as rows of weights of at least one term each."""
        # Documents with the same heaviest term lie side by side.
        top = np.maximum.reduceat(docs.value, docs.start[:-1])
        row = np.repeat(np.arange(len(docs)), np.diff(docs.start))
        first = np.flatnonzero(docs.value == top[row])
        heaviest = docs.column[first[np.searchsorted(row[first], np.arange(len(docs)))]]
        order = np.lexsort((-top, heaviest))
        ids, docs = ids[order], docs.taken(order)
        levels = tree(docs, LEAF)
        self.pairs += len(docs) * len(self.items)
        self._visit(levels, 0, 0, 0, np.arange(len(self.levels[0])), ids, docs)

    def _visit(self, levels: list[Nodes], depth: int, node: int, item_depth: int, nodes: np.ndarray, ids: np.ndarray, docs: Nodes) -> None:
        """All items below `nodes` (of one level) against all documents below `node`."""
        here, weights = levels[depth], np.zeros(self.size, np.int64)
        span = slice(here.start[node], here.start[node + 1])
        weights[here.column[span]] = here.value[span]
        while True:
            some = self.levels[item_depth].taken(nodes)
            bound = _sums(weights[some.column], some.start)
            nodes = nodes[bound >= self.least[item_depth][nodes]]
            if not len(nodes):
                return
            last = item_depth + 1 == len(self.levels)
            if not last:
                children = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes, item_depth = children[children < len(self.levels[item_depth + 1])], item_depth + 1
            # Leaves of documents meet single items; above, both sides go down together.
            if depth + 1 < len(levels):
                break
            if last:
                return self._score(slice(node * LEAF, (node + 1) * LEAF), nodes, ids, docs)
        children = range(node * FAN, min((node + 1) * FAN, len(levels[depth + 1])))
        heavy = [levels[depth + 1].value[slice(*levels[depth + 1].start[c:c + 2])].sum() for c in children]
        for c in sorted(children, key=lambda c: -heavy[c - node * FAN]):
            self._visit(levels, depth + 1, c, item_depth, nodes, ids, docs)

    def _score(self, span: slice, nodes: np.ndarray, ids: np.ndarray, docs: Nodes) -> None:
        part = docs.taken(np.arange(len(docs))[span])
        columns, place = np.unique(part.column, return_inverse=True)
        dense = np.zeros((len(part), len(columns) + 1), np.int64)
        dense[np.repeat(np.arange(len(part)), np.diff(part.start)), place] = part.value
        some = self.items.taken(nodes)
        at = np.minimum(np.searchsorted(columns, some.column), len(columns) - 1)
        at = np.where(columns[at] == some.column, at, len(columns))
        scores, own = _sums(dense[:, at], some.start), ids[span]
        self.scored += scores.size
        changed = False
        for i in np.flatnonzero((scores >= self.least[-1][nodes]).any(axis=0)).tolist():
            item = nodes[i]
            hit = scores[:, i] >= self.least[-1][item]
            score, ident = np.concatenate([self.best[item], scores[hit, i]]), np.concatenate([self.ids[item], own[hit]])
            keep = np.lexsort((ident, -score))[:self.k]
            self.best[item], self.ids[item] = score[keep], ident[keep]
            changed = True
        if changed:
            self._weakest()

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, document and score of all that was kept."""
        item, rank = np.nonzero(self.best > 0)
        return self.order[item], self.ids[item, rank], self.best[item, rank]


def _weights(n: np.ndarray, tf: np.ndarray, weight: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Weight of a term in a document of n terms: whole numbers throughout."""
    m = 100 - 50 + (50 * n * documents) // terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _best(found: DataFrame, items: Nodes, item_ids: pa.Array, weight: np.ndarray, documents: int, terms: int, k: int,
          floors: np.ndarray, kind: str) -> DataFrame:
    """The k best documents of every item within each partition: item_id, _item, doc_id, score."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Search(items, len(weight), k, floors)
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> None:
            ids, n, sizes, term, tf = (np.concatenate(x) for x in zip(*held))
            value = _weights(np.repeat(n, sizes), tf, weight[term], documents, terms)
            trees.add(ids, Nodes(np.concatenate([[0], np.cumsum(sizes)]), term, value))
            held.clear()

        for whole in batches:
            for start in range(0, whole.num_rows, TREE_DOCS):
                batch = whole.slice(start, TREE_DOCS)
                sizes = pc.list_value_length(batch.column("term")).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False)
                held.append((ids, batch.column("n").to_numpy(zero_copy_only=False), sizes,
                             batch.column("term").flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                             batch.column("tf").flatten().to_numpy(zero_copy_only=False)))
                if sum(len(h[0]) for h in held) >= TREE_DOCS or sum(len(h[3]) for h in held) >= TREE_ENTRIES:
                    flush()
        if held:
            flush()
        item, ids, score = trees.results()
        yield pa.RecordBatch.from_arrays(
            [item_ids.take(pa.array(item)), pa.array(item, pa.int32()), pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(score, pa.int64())],
            names=["item_id", "_item", "doc_id", "score"])

    return found.where(F.size("term") > 0).mapInArrow(search, f"item_id {kind}, _item int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: DataFrame, k: int, kind: str) -> DataFrame | None:
    # About BLOCK_PAIRS rows: the stated query set's block, not documents.
    block = pairs.toArrow()
    if not block.num_rows:
        return None
    coded = block.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    words = block.column("term").combine_chunks().dictionary_encode()
    found = occurrences(docs, words.dictionary)
    documents, terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    df = np.zeros(len(words.dictionary), np.int64)
    # One row for each term of the block.
    counts = found.select(F.explode("term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df[counts.column("term").to_numpy()] = counts.column("df").to_numpy()
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
    # Columns of an item by rising weight, so that its rarest term is the last.
    item, term = coded.indices.to_numpy().astype(np.int64), words.indices.to_numpy().astype(np.int64)
    order = np.lexsort((term, weight[term], item))
    items = Nodes(np.searchsorted(item[order], np.arange(len(coded.dictionary) + 1)), term[order], None)
    floors = np.zeros(len(items), np.int64)
    known = (items, coded.dictionary, weight, documents, terms, k)
    if documents > 2 * SEED_DOCS:
        seeds = found.sample(False, SEED_DOCS / documents, 42)
        for r in _ranked(_best(seeds, *known, floors, kind), k).where(F.col("rank") == k).select("_item", "score").collect():
            floors[r["_item"]] = r["score"]
    return _ranked(_best(found, *known, floors, kind), k).select("item_id", "rank", "doc_id", "score")


def best_documents(docs: DataFrame, items: DataFrame, k: int = 50, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The k best `docs` (doc_id, text) of each of `items` (item_id, text): item_id, rank, doc_id, score.

    Terms, term weights and scores as in the contract of this search: score = sum over the item's distinct terms of
    w * (10^9 tf div (1000 tf + 20 m)), with w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 50 + 50 n N div L over all documents
    that have a term. Only scores above 0 count; equal ones go by ascending doc_id, rows without id last.

    Null and empty texts hold no terms: such documents count nowhere, such items have no rows. Rows that repeat a doc_id
    are documents of their own and may all be ranked; rows that repeat an item_id are one item with the terms of all its
    texts. Other columns are ignored. Without documents or items the result is empty.
    """
    pairs, kind = item_terms(items), items.schema["item_id"].dataType.simpleString()
    count = max(1, -(-pairs.count() // block_pairs))
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(count):
        part = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == block) if count > 1 else pairs
        if (found := _search_block(docs, part, k, kind)) is not None:
            out = out.unionByName(found)
    return out
