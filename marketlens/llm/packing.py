"""Packing token sequences by first-fit decreasing in randomised groups of documents.

A document longer than the capacity gives full sequences and a rest; rests are placed first-fit decreasing, the bin found
in a tournament tree of free capacities. What stays in poorly filled bins then fills the gaps of the others, cut to fit.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import blocks, utf8, word_hashes, words

CAPACITY, END_ID = 4096, 2
#: Text bytes of one group, and the free tokens from which on a bin is taken apart to fill others.
GROUP_BYTES, SLACK = 16 << 20, 32
_KNOWN: dict[str, tuple] = {}
SCHEMA = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class TokenTable:
    """Ids of words by their hash; a word is tokenised when first met by the process.

    The tokenizer splits at white space before anything else, so a text's ids are its words' ids in turn.
    """

    LIMIT = 1_500_000

    def __init__(self, path: str):
        # A task has one core: threads of the tokenizer beside those of the other tasks only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self):
        self.hashes, self.begin, self.length, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by END_ID, and the bounds of each text's."""
        starts, ends, first = words(data, bounds)
        found, at, place = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > self.LIMIT:
            self.clear()
        slot = np.searchsorted(self.hashes, found)
        new = (slot >= len(self.hashes)) | (self.hashes[np.minimum(slot, max(len(self.hashes) - 1, 0))] != found if len(self.hashes) else True)
        if new.any():
            raw = data.tobytes()
            coded = [e.ids for e in self.tokenizer.encode_batch([raw[a:b].decode() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())], add_special_tokens=False)]
            sizes = np.array([len(c) for c in coded], np.int64)
            begin = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, np.array([i for c in coded for i in c], np.uint32)])
            # Both are in order, so that the new words go to their places without a sort of the table.
            self.hashes, self.begin, self.length = (
                np.insert(old, slot[new], more) for old, more in ((self.hashes, found[new]), (self.begin, begin), (self.length, sizes)))
            slot = np.searchsorted(self.hashes, found)
        slot = slot[place]
        # The end of a text is one more word, after its last.
        docs = len(bounds) - 1
        length, begin = np.ones(len(slot) + docs, np.int64), np.full(len(slot) + docs, -1, np.int64)
        where = np.arange(len(slot)) + np.repeat(np.arange(docs), np.diff(first))
        length[where], begin[where] = self.length[slot], self.begin[slot]
        total = np.concatenate([[0], np.cumsum(length)])
        source = np.arange(total[-1]) - np.repeat(total[:-1], length) + np.repeat(begin, length)
        ids = self.ids[np.maximum(source, 0)] if len(self.ids) else np.zeros(len(source), np.uint32)
        close = first[1:] + np.arange(docs)
        ids[total[close]] = END_ID
        return ids, np.concatenate([[0], total[close + 1]])


def first_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Positions of the sizes in each bin; sizes are taken in the order given.

    A tournament tree holds the greatest free capacity below each node, bins as leaves; the leftmost bin that fits is
    found from the root.
    """
    leaves = 1
    tree = [0, capacity]
    bins: list[list[int]] = []
    for i, size in enumerate(sizes):
        while tree[1] < size:  # all leaves are in use and none fits: twice the leaves
            old, leaves = tree[leaves:], 2 * leaves
            tree = [0] * leaves + old + [capacity] * (leaves - len(old))
            for n in range(leaves - 1, 0, -1):
                tree[n] = max(tree[2 * n], tree[2 * n + 1])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        leaf = node - leaves
        if leaf == len(bins):
            bins.append([])
        bins[leaf].append(i)
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return bins


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); every token of every document lies in exactly one piece.

    Poorly filled bins are emptied into the gaps of the fuller ones, cut where a gap ends. The rest, less than one
    sequence, is cut into powers of two, which need no padding.
    """
    out = [[(d, s, capacity)] for d, n in enumerate(lengths.tolist()) for s in range(0, n - n % capacity, capacity)]
    rests = sorted(((n % capacity, d) for d, n in enumerate(lengths.tolist()) if n % capacity), key=lambda x: (-x[0], x[1]))
    bins = [[(rests[i][1], int(lengths[rests[i][1]]) - rests[i][0], rests[i][0]) for i in b] for b in first_fit([r[0] for r in rests], capacity)]
    room = [capacity - sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: room[b])
    loose: list[tuple[int, int, int]] = []
    while order and room[order[-1]] > SLACK:
        loose = loose or sorted(bins[order.pop()], key=lambda p: p[2])
        for b in order:
            while room[b] and loose:
                d, s, n = loose.pop()
                cut = min(n, room[b])
                bins[b].append((d, s, cut))
                room[b] -= cut
                if cut < n:
                    loose.append((d, s + cut, n - cut))
            if not loose:
                break
        order.sort(key=lambda b: room[b])
        if loose:
            break
    out += [bins[b] for b in order]
    left = sum(p[2] for p in loose)
    while left:
        size = 1 << (left.bit_length() - 1)
        part, need = [], size
        while need:
            d, s, n = loose.pop()
            cut = min(n, need)
            part.append((d, s, cut))
            need -= cut
            if cut < n:
                loose.append((d, s + cut, n - cut))
        out.append(part)
        left -= size
    return out


def _packed(batches, path: str):
    if path not in _KNOWN:
        _KNOWN[path] = TokenTable(path)
    table, task, made = _KNOWN[path], TaskContext.get().partitionId(), 0

    def groups():
        held, size = [], 0
        for batch in batches:
            for part in blocks(batch, limit=GROUP_BYTES // 4):
                held.append(part)
                size += utf8(part.column("text"))[1][-1]
                if size >= GROUP_BYTES:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    for held in groups():
        coded = [table.encode(*utf8(part.column("text"))) for part in held]
        doc_ids = pa.concat_arrays([p.column("doc_id") for p in held])
        lengths = np.concatenate([np.diff(b) for _, b in coded])
        base = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.concatenate([i for i, _ in coded]).astype("<u4")
        raw, rows = memoryview(ids).cast("B"), []
        for sequence in pack(lengths):
            at = 0
            for d, s, n in sequence:
                a = int(base[d]) + s
                rows.append((d, s, n, zlib.crc32(raw[4 * a:4 * (a + n)]), int(lengths[d]), (task << 36) + made, at))
                at += n
            made += 1
        columns = np.array(rows, np.int64).reshape(-1, 7).T
        yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array(columns[0])), *map(pa.array, columns[1:])],
                                         names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece; `tokenizer` is the path of a file that every executor has.

    Documents are dealt to groups by a hash of id and text; a task takes its rows in the order of that hash, so a task
    that runs again gives the same pieces. Null text counts as empty and gives one piece, its end id; ids are carried as
    they are, also null or repeated, and equal rows are packed each on its own. Empty tables give no rows; further
    columns are ignored. A group is held in memory, a single text at least; no other bound on its length.
    """
    deal = F.xxhash64(F.col(id_col), F.length(F.col(text_col)), F.monotonically_increasing_id())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), deal.alias("deal"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.hint("rebalance", "deal").sortWithinPartitions("deal")
    return dealt.mapInArrow(lambda batches: _packed(batches, tokenizer), SCHEMA.format(id=kind))
