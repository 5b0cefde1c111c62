"""Periodic runs of words: stretches that repeat a unit at least three times.

Suffixes of a document's word sequence are sorted by prefix doubling and joined by decreasing length of their common
prefix (LCP), Kruskal's way: union-find over classes, each an ordered set of positions. Where two classes unite at LCP l,
positions i < j that become neighbours have exactly l words in common; if j - i <= l, the stretch from i to j + l has
smallest period j - i, and it is a run if the word before does not continue it. Every run shows up as one such pair.

Only lengths matter that a wanted run can have: a run of period q and length L >= max(min_words, e * q) has an LCP of
L - q, at least min_words * (e - 1) / e. Documents in which no stretch of that many words occurs twice have no run, which
one hash per word decides (equal stretches have equal hashes, so none is missed); only the others are sorted, exactly.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import blocks, utf8, words

MIN_WORDS = 24
MIN_EXPONENT = 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per word, equal for equal words, by their bytes."""
    if not len(starts):
        return np.zeros(0, np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _with_repeats(numbers: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Texts in which some `width` consecutive words may occur twice."""
    n = len(numbers) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    value = np.zeros(n, np.uint64)
    for t in range(width):
        value = value * _MULTIPLIER + numbers[t:t + n].astype(np.uint64)
        value ^= value >> np.uint64(29)
    inside = np.flatnonzero(text[:n] == text[width - 1:])
    value = value[inside] + text[inside].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(value, kind="stable")
    same = value[order[1:]] == value[order[:-1]]
    return np.unique(text[inside[order[1:][same]]])


def suffix_ranks(numbers: np.ndarray, end: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, and for each place in it whether its first `width` words equal those of the place before.

    `end` is the end of each position's text. Prefix doubling; from round to round only positions that are still tied are
    sorted again, inside their class.
    """
    n = len(numbers)
    _, rank, counts = np.unique(text * (numbers.max() + 1) + numbers, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[rank]
    tied, h, alike = np.flatnonzero(counts[np.searchsorted(np.cumsum(counts) - counts, rank)] > 1), 1, None
    reached = width
    while len(tied):
        if h >= reached and alike is None:
            alike = rank.copy()
        step = h if alike is not None or 2 * h <= reached else reached - h
        ahead = tied + step
        key = np.where(ahead < end[tied], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.lexsort((key, rank[tied]))
        tied, key = tied[order], key[order]
        old = rank[tied]
        new_class = np.ones(len(tied), bool)
        new_class[1:] = old[1:] != old[:-1]
        changes = new_class.copy()
        changes[1:] |= key[1:] != key[:-1]
        at = np.arange(len(tied))
        in_class = at - np.maximum.accumulate(np.where(new_class, at, 0))
        rank[tied] = old + np.maximum.accumulate(np.where(changes, at, 0)) - at + in_class
        last = np.ones(len(tied), bool)
        last[:-1] = changes[1:]
        tied = tied[~(changes & last)]
        h += step
    if alike is None:
        alike = rank
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    shared = np.zeros(n, bool)
    shared[1:] = alike[order[1:]] == alike[order[:-1]]
    return order, shared


def _common_prefixes(numbers: list, end: list, before: list, width: int) -> list:
    """Length of the common prefix of each position and the suffix before it, where there is one (else 0).

    A position's value is at least its predecessor's less one, so all positions together take linear time.
    """
    out, have = [0] * len(numbers), 0
    for i, j in enumerate(before):
        if j < 0:
            have = 0
            continue
        have = max(have - 1, width)
        most = min(end[i] - i, end[j] - j)
        while have < most and numbers[i + have] == numbers[j + have]:
            have += 1
        out[i] = have
    return out


def runs_of(numbers: np.ndarray, first: np.ndarray, min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs; starts count over all texts joined, `first` has each text's first word."""
    width = -(-min_words * (exponent - 1) // exponent)
    n, runs = len(numbers), []
    if not n:
        return runs
    end, text = np.repeat(first[1:], np.diff(first)), np.repeat(np.arange(len(first) - 1), np.diff(first))
    order, shared = suffix_ranks(numbers, end, text, width)
    before = np.full(n, -1, np.int64)
    before[order[1:][shared[1:]]] = order[:-1][shared[1:]]
    word, begin = numbers.tolist(), np.repeat(first[:-1], np.diff(first)).tolist()
    lcp = np.array(_common_prefixes(word, end.tolist(), before.tolist(), width), np.int64)
    linked = np.flatnonzero(before >= 0)
    linked = linked[np.argsort(-lcp[linked], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def seed(i: int, j: int, length: int) -> None:
        period = j - i
        if (exponent - 1) * period <= length and period + length >= min_words and (i == begin[i] or word[i - 1] != word[j - 1]):
            runs.append((i, period + length, period))

    for a, b, length in zip(before[linked].tolist(), linked.tolist(), lcp[linked].tolist()):
        a, b = root(a), root(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small = small, large
        places = [bisect_left(large, x) for x in small]
        for t, (k, x) in enumerate(zip(places, small)):
            # Neighbours in the united set that were in different classes.
            if k and (t == 0 or places[t - 1] != k):
                seed(large[k - 1], x, length)
            if k < len(large) and (t + 1 == len(small) or places[t + 1] != k):
                seed(x, large[k], length)
        if len(small) <= 4:
            for k, x in zip(reversed(places), reversed(small)):
                large.insert(k, x)
        else:
            large += small
            large.sort()  # two sorted parts: one merge
        parent[b] = a
        members[a] = large
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _joined(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    edges, out = np.zeros(len(data) + 1, np.int32), data.copy()
    starts_kept = starts[kept]
    edges[starts_kept] += 1
    edges[ends[kept]] -= 1
    mask = np.cumsum(edges[:-1]).astype(bool)
    place = np.flatnonzero(kept)
    text = np.searchsorted(first, place, "right") - 1
    follows = np.zeros(len(place), bool)
    follows[1:] = text[1:] == text[:-1]
    blank = starts_kept[follows] - 1
    mask[blank] = True
    out[blank] = 0x20
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(sums[bounds]), pa.py_buffer(out[mask])).cast(pa.string())


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, n_words, runs (start, length, period by start, then period), kept_text.

    Words are maximal stretches of bytes other than blank and 0x09-0x0D, numbered from 0, compared by their bytes. A run is
    a stretch with smallest period q, `exponent` times q and `min_words` words long at least, that neither neighbour
    continues. `kept_text` has the words that no run holds after its first q words, joined by one space. Null and empty
    texts have no words and an empty kept_text. Rows that repeat an id are judged each by itself; other columns are
    ignored. Rows stay where they are; a task works on texts of about 1 MB at a time, a longer text by itself.
    """
    if exponent < 2 or min_words < exponent:
        raise ValueError("a run repeats its unit at least twice and min_words is not below the exponent")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for whole in batches:
            for batch in blocks(whole):
                data, bounds = utf8(batch.column("text"))
                starts, ends, first = words(data, bounds)
                numbers = word_numbers(data, starts, ends)
                found: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
                kept = np.ones(len(starts), bool)
                texts = _with_repeats(numbers, first, -(-min_words * (exponent - 1) // exponent))
                if len(texts):
                    part = np.concatenate([np.arange(first[t], first[t + 1]) for t in texts.tolist()])
                    part_first = np.concatenate([[0], np.cumsum(first[texts + 1] - first[texts])])
                    for at, length, period in runs_of(numbers[part], part_first, min_words, exponent):
                        t = int(texts[np.searchsorted(part_first, at, "right") - 1])
                        start = int(part[at])
                        found[t].append((start - int(first[t]), length, period))
                        kept[start + period:start + length] = False
                flat = [r for rows in found for r in rows]
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(rows) for rows in found])]).astype(np.int32))
                runs = pa.ListArray.from_arrays(offsets, pa.array([dict(zip(("start", "length", "period"), r)) for r in flat], kind))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), runs, _joined(data, bounds, starts, ends, first, kept)],
                    names=["doc_id", "n_words", "runs", "kept_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, kept_text string")


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the run of greatest length / period (ties: first), and digests of all runs and of the kept text."""
    none = F.lit(None).cast(RUN)
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", none, lambda best, r: F.when(better(best, r), r).otherwise(best))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    out = found.withColumn("_best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"))


def plant_periods(docs: DataFrame) -> DataFrame:
    """Texts of every tenth document by checksum of its id made periodic from some word on, in plain expressions.

    With h = crc32(decimal doc_id) and g = floor(h / 10), where h is divisible by 10 and the text has n > 0 words, each word
    i >= a becomes word a + (i - a) % p, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). A null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ink = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = docs.select("doc_id", "text", (h % 10 == 0).alias("_planted"), F.floor(h / 10).alias("_g"))
    out = out.withColumn("_words", F.when(F.col("_planted"), ink)).withColumn("_n", F.size("_words"))
    out = out.withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n"))).withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    place = F.expr("transform(sequence(0L, cast(_n - 1 as bigint)), i -> if(i < _a, i, _a + (i - _a) % _p))")
    text = F.array_join(F.transform(place, lambda i: F.get(F.col("_words"), i.cast("int"))), " ")
    return out.select("doc_id", F.when(F.col("_planted") & (F.col("_n") > 0), text).otherwise(F.col("text")).alias("text"))
