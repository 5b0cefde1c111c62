"""Substring dedup by line or paragraph hashing.

Units are normalised (A-Z lower-cased, runs of white space collapsed), digested to 128 bits and grouped over the whole
corpus; the earliest occurrence by (document id, unit number) stays, every other one is removed from its text. Runs of repeated
units that hold few words together, which meet by chance, can be left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import LOWER, _BASE, blocks, longs, mix, utf8, word_hashes, words
from marketlens.sizing import cut_lineage

UNITS = "doc long, key binary, unit int, words int, start int, stop int, d1 long, d2 long"


def unit_bounds(data: np.ndarray, bounds: np.ndarray, breaks: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every unit and one past its line end; units end after `breaks` line feeds or with their text."""
    feed = data == 10
    for _ in range(breaks - 1):
        feed[1:] &= feed[:-1].copy()
    stops = np.unique(np.concatenate([np.flatnonzero(feed) + 1, bounds[1:]]))
    stops = stops[stops > 0]
    return np.concatenate([[0], stops[:-1]]).astype(np.int64), stops


def _units(batches, breaks: int, min_words: int):
    ones, twos = (mix(np.arange(1, 65537, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(s)) | np.uint64(1) for s in (1, 2))
    for batch in batches:
        for part in blocks(batch):
            raw, bounds = utf8(part.column("text"))
            data = LOWER[raw]
            starts, ends, _ = words(data, bounds)
            head, stop = unit_bounds(data, bounds, breaks)
            if not len(stop):
                continue
            first = np.searchsorted(starts, np.append(head, len(data)))
            count = np.diff(first)
            doc = np.searchsorted(bounds, head, "right") - 1
            worded = np.concatenate([[0], np.cumsum(count > 0)])
            number = worded[:-1] - worded[np.searchsorted(head, bounds[:-1])[doc]]  # blank units have no number of their own
            keep = count >= max(1, min_words)
            place = np.arange(len(starts)) - np.repeat(first[:-1], count)
            wide = place >> 16
            digests = []
            for which, w in enumerate((ones, twos)):
                h = word_hashes(data, starts, ends, which)
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + wide.astype(np.uint64)) * w[place & 65535])])
                digests.append(mix(sums[first[1:]] - sums[first[:-1]] + count.astype(np.uint64)))
            at = doc[keep]
            base = bounds[at]
            yield pa.RecordBatch.from_arrays([
                part.column("doc").take(pa.array(at)), part.column("key").take(pa.array(at)), pa.array(number[keep].astype(np.int32)),
                pa.array(count[keep].astype(np.int32)), pa.array((head[keep] - base).astype(np.int32)),
                pa.array((stop[keep] - base).astype(np.int32)), longs(digests[0][keep]), longs(digests[1][keep]),
            ], names=["doc", "key", "unit", "words", "start", "stop", "d1", "d2"])


def keyed(docs: DataFrame, id_col: str, text_col: str, carried=None) -> DataFrame:
    """doc (the id as long, or the column `carried`), text (null: empty) and a 16-byte key of id and text.

    Rows equal in both share the key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text)))
    doc = F.col(id_col).cast("long") if carried is None else carried
    return docs.select(doc.alias("doc"), key.alias("key"), text.alias("text"))


def _runs(spans, least: int):
    """The spans, in order, of those runs of repeated units that hold `least` words or more together."""
    run: list = []
    for s in sorted(spans or [], key=lambda s: s["unit"]):
        if run and s["unit"] != run[-1]["unit"] + 1:
            if sum(x["words"] for x in run) >= least:
                yield from run
            run = []
        run.append(s)
    if sum(x["words"] for x in run) >= least:
        yield from run


def _cut(batches, least: int = 1):
    for batch in batches:
        kept, removed = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, at, parts = text.encode(), 0, []
            merged: list[list[int]] = []
            for s in ((s["start"], s["stop"]) for s in _runs(spans, least)):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            for a, b in merged:
                parts.append(raw[at:a])
                at = b
            parts.append(raw[at:])
            kept.append(b"".join(parts).decode())
            removed.append([{"start": a, "stop": b} for a, b in merged])
        spans = pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([len(r) for r in removed], pa.int64()), spans, pa.array(kept, pa.string())],
                                         names=["doc_id", "n_spans", "removed_spans", "kept_text"])


def drop_repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
                        min_words: int = 1, min_run_words: int = 1) -> DataFrame:
    """doc_id, n_spans, removed_spans (byte offsets in the original, line feed included, adjacent ones merged), kept_text.

    `unit`: "line", or "paragraph" (ends with an empty line). One row per input row. Null text counts as empty; a null id
    ranks last; rows equal in id and text count as one document and share their result; ties cannot occur beyond that. A
    unit that repeats inside one document goes too, all but its first. Every unit that holds a word counts; those of fewer
    than `min_words` words can be left alone, blank ones always are. Repeated units that follow one another, with blank ones
    between them or not, are a run: a run of fewer than `min_run_words` words can be left alone (1: none is), so that a short
    unit still goes where it is part of a longer repeated passage. Empty tables give no rows; further columns are ignored.
    Only digests are shuffled for grouping, with partial minima first, so a unit of a third of all documents is one row per
    task; the join back on it is one that adaptive execution can split.
    """
    breaks = {"line": 1, "paragraph": 2}[unit]
    rows = keyed(docs, id_col, text_col)
    units = rows.mapInArrow(lambda batches: _units(batches, breaks, min_words), UNITS)
    rank = F.struct(F.col("doc").isNull().alias("last"), F.col("doc"), F.col("key"), F.col("unit"))
    repeated = units.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # The digests met more than once, small next to the corpus; the join then drops what is first.
    repeated = cut_lineage(repeated)
    again = units.join(repeated, ["d1", "d2"]).where(rank != F.col("first"))
    spans = again.groupBy("key").agg(F.collect_set(F.struct("unit", "words", "start", "stop")).alias("spans"))
    return rows.join(spans, "key", "left").select("doc", "text", "spans").mapInArrow(
        lambda batches: _cut(batches, min_run_words), "doc_id long, n_spans long, removed_spans array<struct<start:int,stop:int>>, kept_text string")
