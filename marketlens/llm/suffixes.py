"""Substring dedup by suffix arrays: every byte under a repeated MATCH-byte string goes.

Where a suffix array is needed is found first. Each MATCH-byte window belongs to the GRAM-byte string in it of smallest
hash, its anchor; equal windows have equal anchors at equal places. Runs of windows of one anchor are regions; regions
whose anchor occurs once cannot repeat and go no further. Equal regions are counted as one. The others are dealt by
anchor to buckets of bounded size, in which a two-stage suffix sort and the common prefixes of neighbours tell the
repeated windows. An anchor with very many different regions is cut into parts that must share a core of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.lines import keyed
from marketlens.llm.text import Slices, blocks, longs, mix, utf8
from marketlens.sizing import cut_lineage

MATCH, GRAM = 200, 80
#: Bytes of text of one bucket; different regions of one anchor from which on they are cut; widths of the cuts in windows.
BUCKET_BYTES, MANY, WIDTHS = 512 << 10, 512, (16, 1)
#: Text whose regions are found together: each byte takes some twenty numbers while they are.
REGION_BYTES = 256 << 10
#: Text that is cut together.
CUT_BYTES = 1 << 20


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` neighbours, by running minima of blocks from both sides."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    full = np.full(-(-len(x) // width) * width, np.iinfo(x.dtype).max, x.dtype)
    full[:len(x)] = x
    full = full.reshape(-1, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def regions_of(data: np.ndarray, bounds: np.ndarray):
    """Text, first window, number of windows and anchor offset of each region; hashes of its anchor and of its bytes."""
    none = np.zeros(0, np.int64)
    if len(data) < MATCH:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    slices = Slices(data, grouped=True)
    at = np.arange(len(data) - GRAM + 1)
    grams = slices(at, at + GRAM)
    bits = np.uint64(max(22, len(data).bit_length()))
    low = np.uint64((1 << int(bits)) - 1)
    place = (sliding_minimum((grams & ~low) | at.astype(np.uint64), MATCH - GRAM + 1) & low).astype(np.int64)
    # A window is valid if its text ends no earlier; windows of a text are consecutive.
    room = np.diff(bounds) - MATCH + 1
    doc = np.repeat(np.arange(len(room)), np.maximum(room, 0))
    first_of = np.cumsum(np.maximum(room, 0)) - np.maximum(room, 0)
    window = np.arange(len(doc)) - first_of[doc] + bounds[:-1][doc]
    place = place[window]
    head = np.ones(len(window), bool)
    head[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(head)
    count = np.diff(np.append(head, len(window)))
    start, anchor = window[head], place[head]
    off = anchor - start
    return doc[head], start - bounds[:-1][doc[head]], count, off, grams[anchor], mix(slices(start, start + count - 1 + MATCH) + off.astype(np.uint64))


REGION = "key binary, s0 int, windows int, off int, a long, r long"


def _regions(batches):
    for batch in batches:
        for part in blocks(batch, limit=REGION_BYTES):
            doc, start, count, off, a, r = regions_of(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(doc)), *(pa.array(x.astype(np.int32)) for x in (start, count, off)), longs(a), longs(r)],
                names=["key", "s0", "windows", "off", "a", "r"])


def _anchors(batches):
    """Each anchor's number of regions in a block."""
    for batch in batches:
        for part in blocks(batch, limit=REGION_BYTES):
            a, n = np.unique(regions_of(*utf8(part.column("text")))[4], return_counts=True)
            yield pa.RecordBatch.from_arrays([longs(a), pa.array(n)], names=["a", "n"])


def _extract(batches):
    for batch in (part for whole in batches for part in blocks(whole)):
        rows = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            rows += [(w["a"], w["r"], w["mult"], w["windows"], w["off"], raw[w["s0"]:w["s0"] + w["windows"] - 1 + MATCH]) for w in wanted]
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "r", "mult", "windows", "off", "text"])


def _parts(batches, width: int):
    """Regions cut where a window's distance from its anchor passes a multiple of `width`; parts of one place of one
    anchor can only share windows if they share the bytes that all windows of this place have in common."""
    for batch in batches:
        for part in blocks(batch):
            data, bounds = utf8(part.column("text"))
            windows, off = (part.column(c).to_numpy().astype(np.int64) for c in ("windows", "off"))
            slices, rows = Slices(data, grouped=True), []
            for i in range(part.num_rows):
                back = off[i] - np.arange(windows[i]) + MATCH * 4
                edge = np.flatnonzero(np.diff(back // width, prepend=-1))
                for b, e in zip(edge.tolist(), np.append(edge[1:], windows[i]).tolist()):
                    rows.append((i, b, e - b, off[i] - b, (back[b] // width) * width - MATCH * 4))
            if not rows:
                continue
            i, b, n, o, q = np.array(rows, np.int64).T
            start, anchor = bounds[i] + b, bounds[i] + off[i]
            core = slices(anchor - q, anchor - q + MATCH - width + 1)
            a = mix(core + mix(part.column("a").to_numpy()[i].view(np.uint64) + (q + MATCH * 4).astype(np.uint64)))
            r = mix(slices(start, start + n - 1 + MATCH) + mix(a + o.astype(np.uint64)))
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([
                part.column("a").take(pa.array(i)), part.column("r").take(pa.array(i)), pa.array(b.astype(np.int32)), longs(a), longs(r),
                part.column("mult").take(pa.array(i)), pa.array(n.astype(np.int32)), pa.array(o.astype(np.int32)),
                pa.array([raw[x:x + y] for x, y in zip(start.tolist(), (n - 1 + MATCH).tolist())], pa.binary()),
            ], names=["pa", "pr", "shift", "a", "r", "mult", "windows", "off", "text"])


def _long_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, zeros beyond the end."""
    full = np.zeros(len(data) + 8, np.uint64)
    full[:len(data)] = data
    out = np.zeros(len(data), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | full[i:i + len(data)]
    return out


def direct_sort(data: np.ndarray, eights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The positions in the order of the MATCH bytes from each: by eight bytes, ties by eight more, then by the rest."""
    padded = np.concatenate([eights, np.zeros(MATCH, np.uint64)])
    at = at[np.argsort(eights[at], kind="stable")]
    group = np.concatenate([[0], np.cumsum(padded[at][1:] != padded[at][:-1])]) if len(at) else at
    for depth in (8, 16):
        tied = np.flatnonzero(np.bincount(group, minlength=1)[group] > 1) if len(at) else at
        if not len(tied):
            return at
        word = padded[at[tied] + depth]
        order = np.lexsort((word, group[tied]))
        at[tied], word = at[tied][order], word[order]
        step = np.zeros(len(at), bool)
        step[1:] = group[1:] != group[:-1]
        inner = np.zeros(len(tied), bool)
        inner[1:] = (word[1:] != word[:-1])
        step[tied] |= inner
        step[0] = False
        group = np.cumsum(step)
    tied = np.flatnonzero(np.bincount(group)[group] > 1)
    rest = MATCH - 24
    text = np.concatenate([data, np.zeros(MATCH, np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(text, rest)
    for a in range(0, len(tied), 1 << 17):  # whole groups at a time
        a = a if a == 0 else int(np.searchsorted(group[tied], group[tied[a]], "left"))
        b = min(len(tied), a + (1 << 17))
        b = len(tied) if b == len(tied) else int(np.searchsorted(group[tied], group[tied[b]], "left"))
        if b <= a:
            b = int(np.searchsorted(group[tied], group[tied[a]], "right"))
        own = tied[a:b]
        keys = np.empty((len(own), 4 + rest), np.uint8)
        keys[:, :4] = (group[own].astype(">u4")).view(np.uint8).reshape(-1, 4)
        keys[:, 4:] = view[at[own] + 24]
        at[own] = at[own][np.argsort(keys.view(f"S{4 + rest}").ravel(), kind="stable")]
    return at


def two_stage_order(data: np.ndarray) -> np.ndarray:
    """All suffixes in the order of their first MATCH bytes at least.

    Suffixes smaller than their successor are sorted directly; each other one follows, in the bucket of its first byte,
    the order of its successor: a scan of the buckets from the smallest byte on, which takes a bucket's induced suffixes
    before its sorted ones, appends every scanned suffix's larger predecessor to its own bucket.
    """
    n = len(data)
    change = np.flatnonzero(data[1:] != data[:-1]) if n else np.zeros(0, np.int64)
    falls = np.ones(n, bool)  # larger than the successor; the last suffix is
    upto = np.append(change, n - 1)
    value = np.append(data[change] > data[change + 1], True)
    falls = np.repeat(value, np.diff(np.concatenate([[-1], upto]))) if n else falls
    eights = _long_words(data)
    sorted_ones = direct_sort(data, eights, np.flatnonzero(~falls))
    cut = np.searchsorted(data[sorted_ones], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        waiting[data[n - 1]].append(np.array([n - 1]))
    out = []

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Sends the predecessors on; those of the same byte are returned."""
        before = scanned[scanned > 0] - 1
        before = before[falls[before]]
        first = data[before]
        own = before[first == byte]
        before, first = before[first != byte], first[first != byte]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        edges = np.flatnonzero(np.diff(first)) + 1
        for piece in np.split(before, edges) if len(before) else ():
            waiting[data[piece[0]]].append(piece)
        return own

    for byte in range(256):
        front = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(front):
            out.append(front)
            front = induce(front, byte)
        own = sorted_ones[cut[byte]:cut[byte + 1]]
        if len(own):
            out.append(own)
            induce(own, byte)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_windows(data: np.ndarray, is_window: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether the window at each position has an equal one, or is itself counted more than once."""
    order = two_stage_order(data)
    order = order[is_window[order]]
    eights = _long_words(data)
    # Of neighbours, whether the common prefix reaches MATCH bytes.
    alike = np.arange(max(0, len(order) - 1))
    for depth in range(0, MATCH, 8):
        alike = alike[eights[order[alike] + depth] == eights[order[alike + 1] + depth]]
    hit = np.zeros(len(data), bool)
    hit[order[alike]] = True
    hit[order[alike + 1]] = True
    return (hit | (is_window & (weight > 1)))


def _mark(table: pa.Table) -> pa.Table:
    """a, r and runs (begin, end of consecutive repeated windows, in turn) of the regions of one bucket that have any."""
    data, bounds = utf8(table.column("text"))
    windows, mult = (table.column(c).to_numpy().astype(np.int64) for c in ("windows", "mult"))
    owner = np.repeat(np.arange(len(windows)), np.diff(bounds))
    place = np.arange(len(data)) - bounds[:-1][owner]
    is_window = place < windows[owner]
    hit = repeated_windows(data, is_window, mult[owner])
    edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run never passes its region: the MATCH - 1 last positions of a region are no windows.
    of = owner[begin]
    runs = np.stack([begin - bounds[:-1][of], end - bounds[:-1][of]], 1).ravel().astype(np.int32)
    each = np.bincount(of, minlength=len(windows))
    some = np.flatnonzero(each)
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(2 * each[some])]).astype(np.int32)), pa.array(runs))
    return pa.table({"a": table.column("a").take(pa.array(some)), "r": table.column("r").take(pa.array(some)), "runs": lists})


def _marked(regions: DataFrame) -> DataFrame:
    """Repeated windows of regions; buckets are as many as the bytes ask for."""
    total = regions.agg(F.sum(F.length("text"))).first()[0] or 0
    bucket = F.pmod(F.xxhash64("a"), F.lit(max(1, -(-total // BUCKET_BYTES))))
    return regions.select("a", "r", "mult", "windows", "text", bucket.alias("bucket")).groupBy("bucket").applyInArrow(_mark, "a long, r long, runs array<int>")


def _merged(marks: DataFrame) -> DataFrame:
    """One row per region: what a region's parts, or its copies under one key, found stands together, so that a join by
    region makes no more rows than there are regions to mark."""
    return marks.groupBy("a", "r").agg(F.flatten(F.collect_set("runs")).alias("runs"))


def _cut(batches):
    for batch in (part for whole in batches for part in blocks(whole, limit=CUT_BYTES)):
        data, bounds = utf8(batch.column("text"))
        marks = batch.column("marks")
        each = marks.flatten()
        runs, s0 = each.field("runs"), each.field("s0").to_numpy(zero_copy_only=False).astype(np.int64)
        # Of every mark its text, of every run its mark; a run's begin and end are two numbers in turn.
        of = np.repeat(np.arange(len(marks)), pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False))
        own = np.repeat(bounds[:-1][of] + s0, pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False) // 2)
        turn = runs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        begin, end = own + turn[0::2], own + turn[1::2] - 1 + MATCH
        size = len(data) + 1
        gone = np.cumsum(np.bincount(begin, minlength=size) - np.bincount(end, minlength=size))[:-1] > 0
        # Spans begin and end with their text.
        edge = gone[1:] != gone[:-1]
        first, last = np.append(True, edge)[:len(data)], np.append(edge, True)[:len(data)]
        heads, full = bounds[:-1], np.diff(bounds) > 0
        first[heads[full]] = last[bounds[1:][full] - 1] = True
        starts, stops = np.flatnonzero(first & gone), np.flatnonzero(last & gone) + 1
        begins = np.searchsorted(starts, bounds)
        text_of = np.searchsorted(bounds[1:], starts, "right")
        removed = np.concatenate([[0], np.cumsum(gone)])[bounds]
        left, at = data[~gone].tobytes(), (bounds - removed).tolist()
        sha = [hashlib.sha256(left[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
        kept = [left[a:b].decode(errors="ignore") for a, b in zip(at[:-1], at[1:])]
        spans = pa.StructArray.from_arrays([pa.array(starts - heads[text_of]), pa.array(stops - heads[text_of])], names=["start", "stop"])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(np.diff(removed).astype(np.int64)),
            pa.array(np.diff(begins).astype(np.int64)), pa.array(sha, pa.string()),
            pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), spans), pa.array(kept, pa.string()),
        ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text"])


CUT = ("doc_id {doc}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>, "
       "kept_text string")


def repeated_regions(texts: DataFrame) -> DataFrame:
    """key and marks (s0, runs: where repeated windows begin and end from s0 on) of all texts (key, text) that have any."""
    repeated = texts.mapInArrow(_anchors, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").select("a")
    found = cut_lineage(texts.mapInArrow(_regions, REGION).join(cut_lineage(repeated), "a"))
    # Equal regions count as one, read from any document that holds them.
    once = found.groupBy("a", "r").agg(F.count("*").alias("mult"), F.min(F.struct("key", "s0", "windows", "off")).alias("m"))
    wanted = once.select("m.key", F.struct("a", "r", "mult", "m.s0", "m.windows", "m.off").alias("w")).groupBy("key").agg(F.collect_list("w").alias("wanted"))
    level = cut_lineage(texts.join(wanted, "key").select("text", "wanted").mapInArrow(
        _extract, "a long, r long, mult long, windows int, off int, text binary"))

    settled, ways = [], []
    for width in WIDTHS:
        many = cut_lineage(level.groupBy("a").count().where(F.col("count") > MANY).select("a"))
        if many.isEmpty():
            break
        parts = cut_lineage(level.join(many, "a", "left_semi").mapInArrow(
            lambda batches, width=width: _parts(batches, width), "pa long, pr long, shift int, a long, r long, mult long, windows int, off int, text binary"))
        settled.append(level.join(many, "a", "left_anti"))
        ways.append(parts.select("pa", "pr", "shift", "a", "r"))
        level = cut_lineage(parts.groupBy("a", "r").agg(F.sum("mult").alias("mult"), F.first("windows").alias("windows"), F.first("off").alias("off"), F.first("text").alias("text")))
    marks = cut_lineage(_merged(_marked(level)))
    for regions, way in zip(reversed(settled), reversed(ways)):
        back = marks.join(way, ["a", "r"]).select(F.col("pa").alias("a"), F.col("pr").alias("r"), F.transform("runs", lambda x: x + F.col("shift")).alias("runs"))
        marks = cut_lineage(_merged(_marked(regions).unionByName(back)))
    # Rows equal in id and text share a key and their regions, which count once.
    return found.join(marks, ["a", "r"]).groupBy("key").agg(F.collect_set(F.struct("s0", "runs")).alias("marks"))


def _cut_rows(rows: DataFrame) -> DataFrame:
    marks = repeated_regions(rows.select("key", "text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.join(marks, "key", "left").select("doc", "text", "marks").mapInArrow(_cut, CUT.format(doc=kind))


def drop_repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (byte offsets in the original) and kept_text, one row per row.

    Every byte under a string of MATCH bytes that also starts elsewhere, in the same or another document, is removed; the
    judgement is on the input as it is. kept_sha256 is over the remaining bytes; kept_text leaves out bytes that a cut
    through a character left behind. Null and empty texts have no bytes and no spans; ids are carried as they are, null
    or repeated; rows equal in id and text are two occurrences and share their result. Empty tables give no rows; further
    columns are ignored. One text at a time is held whole; a bucket holds BUCKET_BYTES and its largest anchor, which is
    at most MANY regions.
    """
    return _cut_rows(keyed(docs, id_col, text_col))


def cut_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with all their columns, texts cut as drop_repeated_substrings() does, the length column set anew
    where there is one; documents that lost bytes and have no word left are dropped, all others stay."""
    cut = _cut_rows(keyed(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    lost, left = F.col("n_removed") > 0, F.col("kept_text")
    new = {text_col: left} | ({length_col: F.length(left).cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})
    columns = [(F.when(lost, new[c]).otherwise(F.col(f"doc_id.`{c}`")) if c in new else F.col(f"doc_id.`{c}`")).alias(c) for c in docs.columns]
    return cut.where(~lost | left.rlike(r"[^\x20\x09-\x0D]")).select(*columns)
