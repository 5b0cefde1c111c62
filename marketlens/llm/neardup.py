"""MinHash near-dedup with tensored banding.

Two small collections of hash groups are computed per document, GROUPS groups of ROWS minima each; every pair of a group of
the first and a group of the second is the key of one table. So 2 * GROUPS * ROWS minima serve GROUPS**2 tables of
2 * ROWS rows. Documents that meet in a table are verified on their full shingle sets. A pair of similarity s meets in
some table with probability (1 - (1 - s**ROWS)**GROUPS)**2: 0.9995 at 0.75, 0.99993 at 0.8, 1 - 1e-6 at 0.87.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.text import LOWER, blocks, distinct_shingles, lists, longs, mix, utf8, word_hashes, words
from marketlens.sizing import broadcast_if_small, cut_lineage

SHINGLE, GROUPS, ROWS = 5, 10, 2
#: Links need PART * union <= WHOLE * intersection.
WHOLE, PART = 100, 75
#: Members of one block of a bucket; larger buckets are compared block by block.
BLOCK = 256
#: Smallest hashes of a set that are kept, and the share of common ones below which a pair is not compared in full.
SKETCH, LEAST_SHARE = 256, 0.65
_FACTORS = mix(np.arange(1, 2 * GROUPS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _sets(part, text: str = "text"):
    data, bounds = utf8(part.column(text))
    data = LOWER[data]
    starts, ends, first = words(data, bounds)
    return distinct_shingles(word_hashes(data, starts, ends), first, SHINGLE)


def _digests(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two sums over each set's hashes; empty sets have 0."""
    digest, full = np.zeros((len(bounds) - 1, 2), np.uint64), np.flatnonzero(np.diff(bounds) > 0)
    if len(full):
        digest[full, 0] = np.add.reduceat(values, bounds[full])
        digest[full, 1] = np.add.reduceat(mix(values + np.uint64(1)), bounds[full])
    return digest


def _signatures(batches):
    for batch in batches:
        for part in blocks(batch):
            values, bounds = _sets(part)
            n, full = np.diff(bounds), np.flatnonzero(np.diff(bounds) > 0)
            minima = np.zeros((len(n), 2 * GROUPS * ROWS), np.uint64)
            if len(full):
                for j, factor in enumerate(_FACTORS):
                    minima[full, j] = np.minimum.reduceat(values * factor, bounds[full])
            digest = _digests(values, bounds)
            grouped = minima.reshape(len(n), 2 * GROUPS, ROWS)
            code = mix(np.arange(2 * GROUPS, dtype=np.uint64)) + np.zeros((len(n), 1), np.uint64)
            for r in range(ROWS):
                code = mix(code + grouped[:, :, r])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(n.astype(np.int64)), longs(digest[:, 0]), longs(digest[:, 1]),
                lists(code.ravel().view(np.int64), np.arange(0, code.size + 1, 2 * GROUPS)),
            ], names=["doc_id", "n_shingles", "h1", "h2", "codes"])


def _sketches(batches):
    """The smallest hashes of each set, with the digests that tell rows of one id apart."""
    for batch in batches:
        for part in blocks(batch):
            values, bounds = _sets(part)
            digest = _digests(values, bounds)
            smallest = [(values[a:min(b, a + SKETCH)] >> np.uint64(32)).astype("<u4").tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), longs(digest[:, 0]), longs(digest[:, 1]), pa.array(smallest, pa.binary())],
                                             names=["node", "h1", "h2", "sketch"])


def _full_sets(batches):
    for batch in batches:
        for part in blocks(batch):
            values, bounds = _sets(part)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists(values.view(np.int64), bounds)], names=["doc_id", "hashes"])


def _alike(x: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """Whether sets may be as similar as a link asks, by their smallest hashes (sketches, padded with the largest value).

    Up to the smaller of the two sketches' ends both sets are known in full. Sets that fit their sketches are judged
    exactly, others by the share there, which at similarity 0.75 is below LEAST_SHARE with probability 1e-4 at most.
    """
    pad = np.iinfo(np.uint32).max
    end = np.minimum(x[-1], others[:, -1])[:, None]
    slot = np.minimum(np.searchsorted(x, others), len(x) - 1)
    inside = (others <= end) & (others != pad)
    common = ((x[slot] == others) & inside).sum(1)
    union = inside.sum(1) + ((x[None, :] <= end) & (x[None, :] != pad)).sum(1) - common
    exact = (n <= SKETCH) & (sizes <= SKETCH)
    return np.where(exact, WHOLE * common >= PART * union, common >= LEAST_SHARE * union)


def _across(table: pa.Table) -> pa.Table:
    """Pairs of one block pair of a bucket: from different components, of like size, alike by their sketches, and in
    the first table that both share."""
    side = table.column("side").to_numpy()
    ids, comp, n = (table.column(c).to_numpy() for c in ("node", "component", "n_shingles"))
    codes = np.array(table.column("codes").combine_chunks().values).reshape(len(ids), -1)
    sketches = np.full((len(ids), SKETCH), np.iinfo(np.uint32).max, np.uint32)
    for row, own in zip(sketches, table.column("sketch").to_pylist()):
        own = np.frombuffer(own, "<u4")
        row[:len(own)] = own
    i, j = divmod(table.column("tab")[0].as_py(), GROUPS) if len(ids) else (0, 0)
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    out_a, out_b = [], []
    for k in left.tolist():
        others = right[(comp[right] != comp[k]) & (WHOLE * np.minimum(n[right], n[k]) >= PART * np.maximum(n[right], n[k]))]
        if side[k] == 2:
            others = others[ids[others] > ids[k]]
        agree = codes[others] == codes[k]
        others = others[~agree[:, :i].any(1) & ~agree[:, GROUPS:GROUPS + j].any(1)]
        others = others[_alike(sketches[k], sketches[others], n[k], n[others])]
        out_a.append(np.minimum(ids[others], ids[k]))
        out_b.append(np.maximum(ids[others], ids[k]))
    return pa.table({"a": np.concatenate(out_a or [ids[:0]]), "b": np.concatenate(out_b or [ids[:0]])})


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of which 100 times the intersection of the full sets is at least 75 times the union.

    Only the documents that pairs name are shingled again, so no sets are stored.
    """
    named = broadcast_if_small(cut_lineage(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()))
    sets = docs.join(named, "doc_id", "left_semi").mapInArrow(_full_sets, "doc_id long, hashes array<long>")

    def check(batches):
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            xo, yo, xv, yv = x.offsets.to_numpy(), y.offsets.to_numpy(), x.values.to_numpy(), y.values.to_numpy()
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                p, q = xv[xo[i]:xo[i + 1]], yv[yo[i]:yo[i + 1]]
                both = len(np.intersect1d(p, q, assume_unique=True))
                good[i] = WHOLE * both >= PART * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(good))

    left, right = (sets.select(F.col("doc_id").alias(k), F.col("hashes").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of the links, by contraction.

    Each round every node takes the smallest of itself and its neighbours, follows that node's own choice, and the links
    are rewritten to the choices; links within one choice vanish. The rounds grow with the logarithm of the longest path.
    """
    nodes = cut_lineage(links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct().withColumn("component", F.col("node")))
    while True:
        if links.isEmpty():
            return nodes
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        best = cut_lineage(best)
        jumped = cut_lineage(best.alias("p").join(best.select(F.col("n").alias("k"), F.col("m").alias("mm")), F.col("p.m") == F.col("k")).select("p.n", "mm"))
        nodes = cut_lineage(nodes.join(jumped.withColumnRenamed("n", "component"), "component", "left").select("node", F.coalesce("mm", "component").alias("component")))
        one = jumped.select(F.col("n").alias("a"), F.col("mm").alias("am"))
        two = jumped.select(F.col("n").alias("b"), F.col("mm").alias("bm"))
        links = cut_lineage(links.join(one, "a").join(two, "b").where("am != bm").select(F.least("am", "bm").alias("a"), F.greatest("am", "bm").alias("b")).distinct())


def shared_codes(classes: DataFrame) -> DataFrame:
    """node, codes and shared, the bits of its 2 * GROUPS codes that another node has too, of the nodes with any.

    A table's key is shared by two nodes only if they share both its codes, so all other keys need not be made.
    """
    single = classes.select("node", F.posexplode("codes").alias("pos", "code"))
    repeated = single.groupBy("code").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi").select("code")
    bits = single.join(repeated, "code", "left_semi").groupBy("node").agg(F.bit_or(F.expr("shiftleft(1, pos)")).alias("shared"))
    return classes.select("node", "codes").join(bits, "node")


def tables(nodes: DataFrame) -> DataFrame:
    """node, tab, key: one row per table of which both codes are shared."""
    first, second = F.slice("codes", 1, GROUPS), F.slice("codes", GROUPS + 1, GROUPS)
    keys = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x, y))))
    both = f"shiftright(shared, cast(tab div {GROUPS} as int)) & shiftright(shared, {GROUPS} + tab % {GROUPS}) & 1"
    return nodes.select("node", "shared", F.posexplode(keys).alias("tab", "key")).where(f"({both}) = 1").drop("shared")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept and n_copies (documents of the same set) of every document, one row per row.

    Null and empty texts have no shingles and are linked with nothing. A null id cannot be linked: its component is null
    and it is kept. Rows that share an id are one node of the links; each row's own set decides its component. Empty
    tables give no rows; further columns are ignored.

    Equal sets meet by a digest and count as one document from then on, so a group of copies costs a row per task. Keys are
    made of codes that at least two of them share. In each table's bucket all are first compared with its smallest id; after linking these, members of a bucket that still
    are in different components are compared across them, in blocks. So no link between components is lost, and a
    bucket of mutual near copies costs its size.
    """
    return _judged(docs, id_col, text_col).drop("h1", "h2")


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates() with the digests of each row's set."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = cut_lineage(source.mapInArrow(_signatures, "doc_id long, n_shingles long, h1 long, h2 long, codes array<long>"))
    classes = rows.where("doc_id is not null and n_shingles > 0").groupBy("h1", "h2", "n_shingles").agg(
        F.min(F.struct("doc_id", "codes")).alias("m"), F.count("*").alias("n_copies"))
    classes = cut_lineage(classes.select("h1", "h2", "n_shingles", "n_copies", F.col("m.doc_id").alias("node"), F.col("m.codes").alias("codes")))

    met = tables(cut_lineage(shared_codes(classes)))
    buckets = met.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot != last").drop("last")
    members = cut_lineage(met.join(cut_lineage(buckets), "key"))

    # The texts that any comparison below reads, once: only documents that share a bucket.
    shared = cut_lineage(members.select(F.col("node").alias("doc_id")).distinct())
    with_text = cut_lineage(source.where("doc_id is not null").join(broadcast_if_small(shared), "doc_id", "left_semi"))
    star = cut_lineage(members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    links = cut_lineage(verified(with_text, star))
    found = components(links)
    placed = members.select("key", "tab", "node").join(found, "node", "left").select("key", "tab", "node", F.coalesce("component", "node").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).where("lo != hi")
    # Pairs of two were compared as pivot and member.
    open_keys = open_keys.where("n > 2").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    opened = cut_lineage(placed.join(open_keys, "key"))
    # Only the members of open buckets are sketched, so no sketches are stored.
    asked = broadcast_if_small(cut_lineage(opened.select(F.col("node").alias("doc_id")).distinct()))
    sketches = with_text.join(asked, "doc_id", "left_semi").mapInArrow(
        _sketches, "node long, h1 long, h2 long, sketch binary").dropDuplicates(["node", "h1", "h2"])
    facing = opened.join(classes.select("node", "h1", "h2", "n_shingles", "codes").join(sketches, ["node", "h1", "h2"]), "node")
    own = F.pmod(F.xxhash64("node"), "parts").cast("int")
    facing = facing.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "key", "tab", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "node", "component", "n_shingles", "codes", "sketch",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    # Comparing takes longer than its rows' bytes tell, so these are dealt to all partitions.
    facing = facing.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), "key", "p", "q")
    across = facing.groupBy("key", "p", "q").applyInArrow(_across, "a long, b long").join(star, ["a", "b"], "left_anti")
    across = cut_lineage(across)
    if not across.isEmpty():
        more = cut_lineage(verified(with_text, across))
        if not more.isEmpty():
            found = components(links.unionByName(more))

    placed = classes.select("h1", "h2", "n_shingles", "n_copies", "node").join(found, "node", "left").select(
        "h1", "h2", "n_shingles", "n_copies", F.coalesce("component", "node").alias("component"))
    empty = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    out = rows.drop("codes").join(placed, ["h1", "h2", "n_shingles"], "left")
    component = F.when(empty, F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
                      F.when(empty, F.lit(1)).otherwise(F.col("n_copies")).cast("long").alias("n_copies"), "h1", "h2")


def _with_sets(batches):
    """Rows, as they are, with the digests of their sets."""
    for batch in batches:
        for part in blocks(batch):
            values, bounds = _sets(part)
            digest = _digests(values, bounds)
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(np.diff(bounds)), longs(digest[:, 0]), longs(digest[:, 1])],
                                             names=["row", "n_shingles", "h1", "h2"])


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that near_duplicates() keeps.

    Rows without an id stay. Of rows that share an id each is judged by its own text: of those kept, rows of one set of
    shingles stay once, rows without shingles once for each text.
    """
    judged = _judged(docs, id_col, text_col).where("doc_id is not null")
    found = judged.groupBy("doc_id").agg(F.max(~F.col("kept")).alias("gone"), F.count("*").alias("n"))
    flags = cut_lineage(found.where("gone or n > 1"))
    marked = docs.alias("d").join(flags.alias("f"), F.col(f"d.{id_col}") == F.col("f.doc_id"), "left")
    single = marked.where("f.n is null or (f.n = 1 and not f.gone)").select("d.*")
    # Rows that share an id: few, unless the table is made of them.
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns])
    several = marked.where("f.n > 1").select(row.alias("row"), F.col(f"d.{text_col}").alias("text"))
    sets = several.mapInArrow(_with_sets, f"row {several.schema['row'].dataType.simpleString()}, n_shingles long, h1 long, h2 long")
    verdicts = judged.where("kept").select("doc_id", "n_shingles", "h1", "h2").distinct()
    own = F.col(f"s.row.`{id_col}`").cast("long") == F.col("v.doc_id")
    same = own & (F.col("s.n_shingles") == F.col("v.n_shingles")) & F.col("s.h1").eqNullSafe(F.col("v.h1")) & F.col("s.h2").eqNullSafe(F.col("v.h2"))
    kept = sets.alias("s").join(verdicts.alias("v"), same, "left_semi")
    each = kept.withColumns({"_id": F.col(f"row.`{id_col}`"), "_text": F.when(F.col("n_shingles") == 0, F.col(f"row.`{text_col}`"))})
    return single.unionByName(each.dropDuplicates(["_id", "n_shingles", "h1", "h2", "_text"]).select("row.*"))
