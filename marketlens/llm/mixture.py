"""Mixing sources to target weights by entropy balancing.

Each source has one constraint: the expected words taken equal its target. Among all rates between 0 and CEILING the one
of greatest entropy is CEILING / (1 + exp(-lambda * size / mean size)), an exponential tilt of the documents of a source by
their length with one multiplier per source, found by Newton steps on the convex dual. The rates are then rounded into
copies, with the carried error of one document passed on to the next.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.text import blocks, utf8, words
from marketlens.sizing import cut_lineage

#: Base weights of the sources in their order, repeated; the share of all words that the mix takes; words at most per word.
WEIGHTS, SHARE, CEILING = (5, 2, 1), 1.5, 2
STEPS, TOLERANCE = 60, 1e-6
#: Documents of one rounding group on average.
GROUP_ROWS = 2_000


def _sizes(batches):
    for batch in batches:
        for part in blocks(batch):
            data, bounds = utf8(part.column("text"))
            _, _, first = words(data, bounds)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), part.column("salt"), pa.array(np.diff(first))],
                                             names=["doc_id", "source", "salt", "size"])


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc_id, source, salt (a hash of id and text), size in words."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(id_col, text).alias("salt"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_sizes, f"doc_id {kind}, source string, salt long, size long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, ceiling: float = CEILING) -> DataFrame:
    """source, source_size, target: shares by weight, none above ceiling times its size, the excess reshared.

    With sources by ascending cap per weight the capped ones come first, so the level that all others share by weight is
    a running sum. The windows run over one row per source.
    """
    # hex of UTF-8 orders as the code points do
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("cap", ceiling * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("source").isNull(), F.hex(F.encode(F.coalesce("source", F.lit("")), "UTF-8")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = per.withColumn("weight", weight).withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    totals = per.agg(F.sum("source_size").cast("double").alias("words"))
    weigh = ranked.agg(F.sum("weight").alias("weights"))
    out = ranked.join(F.broadcast(totals)).join(F.broadcast(weigh))  # two frames of one row each
    left = share * F.col("words") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    level = left / (F.col("weights") - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    out = out.withColumn("level", level)
    # The first source that is below its cap at the level of those not yet capped sets the level for the rest.
    fixed = out.agg(F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "level"))).alias("at"))
    final = out.join(F.broadcast(fixed))
    return final.select("source", "source_size", F.least("cap", F.coalesce(F.col("weight") * F.col("at.level"), F.col("cap"))).alias("target"))


def multipliers(histogram: DataFrame, targets: DataFrame, ceiling: float = CEILING, steps: int = STEPS) -> DataFrame:
    """source, scale (mean size) and lambda of each source, by Newton steps that bisection keeps in bounds.

    One step is one aggregate over the (source, size) histogram; the sources' state, a row each, is stored between steps.
    A source whose target is its ceiling gets infinity, one without words 0.
    """
    means = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = targets.join(means, targets["source"].eqNullSafe(means["source"])).select(
        targets["source"], "scale", "target",
        F.when(F.col("target") >= ceiling * F.col("source_size") * (1 - 1e-12), F.when(F.col("source_size") > 0, float("inf")).otherwise(0.0)).otherwise(0.0).alias("lambda"),
        F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"),
        ((F.col("target") >= ceiling * F.col("source_size") * (1 - 1e-12)) | (F.col("source_size") == 0)).alias("done"))
    state = cut_lineage(state)
    for _ in range(steps):
        if state.where("not done").isEmpty():
            break
        h, s = histogram.alias("h"), state.where("not done").alias("s")
        x = F.col("h.size") / F.col("s.scale")
        rate = ceiling / (1 + F.exp(-F.col("s.lambda") * x))
        taken = F.sum(F.col("h.n") * F.col("h.size") * rate)
        slope = F.sum(F.col("h.n") * F.col("h.size") * x * rate * (1 - rate / ceiling))
        sums = h.join(s, F.col("h.source").eqNullSafe(F.col("s.source"))).groupBy(F.col("s.source").alias("source")).agg(
            (taken - F.first("s.target")).alias("gap"), slope.alias("slope"))
        old, new = state.alias("o"), sums.alias("u")
        gap = F.col("u.gap")
        low = F.when(gap < 0, F.col("o.lambda")).otherwise(F.col("o.low"))
        high = F.when(gap > 0, F.col("o.lambda")).otherwise(F.col("o.high"))
        step = F.col("o.lambda") - gap / F.greatest(F.col("u.slope"), F.lit(1e-300))
        inside = (step > low) & (step < high)
        close = F.abs(gap) <= TOLERANCE * F.greatest(F.col("o.target"), F.lit(1.0))
        state = cut_lineage(old.join(new, F.col("o.source").eqNullSafe(F.col("u.source")), "left").select(
            "o.source", "o.scale", "o.target",
            F.when(F.col("o.done") | close, F.col("o.lambda")).when(inside, step).otherwise((low + high) / 2).alias("lambda"),
            F.when(F.col("o.done"), F.col("o.low")).otherwise(low).alias("low"), F.when(F.col("o.done"), F.col("o.high")).otherwise(high).alias("high"),
            (F.col("o.done") | F.coalesce(close, F.lit(True))).alias("done")))
    return state.select("source", "scale", "lambda")


def _round(table: pa.Table) -> pa.Table:
    """Whole copies by the running error, large documents first; the last error is taken as part of one document."""
    size, rate, salt = (table.column(c).to_numpy() for c in ("size", "rate", "salt"))
    order = np.lexsort((salt, -size))
    taken = np.zeros(len(size), np.int64)
    carry = 0.0
    for i, s, r in zip(order.tolist(), size[order].tolist(), rate[order].tolist()):
        carry += s * r
        copies = min(2, max(0, int(carry / s + 0.5))) if s else 0
        taken[i] = copies * s
        carry -= copies * s
    for i in order[::-1].tolist() if abs(carry) >= 1 else ():
        part = int(max(-taken[i], min(2 * size[i] - taken[i], round(carry))))
        taken[i] += part
        carry -= part
        if abs(carry) < 1:
            break
    return table.select(["doc_id", "size", "source_size", "target", "salt", "rate"]).append_column("taken", pa.array(taken))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, rate and salt of every document, one row per row.

    A null text has size 0 and nothing is taken of it; a null source is a source of its own, ranked last; ids are carried
    as they are. Rows equal in id and text differ at most in the order they are rounded in. Empty tables give no rows;
    further columns are ignored. `taken` is copies x size but for one document or so per rounding group, of which a part
    is taken to meet the target; groups are drawn by hash within a source, so a hot source has many.
    """
    sizes = cut_lineage(sized(docs, id_col, text_col, source_col))
    targets = cut_lineage(source_targets(sizes))
    histogram = cut_lineage(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")))
    tilt = multipliers(histogram, targets)
    per = targets.alias("t").join(tilt.alias("m"), F.col("t.source").eqNullSafe(F.col("m.source")), "left").select(
        "t.source", "t.source_size", "t.target", F.coalesce("m.scale", F.lit(1.0)).alias("scale"), F.coalesce("m.lambda", F.lit(0.0)).alias("lambda"))
    counts = sizes.groupBy("source").agg(F.ceil(F.count("*") / GROUP_ROWS).alias("groups"))
    per = cut_lineage(per.alias("p").join(counts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source"))).select("p.*", "c.groups"))
    rated = sizes.alias("d").join(per.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "d.doc_id", "d.source", "d.size", "d.salt", "p.source_size", "p.target",
        F.pmod("d.salt", "p.groups").alias("grp"),
        F.when(F.col("p.lambda") == float("inf"), float(CEILING)).otherwise(CEILING / (1 + F.exp(-F.col("p.lambda") * F.col("d.size") / F.col("p.scale")))).alias("rate"))
    kind = sizes.schema["doc_id"].dataType.simpleString()
    return rated.groupBy("source", "grp").applyInArrow(
        _round, f"doc_id {kind}, size long, source_size long, target double, salt long, rate double, taken long")


def _repeat(batches):
    """Rows as often as they are taken; `cut` is the text of a part, null for whole copies."""
    for batch in batches:
        for part in blocks(batch):
            data, bounds = utf8(part.column("text"))
            _, ends, first = words(data, bounds)
            size, taken = np.diff(first), part.column("taken").to_numpy()
            whole, rest = taken // np.maximum(size, 1), taken % np.maximum(size, 1)
            at = np.repeat(np.arange(len(size)), whole + (rest > 0))
            last = np.cumsum(whole + (rest > 0)) - 1
            cut = [None] * len(at)
            raw = data.tobytes()
            for i in np.flatnonzero(rest > 0).tolist():
                cut[last[i]] = raw[bounds[i]:ends[first[i] + rest[i] - 1]].decode()
            yield pa.RecordBatch.from_arrays([part.column("row").take(pa.array(at)), pa.array(cut, pa.string())], names=["row", "cut"])


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str = "n_chars") -> DataFrame:
    """The documents with all their columns, each as often as mix_sources() takes it.

    A part is the text up to the end of its last word; its length column is set anew. Rows equal in id and text share
    what they take equally. Documents without words are not taken.
    """
    mix = mix_sources(docs, id_col, text_col, source_col).groupBy("doc_id", "salt").agg(F.floor(F.avg("taken")).alias("taken")).where("taken > 0").alias("m")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(id_col, text_col).alias("salt")).alias("d")
    joined = rows.join(mix, (F.col("d.salt") == F.col("m.salt")) & F.col("d.id").eqNullSafe(F.col("m.doc_id"))).select("d.row", "d.text", "m.taken")
    out = joined.mapInArrow(_repeat, f"row {joined.schema['row'].dataType.simpleString()}, cut string")
    new = {text_col: F.col("cut")} | ({length_col: F.length("cut").cast(docs.schema[length_col].dataType)} if length_col in docs.columns else {})
    return out.select(*[(F.coalesce(new[c], F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
