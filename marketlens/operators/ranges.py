"""Ranks by range partition: one ordered shuffle, no global sort in a task and no join back on the value.

Rows are dealt out by value range and ranked inside their partition. Every partition then needs three facts about the
others: how many rows lie below it, and how many rows share its first and its last value. These come from one small row per
partition (and group), which is broadcast. A value that holds much of the table is spread over several partitions, because
rows of equal value are dealt out by a running number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.sizing import cut_lineage, let_workers_import, scanned_bytes

PART_BYTES, MOST_PARTS = 64 * 1024 * 1024, 100_000


def range_parts(stored: DataFrame) -> int:
    """Partitions for a stored frame: by its bytes, at least as many as the session shuffles into."""
    least = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # A frame that is not stored has no known size, and an estimate beyond any table.
    return max(least, min(-(-scanned_bytes(stored) // PART_BYTES), MOST_PARTS))


def _runs(table: pa.Table, value: str, by: str | None, weight: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a sorted partition: the weight below its run of equal values in its group, and the run's weight."""
    v = table.column(value).to_numpy()
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) & ~(np.isnan(v[1:]) & np.isnan(v[:-1]))
    group = np.zeros(len(v), bool)
    group[0] = True
    if by is not None:
        g = table.column(by).to_numpy()
        group[1:] = g[1:] != g[:-1]
        new |= group
    w = table.column(weight).to_numpy().astype(np.int64) if weight else np.ones(len(v), np.int64)
    before = np.cumsum(w) - w
    starts, run = np.flatnonzero(new), np.cumsum(new) - 1
    first = np.flatnonzero(group)[np.cumsum(group) - 1]
    return before[starts][run] - before[first], np.add.reduceat(w, starts)[run]


def range_ranks(df: DataFrame, value: str, by: str | None = None, weight: str | None = None, parts: int | None = None) -> DataFrame:
    """Every row of `df` with `rank` (ties share the average of their places) and `ties` (rows of its value), within `by`.

    `value` is a double without nulls, `by` an integer column without nulls, `weight` says how many rows a row stands for.
    Equal values of a group may lie in several partitions: their counts are added up across the borders.
    """
    let_workers_import(df.sparkSession)
    keys = [by] if by else []
    dealt = df.repartitionByRange(parts or range_parts(df), *keys, value, F.monotonically_increasing_id())

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One partition: a bounded share of the rows, whatever their values.
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            below, ties = _runs(table, value, by, weight)
            yield from table.append_column("_below", pa.array(below)).append_column("_ties", pa.array(ties)).to_batches(65_536)

    ordered = dealt.sortWithinPartitions(*keys, value).withColumn("_part", F.spark_partition_id())
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema.fields)
    local = cut_lineage(ordered.mapInArrow(rank, f"{columns}, _below long, _ties long"))

    weighted = F.sum(weight) if weight else F.count(F.lit(1))
    ends = local.groupBy("_part", *keys).agg(
        weighted.alias("_n"), F.min(value).alias("_low"), F.max(value).alias("_high"),
        F.min_by("_ties", value).alias("_low_ties"), F.max_by("_ties", value).alias("_high_ties"))
    # One row per partition and group: few, so windows over a group's partitions see few rows.
    line = Window.partitionBy(*keys).orderBy("_part")
    shares = F.array(F.struct(F.col("_low").alias("v"), F.col("_low_ties").alias("t")), F.struct(F.col("_high").alias("v"), F.col("_high_ties").alias("t")))
    first_and_last = F.when(F.col("_low") == F.col("_high"), F.slice(shares, 1, 1)).otherwise(shares)
    border = (
        ends.withColumn("_lower", F.sum("_n").over(line) - F.col("_n"))
        .select("_part", *keys, "_lower", F.explode(first_and_last).alias("_s"), "_low", "_n", "_high_ties")
        .withColumn("_own", F.when(F.col("_s.v") == F.col("_low"), F.col("_lower")).otherwise(F.col("_lower") + F.col("_n") - F.col("_high_ties"))))
    same = Window.partitionBy(*keys, "_s.v")
    border = border.select(
        "_part", *keys, F.col("_s.v").alias("_border"), F.min("_own").over(same).alias("_from"), F.sum("_s.t").over(same).alias("_all"))
    lower = ends.select("_part", *keys, (F.sum("_n").over(line) - F.col("_n")).alias("_lower"))
    facts = border.groupBy("_part", *keys).agg(F.collect_list(F.struct("_border", "_from", "_all")).alias("_borders")).join(lower, ["_part", *keys])
    shared = F.filter("_borders", lambda b: b["_border"] == F.col(value))
    out = local.join(F.broadcast(facts), ["_part", *keys]).withColumn("_b", F.get(shared, F.lit(0)))
    ties = F.coalesce("_b._all", "_ties")
    start = F.coalesce(F.col("_b._from"), F.col("_lower") + F.col("_below"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], (start + (ties + 1) / 2).alias("rank"), ties.alias("ties"))
