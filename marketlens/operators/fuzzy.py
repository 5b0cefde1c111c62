"""Near-duplicate text values: a lossless similarity self-join.

The similarity is the Ratcliff-Obershelp ratio 2M / (|a| + |b|), M being the matched characters. A
ratio of at least t leaves at most (1 - t)(|a| + |b|) characters unmatched, which bounds from below
how many character pairs both strings share. Values are therefore joined on the rarest of their
character pairs only (prefix filter): two values above the threshold always meet there, while
frequent pairs, the ones that would make large groups, are hardly ever joined on. The index is kept by
bands of the partner's length as well, and a pair enters it only where its position in the value's
order still leaves room for what such a partner must share (positional filter).
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marketlens.functions.scalar import round_half_even

#: Ratio of the lengths at a band's ends.
BAND = 1.05


def similarity(a: str, b: str) -> Column:
    """The exact ratio of two text columns, in Arrow batches.

    The function is nested so that it travels to the workers by value.
    """

    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y)], dtype="float64")

    return F.pandas_udf(ratio, DoubleType())(a, b)


def shared_at_least(length: Column, threshold: float, q: int) -> Column:
    """Lower bound of the q-grams a value shares with any value above the threshold.

    The shortest partner has length * t / (2 - t) characters, so the lengths add up to at least
    2 * length / (2 - t) and M is at least length * t / (2 - t). Single characters: M of them. Pairs:
    M minus the number of matching blocks, of which there is at most one more than unmatched characters.
    """
    total = 2 * length / (2 - threshold)
    matched = total * threshold / 2
    bound = matched if q == 1 else 3 * matched - total - 1
    return F.ceil(bound - 1e-9)


def _tokens(values: DataFrame, q: int) -> DataFrame:
    """(value, size, token): q-grams numbered by occurrence, so that sets of tokens stand for multisets; as hashes.

    Two tokens of one hash only make more values meet.
    """
    starts = F.when(F.col("size") >= q, F.sequence(F.lit(1), F.col("size") - (q - 1))).otherwise(F.array())
    grams = values.select("value", "size", F.explode(F.transform(starts, lambda i: F.substring("value", i, q))).alias("gram"))
    counted = grams.groupBy("value", "size", "gram").agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.select("value", "size", "gram", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_i"))
    return numbered.select("value", "size", F.xxhash64("gram", "_i").alias("token"))


def _prefixes(tokens: DataFrame, threshold: float, q: int) -> DataFrame:
    """Per value the rarest tokens in one order for all, as many as the bound allows to disagree plus one, and their number."""
    frequency = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_f"))
    ordered = tokens.join(frequency, "token").groupBy("value", "size").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_f", "token"))), lambda t: t["token"]).alias("_all")
    )
    keep = F.size("_all") - shared_at_least(F.col("size"), threshold, q) + 1
    return ordered.select("value", "size", F.size("_all").alias("n"),
                          F.slice("_all", F.lit(1), F.greatest(keep, F.lit(0)).cast("int")).alias("prefix"))


def _band(size: Column) -> Column:
    return F.floor(F.log(F.greatest(size.cast("double"), F.lit(1.0))) / math.log(BAND)).cast("int")


def _entries(prefixes: DataFrame, threshold: float, q: int, shorter: bool) -> DataFrame:
    """One row per prefix token and band of partner lengths in which the token's position leaves room for the overlap.

    At the first token that two values share, all they share lies from there on: a value with n tokens can share
    n - position of them (positions from 0). What a partner of a band asks for at least follows from its least length.
    """
    size = F.col("size").cast("double")
    if shorter:
        bands = F.sequence(_band(size), _band(size * (2 - threshold) / threshold + 1e-6))
    else:
        bands = F.sequence(_band(size * threshold / (2 - threshold) - 1e-6), _band(size))
    least = F.pow(F.lit(BAND), F.col("band")) * (1 - 1e-9)
    partner = F.greatest(size, least) if shorter else least
    total = size + partner
    matched = total * threshold / 2
    asked = F.ceil((matched if q == 1 else 3 * matched - total - 1) - 1e-6)
    rows = prefixes.select("value", "size", "n", "prefix", F.posexplode("prefix").alias("position", "token")).select(
        "*", F.explode(bands).alias("band")).where(F.col("n") - F.col("position") >= asked)
    own, other = ("band_a", "band_b") if shorter else ("band_b", "band_a")
    side = "a" if shorter else "b"
    return rows.select(F.col("value").alias(f"value_{side}"), F.col("size").alias(f"size_{side}"), F.col("prefix").alias(f"prefix_{side}"),
                       "token", _band(size).alias(own), F.col("band").alias(other))


def meeting_pairs(prefixes: DataFrame, threshold: float, q: int) -> DataFrame:
    """Pairs that meet in the index by token and both length bands, the shorter value first, each produced once: at their
    first common token."""
    left, right = (_entries(prefixes, threshold, q, shorter) for shorter in (True, False))
    total = F.col("size_a") + F.col("size_b")
    ordered = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("value_a") < F.col("value_b")))
    close = 2 * F.col("size_a") >= threshold * total - 1e-9
    first = F.element_at(F.array_intersect("prefix_a", "prefix_b"), 1) == F.col("token")
    return left.join(right, ["token", "band_a", "band_b"]).where(ordered & close & first)


def _candidates(prefixes: DataFrame, threshold: float, q: int) -> DataFrame:
    """Meeting pairs that pass the edit distance: necessary for the ratio and cheap, it never exceeds the unmatched characters."""
    total = F.col("size_a") + F.col("size_b")
    near = F.levenshtein("value_a", "value_b") <= (1 - threshold) * total + 1e-9
    return meeting_pairs(prefixes, threshold, q).where(near).select(
        F.least("value_a", "value_b").alias("value_a"), F.greatest("value_a", "value_b").alias("value_b"))


def fuzzy_duplicates(df: DataFrame, column: str, threshold: float = 0.90) -> DataFrame:
    """Pairs of distinct normalised values whose similarity reaches the threshold. Nothing is sampled."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    values = (
        df.select(F.lower(F.trim(F.col(column).cast("string"))).alias("value"))
        .where(F.col("value").isNotNull()).distinct().withColumn("size", F.char_length("value"))
    )
    q = 2 if threshold > 2 / 3 else 1
    found = _candidates(_prefixes(_tokens(values, q), threshold, q), threshold, q)
    if q == 2:
        # Values too short for the pair bound, and everything a length filter lets them meet.
        shortest = 1
        while (1.5 * threshold - 1) * 2 * shortest / (2 - threshold) - 1 <= 1e-9:
            shortest += 1
        short = values.where(F.col("size") < shortest * (2 - threshold) / threshold)
        found = found.union(_candidates(_prefixes(_tokens(short, 1), threshold, 1), threshold, 1)).distinct()
    scored = found.withColumn("_ratio", similarity("value_a", "value_b")).where(F.col("_ratio") >= threshold)
    return scored.select("value_a", "value_b", round_half_even("_ratio", 3).alias("similarity"))
