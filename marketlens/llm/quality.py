"""Quality rules: distribution divergence from language references, beside counted base rules.

Each document's histograms of character classes and of its language's common words are held against the language's own
histograms (sums over all its documents) by Jensen-Shannon distance (square root of the divergence in bits, 0 to 1).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.text import SPACE, blocks, longs, mix, utf8, word_hashes, words, _BASE
from marketlens.sizing import cut_lineage

#: Classes of bytes: small letters, capitals, digits, sentence punctuation, symbols, bytes of non-ASCII characters.
CLASSES = 6
_CLASS = np.full(256, 5, np.uint8)
_CLASS[:128] = 4
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
_CLASS[[ord(c) for c in ".,;:'\"-?()"]] = 3
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COMMON_WORDS = 64
#: Languages with the most words whose references every task holds; documents of the others get theirs by a join.
HELD_LANGUAGES = 1000
MIN_REFERENCE_WORDS, MIN_WORDS = 2000, 60
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.46
REPEAT_WIDTH = 8


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def class_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    ink = ~SPACE[data]
    return np.stack([_sums(ink & (_CLASS[data] == c), bounds) for c in range(CLASSES)], 1)


def _corpus(batches):
    """Partial sums of one task's blocks: by language, each class and each word that occurs."""
    for batch in batches:
        for part in blocks(batch):
            data, bounds = utf8(part.column("text"))
            starts, ends, first = words(data, bounds)
            h = word_hashes(data, starts, ends)
            langs = part.column("lang").fill_null("").dictionary_encode()
            code = langs.indices.to_numpy().astype(np.int64)
            of_word = np.repeat(code, np.diff(first))
            classes = class_counts(data, bounds)
            for c, name in enumerate(langs.dictionary.to_pylist()):
                found, n = np.unique(h[of_word == c], return_counts=True)
                own = classes[code == c].sum(0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * (len(found) + CLASSES), pa.string()), pa.array([False] * len(found) + [True] * CLASSES),
                    pa.concat_arrays([longs(found), pa.array(np.arange(CLASSES))]), pa.array(np.concatenate([n, own]).astype(np.int64)),
                ], names=["lang", "is_class", "item", "n"])


def references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", common: int = COMMON_WORDS) -> DataFrame:
    """lang, total (words), classes (counts of each class), items and shares (of the commonest words), over all documents of
    a language that has MIN_REFERENCE_WORDS words.

    Only word hashes and counts are shuffled, summed per block and task first, and stored; the ranking is cut to `common`
    words per task before it meets.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    counts = cut_lineage(rows.mapInArrow(_corpus, "lang string, is_class boolean, item long, n long").groupBy("lang", "is_class", "item").agg(F.sum("n").alias("n")))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "is_class").orderBy(F.desc("n"), "item"))).where(F.col("r") <= common)
    totals = counts.where("not is_class").groupBy("lang").agg(F.sum("n").alias("total"))
    totals = totals.where(F.col("total") >= MIN_REFERENCE_WORDS)
    wide = top.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_class"), F.struct("item", "n")))).alias("classes"),
        F.sort_array(F.collect_list(F.when(~F.col("is_class"), F.struct("item", "n")))).alias("words"))
    return wide.join(totals, "lang").select(
        "lang", "total", F.transform("classes", lambda x: x["n"].cast("double")).alias("classes"), F.transform("words", lambda x: x["item"]).alias("items"),
        F.transform("words", lambda x: x["n"] / F.col("total")).alias("shares"))


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p to q; rows need not be normalised, an empty row is at distance 0."""
    total = p.sum(1, keepdims=True)
    p = np.divide(p, total, out=np.zeros(p.shape), where=total > 0)
    q = np.broadcast_to(q / q.sum(), p.shape)
    m = (p + q) / 2
    part = lambda x: (x * np.log2(np.divide(x, m, out=np.ones(x.shape), where=x > 0))).sum(1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1)), 0.0)


def repeated_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text, the words that lie in windows of eight words found twice or more in it."""
    n = max(0, len(h) - REPEAT_WIDTH + 1)
    if not n:
        return np.zeros(len(first) - 1, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    weights = mix(np.arange(1, REPEAT_WIDTH + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    key = mix(doc[:n].astype(np.uint64) + np.uint64(7))
    for t in range(REPEAT_WIDTH):
        key += h[t:t + n] * weights[t]
    own = np.flatnonzero(doc[:n] == doc[REPEAT_WIDTH - 1:])
    order = own[np.argsort(mix(key[own]))]
    same = key[order][1:] == key[order][:-1]
    hit = np.zeros(len(order), bool)
    hit[1:] |= same
    hit[:-1] |= same
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, order[hit], 1)
    np.add.at(cover, order[hit] + REPEAT_WIDTH, -1)
    return _sums(np.cumsum(cover[:-1]) > 0, first)


def duplicate_lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each text, the lines that hold a word and equal an earlier one of it."""
    feeds = np.flatnonzero(data == 10)
    head = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    head = head[head < len(data)]
    stop = np.append(head[1:], len(data))
    stop = stop - ((stop > head) & (data[stop - 1] == 10)) if len(head) else stop
    inked = np.concatenate([[0], np.cumsum(~SPACE[data])])
    full = inked[stop] > inked[head]
    head, stop = head[full], stop[full]
    doc = np.searchsorted(bounds, head, "right") - 1
    h = word_hashes(data, head, stop)
    order = np.lexsort((h, doc))
    h, d = h[order], doc[order]
    again = np.zeros(len(order), bool)
    again[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[again], minlength=len(bounds) - 1).astype(np.int64)


def by_item(ref: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class counts, word hashes in order and their shares."""
    items = np.array(ref["items"], np.int64).view(np.uint64)
    order = np.argsort(items)
    return np.array(ref["classes"]), items[order], np.array(ref["shares"])[order]


def with_references(rows: DataFrame, refs: DataFrame) -> tuple[DataFrame, dict[str, dict]]:
    """The references of the HELD_LANGUAGES languages of most words, and rows with `ref`, that of any other language.

    The other languages' references are joined by language. None of those has more than its share of all words, and rows
    of the held languages, or of none, get a key of their own there, so no key is hot.
    """
    held = {r["lang"]: r.asDict() for r in refs.orderBy(F.desc("total"), "lang").limit(HELD_LANGUAGES).collect()}
    kind = "struct<classes:array<double>,items:array<bigint>,shares:array<double>>"
    if len(held) < HELD_LANGUAGES:
        return rows.withColumn("ref", F.lit(None).cast(kind)), held
    others = refs.where(~F.col("lang").isin(list(held))).select(F.col("lang").alias("_key"), F.struct("classes", "items", "shares").alias("ref"))
    alone = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
    keyed = rows.withColumn("_key", F.when(F.col("lang").isin(list(held)), alone).otherwise(F.col("lang")))
    return keyed.join(others, "_key", "left").select("doc_id", "lang", "text", "ref"), held


def _judged(batches, refs):
    for batch in batches:
        for part in blocks(batch):
            data, bounds = utf8(part.column("text"))
            starts, ends, first = words(data, bounds)
            h = word_hashes(data, starts, ends)
            n_words = np.diff(first)
            characters = _sums(~SPACE[data] & ((data & 0xC0) != 0x80), bounds)
            symbols = _sums(SYMBOLS[data], bounds)
            repeats = repeated_words(h, first)
            failed = (n_words < 20) | (100 * repeats > 30 * n_words)
            classes = class_counts(data, bounds).astype(float)
            by_class, by_word = np.full(len(n_words), np.nan), np.full(len(n_words), np.nan)
            langs = np.array(part.column("lang").fill_null("").to_pylist(), object)
            doc = np.repeat(np.arange(len(n_words)), n_words)
            own = part.column("ref")
            for lang in set(langs.tolist()):
                at = np.flatnonzero(langs == lang)
                ref = refs.get(lang) or own[int(at[0])].as_py()
                if ref is None:
                    continue
                expected, items, shares = by_item(ref)
                by_class[at] = distance(classes[at], expected)
                slot = np.minimum(np.searchsorted(items, h), len(items) - 1)
                known = np.where(items[slot] == h, slot, len(items))
                table = np.bincount(doc * (len(items) + 1) + known, minlength=len(n_words) * (len(items) + 1)).reshape(len(n_words), -1)
                by_word[at] = distance(table[at].astype(float), np.append(shares, max(1e-9, 1 - shares.sum())))
            far = (n_words >= MIN_WORDS) & ((by_class > MAX_CLASS_DISTANCE) | (by_word > MAX_WORD_DISTANCE))
            nan = lambda x: pa.array(x, mask=np.isnan(x))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (n_words, characters, symbols, duplicate_lines(data, bounds), repeats)),
                pa.array(failed), pa.array(~failed & ~far), nan(by_class), nan(by_word),
            ], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"])


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, both distances and the verdict of every document, one row per row.

    Null text counts as empty and fails; a null language is a language of its own. Fewer than MIN_WORDS words, or a
    language without a reference (fewer than MIN_REFERENCE_WORDS words in the corpus), leave only the base rules.
    Ids are carried as they are, also null or repeated; further columns are ignored; empty tables give no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    rows, refs = with_references(rows, cut_lineage(references(docs, lang_col, text_col)))
    shared = docs.sparkSession.sparkContext.broadcast(refs)
    return rows.mapInArrow(
        lambda batches: _judged(batches, shared.value),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
        "class_distance double, word_distance double")
