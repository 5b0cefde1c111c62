"""Web archives, lexical search and periodic runs on small fixtures: against brute force and by exact round trips."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import zstandard

from marketlens.llm import lexical, periodic, queries, warc

rng = np.random.default_rng(11)
WORDS = ["".join(rng.choice(list("abcdeé"), rng.integers(2, 5))) for _ in range(60)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n).tolist())


# Archives

LARGE = "<p>é" + "x" * 1200
PAGES = [(1, "http://a/1", LARGE), (2, "http://a/2", LARGE), (7, None, LARGE), (3, "http://a/\r\nX: y z", "short"), (4, "u", "short"),
         (5, "u", None), (6, "u", ""), (None, "n", LARGE), (8, "http://é", "y" * 3_000_000), (9, "r", "\r\n\r\nWARC/1.1" * 200),
         (9, "r", "\r\n\r\nWARC/1.1" * 200), (None, "m", "z" * 2000), (None, "m", "z" * 2000), (10, "u", "w" * 1000), (11, "u", "w" * 1000),
         (12, "u", "v" * 999), (13, "u", "v" * 999)]
PAGE_DDL = "page_id long, url string, html string, payload string, _first long, payload_digest string, bundle string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "p", 1, "d", "b") for r in PAGES], PAGE_DDL)


def expected_pages():
    top = {}
    for page, _, html in PAGES:
        if page is not None:
            top[html or ""] = max(top.get(html or "", page), page)
    rows = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        again = len(data) >= 1000 and top.get(html or "") not in (None, page)
        rows.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", top[html] if again else None))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_archives(spark, pages, monkeypatch, broadcast_bytes):
    own = warc.with_first_copies
    monkeypatch.setattr(warc, "with_first_copies", lambda p, m: own(p, m, broadcast_bytes))
    index = warc.write_archives(pages)
    records = warc.read_archives(index)
    got = records.collect()
    fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[f] for f in fields) for r in got), key=repr) == expected_pages()
    assert sorted((r["payload"] for r in got if r["record_type"] == "response"), key=repr) == sorted(
        ((h or "").encode() for (p, _, h), e in zip(PAGES, PAGES) if (p, len((h or "").encode())) in {
            (x[0], x[1]) for x in expected_pages() if x[3] == "response"}), key=repr)
    assert index.count() == len(PAGES)


def test_cold_groups_are_joined(spark, monkeypatch):
    """Few hot groups, many cold ones, and rows without a group, all beyond the broadcast bound."""
    monkeypatch.setattr(warc, "HOT_SHARE", 5)
    rows = [(i, "u", "h" * 1500) for i in range(60)] + [(100 + i, "u", chr(97 + i % 20) * 1100) for i in range(40)] + [(200 + i, "u", "s") for i in range(30)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    joined = warc.with_first_copies(pages, broadcast_bytes=-1)
    got = {r["page_id"]: r["_first"] for r in joined.collect()}
    assert got == {i: 59 if i < 60 else (120 + i % 20 if i < 200 else None) for i, _, _ in rows}


def test_frames_are_independent_and_indexed(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"{i} " + prose(3000, i)) for i in range(150)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path))
    [path] = tmp_path.glob("*.warc.zst")
    with open(path, "rb") as source:
        frames = warc.read_seek_table(source, path.stat().st_size)
        source.seek(0)
        whole = source.read()
    assert len(frames) > 1
    # Any Zstandard reader reads the whole file: the seek table is a skippable frame.
    plain = zstandard.ZstdDecompressor().stream_reader(whole, read_across_frames=True).read()
    assert len(plain) == sum(f[2] for f in frames)
    for r in index.collect()[::17]:
        start, packed, size = frames[r["frame"]]
        assert (start, packed) == (r["frame_start"], r["frame_bytes"])
        frame = zstandard.ZstdDecompressor().decompress(whole[start:start + packed], max_output_size=size)
        record, end = warc.parse_record(frame, r["offset"])
        assert record["record_id"] == r["record_id"] and end == r["offset"] + r["length"]
        assert record["payload"].decode() == rows[r["page_id"]][2]


def test_fetch_records(spark, pages):
    index = warc.write_archives(pages)
    ids = index.where("page_id IN (1, 3, 7, 8)").select("record_id", "page_id")
    got = {r["page_id"]: r["payload"].decode() for r in warc.fetch_records(index, ids).join(ids, "record_id").collect()}
    assert got == {p: h for p, _, h in PAGES if p in (1, 3, 7, 8)}
    none = warc.fetch_records(index, spark.createDataFrame([("urn:uuid:none",)], "record_id string"))
    assert none.count() == 0


def test_archive_of_nothing(spark):
    index = warc.write_archives(spark.createDataFrame([], PAGE_DDL))
    assert index.count() == 0 and warc.read_archives(index).count() == 0


def test_damage_is_found():
    record = warc.build_record(1, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None, False)
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"abc", b"abd"), 0)


# Search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    full = [b for _, b in bags if b]
    N, L = len(full), sum(sum(b.values()) for b in full)
    df = Counter(t for b in full for t in b)
    queries_ = {}
    for i, t in items:
        queries_.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in queries_.items():
        scores = []
        for doc, bag in bags:
            n = sum(bag.values())
            score = 0
            for t in wanted & set(bag):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * n * N) // L
                score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


DOCS = [(i, prose(5 + i % 40, i % 90) + (" Zebra-9 ÄÖ" if i % 31 == 0 else "")) for i in range(400)] + [
    (400, None), (401, ""), (402, "-- !!"), (403, "\x00a\x00B"), (404, prose(20000, 5)), (405, "ABC abc AbC"), (405, "abc"), (None, prose(10, 3))]
ITEMS = [(i, prose(6, 1000 + i)) for i in range(30)] + [(30, None), (31, ""), (32, "nowherefound"), (33, "zebra 9"), (33, "äö ÄÖ"), (34, "a b abc"),
                                                       (None, prose(3, 1)), (35, prose(200, 7))]


@pytest.mark.parametrize("block_pairs,seeds", [(250_000, 20_000), (60, 100)])
def test_search(spark, monkeypatch, block_pairs, seeds):
    monkeypatch.setattr(lexical, "SEED_DOCS", seeds)
    docs = spark.createDataFrame([(*r, 1, "t") for r in DOCS], "doc_id long, text string, n long, term string").repartition(3)
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, rank int")
    got = lexical.best_documents(docs, items, 10, block_pairs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(DOCS, ITEMS, 10)


def test_search_of_nothing(spark):
    docs, items = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for d, i in ((docs, items), (some, items), (docs, asked)):
        assert lexical.best_documents(d, i).count() == 0


def random_rows(n, columns, most, seed):
    r = np.random.default_rng(seed)
    rows = [np.sort(r.choice(columns, r.integers(1, most), replace=False, p=np.arange(columns, 0, -1) / (columns * (columns + 1) / 2))) for _ in range(n)]
    start = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    return start, np.concatenate(rows)


@pytest.mark.parametrize("seed", range(4))
def test_trees_prune_and_stay_exact(seed):
    """Trees of several levels on both sides; the pruned search equals all products."""
    r = np.random.default_rng(seed)
    weight = np.arange(1, 301)  # rare columns (the last) weigh most
    start, column = random_rows(3000, 300, 30, seed)
    docs = lexical.Nodes(start, column, weight[column] * r.integers(1, 1000, len(column)))
    at, terms_ = random_rows(90, 300, 8, seed + 100)
    items, k = lexical.Nodes(at, terms_, None), 5
    dense = np.zeros((3000, 300), np.int64)
    dense[np.repeat(np.arange(3000), np.diff(start)), column] = docs.value
    sets = np.zeros((90, 300), np.int64)
    sets[np.repeat(np.arange(90), np.diff(at)), terms_] = 1
    scores = sets @ dense.T
    search = lexical.Search(items, 300, k, np.zeros(90, np.int64))
    ids = r.permutation(3000)
    for part in np.array_split(np.arange(3000), 3):
        search.add(ids[part], docs.taken(part))
    item, doc, score = search.results()
    got = sorted(zip(item.tolist(), doc.tolist(), score.tolist()))
    expected = []
    for i in range(90):
        order = np.lexsort((ids, -scores[i]))[:k]
        expected += [(i, int(ids[d]), int(scores[i, d])) for d in order if scores[i, d] > 0]
    assert got == sorted(expected)
    assert search.scored < search.pairs / 2


# Runs


def brute_runs(words, min_words=24, exponent=3):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            # Periods rise, so a stretch that is known has a smaller one.
            if j - i + q >= max(min_words, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected_runs(doc_id, text):
    words = planted(doc_id, words_of(text))
    runs, dropped = brute_runs(words), set()
    for s, n, q in runs:
        dropped.update(range(s + q, s + n))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest())


UNIT = prose(9, 70)
TEXTS = [(i, prose(200, i)) for i in range(120)] + [
    (200, None), (201, ""), (202, " \n\t"), (203, "a " * 500), (204, "a b " * 30 + "c " * 23 + "d " * 24), (205, (UNIT + "\n") * 3), (206, (UNIT + " ") * 2 + UNIT[:-1]),
    (207, "x " + (UNIT + " ") * 5 + "y " + (UNIT + " ") * 4), (208, ("a a b " * 4 + "c ") * 5), (209, "é é " * 40), (209, "é é " * 40),
    (210, prose(25, 1) + " " + (prose(400, 2) + " ") * 4), (None, "q " * 30), (211, ("a " * 30 + "b " * 30) * 4), (212, "A a " * 20), (213, "ab " * 23), (214, "k")]


def test_runs(spark):
    docs = spark.createDataFrame([(*r, "x", 1) for r in TEXTS], "doc_id long, text string, runs string, n_words int")
    got = periodic.run_digests(periodic.find_runs(periodic.plant_periods(docs)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected_runs(*r) for r in TEXTS), key=repr)
    assert sum(r["n_runs"] for r in got.collect()) > 20


@pytest.mark.parametrize("seed", range(30))
def test_runs_of_random_periodic_texts(seed):
    """Few different words, several texts at once, all thresholds."""
    r = np.random.default_rng(seed)
    texts = []
    for _ in range(6):
        parts = [np.tile(r.integers(0, 3, r.integers(1, 7)), r.integers(1, 9)) for _ in range(r.integers(0, 9))]
        texts.append(np.concatenate(parts) if parts else np.zeros(0, np.int64))
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for min_words, exponent in ((24, 3), (6, 3), (4, 2), (3, 3)):
        got = periodic.runs_of(np.concatenate(texts).astype(np.int64), first, min_words, exponent)
        expected = [(int(a) + s, n, q) for a, t in zip(first, texts) for s, n, q in brute_runs(t.tolist(), min_words, exponent)]
        assert got == sorted(expected, key=lambda x: (x[0], x[2]))


def test_long_periodic_text():
    """Linear in practice: one word, and a random unit, each 200,000 words long."""
    ones = np.zeros(200_000, np.int64)
    assert periodic.runs_of(ones, np.array([0, 200_000])) == [(0, 200_000, 1)]
    unit = np.random.default_rng(3).integers(0, 50, 700)
    text = np.tile(unit, 290)
    assert periodic.runs_of(text, np.array([0, len(text)])) == [r for r in [(0, len(text), 700)]]


def test_runs_of_nothing(spark):
    assert periodic.find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registered_queries_return_every_row(spark):
    folder = "/root/testdata/sf0.001"
    assert queries.op13_periodic_runs(spark, folder).count() == queries.documents(spark, folder).count()
    sample = queries.documents(spark, folder).where("length(text) < 4000").limit(60)
    texts = [(r["doc_id"], r["text"]) for r in sample.collect()]
    got = periodic.run_digests(periodic.find_runs(periodic.plant_periods(spark.createDataFrame(texts, "doc_id long, text string"))))
    assert sorted(map(tuple, got.collect())) == sorted(expected_runs(*r) for r in texts)
