"""The ten operators on a small fixture: nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables;
results against brute force."""

import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.llm import lines, lm, mixture, neardup, packing, quality, queries, suffixes, topk, toxicity, urls

rng = np.random.default_rng(5)
WORDS = ["".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(WORDS, n).tolist())


PASSAGE = prose(70, 1)
BASE = prose(150, 2)
ROWS = [
    (0, BASE, "s1"), (1, BASE, "s2"), (2, BASE.replace(WORDS[3], "other", 1) + " end", "s1"), (3, prose(120, 3) + "\n" + PASSAGE + "\n" + prose(30, 4), "s1"),
    (4, prose(90, 5) + "\n" + PASSAGE + "\nzz\nzz", None), (5, None, "s3"), (6, "", "s3"), (7, " \n\t ", "s2"), (8, "One", "s1"), (9, "ONE", "s1"),
    (10, prose(6000, 6), "s2"), (11, "word " * 400, "s2"), (None, prose(60, 7), "s1"), (13, prose(60, 8), "s1"), (13, prose(60, 8), "s1"),
    (14, "#*$%&|<> " * 30, "s1"), (15, "a" * 900, "s4"), (16, "é" * 500 + " x", "é"),
]
DDL = "doc_id long, text string, source string, lang string, n_chars long, key string, size long, row string, taken string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, "en", 0, "k", 1, "r", "t") for i, t, s in ROWS], DDL)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def tokens(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_near_duplicates(docs, empty):
    got = {}
    for r in neardup.near_duplicates(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    sets = {}
    for i, t, _ in ROWS:
        w = tokens(t)
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets if i is not None}
    for _ in label:
        for a in label:
            for b in label:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    label[a] = label[b] = min(label[a], label[b])
    for i, rows in got.items():
        assert all(r["n_shingles"] == len(sets[i]) for r in rows)
        assert all(r["component_id"] == label.get(i) for r in rows)
        assert all(r["kept"] == (i is None or label[i] == i) for r in rows)
    assert sum(map(len, got.values())) == len(ROWS)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i in {*label.values()}) + Counter([None])


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    """The probe rows (3, Y), (5, X), (5, Y): X exists nowhere else and stays."""
    x, y, z = prose(80, 31), prose(80, 32), prose(80, 33)
    rows = [(3, y, 1), (5, x, 2), (5, y, 3), (6, z, 4), (6, z.replace("a", "A"), 5), (6, z, 6), (7, "", 7), (7, "", 8), (7, None, 9), (8, x, 10), (None, x, 11), (None, x, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 int")
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"] and r["text"].lower()) for r in kept.collect())
    assert got == Counter([(3, y), (5, x), (6, z), (7, ""), (7, None), (None, x), (None, x)])


def test_many_mutual_copies(spark):
    """A bucket with several components: links between members other than its smallest id are found."""
    texts = [prose(100, 20 + i % 3) + f" tail{i}" for i in range(400)]
    got = neardup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i % 3 for i in range(400)}


def test_top_inner_products(spark):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(0, 0.2, 8).astype("float32").tolist(), 1) for i in range(300)]
    rows += [(300, rows[5][1], 1), (301, None, 1), (302, [float("nan")] * 8, 1), (303, [None] * 8, 1), (None, rows[1][1], 1), (7, rows[7][1], 2), (350, [1e30] * 8, 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = [tuple(x) for x in topk.top_inner_products(frame).orderBy("query_id", "rank").collect()]
    valid = [(i, [math.floor(256 * float(x)) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for q in sorted({i for i, _ in valid if i % 50 == 0}):
        scores = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(x, y)))), v) for i, x in valid if i == q for v, y in valid if v != q)
        expected += [(q, k + 1, v, -s) for k, (s, v) in enumerate(scores[:5])]
    assert [g for g in got if 350 not in (g[0], g[2])] == [e for e in expected if 350 not in (e[0], e[2])]
    assert topk.top_inner_products(frame.limit(0)).count() == 0


def test_rows_of_one_id_are_vectors_of_their_own(spark):
    rows = [(50, [1.0, 0.0]), (7, [0.1, 0.0]), (7, [0.9, 0.0]), (8, [0.5, 0.0]), (100, [0.0, 1.0]), (100, [1.0, 1.0]), (50, [-1.0, 0.0])]
    got = [tuple(x) for x in topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() if x["query_id"] == 50]
    assert got[:3] == [(50, 1, 100, 65536), (50, 2, 7, 58880), (50, 3, 8, 32768)] and len(got) == 5


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_top_inner_products_in_blocks(spark, monkeypatch, spread):
    """Vectors of like and of very different lengths, in many blocks of which the floors may drop some; with ties."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(0, 0.3, 6) * np.exp(spread * r.normal())).round(1).tolist()) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(0, 100, 3)] + [(500, [0.0] * 6)]
    got = topk.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    expected = set()
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[v])), v) for v in whole if v != q)
        expected |= {(q, k + 1, v, -s) for k, (s, v) in enumerate(scores[:5])}
    found = [tuple(x) for x in got.collect()]
    assert len(found) == len(expected) and set(found) == expected


def test_lines(docs, empty):
    got = {r["doc_id"]: r for r in lines.drop_repeated_units(docs).collect()}
    assert PASSAGE in got[3]["kept_text"] and PASSAGE not in got[4]["kept_text"] and got[1]["kept_text"] == ""
    for i, t, _ in ROWS:
        raw, r = (t or "").encode(), got[i]
        assert r["n_spans"] == len(r["removed_spans"])
        left = b"".join(raw[a:b] for a, b in zip([0] + [s["stop"] for s in r["removed_spans"]], [s["start"] for s in r["removed_spans"]] + [len(raw)]))
        assert left.decode() == r["kept_text"]
    assert lines.drop_repeated_units(empty).count() == 0
    assert lines.drop_repeated_units(docs, unit="paragraph").count() == len(ROWS)


def test_every_repeated_line_goes(docs):
    """Lines of one to seven words too; all spans against brute force."""
    digest = lambda i, t: hashlib.md5(f"{'-' if i is None else i}:{t or ''}".encode()).digest()
    seen, expected = set(), {}
    for _, i, d, t in sorted({(i is None, i or 0, digest(i, t), t or "") for i, t, _ in ROWS}):
        kept = ""
        for line in re.findall(r"[^\n]*\n|[^\n]+", t):
            w = tuple(tokens(line))
            kept += "" if w and w in seen else line
            seen.add(w)
        expected[d] = kept
    got = lines.drop_repeated_units(docs).collect()
    assert Counter((r["doc_id"], r["kept_text"]) for r in got) == Counter((i, expected[digest(i, t)]) for i, t, _ in ROWS)
    assert {r["doc_id"]: r["kept_text"] for r in lines.drop_repeated_units(docs, min_words=8).collect()}[9] == "ONE"


def test_short_runs_of_repeated_lines_can_stay(spark):
    """A short line goes inside a longer repeated passage, blank lines or not, and stays where it repeats alone."""
    long = "a line of seven words in all\n"
    rows = [(1, f"Menu\n{long}\nThe end\n{long[:-1]} so\n"), (2, f"own words\nMenu\nmore of them\n{long}\n\nThe end\nlast words"),
            (3, f"Menu\n{long}"), (4, None), (5, "The end\nThe end\n")]
    kept = lambda **bound: {r["doc_id"]: (r["n_spans"], r["kept_text"]) for r in lines.drop_repeated_units(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3), **bound).collect()}
    assert kept(min_run_words=9) == {1: (0, rows[0][1]), 2: (2, "own words\nMenu\nmore of them\n\n\nlast words"),
                                     3: (0, rows[2][1]), 4: (0, ""), 5: (0, rows[4][1])}
    assert kept(min_run_words=8)[3] == (1, "")
    assert kept()[2][1] == "own words\nmore of them\n\n\nlast words" and kept()[5] == (1, "")


def test_lm(docs, empty):
    got = sorted(lm.score_texts(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    count = Counter(w for i, t, _ in ROWS if not held(i) for w in [*tokens(t), "</end> "])
    n, v = sum(count.values()), len(count)
    for r, (i, t, _) in zip(got, sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))):
        w = [*tokens(t), "</end> "]
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, held(i), len(w), sum(count[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r["score"] < 0
    assert lm.score_texts(empty).count() == 0


def test_lm_is_normalised():
    """Slots of their own and shared ones, with the share of what was never met, add up to 1 in any context."""
    r = np.random.default_rng(8)
    own = np.unique(r.integers(1, 1 << 63, 40, dtype=np.uint64))
    space = lm.Space(own, r.integers(5, 90, len(own)), 8, 8, r.integers(0, 9, 64 - len(own)).astype(float), np.ones(64 - len(own)))
    p = [x + r.normal(0, 1, x.shape).astype(np.float32) for x in space.start()]
    assert sorted({*space.places(own)[0]}) == sorted(space.place) and len({*space.place}) == len(own)
    for one, two in ((3, 63), (0, 0), (5, 9)):
        logs = lm.slot_log10(p, space, np.arange(64), np.full(64, one), np.full(64, two))
        assert math.isclose((10 ** logs).sum(), 1, rel_tol=1e-5)


def test_lm_score_equals_a_plain_sum(spark):
    """Each token's probability worked out by itself; blocks of texts and steps of tokens make no difference."""
    r = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(vocabulary[int(x)] for x in r.zipf(1.4, 30) % 60)) for i in range(60)] + [(60, "never met before"), (61, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["score"] for x in lm.score_texts(docs, slots=64, min_count=4).collect()}
    learnt = docs.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2).select("text")
    model = lm.fit(learnt, slots=64, min_count=4)
    space, (c, m, k, scale) = model.space, [x.astype(float) for x in model.vectors]
    rest = {x["h"]: x["c"] for x in model.rest.collect()}
    assert rest and len(space.own)
    for i, text in rows:
        h, _ = lm._tokens(pa.array([text], pa.string()))
        place, count = space.places(h)
        total, before = 0.0, [space.before] * 2
        for token, slot, n in zip(h.view(np.int64).tolist(), place.tolist(), count.tolist()):
            u = c[before[1]] * scale[0] + c[before[0]] * scale[1]
            for matrix, at in ((k, slot // space.members), (m[slot // space.members * space.members:][:space.members], slot % space.members)):
                e = np.exp(matrix[:, :-1] @ u + matrix[:, -1])
                total += math.log10(e[at] / e.sum())
            if not n:
                total += math.log10(rest.get(token, 0) + 1) - space.log_rest[slot]
            before = [before[1], slot]
        assert math.isclose(got[i], total, rel_tol=1e-4)


def test_lm_learns_from_context(spark, monkeypatch):
    """Texts of fixed word order score far above their unigrams, held-out ones too, also when tasks hand over often."""
    monkeypatch.setattr(lm, "HANDOVER", 1 << 12)
    r = np.random.default_rng(5)
    texts = []
    for i in range(600):
        x = int(r.integers(0, 50))
        texts.append((i, " ".join(f"t{(x + j) % 50}" for j in range(40))))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    held = lm.score_texts(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > 0.6 * held[1]


def test_lm_steps_and_sums_are_plain():
    """Gradients of stretches added up, tokens looked up, and probabilities where sums leave a float's range."""
    r = np.random.default_rng(4)
    rows, index = r.normal(size=(500, 5)).astype(np.float32), np.minimum(r.zipf(1.3, 500), 90)
    order = np.argsort(index, kind="stable")
    plain = np.zeros((91, 5))
    np.add.at(plain, index, rows)
    assert np.allclose(lm._summed(rows, order, lm._begins(index[order])), plain[np.unique(index)], atol=1e-4)
    own = np.unique(r.integers(1, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2) >> np.uint64(6))  # crowded in the lookup
    space = lm.Space(own.copy(), np.arange(1, len(own) + 1), 64, 64, np.ones(4096 - len(own)), np.ones(4096 - len(own)))
    asked = np.concatenate([own[::-1], own + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    assert space.places(asked)[1].tolist() == [*range(len(own), 0, -1), *(int(np.searchsorted(own, x)) + 1 if x in own else 0 for x in asked[len(own):])]
    context, matrix = r.normal(0, 12, (400, 16)).astype(np.float32), r.normal(0, 9, (30, 17)).astype(np.float32)
    context[:9], chosen = 0, r.integers(0, 30, 400)
    s = context.astype(float) @ matrix[:, :-1].T.astype(float) + matrix[:, -1]
    s -= s.max(1, keepdims=True)
    expected = (s[np.arange(400), chosen] - np.log(np.exp(s).sum(1))) / np.log(10)
    assert np.allclose(lm._softmax_log10(context, matrix, chosen), expected, rtol=1e-4, atol=1e-4)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    got = packing.pack_documents(docs, path).collect()
    coder = Tokenizer.from_file(path)
    coded = {i: [*coder.encode(t or "", add_special_tokens=False).ids, 2] for i, t, _ in ROWS}
    seen = Counter()
    for r in got:
        ids = coded[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        part = ids[r["start"]:r["start"] + r["length"]]
        assert len(part) == r["length"] > 0 and r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        seen.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
    assert seen == Counter((i, k) for i, _, _ in ROWS for k in range(len(coded[i])))
    by = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert by.setdefault(r["sequence_id"], 0) == r["offset"]
        by[r["sequence_id"]] += r["length"]
    assert all(n <= 4096 for n in by.values())
    assert packing.pack_documents(empty, path).count() == 0


def test_first_fit_is_first_fit():
    sizes = sorted(np.random.default_rng(1).integers(1, 4096, 500).tolist(), reverse=True)
    plain, room = [], []
    for i, s in enumerate(sizes):
        k = next((k for k, f in enumerate(room) if f >= s), len(room))
        if k == len(room):
            room.append(4096)
            plain.append([])
        room[k] -= s
        plain[k].append(i)
    assert packing.first_fit(sizes, 4096) == plain


def test_urls(spark):
    rows = [(1, "http://A.Example.net/en/x?q"), (2, "https://example.com/de/1"), (3, "x"), (4, None), (5, "http://net/"), (6, "http://notnet"),
            (7, "http://b.org/fr/free-bets"), (8, "http://b.org/es/free-bets/"), (8, "http://b.org/es/Free-Bets"), (9, "http://b.org/xfree-bets"), (10, ""),
            (None, "http://sub.example.net#top/en/"), (12, "http://a.io/?poker-x-bonus"), (13, "a\nb://C.org/fr/\nx")]
    got = urls.judge_urls(spark.createDataFrame([(*r, "h", "p") for r in rows], "page_id long, url string, host string, path string")).collect()
    seen = {(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows)
    assert seen == {
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"), (2, "example.com", "/de/1", "example.com/de/", "block"), (3, "", "", None, "allow"),
        (4, "", "", None, "allow"), (5, "net", "/", "net/", "block"), (6, "notnet", "", None, "allow"), (7, "b.org", "/fr/free-bets", "org/fr/", "allow"),
        (8, "b.org", "/es/free-bets/", None, "block"), (8, "b.org", "/es/Free-Bets", None, "block"), (9, "b.org", "/xfree-bets", None, "allow"),
        (10, "", "", None, "allow"), (None, "sub.example.net", "", None, "allow"), (12, "a.io", "/", None, "block"), (13, "c.org", "/fr/\nx", "org/fr/", "allow")}
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    with pytest.raises(ValueError):
        urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), patterns={"bare": "*ab*"})


def cut_by_hand(texts):
    seen = Counter(b[k:k + 200] for b in texts for k in range(len(b) - 199))
    out = []
    for b in texts:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - 199):
            if seen[b[k:k + 200]] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        out.append((len(b), int(mask.sum()), int((np.diff(mask.astype(int), prepend=0) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~mask].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("many", [suffixes.MANY, 1])
def test_suffixes(docs, empty, monkeypatch, many):
    """With MANY = 1 every anchor of several regions is cut into parts and single windows."""
    monkeypatch.setattr(suffixes, "MANY", many)
    got = suffixes.drop_repeated_substrings(docs).collect()
    expected = cut_by_hand([(t or "").encode() for _, t, _ in ROWS])
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == Counter((i, *e) for (i, _, _), e in zip(ROWS, expected))
    assert suffixes.drop_repeated_substrings(empty).count() == 0
    cut = suffixes.cut_documents(docs)
    assert cut.columns == docs.columns
    assert {5, 6, 7, 8, 9, 10} <= {r["doc_id"] for r in cut.collect()} and 0 not in {r["doc_id"] for r in cut.collect()}


@pytest.mark.parametrize("alphabet", [2, 4, 200])
def test_suffix_order(alphabet):
    r = np.random.default_rng(alphabet)
    data = r.integers(20, 20 + alphabet, 4000).astype(np.uint8)
    data[1000:1500], data[2000:2300] = 21, data[100:400]
    b = data.tobytes()
    order = suffixes.two_stage_order(data).tolist()
    assert sorted(order) == list(range(len(b)))
    keys = [b[k:k + 200] for k in order]
    assert keys == sorted(keys)


def test_mixing(docs, empty):
    got = mixture.mix_sources(docs).collect()
    sizes = Counter()
    for i, t, s in ROWS:
        sizes[s] += len(tokens(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, target, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2 * sizes[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    text_source = Counter((i, len(tokens(t)), s) for i, t, s in ROWS)
    taken = Counter()
    for r in got:
        s = next(s for (i, n, s) in text_source if i == r["doc_id"] and n == r["size"])
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert len(got) == len(ROWS) and all(abs(taken[s] - target[s]) <= 2 for s in sizes)
    assert sorted(map(tuple, mixture.mix_sources(docs).drop("rate").collect()), key=repr) == sorted(map(tuple, mixture.mix_sources(docs).drop("rate").collect()), key=repr)
    assert mixture.mix_sources(empty).count() == 0
    mixed = mixture.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert abs(sum(len(tokens(r["text"])) for r in mixed.collect()) - sum(taken.values())) <= 2


def test_toxicity(spark, docs, empty):
    r = np.random.default_rng(9)
    texts = [(i, prose(40, 100 + i) + (" you Idiot, scum!" if i % 4 == 0 else "")) for i in range(400)] + [(400, None), (None, "idiot scum"), (402, "")]
    labels = [(i, int(r.random() < 0.5), int(i % 4 == 0) if r.random() > 0.05 else 1) for i in range(0, 400, 2)] + [(None, 1, 1), (400, None, None)]
    frame = spark.createDataFrame([(*t, 1, 1) for t in texts], "doc_id long, text string, toxic int, quality int")
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x["doc_id"]: x for x in toxicity.grade_toxicity(frame, label).collect()}
    wrong = [i for i in range(1, 400, 2) if got[i]["rejected"]] + [i for i in range(0, 400, 4) if not got[i]["rejected"]]
    assert not wrong and got[None]["rejected"] and not got[400]["rejected"] and not got[402]["rejected"]
    assert all(0 <= x["severity"] <= 2 for x in got.values())
    assert toxicity.kept_documents(frame, label).columns == frame.columns
    assert toxicity.kept_documents(frame, label).count() == sum(not x["rejected"] for x in got.values())
    assert not any(x["rejected"] for x in toxicity.grade_toxicity(docs, label.limit(0)).collect())
    assert toxicity.grade_toxicity(empty, label).count() == 0


def base_counts(text):
    text = text or ""
    w = tokens(text, lower=False)
    rows, dup, seen = text.split("\n"), 0, set()
    for line in rows:
        if tokens(line, lower=False):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    hit = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w)


def test_quality(docs, empty):
    got = quality.judge_quality(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((i, *base_counts(t)) for i, t, _ in ROWS)
    assert all(not (r["kept"] and r["base_failed"]) for r in got)
    assert quality.judge_quality(empty).count() == 0


def test_every_language_is_judged(spark, monkeypatch):
    """Languages beyond those that every task holds get the same verdicts by a join."""
    def speak(lang, i, n=80):
        r = np.random.default_rng(1000 * len(lang) + i)
        return " ".join(r.choice([f"{lang}{k}" for k in range(40)], n).tolist())

    rows = [(100 * k + i, speak(lang, i), lang) for k, lang in enumerate(["xx", "yyy", "zzzz", "wwwww"]) for i in range(30 + 5 * k)]
    rows += [(900 + i, "QQ! " * 30 + prose(60, i).upper(), lang) for i, lang in enumerate(["xx", "yyy", "zzzz", "wwwww", None, "rare"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = sorted(map(tuple, quality.judge_quality(docs).collect()))
    monkeypatch.setattr(quality, "HELD_LANGUAGES", 2)
    joined = sorted(map(tuple, quality.judge_quality(docs).collect()))
    assert str(joined) == str(held)
    assert {r[0] for r in held if r[0] >= 900 and not r[7]} >= {900, 901, 902, 903}


def test_distance():
    p, q = np.array([[1.0, 3.0], [2.0, 2.0], [0.0, 0.0], [1.0, 0.0]]), np.array([0.0, 4.0])
    def plain(a, b):
        m = [(x + y) / 2 for x, y in zip(a, b)]
        kl = lambda x: sum(v * math.log2(v / w) for v, w in zip(x, m) if v)
        return math.sqrt((kl(a) + kl(b)) / 2)
    assert np.allclose(quality.distance(p, q), [plain([0.25, 0.75], [0, 1]), plain([0.5, 0.5], [0, 1]), 0, 1])


@pytest.mark.parametrize("many", [suffixes.MANY, 1])
def test_marks_are_one_row_per_region(spark, monkeypatch, many):
    """Neither equal rows nor the parts of a region multiply what is joined back: each region is marked once for a text."""
    monkeypatch.setattr(suffixes, "MANY", many)
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{i * 7919} {'x' * i} {passage} tail {i * 104729}") for i in range(6)] + [(9, f"{passage} again")] * 8
    texts = lines.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").select("key", "text")
    for row in suffixes.repeated_regions(texts).collect():
        starts = [m["s0"] for m in row["marks"]]
        assert len(starts) == len(set(starts))
    got = {r["doc_id"]: r for r in suffixes.drop_repeated_substrings(texts.selectExpr("hash(key) AS doc_id", "text")).collect()}
    assert len(got) == 7 and all(r["n_removed"] >= len(passage) for r in got.values())


def test_token_table_grows_in_order_on_one_core(monkeypatch):
    """Words met block by block keep the table sorted and have the tokenizer's ids; a task starts no threads beside it."""
    from marketlens.llm.text import utf8

    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    table = packing.TokenTable(queries.tokenizer_path())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    for texts in (["b a c", "", "Zebra's 12%"], ["a d b d", "é x"], ["c"], ["", "new words, b"]):
        ids, bounds = table.encode(*utf8(pa.array(texts)))
        want = [[*e.ids, packing.END_ID] for e in table.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
        assert (np.diff(table.hashes.astype(object)) > 0).all()
