"""Words and texts of the Thue-Morse sequence, for which sums of powers modulo 2**64 meet; word hashes at their borders."""

import hashlib
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import lines, neardup, packing, quality, queries, suffixes
from marketlens.llm.text import PLACES, Slices, eights, word_hashes, words

ONE, TWO = "a", "b"
for _ in range(11):
    ONE, TWO = ONE + TWO, TWO + ONE
REST = " ".join(f"w{i}" for i in range(40))
TEXTS = [(1, f"{ONE} {REST}"), (2, f"{TWO} {REST}"), (3, f"{ONE}\n{TWO}\n{ONE}"), (4, TWO), (5, ONE), (6, ONE[:300] + "." + TWO[:300])]


@pytest.fixture(scope="module")
def patterned(spark):
    return spark.createDataFrame([(i, t, "en") for i, t in TEXTS], "doc_id long, text string, lang string")


def test_hashes_tell_all_words_apart():
    r = np.random.default_rng(3)
    made = {b"", *(bytes(r.choice(list(b"ab"), n).tolist()) for n in (*range(1, 12), PLACES - 1, PLACES, PLACES + 1, 2 * PLACES, 1000) for _ in range(40))}
    made |= {b"a" * n for n in range(1, 300)} | {ONE.encode(), TWO.encode(), b"x" + ONE.encode(), ONE.encode() + b"x"}
    made = sorted(made - {b""})
    data = np.frombuffer(b" ".join(made * 2), np.uint8)
    starts, ends, first = words(data, np.array([0, len(data)]))
    assert [data[a:b].tobytes() for a, b in zip(starts, ends)] == made * 2 and first.tolist() == [0, 2 * len(made)]
    for which in (0, 1):
        h = word_hashes(data, starts, ends, which)
        assert (h[:len(made)] == h[len(made):]).all() and len(np.unique(h)) == len(made)
    assert not np.intersect1d(word_hashes(data, starts, ends, 0), word_hashes(data, starts, ends, 1)).size
    assert not len(word_hashes(data[:0], starts[:0], ends[:0]))
    grouped = Slices(data, grouped=True)
    long = ends - starts >= 8
    h = grouped(starts[long], ends[long])
    assert len(np.unique(h)) == sum(len(w) >= 8 for w in made)


def test_eights():
    b = bytes(range(1, 30))
    expected = [int.from_bytes(b[i:i + 8], "little") for i in range(len(b))]
    assert eights(np.frombuffer(b, np.uint8)).tolist() == expected and not len(eights(np.zeros(0, np.uint8)))


def test_token_ids(patterned):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(queries.tokenizer_path())
    coded = {i: [*coder.encode(t, add_special_tokens=False).ids, 2] for i, t in TEXTS}
    for r in packing.pack_documents(patterned, queries.tokenizer_path()).collect():
        part = coded[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def test_repeats_and_links(patterned):
    counts = {r["doc_id"]: (r["n_dup_lines"], r["n_repeat_words"]) for r in quality.judge_quality(patterned).collect()}
    assert counts == {i: (int(i == 3), 0) for i, _ in TEXTS}
    kept = {r["doc_id"]: r["kept_text"] for r in lines.drop_repeated_units(patterned).collect()}
    assert kept[3] == f"{ONE}\n{TWO}\n" and kept[4] == "" and kept[5] == "" and kept[2] == TEXTS[1][1]
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(patterned).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}  # the first two share 36 of 38 shingles, 4 and 5 nothing


def test_repeated_bytes(patterned):
    texts = [t.encode() for _, t in TEXTS]
    seen = Counter(b[k:k + 200] for b in texts for k in range(len(b) - 199))
    for (i, _), b, r in zip(TEXTS, texts, sorted(suffixes.drop_repeated_substrings(patterned).collect(), key=lambda r: r["doc_id"])):
        gone = {j for k in range(len(b) - 199) if seen[b[k:k + 200]] > 1 for j in range(k, k + 200)}
        left = bytes(c for j, c in enumerate(b) if j not in gone)
        assert (r["doc_id"], r["n_removed"], r["kept_sha256"]) == (i, len(gone), hashlib.sha256(left).hexdigest())


@pytest.mark.parametrize("limit", [64, 1 << 20])
def test_many_texts_are_cut_together(monkeypatch, limit):
    """Spans, hashes and rests of texts cut in one go, those without marks, empty and null ones among them, of any slice."""
    monkeypatch.setattr(suffixes, "CUT_BYTES", limit)
    r = np.random.default_rng(5)
    texts = [None, "", *("".join(r.choice(list("aé\n "), int(n))) for n in r.integers(200, 900, 40)), "", None]
    marks = []
    for text in texts:
        size = len((text or "").encode())
        marks.append([{"s0": int(s), "runs": [0, 1, 9, 9 + int(k)]} for s, k in zip(r.integers(0, max(1, size - 240), 3), r.integers(1, 32, 3))]
                     if size > 240 and r.random() < 0.7 else None)
    marks[4] = [{"s0": 0, "runs": [0, len(texts[4].encode()) - 199]}]
    kind = pa.list_(pa.struct([("s0", pa.int32()), ("runs", pa.list_(pa.int32()))]))
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(marks, kind)], names=["doc", "text", "marks"])
    got = [row for batch in suffixes._cut([whole.slice(0, 9), whole.slice(9)]) for row in batch.to_pylist()]
    assert [row["doc_id"] for row in got] == list(range(len(texts)))
    for row, text, own in zip(got, texts, marks):
        raw = (text or "").encode()
        gone = {p for m in own or () for b, e in zip(m["runs"][::2], m["runs"][1::2]) for p in range(m["s0"] + b, m["s0"] + e + 199)}
        left = bytes(c for p, c in enumerate(raw) if p not in gone)
        starts, stops = sorted(p for p in gone if p - 1 not in gone), sorted(p + 1 for p in gone if p + 1 not in gone)
        assert row["spans"] == [{"start": a, "stop": b} for a, b in zip(starts, stops)] and row["n_spans"] == len(starts)
        assert (row["n_bytes"], row["n_removed"]) == (len(raw), len(gone)) and row["kept_sha256"] == hashlib.sha256(left).hexdigest()
        assert row["kept_text"] == left.decode(errors="ignore")
