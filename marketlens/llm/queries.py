"""The operators applied to their whole tables with production parameters, as registered queries."""

from __future__ import annotations

from pathlib import Path

from marketlens.llm import lexical, lines, lm, mixture, neardup, packing, periodic, quality, suffixes, topk, toxicity, urls, warc

ROOT = str(Path(__file__).resolve().parents[2])
TOKENIZER = "word_bpe_49k.json"
#: Words that a run of repeated lines holds at least to be removed; shorter ones mostly meet by chance.
MIN_RUN_WORDS = 12


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark, folder: str, name: str):
    """A table; Python workers of this session find the package beside this file, where they have none of their own."""
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH"), ROOT]))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark, folder: str):
    return table(spark, folder, "documents")


def op1_near_dedup(spark, folder):
    return neardup.near_duplicates(documents(spark, folder))


def op2_top_inner_products(spark, folder):
    return topk.top_inner_products(table(spark, folder, "embeddings"))


def op3_line_dedup(spark, folder):
    return lines.drop_repeated_units(documents(spark, folder), min_run_words=MIN_RUN_WORDS)


def op4_lm_scoring(spark, folder):
    return lm.score_texts(documents(spark, folder))


def op5_packing(spark, folder):
    return packing.pack_documents(documents(spark, folder), tokenizer_path())


def op6_url_filters(spark, folder):
    return urls.judge_urls(table(spark, folder, "pages"))


def op7_suffix_dedup(spark, folder):
    return suffixes.drop_repeated_substrings(documents(spark, folder)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_mixing(spark, folder):
    return mixture.mix_sources(documents(spark, folder)).select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark, folder):
    return toxicity.grade_toxicity(documents(spark, folder), table(spark, folder, "labels"))


def op10_quality_rules(spark, folder):
    return quality.judge_quality(documents(spark, folder))


def op11_warc_bundles(spark, folder):
    index = warc.write_archives(table(spark, folder, "pages"))
    return warc.read_archives(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_lexical_search(spark, folder):
    return lexical.best_documents(documents(spark, folder), table(spark, folder, "benchmark"))


def op13_periodic_runs(spark, folder):
    return periodic.run_digests(periodic.find_runs(periodic.plant_periods(documents(spark, folder))))


_UPPER, _LOWER = urls.UPPER, urls.LOWER
OP1_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS l
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')]
    ELSE list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
digest AS (SELECT doc_id, sha256(string_agg(g, chr(10) ORDER BY g)) AS d FROM s GROUP BY doc_id),
first AS (SELECT d, MIN(doc_id) AS rep, COUNT(*) AS n_copies FROM digest GROUP BY d),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      WHERE a.doc_id IN (SELECT rep FROM first) AND b.doc_id IN (SELECT rep FROM first) GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT rep AS a, rep AS c FROM first UNION SELECT u.a, r.c FROM r JOIN u ON u.b = r.a),
c AS (SELECT a, MIN(c) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, COALESCE(c.component_id, d.doc_id) AS component_id,
       d.doc_id = COALESCE(c.component_id, d.doc_id) AS kept, COALESCE(f.n_copies, 1) AS n_copies
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN digest g USING (doc_id) LEFT JOIN first f ON f.d = g.d LEFT JOIN c ON c.a = f.rep"""

OP2_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5"""

_BY_PATTERN = " || ".join(f"CASE WHEN regexp_matches(low, '{urls.pattern_regex(p)}') THEN '{name},' ELSE '' END" for name, p in sorted(urls.PATTERNS.items()))
_RULE = "CASE " + " ".join(
    f"WHEN (host = '{r.split('/')[0]}' OR ends_with(host, '.{r.split('/')[0]}')) AND starts_with(path, '{r[r.index('/'):]}') THEN '{r}'"
    for _, r in sorted(urls.HOST_RULES, key=lambda x: -len(x[1]))) + " END"
_VERDICTS = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in urls.HOST_RULES)
OP6_SQL = rf"""
WITH h AS (SELECT page_id, translate(COALESCE(url, ''), '{_UPPER}', '{_LOWER}') AS low,
                  translate(regexp_extract(COALESCE(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
                  regexp_extract(COALESCE(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, {_RULE} AS rule, rtrim({_BY_PATTERN}, ',') AS patterns FROM h)
SELECT page_id, host, path, rule, CASE {_VERDICTS} WHEN patterns <> '' THEN 'block' ELSE 'allow' END AS verdict, patterns FROM r"""

OP11_SQL = """
WITH p AS (SELECT page_id, strlen(COALESCE(html, '')) AS payload_bytes, sha1(COALESCE(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, MAX(page_id) OVER (PARTITION BY payload_digest) AS first, payload_bytes >= 1000 AND page_id IS DISTINCT FROM first AS again FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM r"""

_TERMS = rf"regexp_extract_all(translate(COALESCE(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS l FROM documents),
c AS (SELECT COUNT(*) AS docs, CAST(SUM(len(l)) AS BIGINT) AS terms FROM d WHERE len(l) > 0),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
tf AS (SELECT doc_id, t, n, COUNT(*) AS tf FROM (SELECT doc_id, unnest(l) AS t, len(l) AS n FROM d) GROUP BY ALL),
df AS (SELECT t, COUNT(*) AS df FROM tf GROUP BY t),
w AS (SELECT doc_id, tf.t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS part
      FROM tf JOIN df USING (t), c WHERE tf.t IN (SELECT t FROM i)),
s AS (SELECT item_id, doc_id, CAST(SUM(part) AS BIGINT) AS score FROM i JOIN w USING (t) GROUP BY ALL HAVING SUM(part) > 0)
SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s QUALIFY rank <= 50"""

#: name: (query, reference SQL or None)
QUERIES = {
    "op1_near_dedup": (op1_near_dedup, OP1_SQL),
    "op2_top_inner_products": (op2_top_inner_products, OP2_SQL),
    "op3_line_dedup": (op3_line_dedup, None),
    "op4_lm_scoring": (op4_lm_scoring, None),
    "op5_packing": (op5_packing, None),
    "op6_url_filters": (op6_url_filters, OP6_SQL),
    "op7_suffix_dedup": (op7_suffix_dedup, None),
    "op8_mixing": (op8_mixing, None),
    "op9_toxicity": (op9_toxicity, None),
    "op10_quality_rules": (op10_quality_rules, None),
    "op11_warc_bundles": (op11_warc_bundles, OP11_SQL),
    "op12_lexical_search": (op12_lexical_search, OP12_SQL),
    "op13_periodic_runs": (op13_periodic_runs, None),
}
