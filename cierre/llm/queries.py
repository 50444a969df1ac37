"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cierre.llm import alignment, bpe, fingerprint, frames, licenses, lm, packing, periods, quality, repeats, simhash, topk, toxicity


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.repeated_spans(_table(spark, sf_dir, "documents")))


def op3_segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(_table(spark, sf_dir, "documents"))


def op6_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.score(docs, quality.fit(docs, labels))


def op7_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def op8_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), capacity=2048)


def op11_repair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.run_report(_table(spark, sf_dir, "documents"), change=periods.planted)


def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"),
                                      _tokenizer("piece_bpe_32k.model"))


def op13_seekable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = frames.write_ids(_table(spark, sf_dir, "documents"), frames.scratch_folder(spark), _tokenizer("byte_bpe_50k.json"))
    return frames.read_digests(catalog)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_backoff_lm, op2_suffix_dedup, op3_segment_topk, op4_simhash_vptree, op5_multiset_hash,
              op6_pairwise_quality, op7_toxic_lexicon, op8_backtracking_bpe, op9_license_rules, op10_best_fit_packing,
              op11_repair_runs, op12_diagonal_alignment, op13_seekable_ids)
}



def _values(rows) -> str:
    quote = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return "VALUES " + ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows)


def _license_sql() -> str:
    """Sentences of both cuts, joined to the known ones, and rules found in a
    document's identifiers. The mentions are the cross product of small lists."""
    names = [(lic, n) for lic, ns in licenses.mention_names().items() for n in ns]
    fixed = [*((i, s) for i, s in licenses.SENTENCES.items()),
             ("apache-copy", licenses.SENTENCES["apache-copy"] + " " + licenses.APACHE_URL)]
    spaced = lambda ids: "".join(f" {i} " for i in ids)
    # A rule yields inside a longer one of another licence: it must hold more often than that one does.
    longer = lambda lic, ids: next((spaced(o) for other, _, o in licenses.LONG_RULES
                                    if other != lic and len(o) > len(ids) and licenses.places(o, ids)), "|")
    rules = [(lic, licenses.STRENGTHS.index(s), spaced(ids), longer(lic, ids)) for lic, s, ids in licenses.LONG_RULES]
    cuts = " UNION ALL ".join(
        f"SELECT doc_id, '{how}' AS how, regexp_split_to_array(coalesce(text, ''), '{pattern}') AS parts FROM documents"
        for how, pattern in licenses.CUT.items())
    plain = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))".format
    times = "((length(found.ids) - length(replace(found.ids, {0}, ''))) // length({0}))".format
    one = lambda xs: _values([(x,) for x in xs])
    return f"""
WITH names(lic, name) AS ({_values(names)}), fixed(ident, sentence) AS ({_values(fixed)}),
subjects(s) AS ({one(licenses.SUBJECTS)}), verbs(v) AS ({one(licenses.VERBS)}), terms(t) AS ({one(licenses.TERMS)}),
long_rules(lic, strength, ids, longer) AS ({_values(rules)}),
known AS (
  SELECT DISTINCT {plain("sentence")} AS sentence, ident FROM fixed
  UNION SELECT {plain("s || ' ' || v || ' ' || t || ' ' || name")}, 'names-' || lower(lic) FROM subjects, verbs, terms, names
  UNION SELECT {plain("'SPDX-License-Identifier: ' || name")}, 'names-' || lower(lic) FROM names),
rules AS (
  SELECT lic, strength, ids, longer FROM long_rules UNION SELECT lic, 2, ' names-' || lower(lic) || ' ', '|' FROM names),
parts AS (
  SELECT doc_id, how, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos FROM ({cuts})),
found AS (
  SELECT doc_id, how, count(*) AS n, string_agg(' ' || ident || ' ', '' ORDER BY pos) AS ids
  FROM parts JOIN known ON {plain("part")} = known.sentence GROUP BY doc_id, how),
held AS (
  SELECT doc_id, lic, min(strength) AS strength
  FROM found JOIN rules ON {times("rules.ids")} > {times("rules.longer")} GROUP BY doc_id, lic),
listed AS (
  SELECT doc_id, count(*) AS n, string_agg(lic || ':' || ['full', 'notice', 'mention'][strength + 1], ',' ORDER BY lic) AS licenses
  FROM held GROUP BY doc_id),
most AS (SELECT doc_id, max(n) AS n FROM found GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(most.n, 0) AS BIGINT) AS n_sentences, CAST(coalesce(listed.n, 0) AS BIGINT) AS n_rules,
       coalesce(listed.licenses, '') AS licenses
FROM documents d LEFT JOIN most USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


ORACLE_SQL: dict[str, str] = {
    "op9_license_rules": _license_sql(),
    "op2_suffix_dedup": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM d WHERE length(h) >= 100)),
least_doc AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
gone AS (SELECT w.doc_id, w.p FROM w JOIN least_doc USING (s) WHERE least_doc.m < w.doc_id),
marked AS (
  SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM gone),
numbered AS (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS n FROM marked),
spans AS (SELECT doc_id, n, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, n),
edges AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_byte FROM spans),
kept AS (
  SELECT e.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
         string_agg(substr(d.h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS head,
         any_value(d.h)[2 * max(b) + 1:] AS tail
  FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN kept.doc_id IS NULL THEN unhex(d.h) ELSE unhex(head || tail) END) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_segment_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    # A run is an island of places i with word i = word i + q; equal runs keep their smallest q. The lists
    # at the start are crc32 by its polynomial, byte by byte.
    "op11_repair_runs": """
WITH texts AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS name, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
hashed AS (
  SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda k: CAST(ascii(name[k]) AS BIGINT))),
           lambda c, byte: list_reduce(list_prepend(xor(c, byte), range(1, 9)),
             lambda r, step: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)), 4294967295) AS h
  FROM texts),
ruled AS (
  SELECT doc_id, words, n, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n ELSE 0 END AS a, (h // 10) % 8 AS e FROM hashed),
placed AS (
  SELECT doc_id, words, n, planted, a, 1 + (n - a) // (3 + e) AS p, unnest(range(0, n)) AS i FROM ruled),
w AS (
  SELECT doc_id, n, i, words[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM placed),
same AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
  WHERE 4 * (y.i - x.i) <= x.n),
marked AS (
  SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (
  SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM marked GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, s, len, min(q) AS q FROM stretches GROUP BY doc_id, s, len),
totals AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         first(struct_pack(s := s, len := len, q := q) ORDER BY len DESC, s, q) AS best FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.len AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM texts t LEFT JOIN totals USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}
