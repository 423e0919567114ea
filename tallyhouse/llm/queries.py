"""Registered queries of the text operators over whole test tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontam, lines, phrases, pii, quality, records, repeats, search, sentencepieces, sharding, simhash, toxicity, urls
from tallyhouse.operators import scratch

WORD = r"[^\x20\x09-\x0D]+"


#: The key of the registered query; a real run brings a secret one.
PII_KEY = b"surrogates of the registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger of all documents with the verdicts of the base and the standard policy."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    rows = quality.verdict(rows, quality.BASE, name="base_passed")
    rows = quality.verdict(rows, quality.STANDARD)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("base_passed")).alias("base_failed"), "kept", "fail_bits",
        F.lit(f"{quality.STANDARD.name}/{quality.STANDARD.version}").alias("policy"),
    )


QUALITY_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS ws FROM d),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) >= 2),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 2 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END) AS fail_bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept,
       CAST(fail_bits AS BIGINT) AS fail_bits, 'standard/1' AS policy
FROM b
"""


def vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    rows = sharding.pack(table(spark, sf_dir, "documents"), shards=24)
    return rows.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.groups(table(spark, sf_dir, "documents"), words=3)


def surrogate_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data and secrets."""
    rows = pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), key=PII_KEY)
    return rows.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), "found")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a classifier trained on the labelled rows that are not held out."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 200 bytes or more leave of every document."""
    rows = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict for every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def tokenizer_file() -> str:
    """The vocabulary of the registered query and of the pipeline."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def sentencepiece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and whether they decode to the text again."""
    vocabulary = sentencepieces.load(tokenizer_file())
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sentencepieces.encode_documents(rows, vocabulary, check="same_text")
    return rows.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "same_text")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their recurring lines."""
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), dropped="n_dropped")


LINES_SQL = rf"""
WITH t AS (SELECT text, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY text),
raw AS (
  SELECT text, first_doc, i AS pos, string_split(text, chr(10))[i] AS line
  FROM (SELECT text, first_doc, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM t)),
tok AS (
  SELECT text, first_doc, pos, list_transform(regexp_extract_all(line, '{WORD}'),
         lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS mw FROM raw),
ln AS (
  SELECT *, len(mw) || ' ' || array_to_string(mw[1:4], ' ') AS leaf, array_to_string(mw, ' ') AS own
  FROM tok WHERE len(mw) >= 3),
leaves AS (SELECT leaf FROM ln GROUP BY leaf HAVING count(DISTINCT text) >= 10),
hot AS (SELECT ln.* FROM ln JOIN leaves USING (leaf)),
kinds AS (SELECT leaf, own, any_value(mw) AS mw, count(DISTINCT text) AS n FROM hot GROUP BY leaf, own),
weight AS (SELECT leaf, sum(n) AS total FROM kinds GROUP BY leaf HAVING count(*) > 1),
places AS (
  SELECT leaf, own, n, total, p, mw[p] AS token
  FROM (SELECT leaf, own, n, mw, total, unnest(range(1, len(mw) + 1)) AS p FROM kinds JOIN weight USING (leaf))),
fixed AS (SELECT leaf, p, token FROM places GROUP BY leaf, p, token HAVING 2 * sum(n) > any_value(total)),
patterns AS (SELECT leaf, count(*) AS n_fixed, count(*) FILTER (token <> '<*>') AS n_constant FROM fixed GROUP BY leaf),
agrees AS (SELECT leaf, own, count(*) AS n_agree FROM places JOIN fixed USING (leaf, p, token) GROUP BY leaf, own),
fits AS (
  SELECT own FROM agrees JOIN patterns USING (leaf) JOIN kinds USING (leaf, own)
  WHERE n_agree = n_fixed AND 100 * n_constant >= 60 * len(mw)),
templ AS (
  SELECT hot.text, first_doc, pos, CASE WHEN fits.own IS NULL THEN 'o' || hot.own ELSE 'l' || leaf END AS template
  FROM hot LEFT JOIN fits ON fits.own = hot.own),
recurring AS (
  SELECT template, arg_min(text, first_doc) AS stays FROM templ
  GROUP BY template HAVING count(DISTINCT text) >= 10),
gone AS (SELECT DISTINCT text, pos FROM templ JOIN recurring USING (template) WHERE text <> stays),
cut AS (
  SELECT raw.text, coalesce(string_agg(line, chr(10) ORDER BY raw.pos) FILTER (gone.pos IS NULL), '') AS rest,
         count(gone.pos) AS n_dropped
  FROM raw LEFT JOIN gone ON gone.text = raw.text AND gone.pos = raw.pos GROUP BY raw.text)
SELECT doc_id, rest AS text, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents LEFT JOIN cut ON cut.text = documents.text
"""


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of windows of all benchmark items in all documents."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


DECONTAM_SQL = r"""
WITH folded AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM folded),
pat AS (
  SELECT DISTINCT id AS item_id, k, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM w WHERE kind = 'b' AND len(ws) > 0)),
docwin AS (
  SELECT id AS doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (SELECT DISTINCT k FROM pat) WHERE kind = 'd' AND len(ws) >= k)),
hit AS (SELECT doc_id, i, k, item_id FROM docwin JOIN pat USING (k, win)),
n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n ON n.doc_id = w.id LEFT JOIN it ON it.doc_id = w.id WHERE kind = 'd'
"""

def ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of all for every benchmark item."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


SEARCH_SQL = r"""
WITH folded AS (
  SELECT 'd' AS kind, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
w AS (
  SELECT kind, id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM folded),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM w WHERE kind = 'd' AND len(ws) > 0),
m AS (
  SELECT id AS doc_id, 100 - 25 + (25 * len(ws) * n_docs) // n_terms AS m
  FROM w, total WHERE kind = 'd' AND len(ws) > 0),
times AS (
  SELECT id AS item_id, term, count(*) AS n
  FROM (SELECT id, unnest(ws) AS term FROM w WHERE kind = 'b') GROUP BY id, term),
tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT id AS doc_id, unnest(ws) AS term FROM w WHERE kind = 'd')
  WHERE term IN (SELECT term FROM times) GROUP BY doc_id, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
gain AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS gain
  FROM tf JOIN m USING (doc_id) JOIN weight USING (term)),
scored AS (SELECT item_id, doc_id, CAST(sum(n * gain) AS BIGINT) AS score FROM times JOIN gain USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""


def binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as records of ids; what the index says after the files were read back."""
    import public_tokenizers

    folder = scratch.new_path(spark, "token-records")
    records.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return records.build_index(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


PHRASES_SQL = r"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k >= 2 AND f >= 30),
cuts AS (
  SELECT lang, phrase, a, i, array_to_string(ws[1 : i], ' ') AS head, array_to_string(ws[i + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS i FROM c)),
cut AS (
  SELECT cuts.lang, cuts.phrase, a, i, h.f AS l, t.f AS r,
         CAST(CAST(2000000 AS HUGEINT) * a // (CAST(h.f AS HUGEINT) + t.f) AS BIGINT) AS score
  FROM cuts JOIN g AS h ON h.lang = cuts.lang AND h.phrase = head JOIN g AS t ON t.lang = cuts.lang AND t.phrase = tail),
least_cut AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
inside AS (
  SELECT lang, sub, max(a) AS a
  FROM (SELECT lang, a, array_to_string(ws[i : i + m - 1], ' ') AS sub
        FROM (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k))
  GROUP BY lang, sub),
kept AS (
  SELECT x.* FROM least_cut AS x LEFT JOIN inside ON inside.lang = x.lang AND inside.sub = x.phrase
  WHERE inside.a IS NULL OR CAST(100 AS HUGEINT) * inside.a < CAST(80 AS HUGEINT) * x.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

QUERIES = {
    "op1_quality_rules": quality_rules,
    "op2_vector_bin_packing": vector_bin_packing,
    "op3_simhash_near_dedup": simhash_near_dedup,
    "op4_surrogate_generation": surrogate_generation,
    "op5_counterfactual_toxicity": toxicity_scores,
    "op6_repeat_removal": repeat_removal,
    "op7_url_filter": url_filter,
    "op8_sentencepiece_encoding": sentencepiece_encoding,
    "op9_line_dedup": line_dedup,
    "op10_benchmark_decontamination": benchmark_decontamination,
    "op11_ranked_lexical_search": ranked_lexical_search,
    "op12_binary_records": binary_records,
    "op13_phrase_collocations": phrase_collocations,
}
SQL = {
    "op1_quality_rules": QUALITY_SQL,
    "op9_line_dedup": LINES_SQL,
    "op10_benchmark_decontamination": DECONTAM_SQL,
    "op11_ranked_lexical_search": SEARCH_SQL,
    "op13_phrase_collocations": PHRASES_SQL,
}
