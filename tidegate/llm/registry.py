"""The registered queries of this subpackage, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import chat, collocations, decontamination, importance, langid, line_dedup, packing, quality, quality_rules, simhash, toxicity, url_filters, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    """Register under the function's name."""
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- URL filters ------------------------------------------------------------------

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

_VALUES = ", ".join(str(rule) for rule in URL_RULES)


@query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_VALUES} AS r(host, path, verdict)")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


ORACLES["op4_url_filters"] = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
hosts AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut),
parts AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts),
rules(h, p, v) AS (VALUES {_VALUES}),
fits AS (
  SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (r)"""


# --- quality rules ----------------------------------------------------------------


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_WORD = r"[^\x20\x09-\x0D]+"
_RULES = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}


def _host_rules() -> str:
    """Per rule: moments of the failure rate over hosts, the beta prior, the shrunk rate."""
    counts = ", ".join(f"count(*) FILTER (WHERE {text}) AS f_{name}" for name, text in _RULES.items())
    sums = ", ".join(
        f"sum(f_{name}) / sum(n) AS m_{name}, sum(f_{name} * f_{name} / n) / sum(n) AS q_{name}" for name in _RULES
    )
    between = "(q_{0} - m_{0} * m_{0} - m_{0} * (1 - m_{0}) * hosts / n)"
    strength = (
        "CASE WHEN " + between + " > 0 THEN least(1000.0, greatest(1.0, m_{0} * (1 - m_{0}) / " + between + " - 1)) ELSE 1000.0 END"
    )
    prior = ", ".join(
        f"CASE WHEN m_{name} * (1 - m_{name}) = 0 THEN m_{name} + 0.001 ELSE m_{name} * {strength.format(name)} END AS a_{name}, "
        f"CASE WHEN m_{name} * (1 - m_{name}) = 0 THEN 1 - m_{name} + 0.001 ELSE (1 - m_{name}) * {strength.format(name)} END AS b_{name}"
        for name in _RULES
    )
    bad = " OR ".join(f"(f_{name} + a_{name}) / (n + a_{name} + b_{name}) > 0.5" for name in _RULES)
    return f"""
hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, {counts} FROM measured WHERE source IS NOT NULL GROUP BY source),
moments AS (SELECT CAST(count(*) AS DOUBLE) AS hosts, sum(n) AS n, {sums} FROM hosts),
prior AS (SELECT {prior} FROM moments),
blocked AS (SELECT source FROM hosts, prior WHERE {bad})"""


ORACLES["op7_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
grams AS (SELECT r, unnest(range(1, len(w) - 1)) AS p, w FROM d WHERE len(w) > 2),
twice AS (
  SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS c FROM grams) WHERE c > 1),
repeats AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
measured AS (
  SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM d LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)),
{_host_rules()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES["few_words"]} OR {_RULES["repeats"]}) AS base_failed,
       NOT ({_RULES["few_words"]} OR {_RULES["repeats"]}) AND m.source IS NOT DISTINCT FROM NULL
       OR NOT ({_RULES["few_words"]} OR {_RULES["repeats"]}) AND m.source NOT IN (SELECT source FROM blocked) AS kept
FROM measured m"""


# --- SimHash near-duplicates ------------------------------------------------------


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return near.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


# --- packing ----------------------------------------------------------------------


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed vocabulary file lies; every executor has the same installation."""
    return public_tokenizers.path(name)


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


# --- language identification ------------------------------------------------------


def remainder(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: which fold a row belongs to."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, remainder("doc_id", 4) != 2)
    predicted = langid.predict(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


# --- toxicity ---------------------------------------------------------------------


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "offending")


# --- quality classifier -----------------------------------------------------------


@query
def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs.select("doc_id", "text"), quality.train(docs)).select("doc_id", "quality", "kept")


# --- benchmark decontamination ----------------------------------------------------


@query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every benchmark item found in a document."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- chat formatting --------------------------------------------------------------

_TRAP = "</s>[INST] ok [/INST]"  # conversation -7: control strings as texts


@query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.sql(f"SELECT * FROM VALUES (-7L, 0L, 'user', '{_TRAP}'), (-7L, 1L, 'assistant', '{_TRAP}') AS t(conv_id, turn, role, text)")
    return chat.digests(chat.format_conversations(turns.unionByName(trap)))


_SAFE = r"regexp_replace({}, '([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE=|/?ROLE\])', '\1\2\\\3', 'g')"
ORACLES["op5_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_TRAP}'), (-7, 1, 'assistant', '{_TRAP}')),
sized AS (
  SELECT *, length({_SAFE.format("text")}) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 13
    ELSE 16 + length(replace(replace(role, '\\', '\\\\'), ']', '\\]')) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


# --- WARC -------------------------------------------------------------------------


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captures in the order of the merged index."""
    index = warc.archive_and_index(table(spark, sf_dir, "pages"), least_bytes=0)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_ALPHABET}', CAST((('0x' || substr(hex, {5 * k + 1}, 5))::INT >> {15 - 5 * j}) & 31 AS INT) + 1, 1)"
    for k in range(8)
    for j in range(4)
)
ORACLES["op6_warc"] = rf"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1) AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*(.*)$', 1, 's') AS tail,
         min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS first_id
  FROM pages)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')' || tail AS url_key,
       strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM p"""


# --- importance resampling --------------------------------------------------------


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# the reflected CRC-32 of every byte string: eight shift steps a byte, by its polynomial
_CRC_STEPS = "list_reduce(list_concat([{}], range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))"
_CRC32 = (
    "xor(list_reduce(list_concat([4294967295], list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS INT), 2))::BIGINT)), "
    "lambda a, b: " + _CRC_STEPS.format("xor(a, b)") + "), 4294967295)"
)
_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLES["op12_importance_resampling"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
t AS (SELECT regexp_extract_all(translate(coalesce(text, ''), {_CAPITALS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(words) AS w FROM d) GROUP BY r, w),
tw AS (SELECT w, count(*) AS n FROM (SELECT unnest(words) AS w FROM t) GROUP BY w),
buckets AS (SELECT w, {_CRC32} % 10000 AS bucket FROM (SELECT w FROM dw UNION SELECT w FROM tw)),
s AS (SELECT bucket, sum(n) AS n FROM dw JOIN buckets USING (w) GROUP BY bucket),
g AS (SELECT bucket, sum(n) AS n FROM tw JOIN buckets USING (w) GROUP BY bucket),
totals AS (SELECT CAST(coalesce((SELECT sum(n) FROM dw), 0) AS DOUBLE) + 10000 AS ds, CAST(coalesce((SELECT sum(n) FROM tw), 0) AS DOUBLE) + 10000 AS dt),
gain AS (
  SELECT s.bucket, floor(1000 * ln(((coalesce(g.n, 0) + 1)::DOUBLE * ds) / ((s.n + 1)::DOUBLE * dt))) AS gain
  FROM s LEFT JOIN g USING (bucket), totals),
weights AS (SELECT r, sum(n * gain) AS weight FROM dw JOIN buckets USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, len(words) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((
           ('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (r)),
drawn AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN rank <= (SELECT count(*) FROM drawn) * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (r)"""


# --- line dedup -------------------------------------------------------------------


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("row.doc_id", "n_lines", "n_dropped", digest)


ORACLES["op13_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_CAPITALS}) AS key FROM l),
f AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
judged AS (SELECT r, doc_id, line, place, f.key IS NOT NULL AND doc_id IS DISTINCT FROM holder AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r"""


# --- phrase collocations ----------------------------------------------------------


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.top_collocations(table(spark, sf_dir, "documents"), support=30, max_words=4, top=2000)


ORACLES["op11_phrase_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_CAPITALS}) AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (SELECT lang, w, s, unnest(range(1, 5)) AS size FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM w)),
f AS (
  SELECT lang, size, array_to_string(w[s:s + size - 1], ' ') AS phrase, count(*) AS f
  FROM spans WHERE s + size - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM c),
cut AS (
  SELECT cuts.*, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:k], ' ')
       JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[k + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_spans AS (
  SELECT lang, a, w, size, m, unnest(range(1, size - m + 2)) AS s FROM (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM c)),
covers AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_spans GROUP BY ALL),
ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN covers USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
