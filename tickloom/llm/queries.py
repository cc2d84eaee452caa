"""The registered queries of this package: the thin digests their contracts ask for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.llm import (
    bpe, chat, language, licenses, mixing, packing, pii, quality, records, search, simhash, vectors, whitening,
)
from tickloom.llm.tokens import public_tokenizer
from tickloom.session import scratch_path, written

TOKENIZER = "word_bpe_49k.json"
END_ID, CAPACITY = 2, 4096

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function of (spark, folder) under its own name."""

    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = lambda spark, folder: run(spark, str(folder).rstrip("/"))
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Words and their number, in DuckDB's terms.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


# --- 1: records ------------------------------------------------------------------------------


@query()
def op1_token_records(spark: SparkSession, folder: str) -> DataFrame:
    """What the record files of all documents hold, read back."""
    docs = table(spark, folder, "documents")
    manifest = written(
        records.write_records(docs, scratch_path(spark, "records"), public_tokenizer(TOKENIZER), END_ID), "manifest")
    found = records.read_records(manifest).select(
        "shard", "record", "doc_id", "ids", F.crc32("ids").alias("ids_crc32"))
    return records.with_starts(found, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


# --- 2: licences -----------------------------------------------------------------------------


@query()
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The licence notices of every document: names, spans and coverage, in order."""
    found = licenses.with_licenses(table(spark, folder, "documents").select("doc_id", "text"), "found").select("doc_id", "found")
    spans = F.transform("found", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_found"), F.array_join(spans, ",").alias("spans"),
        F.array_max("found.coverage").alias("coverage"))


# --- 3: chats --------------------------------------------------------------------------------

# A conversation that says what marks look like.
TRAP_ID, TRAP_TEXT = -7, "\\### Assistant: </turn> ok"


@query(rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {TRAP_ID}, 0, 'user', '{TRAP_TEXT}' UNION ALL SELECT {TRAP_ID}, 1, 'assistant', '{TRAP_TEXT}'
), placed AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), shown AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) AS chars,
    length(role) + length(role)
      - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', '')) AS role_chars
  FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN before = role THEN 6 ELSE role_chars + 6 + 8 END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id""")
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of all formatted conversations, from the stored output read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(
        F.lit(TRAP_ID).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(TRAP_TEXT))
    chats = written(chat.format_chats(turns.union(trap)), "chats")
    read = chats.select(
        "conv_id", chat.read_turns(F.col("text")).alias("turns"),
        chat.read_loss(F.col("text"), F.col("loss")).alias("trained"), F.char_length("text").alias("chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"), F.char_length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"), F.col("chars").cast("long").alias("formatted_chars"))


# --- 4: near-duplicates by fingerprint -------------------------------------------------------


@query()
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint of every document and the class it falls into."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- 5: quality ------------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
_S = r"\x20\x09-\x0D"


@query(rf"""
WITH numbered AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {SQL_WORDS} AS w FROM documents
), lines AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_S}]')) AS l FROM numbered
), windows AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM numbered WHERE len(w) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1
), inside AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(3) AS steps(k) GROUP BY rid
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[{_S}]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_exclamations,
    len(list_filter(w, lambda x: NOT regexp_matches(x, '\p{{L}}'))) AS n_letterless,
    len(list_filter(w, lambda x: lower(x) IN ({_STOP}))) AS n_stop_words, len(l) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[{_S}]*[-*•]'))) AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[{_S}]*$'))) AS n_ellipses,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM lines LEFT JOIN inside USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR word_chars < 2.5 * n_words OR word_chars > 12 * n_words
    OR n_symbols > 0.1 * n_words OR n_exclamations > 0.3 * n_words OR n_letterless > 0.2 * n_words
    OR n_stop_words < 0.01 * n_words OR n_dup_lines > 0.3 * n_lines OR n_bullets > 0.9 * n_lines
    OR n_ellipses > 0.3 * n_lines) AS kept
FROM counted""")
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The counts and the verdict of every document."""
    found = quality.judged(table(spark, folder, "documents").select("doc_id", "text"), into="q")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *[f"q.{c}" for c in counts])


# --- 6: language -----------------------------------------------------------------------------


@query()
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.fit(docs.filter(~F.coalesce(held_out, F.lit(False))))
    found = language.with_language(docs.select("doc_id", "text"), model, "found")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "found.lang_pred", "found.score")


# --- 7: packing ------------------------------------------------------------------------------


@query()
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where every piece of every document lies."""
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizer(TOKENIZER), CAPACITY, END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# --- 8: personal data ------------------------------------------------------------------------


@query()
def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """The spans of personal data in every document, and those of the patterns alone."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.fit(docs), "found").select("doc_id", "found")
    base = F.filter("found", lambda x: x["base"])

    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def number(kind):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told(base), 256).alias("base_sha256"), told("found").alias("spans"))


# --- 9: near-duplicate vectors ---------------------------------------------------------------


# All pairs, and the closure of the links: quadratic, for tables of thousands of vectors.
SQL_LINKS = """
WITH RECURSIVE given AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), sound AS MATERIALIZED (
  SELECT r, v FROM (SELECT r, v, unnest(v) AS x FROM given)
  GROUP BY r, v HAVING count(x) = len(v) AND bool_and(isfinite(x)) AND bool_or(x <> 0)
), pairs AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.r < b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), links AS MATERIALIZED (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reached AS (
  SELECT r AS a, r AS b FROM given UNION SELECT t.a, l.b FROM reached t JOIN links l ON l.a = t.b
), classes AS (
  SELECT t.a AS r, min(g.vec_id) AS component_id FROM reached t JOIN given g ON g.r = t.b GROUP BY t.a
)
SELECT g.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, g.vec_id = c.component_id AS kept
FROM given g JOIN classes c ON c.r = g.r
LEFT JOIN (SELECT a, count(*) AS n_links FROM links GROUP BY a) n ON n.a = g.r"""


@query(SQL_LINKS)
def op9_vector_links(spark: SparkSession, folder: str) -> DataFrame:
    """The links and the class of every vector."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


# --- 10: mixing ------------------------------------------------------------------------------

MIX = {"weights": (3, 1, 2), "share": 1.5, "most": 2.0, "seed": 0}
# The mix in DuckDB's terms, as the plain definition has it: all rows of a source added up in order.
SQL_MIX = f"""
rows AS (
  SELECT doc_id, source, len({SQL_WORDS}) AS size,
    md5('{MIX["seed"]}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents
), sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM rows GROUP BY source
), levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
    (1.5::DOUBLE * sum(source_size) OVER ())
      - coalesce(sum(2.0::DOUBLE * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
    row_number() OVER w AS place
  FROM sizes WINDOW w AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)
), first_open AS (
  SELECT remaining AS r, weights AS w FROM levels WHERE cap * weights > remaining * weight ORDER BY place LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN cap * weights <= remaining * weight OR w IS NULL THEN cap
    ELSE r * weight / w END AS target
  FROM levels LEFT JOIN first_open ON true
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets
), grouped AS (
  SELECT source, key, count(*) AS copies, sum(size) AS words FROM rows GROUP BY source, key
), added AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS before FROM grouped
), mix AS (
  SELECT r.doc_id, r.size, r.key, b.source_size, b.target,
    CAST(b.epochs * r.size + least(r.size, greatest(0, (CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size - a.before)
      // a.copies)) AS BIGINT) AS taken
  FROM rows r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
  JOIN added a ON r.source IS NOT DISTINCT FROM a.source AND r.key = a.key
)"""


@query(f"WITH {SQL_MIX} SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken FROM mix")
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix takes."""
    mixed = mixing.with_mix(table(spark, folder, "documents").select("doc_id", "text", "source"), "mix", **MIX)
    return mixed.select("doc_id", "mix.*")


# --- 11: byte-level BPE ----------------------------------------------------------------------

BYTE_TOKENIZER = "byte_bpe_50k.json"


@query()
def op11_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the text that they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lexicon = bpe.build_lexicon(docs, public_tokenizer(BYTE_TOKENIZER))
    coded = bpe.encode(docs, lexicon, decoded="decoded")
    return coded.select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


# --- 12: ranked search -----------------------------------------------------------------------

BEST = 20


def _sql_terms(source: str, key: str) -> str:
    """Rows of key and term, in DuckDB's terms."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""SELECT rid, {key}, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{parts}')) AS term
  FROM (SELECT row_number() OVER () AS rid, * FROM {source})"""


@query(f"""
WITH doc_terms AS ({_sql_terms("documents", "doc_id")}
), tfs AS (
  SELECT rid, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM doc_terms GROUP BY rid, term
), sizes AS (
  SELECT rid, sum(tf)::BIGINT AS n FROM tfs GROUP BY rid
), whole AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, whole GROUP BY term
), wanted AS (
  SELECT rid AS item, any_value(item_id) AS item_id, term, count(*) AS times FROM ({_sql_terms("benchmark", "item_id")}) GROUP BY rid, term
), scored AS (
  SELECT item, any_value(item_id) AS item_id, t.rid, any_value(t.doc_id) AS doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // len))))::BIGINT AS score
  FROM wanted JOIN tfs t USING (term) JOIN weights USING (term) JOIN sizes s ON s.rid = t.rid, whole
  GROUP BY item, t.rid
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= {BEST}""")
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The best documents for every benchmark item."""
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), BEST)


# --- 13: whitening ---------------------------------------------------------------------------


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector along the components of all distinct ones."""
    return whitening.whitened(table(spark, folder, "embeddings"))
