"""The registered queries over the operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.staging import new_folder
from . import (
    backoff,
    byte_bpe,
    collocations,
    conversations,
    language,
    phrase_index,
    quality,
    ranked_search,
    recompression,
    similarity_search,
    simhash,
    suffix_array,
    token_files,
)
from .tables import table

VOCABULARY = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; an id that is null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.classify(docs, labels, learn=remainder(5) != 0)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    found = backoff.scores(table(spark, folder, "documents"), order=2, alpha=0.4, unseen=0.5)
    # The sums are of doubles; their last digits depend on the order of summing.
    rounded = {name: F.round(name, 6) for name in ("log_score", "mean_log_score")}
    return found.withColumns(rounded)


LANGUAGE_MODEL_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
said AS (SELECT doc_id, p, ws[p] AS w, CASE WHEN p > 1 THEN ws[p - 1] END AS before FROM words, range(1, len(ws) + 1) AS r(p)),
own1 AS (SELECT doc_id, w, count(*) AS n FROM said GROUP BY ALL),
all1 AS (SELECT w, sum(n) AS n FROM own1 GROUP BY w),
own2 AS (SELECT doc_id, before, w, count(*) AS n FROM said WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, w, sum(n) AS n FROM own2 GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM said GROUP BY doc_id),
counted AS (
  SELECT doc_id, a.n - o.n AS f_word, (SELECT sum(n) FROM sizes) - s.n AS f_all,
    coalesce(a2.n - o2.n, 0) AS f_pair, coalesce(ab.n - ob.n, 0) AS f_before, before
  FROM said JOIN own1 o USING (doc_id, w) JOIN all1 a USING (w) JOIN sizes s USING (doc_id)
  LEFT JOIN own2 o2 USING (doc_id, before, w) LEFT JOIN all2 a2 USING (before, w)
  LEFT JOIN own1 ob ON ob.doc_id = said.doc_id AND ob.w = before LEFT JOIN all1 ab ON ab.w = before),
scored AS (
  SELECT doc_id, CASE WHEN f_pair > 0 THEN ln(f_pair / f_before)
    ELSE ln(greatest(f_word, 0.5) / greatest(f_all, 1)) + CASE WHEN before IS NULL THEN 0 ELSE ln(0.4) END END AS l
  FROM counted)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(sum(l), 6) AS log_score, round(sum(l) / len(ws), 6) AS mean_log_score
FROM words LEFT JOIN scored USING (doc_id) GROUP BY doc_id, ws
"""


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), words_each=4, distance=4)
    fingerprint = F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0"))
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs, where=remainder(3) != 1)
    found = language.predict(docs, model)
    return found.select("doc_id", (remainder(3) == 1).alias("held_out"), "lang_pred", "score")


def encoded(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    found = byte_bpe.encode(table(spark, folder, "documents"), path, pattern, decoded="decoded")
    return found.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def without_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = recompression.remove_repeats(table(spark, folder, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def chats(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.collapse_and_render(table(spark, folder, "conversations"))


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    found = similarity_search.nearest(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)
    return found.withColumn("score", F.round("score", 12))


def without_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_array.remove_repeats(table(spark, folder, "documents"), window=200)
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def contaminated(spark: SparkSession, folder: str) -> DataFrame:
    found = phrase_index.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)


RANKED_SQL = r"""
WITH said AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term
  FROM documents),
asked AS (
  SELECT DISTINCT item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term
  FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM said GROUP BY doc_id),
totals AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
norms AS (SELECT doc_id, 100 - 90 + (90 * n * all_docs) // all_terms AS m FROM sizes, totals),
postings AS (SELECT doc_id, term, count(*) AS tf FROM said WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (doc_id) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""


def phrases_by_language(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"), least=100, most_words=5, first=2000)


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
said AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM said GROUP BY lang),
frequent AS (
  SELECT lang, size, array_to_string(ws[s : s + size - 1], ' ') AS phrase, count(*) AS f
  FROM said, range(1, 6) AS a(size), range(1, len(ws) - size + 2) AS b(s) GROUP BY ALL HAVING count(*) >= 100),
spelled AS (SELECT lang, size, phrase, f, string_split(phrase, ' ') AS ws FROM frequent),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM spelled c JOIN sizes USING (lang), range(1, size) AS cut(k)
  JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : k], ' ')
  JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1 :], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(ws[s : s + part - 1], ' ') AS phrase, max(f) AS inside
  FROM spelled, range(2, size) AS a(part), range(1, size - part + 2) AS b(s) GROUP BY ALL),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM lowest LEFT JOIN inner_phrases USING (lang, phrase) WHERE inside IS NULL OR 100 * inside < 100 * a)
SELECT * FROM ranked WHERE rank <= 2000
"""


def written_tokens(spark: SparkSession, folder: str) -> DataFrame:
    files = new_folder(spark)
    token_files.write_tokens(table(spark, folder, "documents"), files, public_tokenizers.path(TOKENIZER), end_id=2)
    return token_files.read_tokens(spark, files, with_ids=False).withColumnRenamed("doc_key", "doc_id")


CONTAMINATED_SQL = r"""
WITH said AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents),
asked AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s : s + 9], ' ') AS phrase
  FROM asked, range(1, greatest(len(ws) - 9, 1) + 1) AS r(s) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM phrases),
hits AS (
  SELECT doc_id, s, n, item_id FROM (
    SELECT doc_id, s, n, array_to_string(ws[s : s + n - 1], ' ') AS phrase
    FROM said, sizes, range(1, len(ws) - n + 2) AS r(s)) JOIN phrases USING (n, phrase)),
words_hit AS (
  SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM hits, range(0, n) AS r(k) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM said LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""

REPEATS_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS w FROM words, range(1, len(ws) - 18) AS r(s)),
earliest AS (
  SELECT w, min(struct_pack(d := doc_id, s := s)) AS earlier FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, s + k AS p FROM windows JOIN earliest USING (w), range(0, 20) AS r(k)
  WHERE struct_pack(d := doc_id, s := s) > earlier),
kept AS (
  SELECT doc_id, p, ws[p] AS w FROM words, range(1, len(ws) + 1) AS r(p)
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = words.doc_id AND g.p = r.p)),
texts AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM kept GROUP BY doc_id)
SELECT words.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN texts USING (doc_id)
"""

CHATS_SQL = """
WITH said AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS nth
  FROM said),
listed AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY nth) AS turns,
    string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY nth) AS text
  FROM numbered GROUP BY conv_id),
prefixes AS (
  SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM listed, range(1, n_turns) AS r(k)),
kept AS (
  SELECT turns, min(conv_id) AS conv_id, min(n_turns) AS n_turns, count(*) AS n_copies, min(text) AS text
  FROM listed WHERE turns NOT IN (SELECT turns FROM prefixes) GROUP BY turns)
SELECT conv_id, n_turns, n_copies, text FROM kept
"""

NEIGHBOURS_SQL = """
WITH usable AS (
  SELECT vec_id, min(embedding::DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, round(score, 12) AS score FROM ranked WHERE rank <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": quality_scores,
        "op2_lm_scoring": language_model_scores,
        "op3_simhash_near_dedup": near_duplicates,
        "op4_language_id": languages,
        "op5_byte_bpe": encoded,
        "op6_substring_dedup": without_repeats,
        "op7_chat_formatting": chats,
        "op8_benchmark_decontamination": contaminated,
        "op9_suffix_array_dedup": without_repeated_bytes,
        "op10_nearest_neighbours": neighbours,
        "op11_ranked_search": ranked,
        "op12_collocations": phrases_by_language,
        "op13_token_files": written_tokens,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_lm_scoring": LANGUAGE_MODEL_SQL,
        "op6_substring_dedup": REPEATS_SQL,
        "op7_chat_formatting": CHATS_SQL,
        "op8_benchmark_decontamination": CONTAMINATED_SQL,
        "op10_nearest_neighbours": NEIGHBOURS_SQL,
        "op11_ranked_search": RANKED_SQL,
        "op12_collocations": COLLOCATIONS_SQL,
    }
