"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (document, term, position) for every occurrence of a
benchmark term in the corpus, and one that closes each document and holds its length.
Phrases are found from their rarest terms: the postings of a phrase's rarest term,
moved by the term's offset, are the places where it can start; they are intersected
with the moved postings of its second rarest term, and what is left is compared with
the words of the document. Terms as frequent as "the" are looked up only where a phrase
has no rarer ones.

DataFrame functions only. What is broadcast is staged first and its size checked; beyond
``BROADCAST_BYTES`` the same join shuffles.

Defined results: null and empty texts have no words; null item ids are named by an empty
string. Equal phrases of several items count for each of them. Repeated rows of a document
each get the same result; an item on several rows counts once. Extra columns are not looked
at, or pass through where asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.staging import stage, stage_lookup, staged_bytes
from .tables import free_name

PHRASE_WORDS = 10
BROADCAST_BYTES = 32 << 20
# ASCII apart from digits and lower-case letters; upper case is lowered before.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def closed_words(text: Column) -> Column:
    """The words of a text, and an empty string behind the last one."""
    text = F.concat(F.coalesce(text, F.lit("")), F.lit(" "))
    # lower() is quick on plain ASCII and would lower other letters too.
    plain = F.octet_length(text) == F.char_length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.split(F.regexp_replace(lowered, "^" + SEPARATORS, ""), SEPARATORS, -1)


def _looked_up(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join of a staged relation, broadcast if it is small."""
    hint = "broadcast" if staged_bytes(small) <= BROADCAST_BYTES else "merge"
    return big.join(small.hint(hint), on, how)


def phrases(items: DataFrame, size: int = PHRASE_WORDS, key: str = "item_id", text: str = "text") -> DataFrame:
    """(phrase, n, words, item_id): every window of ``size`` words, or a shorter item as a whole."""
    words = F.filter(closed_words(F.col(text)), lambda w: w != "")
    listed = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item_id"), words.alias("all"))
    listed = listed.where(F.size("all") > 0)
    last = F.greatest(F.size("all") - size, F.lit(0))
    windows = listed.select("item_id", "all", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    windows = windows.select("item_id", F.slice("all", F.col("at") + 1, F.lit(size)).alias("words"))
    spelled = F.array_join("words", " ")
    return windows.select(F.xxhash64(spelled).alias("phrase"), F.size("words").alias("n"), "words", "item_id").distinct()


def index(docs: DataFrame, terms: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, row_hash, term, position) of all occurrences of ``terms`` (word, term), staged.

    Each row of ``docs`` also has one posting of the empty word, at its number of words.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(key, text).alias("row_hash"), closed_words(F.col(text)).alias("w"))
    said = rows.select("doc_id", "row_hash", F.posexplode("w").alias("position", "word"))
    return stage(_looked_up(said, terms, ["word"]).select("doc_id", "row_hash", "term", "position"))


def vocabulary(found: DataFrame) -> DataFrame:
    """(word, term) of all words of phrases, and the empty word; staged."""
    words = found.select(F.explode("words").alias("word")).distinct()
    words = words.unionByName(found.sparkSession.sql("SELECT '' AS word"))
    return stage_lookup(words.select("word", F.xxhash64("word").alias("term")))


def rarest_terms(found: DataFrame, postings: DataFrame) -> DataFrame:
    """(phrase, n, term1, offset1, term2, offset2) of phrases all of whose terms occur; staged."""
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))
    different = found.select("phrase", "n", "words").distinct()
    terms = different.select("phrase", "n", F.posexplode("words").alias("offset", "word"))
    terms = terms.select("phrase", "n", "offset", F.xxhash64("word").alias("term")).join(counts, "term", "left")
    ranked = terms.groupBy("phrase", "n").agg(  # a phrase has at most as many terms as a window has words
        F.count("frequency").alias("known"),
        F.sort_array(F.collect_list(F.struct("frequency", "term", "offset"))).alias("by_rarity"),
    )
    first, second = F.col("by_rarity")[0], F.col("by_rarity")[F.size("by_rarity") - 1]
    # The second rarest different term; for a phrase of one repeated word its other end.
    others = F.filter("by_rarity", lambda x: x["term"] != F.col("by_rarity")[0]["term"])
    second = F.when(F.size(others) > 0, F.get(others, F.lit(0))).otherwise(second)
    return stage_lookup(
        ranked.where(F.col("known") == F.col("n")).select(
            "phrase",
            "n",
            first["term"].alias("term1"),
            first["offset"].alias("offset1"),
            second["term"].alias("term2"),
            second["offset"].alias("offset2"),
        )
    )


def possible_starts(rarest: DataFrame, postings: DataFrame) -> DataFrame:
    """(row_hash, start, phrase, n) where the two rarest terms of a phrase stand in their places; staged."""
    first = _looked_up(postings.withColumnRenamed("term", "term1"), rarest, ["term1"])
    first = first.select(
        "row_hash", "phrase", "n", (F.col("position") - F.col("offset1")).alias("start"), "term2", "offset2"
    ).where("start >= 0")
    starts = first.select(
        "row_hash", "start", "phrase", "n", F.col("term2").alias("term"), (F.col("start") + F.col("offset2")).alias("position")
    )
    second = stage_lookup(rarest.select(F.col("term2").alias("term")).distinct())
    lists = _looked_up(postings.select("row_hash", "term", "position"), second, ["term"])
    met = starts.join(lists, ["row_hash", "term", "position"], "left_semi")
    return stage_lookup(met.select("row_hash", "start", "phrase", "n").distinct())


def occurrences(docs: DataFrame, starts: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row_hash, start, n, phrase) of the possible starts where the whole phrase stands; staged."""
    listed = stage_lookup(
        starts.groupBy("row_hash").agg(F.collect_list(F.struct("start", "n", "phrase")).alias("starts"))
    )
    rows = docs.select(F.xxhash64(key, text).alias("row_hash"), F.col(text).alias("text"))
    rows = _looked_up(rows, listed, ["row_hash"]).select("row_hash", "starts", closed_words(F.col("text")).alias("w"))
    same = F.filter(
        "starts", lambda s: F.xxhash64(F.array_join(F.slice(F.col("w"), s["start"] + 1, s["n"]), " ")) == s["phrase"]
    )
    found = rows.select("row_hash", F.explode(same).alias("s"))
    return stage(found.select("row_hash", "s.start", "s.n", "s.phrase").distinct())


def contamination(
    docs: DataFrame,
    items: DataFrame,
    size: int = PHRASE_WORDS,
    text: str = "text",
    key: str = "doc_id",
    item_key: str = "item_id",
) -> DataFrame:
    """(doc_id, row_hash, n_words, n_hit, item_ids) of every row of ``docs``.

    ``n_hit``: words inside an occurrence of a phrase of ``items``; ``item_ids``: the
    items, as sorted strings, that have one.
    """
    found = stage(phrases(items, size, item_key))
    postings = index(docs, vocabulary(found), text, key)
    closing = postings.where(F.col("term") == F.xxhash64(F.lit("")))
    rarest = rarest_terms(found, postings)
    hits = occurrences(docs, possible_starts(rarest, postings), text, key)
    places = hits.select("row_hash", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("p")).distinct()
    hit_words = places.groupBy("row_hash").agg(F.count(F.lit(1)).alias("n_hit"))
    named = _looked_up(hits.select("row_hash", "phrase"), stage_lookup(found.select("phrase", "item_id")), ["phrase"])
    named = named.groupBy("row_hash").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    marks = stage_lookup(hit_words.join(named, "row_hash"))
    lengths = closing.select("doc_id", "row_hash", F.col("position").cast("bigint").alias("n_words"))
    return _looked_up(lengths, marks, ["row_hash"], "left").select(
        "doc_id",
        "row_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(docs: DataFrame, items: DataFrame, size: int = PHRASE_WORDS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without an occurrence, with all their columns."""
    name = free_name(docs, "row_hash")
    hit = contamination(docs, items, size, text, key).where("n_hit > 0").select(F.col("row_hash").alias(name))
    marked = docs.withColumn(name, F.xxhash64(key, text))
    return _looked_up(marked, stage_lookup(hit.distinct()), [name], "left_anti").drop(name)


def near_each_other(docs: DataFrame, pairs: DataFrame, within: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, a, b, position_a, position_b): pairs of words (a, b) at most ``within`` positions apart."""
    words = pairs.select(F.explode(F.array("a", "b")).alias("word")).distinct()
    terms = stage_lookup(words.select("word", F.xxhash64("word").alias("term")))
    postings = index(docs, terms, text, key)
    cell = F.floor(F.col("position") / within)
    named = stage_lookup(pairs.select("a", "b", F.xxhash64("a").alias("term_a"), F.xxhash64("b").alias("term_b")).distinct())
    left = _looked_up(postings.withColumnRenamed("term", "term_a"), named, ["term_a"])
    left = left.select(
        "doc_id", "row_hash", "a", "b", "term_b", F.col("position").alias("position_a"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"),
    )
    right = postings.select("row_hash", F.col("term").alias("term_b"), F.col("position").alias("position_b"), cell.alias("cell"))
    met = left.join(right, ["row_hash", "term_b", "cell"])
    apart = F.abs(F.col("position_a") - F.col("position_b"))
    return met.where((apart <= within) & (apart > 0)).select("doc_id", "a", "b", "position_a", "position_b").distinct()
