"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

Three tables make the index, written once to the shared folder (or to ``path``): ``tokens`` (a row
per document: key, doc_id, n_words, and its words with one space between), ``postings`` (a row per word
of a document: term, key, pos), each file of it a range of documents with the places of a term
together, and ``terms`` (how often each term occurs).
Neither documents nor postings are shuffled to build it, so no term, however frequent, meets in one task.

A search cuts every item into windows of consecutive words. The terms of a window are ranked by how
often they occur; the list of the rarest, moved by the term's place in the window, gives the places
where the window could begin, and the lists of the next rarest are intersected with it. What is left
is compared word by word with the stored documents. A window with a term that no document has ends
at once. The same start gives proximity matches: all words of a window within so many words.

Words: A-Z are lower-cased; runs of anything but ASCII that is not a letter or digit.

Defined cases: a null or empty text has no words: its document is listed with zeros, its item has no
windows. An item of fewer words than a window is one window. Rows that share a doc_id, repeated rows and
rows without one are documents of their own. Rows of one item_id are one item; an item without item_id
marks words as hit, but is not counted or listed. Ties among a window's terms go to the earlier place.
Empty tables give no rows, or no matches. Other columns are not read.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import stored
from tripmart.session import shared_dir

WINDOW = 10
#: Posting lists that are intersected, from the rarest on, before words are compared.
LISTS = 3
#: Bytes of a row group of the stored words.
ROW_GROUP = 8 * 2**20
#: What stands between words, once A-Z are lower-cased.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced(text: Column) -> Column:
    """The words of a text with one space between; empty of a null one."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)  # then lower() touches nothing but A-Z, and is faster
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.trim(F.regexp_replace(lowered, _BETWEEN, " "))


def split(words: Column) -> Column:
    """The words of ``spaced``; none of an empty text."""
    return F.when(words == "", F.array().cast("array<string>")).otherwise(F.split(words, " "))


def words(text: Column) -> Column:
    return split(spaced(text))


@dataclass(frozen=True)
class Index:
    tokens: DataFrame
    postings: DataFrame
    terms: DataFrame


TOKENS, POSTINGS, TERMS = "tokens", "postings", "terms"


def build(docs: DataFrame, path: str | None = None) -> Index:
    """Write the index of ``docs`` (doc_id, text) below ``path`` and open it."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/llm/positional-{uuid.uuid4().hex[:12]}"
    # the number of a row is given once and stored: jobs that read it see the same one whenever tasks run again
    own = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", spaced(F.col("text")).alias("words"))
    spaces = F.char_length("words") - F.char_length(F.replace("words", F.lit(" ")))
    n_words = F.when(F.col("words") == "", 0).otherwise(spaces + 1).cast("long")
    # plain and in small row groups: a split of this table then bounds the words that a task sorts below
    (own.select("key", "doc_id", n_words.alias("n_words"), "words").write.option("compression", "uncompressed")
     .option("parquet.block.size", ROW_GROUP).parquet(f"{path}/{TOKENS}"))
    tokens = spark.read.parquet(f"{path}/{TOKENS}")
    # places of a term come together by its hash: numbers sort several times as fast as words
    (tokens.select("key", F.posexplode(split(F.col("words"))).alias("pos", "term")).select("term", "key", "pos")
     .sortWithinPartitions(F.xxhash64("term")).write.parquet(f"{path}/{POSTINGS}"))
    postings = spark.read.parquet(f"{path}/{POSTINGS}")
    postings.groupBy("term").agg(F.count("*").alias("n")).write.parquet(f"{path}/{TERMS}")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    """An index written before."""
    return Index(*(spark.read.parquet(f"{path}/{name}") for name in (TOKENS, POSTINGS, TERMS)))


@dataclass(frozen=True)
class Windows:
    """Distinct windows of all items: phrases (win, phrase), owners (win, item_id)."""
    phrases: DataFrame
    owners: DataFrame


def windows(items: DataFrame, size: int = WINDOW) -> Windows:
    own = items.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1))))
    each = own.select("item_id", "w", first.alias("i")).select("item_id", F.slice("w", F.col("i"), size).alias("phrase"))
    phrases = stored(each.select("phrase").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    return Windows(phrases, stored(each.join(phrases, "phrase").select("win", "item_id").distinct(), "window-owners"))


def ranked_terms(index: Index, wins: Windows) -> DataFrame:
    """(win, term, place, rank, len) of the windows whose terms all occur; rank 1 is the rarest term."""
    each = wins.phrases.select("win", F.size("phrase").alias("len"), F.posexplode("phrase").alias("place", "term"))
    held = each.join(index.terms, "term").withColumn("held", F.count("*").over(Window.partitionBy("win")))
    rank = F.row_number().over(Window.partitionBy("win").orderBy("n", "place"))
    return held.filter("held = len").select("win", "term", "place", "len", rank.alias("rank"))


def _list(index: Index, terms: DataFrame) -> DataFrame:
    """The postings of some terms."""
    return index.postings.join(terms.select("term").distinct(), "term", "left_semi")


def phrase_matches(index: Index, wins: Windows, lists: int = LISTS) -> DataFrame:
    """Every place where a window occurs: win, key (of the document), start, len."""
    ranked = stored(ranked_terms(index, wins), "window-terms")
    rarest = ranked.filter("rank = 1").select("win", "term", "place", "len")
    found = (index.postings.join(rarest, "term")
             .select("win", "key", (F.col("pos") - F.col("place")).alias("start"), "len").filter("start >= 0"))
    for r in range(2, lists + 1):
        level = ranked.filter(F.col("rank") == r).select("win", "term", "place")
        # stored with the term that they want next: their size is known before postings are moved for the join
        wanted = stored(found.join(level, "win", "left").select("win", "key", "start", "len", "term", (F.col("start") + F.col("place")).alias("pos")),
                        f"starts-{r - 1}")
        kept = _list(index, level).join(wanted, ["term", "key", "pos"]).select("win", "key", "start", "len")
        found = kept.unionByName(wanted.filter("term IS NULL").select("win", "key", "start", "len"))  # windows of fewer words
    found = stored(found, f"starts-{lists}")
    # the documents of the last list, and their words at these places
    at = found.groupBy("key").agg(F.collect_list(F.struct("win", "start", "len")).alias("starts"))
    there = (_held(index, found).join(at, "key").select("key", split(F.col("words")).alias("words"), F.explode("starts").alias("s"))
             .select("key", "s.*", F.slice("words", F.col("s.start") + 1, F.col("s.len")).alias("phrase")))
    return there.join(wins.phrases, ["win", "phrase"]).select("win", "key", "start", "len")


def _held(index: Index, found: DataFrame) -> DataFrame:
    """The documents of some starts. Their stored keys pick them: where those are few, Spark sees it and moves no other text."""
    return index.tokens.join(stored(found.select("key").distinct(), "start-keys"), "key", "left_semi")


def proximity_matches(index: Index, wins: Windows, slop: int) -> DataFrame:
    """Every stretch of a document that holds all different words of a window, in any order: win, key, start, len.

    A stretch is as long as the window and ``slop`` more words (the whole document where that is shorter).
    """
    ranked = stored(ranked_terms(index, wins), "window-terms")
    span = F.col("len") + slop
    rarest = ranked.filter("rank = 1").select("win", "term", "len")
    found = stored(index.postings.join(rarest, "term").select("win", "key", "len", F.col("pos").alias("p")), "near-1")
    second = ranked.filter("rank = 2").select("win", "term")
    near = _list(index, second).withColumnRenamed("pos", "q")
    kept = (found.join(second, "win").join(near, ["term", "key"]).filter(F.abs(F.col("p") - F.col("q")) < span)
            .select("win", "key", "len", "p").distinct())
    found = stored(kept.unionByName(found.filter("len = 1")), "near-2")
    last = F.greatest(F.col("n_words") - span, F.lit(0))
    starts = F.explode(F.sequence(F.greatest(F.least(F.col("p") - span + 1, last), F.lit(0)), F.least(F.col("p"), last)))
    tried = (found.join(_held(index, found), "key").withColumn("n_words", F.col("n_words").cast("int"))
             .select("win", "key", "len", split(F.col("words")).alias("words"), starts.alias("start"))
             .select("win", "key", "start", span.alias("len"), F.slice("words", F.col("start") + 1, span).alias("stretch"))
             .join(wins.phrases, "win"))
    return tried.filter(F.size(F.array_except("phrase", "stretch")) == 0).select("win", "key", "start", "len").distinct()


def covered(matches: DataFrame) -> DataFrame:
    """(key, n_hit): words of each document inside a match."""
    runs = matches.groupBy("key", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    return runs.select("key", F.greatest(new, F.lit(0)).alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))


def spans(index: Index, wins: Windows, matches: DataFrame) -> DataFrame:
    """The matches as their reader wants them: doc_id, item_id, start, len, phrase."""
    return (matches.join(wins.owners, "win").join(wins.phrases, "win").join(index.tokens.select("key", "doc_id"), "key")
            .select("doc_id", "item_id", "start", "len", F.array_join("phrase", " ").alias("phrase")))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    index, wins = build(docs), windows(items, size)
    matches = stored(phrase_matches(index, wins), "phrase-matches")
    names = (matches.select("key", "win").distinct().join(wins.owners, "win")
             .groupBy("key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("names")))
    found = covered(matches).join(names, "key")
    names = F.coalesce("names", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return index.tokens.select("key", "doc_id", "n_words").join(found, "key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def sql(size: int = WINDOW) -> str:
    """DuckDB SQL: every window of every document against every window of every item."""
    def words_of(table: str, key: str) -> str:
        return (f"SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), "
                f"'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}")
    return f"""
WITH d AS ({words_of("(SELECT row_number() OVER () AS k, * FROM documents)", "k, doc_id")}),
b AS ({words_of("benchmark", "item_id")}),
bw AS (SELECT item_id, w[i:i + {size - 1}] AS p, len(w[i:i + {size - 1}]) AS m FROM
       (SELECT *, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT k, m, i, w[i:i + m - 1] AS p FROM (SELECT k, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m)),
hit AS (SELECT k, i, m, item_id FROM dw JOIN bw USING (m, p)),
pos AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + m)) AS j FROM hit) GROUP BY k),
own AS (SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (k) LEFT JOIN own USING (k)"""
