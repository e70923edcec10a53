"""Benchmark decontamination: which words of each document lie in a window of words of a benchmark item.

A prefix-filtered join for exact containment. The words of a window are ordered by how rare they are in the
documents; a document that holds the window holds its rarest word, so that this word alone (the prefix that full
containment makes necessary) is joined. Position and length then bound where the window would lie, and its words are
compared in place. All steps are DataFrame operations; documents are never shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import ascii_lower, cut

WINDOW = 10
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 32 << 20  # windows are joined in blocks of about this size, one pass over the documents each


def words_of(text: Column) -> Column:
    """A-Z in lower case, then the runs of characters other than ASCII signs; no words for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """words (array) and items (sorted ids as text) of each distinct window of the items (item_id, text).

    An item of fewer words than `window`, but not none, is one window. A null item_id counts as an empty id.
    """
    words, n = F.col("words"), F.size("words")
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))
    cuts = items.filter(n > 0).select("item", "words", F.explode(starts).alias("at"))
    parts = cuts.select("item", F.slice(words, F.col("at"), F.lit(window)).alias("words"))
    return parts.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, mark (xxhash64 of the text), start, length and items of each place where a window of words occurs."""
    windows = cut(item_windows(benchmark, window), "windows")
    size = windows.agg(F.sum(F.octet_length(F.array_join("words", " ")) + 64 + 32 * F.size("items"))).first()[0]
    blocks = max(1, math.ceil((size or 0) / BROADCAST_BYTES))

    # how often the words of the windows occur in the documents, in blocks of words; words never met count as rarest
    spread = windows.select("words", "items", F.posexplode("words").alias("offset", "word"))
    vocabulary = spread.select("word").distinct()
    shown = docs.select(F.explode(words_of(F.col("text"))).alias("word"))
    counts = [
        shown.join(F.broadcast(vocabulary.filter(_block(F.col("word"), blocks) == b)), "word", "left_semi")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        for b in range(blocks)]
    rarity = cut(reduce(DataFrame.unionByName, counts), "rarity")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset"))
    ordered = spread.join(rarity, "word", "left").groupBy("words").agg(
        rarest.alias("rarest"), F.first("items").alias("items"))
    prefixes = cut(ordered.select(
        "words", "items", F.col("rarest.word").alias("word"), F.col("rarest.offset").alias("offset"),
        F.size("words").alias("length")), "prefixes")

    text = docs.select("doc_id", F.xxhash64("text").alias("mark"), words_of(F.col("text")).alias("own"))
    placed = text.select("doc_id", "mark", "own", F.posexplode("own").alias("pos", "word"))
    start = F.col("pos") - F.col("offset")
    hits = []
    for b in range(blocks):
        near = F.broadcast(prefixes.filter(_block(F.col("words"), blocks) == b))
        met = placed.join(near, "word").filter((start >= 0) & (start + F.col("length") <= F.size("own")))
        met = met.filter(F.slice("own", start + 1, F.col("length")) == F.col("words"))
        hits.append(met.select("doc_id", "mark", start.alias("start"), "length", "items"))
    return cut(reduce(DataFrame.unionByName, hits).distinct(), "hits")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and mark (xxhash64 of the text) of the documents with a window of a benchmark item, each once."""
    return occurrences(docs, benchmark, window).select("doc_id", "mark").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of `docs` (doc_id, text).

    n_hit counts words inside any occurrence of a window, n_items the items with such windows, items_sha256 is over
    their ids, sorted as text and joined by commas. Null and empty texts have no words and no hits. Rows that repeat
    get a row each, and a doc_id with several texts the result of each. Columns of other names are ignored. An empty
    benchmark hits nothing.
    """
    found = occurrences(docs, benchmark, window)
    last = F.col("start") + F.col("length") - 1
    covered = (
        found.select("doc_id", "mark", F.explode(F.sequence("start", last)).alias("pos")).distinct()
        .groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("n_hit")))
    items = (
        found.select("doc_id", "mark", F.explode("items").alias("item")).distinct()
        .groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("item")).alias("names")))
    both = F.col("key").eqNullSafe(F.col("doc_id")) & (F.col("key_mark") == F.col("mark"))
    summary = covered.withColumnsRenamed({"doc_id": "key", "mark": "key_mark"}).join(items, both).select(
        "key", "key_mark", "n_hit", "names")
    every = docs.select(
        "doc_id", F.xxhash64("text").alias("mark"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("key_mark"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return every.join(summary, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("names", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))
