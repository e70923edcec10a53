"""Spelling variants: frequent words that one edit parts, found by a join of asymmetric chunks, and their main forms.

Of two words within one edit the shorter (or either, if equally long) gives two disjoint chunks, its halves; the other
gives its grams of those lengths by position. One edit spoils at most one half, so that the other half is a gram of the
longer word, at a place shifted by no more than the one code point by which the lengths differ. An equality join on
(length, half, gram) therefore finds every pair; Levenshtein distances settle which of them are near.

A half that many words share is not compared pair by pair: its words are parted by halves of what is left of them, and
so on, until few meet. Where only one code point is left, all that meet are near. A word has at most as many rows as
code points. All of it is expressions and joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import ascii_lower, cut, lean_shuffles

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 6  # two chunks of three code points
LEAST_COUNT = 5
RATIO = 5         # a form is at least so many times as frequent as its variant
FEW = 1024        # comparisons of a chunk that are made at once; beyond them it is split by further chunks


def drop_letter(doc: Column, word: Column, every: int) -> Column:
    """The word without one code point in one of `every` cases, told by crc32 of `<doc>:<word>`; null doc is empty."""
    told = F.crc32(F.concat(F.coalesce(doc.cast("string"), F.lit("")), F.lit(":"), word))
    place = F.pmod(told, F.length(word)).cast("int")
    rest = F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))
    return F.when(told % every == 0, rest).otherwise(word)


def word_counts(docs: DataFrame, damage_every: int | None = None) -> DataFrame:
    """word and n of the words of at least six code points that occur five times in `docs` (doc_id, text).

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts, A-Z in lower case. Null and empty
    texts have none; rows that repeat count each; other columns are ignored. With `damage_every`, words lose a code
    point as `drop_letter` says before they are counted.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("word")).select("doc_id", ascii_lower(F.col("word")).alias("word"))
    if damage_every:
        found = found.select(drop_letter(F.col("doc_id"), F.col("word"), damage_every).alias("word"))
        found = found.filter(F.length("word") >= LEAST_LENGTH)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _chunks(rows: DataFrame) -> DataFrame:
    """Each row twice: by the front and by the back half of its open part [low, high), which leaves the other half open.

    `more` is by how many code points the longer word is longer, `shift` the same on the longer word's rows, 0 on
    others. An open part of one code point has no halves: it stands before or behind the inserted one.
    """
    one = F.col("high") - F.col("low") == 1
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    end, begin = F.when(one, F.col("high")).otherwise(middle), F.when(one, F.col("low")).otherwise(middle)
    front = F.substring(F.col("word"), F.col("low") + 1, end - F.col("low"))
    back = F.substring(F.col("word"), begin + F.col("shift") + 1, F.col("high") - begin)
    halves = F.array(
        F.struct(F.lit(0).alias("half"), front.alias("gram"), end.alias("low"), F.col("high").alias("high")),
        F.struct(F.lit(1).alias("half"), back.alias("gram"), F.col("low").alias("low"), begin.alias("high")))
    rows = rows.select("word", "n", "long", "more", "shift", "key", F.explode(halves).alias("h"))
    return rows.select("word", "n", "long", "more", "shift", F.xxhash64("key", "h.half", "h.gram").alias("key"),
                       "h.low", "h.high")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: every two of the given words (word, n) that one inserted, deleted or replaced code point
    parts, in both directions.

    Words are distinct and have two code points at least; null is no word.
    """
    size = F.length("word")
    side = words.filter("word IS NOT NULL").select(
        "word", "n", size.alias("size"), F.explode(F.array(F.lit(0), F.lit(1))).alias("more"), F.lit(0).alias("low"))
    giving = side.select("*", F.lit(False).alias("long"), F.lit(0).alias("shift"), F.col("size").alias("high"))
    taking = side.select("*", F.lit(True).alias("long"), F.col("more").alias("shift"),
                         (F.col("size") - F.col("more")).alias("high"))
    level = giving.unionByName(taking).withColumn("key", F.xxhash64("more", "high"))
    found: list[DataFrame] = []
    while True:
        level = cut(_chunks(level), "chunks")
        work = F.count_if("long") * F.count_if(~F.col("long"))
        met = level.groupBy("key", "more").agg(work.alias("work")).drop("more")
        # words of one length are on both sides, so that one of them alone meets itself
        rows = cut(level.join(met, "key").filter((F.col("work") > 1) | (F.col("work") == F.col("more"))), "met")
        last = F.col("high") - F.col("low") <= 1 - F.col("more")
        ready = rows.filter((F.col("work") <= FEW) | last)
        givers = ready.filter(~F.col("long")).select("key", "more", "word", "n")
        takers = ready.filter("long").select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
        once = (F.col("more") == 1) | (F.col("word") < F.col("other"))
        pairs = givers.join(takers, "key").filter(once & (F.levenshtein("word", "other", 1) == 1))
        found.append(pairs.select("word", "n", "other", "other_n"))
        level = rows.filter((F.col("work") > FEW) & ~last).drop("work")
        if level.isEmpty():
            break
    pairs = reduce(DataFrame.unionByName, found).distinct()
    return pairs.unionByName(pairs.select(
        F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where following `forms` (word, form) from each word ends. Each round doubles the steps."""
    reached = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = cut(reached.join(beyond, "root", "left").select("word", "root", "further"), "roots")
        reached = step.select("word", F.coalesce("further", "root").alias("root"))
        if step.filter("further IS NOT NULL").isEmpty():
            return reached


def group_spellings(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every given word (word, n).

    form is the most frequent of the near words (ties: the least in code-point order), if it is five times as frequent
    at least, else null; form_n its n; root the word at the end of the forms, from a word without form itself; n_near
    the number of near words. An empty table gives an empty one.
    """
    lean_shuffles(words.sparkSession)
    words = cut(words, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("rank"), F.col("other").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own"), best.alias("best"))
    fits = -F.col("best.rank") >= RATIO * F.col("own")
    near = cut(near.select("word", "n_near", F.when(fits, F.col("best.form")).alias("form"),
                           F.when(fits, -F.col("best.rank")).alias("form_n")), "near")
    ends = roots(near.filter("form IS NOT NULL"))
    out = words.join(near, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), F.col("n").cast("long").alias("n"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("form_n").cast("long").alias("form_n"))
