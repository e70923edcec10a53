"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from tablewright.llm import queries, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, every):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def grouped(spark, rows, every=None, extra=False):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if extra:
        for name in ("word", "n", "key", "form", "root"):
            docs = docs.withColumn(name, F.lit("clash"))
    return sorted(tuple(r) for r in spelling.group_spellings(spelling.word_counts(docs, every)).collect())


def vocabulary(seed, n):
    """Words of a small alphabet with variants, of any length from five."""
    rng = random.Random(seed)
    words = []
    while len(words) < n:
        word = "".join(rng.choice("abéß") for _ in range(rng.randint(5, 12)))
        words.append(word)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(word))
            words.append(rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abÿ") + word[at:],
                                     word[:at] + rng.choice("abÿ") + word[at + 1:]]))
    return words


def test_against_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    words = vocabulary(4, 300)
    texts = [rng.choices(words, k=200) for _ in range(60)] + [[w] * rng.choice([5, 30, 160]) for w in words]
    rows = [(i if i % 9 else None, " ".join(t).title() if i % 4 else "-".join(t)) for i, t in enumerate(texts)]
    rows += [(1, None), (2, ""), (3, "12 34"), *rows[:20]]
    want = brute(rows, 7)
    assert len(want) > 200 and any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)
    assert grouped(spark, rows, 7, extra=True) == want
    monkeypatch.setattr(spelling, "FEW", 2)  # every chunk that words share is split to the end
    assert grouped(spark, rows, 7) == want


def test_a_half_that_all_words_share_is_split(spark, monkeypatch):
    """3,000 words begin alike, 3,000 end alike: comparisons stay near the number of words."""
    rng = random.Random(5)
    tails = {"".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(3000)}
    words = sorted({"prefix" + t for t in tails} | {t + "suffix" for t in tails})
    frame = spark.createDataFrame([(w, 5 + i % 50) for i, w in enumerate(words)], "word string, n long")
    compared = spark.sparkContext.accumulator(0)
    real = F.levenshtein

    def counting(a, b, limit):
        seen = F.udf(lambda: compared.add(1) or True, "boolean").asNondeterministic()
        return F.when(seen(), real(a, b, limit))

    want = sum(len(x) for x in brute_neighbours(words).values())
    assert spelling.near_pairs(frame).count() == want
    monkeypatch.setattr(F, "levenshtein", counting)
    assert spelling.near_pairs(frame).count() == want
    assert compared.value < 60 * len(words)  # all pairs would be 3,000 times that number


def brute_neighbours(words):
    by_gap = {}
    for w in words:
        for i in range(len(w)):
            by_gap.setdefault((i, w[:i] + w[i + 1:]), []).append(w)
    known, out = set(words), {w: set() for w in words}
    for same in by_gap.values():
        for w in same:
            out[w] |= set(same) - {w}
    for (_, short), longer in by_gap.items():
        if short in known:
            out[short] |= set(longer)
            for w in longer:
                out[w].add(short)
    return out


def test_chains_lead_to_the_root(spark):
    words = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("zzzzzz", 7)]
    got = spelling.group_spellings(spark.createDataFrame(words, "word string, n long")).collect()
    assert {r.word: r.root for r in got} == {w: "aabbbb" if w[0] == "a" else w for w, _ in words}
    assert {r.word: r.n_near for r in got} == {"aaaaaa": 1, "aaaaab": 2, "aaaabb": 2, "aaabbb": 2, "aabbbb": 1, "zzzzzz": 0}


def test_ties_long_words_and_empty_tables(spark):
    long = "ab" * 20_000
    rows = [(1, " ".join(["letter", "lettes", "lettex"] * 5 + ["lettea"] * 25 + ["letteb"] * 25 + [long, long + "c"] * 5))]
    want = brute(rows, None)
    assert grouped(spark, rows) == want and ("letter", "lettea", "lettea", 5, 4, 25) in want
    assert grouped(spark, []) == [] and grouped(spark, [(1, None), (None, "")]) == []


def test_query_against_its_sql(spark, tmp_path):
    rng = random.Random(9)
    words = vocabulary(10, 400)
    rows = [(i if i % 7 else None, " ".join(rng.choices(words, k=150))) for i in range(80)] + [(1, None), (2, ""), (3, "× ÷ ×÷abcdef")] * 6
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_spelling_variants(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = f"SELECT word, form, root, n, n_near, form_n FROM ({queries.ORACLES['op13_spelling_variants']})"
    want = sorted(db.execute(sql).fetchall(), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want == sorted(brute(rows, queries.DAMAGED_WORDS), key=str)
    assert len(want) > 100
