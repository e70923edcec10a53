import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import bwt, chosen_path, decontaminate, language, licenses, queries, suffix_dedup
from tablewright.llm.common import utf8
from tablewright.llm.components import components, forest
from tablewright.llm.shingles import shingle_hashes, word_hashes

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# columns that clash with names the operators use inside
CLASHES = "mark string, class string, words string, spans string, n_hit int, path string, n long, digest string"


def brute_words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"W{rng.randrange(vocabulary)}"
                    for _ in range(n)) + "."


def corpus(seed):
    """Texts with copies, near copies, shared passages, periodic, short, empty, null and very long ones; a repeated row."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    texts += [texts[0], texts[0], texts[1], None, None, "", "", "?!", "one", "two words", "two words"]
    passage = prose(rng, 60)
    texts += [prose(rng, 5) + passage + prose(rng, 20) for _ in range(6)]
    base = prose(rng, 150).split(" ")
    for _ in range(8):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = "edit"
        texts.append(" ".join(copy))
    texts += ["ab" * 400, "x" * 1000, "line of text\n" * 60, prose(rng, 60_000, 5000)]
    rows = list(enumerate(texts))
    return [*rows, rows[3], (5, "another text under the id five"), (None, "no id")]


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    extra = [F.lit(None).cast(kind).alias(name) for name, kind in (c.split(" ") for c in CLASHES.split(", "))]
    return docs.select("*", *extra)


def test_utf8_of_slices_and_nulls():
    array = pa.array(["é", None, "ab", ""])
    data, bounds = utf8(array.slice(1, 3))
    assert data.tobytes() == b"ab" and bounds.tolist() == [0, 0, 2, 2]
    assert utf8(pa.array([], pa.string()))[1].tolist() == [0]


def test_words_across_spans(monkeypatch):
    import tablewright.llm.shingles as sh

    rng = random.Random(3)
    texts = [prose(rng, 50), "", "é" * 500, "a b", "?"] * 3
    whole, counts = word_hashes(*utf8(pa.array(texts)))
    monkeypatch.setattr(sh, "SPAN", 7)
    small, again = word_hashes(*utf8(pa.array(texts)))
    assert (whole == small).all() and counts.tolist() == again.tolist()
    assert counts.tolist() == [len(brute_words(t)) for t in texts]
    assert word_hashes(*utf8(pa.array(["ABC", "abc"])))[0].tolist()[0] == whole.dtype.type(
        word_hashes(*utf8(pa.array(["abc"])))[0][0])


def test_shingles_of_short_texts():
    hashes, counts = shingle_hashes(*utf8(pa.array(["a b", "a b c d e f", "", "a b"])))
    assert counts.tolist() == [1, 2, 0, 1] and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3


def test_decontamination_is_exact(spark):
    rng = random.Random(1)
    rows = corpus(1)
    items = [(1, " ".join(rows[7][1].split(" ")[:14]).upper()), (2, "two, words"), (3, prose(rng, 30)), (4, None), (5, "--"),
             (6, prose(rng, 12)), (6, rows[9][1]), (10, "two-words"), (None, rows[9][1])]
    rows += [(900, "x y " + items[5][1] + " " + items[5][1]), (901, "so " * 5000 + items[2][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    got = decontaminate.decontaminate(frame(spark, rows), benchmark).collect()

    windows = defaultdict(set)
    for item, text in items:
        words = brute_words(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i:i + 10])].add("" if item is None else str(item))
    want = []
    for doc, text in rows:
        words, hit, found = brute_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(words[i:i + size])]
        names = ",".join(sorted(found))
        want.append((doc, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    assert Counter(map(tuple, got)) == Counter(want)


def test_hits_of_rows_without_id(spark):
    """The same text under an id, under none, and under none twice; another text without id."""
    rng = random.Random(12)
    item, other = prose(rng, 12), prose(rng, 14)
    rows = [(1, "x " + item), (None, "x " + item), (None, "x " + item), (None, other + " y " + item), (None, "clean"), (None, None)]
    benchmark = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, rows), benchmark).collect()
    assert Counter((r.doc_id, r.n_hit, r.n_items, r.contaminated) for r in got) == Counter(
        {(1, 12, 1, True): 1, (None, 12, 1, True): 2, (None, 26, 2, True): 1, (None, 0, 0, False): 2})


def test_decontamination_in_blocks(spark, monkeypatch):
    rows = corpus(2)
    benchmark = spark.createDataFrame([(i, rows[i][1]) for i in range(4)], "item_id long, text string")
    once = decontaminate.decontaminate(frame(spark, rows), benchmark).collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 20_000)
    assert Counter(map(tuple, decontaminate.decontaminate(frame(spark, rows), benchmark).collect())) == Counter(map(tuple, once))
    assert any(r.contaminated for r in once)


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, "a b")])
    assert [tuple(r)[:4] for r in decontaminate.decontaminate(docs, none).collect()] == [(1, 2, 0, 0)]
    assert decontaminate.decontaminate(docs.limit(0), none).collect() == []


def brute_repeats(texts, size=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + size] for b in data for i in range(len(b) - size + 1))
    for b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i] += 1
                gone[i + size] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        yield len(b), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("crowd", [0, 512])
def test_repeats_are_exact(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = corpus(4)
    got = suffix_dedup.digests(suffix_dedup.remove_repeats(frame(spark, rows))).collect()
    want = Counter((d, *x) for (d, _), x in zip(rows, brute_repeats([t for _, t in rows])))
    assert Counter(map(tuple, got)) == want
    assert sum(r.n_removed for r in got) > 5000 and any(r.n_removed == 0 for r in got)


def test_repeats_keep_columns_and_whole_characters(spark):
    passage = "ä" * 150
    docs = spark.createDataFrame([(1, "é" + passage, 7), (2, "è" + passage, 8), (3, None, 9)], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, as_text=True).collect()}
    # é and è share their first byte with each other and with ä: only their second bytes differ
    assert got[1].n_bytes == 302 and got[1].n_removed == 300 and got[1].kept == "é" and got[3].kept == ""
    assert suffix_dedup.remove_repeats(docs.limit(0)).collect() == []


def test_segments_do_not_depend_on_spans(monkeypatch):
    rng = random.Random(8)
    data, bounds = utf8(pa.array([prose(rng, 300), "short", prose(rng, 200)]))
    whole = suffix_dedup.segments(data, bounds)
    starts, windows = whole[1], whole[2]
    for i, size in enumerate(np.diff(bounds)):
        own = np.sort(np.concatenate([np.arange(s, s + n) for o, s, n in zip(whole[0], starts, windows) if o == i] or [np.zeros(0, int)]))
        assert own.tolist() == list(range(max(0, size - 199)))


def test_merged_transforms_against_counts():
    rng = random.Random(5)
    for _ in range(60):
        size, letters = rng.choice([8, 16, 40]), rng.choice([b"ab", b"abcdef\xff\x00"])
        base = bytes(rng.choice(letters) for _ in range(120))
        strings = []
        for _ in range(rng.randint(1, 12)):
            at = rng.randint(0, 80)
            strings.append(base[at:at + rng.randint(1, 60)])
        found = suffix_dedup.repeated_windows(strings, size, rng.randint(1, 4))
        count = Counter(s[i:i + size] for s in strings for i in range(len(s) - size + 1))
        for s, flags in zip(strings, found):
            assert flags.tolist() == [count[s[i:i + size]] > 1 for i in range(len(s) - size + 1)]


def test_merge_orders_and_common_bytes():
    strings = [b"banana bandana", b"bananas and", b"anna"]
    order, common = bwt.merge([bwt.build_shard([s], 16) for s in strings], 16)
    circles = [s + b"\xff" for s in strings]
    turned = [(c * 8)[i:i + 16] for c in circles for i in range(len(c))]
    placed = [turned[k] for k in order]
    assert placed == sorted(turned)
    for a, b, shared in zip(placed, placed[1:], common):
        exact = next((k for k in range(16) if a[k] != b[k]), 16)
        assert shared == exact // bwt.STEP * bwt.STEP


def brute_join(rows):
    sets = []
    for _, text in rows:
        words = brute_words(text)
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    group, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                group[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], links, sets


def test_similarity_join_is_exact(spark):
    rows = [r for r in corpus(6) if r[0] is not None]
    got = chosen_path.similarity_join(frame(spark, rows)).collect()
    group, links, sets = brute_join(rows)
    least = {}
    for (doc, _), g in zip(rows, group):
        least[g] = min(doc, least.get(g, doc))
    first = {}
    for (doc, _), s in zip(rows, sets):
        first[s] = min(doc, first.get(s, doc))
    want = Counter((d, first[s] if s else d, least[g] if s else d, n) for (d, _), g, n, s in zip(rows, group, links, sets))
    assert Counter((r.doc_id, r.class_id, r.group_id, r.n_links) for r in got) == want
    assert max(links) > 5 and all(r.kept == (r.doc_id == r.group_id) for r in got if r.doc_id != 5)


def test_similarity_join_of_rows_without_id(spark):
    rows = corpus(6)
    base = next(t for d, t in rows if d == 45)
    rows += [(None, base), (None, base), (None, base + " one more"), (None, rows[0][1]), (45, base)]
    got = chosen_path.similarity_join(frame(spark, rows)).collect()
    group, links, sets = brute_join(rows)
    low = [(-1 if d is None else d) for d, _ in rows]  # null comes first
    least, first = {}, {}
    for d, g, s in zip(low, group, sets):
        least[g], first[s] = min(d, least.get(g, d)), min(d, first.get(s, d))
    want = Counter((d, first[s] if s else d, least[g] if s else d, n) for d, g, n, s in zip(low, group, links, sets))
    assert Counter(tuple(-1 if x is None else x for x in (r.doc_id, r.class_id, r.group_id)) + (r.n_links,) for r in got) == want
    assert sum(n for (d, _), n in zip(rows, links) if d is None) > 10


def near_copies(rng, n, base, edits=1):
    """Texts that differ from a base text in a few words each."""
    out = []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(len(copy)), edits):
            copy[at] = f"edit{i}x{at}"
        out.append(" ".join(copy))
    return out


def test_similarity_join_splits_large_buckets(spark, monkeypatch):
    rng = random.Random(11)
    rows = list(enumerate(near_copies(rng, 60, prose(rng, 120).split(" "))))
    rows += [(100 + i, prose(rng, 90)) for i in range(20)]
    for name, value in (("LIMIT", 8), ("BLOCK_SHINGLES", 900), ("BLOCK_SETS", 7), ("CHUNK_SETS", 3), ("MOST_SETS", 20)):
        monkeypatch.setattr(chosen_path, name, value)
    got = {r.doc_id: r for r in chosen_path.similarity_join(frame(spark, rows)).collect()}
    group, links, _ = brute_join(rows)
    assert [got[d].n_links for d, _ in rows] == links and max(links) >= 50
    assert sum(r.kept for r in got.values()) == len(set(group))


def test_recall_among_texts_that_share_half(spark, monkeypatch):
    """Pairs at the bound inside buckets that hold hundreds of texts with a long common passage, split again and again."""
    monkeypatch.setattr(chosen_path, "LIMIT", 12)
    rng = random.Random(13)
    passage = prose(rng, 100, 5000)
    rows = []
    for i in range(120):
        own = (passage + " " + prose(rng, 100, 5000)).split(" ")
        rows += [(10 * i + k, t) for k, t in enumerate([" ".join(own), *near_copies(rng, 2, own, 3)])]
    got = {r.doc_id: r for r in chosen_path.similarity_join(frame(spark, rows)).collect()}
    group, links, _ = brute_join(rows)
    found = sum(got[d].n_links for d, _ in rows)
    assert 0.999 * sum(links) <= found <= sum(links) and sum(links) > 400
    assert all(got[d].n_links <= n for (d, _), n in zip(rows, links))


@pytest.mark.parametrize("kind, sizes", [("copies", (500, 1000, 2000)), ("half", (500, 1000))])
def test_rows_of_hot_groups_grow_in_proportion(spark, monkeypatch, kind, sizes):
    """Rows that buckets are split into: near copies just below the bound, and texts that share half of their words."""
    made = {}
    real = chosen_path.cut
    monkeypatch.setattr(chosen_path, "LIMIT", 32)
    monkeypatch.setattr(chosen_path, "BLOCK_SETS", 64)
    for n in sizes:
        rng, counts = random.Random(14), Counter()

        def counting(df, label):
            out = real(df, label)
            counts[label] += out.count()
            return out

        monkeypatch.setattr(chosen_path, "cut", counting)
        base = prose(rng, 60, 5000)
        texts = near_copies(rng, n, base.split(" ")) if kind == "copies" else [base + " " + prose(rng, 60, 5000) for _ in range(n)]
        chosen_path.similarity_join(frame(spark, list(enumerate(texts)))).count()
        made[n] = counts["paths"] + counts["settled"] + counts["mixed"]
    assert made[sizes[-1]] < 1.6 * made[sizes[0]] * sizes[-1] / sizes[0]


def test_similarity_join_of_nothing(spark):
    assert chosen_path.similarity_join(frame(spark, [(1, "a")]).limit(0)).collect() == []
    rows = chosen_path.similarity_join(frame(spark, [(1, None), (2, ""), (None, "a b")])).collect()
    assert sorted((r.doc_id or 0, r.n_links, r.kept) for r in rows) == [(0, 0, True), (1, 0, True), (2, 0, True)]


def test_components_of_paths_and_stars(spark):
    pairs = [(f"p{i:03}", f"p{i + 1:03}") for i in range(150)] + [("s", f"s{i}") for i in range(50)] + [("z", "z")]
    found = components(spark.createDataFrame(pairs, "a string, b string")).collect()
    assert len(found) == 202 and len({r.root for r in found if r.id[0] == "p"}) == 1 and len({r.root for r in found}) == 2
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []
    assert forest(5, np.array([0, 3]), np.array([2, 4])).tolist() == [0, 1, 0, 3, 3]


def brute_phrases(sample, text):
    count = at = 0
    while at < len(text):
        end = at
        while end < len(text) and text[at:end + 1] in sample:
            end += 1
        count, at = count + 1, max(end, at + 1)
    return count


def test_cross_parsing_against_substring_search(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(language, "STRETCH", 50)
    samples = {"a": "\n".join("".join(rng.choice("abc ") for _ in range(60)) for _ in range(4)), "b": "abd abd\nxyz"}
    model = language.LanguageModel(tuple(sorted((k, language.fold_codes(v.split("\n")[0]).tobytes().decode("utf-32-le")
                                                 + "\n" + v.split("\n")[-1].strip()) for k, v in samples.items())))
    texts = ["".join(rng.choice("abcdxQ, ") for _ in range(rng.randrange(200))) for _ in range(30)] + [None, "", "12", "日本"]
    totals, count, has = language.Parser(model).phrases(pa.array(texts))
    for i, text in enumerate(texts):
        folded = language.fold_codes(text or "").tobytes().decode("utf-32-le")
        assert count[i] == len(folded) and has[i] == any(c.isalpha() for c in text or "")
        for k, (_, sample) in enumerate(model.samples):
            parts = [folded[j:j + 50] for j in range(0, len(folded), 50)]
            lines = sample.split("\n")
            wanted = sum(brute_phrases_lines(lines, p) for p in parts)
            assert totals[k, i] == wanted


def brute_phrases_lines(lines, text):
    count = at = 0
    while at < len(text):
        end = at
        while end < len(text) and any(text[at:end + 1] in line for line in lines):
            end += 1
        count, at = count + 1, max(end, at + 1)
    return count


def test_language_of_held_out_texts(spark):
    rng = random.Random(4)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["str", "eng", "isch"], "cc": ["ña", "que", "ció"]}
    rows = [(i, "".join(rng.choice(parts[x]) + (" " if rng.random() < 0.3 else "") for _ in range(40)), x)
            for i, x in enumerate(rng.choices(list(parts), [8, 1, 1], k=400))]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "12 !", "bb"), (503, "kalomi", None), (503, "kalomi", None), (None, "streng", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    marked = language.with_hold_out(docs)
    model = language.fit(marked.filter("NOT held_out"), rows=8)
    assert [x for x, _ in model.samples] == ["aa", "bb", "cc"] and all(len(t.split("\n")) == 8 for _, t in model.samples)
    got = language.identify(marked, model).collect()
    assert len(got) == len(rows) and set(got[0].asDict()) == {"doc_id", "text", "lang", "held_out", "lang_pred", "score"}
    assert all(r.lang_pred == r.lang for r in got if r.doc_id is not None and r.doc_id < 500)
    assert {(r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id in (500, 501, 502)} == {(i, "und", 0.0) for i in (500, 501, 502)}
    assert all(0 <= r.score <= 1 for r in got) and any(r.held_out for r in got)
    empty = language.fit(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def related_languages():
    """A maker of texts in either of two languages that share letters and most of their syllables."""
    rng = random.Random(9)
    shared = ["".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(2)) for _ in range(40)]
    words = {x: shared + ["".join(rng.choice("bdklmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)] for x in "ab"}
    return lambda x, size: " ".join(rng.choice(words[x]) for _ in range(size // 5))[:size]


@pytest.mark.parametrize("few", [1, 3, 8])
def test_languages_with_few_rows_are_found(few):
    make = related_languages()
    samples = {x: "\n".join(make(x, 256) for _ in range(n)) for x, n in (("a", 64), ("b", few))}
    parser = language.Parser(language.LanguageModel(tuple(samples.items())))
    for k, x in enumerate("ab"):
        totals, _, _ = parser.phrases(pa.array([make(x, 400) for _ in range(100)]))
        assert ((totals * parser.costs[:, None]).argmin(axis=0) == k).mean() >= 0.95
    if few < 8:
        assert (totals.argmin(axis=0) == 1).mean() < 0.95  # what counts alone would find


def test_samples_of_a_letter_do_not_win():
    make = related_languages()
    parser = language.Parser(language.LanguageModel((("a", "\n".join(make("a", 256) for _ in range(64))), ("b", "k"))))
    totals, _, _ = parser.phrases(pa.array([make("a", 400) for _ in range(50)]))
    assert ((totals * parser.costs[:, None]).argmin(axis=0) == 0).all()


def test_samples_hold_letters_and_stay_few(spark, monkeypatch):
    rows = [(i, f"{i} 12 !", "zxx") for i in range(2000)] + [(i, f"{i} abc", "zxx") for i in range(3)]
    rows += [(i, f"kalo {i}", "aa") for i in range(400)] + [(i, "99", "nn") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    read = []
    collect = type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: read.append(collect(self)) or read[-1])
    model = language.fit(docs, rows=8)
    assert [(x, len(t.split("\n"))) for x, t in model.samples] == [("aa", 8), ("zxx", 3)]
    assert max(map(len, read)) <= 2 * 8


def test_licenses_fold_and_match_whole_units(spark):
    known = licenses.known_digests(spark)
    mit = dict(licenses.KNOWN)["MIT"] and licenses.KNOWN[0][1]
    rows = [
        (1, "Copyright (c) 2021 A. Person\n\n" + mit.upper().replace('"', "“").replace(",", " , ")),
        (2, "© 2020 Someone\nAll rights reserved.\n" + mit.replace("sublicense", "sub-licence")),
        (3, mit + " And more."), (4, None), (5, ""), (6, "some words\n  released UNDER the MIT licence!\nmore\nLicensed under CC BY-NC 4.0"),
        (6, "some words\n  released UNDER the MIT licence!\nmore\nLicensed under CC BY-NC 4.0"), (7, "We were released under the MIT License."),
        (8, "Released under the MIT License.\n" * 3), (8, "other")]
    got = sorted(map(tuple, licenses.scan_licenses(frame(spark, rows), known).drop("digest").collect()), key=str)
    assert got == sorted([
        (1, "MIT", 3, 0, ""), (2, "MIT", 3, 0, ""), (3, None, 3, 0, ""), (4, None, 0, 0, ""), (5, None, 0, 0, ""),
        (6, None, 4, 2, "CC-BY-NC-4.0,MIT"), (6, None, 4, 2, "CC-BY-NC-4.0,MIT"), (7, None, 1, 0, ""),
        (8, None, 3, 3, "MIT"), (8, None, 1, 0, "")], key=str)
    assert licenses.scan_licenses(frame(spark, rows).limit(0), known).collect() == []
    own = licenses.known_digests(spark, [("B", "x y"), ("A", "X, Y"), ("C", "")])
    assert [tuple(r)[1:] for r in own.collect()] == [("A",)]


HEADS = ["Copyright © 2024 Jane Doe", "Copyright (c) Microsoft Corporation.", "Copyright The Foo Authors", "© Copyright 2019, X",
         "(c) Copyright Foo GmbH", "Copyright Foo Inc. 2020. All rights reserved.", "Copyright Jane Doe 2020",
         "Copyright by Jane Doe 2020", "(c) Jane Doe 2020", "Portions Copyright (c) 2020 X", "SPDX-FileCopyrightText: 2020 Jane",
         "SPDX-FileCopyrightText: Jane", "All rights reserved."]
PROSE = ["Copyright notice, this list of conditions and the authors", "copyright holders and contributors", "C code is compiled",
         "Copyright law in 2020", "copyright (c) notice of the team", "Copyright is held by the authors", "c 2020 is the standard",
         "Copyright (c) 2020 X. All rights reserved. You may copy this freely under terms", "Copyright by Jane",
         "(c) 2020 X, licensed under other terms"]


def test_licenses_below_any_copyright_notice(spark):
    known, mit = licenses.known_digests(spark), licenses.KNOWN[0][1]
    rows = list(enumerate([h + "\n\n" + mit for h in HEADS + PROSE]))
    got = {r.doc_id: (r.license_id, r.n_lines) for r in licenses.scan_licenses(frame(spark, rows), known).collect()}
    assert [got[i] for i in range(len(HEADS))] == [("MIT", 3)] * len(HEADS)
    assert [got[len(HEADS) + i] for i in range(len(PROSE))] == [(None, 4)] * len(PROSE)


def test_license_sql_has_the_same_rule(spark):
    mit = licenses.KNOWN[0][1]
    rows = [(i, h + "\n" + mit) for i, h in enumerate(HEADS + PROSE)] + [(90, "c " * 4000), (91, None), (92, "")]
    got = sorted(map(tuple, licenses.scan_licenses(frame(spark, rows), licenses.known_digests(spark)).select(
        "doc_id", "digest", "license_id", "n_lines", "n_notices", "notices").collect()))
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(db.execute(queries.ORACLES["op1_license_scan"]).fetchall()) == got


@pytest.mark.parametrize("text", ["c " * 4000, "copyright c " * 200_000, "c 2020 " * 200_000, "(c) " + "x" * 1_000_000 + " 2020",
                                  "copyright " + "foo authors " * 100_000, "\n".join(["c"] * 300_000)])
def test_licenses_of_very_long_texts(spark, text):
    got = licenses.scan_licenses(frame(spark, [(1, text), (2, licenses.KNOWN[0][1])]), licenses.known_digests(spark))
    assert {r.doc_id: r.license_id for r in got.collect()} == {1: None, 2: "MIT"}


def test_complete_license_texts_are_known(spark):
    folder = "/usr/share/common-licenses"
    if not os.path.isdir(folder):
        pytest.skip("no license texts on this machine")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    rows = [(i, open(f"{folder}/{f}", encoding="utf-8").read().upper()) for i, f in enumerate(names.values())]
    got = licenses.scan_licenses(frame(spark, rows), licenses.known_digests(spark)).collect()
    assert {r.doc_id: r.license_id for r in got} == dict(enumerate(names))
