import dataclasses
import hashlib
import json
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import pieces_codec as pc
from tablewright.llm import queries, sorted_projections, token_counts, tool_calls, url_filter

MODEL = f"{queries.TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{queries.TOKENIZERS}/byte_bpe_50k.tiktoken"
TEXTS = ["", None, " ", "  two  spaces ", "<s> x </s> <0x0A>", "a\n\tb", "日本語 ▁ x", "🙂🙂\x00", "a" * 3000, "<unk>", "Ünïcode é",
         "plain words, plain words.", "plain words, plain words.", "long text " * 20_000]


def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("ids", F.lit(1))


def test_codec_parity_with_the_model_library(spark):
    assert {tuple(r)[1:] for r in pc.parity(texts(spark), MODEL).collect()} == {(True, True)}


def test_codec_beside_the_model_library(spark):
    rows = pc.encode_and_check(texts(spark), MODEL, with_library=True).collect()
    assert len(rows) == len(TEXTS) and all(r.same_ids and r.n_tokens == len(r.ids) for r in rows)
    assert "same_ids" not in pc.encode_and_check(texts(spark), MODEL).columns


def test_codec_round_trip(spark):
    coded = pc.encode_and_check(texts(spark), MODEL)
    got = {r.doc_id: r for r in coded.collect()}
    # only the text that holds the space marker itself does not come back
    assert {i for i, r in got.items() if not r.round_trip} == {6} and got[0].ids == got[1].ids == []
    assert all(r.n_tokens == len(r.ids) for r in got.values())
    plain = pc.encode(texts(spark), MODEL)
    assert {r.doc_id: r.ids for r in plain.collect()} == {i: r.ids for i, r in got.items()}
    back = {r.doc_id: r.text for r in pc.decode(plain, MODEL).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS) if i != 6)
    odd = spark.createDataFrame([(1, None), (2, [3 + 0xC3]), (3, [0, 1, 2])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pc.decode(odd, MODEL).collect()}[1] == ""
    assert pc.encode_and_check(texts(spark).limit(0), MODEL).collect() == []


def test_texts_put_together_are_those_of_the_tokenizer(monkeypatch):
    """Ids of any kind, also bytes that are no UTF-8, ids beyond the pieces and markers spelled as bytes."""
    import random

    with open(MODEL, "rb") as file:
        serialized = pc.build_tokenizer(pc.parse_model(file.read())).to_str()
    tokenizer = pc._tokenizer(serialized, 2)
    size, draw = tokenizer.get_vocab_size(), random.Random(3)
    odd = [[], [0, 1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [3 + 32, 3 + 32], [3 + 0xE2, 3 + 0x96, 3 + 0x81], [3 + 0xC3, 300, 3 + 0xA9]]
    some = [[draw.randrange(size) for _ in range(draw.randrange(40))] for _ in range(300)]
    bytes_ = [[3 + draw.randrange(256) for _ in range(draw.randrange(6))] for _ in range(300)]
    real = [e.ids for e in tokenizer.encode_batch_fast([t or "" for t in TEXTS], add_special_tokens=False)]
    for lists in (odd, some, bytes_, real, [[]], []):
        assert pc._texts(serialized, 2, lists) == tokenizer.decode_batch(lists, skip_special_tokens=False)
    beyond = [[300, size + 5, 301], [302]]
    assert pc._texts(serialized, 2, beyond) == tokenizer.decode_batch(beyond, skip_special_tokens=False)
    valid, library = [[300, 301], *real], tokenizer.decode_batch([[300, 301], *real], skip_special_tokens=False)

    class Plain:  # texts that are UTF-8 need no call a row
        decode = decode_batch = None

    pc._spellings(serialized, 2)
    monkeypatch.setattr(pc, "_tokenizer", lambda *_: Plain)
    assert pc._texts(serialized, 2, valid) == library


def test_steps_on_spaces_outside_the_tokenizer_give_its_ids():
    """Models that only mark spaces have no normalizer in the tokenizer; models that do more keep theirs."""
    import json

    with open(MODEL, "rb") as file:
        model = pc.parse_model(file.read())
    given = [t or "" for t in TEXTS] + ["▁", " ▁ ", "\u00a0x", "a  b", "<0x20>", "\x00"]
    for prefix, marks in ((True, True), (False, True), (True, False), (False, False)):
        model.dummy_prefix, model.mark_spaces = prefix, marks
        shipped = pc._without_spaces(model)
        assert json.loads(shipped.tokenizer)["normalizer"] == {"type": "Sequence", "normalizers": []}
        whole = pc.build_tokenizer(model).encode_batch_fast(given, add_special_tokens=False)
        assert pc._ids(shipped, 2, given) == [e.ids for e in whole]
    model.trim_spaces = True
    assert pc._without_spaces(model) == pc.Shipped(pc.build_tokenizer(model).to_str())


def _some_texts(seed, n):
    draw = random.Random(seed)
    parts = [" ", "  ", "   ", "▁", "▁▁", "\n", "the", "c", "с", "я", "é", "🙂", "日本", "<0x20>", "<unk>", "\x00", "ing", "x" * 9]
    return ["".join(draw.choices(parts, k=draw.randrange(12))) for _ in range(n)]


def test_ids_of_words_are_those_of_whole_texts(monkeypatch):
    """Runs of spaces, markers in the text, words of one text and of many: the ids are those of the text as a whole."""
    with open(MODEL, "rb") as file:
        model = pc.parse_model(file.read())
    given = TEXTS + _some_texts(5, 3000) + ["▁", " ▁ ", "▁ ", "a  b", " ", "   "]
    plain = [t or "" for t in given]
    pieces = model.pieces
    for run_bytes, prefix, marks, added in (
            (1 << 10, True, True, []), (8, True, True, []), (64, False, True, []), (64, True, False, []),
            (64, True, False, [" ", "  ", " t"]), (8, False, False, [" ", "  ", " t"])):
        monkeypatch.setattr(pc, "RUN_BYTES", run_bytes)
        model.dummy_prefix, model.mark_spaces = prefix, marks
        model.pieces = pieces + [(p, -1.0, pc.NORMAL) for p in added]
        shipped = pc._without_spaces(model)
        assert shipped.by_words == (marks or bool(added))
        whole = pc.build_tokenizer(model).encode_batch_fast(plain, add_special_tokens=False)
        for part in (slice(None), slice(0, 2), slice(0, 0), slice(4, 40)):
            got = pc._encoded(shipped, 2, pa.array(given[part], pa.string()))
            assert got.to_pylist() == [e.ids for e in whole[part]]
    sliced = pa.array(given, pa.string()).slice(14, 500)
    model.dummy_prefix = model.mark_spaces = True
    model.pieces = pieces
    shipped = pc._without_spaces(model)
    assert pc._encoded(shipped, 2, sliced).to_pylist() == pc._ids(shipped, 2, plain[14:514])


def test_models_whose_words_depend_on_each_other_get_whole_texts():
    with open(MODEL, "rb") as file:
        model = pc.parse_model(file.read())
    pieces, shipped = model.pieces, pc._without_spaces(model)
    assert shipped.by_words
    for change in ({"pieces": [*pieces, ("of▁the", -1.0, pc.NORMAL)]}, {"pieces": [*pieces, ("\n▁", -1.0, pc.NORMAL)]},
                   {"pieces": [p for p in pieces if p[0] != "<0x0A>"]}, {"pieces": [p for p in pieces if p[0] != "▁"]},
                   {"byte_fallback": False}, {"kind": pc.UNIGRAM}):
        other = dataclasses.replace(model, **change)
        assert not pc._apart(other, "▁")


def test_words_that_repeat_are_encoded_once(spark, monkeypatch):
    """The library gets each word of a few megabytes of text once, and little text at a time."""
    with open(MODEL, "rb") as file:
        shipped = pc._without_spaces(pc.parse_model(file.read()))
    whole, calls = pc._ids, []
    monkeypatch.setattr(pc, "_ids", lambda shipped, threads, texts: calls.append(texts) or whole(shipped, threads, texts))
    words = [f"w{i}x{i % 7}" for i in range(40_000)]
    given = [" ".join(words[i % 40:i % 40 + 20_000:7]) for i in range(80)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(80)), "text": given})
    coded = list(pc._coded(shipped, 2, iter([batch])))
    assert sum(len(b) for b in coded) == 80
    seen = [sum(map(len, texts)) for texts in calls]
    assert max(seen) <= pc.SLICE_BYTES + 2 * pc.RUN_BYTES
    assert sum(seen) < 0.3 * sum(map(len, given))
    assert coded[0].column("ids").to_pylist() == whole(shipped, 2, given)[:len(coded[0])]


def test_digest_of_ids_is_that_of_the_joined_ids(spark, tmp_path):
    texts(spark).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op2_piece_codec(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS) and {r.n_tokens for r in rows} >= {0, 1}
    assert all(r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in rows)


def test_encoding_takes_short_slices(spark, monkeypatch):
    """What the library holds for a slice is some 80 times its bytes: a thousand texts are not encoded at once."""
    seen = []
    monkeypatch.setattr(pc, "pieces", lambda batches, column, limit: seen.append(limit) or iter(()))
    runs = []
    frame = texts(spark)
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema, *rest: runs.append(run) or self)
    pc.encode(frame, MODEL), pc.encode_and_check(frame, MODEL), pc.parity(frame, MODEL)
    assert [list(run(iter(()))) for run in runs] == [[], [], []] and len(seen) == 3 and max(seen) <= 1 << 17


def _message(*parts):
    out = b""
    for number, value in parts:
        if isinstance(value, int):
            out += bytes([number * 8 % 128 | (128 if number > 15 else 0)]) + (bytes([number >> 4]) if number > 15 else b"")
            out += bytes([value])
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            size, length = len(value), b""
            while True:
                length += bytes([size & 127 | (128 if size > 127 else 0)])
                size >>= 7
                if not size:
                    break
            out += bytes([number << 3 | 2]) + length + value
    return out


@pytest.mark.parametrize("trim", [0, 1])
def test_unigram_models(spark, tmp_path, trim):
    """A model file made here, with unigram scores and byte fallback, held against the model library."""
    rows = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    rows += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    rows += [("▁", -3.0, 1), ("▁ab", -2.5, 1), ("a", -4.0, 1), ("b", -4.25, 1), ("abc", -5.0, 1), ("c", -6.0, 1), ("bc", -4.5, 1)]
    data = b"".join(_message((1, _message((1, p.encode()), (2, s), (3, k)))) for p, s, k in rows)
    data += _message((2, _message((3, 1), (35, 1))))
    data += _message((3, _message((1, b"identity"), (3, 1), (4, trim), (5, 1))))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    model = pc.parse_model(data)
    assert (model.kind, model.byte_fallback, model.trim_spaces, len(model.pieces)) == (pc.UNIGRAM, True, bool(trim), len(rows))
    docs = spark.createDataFrame(list(enumerate(["ab abc", "cab  bca", "  é ab ", "", None, "abcabc" * 50])), "doc_id long, text string")
    assert {tuple(r)[1:] for r in pc.parity(docs, str(path)).collect()} == {(True, True)}


def test_broken_model_files():
    with pytest.raises((ValueError, IndexError)):
        pc.parse_model(b"\x0a\xff\x01")


def test_token_histogram_answers_every_limit(spark):
    import base64

    import tiktoken

    counted = token_counts.with_token_counts(texts(spark), RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=token_counts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = {r.doc_id: r.n_tokens for r in counted.collect()}
    assert sizes == {i: len(plain.encode_ordinary(t or "")) for i, t in enumerate(TEXTS)}

    rng = random.Random(1)
    lengths = [rng.choice([0, 1, 5, 1023, 1024, 1025, rng.randrange(10_000)]) for _ in range(300)]
    hist = token_counts.length_histogram(spark.createDataFrame([(x,) for x in lengths], "n_tokens long"))
    rows = {r.n_tokens: r for r in hist.collect()}
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        fit = [x for x in lengths if x <= limit]
        assert (r.n_docs, r.docs_upto, r.docs_longer) == (lengths.count(limit), len(fit), 300 - len(fit))
        assert (r.tokens_upto, r.tokens_longer) == (sum(fit), sum(lengths) - sum(fit))
        assert r.truncated_total == sum(min(x, limit) for x in lengths) and r.share_upto == len(fit) / 300
    for limit in (0, 77, 10**6):
        assert token_counts.truncated_total(hist, limit).first()[0] == sum(min(x, limit) for x in lengths)
    for share in (0.01, 0.5, 1.0):
        assert token_counts.quantile(hist, share).first()[0] == sorted(lengths)[math.ceil(share * 300 - 1e-9) - 1]
    assert token_counts.length_histogram(counted.limit(0)).collect() == []


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((40, 16))
    rows = [centers[i % 40] + 0.12 * rng.standard_normal(16) for i in range(400)]
    rows += [centers[0] + 0.05 * rng.standard_normal(16) for _ in range(700)]  # a group beyond the window and a block
    rows += [rows[5]] * 30 + [3 * rows[5]]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0] * 3, [2.0] * 3, [1e300] * 3]
    rows += [(2000 + i, v) for i, v in enumerate(odd)] + [rows[7], (None, rows[7][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("root", F.lit("x"))
    got = sorted(map(tuple, sorted_projections.near_duplicates(vectors).collect()), key=str)
    unit, keep = [], []
    for v in (r[1] for r in rows):
        fine = bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        keep.append(fine)
        v = np.array(v if fine else [0.0]) / max(map(abs, v if fine else [1.0]))
        unit.append(v / (np.linalg.norm(v) or 1))
    near = [[j for j in range(len(rows)) if j != i and keep[i] and keep[j] and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= 0.9] for i in range(len(rows))]
    least = [r[0] for r in rows]
    for _ in range(20):
        least = [min((least[j] for j in [i, *near[i]] if least[j] is not None), default=None) for i in range(len(rows))]
    want = sorted(((r[0], len(near[i]), least[i], r[0] == least[i]) for i, r in enumerate(rows)), key=str)
    assert got == want and max(len(n) for n in near) > 700
    assert sorted_projections.near_duplicates(vectors.limit(0)).collect() == []


def test_rounds_go_on_until_few_vectors_are_left(spark, monkeypatch):
    """Pairs at cosine 0.9 in a crowd of vectors at 0.6: one pass with a small window meets few of them."""
    monkeypatch.setattr(sorted_projections, "PASSES", 4)
    monkeypatch.setattr(sorted_projections, "WINDOW", 6)
    rng = np.random.default_rng(5)
    middle, rows = rng.standard_normal(32), []
    for i in range(1500):
        rows.append(middle + 0.8 * rng.standard_normal(32))
        if i < 300:
            rows.append(rows[-1] + 0.5 * rng.standard_normal(32))
    unit = np.array([r / np.linalg.norm(r) for r in rows])
    near = unit @ unit.T >= 0.9
    links = near.sum(axis=1) - 1
    vectors = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in sorted_projections.near_duplicates(vectors).collect()}
    assert links.sum() > 300 and all(got[i] <= n for i, n in enumerate(links))
    assert sum(got.values()) >= 0.99 * links.sum()


def test_urls_rules_and_parts(spark):
    cases = [
        ("http://EXAMPLE.com/en/x?q#f", "example.com", "/en/x", "example.com/en/", "block"),
        ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://a.www.example.com/en/1", "a.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
        ("https://x.example.com?en/", "x.example.com", "", None, "allow"),
        ("s://h.net/fr/é#x", "h.net", "/fr/é", "net/fr/", "block"), ("s://h.net/FR/", "h.net", "/FR/", None, "allow"),
        ("no scheme/en/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow")]
    rows = [(i, c[0]) for i, c in enumerate(cases)]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string").withColumn("host", F.lit("clash"))
    none = spark.createDataFrame([], "key long, bad int")
    got = url_filter.filter_urls(pages, none, queries.URL_RULES, F.lit(None).cast("long")).collect()
    want = Counter((i, *c[1:]) for i, c in enumerate(cases)) + Counter([(0, *cases[0][1:])])
    assert Counter(tuple(r)[:5] for r in got) == want
    assert url_filter.filter_urls(pages.limit(0), none, queries.URL_RULES, F.lit(1).cast("long")).collect() == []


def test_hosts_are_judged_by_bounds(spark):
    rows, outcomes = [], []
    for host, n, bad in (("a.bad.com", 200, 190), ("b.bad.com", 3, 3), ("c.bad.com", 0, 0), ("x.good.com", 300, 2), ("y.fine.org", 200, 10),
                         ("z.fine.org", 1, 1), ("s.shop.co.uk", 50, 45), ("10.0.0.1:80", 5, 5), ("u@q.bad.com", 4, 4)):
        for k in range(max(n, 1)):
            rows.append((len(rows), f"http://{host}/p"))
            if n:
                outcomes += [(len(rows) - 1, int(k < bad)), (len(rows) - 1, 0)]  # the worst counts
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = url_filter.filter_urls(pages, spark.createDataFrame([*outcomes, (None, 1)], "key long, bad int"), [], F.col("page_id"))
    verdict = {r.host: r.verdict for r in got.collect()}
    assert verdict["a.bad.com"] == verdict["b.bad.com"] == verdict["s.shop.co.uk"] == verdict["u@q.bad.com"] == "block"
    # one bad page does not outweigh a good domain, and a host without labels has its domain's rate but a wide bound
    assert verdict["z.fine.org"] == verdict["x.good.com"] == verdict["y.fine.org"] == "allow"
    rates = {r.host: r.bad_rate for r in got.collect()}
    assert rates["c.bad.com"] > 0.7 and rates["z.fine.org"] < 0.9


SCHEMAS = {"f": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {
    "a": {"type": "integer", "minimum": 0, "maximum": 9}, "b": {"type": ["string", "null"], "pattern": "^x|^.call"},
    "c": {"type": "array", "items": {"enum": [1, "z"]}}}}}


def linked(spark, calls, results):
    calls = spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string")
    rows = tool_calls.link_calls(calls.withColumn("ref", F.lit(1)), results, SCHEMAS).collect()
    return {r.call_id: r for r in rows}, rows


def test_calls_are_linked_checked_and_written(spark):
    got, rows = linked(spark, [
        (1, 0, "k1", "f", '{"b": "x", "a": 1.0}'), (1, 2, "k2", "f", '{"a": 10, "z": 1}'), (1, 4, "k3", "f", "no json"),
        (1, 6, "k4", "g", "{}"), (2, 5, "k5", "f", '{"a": 2, "c": [1, "z", 2]}'), (2, 9, "k1", "f", '{"a": 1}'), (2, 1, None, "f", '{"a": 1}'),
        (2, 1, "", "f", None), (None, None, "k6", "f", '{"a": 3, "b": "xé\\""}'), (2, 7, "k7", None, '{"a": 1}')],
        [(1, 1, "k1", "one"), (1, 8, "k1", "two"), (1, 3, "k2", None), (2, 4, "k5", "soon"), (2, 6, "zz", "lost"), (2, 6, None, "lost")])
    assert len(rows) == 11
    assert {k: (r.status, r.valid, r.problems) for k, r in got.items() if k} == {
        "k1": ("linked", True, "repeated"), "k2": ("linked", False, "$.a: range; $.z: unknown"), "k3": ("unanswered", False, "$: no JSON"),
        "k4": ("unanswered", False, "$: no schema"), "k5": ("early", False, "$.c[2]: not in enum"), "k6": ("unanswered", True, ""),
        "k7": ("unanswered", False, "$: no schema"), "zz": ("orphan", None, "")}
    assert got["k1"].message == '{"arguments":{"a":1.0,"b":"x"},"id":"k1","name":"f","result":"one","status":"linked"}'
    assert got["k6"].message == '{"arguments":{"a":3,"b":"xé\\""},"id":"k6","name":"f","status":"unanswered"}'
    assert sorted(r.status for r in rows if not r.call_id) == ["unnamed"] * 3


def test_references_are_ordered(spark):
    def call(name, turn, *refs):
        return (1, turn, name, "f", json.dumps({"a": 1, "c": [f"$call:{r}" for r in refs]}))

    back = [call(f"b{i}", i, *([f"b{i - 1}"] if i else []), *(["b0"] if i > 3 else [])) for i in range(40)]
    odd = [call("p", 50, "q"), call("q", 60, "r"), call("r", 55), call("s", 61, "p"), call("t", 60, "q", "nowhere"),
           call("c1", 70, "c2"), call("c2", 71, "c1"), call("c3", 72, "c1"), call("self", 73, "self"), call("after", 71, "c2")]
    got, rows = linked(spark, back + odd, [])
    assert all((got[f"b{i}"].position, got[f"b{i}"].level) == (i, 0) for i in range(40)) and got["b9"].n_refs == 2
    where = {k: (r.position, r.level) for k, r in got.items()}
    assert where["r"] == (55, 0) and where["q"] == (60, 0) and where["p"] == (60, 1) and where["t"] == (60, 1) and where["s"] == (61, 0)
    assert where["c1"] == where["c2"] == (71, None) and where["after"] == (71, None) and where["c3"] == (72, 0)
    assert where["self"] == (73, None) and got["t"].n_unresolved == 1


def test_calls_in_chats(spark):
    said = json.dumps({"tool_calls": [{"id": "t1", "name": "f", "arguments": '{"a":1}'}, {"id": "t2", "name": "f", "arguments": "{}"}]})
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", "é?"), (1, 2, "assistant", said), (1, 3, "tool", '{"tool_call_id":"t1","content":"r"}'),
            (1, 4, None, None), (1, 5, "user", None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(r.call_id for r in tool_calls.calls_in_messages(messages).collect()) == ["t1", "t2"]
    assert [(r.call_id, r.content) for r in tool_calls.results_in_messages(messages).collect()] == [("t1", "r")]
    calls, results = tool_calls.exchanges(messages)
    found = {r.call_id: r for r in tool_calls.link_calls(calls, results, queries.CALL_SCHEMAS).collect()}
    assert found["c1-1"].message == json.dumps(
        {"arguments": {"prompt": "é?"}, "id": "c1-1", "name": "reply", "result": said, "status": "linked"},
        separators=(",", ":"), ensure_ascii=False)
    assert found["c1-5"].problems == "$.prompt: missing" and found["c1-0"].status == "unanswered" and found["c1-3"].status == "orphan"
    assert tool_calls.link_calls(calls.limit(0), results.limit(0), {}).collect() == []


def test_identifiers_hold_within_a_conversation(spark, tmp_path):
    def said(*calls):
        return json.dumps({"tool_calls": [{"id": i, "name": "f", "arguments": a} for i, a in calls]})

    def gave(i, content):
        return json.dumps({"tool_call_id": i, "content": content})

    rows = [(1, 0, "assistant", said(("k1", "{}"))), (1, 1, "tool", gave("k1", "one")), (1, 3, "tool", gave("k1", "again")),
            (2, 0, "assistant", said(("k1", "{}"), ("k2", '{"x": "$call:k1", "y": "$call:k9"}'))), (2, 1, "tool", gave("k1", "two")),
            (2, 2, "assistant", said(("k1", '{"late": "$call:k2"}'))), (2, 4, "tool", gave("k9", "lost")),
            (3, 0, "assistant", said(("k9", '{"x": "$call:k2"}'))), (3, 0, "assistant", said(("k9", '{"x": "$call:k2"}'))),
            (None, 0, "assistant", said(("k1", "{}"))), (None, 1, "tool", gave("k1", "none"))]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = [r for r in queries.op10_tool_calls(spark, str(tmp_path)).collect() if r.call_id and r.call_id[0] == "k"]
    want = [
        (1, "k1", 0, "linked", 0, 0, "one"), (1, "k1", 3, "repeated", 0, 0, "again"), (2, "k1", 0, "linked", 0, 0, "two"),
        (2, "k2", 0, "unanswered", 2, 1, None), (2, "k1", 2, "repeated", 1, 0, None), (2, "k9", 4, "orphan", 0, 0, "lost"),
        (3, "k9", 0, "unanswered", 1, 1, None), (3, "k9", 0, "repeated", 1, 1, None), (None, "k1", 0, "linked", 0, 0, "none")]
    found = [(r.conv_id, r.call_id, r.turn, r.status, r.n_refs, r.n_unresolved, json.loads(r.message).get("result")) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert {(r.conv_id, r.call_id) for r in got if "repeated" in r.problems} == {(1, "k1"), (2, "k1"), (3, "k9")}
    assert next((r.position, r.level) for r in got if r[:2] == (2, "k2")) == (0, 1)
    none = messages.limit(0)
    assert tool_calls.link_conversations(*tool_calls.exchanges(none), {}).collect() == []


ODD_ARGUMENTS = [
    '{"prompt":"\\ud800"}', '{"prompt":"\\ud83d\\ude00"}', '{"\\udfff":1}', '{"prompt":NaN}', '{"prompt":-Infinity}', '{"prompt":1e999}',
    '{"prompt":' + "9" * 400 + "}", "9" * 5000, "[" * 100_000 + "]" * 100_000, '{"prompt":' + "[" * 900 + "]" * 900 + "}",
    '{"prompt":"' + "x" * 2_000_000 + '"}', "", "null", '{"prompt":"a"} b']


def test_odd_json_is_written_or_refused(spark):
    """Halves of surrogate pairs, numbers beyond doubles, deep and very long values: a row each, as real JSON."""
    calls = spark.createDataFrame(
        [(1, i, f"k{i}", "reply", a) for i, a in enumerate(ODD_ARGUMENTS)],
        "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([], "conv_id long, turn long, call_id string, content string")
    rows = {r.turn: r for r in tool_calls.link_conversations(calls, results, queries.CALL_SCHEMAS).collect()}
    assert len(rows) == len(ODD_ARGUMENTS)

    def refuse(word):
        raise AssertionError(word)

    written = {i: json.loads(r.message, parse_constant=refuse)["arguments"] for i, r in rows.items()}
    assert rows[0].valid and written[0] == {"prompt": "\ud800"} and "\\ud800" in rows[0].message
    assert rows[1].valid and written[1] == {"prompt": "\U0001f600"}
    assert not rows[2].valid and "\\udfff: unknown" in rows[2].problems
    for i in (3, 4, 5, 7, 8, 13):
        assert rows[i].problems == "$: no JSON" and written[i] == ODD_ARGUMENTS[i]
    assert rows[6].problems == "$.prompt: not string" and written[6] == {"prompt": int("9" * 400)}
    assert rows[10].valid and not rows[11].valid and not rows[12].valid
    assert tool_calls.schema_problems(10 ** 400, {"type": "integer", "minimum": 1}) == []
    assert tool_calls.schema_problems(1.5, {"type": "integer"}) == ["$: not integer"]


def brute_link(calls, results):
    """(conv, id, turn, status, position, n_refs, n_unresolved) of every call and every result without a call of its own."""
    def least(rows):
        out = {}
        for conv, turn, name, *rest in sorted(rows, key=lambda r: (r[1], r[3] or "", r[2] or "")):
            out.setdefault((conv, name), (turn, *rest)) if name else None
        return out

    calls = [(c, t or 0, i, a) for c, t, i, a in calls]
    results = [(c, t or 0, i, x) for c, t, i, x in results]
    first, answers = least(calls), least(results)

    def refs(conv, arguments):
        return list(dict.fromkeys(re.findall(tool_calls.REFERENCE, arguments or "")))

    def reach(conv, turn, arguments):
        latest, seen, todo = turn, set(), refs(conv, arguments)
        while todo:
            key = (conv, todo.pop())
            if key in first and key not in seen:
                seen.add(key)
                latest = max(latest, first[key][0])
                todo += refs(conv, first[key][1])
        return latest

    out, taken = [], set()
    for conv, turn, name, arguments in calls:
        mine = first.get((conv, name)) == (turn, arguments) and (conv, name) not in taken and bool(name)
        answer = answers.get((conv, name))
        if mine:
            taken.add((conv, name))
            status = "unanswered" if answer is None else "early" if answer[0] < turn else "linked"
        else:
            status = "repeated" if name else "unnamed"
        own = refs(conv, arguments)
        out.append((conv, name, turn, status, reach(conv, turn, arguments), len(own), sum((conv, r) not in first for r in own)))
    used = set()
    for conv, turn, name, content in results:
        key = (conv, name)
        if name and answers[key] == (turn, content) and key not in used:
            used.add(key)
            if key in first:
                continue
            out.append((conv, name, turn, "orphan", turn, 0, 0))
        else:
            out.append((conv, name, turn, "repeated" if name else "unnamed", turn, 0, 0))
    return Counter(out)


def test_linking_against_brute_force(spark):
    rng = random.Random(31)
    names = ["a", "b", "c", "d", "e", "", None]
    calls = [(rng.choice([1, 2, None]), rng.choice([0, 1, 2, 5, 9, None]), rng.choice(names),
              json.dumps({"x": f"$call:{rng.choice('abcdefz')}", "y": [f"$call:{rng.choice('abc')}"], "z": i})) for i in range(60)]
    results = [(rng.choice([1, 2, 3, None]), rng.choice([0, 1, 3, 9, None]), rng.choice(names), f"r{i}") for i in range(50)]
    frames = (spark.createDataFrame([(c, t, i, "f", a) for c, t, i, a in calls],
                                    "conv_id long, turn long, call_id string, name string, arguments string"),
              spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"))
    got = tool_calls.link_conversations(*(f.repartition(3) for f in frames), {}).collect()
    assert Counter((r.conv_id, r.call_id, r.turn, r.status, r.position, r.n_refs, r.n_unresolved) for r in got) == brute_link(
        calls, results)


def test_suffixes_from_a_list(spark, tmp_path):
    (tmp_path / "list.dat").write_text(
        "// a comment\n\nco.uk\n*.ck\n!www.ck  // kept\npref.city.jp\n*.city.jp\nUK\n")
    suffixes = url_filter.read_suffixes(spark, str(tmp_path / "list.dat"))
    assert suffixes == ["!www.ck", "*.city.jp", "*.ck", "co.uk", "pref.city.jp", "uk"]
    hosts = {"a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "x.y.ck": ("x.y.ck", "y.ck"), "z.www.ck": ("www.ck", "ck"),
             "a.b.pref.city.jp": ("b.pref.city.jp", "pref.city.jp"), "a.o.city.jp": ("a.o.city.jp", "o.city.jp"),
             "me@a.example.com:80": ("example.com", "com"), "10.0.0.1": ("10.0.0.1", ""), "": ("", ""), "com": ("com", "com")}
    levels = url_filter.host_levels(F.col("host"), suffixes)
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", levels["domain"], levels["suffix"])
    assert {r[0]: (r[1], r[2]) for r in rows.collect()} == hosts
