"""Conversation repair against a search of all edits by cost and letters."""

import hashlib
import random
import re
from functools import lru_cache

import duckdb
import pytest
from pyspark.sql import functions as F

from tablewright.llm import conversation_repair as repair
from tablewright.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
NOTHING = hashlib.sha256(b"").hexdigest()


def brute(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and the hash of the repaired rows of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))

    @lru_cache(None)
    def best(i, written, inserts):
        """(cost, letters, repaired rows) from row i on; `written` is what the roles so far end with."""
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[written]
        name = {"u": "user", "a": "assistant"}[follow]
        ways = []
        if i == len(rows) and written in ("", "a"):
            ways.append((0, "", ()))
        if inserts:
            cost, letters, out = best(i, follow, inserts - 1)
            ways.append((cost + 3, "I" + letters, (f"{name}:",) + out))
        if i < len(rows):
            _, role, text = rows[i]
            cost, letters, out = best(i + 1, written, 2)
            ways.append((cost + 4, "D" + letters, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] == "truncated" else 0
                cost, letters, out = best(i + 1, follow, 2)
                ways.append((cost + 3 + more, "R" + letters, (f"{name}:{text}",) + out))
                if role[:1] == follow or (role[:1] == "s" and written == ""):
                    cost, letters, out = best(i + 1, role[:1], 2)
                    ways.append((cost + more, "K" + letters, (f"{role}:{text}",) + out))
        return min(ways) if ways else (10 ** 9, "", ())

    cost, letters, out = best(0, "", 2)
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest)


def repaired(spark, rows, schema=SCHEMA):
    written, found = repair.repair(spark.createDataFrame(rows, schema).repartition(3))
    hashes = {r.conv_id: r.sha256 for r in repair.digests(written).collect()}
    return {r.conv_id: (*(r[c] for c in COUNTS), hashes.get(r.conv_id, NOTHING)) for r in found.collect()}, written


def conversations(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = rng.choice(["Yes.", "No!", "Why?", "so on", "é?  \t", "", " \n\t", None, "a.b", f"{turn}.", f"{turn}!", "x. "])
            rows += [(conv if conv else None, rng.choice([turn, turn, turn, turn - 1, turn + 2, None]), role, text)] * rng.choice([1, 1, 1, 2, 3])
    return rows


def by_conversation(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return {c: brute(v) for c, v in out.items()}


def test_against_brute_force(spark):
    rows = conversations(1, 150, 9)
    assert repaired(spark, rows)[0] == by_conversation(rows)


def test_blocks_are_joined(spark, monkeypatch):
    """Blocks of four rows, joined two at a time, as a long conversation has them."""
    rows = conversations(2, 12, 40) + [(99, t, ("user", "assistant")[t % 3 == 1], f"{t % 60}{'.,'[t % 7 == 0]}") for t in range(150)]
    want = by_conversation(rows)
    monkeypatch.setattr(repair, "BLOCK_BITS", 2)
    monkeypatch.setattr(repair, "JOIN_BITS", 1)
    assert repaired(spark, rows)[0] == want


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "tool", "Out."), (1, 2, "user", "And?"), (1, 3, "user", "cut off")]
    found, written = repaired(spark, rows)
    got = sorted(tuple(r) for r in written.collect())
    assert found[1][6] == "KRKR" and found[1][5] == 3 + 6
    assert got == [(1, 0, 0, "user", "Hi.", "K"), (1, 1, 1, "assistant", "Out.", "R"), (1, 2, 2, "user", "And?", "K"),
                   (1, 3, 3, "assistant", "cut off", "R")]


def test_many_copies_and_one_long_conversation(spark):
    rows = [(5, 1, "user", "Same.")] * 3000 + [(5, 2 + t, ("assistant", "user")[t % 2], f"Turn {t}.") for t in range(2501)]
    found, written = repaired(spark, rows)
    gaps, blank, duplicate, truncated, illegal, cost, audit, _ = found[5]
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0, 0, 2999, 0, 2999, 4 * 2999)
    assert audit == "K" + "D" * 2999 + "K" * 2501 and written.count() == 2502


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)], [(1, None, "user", "")]])
def test_nothing_stays(spark, rows):
    found, written = repaired(spark, rows)
    assert written.count() == 0
    assert all(v[0] == 0 and v[6] == "D" and v[7] == NOTHING for v in found.values()) and len(found) == len(rows)


def test_extra_columns_and_long_texts(spark):
    rows = [("a", 0, "user", "x " * 400_000 + "end."), ("a", 1, "assistant", "Fine.")]
    frame = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    for name in ("place", "block", "audit", "fault", "initial", "first"):
        frame = frame.withColumn(name, F.lit("clash"))
    written, found = repair.repair(frame)
    assert found.select("audit", "cost").first() == ("KK", 0)
    assert sorted(len(r.text) for r in written.collect()) == [5, 800_004]


def test_query_against_its_sql(spark, tmp_path):
    """Damage included: null conversations, turns, roles and texts, repeated rows, and conversations that damage empties."""
    rows = conversations(7, 120, 8) + [(1000 + i, 0, "user", "Only row.") for i in range(60)] + [(None, None, None, None)] * 2
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = db.execute(queries.ORACLES["op11_conversation_repair"])
    names = sorted(got.columns)
    places = [[c[0] for c in want.description].index(n) for n in names]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(
        str(tuple(r[p] for p in places)) for r in want.fetchall())
    assert got.filter("audit = '' AND cost = 0").count() > 0
