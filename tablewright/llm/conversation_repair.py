"""Conversation structure repair: the cheapest edits that leave `system? (user assistant)+` turns, or none.

Edits are Keep (0), Rerole to user or assistant (3), Delete (4, required for blank and duplicate rows) and Insert of an
empty user or assistant turn (3); a truncated row that is not deleted costs 3 more. Edits and roles form a graph
without cycles: nodes are (rows read, role written last), edges are edits. Every path is one integer: its cost in the
high digits, and below, in a fixed number of digits of one byte, the letters of its edits by position, with zeros after
the end. An edge adds its cost and, at the place it has come to, its letter; the least integer of a node is the cheapest
path, and of equally dear ones that with the least letters. Nothing else decides.

Rows are put in order by ranges of (conversation, turn, role, text), so that a long conversation is dealt to many
tasks. Blocks of at most 1,024 rows are solved from every role to every role; blocks of a conversation are then joined
32 at a time until one path is left. Equal rows are one row with a count, and all copies after the first are deleted
by one edge: an Insert among them is never the least, as D comes before I.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, lean_batches, lean_shuffles

BLANK = " \t\n\x0b\x0c\r"
OK, TRUNCATED, BLANKED, REPEATED = range(4)          # the first fault of a row
START, SYSTEM, USER, ASSISTANT = range(4)            # the role written last
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
FILLS = (USER, USER, ASSISTANT, USER)                # what Rerole and Insert write next
ENDS = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, HALF_SENTENCE = 3, 4, 3, 3
BLOCK_BITS, JOIN_BITS = 10, 5
_PATHS = "array<struct<cost:long,audit:string>>"
_BLOCK = ("block long, n_rows long, blank long, duplicate long, truncated long, illegal long, head string, tail string, "
          f"turns long, low long, high long, paths {_PATHS}")
_FIELDS = [part.split()[0] for part in _BLOCK.split(", ")]


def _scalar(cost: int, letters: bytes, width: int) -> int:
    return cost << 8 * width | int.from_bytes(letters.ljust(width, b"\0"), "big")


def _split(scalar: int, width: int) -> tuple[int, bytes]:
    return scalar >> 8 * width, (scalar & (1 << 8 * width) - 1).to_bytes(width, "big").rstrip(b"\0")


@lru_cache(maxsize=1 << 14)
def solve(initials: str, faults: bytes) -> list[tuple[int, bytes] | None]:
    """For rows by role initial (`x`: any other) and fault: the best (cost, letters) from each role to each role."""
    width = 3 * len(initials) + 2
    unit = 1 << 8 * width
    out: list[tuple[int, bytes] | None] = []

    def insert(best: dict) -> None:
        for _ in range(2):  # more than two in one place lead back to a role that is reached without them
            for state, (weight, place) in list(best.items()):
                put(best, FILLS[state], weight + INSERT * unit, b"I", place)

    def put(best: dict, state: int, weight: int, letter: bytes, place: int) -> None:
        weight += letter[0] << 8 * (width - 1 - place)
        if state not in best or weight < best[state][0]:
            best[state] = (weight, place + 1)

    for entry in range(4):
        best = {entry: (0, 0)}
        insert(best)
        for initial, fault in zip(initials, faults):
            reached: dict[int, tuple[int, int]] = {}
            more = HALF_SENTENCE * unit if fault == TRUNCATED else 0
            for state, (weight, place) in best.items():
                put(reached, state, weight + DELETE * unit, b"D", place)
                if fault in (OK, TRUNCATED):
                    put(reached, FILLS[state], weight + REROLE * unit + more, b"R", place)
                    if initial in KEEPS[state]:
                        put(reached, KEEPS[state][initial], weight + more, b"K", place)
            best = reached
            insert(best)
        out += [_split(best[q][0], width) if q in best else None for q in range(4)]
    return out


def _join_paths(left: list, right: list) -> list:
    """Paths through two blocks one after another."""
    out = []
    for entry in range(4):
        for end in range(4):
            both = [(a[0] + b[0], a[1] + b[1]) for m in range(4)
                    if (a := left[4 * entry + m]) is not None and (b := right[4 * m + end]) is not None]
            width = max((len(x) for _, x in both), default=0)
            out.append(_split(min(_scalar(c, x, width) for c, x in both), width) if both else None)
    return out


def _solve_block(rows: list[dict]) -> dict:
    """Counts and paths of the rows (place, turn, initial, fault, copies) of a block, in order."""
    initials, faults, runs = [], [], []
    out = dict.fromkeys(("n_rows", "blank", "duplicate", "truncated", "illegal", "turns"), 0)
    out |= {"head": rows[0]["initial"], "tail": rows[-1]["initial"], "low": None, "high": None}
    counts = {TRUNCATED: "truncated", BLANKED: "blank", REPEATED: "duplicate"}
    before = None
    for row in rows:
        own, fault, copies, turn = row["initial"], row["fault"], row["copies"], row["turn"]
        later = fault if fault == BLANKED else REPEATED
        out["n_rows"] += copies
        out["illegal"] += copies - 1 + (before is not None and before + own not in LEGAL)
        before = own
        for f, n in ((fault, 1), (later, copies - 1)):
            if n and f in counts:
                out[counts[f]] += n
            if n:
                initials.append(own if own in ("s", "u", "a") else "x")
                faults.append(f)
                runs.append(n)
        if turn is not None and turn != out["high"]:
            out["turns"] += 1
            out["low"], out["high"] = turn if out["low"] is None else out["low"], turn
    paths = solve("".join(initials), bytes(faults))
    if max(runs) > 1:
        paths = [p and (p[0] + sum(DELETE * (n - 1) for n in runs), _spread(p[1], runs)) for p in paths]
    return out | {"paths": paths}


def _spread(letters: bytes, runs: list[int]) -> bytes:
    """The letters with that of each run of copies as often as it has rows."""
    left = iter(runs)
    return b"".join(bytes([x]) * (1 if x == ord("I") else next(left)) for x in letters)


def _join_blocks(blocks: list[dict]) -> dict:
    """Counts and paths of blocks that follow each other."""
    out = blocks[0]
    for b in blocks[1:]:
        same = out["high"] is not None and out["high"] == b["low"]
        joined = {x: out[x] + b[x] for x in ("n_rows", "blank", "duplicate", "truncated")}
        out = joined | {
            "illegal": out["illegal"] + b["illegal"] + (out["tail"] + b["head"] not in LEGAL),
            "turns": out["turns"] + b["turns"] - same, "head": out["head"], "tail": b["tail"],
            "low": b["low"] if out["low"] is None else out["low"], "high": out["high"] if b["high"] is None else b["high"],
            "paths": _join_paths(out["paths"], b["paths"])}
    return out


def _stored(paths: list) -> list:
    return [p and {"cost": p[0], "audit": p[1].decode()} for p in paths]


def _read(paths: list) -> list:
    return [p and (p["cost"], p["audit"].encode()) for p in paths]


def _ordered(messages: DataFrame) -> DataFrame:
    """Distinct rows in order: conv_id, turn, role, text, copies and place, which rises with the order of all rows."""
    copies = F.col("copies") if "copies" in messages.columns else F.lit(1)
    space = F.lit(" ")
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
                           F.coalesce("text", space).alias("text"), copies.cast("long").alias("copies"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    # the bounds of the ranges come to the driver: long texts are cut for them, and for them alone
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, 64), F.substring("text", 1, 64))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    return cut(dealt.withColumn("place", F.monotonically_increasing_id()), "ordered")


def _faulty(ordered: DataFrame) -> DataFrame:
    """The ordered rows without texts: conv_id, place, turn, initial, fault (of the first copy) and copies."""
    first = ordered.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("place"))
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    open_end = ~F.substring(end, -1, 1).isin(".", "!", "?")
    rows = ordered.select("conv_id", "place", "turn", "copies", F.substring("role", 1, 1).alias("initial"),
                          (end == "").alias("blank"), open_end.alias("open_end"))
    rows = rows.join(first.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when(F.col("blank"), BLANKED).when(F.col("first").isNull(), REPEATED).when(F.col("open_end"), TRUNCATED)
    return rows.select("conv_id", "place", "turn", "copies", "initial", fault.otherwise(OK).alias("fault"))


def _gathered(spark_rows: DataFrame, key: Column, item: Column, make) -> DataFrame:
    """One row for each conversation and `key`: `make` of the sorted items that share them, as a block."""
    kind = spark_rows.schema["conv_id"].dataType.simpleString()
    grouped = spark_rows.groupBy("conv_id", key.alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))

    def run(batches):
        for batch in batches:
            made = [make(x) for x in batch.column("items").to_pylist()]
            columns = [batch.column("block")] + [
                pa.array([_stored(m[f]) if f == "paths" else m[f] for m in made], _TYPES[f]) for f in _FIELDS[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names=["conv_id", *_FIELDS])

    return cut(grouped.mapInArrow(run, f"conv_id {kind}, {_BLOCK}"), "blocks")


_TYPES = {f: pa.string() if f in ("head", "tail") else pa.int64() for f in _FIELDS} | {
    "paths": pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))}


def _planned(ordered: DataFrame) -> DataFrame:
    """conv_id, audit, cost and the counts of every conversation."""
    row = F.struct("place", "turn", "initial", "fault", "copies")
    blocks = _gathered(_faulty(ordered), F.shiftright("place", BLOCK_BITS), row, _solve_block)

    def joined(items: list[dict]) -> dict:
        return _join_blocks([item | {"paths": _read(item["paths"])} for item in items])

    while (blocks.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1 << JOIN_BITS:
        blocks = _gathered(blocks, F.shiftright("block", JOIN_BITS), F.struct(*_FIELDS), joined)
    whole = _gathered(blocks, F.lit(0).cast("long"), F.struct(*_FIELDS), joined)
    ways = F.filter(F.transform(F.array(*[F.lit(q) for q in ENDS]), lambda q: F.get("paths", q)), lambda p: p.isNotNull())
    best = F.array_min(ways)  # least cost, then least letters: both ends compare as their integers do
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    return whole.select("conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
                        best["cost"].alias("cost"), best["audit"].alias("audit"))


def repair(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The repaired rows, and one row of findings for each conversation of `messages` (conv_id, turn, role, text).

    Rows: conv_id, place (from 0), turn (null for inserted rows), role, text and edit (K, R or I). Findings: conv_id,
    gaps, blank, duplicate, truncated, illegal, cost and audit. Rows of a conversation count by turn (nulls first), then
    role and text. A null role or text is one space, a null conv_id is a conversation of its own, a null turn leaves no
    gap. Rows that repeat are duplicates after the first; a column `copies`, if there, says how often a row counts.
    Other columns are ignored. An empty table gives two empty ones, a conversation of which nothing stays no rows.

    Repaired rows of a conversation are written in order by one task, which reads them as a stream and holds the
    conversation's letters, one byte a row, but not its texts.
    """
    lean_shuffles(messages.sparkSession)
    lean_batches(messages.sparkSession)
    ordered = _ordered(messages)
    planned = _planned(ordered)
    kind = messages.schema["conv_id"].dataType.simpleString()
    none = {c: F.lit(None).cast("string") for c in ("role", "text", "audit")}
    heads = planned.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("turn"),
                           none["role"].alias("role"), none["text"].alias("text"), F.lit(0).cast("long").alias("copies"), "audit")
    rows = heads.unionByName(ordered.withColumn("audit", none["audit"]))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return rows.mapInArrow(_write, f"conv_id {kind}, place long, turn long, role string, text string, edit string"), planned


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's rows after its edits; a first row of each holds the edits."""
    out: list[tuple] = []
    size, kind = 0, None
    conv, audit, at, state, place = None, "", 0, START, 0

    def fill(text: str, turn: int | None, letter: str) -> None:
        nonlocal state, place
        state = FILLS[state]
        out.append((conv, place, turn, NAMES[state], text, letter))
        place += 1

    def inserted() -> None:
        nonlocal at
        while audit[at:at + 1] == "I":
            fill("", None, "I")
            at += 1

    def flushed() -> pa.RecordBatch:
        nonlocal size
        columns = list(zip(*out)) or [()] * 6
        out.clear()
        size = 0
        types = [kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["conv_id", "place", "turn", "role", "text", "edit"])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for row in batch.to_pylist():
            if row["audit"] is not None:
                inserted()  # those at the end of the conversation before
                conv, audit, at, state, place = row["conv_id"], row["audit"], 0, START, 0
                continue
            for left in range(row["copies"], 0, -1):
                if audit.startswith("D" * left, at):
                    at += left
                    break
                inserted()
                letter = audit[at]
                at += 1
                if letter == "K":
                    state = KEEPS[state][row["role"][:1]]
                    out.append((conv, place, row["turn"], row["role"], row["text"], "K"))
                    place += 1
                elif letter == "R":
                    fill(row["text"], row["turn"], "R")
                if letter != "D":
                    size += len(row["text"])
            if size > 1 << 20 or len(out) > 4096:
                yield flushed()
    inserted()
    if out:
        yield flushed()


def digests(repaired: DataFrame) -> DataFrame:
    """conv_id and sha256 (hex) of the `role:text` of its rows, joined by line ends; rows must come as `repair` gives them."""
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches):
        conv, digest = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")))
            for own, place, role, text in rows:
                if place == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            if done:
                yield made(batch, done)
            last = batch
        if digest is not None:
            yield made(last, [(conv, digest.hexdigest())])

    def made(batch, done):
        names, values = zip(*done)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, batch.schema.field("conv_id").type), pa.array(values, pa.string())], names=["conv_id", "sha256"])

    return repaired.mapInArrow(run, f"conv_id {kind}, sha256 string")
