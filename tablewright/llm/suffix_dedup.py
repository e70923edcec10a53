"""Repeated passages: every byte covered by a string of LENGTH bytes that also starts anywhere else.

Strings of LENGTH bytes (windows) can only be equal if the least hash among their grams is equal. All texts are cut
into segments of neighbouring windows with the same least hash, so that equal windows always fall under the same hash.
Hashes that occur once need no further work; where all segments of a hash are the same string, all their windows are
repeated. The different segments of the remaining hashes are gathered by hash, each string once, and go through
Burrows-Wheeler transforms: shards of them are merged by interleave refinement (bwt.py), whose neighbours with LENGTH
bytes in common are the repeated windows. A hash with too many different segments (a common line amid all kinds of
text) is settled by counting digests of its windows instead, which spreads it over all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.bwt import build_shard, merge
from tablewright.llm.common import cut, lean_batches, lean_shuffles, pieces, utf8, within
from tablewright.llm.shingles import mix

LENGTH = 200
GRAM = 64
SPAN = 1 << 19        # bytes that are hashed in one go
MOST_WINDOWS = 256    # windows in a segment; longer runs (of periodic text) are cut
CROWD = 512           # different segments of a hash that go through one merge
MERGE_BYTES = 48 << 10  # segments that are merged together, whole hashes each (in a size that caches hold), ...
SHARDS = 4            # ... from so many transforms
_rng = np.random.default_rng(7)
_LETTERS = _rng.integers(1 << 62, size=(2, 256), dtype=np.uint64) * 2 + 1
_BASES = [int(x) * 2 + 1 for x in _rng.integers(1 << 61, size=2)]
_EDGE = SPAN + LENGTH + 1


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    both = np.ones((2, _EDGE + 1), np.uint64)
    both[0, 1:], both[1, 1:] = base, pow(base, -1, 1 << 64)
    return tuple(np.cumprod(both, axis=1))


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


class Rolling:
    """Hashes of any substring of a span, in constant time each."""

    def __init__(self, data: np.ndarray, which: int):
        if not _POWERS:
            _POWERS.extend(_powers(b) for b in _BASES)
        up, self.down = _POWERS[which]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_LETTERS[which][data] * up[:len(data)], out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])

    def some(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[begins]) * self.down[begins])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _spans(bounds: np.ndarray):
    """First text, last text, begin and end of spans: whole texts together, or a stretch of a long one."""
    i, n = 0, len(bounds) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + SPAN, side="right")) - 1)
        for begin in range(int(bounds[i]), int(bounds[j]), SPAN):
            yield i, j, begin, int(min(bounds[j], begin + SPAN + LENGTH - 1))
        i = j


def segments(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
    """text, start, windows, least, digest of the segments of all texts, and whether one may hold a window twice."""
    out = []
    for i, j, begin, end in _spans(bounds):
        count = end - begin - length + 1
        if count <= 0:
            continue
        part = data[begin:end]
        grams = Rolling(part, 0).all(GRAM)
        least = _least(grams, length - GRAM + 1)
        valid = np.ones(count, bool)
        first = np.zeros(count, bool)
        first[0] = True
        for b in bounds[i + 1:j]:  # windows that would reach into the next text
            valid[max(0, b - begin - length + 1):b - begin] = False
            first[b - begin:b - begin + 1] = True
        first[1:] |= (least[1:] != least[:-1]) | ~valid[:-1]
        starts = np.flatnonzero(first & valid)
        stops = np.flatnonzero(valid & np.append(first[1:] | ~valid[1:], True)) + 1
        sizes = stops - starts
        cuts = -(-sizes // MOST_WINDOWS)
        step = within(cuts) * MOST_WINDOWS
        starts = np.repeat(starts, cuts) + step
        sizes = np.minimum(np.repeat(sizes, cuts) - step, MOST_WINDOWS)
        digest = Rolling(part, 1).some(starts, starts + sizes + length - 1)
        # a segment can only hold one window twice if its least gram occurs twice in it
        spread = sizes + (length - GRAM)
        met = grams[np.repeat(starts, spread) + within(spread)] == np.repeat(least[starts], spread)
        twice = np.add.reduceat(met.astype(np.int32), np.cumsum(spread) - spread) > 1 if len(starts) else met
        owner = np.searchsorted(bounds, starts + begin, side="right") - 1
        out.append((owner, starts + begin - bounds[owner], sizes, least[starts].astype(np.int64),
                    (digest + sizes.astype(np.uint64)).astype(np.int64), twice))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*out))


def _segment_rows(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in pieces(batches, "text", SPAN):
            owner, start, windows, least, digest, twice = segments(*utf8(batch.column("text")))
            owner = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(owner), batch.column("mark").take(owner), pa.array(start),
                 pa.array(windows, pa.int32()), pa.array(least), pa.array(digest), pa.array(twice, pa.bool_())],
                names=["doc_id", "mark", "start", "windows", "least", "digest", "twice"])

    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(
        run, f"doc_id {kind}, mark long, start long, windows int, least long, digest long, twice boolean")


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_windows(strings: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> list[np.ndarray]:
    """For each string: which of its windows occur at another place of the strings too."""
    parts = [list(range(k, len(strings), shards)) for k in range(min(shards, len(strings)))]
    order, common = merge([build_shard([strings[i] for i in p], length) for p in parts], length)
    sizes = np.array([len(strings[i]) + 1 for p in parts for i in p])
    begins = np.cumsum(sizes) - sizes
    valid = within(sizes) <= np.repeat(sizes, sizes) - 1 - length
    interval = np.concatenate(([0], np.cumsum(common < length)))
    repeated = np.zeros(len(order), bool)
    repeated[order] = (np.bincount(interval, valid[order]) > 1)[interval]
    out = [np.zeros(0, bool)] * len(strings)
    for i, begin, size in zip((i for p in parts for i in p), begins, sizes):
        out[i] = repeated[begin:begin + max(0, size - length)]
    return out


def _merged(strings: DataFrame) -> DataFrame:
    """least, digest, first, last: ranges of repeated windows of the segments (least, digest, string), by merging."""

    def settle(batch):
        names = [batch.column("least").to_numpy(), batch.column("digest").to_numpy()]
        rows, first, last = [], [], []
        for i, flags in enumerate(repeated_windows(batch.column("string").to_pylist())):
            a, b = _ranges(flags)
            rows.append(np.full(len(a), i))
            first.append(a)
            last.append(b)
        rows = np.concatenate(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(names[0][rows]), pa.array(names[1][rows]), pa.array(np.concatenate(first)),
             pa.array(np.concatenate(last))], names=["least", "digest", "first", "last"])

    def run(batches):
        kept = None
        for batch in batches:
            kept = batch if kept is None else pa.concat_batches([kept, batch])
            filled = np.cumsum(pc.binary_length(kept.column("string")).to_numpy())
            at = last = 0
            for end in np.flatnonzero(np.diff(kept.column("least").to_numpy())) + 1:
                if last > at and filled[end - 1] - (filled[at - 1] if at else 0) > MERGE_BYTES:
                    yield settle(kept.slice(at, last - at))
                    at = last
                last = int(end)
            kept = pa.concat_batches([kept.slice(at)])
        if kept is not None and len(kept):
            yield settle(kept)

    return strings.repartition("least").sortWithinPartitions("least").select("least", "digest", "string").mapInArrow(
        run, "least long, digest long, first long, last long")


def _counted(strings: DataFrame) -> DataFrame:
    """The same for hashes with many segments, by counting digests of their windows."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                data, bounds = utf8(part.column("string"))
                sizes = np.diff(bounds) - LENGTH + 1
                begins = np.repeat(bounds[:-1], sizes) + within(sizes)
                owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
                one, two = (Rolling(data, k).some(begins, begins + LENGTH).astype(np.int64) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("least").take(owner), part.column("digest").take(owner), pa.array(within(sizes)),
                     pa.array(one), pa.array(two)], names=["least", "digest", "at", "one", "two"])

    windows = strings.select("least", "digest", "string").mapInArrow(
        run, "least long, digest long, at long, one long, two long")
    often = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("one", "two")
    found = windows.join(often, ["one", "two"], "left_semi").groupBy("least", "digest").agg(
        F.sort_array(F.collect_set("at")).alias("at"))

    def together(batches):
        for batch in batches:
            at = batch.column("at").flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), [len(x) for x in batch.column("at")])
            first = np.ones(len(at), bool)
            first[1:] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])
            last = np.append(first[1:], True)
            rows = pa.array(owner[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("least").take(rows), batch.column("digest").take(rows), pa.array(at[first]),
                 pa.array(at[last] + 1)], names=["least", "digest", "first", "last"])

    return found.mapInArrow(together, "least long, digest long, first long, last long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, mark (xxhash64 of the text) and spans: (begin, end) of bytes under repeated windows, not yet united."""
    lean_shuffles(docs.sparkSession)
    lean_batches(docs.sparkSession)
    rows = cut(_segment_rows(docs), "segments")
    hashes = rows.groupBy("least").agg(
        F.count(F.lit(1)).alias("n"), (F.min("digest") != F.max("digest")).alias("mixed"), F.max("twice").alias("twice"))
    hashes = hashes.filter("n > 1 OR twice").select("least", F.expr("mixed OR n = 1").alias("mixed"))
    shared = cut(rows.drop("twice").join(hashes, "least"), "shared")

    mixed = shared.filter("mixed").drop("mixed")
    place = F.struct("doc_id", "mark", "start", "windows")
    different = mixed.groupBy("least", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("place"))
    different = cut(different.select("least", "digest", "copies", "place.*"), "different")
    crowds = different.groupBy("least").agg((F.count(F.lit(1)) > CROWD).alias("crowd")).filter("crowd")
    wanted = different.join(crowds, "least", "left").select(
        F.col("doc_id").alias("key"), F.col("mark").alias("key_mark"),
        F.struct("least", "digest", "start", "windows", F.coalesce("crowd", F.lit(False)).alias("crowd")).alias("s"))
    wanted = wanted.groupBy("key", "key_mark").agg(F.collect_list("s").alias("wanted"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("key_mark"))
    fetched = texts.join(wanted, same).select(F.col("text").cast("binary").alias("text"), F.explode("wanted").alias("s"))
    string = F.substring("text", (F.col("s.start") + 1).cast("int"), F.col("s.windows") + (LENGTH - 1))
    # rows that repeat bring their strings twice
    strings = cut(fetched.select("s.least", "s.digest", "s.crowd", string.alias("string")), "strings")
    few = _merged(strings.filter("NOT crowd").dropDuplicates(["least", "digest"]))
    many = _counted(strings.filter("crowd").dropDuplicates(["least", "digest"]))
    found = few.unionByName(many)
    whole = different.filter("copies > 1").select(
        "least", "digest", F.lit(0).cast("long").alias("first"), F.col("windows").cast("long").alias("last"))
    found = cut(found.unionByName(whole), "ranges").groupBy("least", "digest").agg(
        F.collect_list(F.struct("first", "last")).alias("ranges"))

    start, reach = F.col("start"), F.lit(LENGTH - 1)
    part = mixed.join(found, ["least", "digest"]).select("doc_id", "mark", F.transform("ranges", lambda r: F.struct(
        (start + r["first"]).alias("begin"), (start + r["last"] + reach).alias("end"))).alias("spans"))
    full = shared.filter("NOT mixed").select("doc_id", "mark", F.array(F.struct(
        start.alias("begin"), (start + F.col("windows") + reach).alias("end"))).alias("spans"))
    return cut(part.unionByName(full).groupBy("doc_id", "mark").agg(
        F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """All columns of `docs` (doc_id, text), and n_bytes, n_removed, n_spans, kept (the remaining bytes).

    With `as_text`, kept is a string, and parts of characters that a cut has left are dropped.

    Texts are UTF-8 bytes, null counts as empty; matches never cross texts, and texts shorter than LENGTH have none.
    All strings are judged on the texts as given. Rows that repeat are copies of each other. Columns of `docs` that
    clash with the new ones are replaced.
    """
    found = repeated_spans(docs).select(F.col("doc_id").alias("_key"), F.col("mark").alias("_mark"), "spans")
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", "spans")
    same = F.col("doc_id").eqNullSafe(F.col("_key")) & (F.xxhash64("text") == F.col("_mark"))
    names = docs.columns
    joined = docs.join(found, same, "left").select(*names, "spans")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    kind = "string" if as_text else "binary"

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                yield part(batch.slice(at, 256))

    def part(batch):
        data, bounds = utf8(batch.column("text"))
        lists = batch.column("spans")
        flat = lists.flatten()
        begin, end = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
        ends = np.cumsum(sizes)
        removed, count, kept = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), []
        for i in range(len(batch)):
            text = data[bounds[i]:bounds[i + 1]]
            if sizes[i]:
                a, b = begin[ends[i] - sizes[i]:ends[i]], end[ends[i] - sizes[i]:ends[i]]
                depth = np.bincount(a, minlength=len(text) + 1) - np.bincount(b, minlength=len(text) + 1)
                gone = np.cumsum(depth[:-1]) > 0
                removed[i], count[i] = gone.sum(), len(_ranges(gone)[0])
                text = text[~gone]
            kept.append(text.tobytes().decode("utf-8", "ignore") if as_text else text.tobytes())
        own = [batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(
            [*own, pa.array(np.diff(bounds)), pa.array(removed), pa.array(count), pa.array(kept, pa.string() if as_text else pa.binary())],
            names=[*names, "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, f"{fields}, n_bytes long, n_removed long, n_spans long, kept {kind}")


def digests(cleaned: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of what remove_repeats returns."""
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))
