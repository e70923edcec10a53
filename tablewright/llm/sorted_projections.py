"""Near-duplicate vectors by sorted projection passes.

Each pass hashes all vectors with its own random projections, orders them by the concatenated hashes, and compares
each with a bounded window of neighbours in that order. Similar vectors agree in each hash with a high probability, so
that they come to lie side by side in some pass. Verified pairs of all passes are united to components. Windows bound
how many partners a pass compares; inside each component all pairs are therefore compared once more, in blocks, so
that its links are counted whole however large it is. Pairs are counted and never emitted.

A pair whose windows never meet is lost only if nothing else joins its components. The more rows there are, and the
more they crowd, the less often a pair meets in one pass. So rounds of passes with new projections go on, whatever
their number, until those that follow join hardly any components.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, lean_shuffles, runs
from tablewright.llm.components import components, forest

COSINE = 0.9
PASSES = 16   # passes of a round
RECALL = 0.999  # share of the joins between components that should be found when rounds end
QUIET = 2     # rounds in a row that must say so
BITS = 128    # hashes that are concatenated, each the side of a random hyperplane
WINDOW = 24   # neighbours that follow a vector in the order of a pass
BLOCK = 512   # vectors of a component that are compared as one block


@functools.lru_cache(maxsize=8)
def _planes(size: int, turn: int) -> np.ndarray:
    return np.random.default_rng([size, turn]).standard_normal((size, PASSES * BITS))


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of a batch, all of one length, scaled to length 1 in double precision."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _by_length(batch: pa.RecordBatch, column: str):
    """Slices of a batch by the length of its vectors."""
    sizes = np.array([len(x) for x in batch.column(column)])
    for size in np.unique(sizes):
        yield int(size), batch.take(pa.array(np.flatnonzero(sizes == size)))


def _hashed(vectors: DataFrame, turn: int) -> DataFrame:
    """key and place (pass, length and concatenated hashes) of each distinct vector, once per pass of a round."""

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 2048):
                for size, batch in _by_length(whole.slice(at, 2048), "embedding"):
                    sides = _matrix(batch.column("embedding")) @ _planes(size, turn) > 0
                    for p in range(PASSES):
                        bits = np.packbits(sides[:, p * BITS:(p + 1) * BITS], axis=1)
                        head = np.array([p], ">u2").tobytes() + np.array([size], ">u4").tobytes()
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([head + b.tobytes() for b in bits], pa.binary()), batch.column("key"),
                             batch.column("embedding")], names=["place", "key", "embedding"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select("key", "embedding").mapInArrow(run, f"place binary, key string, embedding {kind}")


def _neighbours(hashed: DataFrame) -> DataFrame:
    """Edges (a, b) between vectors that a window finds similar, and the rows at both ends of each task (edge of b null).

    Tasks hold ranges of the order. What lies across the end of one is compared by `_across`.
    """
    kind = hashed.schema["embedding"].dataType.simpleString()

    def compare(batch):
        out = []
        places = batch.column("place").to_pylist()
        head = np.array([hash(p[:6]) for p in places], np.int64)
        for start, end in runs(head):
            unit = _matrix(batch.column("embedding").slice(start, end - start))
            left, right = [], []
            for step in range(1, min(WINDOW, end - start - 1) + 1):
                close = np.flatnonzero(np.einsum("ij,ij->i", unit[:-step], unit[step:]) >= COSINE)
                left.append(close)
                right.append(close + step)
            if left:
                root = forest(end - start, np.concatenate(left), np.concatenate(right))
                linked = np.flatnonzero(root != np.arange(end - start))
                out.append((start + linked, start + root[linked]))
        return out

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        kept, first = None, True
        for whole in batches:
            for at in range(0, len(whole), 4096):
                batch = whole.slice(at, 4096)
                if first:
                    yield ends(batch.slice(0, WINDOW), task - 1, 1)
                    first = False
                batch = batch if kept is None else pa.concat_batches([kept, batch])
                names = batch.column("key")
                for a, b in compare(batch):
                    yield rows(names.take(a), names.take(b))
                kept = batch.slice(max(0, len(batch) - WINDOW))
        if kept is not None:
            yield ends(kept, task, 0)

    def rows(a, b):
        n = len(a)
        return pa.RecordBatch.from_arrays(
            [a, b, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, inner)],
            names=["a", "b", "seam", "side", "place", "embedding"])

    def ends(batch, seam, side):
        n = len(batch)
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.nulls(n, pa.string()), pa.array(np.full(n, seam)), pa.array(np.full(n, side)),
             batch.column("place"), batch.column("embedding")],
            names=["a", "b", "seam", "side", "place", "embedding"])

    inner = pa.list_(pa.float32() if "float" in kind else pa.float64())
    schema = f"a string, b string, seam long, side long, place binary, embedding {kind}"
    found = cut(hashed.repartitionByRange("place", "key").sortWithinPartitions("place", "key").mapInArrow(run, schema),
                "windows")

    def across(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("side", "ascending"), ("place", "ascending"), ("a", "ascending")])
        batch = table.select(["place", "a", "embedding"]).to_batches()[0]
        names = batch.column("a")
        found = compare(batch)
        return pa.table({
            "a": pa.concat_arrays([names.take(a) for a, _ in found]) if found else pa.array([], pa.string()),
            "b": pa.concat_arrays([names.take(b) for _, b in found]) if found else pa.array([], pa.string())})

    seams = found.filter("seam IS NOT NULL").groupBy("seam").applyInArrow(across, "a string, b string")
    return found.filter("b IS NOT NULL").select("a", "b").unionByName(seams)


def _groups(distinct: DataFrame) -> DataFrame:
    """id and root of every vector that a window has linked: rounds go on until few joins are left to find.

    What is left is estimated from the joins that the last two rounds added, as a geometric series.
    """
    groups, joins, before, quiet, turn = None, 0, 0, 0, 0
    while quiet < QUIET:
        edges = _neighbours(_hashed(distinct, turn))
        if groups is not None:
            edges = edges.unionByName(groups.select(F.col("id").alias("a"), F.col("root").alias("b")))
        groups = components(edges)
        found = groups.agg(F.count(F.lit(1)) - F.count_distinct("root")).first()[0]
        added, joins = found - joins, found
        left = added * max(1.0, added / (before - added)) if added < before else float(added and np.inf)
        quiet = quiet + 1 if turn and left <= (1 - RECALL) * joins else 0
        before, turn = added, turn + 1
    return groups


def _count_links(members: DataFrame) -> DataFrame:
    """key and weight: rows of linked vectors of the same component (key, root, copies, embedding)."""
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    dealt = members.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "key", "copies", "embedding")

    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, copies = table.column("block").to_numpy(), table.column("copies").to_numpy()
        unit = _matrix(table.column("embedding").chunk(0))
        top, bottom = np.flatnonzero(block == i), np.flatnonzero(block == j)
        weight = np.zeros(len(unit), np.int64)
        for at in range(0, len(top), BLOCK):
            part = top[at:at + BLOCK]
            close = unit[part] @ unit[bottom].T >= COSINE
            if i == j:
                close[np.arange(len(part)), np.arange(at, at + len(part))] = False
            weight[part] += close @ copies[bottom]
            if i != j:
                weight[bottom] += copies[part] @ close
        return pa.table({"key": table.column("key"), "weight": pa.array(weight)})

    return dealt.groupBy("root", "i", "j").applyInArrow(links, "key string, weight long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors` (vec_id, embedding).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, and vectors of
    different lengths do not link. Equal vectors are compared as one and linked with each other. n_links counts the
    other rows linked directly, component_id is the least vec_id reachable, kept says whether it is the row's own. Rows
    that repeat are copies of each other (several rows may then be kept). Other columns are ignored.
    """
    lean_shuffles(vectors.sparkSession)
    vector = F.col("embedding")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))
    # -0.0 becomes 0.0
    plain = F.transform(vector, lambda x: F.when(x == 0, F.lit(0)).otherwise(x)).cast(vectors.schema["embedding"].dataType)
    key = F.concat(F.lpad(F.hex(F.xxhash64(F.lit(1), plain)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit(2), plain)), 16, "0"))
    rows = vectors.select("vec_id", F.when(usable, key).alias("key"), F.when(usable, plain).alias("embedding"))
    distinct = cut(rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")), "vectors")

    groups = _groups(distinct).withColumnsRenamed({"id": "key"})
    members = groups.join(distinct, "key")
    weights = _count_links(members).groupBy("key").agg(F.sum("weight").alias("weight"))
    heads = members.groupBy("root").agg(F.min("least").alias("head"))
    placed = groups.join(heads, "root").join(weights, "key")
    named = distinct.select("key", "least", "copies").join(placed, "key", "left").select(
        "key", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("links"),
        F.coalesce("head", "least").alias("head"))
    out = rows.select("vec_id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("head"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
