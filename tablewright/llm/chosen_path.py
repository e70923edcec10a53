"""Set similarity join on word shingles by chosen paths: pairs of texts whose Jaccard similarity reaches a bound.

Each text is the set of its runs of five words, embedded as 64 tokens (the least hash under each of 64 functions), so
that two sets share a token with a probability equal to their similarity. A run sends every set to the bucket of one
of its tokens. Small buckets are compared all against all by their tokens. In a large one every set is compared with a
few pivots; sets that agree with a pivot are candidates through it and need not meet again. If sets agree with the
pivots about as well as candidates do, splitting would not part them: the bucket is compared all against all, as one
group of candidates. What else it holds is split by further tokens, each taken with a probability that gives a set
1 / similarity children on average: two sets at the bound have one in common, and rows grow by a quarter a level, however
large the bucket is. Runs are repeated until the chance that a pair at the bound meets in none is below 1 - RECALL, more
of them for sets that were split more often.

What this leaves as candidates, connected, is verified on whole sets: inside each component of candidates all pairs are
compared exactly, by blocks, counted, and never emitted.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, lean_batches, lean_shuffles, pieces, utf8
from tablewright.llm.components import components, forest
from tablewright.llm.shingles import mix, shingle_hashes

SIMILARITY = 0.8
RECALL = 0.9995
TOKENS = 64           # tokens that embed a set
LIKELY = 38           # candidates share at least so many (a pair at the bound shares 51 +- 3.2)
LIMIT = 1024          # sets in a bucket that is compared all against all
PIVOTS = 4            # sets of a larger bucket that all others are compared with
DENSE = 0.5           # share of tokens that sets have in common with the pivots, on average, in a bucket not worth splitting
BLOCK_SETS = 512      # sets of a component in a block, as long as SIDES blocks are enough
SIDES = 8             # copies of a set that its comparisons take, unless blocks outgrow the memory of a task
BLOCK_SHINGLES = 1_000_000  # 8 MB, and some ten times that while two blocks are compared
MOST_SETS = 8192
CHUNK_SETS = 1024     # sets that are compared with a block at once
FEW = 300_000         # members sent to all executors to fetch their texts; more are joined by a shuffle
_SEEDS = np.random.default_rng(9).integers(1 << 62, size=(2, TOKENS), dtype=np.uint64) * 2 + 1


def embed(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), set1 and set2 (hash of the shingle set; null without words), n, tokens."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in pieces(batches, "text", 1 << 20):
            hashes, counts = shingle_hashes(*utf8(batch.column("text")))
            n, set1, set2 = (np.zeros(len(counts), np.int64) for _ in range(3))
            tokens = np.zeros((len(counts), TOKENS), np.uint32)
            some = np.flatnonzero(counts)
            if len(some):
                ends = np.cumsum(counts)
                begins = ends - counts
                for i in some:
                    own = np.unique(hashes[begins[i]:ends[i]])
                    n[i] = len(own)
                    set1[i] = own.sum(dtype=np.uint64).astype(np.int64)
                    set2[i] = mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)
                for t in range(TOKENS):
                    turned = ((hashes * _SEEDS[0, t] + _SEEDS[1, t]) >> np.uint64(32)).astype(np.uint32)
                    tokens[some, t] = np.minimum.reduceat(turned, begins[some])
            blank = counts == 0
            rows = [t.tobytes() for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(set1, mask=blank), pa.array(set2, mask=blank),
                 pa.array(n), pa.array(rows, pa.binary())],
                names=["doc_id", "mark", "set1", "set2", "n", "tokens"])

    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return marked.mapInArrow(run, f"doc_id {kind}, mark long, set1 long, set2 long, n long, tokens binary")


def _token(place: Column | int) -> Column:
    place = F.lit(place) if isinstance(place, int) else place
    return F.substring(F.col("tokens"), (place * 4 + 1).cast("int"), F.lit(4))


def _runs_needed(depth: int) -> int:
    """Runs after which a pair at the bound that is split `depth` times in each has met with probability RECALL.

    A run that begins with a token both have keeps them together at each split with the chance that one of a Poisson
    number (mean 1) of children they have in common does.
    """
    met = 1.0
    for _ in range(depth):
        met = 1 - math.exp(-met)
    return math.ceil(math.log(1 - RECALL) / math.log(1 - SIMILARITY * met))


def _candidates(classes: DataFrame) -> DataFrame:
    """Edges (a, b) between classes whose tokens agree well."""
    edges: list[DataFrame] = []
    deepest = _run(classes.select("class", "n", "tokens", F.lit(0).alias("first"), F.lit(_runs_needed(0)).alias("last")), edges)
    while deepest is not None:
        needed = F.element_at(F.array(*[F.lit(_runs_needed(d)) for d in range(65)]), F.least("depth", F.lit(64)) + 1)
        again = cut(deepest.select("class", F.col("last").alias("first"), needed.alias("last")).filter("last > first"), "again")
        if again.isEmpty():
            break
        deepest = _run(cut(again.join(classes.select("class", "n", "tokens"), "class"), "again"), edges)
    return reduce(DataFrame.unionByName, edges)


def _run(classes: DataFrame, edges: list[DataFrame]) -> DataFrame | None:
    """Runs `first` to `last` - 1 of each class; adds the edges found and returns how deep classes were split.

    class, last and depth of those that were; none if no bucket was large.
    """
    classes = classes.select("class", "n", "tokens", "first", "last")
    tokens = classes.select("class", "n", "tokens")
    path = F.xxhash64(F.col("step"), _token(F.pmod("step", F.lit(TOKENS))))
    level = classes.select("class", "last", "tokens", F.explode(F.sequence("first", F.col("last") - 1)).alias("step"))
    level = level.select(path.alias("path"), "class", "last", F.lit(None).cast("string").alias("settled"))
    split: list[DataFrame] = []
    while True:
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size"), _one_candidate().alias("done"))
        sizes = sizes.filter("size > 1 AND NOT done").drop("done")
        met = cut(level.join(sizes, "path").join(tokens, "class"), "paths")
        edges.append(cut(_compare(met.filter(F.col("size") <= LIMIT).select("path", "class", "n", "tokens")), "near"))
        large = met.filter(F.col("size") > LIMIT)
        if large.isEmpty():
            break
        rank = [F.min(F.struct(F.xxhash64(F.lit(i), "path", "class").alias("rank"), "class", "n", "tokens")) for i in range(PIVOTS)]
        chance = F.lit(1 / (SIMILARITY * TOKENS))
        taken = F.filter(F.sequence(F.lit(0), F.lit(TOKENS - 1)),
                         lambda i: F.pmod(F.xxhash64("path", i), F.lit(1 << 30)) < chance * F.lit(1 << 30))
        chosen = large.groupBy("path").agg(F.array(*rank).alias("pivots")).withColumn("steps", taken)
        placed = cut(_settle(large.join(chosen, "path")), "settled")
        edges.append(placed.filter("pivot <> class").select(F.col("class").alias("a"), F.col("pivot").alias("b")))
        state = placed.groupBy("path").agg(
            _one_candidate().alias("done"), (F.avg("alike") >= DENSE).alias("dense"), F.min("class").alias("least"))
        placed = cut(placed.drop("pivot", "alike").join(state.filter("NOT done"), "path"), "mixed")
        edges.append(placed.filter("dense").select(F.col("class").alias("a"), F.col("least").alias("b")))
        placed = placed.filter("NOT dense")
        split.append(placed.select("class", "last", F.lit(len(split) + 1).alias("depth")))
        below = placed.select("path", "class", "last", "settled", "tokens", F.explode("steps").alias("step"))
        level = below.select(F.xxhash64("path", "step", _token(F.col("step"))).alias("path"), "class", "last", "settled")
    if not split:
        return None
    return reduce(DataFrame.unionByName, split).groupBy("class").agg(F.max("last").alias("last"), F.max("depth").alias("depth"))


def _one_candidate() -> Column:
    """Whether all sets of a bucket agree with the same pivot: it holds no pair that is not a candidate yet."""
    return F.every(F.col("settled").isNotNull()) & F.coalesce(F.min("settled") == F.max("settled"), F.lit(False))


def _settle(rows: DataFrame) -> DataFrame:
    """The rows with `pivot`, the first one of the bucket that a set agrees with (itself, if it is one).

    settled is the first pivot that it agreed with on its path, alike the share of tokens it has in common with the
    pivots.
    """

    def run(batches):
        for batch in batches:
            mine = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
            n = batch.column("n").to_numpy()
            pivots = batch.column("pivots").flatten()
            theirs = np.frombuffer(b"".join(pivots.field("tokens").to_pylist()), np.uint32).reshape(-1, PIVOTS, TOKENS)
            size = pivots.field("n").to_numpy().reshape(-1, PIVOTS)
            shared = (mine[:, None, :] == theirs).sum(axis=2)
            near = np.minimum(n[:, None], size) >= SIMILARITY * np.maximum(n[:, None], size) - 1e-9
            near &= shared >= LIKELY
            which = np.arange(len(n)) * PIVOTS + near.argmax(axis=1)
            pivot = pivots.field("class").take(pa.array(which, mask=~near.any(axis=1)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("path", "class", "last", "tokens", "steps", "settled")), pivot,
                 pa.array(shared.mean(axis=1) / TOKENS)],
                names=["path", "class", "last", "tokens", "steps", "settled", "pivot", "alike"])

    rows = rows.select("path", "class", "last", "n", "tokens", "steps", "settled", "pivots")
    out = rows.mapInArrow(
        run, "path long, class string, last int, tokens binary, steps array<int>, settled string, pivot string, alike double")
    return out.withColumn("settled", F.coalesce("settled", "pivot"))


def _compare(rows: DataFrame) -> DataFrame:
    """All pairs of each bucket, by their tokens and sizes; a task emits one edge per set at most for a bucket."""

    def run(batches):
        kept = None
        for batch in batches:
            kept = batch if kept is None else pa.concat_batches([kept, batch])
            path = kept.column("path").to_numpy()
            done = int(np.searchsorted(path, path[-1])) if len(path) else 0
            if done:
                yield from pairs(kept.slice(0, done))
                kept = kept.slice(done)
        if kept is not None and len(kept):
            yield from pairs(kept)

    def pairs(batch):
        path, n = batch.column("path").to_numpy(), batch.column("n").to_numpy()
        names = batch.column("class")
        tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(-1, TOKENS)
        left, right = [], []
        base = np.arange(len(path))
        for step in range(1, 2 * LIMIT):
            base = base[base < len(path) - step]
            base = base[path[base] == path[base + step]]
            if not len(base):
                break
            for part in np.array_split(base, len(base) // 65536 + 1):
                a, b = n[part], n[part + step]
                close = part[np.minimum(a, b) >= SIMILARITY * np.maximum(a, b) - 1e-9]
                alike = close[(tokens[close] == tokens[close + step]).sum(axis=1) >= LIKELY]
                left.append(alike)
                right.append(alike + step)
        if left:
            root = forest(len(path), np.concatenate(left), np.concatenate(right))
            linked = np.flatnonzero(root != np.arange(len(path)))
            yield pa.RecordBatch.from_arrays([names.take(linked), names.take(root[linked])], names=["a", "b"])

    return rows.repartition("path").sortWithinPartitions("path").mapInArrow(run, "a string, b string")


def _verify(members: DataFrame) -> DataFrame:
    """class, parent, weight per task that held it: exact links inside components of candidates.

    `members` has class, root, copies, n and text. The sets of a component are dealt to blocks by a hash, and each pair
    of blocks is one group; the weight counts documents of linked classes. A component has few, large blocks, so that
    a set is copied SIDES times at most, until blocks would outgrow a task.
    """
    salt = F.pmod(F.xxhash64("class"), F.lit(64))
    sizes = members.groupBy("root").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("sets"))
    wide = F.least(F.ceil(F.col("sets") / BLOCK_SETS), F.lit(SIDES))
    blocks = F.greatest(wide, F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("sets") / MOST_SETS)).cast("long")
    # a component that holds a third of all sets meets its size in many tasks
    sizes = sizes.select("root", blocks.alias("blocks"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("salt"))

    def sets(batches):
        for batch in pieces(batches, "text", 1 << 20):
            hashes, counts = shingle_hashes(*utf8(batch.column("text")))
            own = np.split(hashes, np.cumsum(counts)[:-1])
            rows = pa.array([np.unique(x).tobytes() for x in own], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("class", "root", "copies")), rows],
                names=["class", "root", "copies", "shingles"])

    made = members.select("class", "root", "copies", "text").mapInArrow(
        sets, "class string, root string, copies long, shingles binary")
    block = F.pmod(F.xxhash64(F.lit(1), "class"), F.col("blocks"))
    dealt = made.withColumn("salt", salt.cast("int")).join(sizes, ["root", "salt"]).withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "class", "copies", "shingles")

    def links(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = np.array(table.column("class").to_pylist(), object)
        _, once = np.unique(names, return_index=True)
        names, copies = names[once], table.column("copies").to_numpy()[once]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block = table.column("block").to_numpy()[once]
        rows = table.column("shingles").to_pylist()
        own = [np.frombuffer(rows[k], np.uint64) for k in once]
        size = np.array([len(x) for x in own], np.int64)
        _, token, often = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(own)), size)
        shared = often[token] > 1
        token, owner = np.unique(token[shared], return_inverse=True)[1], owner[shared]
        top, bottom = np.flatnonzero(block == i), np.flatnonzero(block == j)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        weight, pairs = np.zeros(len(own), np.int64), []
        for at in range(0, len(top), CHUNK_SETS):
            part = top[at:at + CHUNK_SETS]
            close = _close(part, bottom, size, token, owner)
            close &= part[:, None] != bottom[None, :]
            weight[part] += close @ copies[bottom]
            if i != j:
                weight[bottom] += close.T @ copies[part]
            a, b = np.nonzero(close)
            root = forest(len(own), part[a], bottom[b])
            pairs.append((np.flatnonzero(root != np.arange(len(own))), root))
        left = np.concatenate([a for a, _ in pairs])
        root = forest(len(own), left, np.concatenate([r[a] for a, r in pairs]))
        linked = np.flatnonzero(weight)
        return pa.table({"class": pa.array(names[linked], pa.string()), "parent": pa.array(names[root[linked]], pa.string()),
                         "weight": pa.array(weight[linked], pa.int64())})

    # by number, so that small but laborious groups are not put together into few tasks
    dealt = dealt.repartition(4 * members.sparkSession.sparkContext.defaultParallelism, "root", "i", "j")
    return dealt.groupBy("root", "i", "j").applyInArrow(links, "class string, parent string, weight long")


def _close(top: np.ndarray, bottom: np.ndarray, size: np.ndarray, token: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which sets of `top` and `bottom` reach the similarity; `owner` holds `token`, in the order of tokens."""
    common = np.zeros((len(top), len(bottom)), np.float32)
    place = np.full((2, len(size)), -1)
    place[0, top], place[1, bottom] = np.arange(len(top)), np.arange(len(bottom))
    both = np.zeros((2, int(token[-1]) + 1 if len(token) else 0), bool)
    both[0, token[place[0, owner] >= 0]] = both[1, token[place[1, owner] >= 0]] = True
    inside = both.all(axis=0)[token]
    token, owner = np.unique(token[inside], return_inverse=True)[1], owner[inside]
    width = max(1, (4 << 20) // (len(top) + len(bottom)))
    for begin in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, (begin, begin + width))
        sides = []
        for place_of, n in ((place[0], len(top)), (place[1], len(bottom))):
            dense, rows = np.zeros((n, width), np.float32), place_of[owner[a:b]]
            dense[rows[rows >= 0], token[a:b][rows >= 0] - begin] = 1
            sides.append(dense)
        common += sides[0] @ sides[1].T
    either = size[top][:, None] + size[bottom][None, :] - common
    return (common >= SIMILARITY * either - 1e-6) & (common > 0)


def similarity_join(docs: DataFrame) -> DataFrame:
    """doc_id, mark, class_id, group_id, n_links and kept for every row of `docs` (doc_id, text).

    class_id is the least doc_id (null first) among rows with the same shingle set, group_id the least one that links lead to,
    n_links the number of other rows whose set has a similarity of at least 0.8 (copies included), kept whether the
    row is the one that stays of its group (doc_id = group_id and the class of least text hash). mark is the xxhash64
    of the text. Null and wordless texts link with nothing. Rows that repeat are copies of each other: each gets a
    row, with the same result. Other columns are ignored.
    """
    lean_shuffles(docs.sparkSession)
    lean_batches(docs.sparkSession)
    rows = cut(embed(docs), "sets")
    name = F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("set1", "set2")])
    classes = rows.filter("n > 0").groupBy(name.alias("class")).agg(
        F.min(F.struct("doc_id", "mark")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = cut(classes, "classes")

    found = components(_candidates(classes)).withColumnsRenamed({"id": "class"})
    keyed = cut(found.join(classes.select("class", "first", "copies", "n"), "class").select(
        "class", "root", "copies", "n", F.col("first.doc_id").alias("key"), F.col("first.mark").alias("mark")), "members")
    members = F.broadcast(keyed) if keyed.count() <= FEW else keyed
    same = F.col("doc_id").eqNullSafe(F.col("key")) & (F.xxhash64("text") == F.col("mark"))
    # rows that repeat hold the text of their class several times
    texts = docs.select("doc_id", "text").join(members, same).groupBy("class").agg(
        *[F.first(c).alias(c) for c in ("root", "copies", "n", "text")])
    checked = cut(_verify(texts), "links")

    groups = components(checked.select(F.col("class").alias("a"), F.col("parent").alias("b")))
    weights = checked.groupBy("class").agg(F.sum("weight").alias("weight"))
    placed = classes.select("class", "first", "copies").join(weights, "class", "left").join(
        groups.withColumnsRenamed({"id": "class"}), "class", "left")
    placed = cut(placed.select("class", "first", "copies", F.coalesce("weight", F.lit(0)).alias("weight"),
                               F.coalesce("root", "class").alias("root")), "placed")
    least = placed.groupBy("root").agg(F.min("first").alias("head"))
    named = placed.join(least, "root").select(
        "class", F.col("first.doc_id").alias("class_id"), F.col("head.doc_id").alias("group_id"),
        F.col("head.mark").alias("head_mark"), (F.col("copies") - 1 + F.col("weight")).alias("links"))
    out = rows.select("doc_id", "mark", F.when(F.col("n") > 0, name).alias("class")).join(named, "class", "left")
    alone = F.col("class_id").isNull() & F.col("links").isNull()
    return out.select(
        "doc_id", "mark", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("group_id")) & (F.col("mark") == F.col("head_mark")))).alias("kept"))
