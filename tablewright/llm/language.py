"""Language identification by cross parsing: the language whose sample text covers a text in fewest phrases, weighed by the size of
its sample, wins.

A suffix automaton of labelled text per language answers how far a phrase can be extended so that it still occurs in
that language's sample. A text is cut greedily into such longest phrases. Its cross entropy is the number of phrases
times the cost of one, about the logarithm of the sample's length: a small sample has fewer phrases to offer. The automata are tables of state and letter class, so that
all texts of a batch step through them together, four or more languages side by side.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import lean_batches, pieces, within

SAMPLE_ROWS = 64      # labelled rows per language that the model learns from, ...
SAMPLE_LETTERS = 256  # ... and characters of each
STRETCH = 1024        # a long text is parsed in stretches of so many characters, side by side
LETTERS = 64          # a phrase is one of the places in the sample, or one of about so many letters
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Sample text per language, in the folded alphabet of `fold_text`."""

    samples: tuple[tuple[str, str], ...]


@functools.lru_cache(maxsize=1)
def _folding() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its lower-case letter, or a space if it is no letter; and whether it is a letter."""
    fold, letter = np.full(0x110000, 32, np.uint32), np.zeros(0x110000, bool)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            fold[code], letter[code] = ord(lower[0]), True
    return fold, letter


def fold_codes(text: str) -> np.ndarray:
    """Lower-case letters of a text as code points, any run of other characters as one space."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    folded = _folding()[0][codes]
    space = folded == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    return folded[keep]


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, letters: int = SAMPLE_LETTERS) -> LanguageModel:
    """Learn from a bounded sample of the labelled rows (text, lang): `rows` per language, `letters` of each.

    The sample is the rows of least hash of their text, so that it does not depend on how rows are partitioned, and
    copies of a text count once; rows without a letter in that part do not count. Only rows under a bound on the hash,
    set from the counts per language, are ordered, and `rows` of a language at most reach the driver; if copies leave
    a language short, the bound grows fourfold.
    """
    labelled = docs.filter("lang IS NOT NULL").select("lang", "text", F.substring("text", 1, letters).alias("part"))
    labelled = labelled.filter(F.col("part").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    chosen: dict[str, list[str]] = {}
    share, mark = 4.0, F.crc32(F.md5(F.col("text")))
    while counts.keys() - chosen.keys():
        bounds = {x: min(1.0, share * rows / n) for x, n in counts.items() if x not in chosen}
        bound = F.element_at(F.create_map(*[F.lit(v) for kv in bounds.items() for v in kv]), F.col("lang"))
        drawn = (
            labelled.filter(mark / 2.0**32 < bound).groupBy("lang", F.col("part").alias("text"))
            .agg(F.min(mark).alias("mark")).withColumn("n", F.row_number().over(
                Window.partitionBy("lang").orderBy("mark", "text"))).filter(F.col("n") <= rows))
        found: dict[str, list[str]] = {x: [] for x in bounds}
        for row in sorted(drawn.collect(), key=lambda r: r["n"]):
            folded = fold_codes(row["text"])
            if (folded != 32).any():
                found[row["lang"]].append(folded.astype(np.uint32).tobytes().decode("utf-32-le"))
        for lang, texts in found.items():
            if len(texts) >= rows or bounds[lang] >= 1.0:
                chosen[lang] = texts[:rows]
        share *= 4
    samples = tuple((x, "\n".join(texts)) for x, texts in sorted(chosen.items()) if texts)
    return LanguageModel(samples)


def suffix_automaton(text: str, alphabet: dict[str, int]) -> np.ndarray:
    """Transitions of the automaton of all substrings: state x class -> state, -1 where no substring goes on.

    Class 0 stands for characters outside the alphabet; a line break ends a substring.
    """
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for char in text:
        if char == "\n":
            last = 0
            continue
        c = alphabet[char]
        if c in nexts[last]:  # already a substring from here: reuse or split, as texts are added one after another
            q = nexts[last][c]
            if length[q] == length[last] + 1:
                last = q
                continue
            copy = len(nexts)
            nexts.append(dict(nexts[q]))
            link.append(link[q])
            length.append(length[last] + 1)
            p = last
            while p >= 0 and nexts[p].get(c) == q:
                nexts[p][c] = copy
                p = link[p]
            link[q] = copy
            last = copy
            continue
        new, p = len(nexts), last
        nexts.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = new
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(nexts), len(alphabet) + 1), -1, np.int32)
    for state, out in enumerate(nexts):
        for c, target in out.items():
            table[state, c] = target
    return table


class Parser:
    """The automata of a model, ready to parse batches of texts."""

    def __init__(self, model: LanguageModel):
        self.names = [x for x, _ in model.samples]
        chars = sorted({c for _, t in model.samples for c in t} - {"\n"})
        alphabet = {c: i + 1 for i, c in enumerate(chars)}
        self.width = len(alphabet) + 1
        self.costs = np.log([LETTERS + len(t.replace("\n", "")) for _, t in model.samples])
        self.classes = np.zeros(0x110000, np.uint16)
        for c, i in alphabet.items():
            self.classes[ord(c)] = i
        self.tables, self.roots = [], []
        for _, text in model.samples:
            # a last state that nothing leaves: where texts begin, and a phrase of one unknown character ends. A step
            # that ends a phrase is coded as the state that its character leads to from the root, negated
            table = suffix_automaton(text, alphabet)
            table = np.vstack([table, np.full((1, self.width), -1, np.int32)])
            fresh = np.where(table[0] >= 0, table[0], len(table) - 1)
            self.tables.append(np.where(table >= 0, table, -1 - fresh[None, :]).astype(np.int32).ravel())

    def phrases(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: phrases under each language, characters parsed, and whether it holds a letter."""
        fold, letter = _folding()
        joined = [t or "" for t in texts.to_pylist()]
        sizes = np.array([len(t) for t in joined], np.int64)
        codes = np.frombuffer("".join(joined).encode("utf-32-le", "replace"), np.uint32)
        owner = np.repeat(np.arange(len(joined), dtype=np.int32), sizes)
        folded, known = fold[codes], letter[codes]
        keep = known.copy()
        keep[1:] |= known[:-1] & (owner[1:] == owner[:-1])
        has = np.bincount(owner[known], minlength=len(joined)) > 0
        symbols, owner = self.classes[folded[keep]], owner[keep]
        count = np.bincount(owner, minlength=len(joined)) if len(owner) else np.zeros(len(joined), np.int64)

        parts = -(-count // STRETCH)
        of = np.repeat(np.arange(len(joined)), parts)
        place = within(parts)
        begin = np.repeat(np.cumsum(count) - count, parts) + place * STRETCH
        size = np.minimum(STRETCH, np.repeat(count, parts) - place * STRETCH)
        order = np.argsort(-size, kind="stable")
        begin, size, of = begin[order], size[order], of[order]
        totals = np.zeros((len(self.names), len(joined)), np.int64)
        if len(size):
            live = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
            for k, table in enumerate(self.tables):
                state = np.full(len(size), len(table) // self.width - 1, np.int64)
                ends = np.zeros(len(size), np.int64)
                for step in range(size[0]):
                    n = live[step]
                    to = table[state[:n] * self.width + symbols[begin[:n] + step]]
                    over = to < 0
                    ends[:n] += over
                    state[:n] = to ^ -over.astype(np.int32)
                totals[k] = np.bincount(of, ends, minlength=len(joined)).astype(np.int64)
        return totals, count, has


@functools.lru_cache(maxsize=1)
def _parser(model: LanguageModel) -> Parser:
    return Parser(model)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of `docs` with lang_pred and score; only text decides.

    Whole texts are parsed. `und` with score 0.0 where text is null or has no letter, or nothing was learned. The
    score is how much less the winner's phrases cost (their number times the logarithm of the sample's size) than the
    next language's, as a share (1.0 with one language); equal costs go to the first name. Columns lang_pred and score that `docs` has are replaced.
    """
    lean_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        parser = _parser(shipped.value)
        names = np.array([*parser.names, UNKNOWN], object)
        for batch in pieces(batches, "text", 3 << 19):
            totals, _, has = parser.phrases(batch.column("text"))
            if len(parser.names):
                costs = totals * parser.costs[:, None]
                best = costs.argmin(axis=0)
                ordered = np.sort(costs, axis=0)
                score = np.ones(len(batch)) if len(costs) == 1 else 1 - ordered[0] / np.maximum(ordered[1], 1)
            else:
                best, score = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            best = np.where(has, best, len(parser.names))
            score = np.where(has & (len(parser.names) > 0), score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best], pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def with_hold_out(docs: DataFrame) -> DataFrame:
    """held_out: whether crc32 of doc_id as text leaves 0 modulo 5; a null doc_id is not held out."""
    left = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return docs.withColumn("held_out", F.coalesce(left == 0, F.lit(False)))
