"""SentencePiece models on the tokenizers library: the model file is parsed and rebuilt, then run in batches."""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tablewright.llm.common import lean_batches, pieces, runs, utf8

# fixed values of the model format: kinds of pieces, kinds of models, the marker of a space
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
BYTE_PIECE = re.compile("<0x([0-9A-Fa-f]{2})>")

SLICE_BYTES = 1 << 17  # of text that is encoded at once: the library holds some 80 bytes for each of them meanwhile
WORD_BYTES = 1 << 22  # of text whose words are encoded once, where words can be encoded apart
RUN_BYTES = 1 << 10  # of such words that the library gets as one text


@dataclass
class PieceModel:
    """What a model file says about encoding."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim_spaces: bool = True
    mark_spaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protobuf message; 4- and 8-byte values come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire)
        if wire == 2:
            size = varint()
        if size is None or at + size > len(data):
            raise ValueError("not a SentencePiece model")
        yield tag >> 3, data[at:at + size]
        at += size


def parse_model(data: bytes) -> PieceModel:
    """Pieces, trainer and normalizer settings of a model file; fields that encoding does not need are skipped."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            part = dict(_fields(value))
            score = struct.unpack("<f", part[2])[0] if 2 in part else 0.0
            model.pieces.append((part.get(1, b"").decode("utf-8"), score, part.get(3, NORMAL)))
        elif number == 2:
            part = dict(_fields(value))
            model.kind, model.byte_fallback = part.get(3, UNIGRAM), bool(part.get(35, 0))
            if part.get(24):
                raise ValueError("models that mark spaces at the end of words are not supported")
        elif number == 3:
            part = dict(_fields(value))
            model.charsmap = part.get(2, b"")
            model.dummy_prefix, model.trim_spaces, model.mark_spaces = (bool(part.get(k, 1)) for k in (3, 4, 5))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def merge_ranks(model: PieceModel) -> list[tuple[str, str]]:
    """The merges a BPE model implies: each way to join two pieces to a third, best scored third first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, index in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-model.pieces[index][1], left, right))
    return [(model.pieces[a][0], model.pieces[b][0]) for _, a, b in sorted(found)]


def build_tokenizer(model: PieceModel):
    """The tokenizer of the `tokenizers` library that gives the model's ids."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == BPE:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)}, merges=merge_ranks(model),
            unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE if model.mark_spaces else " "))
    if model.mark_spaces:
        steps.append(normalizers.Replace(" ", SPACE))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.add_tokens([AddedToken(p, normalized=True) for p, _, kind in model.pieces if kind == USER_DEFINED])
    back = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(back)
    tokenizer.encode_special_tokens = True
    return tokenizer


class Shipped(NamedTuple):
    tokenizer: str  # as JSON
    prefix: str = ""  # before each text that is not empty
    space: str = " "  # what stands for a space
    by_words: bool = False  # whether the ids of a text are those of its words, one after another


def _apart(model: PieceModel, space: str) -> bool:
    """Whether no merge joins a space to what is before it, and every piece tells how many bytes of text it stands for."""
    names = {p for p, _, _ in model.pieces}
    whole = {p for p, _, kind in model.pieces if kind == BYTE} >= {f"<0x{b:02X}>" for b in range(256)}
    return (model.kind == BPE and model.byte_fallback and whole and space in names
            and not any(re.search(f"[^{space}]{space}", p, re.DOTALL) for p in names))


def _without_spaces(model: PieceModel) -> Shipped:
    """The tokenizer, and the steps on spaces it leaves to `_ids` where nothing else normalizes texts.

    The library keeps the origin of each byte through such steps, which costs as much as a fifth of encoding.
    """
    from tokenizers import normalizers

    built = build_tokenizer(model)
    if model.charsmap or model.trim_spaces or any(kind == USER_DEFINED for _, _, kind in model.pieces):
        return Shipped(built.to_str())
    built.normalizer = normalizers.Sequence([])
    space = SPACE if model.mark_spaces else " "
    return Shipped(built.to_str(), space if model.dummy_prefix else "", space, _apart(model, space))


@functools.lru_cache(maxsize=1)
def _tokenizer(serialized: str, threads: int):
    os.environ["RAYON_NUM_THREADS"], os.environ["TOKENIZERS_PARALLELISM"] = str(threads), "true"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(serialized)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _ids(shipped: Shipped, threads: int, texts: list[str]) -> list[list[int]]:
    tokenizer = _tokenizer(shipped.tokenizer, threads)
    ready = [shipped.prefix + t.replace(" ", shipped.space) if t else "" for t in texts]
    return [e.ids for e in tokenizer.encode_batch_fast(ready, add_special_tokens=False)]


def _marks(data: np.ndarray) -> np.ndarray:
    """Where the space markers end that the bytes of texts hold themselves."""
    a, b, c = SPACE.encode()
    return np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c)) + 3


def _words(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where words begin, and where the last ends: at the start of a text, and where spaces or markers begin."""
    starts, marks = data == 32, _marks(data)
    starts[1:] &= data[:-1] != 32
    starts[marks[marks < len(data)]] = False
    starts[bounds[bounds < len(data)]] = True
    return np.append(np.flatnonzero(starts), len(data))


def _ids_of_words(shipped: Shipped, threads: int, words: pa.Array) -> pa.ListArray:
    """The ids of each word. The library gets many words as one text, and the bytes its pieces stand for tell them apart.

    Words that do not begin with a space, end with one or hold a marker are texts of their own.
    """
    data, bounds = utf8(words)
    alone = (data[bounds[:-1]] != 32) | (data[bounds[1:] - 1] == 32)
    alone[np.searchsorted(bounds, _marks(data)) - 1] = True
    opens = np.append(True, alone[1:] | alone[:-1] | (np.diff(bounds[:-1] // RUN_BYTES) > 0))
    at = np.append(bounds[:-1][opens], len(data))
    found = []
    for start, end in runs(at[:-1] // SLICE_BYTES):
        texts = [data[a:b].tobytes().decode("utf-8") for a, b in zip(at[start:end], at[start + 1:end + 1])]
        found.append(pa.array(_ids(shipped._replace(prefix=""), threads, texts), pa.list_(pa.int32())))
    lists = pa.concat_arrays(found)
    ids, firsts = lists.values, lists.offsets.to_numpy()
    sizes = pc.binary_length(_spellings(shipped.tokenizer, threads)[0]).to_numpy()
    ends = np.append(0, np.cumsum(sizes[ids.to_numpy()]))
    ends = ends[1:] + np.repeat(at[:-1] - ends[firsts[:-1]], np.diff(firsts))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(ends, bounds, "right"), pa.int32()), ids)


def _encoded(shipped: Shipped, threads: int, texts: pa.Array) -> pa.ListArray:
    """The ids of every text, null counting as empty; where words can be encoded apart, each is encoded once."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if shipped.prefix and shipped.by_words:
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        texts = pc.if_else(pc.equal(texts, nothing), texts, pc.binary_join_element_wise(space, texts, nothing))
    data, bounds = utf8(texts)
    if not shipped.by_words or not len(data):
        return pa.array(_ids(shipped, threads, texts.to_pylist()), pa.list_(pa.int32()))
    at = _words(data, bounds)
    words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    words = words.dictionary_encode()
    taken = _ids_of_words(shipped, threads, words.dictionary).take(words.indices)
    firsts = taken.offsets.take(pa.array(np.searchsorted(at, bounds)))
    return pa.ListArray.from_arrays(firsts, taken.values)


def _coded(shipped: Shipped, threads: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text and ids."""
    for batch in pieces(batches, "text", WORD_BYTES if shipped.by_words else SLICE_BYTES):
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), _encoded(shipped, threads, batch.column("text"))],
            names=["doc_id", "text", "ids"])


@functools.lru_cache(maxsize=1)
def _spellings(serialized: str, threads: int) -> tuple[pa.Array, bool]:
    """The bytes each id stands for, none where there is no such piece; whether a space before the text is dropped."""
    tokenizer = _tokenizer(serialized, threads)
    ids = tokenizer.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(ids.values()) + 1)
    for piece, index in ids.items():
        byte = BYTE_PIECE.fullmatch(piece)
        spelled[index] = bytes.fromhex(byte[1]) if byte else piece.replace(SPACE, " ").encode()
    steps = json.loads(serialized)["decoder"]["decoders"]
    return pa.array(spelled, pa.large_binary()), any(s["type"] == "Strip" for s in steps)


def _texts(serialized: str, threads: int, ids: list[list[int]] | pa.ListArray) -> list[str]:
    """What the tokenizer decodes the ids to, put together from the bytes of all their pieces at once.

    Ids beyond the pieces and bytes that are no UTF-8 are left to the tokenizer itself.
    """
    tokenizer = _tokenizer(serialized, threads)
    spelled, drops_space = _spellings(serialized, threads)
    lists = ids if isinstance(ids, pa.Array) else pa.array(ids, pa.list_(pa.int64()))
    flat = lists.flatten()
    if len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < len(spelled):
        return tokenizer.decode_batch(lists.to_pylist(), skip_special_tokens=False)
    taken = spelled.take(flat)
    ends = np.cumsum(np.append(0, pc.list_value_length(lists)))
    raw = taken.buffers()[2].to_pybytes() if len(flat) else b""
    bounds = np.frombuffer(taken.buffers()[1], np.int64)[ends].tolist() if len(flat) else ends.tolist()
    texts = []
    for own, start, end in zip(lists, bounds, bounds[1:]):
        if drops_space and start < end and raw[start] == 32:
            start += 1
        try:
            texts.append(raw[start:end].decode("utf-8"))
        except UnicodeDecodeError:
            texts.append(tokenizer.decode(own.as_py(), skip_special_tokens=False))
    return texts


def _shipped(docs: DataFrame, model_file: str):
    """The tokenizer for the workers, built once from the model file."""
    lean_batches(docs.sparkSession)
    with open(model_file, "rb") as file:
        built = _without_spaces(parse_model(file.read()))
    return docs.sparkSession.sparkContext.broadcast(built)


def encode(docs: DataFrame, model_file: str, threads: int = 2) -> DataFrame:
    """doc_id and ids (array<int>) of every row's whole text; null and empty texts have no ids.

    Strings such as `<s>` are ordinary text. Rows that repeat get a row each; other columns are ignored.
    """
    shipped = _shipped(docs, model_file)

    def run(batches):
        for batch in pieces(_coded(shipped.value, threads, batches), "text", SLICE_BYTES):
            yield batch.select(["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model_file: str, threads: int = 2) -> DataFrame:
    """doc_id, ids and text of every row; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""
    shipped = _shipped(encoded, model_file)

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                ids = [x or [] for x in part.column("ids").to_pylist()]
                texts = _texts(shipped.value.tokenizer, threads, ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())],
                    names=["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def encode_and_check(docs: DataFrame, model_file: str, threads: int = 2, with_library: bool = False) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip: whether the decoded ids give the whole text again (null counts as empty).

    Encoding and decoding share one pass, so that neither texts nor ids are shuffled to be compared. A model that
    normalizes texts, and texts that hold the space marker itself, do not come back unchanged. `with_library` adds
    same_ids: whether the sentencepiece library gives every text the same ids.
    """
    shipped = _shipped(docs, model_file)
    model = _model_bytes(docs, model_file) if with_library else None

    def run(batches):
        reference = _reference(model.value) if model else None
        for batch in pieces(_coded(shipped.value, threads, batches), "text", SLICE_BYTES):
            texts, ids = [t or "" for t in batch.column("text").to_pylist()], batch.column("ids")
            same = [a == b for a, b in zip(_texts(shipped.value.tokenizer, threads, ids), texts)]
            columns = {"doc_id": batch.column("doc_id"), "ids": ids,
                       "n_tokens": pc.list_value_length(ids).cast(pa.int64()), "round_trip": pa.array(same, pa.bool_())}
            if reference:
                columns["same_ids"] = pa.array(_equal(ids, reference.encode(texts, num_threads=1)), pa.bool_())
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", same_ids boolean" if with_library else ""))


def _model_bytes(docs: DataFrame, model_file: str) -> Broadcast:
    with open(model_file, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def _reference(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _equal(ids: pa.ListArray, theirs: list[list[int]]) -> list[bool]:
    """Whether each text has the same ids."""
    flat = array("i", ids.flatten().to_numpy().tobytes())
    ends = np.cumsum(np.append(0, pc.list_value_length(ids))).tolist()
    return [flat[a:b] == array("i", x) for a, b, x in zip(ends, ends[1:], theirs)]


def parity(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, same_ids and same_text: whether the sentencepiece library encodes and decodes each row alike."""
    model = _model_bytes(docs, model_file)
    shipped = _shipped(docs, model_file)

    def run(batches):
        reference = _reference(model.value)
        for batch in pieces(_coded(shipped.value, 2, batches), "text", SLICE_BYTES):
            texts, ids = [t or "" for t in batch.column("text").to_pylist()], batch.column("ids")
            theirs = [list(x) for x in reference.encode(texts, num_threads=1)]
            back = _texts(shipped.value.tokenizer, 2, ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_equal(ids, theirs), pa.bool_()),
                 pa.array([a == reference.decode(b) for a, b in zip(back, theirs)], pa.bool_())],
                names=["doc_id", "same_ids", "same_text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, same_ids boolean, same_text boolean")
