"""Burrows-Wheeler transforms of shards of strings, merged by interleave refinement up to a depth.

A string is read as a circle that ends in a separator. A shard keeps its suffixes in order of their first DEPTH bytes,
and for each the STEP bytes before it (the transform, with STEP bytes as one symbol). The merge never compares
suffixes: it refines only the interleaving, that is, which shard each place of the merged order belongs to. If the
interleaving is right up to h bytes, a stable distribution of its places by their symbols makes it right up to
h + STEP. Neighbours that are still together after the last round share DEPTH bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 8
SEPARATOR = 0xFF


@dataclass
class Shard:
    """Circular strings in one array: where each begins, their sizes, and the transform."""

    begins: np.ndarray   # of the string that each place of the array belongs to
    sizes: np.ndarray    # of that string, separator included
    order: np.ndarray    # places in order of what follows them
    before: np.ndarray   # in that order: the STEP bytes before


def _gram(data: np.ndarray, shift) -> np.ndarray:
    """STEP bytes from each place on its circle as one big-endian number."""
    gram = np.zeros(len(data), np.uint64)
    for k in range(STEP):
        gram = (gram << np.uint64(8)) | data[shift(k)].astype(np.uint64)
    return gram


def build_shard(strings: list[bytes], depth: int) -> Shard:
    """The transform of a few strings, ordered by rank doubling."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    data = np.frombuffer(b"".join(s + bytes([SEPARATOR]) for s in strings), np.uint8)
    begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
    size = np.repeat(sizes, sizes)
    at = np.arange(len(data)) - begins

    def shift(by: int) -> np.ndarray:
        return begins + (at + by) % size

    gram = _gram(data, shift)
    rank, reach = np.unique(gram, return_inverse=True)[1].astype(np.uint64), STEP
    while reach < depth:
        ahead = min(reach, depth - reach)
        rank = np.unique((rank << np.uint64(32)) | rank[shift(ahead)], return_inverse=True)[1].astype(np.uint64)
        reach += ahead
    order = np.argsort(rank, kind="stable")
    return Shard(begins, size, order, gram[shift(-STEP)][order])


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The merged order of all places of all shards, and how many bytes each neighbour pair has in common.

    Places count through the shards one after another. Common bytes are rounded down to a multiple of STEP, and at
    most `depth`, itself a multiple of STEP.
    """
    total = sum(len(s.order) for s in shards)
    starts = np.cumsum([0, *(len(s.order) for s in shards)])
    inside = np.concatenate([s.order + b for s, b in zip(shards, starts)])
    known, code = np.unique(np.concatenate([s.before for s in shards]), return_inverse=True)
    code = code.astype(np.int32)
    low, high = (code & 0xFFFF).astype(np.uint16), (code >> 16).astype(np.uint16)
    owner = np.repeat(np.arange(len(shards), dtype=np.uint16), np.diff(starts))
    places = np.arange(total, dtype=np.int32)
    source = places.copy()             # which entry of the transforms each place of the interleaving holds
    group = np.zeros(total, np.int32)  # equal for places that agree in all bytes so far
    common = np.full(max(total - 1, 0), depth, np.int32)
    for reach in range(0, depth, STEP):
        place = np.argsort(low[source], kind="stable")
        if len(known) > 0x10000:
            place = place[np.argsort(high[source[place]], kind="stable")]
        symbol, group, owner = code[source[place]], group[place], owner[place]
        parted = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        common[parted & (common == depth)] = reach
        group = np.concatenate(([0], np.cumsum(parted, dtype=np.int32)))
        source[np.argsort(owner, kind="stable")] = places
    return inside[source], common
