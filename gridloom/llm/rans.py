"""Range asymmetric numeral coding of token ids with one static table, in numpy.

A block is BLOCK ids dealt to LANES states in turn (id i belongs to state i % LANES), which
write to one stream of 32-bit words. States are 64 bits wide and lie in [2^31, 2^63), so that a
step moves at most one word. Encoding goes through a block from its end, all blocks at once;
decoding from its start. The states and the place in the stream that a decoder has at every
CHECK-th id are kept, so that decoding can begin there: all stretches between checkpoints
are decoded at once, or only those that are wanted. A block has the CRC-32 of its ids.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

#: Bits of a table's sum, ids of a block, ids between checkpoints, states of a block.
SCALE, BLOCK, CHECK, LANES = 20, 1 << 16, 1 << 14, 32
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS, _SUM = np.uint64(SCALE), np.uint64(1 << SCALE)
_MASK = np.uint64((1 << SCALE) - 1)
#: A state of at least a frequency times this gives a word away first.
_ROOM = np.uint64(63 - SCALE)


def shares(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2^SCALE, at least 1 for every id that occurs, as near to the counts' shares as that allows."""
    counts = np.asarray(counts, dtype=np.int64)
    seen = np.flatnonzero(counts)
    if len(seen) > 1 << SCALE:
        raise ValueError(f"a table holds at most {1 << SCALE} different ids")
    out = np.zeros(len(counts), dtype=np.int64)
    if not len(seen):
        return out
    exact = counts[seen] / counts[seen].sum() * (1 << SCALE)
    part = np.maximum(1, np.floor(exact).astype(np.int64))
    short = (1 << SCALE) - int(part.sum())
    if short > 0:
        part[np.argsort(part - exact, kind="stable")[:short]] += 1
    while short < 0:  # rare ids got more than their share: take it from those that have the most over 1
        room = np.argsort(-part, kind="stable")[:-short]
        room = room[part[room] > 1]
        part[room] -= 1
        short += len(room)
    out[seen] = part
    return out


@dataclass
class Table:
    """Frequencies of ids and what is looked up with them."""

    frequency: np.ndarray

    def __post_init__(self) -> None:
        self.frequency = np.asarray(self.frequency, dtype=np.uint64)
        self.first = np.cumsum(self.frequency, dtype=np.uint64) - self.frequency
        self.of_slot = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))

    def holds(self, ids: np.ndarray) -> bool:
        return not len(ids) or bool(ids.min() >= 0 and ids.max() < len(self.frequency) and self.frequency[ids].all())


@dataclass
class Coded:
    """n ids: the stream, and for each stretch between checkpoints the states and the place in the stream; a checksum for each block."""

    n: int
    words: np.ndarray
    states: np.ndarray
    places: np.ndarray
    sums: np.ndarray


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").data)


def encode(ids: np.ndarray, table: Table) -> Coded:
    if not table.holds(ids):
        raise ValueError("an id has no place in the table")
    n, steps = len(ids), BLOCK // LANES
    blocks, segments = -(-n // BLOCK), -(-n // CHECK)
    grid = np.zeros(blocks * BLOCK, dtype=np.int64)
    grid[:n] = ids
    grid = grid.reshape(blocks, steps, LANES)
    live = (np.arange(blocks * BLOCK) < n).reshape(blocks, steps, LANES)
    out, given = np.zeros((steps, blocks, LANES), dtype=np.uint32), np.zeros((steps, blocks, LANES), dtype=bool)
    kept = np.full((blocks, BLOCK // CHECK, LANES), _LOW, dtype=np.uint64)
    state = np.full((blocks, LANES), _LOW, dtype=np.uint64)
    every, some = live.all(axis=(0, 2)), live.any(axis=(0, 2))
    for t in range(steps - 1, -1, -1):
        if some[t]:
            on, symbol = live[:, t], grid[:, t]
            share = table.frequency[symbol]
            full = state >= share << _ROOM
            if not every[t]:
                share, full = np.where(on, share, np.uint64(1)), full & on
            out[t], given[t] = state, full
            moved = np.where(full, state >> _WORD, state)
            whole = moved // share
            # whole << SCALE, the rest of the division, and the first slot
            coded = whole * (_SUM - share) + moved + table.first[symbol]
            state = coded if every[t] else np.where(on, coded, state)
        if t % (CHECK // LANES) == 0:
            kept[:, t // (CHECK // LANES)] = state
    given = given.transpose(1, 0, 2)
    words = out.transpose(1, 0, 2)[given]
    many = given.reshape(blocks * (BLOCK // CHECK), CHECK).sum(axis=1)
    places = np.cumsum(many) - many
    sums = np.array([checksum(ids[i : i + BLOCK]) for i in range(0, n, BLOCK)], dtype=np.uint32)
    return Coded(n, words, kept.reshape(-1, LANES)[:segments], places[:segments].astype(np.uint64), sums)


def decode(coded: Coded, table: Table, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids start to stop; only the stretches between checkpoints that hold them are decoded. Blocks that
    are decoded whole are checked."""
    stop = coded.n if stop is None else min(stop, coded.n)
    if start >= stop:
        return np.empty(0, dtype=np.uint32)
    chosen = np.arange(start // CHECK, -(-stop // CHECK))
    state, place = coded.states[chosen].astype(np.uint64), coded.places[chosen].astype(np.int64)
    words = np.concatenate([coded.words, np.zeros(1, dtype=np.uint32)]).astype(np.uint64)
    left = np.minimum(coded.n - chosen * CHECK, CHECK)
    out = np.empty((CHECK // LANES, len(chosen), LANES), dtype=np.uint32)
    lane, whole = np.arange(LANES), bool((left == CHECK).all())
    for t in range(-(-int(left.max()) // LANES)):
        slot = state & _MASK
        symbol = table.of_slot[slot]
        moved = table.frequency[symbol] * (state >> _BITS) + slot - table.first[symbol]
        if not whole:
            moved = np.where(t * LANES + lane < left[:, None], moved, state)
        low = moved < _LOW
        at = place[:, None] + np.cumsum(low, axis=1)
        state = np.where(low, moved << _WORD | words[np.minimum(at - 1, len(words) - 1)], moved)
        place = at[:, -1]
        out[t] = symbol
    ids = out.transpose(1, 0, 2).reshape(-1)
    base = int(chosen[0]) * CHECK
    ids = ids[: min(coded.n, int(chosen[-1] + 1) * CHECK) - base]
    for b in range(-(-base // BLOCK), len(coded.sums)):
        lo, hi = b * BLOCK - base, min((b + 1) * BLOCK, coded.n) - base
        if hi > len(ids):
            break
        if checksum(ids[lo:hi]) != coded.sums[b]:
            raise ValueError(f"block {b} does not have its checksum")
    return ids[start - base : stop - base]
