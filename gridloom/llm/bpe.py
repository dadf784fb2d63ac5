"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Every match of the split pattern is encoded on its own. Leaf i of its tree holds
the rank of the pair that starts at the live token at byte i, packed with i, so
that the root is the leftmost pair of the least rank. A merge removes one live
token and changes three leaves (the merged token, its left neighbour, the token
that went); each change walks up the logarithmically many levels to the root.
The trees of many matches are kept in one matrix and step together. Matches, and
stretches of text between places where a match always begins, are remembered with their
ids. Decoding takes the tokens' bytes by their ids from one table.

Edge cases: a null or empty text has no tokens; characters outside the
vocabulary do not exist, as all 256 bytes are tokens; equal rows stay equal rows; a very long text
is encoded whole, in trees of its matches (one match of n letters takes n steps); other columns stay, and one named like the ids is replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Hashable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import column_slices

_NONE = np.int64(2**62)
_LOW = np.int64(2**32 - 1)
#: Stretches, and matches, remembered from earlier rows in one Python worker.
CACHE = 100_000
#: Where a match of a pattern always begins if its matches hold no space but in front or among white space.
SPACES = r" (?=\S)"
#: Bytes of texts encoded at a time.
PART = 1 << 20


def _rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Memory:
    """Keys and the ids of each, one after the other."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.place: dict[Hashable, int] = {}
        self.ids, self.begin = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def look(self, keys: list) -> np.ndarray:
        """The place of each key, -1 for new ones."""
        return np.fromiter(map(self.place.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))

    def add(self, keys: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.place)
        self.place.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all places in their order, and where each place's begin and the last one's end."""
        size = self.begin[places + 1] - self.begin[places]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.repeat(self.begin[places] - ends[:-1], size) + np.arange(ends[-1])], ends


class Vocabulary:
    """Ranks of a tiktoken file and the merges that they imply."""

    def __init__(self, path: str) -> None:
        self.ranks = _rank_table(path)
        if max(self.ranks.values(), default=0) >= (1 << 20) - 1:
            raise ValueError("ranks must lie below 2^20 - 1")
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.matches, self.stretches = Memory(), Memory()

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that a and b make together; _NONE where there is none."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def merge_all(self, pieces: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """Numbers of some pieces, their token ids, and how many each has."""
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            by_size.setdefault(max(2, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for size, members in by_size.items():
            step = max(1, (1 << 19) // size)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                yield part, *self._trees([pieces[i] for i in part], size)

    def _trees(self, pieces: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), dtype=np.uint8).reshape(n, size)
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        # one slot more on each side: 0 is "no token to the left", size + 1 "none to the right"
        ids = np.full((n, size + 2), (1 << 20) - 1, dtype=np.int64)
        here = np.arange(size)[None, :] < length[:, None]
        ids[:, 1:-1] = np.where(here, self.of_byte[raw], (1 << 20) - 1)
        after = np.tile(np.minimum(np.arange(1, size + 3), size + 1), (n, 1))
        after[np.arange(n), length] = size + 1
        before = np.tile(np.maximum(np.arange(-1, size + 1), 0), (n, 1))
        tree = np.full((n, 2 * size), _NONE, dtype=np.int64)
        rank = self.pair(ids[:, 1:-1].ravel(), ids[:, 2:].ravel()).reshape(n, size)
        where = np.arange(1, size + 1)[None, :]
        tree[:, size:] = np.where(rank == _NONE, _NONE, rank << 32 | where)
        low = size
        while low > 1:
            half = low // 2
            tree[:, half:low] = np.minimum(tree[:, low : 2 * low : 2], tree[:, low + 1 : 2 * low : 2])
            low = half
        flat_tree, flat_ids, flat_after, flat_before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()
        row = np.arange(n)
        while len(row):
            top = flat_tree[row * (2 * size) + 1]
            live = top != _NONE
            row, top = row[live], top[live]
            if not len(row):
                break
            base = row * (size + 2)
            p, merged = top & _LOW, top >> 32
            q = flat_after[base + p]
            right, left = flat_after[base + q], flat_before[base + p]
            flat_ids[base + p] = merged
            flat_ids[base + q] = -1
            flat_after[base + p] = right
            flat_before[base + right] = p
            new = self.pair(merged, flat_ids[base + right])
            old = self.pair(flat_ids[base + left], merged)
            trees = row * (2 * size)
            edge = left > 0
            at = np.concatenate([trees + size + q - 1, trees + size + p - 1, (trees + size + left - 1)[edge]])
            put = np.concatenate([np.full(len(row), _NONE), np.where(new == _NONE, _NONE, new << 32 | p), np.where(old == _NONE, _NONE, old << 32 | left)[edge]])
            flat_tree[at] = put
            root = np.concatenate([trees, trees, trees[edge]])
            node = at - root
            level = size
            while level > 1:
                node, level = node >> 1, level >> 1
                kids = root + 2 * node
                flat_tree[root + node] = np.minimum(flat_tree[kids], flat_tree[kids + 1])
        alive = here & (ids[:, 1:-1] >= 0)
        return ids[:, 1:-1][alive], alive.sum(axis=1)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the matches are remembered; new ones are encoded."""
        memory = self.matches
        at = memory.look(words)
        if (at < 0).any():
            new = list(dict.fromkeys(words[i] for i in np.flatnonzero(at < 0)))
            raw = [w.encode("utf-8", "surrogatepass") for w in new]
            rank = np.fromiter(map(self.ranks.get, raw, repeat(-1)), dtype=np.int64, count=len(raw))
            whole, rest = np.flatnonzero(rank >= 0), np.flatnonzero(rank < 0).tolist()
            memory.add([new[i] for i in whole], rank[whole], np.ones(len(whole), dtype=np.int64))
            for part, ids, sizes in self.merge_all([raw[i] for i in rest]):
                memory.add([new[rest[i]] for i in part], ids, sizes)
            at = memory.look(words)
        return at

    def _learn(self, keys: list, split: regex.Pattern) -> None:
        """Remember stretches; a stretch that followed a space is a string, one that began a text a tuple."""
        heads = [k for k in keys if isinstance(k, tuple)]
        tails = [k for k in keys if not isinstance(k, tuple)]
        words = [split.findall(k[0]) for k in heads]
        count = np.array([len(w) for w in words], dtype=np.int64)
        more = split.findall("".join(map(" ".__add__, tails)))  # a match begins at each of the spaces
        ends = np.cumsum(np.fromiter(map(len, more), dtype=np.int64, count=len(more)))
        upto = np.searchsorted(ends, np.cumsum([len(k) + 1 for k in tails]), "right")
        count = np.concatenate([count, np.diff(upto, prepend=0)]).astype(np.int64)
        ids, starts = self.matches.take(self._places([*chain.from_iterable(words), *more]))
        self.stretches.add([*heads, *tails], ids, np.diff(starts[np.concatenate([[0], np.cumsum(count)])]))

    def encode(self, texts: list[str], split: regex.Pattern, apart: re.Pattern | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after the other, and where each text's begin and the last one's end."""
        for memory in (self.matches, self.stretches):
            if len(memory.place) > CACHE:
                memory.clear()
        if apart is None:
            parts = [split.findall(t) for t in texts]
            ids, starts = self.matches.take(self._places(list(chain.from_iterable(parts))))
        else:
            parts = [apart.split(t) for t in texts]
            for x in parts:
                x[0] = (x[0],)
            keys = list(chain.from_iterable(parts))
            at = self.stretches.look(keys)
            if (at < 0).any():
                self._learn(list(dict.fromkeys(keys[i] for i in np.flatnonzero(at < 0))), split)
                at = self.stretches.look(keys)
            ids, starts = self.stretches.take(at)
        return ids, starts[np.cumsum([0, *map(len, parts)])]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each Python worker."""
    return Vocabulary(path)


@lru_cache(maxsize=4)
def token_table(path: str) -> pa.Array:
    """The bytes of each id; none where there is no token."""
    ranks = _rank_table(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return pa.array(tokens, pa.binary())


def _ranks_file(df: DataFrame, path: str, ship: bool) -> tuple[str, bool]:
    if ship:
        df.sparkSession.sparkContext.addFile(path)
        return path.rsplit("/", 1)[-1], True
    return path, False


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [values], [*names, name])


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids", ship: bool = False, apart: str | None = None) -> DataFrame:
    """df with the array<int> column out: the token ids of the column text.

    ranks: path of a tiktoken rank file that every executor has, or with ship=True
    one that only the driver has. apart: a pattern for spaces at which a match of the other
    pattern always begins, such as SPACES, which saves time. A column named out is replaced.
    """
    file, shipped = _ranks_file(df, ranks, ship)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, split, cuts = vocabulary(SparkFiles.get(file) if shipped else file), regex.compile(pattern), re.compile(apart) if apart else None
        for batch in batches:
            column = batch.column(text)
            for a, b in column_slices(column, PART):
                ids, ends = v.encode([t or "" for t in column.slice(a, b - a).to_pylist()], split, cuts)
                yield _with(batch.slice(a, b - a), out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))

    fields = [f for f in df.schema.fields if f.name != out]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ranks: str, ids: str = "ids", out: str = "decoded", ship: bool = False) -> DataFrame:
    """df with the binary column out: the bytes of the token ids in the column ids (null: none)."""
    file, shipped = _ranks_file(df, ranks, ship)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(SparkFiles.get(file) if shipped else file)
        for batch in batches:
            column = batch.column(ids)
            ends = np.cumsum([0, *(x or 0 for x in column.value_lengths().to_pylist())])
            flat = column.flatten()
            at = 0
            while at < len(batch):  # as many rows as have PART ids, one at least
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + PART, "right")) - 1)
                taken = table.take(flat.slice(ends[at], ends[end] - ends[at]))
                places = np.frombuffer(taken.buffers()[1], dtype=np.int32)[ends[at : end + 1] - ends[at]] if len(taken) else np.zeros(end - at + 1, dtype=np.int32)
                whole = pa.Array.from_buffers(pa.binary(), end - at, [None, pa.py_buffer(places), taken.buffers()[2]])
                yield _with(batch.slice(at, end - at), out, whole)
                at = end

    fields = [f for f in df.schema.fields if f.name != out]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.BinaryType())]))
