"""Token ids of whole texts with the tokenizers library.

The library spends its time on word after word, and a corpus has the same words again and
again. So texts are cut where a tokenizer's words can't go on, at APART; pieces are
remembered with their ids, and so are the words of pieces that hold plain letters only.
New words are handed to the library many at a time, joined by spaces; the tokens that end
a word tell them apart again. Pieces with anything else in them (other scripts, control
characters, marks, special tokens) are handed to the library as they are.

Edge cases: null and empty texts have no tokens; a special token that stands in a text is
one id, as in the library; equal texts have equal ids; other columns stay as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer, pre_tokenizers

from .bpe import Memory
from .common import column_slices

#: Pieces, and words, remembered in one Python worker, and bytes of texts at a time.
CACHE, PART = 600_000, 1 << 22
#: New words that are encoded in one string.
JOINED = 2048


@dataclass(frozen=True)
class Rules:
    """What of a tokenizer's splitting can be done before it.

    apart: a string that ends every word and leaves nothing behind; plain: pieces whose words are the matches of word in
    their lower-case text, to the bytes of which the vocabulary applies; ending: what the last token of a word ends with.
    """

    apart: str = " "
    plain: str = "[\n\x20-\x7eÀ-ÖØ-öø-įı-ſ]*"
    word: str = "'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ſ]+|[0-9]|[^ \na-z0-9ß-öø-ſ]+"
    ending: str = "</w>"


class Words:
    """A tokenizer with what it has said before."""

    def __init__(self, path: str, rules: Rules) -> None:
        self.tokenizer, self.rules = Tokenizer.from_file(path), rules
        # for words that are found already: neither a normalizer nor a pattern
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(rules.apart, "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(True)
        self.size = max(vocabulary.values()) + 1
        self.last = np.zeros(self.size, dtype=bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(rules.ending)]] = True
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special)) if special else None
        self.plain, self.word = re.compile(rules.plain), re.compile(f"{rules.word}|{re.escape(rules.apart)}")
        self.pieces, self.words = Memory(), Memory()

    @staticmethod
    def _library(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), dtype=np.int64), np.array([len(i) for i in found], dtype=np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and how many each has."""
        ids, _ = self._library(self.bare, [self.rules.apart.join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # a vocabulary without ends of words
            return self._library(self.bare, words)
        return ids, np.diff(ends, prepend=0)

    def _is_plain(self, text: str) -> bool:
        return bool(self.plain.fullmatch(text)) and not (self.special and self.special.search(text))

    @staticmethod
    def _places(memory: Memory, keys: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """Where the keys are remembered; new ones are given to learn, as often as they occur."""
        at = memory.look(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            lacking = [keys[i] for i in missing.tolist()]
            learn(lacking)
            at[missing] = memory.look(lacking)
        return at

    def _learn_words(self, keys: list[str]) -> None:
        new = list(dict.fromkeys(keys))
        self.words.add(new, *self._joined(new))

    def _learn(self, keys: list[str]) -> None:
        """Pieces, each once."""
        apart, plain = self.rules.apart, keys
        joined = apart.join(keys)
        if not self._is_plain(joined):
            is_plain = [self._is_plain(k) for k in keys]
            odd = [k for k, p in zip(keys, is_plain, strict=True) if not p]
            self.pieces.add(odd, *self._library(self.tokenizer, odd))
            plain = [k for k, p in zip(keys, is_plain, strict=True) if p]
            if not plain:
                return
            joined = apart.join(plain)
        if apart not in self.words.place:
            self.words.add([apart], np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
        words = self.word.findall(joined.lower())
        at = self._places(self.words, words, self._learn_words)
        ids, ends = self.words.take(at)
        between = ends[np.flatnonzero(at == self.words.place[apart])]
        self.pieces.add(plain, ids, np.diff(np.concatenate([[0], between, [len(ids)]])))

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin and the last one's end."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([clean(t) for t in texts], pa.string())
        for memory in (self.pieces, self.words):
            if len(memory.place) > CACHE:
                memory.clear()
        parts = pc.split_pattern(pc.fill_null(texts, ""), self.rules.apart)
        pieces = parts.flatten().dictionary_encode()  # few of them are new to a slice, so Python sees each once
        at = self._places(self.pieces, pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), self._learn)
        ids, ends = self.pieces.take(at[pieces.indices.to_numpy()])
        return ids, ends[parts.offsets.to_numpy()]


@lru_cache(maxsize=2)
def words_of(path: str, rules: Rules) -> Words:
    """Loaded once in each Python worker."""
    return Words(path, rules)


def vocabulary_size(path: str) -> int:
    return max(Tokenizer.from_file(path).get_vocab(True).values()) + 1


def clean(text: str | None) -> str:
    """The text without code points that are no characters, which no UTF-8 holds."""
    if not text:
        return ""
    try:
        text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-8", "replace").decode()
    return text


def as_lists(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))


def tokenized(
    df: DataFrame, path: str, text: str = "text", out: str = "ids", end: int | None = None, rules: Rules = Rules(), form: Callable[[np.ndarray, np.ndarray], pa.Array] = as_lists, kind: str = "array<int>"
) -> DataFrame:
    """df with the column out in place of the column text: its token ids, and the id end after them if given.

    path: a tokenizer's JSON file that every executor has. form and kind: how ids are given (see
    idfiles.packed). A column named out is replaced.
    """
    fields = [f for f in df.schema.fields if f.name not in (out, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path, rules)
        for batch in batches:
            column = batch.column(text)
            for a, b in column_slices(column, PART):
                ids, ends = words.encode(column.slice(a, b - a))
                if end is not None:
                    ids, ends = np.insert(ids, ends[1:], end), ends + np.arange(b - a + 1)
                yield pa.RecordBatch.from_arrays([*(batch.column(f.name).slice(a, b - a) for f in fields), form(ids, ends)], [*(f.name for f in fields), out])

    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.DataType.fromDDL(kind))]))
