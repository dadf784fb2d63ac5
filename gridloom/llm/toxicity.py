"""Toxicity of whole texts by averaged subword embeddings and a linear softmax.

A word is the bag of its character n-grams (with marks for its ends) and the whole
word, each hashed to a row of an embedding table. The mean of the bag's rows goes into
a linear softmax, and so does the mean over all distinct words of a document. A document
is toxic as soon as it as a whole or one of its words is (noisy or), so that a long text does
not dilute a short insult. Table and softmax are
trained jointly in numpy, by gradient steps over all sampled labels. Misspelled and
unseen words share the n-grams of known ones.

As the means are linear, a trained model gives each n-gram one number, and scoring
adds numbers. Only a bounded sample of labelled rows (SAMPLE rows of each label and BYTES of their
texts, the first in hash order) is brought to one task to fit, and the model, of fixed size, to the
driver; scoring covers every row.

Edge cases: null and empty texts get the score of a document whose mean is zero; rows without labels are scored like others;
without labelled rows of both kinds every score is 0; labels that are neither 0 nor 1 are not learned; repeated rows are
scored one by one, alike; a very long text is scored whole, word by word; columns of other names stay, and one named like the score is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

BUCKETS, DIMENSIONS, NGRAMS = 1 << 19, 4, (3, 4, 5, 6)
#: Labelled rows of each label that a fit may use at most.
SAMPLE = 1500
#: Bytes of the texts of each label that a fit may use at most; a text that would go beyond is left out whole.
BYTES = 1 << 23
STEPS, RATE, DECAY = 60, 0.1, 1e-6
#: Sampled texts that must hold an n-gram for it to be learned.
TEXTS = 4

_TOKEN = re.compile(r"[^\W_](?:[^\s]*[^\W_])?")
_U = np.uint64
_MULTIPLY = _U(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without the punctuation around them."""
    return _TOKEN.findall((text or "").lower())


def word_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of all words, one after the other, and each word's count."""
    marked = "".join(f"<{w}>" for w in words)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(_U)
    length = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    start = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(words) else np.empty(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), length)
    left = np.repeat(start + length, length) - np.arange(len(code))
    who, what = [], []
    h = np.zeros(len(code), dtype=_U)
    for n in range(1, max(NGRAMS) + 1):
        h = h[: len(code) - n + 1] * _MULTIPLY + code[n - 1 :] + _U(n) if n > 1 else code + _U(1)
        if n in NGRAMS:
            ok = left[: len(h)] >= n
            who.append(owner[: len(h)][ok])
            what.append(_bucket(h[ok]))
    # the whole word, by a sum that does not depend on its place
    place = (np.arange(len(code)) - np.repeat(start, length)).astype(_U)
    if len(words):
        whole = np.add.reduceat((code + _U(7)) * _bits((place + _U(1)) * _MULTIPLY), start)
        who.append(np.arange(len(words), dtype=np.int32))
        what.append(_bucket(whole))
    owner, grams = np.concatenate(who), np.concatenate(what)
    order = np.argsort(owner, kind="stable")
    return grams[order], np.bincount(owner, minlength=len(words))


def _bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def _bucket(h: np.ndarray) -> np.ndarray:
    return (_bits(h) % _U(BUCKETS)).astype(np.int32)


@dataclass
class Model:
    """gram[b]: what n-gram bucket b adds to the log odds; bias: the log odds of an empty passage."""

    gram: np.ndarray
    bias: float

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        grams, counts = word_grams(words)
        return np.add.reduceat(self.gram[grams], np.concatenate([[0], np.cumsum(counts)[:-1]])) / counts

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of each text."""
        words, docs, ids = _bags(texts)
        own = self.words(words)[ids]
        size = np.bincount(docs, minlength=len(texts))
        mean = np.bincount(docs, weights=own, minlength=len(texts)) / np.maximum(size, 1)
        total = np.bincount(docs, weights=np.logaddexp(0, own + self.bias), minlength=len(texts)) + np.logaddexp(0, mean + self.bias)
        return -np.expm1(-total)


def _bags(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of all texts, and (text, word) of each distinct pair."""
    found = [set(tokens(t)) for t in texts]
    place: dict[str, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in chain.from_iterable(found)), dtype=np.int64)
    return list(place), np.repeat(np.arange(len(found)), [len(ws) for ws in found]), ids


def _common(grams: np.ndarray, counts: np.ndarray, starts: np.ndarray, docs: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether at least TEXTS texts hold each bucket; docs must be sorted."""
    texts = np.zeros(BUCKETS, dtype=np.int32)
    edges = np.searchsorted(docs, np.arange(0, docs[-1] + 200, 200)) if len(docs) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        n = counts[ids[a:b]]
        at = np.repeat(starts[ids[a:b]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        texts += np.bincount(np.unique(grams[at].astype(np.int64) << 31 | np.repeat(docs[a:b], n)) >> 31, minlength=BUCKETS).astype(np.int32)
    return texts >= TEXTS


def fit(texts: list[str | None], labels: np.ndarray, seed: int = 0) -> Model:
    """A model of labelled texts; labels are 0 or 1 and both must occur."""
    words, docs, ids = _bags(texts)
    parts = [word_grams(words[i : i + 20_000]) for i in range(0, max(1, len(words)), 20_000)]
    grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts, words
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    common = _common(grams, counts, starts, docs, ids)
    used = np.flatnonzero(common)  # the rows of all others stay 0
    slot = np.zeros(BUCKETS, dtype=np.int32)
    slot[used] = np.arange(len(used))
    owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)[common[grams]]
    grams = slot[grams[common[grams]]]
    # the pairs of words and n-grams, sorted by word, and by n-gram
    by_word = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.empty(0, dtype=np.int64)
    filled = owner[by_word]
    order = np.argsort(grams, kind="stable")
    owners = owner[order]
    by_gram = np.searchsorted(grams[order], np.arange(len(used)))
    del order, owner, starts
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32)
    weight = rng.normal(0, 1, (DIMENSIONS, 2))
    offset = np.array([0.0, -4.0])
    squares = [np.full(x.shape, 1e-8) for x in (table, weight, offset)]
    y = np.asarray(labels, dtype=np.float64)
    share = np.where(y == 1, 0.35 / max(1, y.sum()), 0.65 / max(1, (1 - y).sum())) * len(y) / 10
    sign, inverse = np.array([-1.0, 1.0]), 1 / counts
    size = np.bincount(docs, minlength=len(y))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for _ in range(STEPS if len(used) else 0):
        mean = np.zeros((len(counts), DIMENSIONS))
        for d in range(DIMENSIONS):
            mean[filled, d] = np.add.reduceat(table[grams, d], by_word)
        mean *= inverse[:, None]
        z = (mean @ weight + offset) @ sign
        # a document's mean is that of its words' means, and so are the log odds
        whole = np.where(size, np.bincount(docs, weights=z[ids], minlength=len(y)) / np.maximum(size, 1), (offset * sign).sum())
        keep = np.bincount(docs, weights=np.logaddexp(0, z)[ids], minlength=len(y)) + np.logaddexp(0, whole)
        # d loss / d z of a part of a text: sigmoid(z) for label 0, -sigmoid(z) (1 - p) / p for label 1
        ratio = np.where(y == 1, -1 / np.maximum(np.expm1(np.minimum(keep, 500)), 1e-6), 1.0) * share
        dz = np.bincount(ids, weights=ratio[docs], minlength=len(counts)) * sigmoid(z) + np.bincount(ids, weights=(ratio * sigmoid(whole) / np.maximum(size, 1))[docs], minlength=len(counts))
        both = dz[:, None] * sign
        back = (both @ weight.T * inverse[:, None]).astype(np.float32)
        to_table = np.stack([np.add.reduceat(back[owners, d], by_gram) for d in range(DIMENSIONS)], axis=1)
        for x, g, s in zip((table, weight, offset), (to_table + DECAY * table, mean.T @ both, both.sum(axis=0)), squares, strict=True):
            s += g * g
            x -= (RATE * g / np.sqrt(s)).astype(x.dtype)
    gram = np.zeros(BUCKETS, dtype=np.float32)
    gram[used] = table @ (weight @ sign)
    return Model(gram, float(offset[1] - offset[0]))


def sample(labelled: DataFrame, label: str, id: str, rows: int = SAMPLE) -> DataFrame:
    """At most rows rows of each label, the first in hash order."""
    order = F.xxhash64(F.col(id))
    first = labelled.filter(F.col(label).isin(0, 1)).withColumn("_h", order)
    return first.filter(F.col(label) == 1).orderBy("_h", id).limit(rows).union(first.filter(F.col(label) == 0).orderBy("_h", id).limit(rows)).drop("_h")


def train(labelled: DataFrame, text: str = "text", label: str = "toxic", id: str = "doc_id", rows: int = SAMPLE, size: int = BYTES) -> Model:
    """Fit on a bounded sample of labelled rows; see SAMPLE and BYTES."""
    known = sample(labelled.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label")), "label", "id", rows)
    upto = W.partitionBy("label").orderBy(F.xxhash64("id"), "id", "text").rowsBetween(W.unboundedPreceding, W.currentRow)  # over rows at most
    bounded = known.withColumn("upto", F.sum(F.octet_length("text")).over(upto)).filter(F.col("upto") <= size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column("text").to_pylist()
            labels += batch.column("label").to_pylist()
        if len(set(labels)) == 2:
            model = fit(texts, np.array(labels))
            yield pa.RecordBatch.from_arrays([pa.array([model.gram.tobytes()], pa.binary()), pa.array([model.bias])], ["gram", "bias"])

    made = bounded.repartition(1).sortWithinPartitions("id", "label", "text").select("text", "label").mapInArrow(run, "gram binary, bias double").first()
    return Model(np.frombuffer(made.gram, dtype=np.float32), made.bias) if made else Model(np.zeros(BUCKETS, dtype=np.float32), -np.inf)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """df with the column out, the probability of label 1; a column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast((model.gram, model.bias))
    names = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            made = [own.scores(texts[a:b]) for a, b in slices(texts)]
            values = pa.array(np.concatenate(made) if made else np.empty(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), values], [*names, out])

    return df.mapInArrow(run, T.StructType([*(df.schema[n] for n in names), T.StructField(out, T.DoubleType())]))
