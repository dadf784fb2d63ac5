"""Removal of repeated substrings of LENGTH bytes by prefix-free parsing.

Every text is parsed into phrases: each window of LENGTH bytes has a trigger, its least
rolling hash of TRIGGER bytes, leftmost first, and the starts of consecutive windows with
one trigger form a phrase. A trigger depends on its window alone, so equal strings of
LENGTH bytes have equal triggers wherever they lie, and every such string starts in
exactly one phrase. (A hash that is 0 modulo something would leave strings without any
trigger.) A phrase carries the LENGTH - 1 bytes after it, so strings compare within phrases:

1. the parse: its places, sorted by trigger, phrase and corpus order, are its suffix array
   as far as LENGTH bytes need it, dealt out by trigger. A place whose phrase came before
   is a repeat in whole, and the first places of distinct phrases are the dictionary;
2. the dictionary: where one trigger has several phrases, these may share strings in part.
   Their suffixes, cut to LENGTH bytes, are sorted: the dictionary's suffix array. As the
   sort is stable and phrases stand in the order of their first place in the parse, the
   first of equal suffixes is the first in the corpus, and the others are repeats.

Suffixes of repeated phrases are never made, which is what the parsing saves. A trigger
with very many phrases, as where a passage of many documents begins or ends, is split: its
phrases are dealt out one by one (a sample of documents tells such triggers beforehand;
others are noticed when their phrases are counted), and their suffixes are dealt out and
sorted by two 64-bit hashes, after those that repeat within a batch are settled there.

Edge cases: null and empty texts have no bytes and nothing removed; rows with equal id
and equal text are one document and get the same result; a null id comes first; ids may
be of any type that can be sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, slices, stored

LENGTH, TRIGGER = 100, 24
#: Bytes of a text that are parsed at a time, and of phrases whose suffixes are sorted at a time.
CHUNK = 1 << 20
#: Distinct phrases of a trigger beyond which it is split.
HOT = 4096
#: One document in so many is looked at for such triggers, and so many of them are known beforehand at most.
LOOK, KNOWN = 16, 10_000

_U = np.uint64
_random = np.random.default_rng(20240611)
_BYTE = _random.integers(1, 2**63, 256, dtype=_U) * _U(2) + _U(1)
_BASE, _LOW = 0x9E3779B97F4A7C15, _U(2**24 - 1)
_POWER = np.cumprod(np.concatenate([[_U(1)], np.full(CHUNK + 4 * LENGTH, _U(_BASE))]))
_INVERSE = np.cumprod(np.concatenate([[_U(1)], np.full(CHUNK + 4 * LENGTH, _U(pow(_BASE, -1, 2**64)))]))
#: Weights of a string's bytes in its two hashes.
_WEIGHTS = _random.integers(1, 2**63, (LENGTH, 2), dtype=_U) * _U(2) + _U(1)


def _bits(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _prefix(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTE[data] * _POWER[: len(data)], out=out[1:])
    return out


def parse(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigger, phrase hash, start and number of starts of each phrase of a text."""
    parts = []
    data = np.frombuffer(text, dtype=np.uint8)
    for at in range(0, len(data) - LENGTH + 1, CHUNK):
        part = data[at : at + CHUNK + LENGTH - 1]
        starts = len(part) - LENGTH + 1
        prefix = _prefix(part)
        hashes = _bits((prefix[TRIGGER:] - prefix[:-TRIGGER]) * _INVERSE[: len(part) - TRIGGER + 1])
        least, have, wide = hashes & ~_LOW | np.arange(len(hashes), dtype=_U), 1, LENGTH - TRIGGER + 1
        while have * 2 <= wide:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[:starts], least[wide - have : wide - have + starts])
        trigger = (least & _LOW).astype(np.int64)
        lo = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        hi = np.concatenate([lo[1:], [starts]])
        trigger = trigger[lo]
        phrase = _bits((prefix[hi + LENGTH - 1] - prefix[lo]) * _INVERSE[lo] + (trigger - lo).astype(_U) * _U(_BASE))
        parts.append((hashes[trigger].view(np.int64), phrase.view(np.int64), lo + at, hi - lo))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.empty(0, dtype=np.int64),) * 4


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
#: pos: start << 9 | starts << 2 | kind, where kind is PLAIN, SPREAD (dealt by phrase, not trigger) or SETTLED (a run of as many repeats as phrase says).
_PHRASE = "trigger long, phrase long, doc long, mark long, pos long"
PLAIN, SPREAD, SETTLED = 0, 1, 2
#: kind: WHOLE (repeats), OPEN (maybe in part, among its trigger's phrases) or ALONE (maybe in part, its strings are dealt one by one).
_RANGE = "trigger long, doc long, mark long, start int, starts int, kind int"
WHOLE, OPEN, ALONE = 0, 1, 2
_SUFFIX = "key long, second long, doc long, mark long, start int, starts int, bytes binary"
_REPEAT = "doc long, mark long, start int, starts int"


def _batch(schema: str, *columns: np.ndarray) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Documents, marks and bytes of some texts at a time."""
    docs, marks, texts = (batch.column(c) for c in ("doc", "mark", "text"))
    docs, marks, texts = docs.to_numpy(), marks.to_numpy(), texts.to_pylist()
    for a, b in slices(texts, 1 << 22):
        yield docs[a:b], marks[a:b], [(t or "").encode("utf-8", "surrogatepass") for t in texts[a:b]]


def _runs(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same starts in the fewest rows, in corpus order."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start, stop = doc[order], mark[order], start[order], (start + starts)[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] != stop[:-1])])) if len(doc) else np.empty(0, dtype=np.int64)
    last = np.concatenate([new[1:], [len(doc)]])[: len(new)] - 1
    return doc[new], mark[new], start[new], stop[last] - start[new]


def _spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Keys that deal rows out evenly."""
    return _bits(doc.astype(np.int64).view(_U) * _U(_BASE) + start.astype(_U)).view(np.int64)


def _parsed(raw: list[bytes]) -> tuple[np.ndarray, ...] | None:
    """Row, trigger, phrase, start and starts of all phrases of some texts."""
    found = [parse(x) for x in raw]
    row = np.repeat(np.arange(len(raw)), [len(f[0]) for f in found])
    return (row, *(np.concatenate(x) for x in zip(*found, strict=True))) if len(row) else None


def _phrases(hot: np.ndarray):
    """Phrases of (doc, mark, text) rows; those of the triggers in hot (sorted) are dealt by phrase.

    Repeats among the texts at hand are settled here, so a frequent phrase is not sent again and again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, marks, raw in _rows_of(batch):
                if (found := _parsed(raw)) is None:
                    continue
                row, trigger, phrase, start, starts = found
                doc, mark = docs[row], marks[row]
                order = np.lexsort((start, mark, doc, phrase, trigger))
                trigger, phrase, start, starts, doc, mark = (x[order] for x in (trigger, phrase, start, starts, doc, mark))
                same = np.concatenate([[False], (trigger[1:] == trigger[:-1]) & (phrase[1:] == phrase[:-1])])
                own = same & ~np.concatenate([[False], (doc[1:] == doc[:-1]) & (mark[1:] == mark[:-1]) & (start[1:] == start[:-1])])
                left = ~own
                alone = hot[np.minimum(np.searchsorted(hot, trigger), len(hot) - 1)] == trigger if len(hot) else np.zeros(len(trigger), dtype=bool)
                key = np.where(alone, _bits((trigger ^ phrase).view(_U)).view(np.int64), trigger)
                yield _batch(_PHRASE, key[left], phrase[left], doc[left], mark[left], start[left] << 9 | starts[left] << 2 | np.where(alone, SPREAD, PLAIN)[left])
                if own.any():
                    d, m, a, n = _runs(doc[own], mark[own], start[own], starts[own])
                    yield _batch(_PHRASE, _spread(d, a), n, d, m, a << 9 | SETTLED)

    return run


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(trigger, phrases) of triggers that have several distinct phrases among the texts at hand."""
    for batch in batches:
        for _, _, raw in _rows_of(batch):
            if (found := _parsed(raw)) is not None:
                trigger, n = np.unique(np.unique(np.stack(found[1:3]), axis=1)[0], return_counts=True)
                yield _batch("trigger long, phrases long", trigger[n > 2], n[n > 2])


def _repeats(hot: int):
    """Of sorted phrases the ranges of starts that are repeats in whole, and the first ones that may be so in part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [0, 0, 0, 0, -1]  # the phrase before: trigger, phrase, doc, mark, start
        held = np.empty((6, 0), dtype=np.int64)  # first places of a trigger's phrases that may go on, hot at most
        split: int | None = None  # the trigger that had more
        for batch in batches:
            trigger, phrase, doc, mark, pos = (batch.column(i).to_numpy() for i in range(5))
            if not len(trigger):
                continue
            start, starts, kind = pos >> 9, pos >> 2 & 127, pos & 3
            settled = kind == SETTLED
            was = [np.concatenate([[b], x[:-1]]) for b, x in zip(last, (trigger, phrase, doc, mark, start), strict=True)]
            last = [x[-1] for x in (trigger, phrase, doc, mark, start)]
            same = (trigger == was[0]) & (phrase == was[1]) & ~settled
            again = same & (doc == was[2]) & (mark == was[3]) & (start == was[4])  # the same row once more
            whole = settled | same & ~again
            rows = np.stack([trigger, doc, mark, start, np.where(settled, phrase, starts), kind])
            firsts = np.concatenate([held, rows[:, ~same & ~settled]], axis=1)
            yield _batch(_RANGE, *rows[:5, whole], np.zeros(int(whole.sum())))
            held = firsts[:, :0]
            if not firsts.shape[1]:
                continue
            new = np.flatnonzero(np.concatenate([[True], firsts[0, 1:] != firsts[0, :-1]]))
            size = np.diff(np.concatenate([new, [firsts.shape[1]]]))
            how = np.where(size > hot, ALONE, np.where(size > 1, OPEN, WHOLE))
            if split is not None and firsts[0, 0] == split:
                how[0] = ALONE
            split = int(firsts[0, -1]) if how[-1] == ALONE else None
            how = np.repeat(how, size)
            if split is None:
                held, firsts, how = firsts[:, new[-1] :], firsts[:, : new[-1]], how[: new[-1]]
            how = np.where(firsts[5] == SPREAD, ALONE, how)
            out = how != WHOLE
            yield _batch(_RANGE, *firsts[:5, out], how[out])
        if held.shape[1]:
            how = np.where(held[5] == SPREAD, ALONE, OPEN if held.shape[1] > 1 else WHOLE)
            yield _batch(_RANGE, *held[:5, how != WHOLE], how[how != WHOLE])

    return run


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, mark, whole, open) of (doc, mark, ranges): the repeats in fewest ranges, and the phrases yet to be looked into."""
    for batch in batches:
        names = ("trigger", "start", "starts", "kind")
        ranges = batch.column("ranges")
        row = np.repeat(np.arange(len(batch)), ranges.value_lengths().to_numpy())
        trigger, start, starts, kind = (ranges.flatten().field(n).to_numpy() for n in names)
        done = kind == WHOLE
        at, _, a, n = _runs(row[done], row[done], start[done].astype(np.int64), starts[done])
        ends = np.searchsorted(at, np.arange(len(batch) + 1)).astype(np.int32)
        whole = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (a, n)], ["start", "starts"]))
        rest = np.flatnonzero(~done)
        ends = np.searchsorted(row[rest], np.arange(len(batch) + 1)).astype(np.int32)
        parts = [pa.array(trigger[rest], pa.int64()), *(pa.array(x[rest], pa.int32()) for x in (start, starts, kind))]
        open_ = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, list(names)))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), whole, open_], ["doc", "mark", "whole", "open"])


_LISTS = "doc long, mark long, whole array<struct<start:int,starts:int>>, open array<struct<trigger:long,start:int,starts:int,kind:int>>"


def _suffixes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of documents (doc, mark, text, open): the bytes of open phrases, or for those of split triggers their strings' hashes."""
    for batch in batches:
        opens = batch.column("open").to_pylist()
        at = 0
        for docs, marks, raw in _rows_of(batch):
            sent: list[tuple] = []
            strings, places = [], []
            for doc, mark, x, some in zip(docs.tolist(), marks.tolist(), raw, opens[at : at + len(raw)], strict=True):
                for r in some:
                    piece = x[r["start"] : r["start"] + r["starts"] + LENGTH - 1]
                    if r["kind"] == OPEN:
                        sent.append((r["trigger"], 0, doc, mark, r["start"], r["starts"], piece))
                    else:
                        window = np.lib.stride_tricks.sliding_window_view(np.frombuffer(piece, dtype=np.uint8), LENGTH)
                        strings.append(_BYTE[window] @ _WEIGHTS)
                        places.append(np.array([[doc, mark, r["start"] + i] for i in range(r["starts"])], dtype=np.int64))
            at += len(raw)
            if sent:
                yield _batch(_SUFFIX, *zip(*sent, strict=True))
            if not strings:
                continue
            key, second = _bits(np.concatenate(strings)).T.view(np.int64)
            doc, mark, start = np.concatenate(places).T
            order = np.lexsort((start, mark, doc, second, key))
            key, second, doc, mark, start = (v[order] for v in (key, second, doc, mark, start))
            again = np.concatenate([[False], (key[1:] == key[:-1]) & (second[1:] == second[:-1])])
            same = np.concatenate([[False], (doc[1:] == doc[:-1]) & (mark[1:] == mark[:-1]) & (start[1:] == start[:-1])])
            first, own = ~again, again & ~same
            yield _batch(_SUFFIX, key[first], second[first], doc[first], mark[first], start[first], np.ones(int(first.sum())), [None] * int(first.sum()))
            if own.any():
                d, m, a, n = _runs(doc[own], mark[own], start[own], np.ones(int(own.sum()), dtype=np.int64))
                yield _batch(_SUFFIX, _spread(d, a), 0 * n, d, m, a, -n, [None] * len(n))


def suffix_array(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes of all pieces that have LENGTH bytes at least, by those bytes and then
    by place, and whether each has the same bytes as the one before it."""
    starts = np.array([len(x) - LENGTH + 1 for x in pieces])
    firsts = np.cumsum([0, *(len(x) for x in pieces[:-1])])
    at = np.repeat(firsts - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    window = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b"".join(pieces), dtype=np.uint8), LENGTH)
    keys = np.ascontiguousarray(window[at])
    order = np.argsort(keys.view(f"S{LENGTH}").ravel(), kind="stable")
    words = keys.view(np.uint32)[order]
    return order, np.concatenate([[False], (words[1:] == words[:-1]).all(axis=1)])


def _settled(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeats among phrases (key, doc, mark, start, bytes) in corpus order for each key."""
    _, doc, mark, start, pieces = zip(*rows, strict=True)
    order, same = suffix_array(pieces)
    repeat = np.zeros(len(order), dtype=bool)
    repeat[order[same]] = True
    size = np.array([len(x) - LENGTH + 1 for x in pieces])
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    doc, mark, start = (np.array(x, dtype=np.int64)[row[repeat]] for x in (doc, mark, start))
    if len(doc):
        yield _batch(_REPEAT, *_runs(doc, mark, start + place[repeat], np.ones(len(doc), dtype=np.int64)))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeats among sorted rows of _SUFFIX."""
    rows: list[tuple] = []
    size = 0
    last = [0, 0, 0, 0, -1]
    for batch in batches:
        key, second, doc, mark, start, starts = (batch.column(i).to_numpy() for i in range(6))
        if not len(key):
            continue
        phrase = batch.column(6).is_valid().to_numpy(zero_copy_only=False)
        single = ~phrase & (starts > 0)
        k, s, d, m, a = (x[single].astype(np.int64) for x in (key, second, doc, mark, start))
        if len(k):
            was = [np.concatenate([[b], x[:-1]]) for b, x in zip(last, (k, s, d, m, a), strict=True)]
            last = [x[-1] for x in (k, s, d, m, a)]
            again = (k == was[0]) & (s == was[1]) & ~((d == was[2]) & (m == was[3]) & (a == was[4]))
            yield _batch(_REPEAT, d[again], m[again], a[again], np.ones(int(again.sum())))
        done = starts < 0
        yield _batch(_REPEAT, doc[done], mark[done], start[done], -starts[done])
        at = np.flatnonzero(phrase)
        for row in zip(*(x[at].tolist() for x in (key, doc, mark, start)), batch.column(6).take(pa.array(at)).to_pylist(), strict=True):
            if size > CHUNK and row[0] != rows[-1][0]:
                yield from _settled(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield from _settled(rows)


def cut(text: bytes, ranges: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left, for ranges (start, starts) of repeated strings."""
    removed = runs = at = 0
    left = []
    end = -1
    for start, starts in sorted(ranges):
        stop = start + starts - 1 + LENGTH
        if start > end:
            left.append(text[at:start])
            runs += 1
        removed += max(0, stop - max(end, start))
        end = at = max(end, stop)
    left.append(text[at:])
    return removed, runs, b"".join(left)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, mark, n_bytes, n_removed, n_spans, kept) of (doc, mark, text, whole, more)."""
    for batch in batches:
        lists = [batch.column(c).to_pylist() for c in ("whole", "more")]
        at = 0
        for docs, marks, raw in _rows_of(batch):
            found = [cut(x, [(r["start"], r["starts"]) for y in both for r in y or ()]) for x, *both in zip(raw, *(y[at : at + len(raw)] for y in lists), strict=True)]
            at += len(raw)
            removed, runs, left = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(marks), *(pa.array(x, pa.int64()) for x in ([len(x) for x in raw], removed, runs)), pa.array(left, pa.binary())], ["doc", "mark", "n_bytes", "n_removed", "n_spans", "kept"])


#: Stands for a null id.
_NULL = -(2**63)


def _numbered(df: DataFrame, id: str) -> DataFrame:
    """df with doc: a number of its id that sorts like the id."""
    if isinstance(df.schema[id].dataType, T.IntegralType):
        return df.withColumn("doc", F.coalesce(F.col(id).cast("long"), F.lit(_NULL)))
    return numbered(df, id, "doc").withColumn("doc", F.coalesce("doc", F.lit(_NULL)))


def deduplicated(df: DataFrame, id: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): kept is the text's remaining bytes.

    hot: the distinct phrases of a trigger from which on it is split.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = _numbered(df.select(F.col(id).alias("id"), F.col(text).alias("text")), "id")
    twice = not known.groupBy("doc").count().filter("count > 1").isEmpty()
    mark = F.xxhash64("text") if twice else F.lit(0).cast("long")
    docs = known.select("doc", mark.alias("mark"), "text")

    seen = docs.filter(F.pmod(F.xxhash64("doc", "mark"), F.lit(LOOK)) == 0).mapInArrow(_crowded, "trigger long, phrases long")
    crowded = seen.groupBy("trigger").agg(F.sum("phrases").alias("n")).filter(F.col("n") > hot // LOOK).orderBy(F.desc("n"), "trigger").limit(KNOWN)
    split = np.array(sorted(r.trigger for r in crowded.select("trigger").collect()), dtype=np.int64)
    dealt = docs.mapInArrow(_phrases(split), _PHRASE).repartition(parts, "trigger").sortWithinPartitions("trigger", "phrase", "doc", "mark", "pos")
    ranges = dealt.mapInArrow(_repeats(hot), _RANGE).groupBy("doc", "mark").agg(F.collect_list(F.struct("trigger", "start", "starts", "kind")).alias("ranges"))
    lists = stored(ranges.mapInArrow(_ranges, _LISTS), "ranges")

    # the same exchange of texts serves both joins
    texts = docs.repartition(parts, "doc", "mark")
    rest = texts.join(lists.filter(F.size("open") > 0).select("doc", "mark", "open"), ["doc", "mark"])
    sent = rest.mapInArrow(_suffixes_of, _SUFFIX).repartition(parts, "key").sortWithinPartitions("key", "second", "doc", "mark", "start")
    more = sent.mapInArrow(_compared, _REPEAT).groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "starts")).alias("more"))
    every = texts.join(lists.select("doc", "mark", "whole"), ["doc", "mark"], "left").join(more, ["doc", "mark"], "left")
    cuts = every.mapInArrow(_cuts, "doc long, mark long, n_bytes long, n_removed long, n_spans long, kept binary")
    kind = df.schema[id].dataType
    if isinstance(kind, T.IntegralType):
        return cuts.select(F.when(F.col("doc") != _NULL, F.col("doc")).cast(kind).alias(id), "n_bytes", "n_removed", "n_spans", "kept")
    names = known.select("doc", F.col("id").alias(id)).distinct()
    return cuts.join(names, "doc").select(id, "n_bytes", "n_removed", "n_spans", "kept")
