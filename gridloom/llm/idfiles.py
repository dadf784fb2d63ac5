"""Files of token ids: written in the order of documents, read whole or in part.

A data set is a folder with

* `records/kind=data/*.txt`: one file for each range of document ids, in their order. A file is a
  row of records (HEAD and what follows it, see `record`), each with whole documents of about
  PART ids: document ids, numbers of ids and their CRC-32, then the coded ids of rans.py with
  checkpoints and block checksums, then a CRC-32 of the record. A record ends with a line feed.
* `records/kind=index/*.txt`: a line of JSON for each record: file, first, n_ids, n_docs.
* `table`: Parquet (id, frequency), the one table that all blocks share, from counts of all ids.
* `manifest`: Parquet (file, start, n_ids, n_docs); start counts the ids of all files before.

Spark's own committer writes them all, so a lost task leaves nothing behind, and any file system
that Spark knows will do. A block needs nothing but the table to be decoded, a stretch between
checkpoints nothing but its states, so files, records and stretches are decoded apart.

Edge cases: documents without ids are kept with none; null ids of documents come last, equal ones stand
in the order in which they were read; an empty table gives a data set without files; other columns
are left out. Ids of documents may be of any type that casts to a string and back.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rans
from .common import column_slices, discard, stored

#: Ids of a record and of a file, about, and files whose ids are summed in one group.
PART, FILE, GROUP = 1 << 22, 1 << 24, 256
#: Magic, version; bytes of the record; file; ids before it in the file; documents; ids; words; bytes of document ids.
HEAD = struct.Struct("<4sI7Q")
MAGIC, VERSION = b"GLID", 1
_NULL = 0xFFFFFFFF
_SIZE = struct.Struct("<BI")


def pack(ids: np.ndarray) -> bytes:
    """Ids of one document for the way to their file: width and number, then the compressed ids."""
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return _SIZE.pack(width, len(ids)) + pa.Codec("zstd", 1).compress(np.asarray(ids, dtype=f"<u{width}").data, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, n = _SIZE.unpack_from(data)
    if not n:
        return np.empty(0, dtype=np.uint32)
    raw = pa.Codec("zstd").decompress(memoryview(data)[_SIZE.size :], decompressed_size=n * width)
    return np.frombuffer(raw, dtype=f"<u{width}").astype(np.uint32)


def packed(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A column of pack() from the ids of some documents and where each one's end."""
    return pa.array([pack(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())


def record(file: int, first: int, names: list[str | None], parts: list[np.ndarray], table: rans.Table) -> bytes:
    """One record: HEAD, numbers of ids (u32), CRC-32 of ids (u32) and lengths of names (u32, the largest for null) of
    the documents, names, then block checksums (u32), places (u64) and states (u64) of checkpoints, words (u32), CRC-32."""
    ids = np.concatenate(parts) if parts else np.empty(0, dtype=np.uint32)
    coded = rans.encode(ids, table)
    raw = [None if n is None else n.encode("utf-8", "surrogatepass") for n in names]
    u4 = lambda values: np.asarray(values, dtype="<u4").tobytes()
    body = b"".join(
        [
            u4([len(p) for p in parts]),
            u4([rans.checksum(p) for p in parts]),
            u4([_NULL if n is None else len(n) for n in raw]),
            name := b"".join(n or b"" for n in raw),
            coded.sums.astype("<u4").tobytes(),
            coded.places.astype("<u8").tobytes(),
            coded.states.astype("<u8").tobytes(),
            coded.words.astype("<u4").tobytes(),
        ]
    )
    head = HEAD.pack(MAGIC, VERSION, HEAD.size + len(body) + 4, file, first, len(parts), len(ids), len(coded.words), len(name))
    return head + body + struct.pack("<I", zlib.crc32(body, zlib.crc32(head)))


class Record:
    """A record read from a file's bytes at a place."""

    def __init__(self, data: memoryview, at: int) -> None:
        magic, version, size, self.file, self.first, docs, n, words, names = HEAD.unpack_from(data, at)
        if magic != MAGIC or version != VERSION:
            raise ValueError("this is no record of token ids")
        if zlib.crc32(data[at : at + size - 4]) != struct.unpack_from("<I", data, at + size - 4)[0]:
            raise ValueError("a record does not have its checksum")
        self.end = at + size + 1  # and a line feed
        place = at + HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal place
            found = np.frombuffer(data, dtype=kind, count=count, offset=place)
            place += found.nbytes
            return found

        self.sizes, self.sums, length = (take("<u4", docs) for _ in range(3))
        raw, ends = bytes(take("u1", names)), np.cumsum(np.where(length == _NULL, 0, length))
        self.names = [None if k == _NULL else raw[e - k : e].decode("utf-8", "surrogatepass") for k, e in zip(length.tolist(), ends.tolist(), strict=True)]
        blocks, segments = -(-n // rans.BLOCK), -(-n // rans.CHECK)
        sums, places = take("<u4", blocks), take("<u8", segments)
        states = take("<u8", segments * rans.LANES).reshape(-1, rans.LANES)
        self.coded = rans.Coded(n, take("<u4", words), states, places, sums)


def records(data: bytes) -> Iterator[Record]:
    view, at = memoryview(data), 0
    while at < len(view):
        found = Record(view, at)
        at = found.end
        yield found


def _counts(rows: DataFrame) -> np.ndarray:
    """How often each id occurs in the column packed. At most 2^SCALE numbers come to the driver, as a table holds no more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for a, b in column_slices(batch.column("packed"), PART):
                ids = np.concatenate([unpack(data.as_py()) for data in batch.column("packed").slice(a, b - a)])
                if len(ids) and ids.max() >= 1 << rans.SCALE:
                    raise ValueError(f"ids must lie below {1 << rans.SCALE}")
                more = np.bincount(ids)
                if len(more) > len(total):
                    total = np.concatenate([total, np.zeros(len(more) - len(total), dtype=np.int64)])
                total[: len(more)] += more
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["token", "count"])

    found = rows.select("packed").mapInArrow(run, "token long, count long").groupBy("token").agg(F.sum("count").alias("count")).collect()
    out = np.zeros(max((r["token"] for r in found), default=-1) + 1, dtype=np.int64)
    for r in found:
        out[r["token"]] = r["count"]
    return out


def write(df: DataFrame, path: str, id: str = "doc_id", ids: str = "packed") -> None:
    """Write the columns id and ids (array<int>, or pack()ed as binary) of df as a data set in a new folder."""
    spark = df.sparkSession
    if not isinstance(df.schema[ids].dataType, T.BinaryType):
        df = _packing(df, ids)
    rows = stored(df.select(F.col(id).alias("key"), F.col(ids).alias("packed"), F.monotonically_increasing_id().alias("row")), "token-ids")
    counts = _counts(rows)
    table = rans.Table(rans.shares(counts))
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(table.frequency) if n] or [], "id int, frequency int").coalesce(1).write.parquet(f"{path}/table")
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts.sum()) // FILE))
    order = [F.col("key").asc_nulls_last(), F.col("row").asc()]
    ranged = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    frequency = table.frequency.astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, file, first = rans.Table(frequency), TaskContext.get().partitionId(), 0
        names: list[str | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def made() -> pa.RecordBatch:
            data = record(file, first, names, parts, table)
            line = json.dumps({"file": file, "first": first, "n_ids": held, "n_docs": len(parts)}).encode()
            return pa.RecordBatch.from_arrays([pa.array(["data", "index"]), pa.array([data, line], pa.binary())], ["kind", "value"])

        for batch in batches:
            for name, data in zip(batch.column("key"), batch.column("packed"), strict=True):
                ids = unpack(data.as_py())
                if parts and held + len(ids) > PART:
                    yield made()
                    first += held
                    names, parts, held = [], [], 0
                names.append(name.as_py())
                parts.append(ids)
                held += len(ids)
        if parts:
            yield made()

    made = ranged.select(F.col("key").cast("string").alias("key"), "packed").mapInArrow(run, "kind string, value binary")
    made.select("kind", F.col("value").cast("string").alias("value")).write.partitionBy("kind").option("lineSep", "\n").option("compression", "none").text(f"{path}/records")
    _manifest(spark, path).write.parquet(f"{path}/manifest")
    discard(rows)


def _packing(df: DataFrame, ids: str) -> DataFrame:
    fields = [f for f in df.schema.fields if f.name != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([pack(np.array(x.as_py() or [], dtype=np.int64)) for x in batch.column(ids)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), values], [*(f.name for f in fields), ids])

    return df.mapInArrow(run, T.StructType([*fields, T.StructField(ids, T.BinaryType())]))


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, n_ids, n_docs) from the index: sums of groups of files, then of the files in a group."""
    lines = spark.read.option("pathGlobFilter", "*.txt").text(f"{path}/records")
    lines = lines.filter("kind = 'index'") if "kind" in lines.columns else lines.filter("false")  # no files
    index = lines.select(F.from_json("value", "file long, first long, n_ids long, n_docs long").alias("x")).select("x.*")
    files = index.groupBy("file").agg(F.sum("n_ids").alias("n_ids"), F.sum("n_docs").alias("n_docs")).withColumn("group", F.floor(F.col("file") / GROUP))
    before = lambda window: F.coalesce(F.sum("n_ids").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    groups = files.groupBy("group").agg(F.sum("n_ids").alias("n_ids")).select("group", before(W.orderBy("group")).alias("base"))
    within = files.withColumn("inner", before(W.partitionBy("group").orderBy("file")))
    return within.join(groups, "group").select("file", (F.col("base") + F.col("inner")).alias("start"), "n_ids", "n_docs")


def _table(spark: SparkSession, path: str) -> np.ndarray:
    """The frequencies; at most 2^SCALE of them."""
    found = spark.read.schema("id int, frequency int").parquet(f"{path}/table").collect()
    out = np.zeros(max((r["id"] for r in found), default=-1) + 1, dtype=np.uint32)
    for r in found:
        out[r["id"]] = r["frequency"]
    return out


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(content, file): the data files; file is the number in their name."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{path}/records")
    if "kind" not in found.columns:  # no files
        return found.select("content", F.lit(0).cast("long").alias("file"))
    return found.filter("kind = 'data'").select("content", F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long").alias("file"))


def read(spark: SparkSession, path: str, id_type: str = "long", with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a data set; all ids are decoded and checked.

    start: ids of all documents before; ids_crc32 is computed from what was decoded. with_ids=False leaves ids out.
    """
    frequency = _table(spark, path)
    names = ["name", "at", "n_tokens", "ids_crc32", "file", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(frequency)
        for batch in batches:
            for data in batch.column("content"):
                for part in records(data.as_buffer()):
                    ids = rans.decode(part.coded, table)
                    ends = np.concatenate([[0], np.cumsum(part.sizes, dtype=np.int64)])
                    sums = [rans.checksum(ids[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    if sums != part.sums.tolist():
                        raise ValueError("a document does not have its checksum")
                    values = [pa.array(part.names, pa.string()), pa.array(part.first + ends[:-1], pa.int64()), pa.array(part.sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(np.full(len(sums), part.file), pa.int64())]
                    if with_ids:
                        values.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(values, names)

    kinds = "name string, at long, n_tokens long, ids_crc32 long, file long" + (", ids array<int>" if with_ids else "")
    docs = _files(spark, path).select("content").mapInArrow(run, kinds)
    manifest = spark.read.schema("file long, start long, n_ids long, n_docs long").parquet(f"{path}/manifest")
    return docs.join(manifest, "file").select(F.col("name").cast(id_type).alias("doc_id"), (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(at, ids): the ids numbered start to stop of the whole data set, a row for each record that has some.

    Only files that hold such ids are read, by the manifest, and of them only the stretches between checkpoints.
    """
    frequency = _table(spark, path)
    wanted = spark.read.schema("file long, start long, n_ids long, n_docs long").parquet(f"{path}/manifest").filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    numbers = [(r["file"], r["start"]) for r in wanted.collect()]  # files of one span

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, begins = rans.Table(frequency), dict(numbers)
        for batch in batches:
            for data in batch.column("content"):
                for part in records(data.as_buffer()):
                    base = begins[part.file] + part.first
                    lo, hi = max(start - base, 0), min(stop - base, part.coded.n)
                    if lo < hi:
                        ids = rans.decode(part.coded, table, lo, hi)
                        yield pa.RecordBatch.from_arrays([pa.array([base + lo], pa.int64()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], ["at", "ids"])

    files = _files(spark, path)
    return files.filter(F.col("file").isin([n for n, _ in numbers])).select("content").mapInArrow(run, "at long, ids array<int>")
