"""Token ids of texts, their coding, and files of them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridloom.llm import idfiles, queries, rans, wordtokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [*"abcXYZ019 '\n\t.,;!?-_<|>/éÀßſİıΣσ日本😀́  \x1c\x85²¼ªº×÷ŉǅ", "'s", "'ll", "<|endoftext|>", "</w>", "  "]


def said(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_words_are_those_of_the_library():
    rng, words = random.Random(5), wordtokens.Words(PATH, wordtokens.Rules())
    for _ in range(20):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(60))) for _ in range(200)]
        ids, ends = words.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == said(texts)


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, rans.CHECK, rans.CHECK + 1, rans.BLOCK, rans.BLOCK + 1, 3 * rans.BLOCK - 7])
def test_coding_there_and_back(n):
    ids = np.random.default_rng(n).zipf(1.3, n) % 49_000
    table = rans.Table(rans.shares(np.bincount(ids, minlength=49_408)))
    coded = rans.encode(ids, table)
    assert rans.decode(coded, table).tolist() == ids.tolist()
    for a, b in ((0, n // 2), (n // 3, n // 2), (max(0, n - 1), n), (n // 2, n + 5)):
        assert rans.decode(coded, table, a, b).tolist() == ids[a:b].tolist()


def test_coded_size_is_near_the_entropy():
    ids = np.random.default_rng(0).zipf(1.3, 400_000) % 49_000
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    bits = -(share * np.log2(share)).sum()
    coded = rans.encode(ids, rans.Table(rans.shares(counts)))
    assert bits * 0.99 < 32 * len(coded.words) / len(ids) < bits * 1.03


def test_tables():
    for counts in ([0, 5], [1] * 1000, [1] * 49_000 + [10**12], [3, 0, 0, 1], np.ones(1 << 20, dtype=int)):
        frequency = rans.shares(np.array(counts))
        assert frequency.sum() == 1 << rans.SCALE and ((frequency > 0) == (np.array(counts) > 0)).all()
    assert rans.shares(np.array([], dtype=int)).tolist() == []
    one = np.full(70_000, 7)
    table = rans.Table(rans.shares(np.bincount(one)))
    assert not len(rans.encode(one, table).words) and (rans.decode(rans.encode(one, table), table) == 7).all()
    with pytest.raises(ValueError, match="no place"):
        rans.encode(np.array([3]), table)


def test_query_against_the_library(answer, folder):
    rows = {r.doc_id: r for r in answer("op13_token_files")}
    texts, start = folder[1], 0
    assert len(rows) == len(texts)
    for i, ids in enumerate(said(texts)):
        ids.append(queries.END)
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)


def test_query_without_rows(spark, empty):
    assert queries.op13_token_files(spark, empty).count() == 0


def test_spans_and_whole_ids(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").withColumn("packed", F.lit(1)).withColumn("row", F.lit("x"))
    idfiles.write(wordtokens.tokenized(docs, PATH, end=1), str(tmp_path / "x"), ids="ids")
    read = idfiles.read(spark, str(tmp_path / "x")).orderBy("doc_id").collect()
    want = [[*ids, 1] for ids in said(folder[1])]
    assert [r.ids for r in read] == want
    flat = [i for ids in want for i in ids]
    for a, b in ((0, 3), (100, 30_000), (len(flat) - 2, len(flat) + 9), (5, 5)):
        found = idfiles.read_span(spark, str(tmp_path / "x"), a, b).orderBy("at").collect()
        assert [i for r in found for i in r.ids] == flat[a:b] and (not found or found[0].at == a)


def test_repeated_and_null_ids(spark, tmp_path):
    rows = [(None, [5, 6]), ("b", []), ("b", [7]), ("a", None), ("a", [70_000])]
    idfiles.write(spark.createDataFrame(rows, "name string, ids array<int>"), str(tmp_path / "x"), "name", "ids")
    read = idfiles.read(spark, str(tmp_path / "x"), "string").orderBy("start", "n_tokens").collect()
    assert sorted((r.doc_id or "~", r.ids) for r in read) == [("a", []), ("a", [70_000]), ("b", []), ("b", [7]), ("~", [5, 6])]
    assert read[-1].doc_id is None and read[-1].start == 2


def test_damage_is_seen():
    ids = [np.arange(50) % 7, np.arange(9)]
    table = rans.Table(rans.shares(np.bincount(np.concatenate(ids))))
    data = idfiles.record(3, 11, ["x", None], ids, table) + b"\n"
    found = list(idfiles.records(data * 2))
    assert [f.file for f in found] == [3, 3] and found[0].names == ["x", None] and found[0].sizes.tolist() == [50, 9]
    assert rans.decode(found[1].coded, table).tolist() == np.concatenate(ids).tolist()
    for at in (5, 60, len(data) // 2, len(data) - 3):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(idfiles.records(bytes(broken)))


def test_a_piece_is_looked_up_once_in_a_slice():
    import pyarrow as pa

    words = wordtokens.Words(PATH, wordtokens.Rules())
    looked = []
    look = words.pieces.look
    words.pieces.look = lambda keys: looked.append(len(keys)) or look(keys)
    texts = ["the cat and the dog", None, "", "the  dog", "Ω the Ω dog"] * 50
    ids, ends = words.encode(pa.array(["", *texts]).slice(1))
    assert max(looked) <= 6
    want = [words.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == want
    assert [len(x) for x in words.encode([])] == [0, 1]
