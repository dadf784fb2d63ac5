"""The pipeline's stages, one by one on what the one before kept."""

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from gridloom.llm import mixing, neardup, queries, secrets, stages
from gridloom.llm.common import stored

from ..oracle import compare, connect


def test_stages(spark, folder):
    docs = before = spark.read.parquet(f"{folder[0]}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, folder[0]), name.replace(" ", "-"))
        kept[name] = docs.collect()
        if name != "tokens":
            assert docs.columns == before.columns
    texts = {i: t or "" for i, t in enumerate(folder[1])}
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in kept.items()}
    assert set(ids["near duplicates"]) < set(ids["toxicity"]) and max(ids["near duplicates"].values()) == 1
    components = {r.doc_id: r.component_id for r in queries.op6_near_duplicates(spark, folder[0]).collect()}
    assert {components[i] for i in ids["near duplicates"]} == {components[i] for i in ids["toxicity"]}
    assert ids["secrets"] == ids["near duplicates"]
    for r in kept["secrets"]:
        assert ("[secret]" in (r.text or "")) or (r.text or "") == texts[r.doc_id]
        assert r.n_chars == len(r.text or "")
    assert not secrets.find_secrets(spark.createDataFrame([(r.text,) for r in kept["secrets"]], "text string")).filter("size(base) > 0").count()
    assert max(ids["mix"].values()) <= 3 and set(ids["mix"]) <= set(ids["secrets"])
    assert ids["tokens"] == ids["mix"]


def test_the_order_of_the_mix_reaches_the_tokens(spark, folder):
    """The slots of a mix made apart give the order, whatever order files are read in."""
    docs = stored(spark.read.parquet(f"{folder[0]}/documents.parquet"), "docs")
    known, taken = mixing.mixed(docs, also=["doc_id"])
    size = {r.row: (r.size, r.doc_id) for r in known.collect()}
    slots, words = {}, Counter()
    for r in taken.collect():
        slots[r.row, r["pass"]] = min(slots.get((r.row, r["pass"]), r.slot), r.slot)
        words[r.row, r["pass"]] += r.words
    want = sorted((slots[k], size[k[0]][1]) for k, n in words.items() if 2 * n >= size[k[0]][0])
    mixed = stored(stages.mixed(spark, docs, folder[0]), "mixed")
    read = stages.tokenized(spark, mixed, folder[0]).orderBy("place").collect()
    assert len({r.place for r in read}) == len(read) == len(want) > 50
    # documents that begin in one slot may stand in any order
    assert [sorted(i for s, i in want if s == slot) for slot in dict.fromkeys(s for s, _ in want)] == _groups([r.doc_id for r in read], Counter(s for s, _ in want))
    assert stages.tokenized(spark, spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, lang string, source string"), "").first().place is None


def _groups(ids, sizes):
    out, at = [], 0
    for slot in sorted(sizes):
        out.append(sorted(ids[at : at + sizes[slot]]))
        at += sizes[slot]
    return out


def test_rows_with_one_id(spark, folder):
    frame = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(20)
    twice = frame.union(frame)
    assert stages.without_copies(spark, twice, folder[0]).groupBy("doc_id").count().filter("count > 1").isEmpty()


def test_run(spark, folder, empty):
    assert corpus_pipeline.run(spark, folder[0]).count() > 10
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    for name, sql in queries.oracle_sql().items():
        assert compare(queries.queries()[name](spark, sf), connect(sf), sql) > 0


def test_copies_with_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(80)]
    near = lambda i: " ".join([*base[:-1], f"end{i}"])
    other = lambda i: " ".join(f"o{i}x{k}" for k in range(40))
    rows = [(1, other(1), "a"), (None, other(1), "a"), (None, other(2), "a"), (None, other(2), "b"), (None, near(0), "a"), (None, near(1), "a"), (5, other(3), "a"), (6, other(3), "a"), (6, other(4), "a"), (7, other(5), "a"), (7, near(2), "a"), (None, "", "a"), (None, "", "b"), (None, "", "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = Counter((r.doc_id, r.text) for r in stages.without_copies(spark, frame, "").collect())
    assert kept == {(1, other(1)): 1, (None, other(2)): 1, (5, other(3)): 1, (6, other(4)): 1, (7, other(5)): 1, (7, near(2)): 1, (None, ""): 2}


def test_near_copies_whose_ids_are_null_or_repeated(spark):
    """Links are found by the text of the row itself, whatever other texts have its id."""
    base = [f"w{i}" for i in range(80)]
    near = lambda i: " ".join([*base[:-1], f"end{i}"])
    other = lambda i: " ".join(f"o{i}x{k}" for k in range(40)) + f" tail{i}"
    rows = [(i, near(i)) for i in range(20)] + [(i, other(i % 5) + (f" z{i}" if i % 2 else "")) for i in range(20)] + [(None, near(50)), (None, near(51))]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component) for r in found) == Counter([(i, 0) for i in range(20)] + [(i, i % 5) for i in range(20)] + [(None, 0)] * 2)


def test_columns_of_any_name_and_kind(spark, folder):
    """Names that the stages use themselves, maps, null and repeated ids: every stage gives back what it got."""
    frame = spark.read.parquet(f"{folder[0]}/documents.parquet")
    frame = frame.union(frame.filter("doc_id < 6")).withColumn("doc_id", F.when(F.col("doc_id") % 7 != 3, F.col("doc_id")))
    for name in ("_mark", "_score", "_drop", "_id", "_of", "_slot", "_copies", "_one", "_row", "_h", "x0", "slots", "spans", "row", "one", "ids", "n_tokens"):
        frame = frame.withColumn(name, F.create_map(F.lit(name), F.col("size")) if name in ("_one", "_drop") else F.lit(name))
    docs = stored(frame, "named")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, folder[0]), "named-" + name.replace(" ", "-"))
        if name != "tokens":
            assert docs.columns == before.columns and docs.dtypes == before.dtypes
            assert docs.filter("_mark != '_mark' or ids != 'ids' or element_at(_one, '_one') != size").isEmpty()
    assert docs.count() > 10 and docs.columns == ["doc_id", "lang", "source", "place", "n_tokens", "ids"]
