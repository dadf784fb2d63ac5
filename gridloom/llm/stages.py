"""What the pipeline does with the operators' findings: docs in, docs out.

Each stage gets and gives the columns of documents and any others, whatever their names
and kinds: while a stage is at work, columns that it does not know have numbers for names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, mixing, neardup, secrets, toxicity
from .common import stored, table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _own_names(stage: Stage) -> Stage:
    """The stage on docs whose other columns can't clash with names of its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in _KNOWN else f"x{i}" for i, c in enumerate(docs.columns)]
        made = stage(spark, docs.toDF(*names), sf_dir)
        return made.toDF(*docs.columns) if made.columns == names else made

    return run


def _marked(docs: DataFrame) -> DataFrame:
    """docs with a key that tells rows with one id and different texts apart."""
    return docs.withColumn("_mark", F.xxhash64("text"))


def _matched(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of docs joined to found on (doc_id, _mark), null ids included; found's other columns get a _ in front."""
    right = found.select(F.col("doc_id").alias("_id"), F.col("_mark").alias("_of"), *[F.col(c).alias(f"_{c}") for c in found.columns if c not in ("doc_id", "_mark")])
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    return _marked(docs).join(right, on, how)


@_own_names
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels that are not held out, doesn't call toxic."""
    texts = docs.select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    model = toxicity.train(toxicity.sample(labels, "toxic", "doc_id").join(texts, "doc_id"))
    return toxicity.score(docs, model, out="_score").filter("_score < 0.5").drop("_score")


@_own_names
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of the least id; of equal rows without words one."""
    found = stored(neardup.near_duplicates(docs, "doc_id", "text").select("doc_id", F.col("mark").alias("_mark"), "root"), "found")
    first = found.filter("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_mark")).alias("of"))
    blank = found.filter("root is null").select("doc_id", "_mark").distinct()
    kept = _matched(docs, first.select("of.doc_id", "of._mark", F.lit(True).alias("one")).union(blank.withColumn("one", F.lit(False))), "inner")
    if not found.groupBy("doc_id", "_mark").count().filter("count > 1").isEmpty():
        whole = F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"})  # maps can't be compared
        blank = kept.filter("not _one").withColumn("_row", F.md5(whole)).dropDuplicates(["_row"]).drop("_row")
        kept = kept.filter("_one").dropDuplicates(["doc_id", "_mark"]).union(blank)
    return kept.select(*docs.columns)


@_own_names
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    found = secrets.find_secrets(_marked(docs.select("doc_id", "text")), keep=["doc_id", "_mark"], runs=True)
    found = found.filter(F.size("runs") > 0).select("doc_id", "_mark", "runs").dropDuplicates(["doc_id", "_mark"])
    clean = secrets.redacted(F.col("text"), F.col("_runs"))
    met = _matched(docs, found, "left").withColumn("text", F.when(F.col("_runs").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        met = met.withColumn("n_chars", F.when(F.col("_runs").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return met.select(*docs.columns)


@_own_names
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, each as often as its slots take it: once for each pass of
    which they take at least half of its words, at the first of these slots."""
    known, taken = mixing.mixed(_marked(docs), also=["_mark"])
    times = taken.groupBy("row", "pass").agg(F.sum("words").alias("words"), F.min("slot").alias("slot")).join(known.select("row", "size"), "row").filter(F.col("words") * 2 >= F.col("size"))
    copies = times.groupBy("row").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    found = known.join(copies, "row").groupBy(F.col("id").alias("doc_id"), "_mark").agg(F.max("slots").alias("slots"))
    met = _matched(docs, found, "inner").withColumn("_slot", F.explode("_slots"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return met.repartitionByRange(parts, "_slot").sortWithinPartitions("_slot").select(*docs.columns)


def _placed(docs: DataFrame) -> DataFrame:
    """docs with place, which sorts rows as they were written: by the number of their file, then by where in it
    they stand. Readers deal out files in any order. Null where docs is not read from Spark's files."""
    try:
        return docs.withColumn("place", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("long") * 2**40 + F.col("_metadata.row_index"))
    except AnalysisException:  # no files
        return docs.withColumn("place", F.lit(None).cast("long"))


@_own_names
def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, place, n_tokens, ids) of every document; sorted by place they are in the order of the mix."""
    texts = _placed(docs.select("doc_id", "lang", "source", "text"))
    ids = bpe.encode(texts, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, apart=bpe.SPACES).drop("text")
    return ids.select("doc_id", "lang", "source", "place", F.size("ids").cast("long").alias("n_tokens"), "ids")
