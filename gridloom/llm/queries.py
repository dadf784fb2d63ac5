"""The numbered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.scratch import new_path

from . import bpe, exponion, idfiles, mincut, mixing, neardup, oracles, quality, quotes, secrets, substrings, syncmers, toxicity, whitening, wordtokens
from .common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE, END = public_tokenizers.path("word_bpe_49k.json"), 1


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, the first slot that takes any, and the number of those slots."""
    docs, taken = mixing.mixed(table(spark, sf_dir, "documents"))
    sums = taken.groupBy("row", "slot").agg(F.sum("words").alias("words")).groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots"))
    zero = F.lit(0).cast("long")
    return docs.join(sums, "row", "left").select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", zero).alias("taken"), "first_slot", F.coalesce("n_slots", zero).alias("n_slots"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.train(toxicity.sample(labels, "toxic", "doc_id").join(docs, "doc_id"))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _edited(texts: list[str], following: list[str]) -> list[tuple]:
    """Digests of each text, of its edit with the head of the text that follows, and how like they are."""
    out, known = [], {}
    for text, after in zip(texts, following, strict=True):
        n = len(text)
        edit = text[: n - n // 4] + after[: n // 4]
        own = known.pop(text, None) or syncmers.fingerprint(text)
        new = syncmers.fingerprint(edit)
        known = {after: syncmers.fingerprint(after)}  # most often the next text
        sha = hashlib.sha256(edit.encode("utf-8", "surrogatepass")).hexdigest()
        out.append((n, sha, syncmers.written(own), syncmers.written(new), syncmers.likeness(own, new), syncmers.likeness(own, known[after])))
    return out


def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and of its edited text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return syncmers.successive(docs, _edited, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op4_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without its repeated strings of 100 bytes."""
    left = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return mincut.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of 85 % of five-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = neardup.near_duplicates(docs)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def op7_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose messages quote the two before them, linked again and without quotes."""
    talks = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "text")
    mails = quotes.quoting(talks)
    linked = quotes.conversations(mails)
    return linked.select(F.col("conv").alias("conv_id"), "turn", F.col("to_turn").alias("parent_turn"), F.col("root_turn"), "depth", F.sha2("own", 256).alias("text_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every text."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [secrets.count(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judged(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids again, and give digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, apart=bpe.SPACES).drop("text")
    return bpe.decode(ids, RANKS).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds."""
    found, centroids = exponion.clustered(table(spark, sf_dir, "embeddings"))
    if not len(centroids):
        return found.withColumn("centroid_sha256", F.lit(""))
    digests = F.create_map(*[F.lit(v) for c, x in enumerate(centroids) for v in (c, exponion.centroid_digest(x))])
    return found.withColumn("centroid_sha256", digests[F.col("cluster")])


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every vector."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, written to files in the order of documents and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = wordtokens.tokenized(docs, WORD_BPE, out="packed", end=END, form=idfiles.packed, kind="binary")
    path = new_path(spark, "token-files")
    idfiles.write(ids, path)
    return idfiles.read(spark, path, docs.schema["doc_id"].dataType.simpleString(), with_ids=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_toxicity": op2_toxicity,
        "op3_syncmer_fingerprints": op3_syncmer_fingerprints,
        "op4_repeated_substrings": op4_repeated_substrings,
        "op5_main_text": op5_main_text,
        "op6_near_duplicates": op6_near_duplicates,
        "op7_quotation_links": op7_quotation_links,
        "op8_secrets": op8_secrets,
        "op9_quality_rules": op9_quality_rules,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_centroid_clusters": op11_centroid_clusters,
        "op12_whitening": op12_whitening,
        "op13_token_files": op13_token_files,
    }


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can say; tests/llm compares all with brute force."""
    return {"op1_mix_sources": oracles.MIX, "op6_near_duplicates": oracles.NEAR, "op7_quotation_links": oracles.QUOTES, "op9_quality_rules": oracles.QUALITY, "op11_centroid_clusters": oracles.CLUSTERS}
