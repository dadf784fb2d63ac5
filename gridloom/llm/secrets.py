"""Secret scans and the linking of credentials that come in parts.

Built-in functions only. A pattern's spans are found by writing a mark before and
after each match, cutting at the marks, and adding up lengths, which is a running sum over
the parts as rows, so that a text with very many matches takes time in proportion; a mark in the
text itself is first replaced by another control character, which no pattern matches.

Base spans stand on their own: assignments of a secret, access identifiers, long
hexadecimal numbers. Weak candidates do not: names of accounts, mixed strings without a
name, addresses of services. All are parts of credentials: identifiers, secrets,
endpoints. An interval join over the scopes of parts, SCOPE characters around each,
finds those that lie together: a weak identifier or secret is reported with the other
within its scope, an endpoint with both. Scopes are cut into bins of SCOPE characters,
so that a join group is what one stretch of one text holds.

Edge cases: null and empty texts have no spans; touching spans of different kinds all
count; equal rows are scanned each on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Characters between parts of one credential, at most.
SCOPE = 300
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# (kind, pattern, least characters of the match, role of the part); an assignment's value is checked apart
BASE = (("assign", ASSIGN, 0, "secret"), ("access", r"AKIA[A-Z0-9]{16,}", 20, "identifier"), ("hex", r"[0-9a-f]{24,}", 24, "secret"))
WEAK = (
    ("account", r"""(?i)\b(?:user_?name|user_?id|login|client_?id|account_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@=-]{3,}""", 0, "identifier"),
    ("mixed", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{20,}={0,2}", 0, "secret"),
    ("endpoint", r"""(?i)\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\s"'<>]{4,}""", 0, "endpoint"),
)
_KINDS = BASE + WEAK
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_RUN = "array<struct<start:int,end:int>>"


def parts(text: Column, kind: int) -> Column:
    """The text cut before and after each match of a kind: array<struct<kind, pos, size, bytes, good>>, null without
    a match. Every second part is a match, good if it is long enough."""
    name, pattern, least, _ = _KINDS[kind]

    def part(p: Column, i: Column) -> Column:
        good = F.length(p) >= least
        if name == "assign":
            good = F.length(F.regexp_extract(p, pattern, 2)) >= 6
        good = F.when(i % 2 == 1, good).otherwise(False)
        return F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.length(p).alias("size"), F.octet_length(p).alias("bytes"), good.alias("good"))

    cut = F.split(F.regexp_replace(text, pattern, "\x01$0\x01"), "\x01")
    return F.when(text.rlike(pattern), F.transform(cut, part))


def spans(scans: DataFrame) -> DataFrame:
    """(row, kind, start, end, lo, hi) of good matches, from (row, hits); start and end count code points, lo and hi bytes."""
    rows = scans.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("x")).select("row", "x.*")
    upto = W.partitionBy("row", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = rows.withColumns({"end": F.sum("size").over(upto).cast("int"), "hi": F.sum("bytes").over(upto).cast("int")})
    return ends.filter("good").select("row", "kind", (F.col("end") - F.col("size")).alias("start"), "end", (F.col("hi") - F.col("bytes")).alias("lo"), "hi")


def _met(some: DataFrame, others: DataFrame, gap: int, how: str) -> DataFrame:
    """Join of spans of one row with less than gap code points from the end of one to the start of the other, in bins of SCOPE."""
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / SCOPE), F.floor(hi / SCOPE)))
    left = some.withColumn("cell", cells(F.col("start"), F.col("end")))
    right = others.select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"), cells(F.col("start") - gap, F.col("end") + gap).alias("cell"))
    on = (left["row"] == right["r"]) & (left["cell"] == right["cell"]) & (left["start"] < right["e"] + gap) & (left["end"] + gap > right["s"])
    hit = left.join(right, on, "left_semi").drop("cell").distinct()
    return hit if how == "semi" else some.join(hit, some.columns, "left_anti")


def linked(base: DataFrame, weak: DataFrame) -> DataFrame:
    """Those weak candidates that lie with the parts that complete them; both are spans."""
    every = base.union(weak)
    kinds = lambda role: [i for i, k in enumerate(_KINDS) if k[3] == role]
    of = lambda frame, role: frame.filter(F.col("kind").isin(kinds(role)))
    near = lambda some, others: _met(some, others, SCOPE + 1, "semi")
    identifiers = near(of(weak, "identifier"), of(every, "secret"))
    found = near(of(weak, "secret"), of(every, "identifier"))
    endpoints = near(near(of(weak, "endpoint"), of(every, "identifier")), of(every, "secret"))
    return identifiers.union(found).union(endpoints)


def find_secrets(df: DataFrame, text: str = "text", keep: list[str] | None = None, runs: bool = False) -> DataFrame:
    """(keep..., base, spans) of every row: its base spans, and with the linked ones.

    keep: columns of df to carry, by default all but the text. With runs there is one more
    column, the places of overlapping spans together, in bytes, for redacted(). Rows are
    numbered in a stored table without the texts, so that every text is read once.
    """
    keep = [c for c in df.columns if c != text] if keep is None else keep
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), "\x01", "\x02")
    hits = F.concat(*[F.coalesce(parts(plain, i), F.array().cast("array<struct<kind:int,pos:int,size:int,bytes:int,good:boolean>>")) for i in range(len(_KINDS))])
    scans = stored(df.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)], hits.alias("hits"), F.monotonically_increasing_id().alias("row")), "scans")
    found = stored(spans(scans), "spans")
    base, weak = found.filter(F.col("kind") < len(BASE)), found.filter(F.col("kind") >= len(BASE))
    every = base.union(linked(base, _met(weak, base, 0, "anti")))
    every = stored(every, "found") if runs else every
    lists = every.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    if runs:
        before = W.partitionBy("row").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, -1)
        upto = W.partitionBy("row").orderBy("lo", "hi").rowsBetween(W.unboundedPreceding, W.currentRow)
        new = every.withColumn("new", (F.col("lo") >= F.coalesce(F.max("hi").over(before), F.lit(0))).cast("int")).withColumn("run", F.sum("new").over(upto))
        whole = new.groupBy("row", "run").agg(F.min("lo").alias("start"), F.max("hi").alias("end")).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
        lists = lists.join(whole, "row")
    out = scans.drop("hits").join(lists, "row", "left")
    all_spans = F.coalesce("spans", F.array().cast(_SPAN))
    more = [F.coalesce("runs", F.array().cast(_RUN)).alias("runs")] if runs else []
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], F.filter(all_spans, lambda s: s.kind < len(BASE)).alias("base"), all_spans.alias("spans"), *more)


def written(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k[0]) for k in _KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")


def count(found: Column, name: str) -> Column:
    kind = [k[0] for k in _KINDS].index(name)
    return F.size(F.filter(found, lambda s: s.kind == kind)).cast("long")


def redacted(text: Column, runs: Column, mark: str = "[secret]") -> Column:
    """The text with each of the runs of find_secrets replaced by the mark; a null text stays null."""
    raw = text.cast("binary")
    end = lambda i: F.when(i > 0, F.element_at(runs, F.greatest(i, F.lit(1))).getField("end")).otherwise(0)
    stop = lambda i: F.coalesce(F.try_element_at(runs, i + 1).getField("start"), F.octet_length(text))
    gaps = F.transform(F.sequence(F.lit(0), F.size(runs)), lambda i: F.substring(raw, end(i) + 1, stop(i) - end(i)).cast("string"))
    return F.when(F.size(runs) > 0, F.array_join(gaps, mark)).otherwise(text)
