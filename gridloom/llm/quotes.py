"""Quotation linking: from messages that quote each other to conversations without quotes.

A message's lines are parsed by quote level (the number of > before them). What is left at
level 0 is the message's own text. The quoted passages of all levels, and their
lines, are normalised (lower case, single spaces) and hashed, as are the own texts and
their lines. A quote is joined to the nearest earlier message of its conversation with
an equal hash; if there is none, to the first message of all that has it, so that a text
that thousands of messages share makes one row. The message that most quoted characters of the
shallowest level that has a match point to is the parent: if the message answered is missing,
the one that it quoted. Parents are always earlier in (conversation, turn), so there are no
circles; roots and depths follow by doubling.

Edge cases: null and empty texts have an empty own text and quote nothing; a message
that only quotes has an empty own text; rows with equal conversation and turn are
all answered alike, the first own text in order counts as the original; conversations and turns
may be of any type that can be sorted; an empty table gives no rows; very long messages are one row each; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stored

_LEVEL = re.compile(r"((?:[ \t]{0,3}>)+)[ \t]?")
# How mail programs announce a quotation.
_INTRODUCED = re.compile(r"^(?:On|Am|Le|El)\b.{0,200}\b(?:wrote|schrieb|a écrit|escribió)\s?.{0,80}:\s*$")
_SPACE = re.compile(r"\s+")


def levels(text: str) -> list[tuple[int, str]]:
    """Passages of consecutive lines with one quote level."""
    out: list[tuple[int, list[str]]] = []
    for line in text.split("\n"):
        m = _LEVEL.match(line)
        level, rest = (m[1].count(">"), line[m.end() :]) if m else (0, line)
        if not out or out[-1][0] != level:
            out.append((level, []))
        out[-1][1].append(rest)
    return [(level, "\n".join(lines)) for level, lines in out]


def own_text(passages: list[tuple[int, str]]) -> str:
    """What the author wrote: level 0, without blank lines next to quotes and lines that announce them."""
    kept = []
    for i, (level, text) in enumerate(passages):
        if level:
            continue
        lines = text.split("\n")
        while i and lines and not lines[0].strip():
            lines.pop(0)
        while i + 1 < len(passages) and lines and (not lines[-1].strip() or _INTRODUCED.match(lines[-1])):
            lines.pop()
        kept.append("\n".join(lines))
    return "\n".join(x for x in kept if x)


def hashes(text: str) -> dict[int, int]:
    """Hash -> characters of the normalised text and its lines."""
    out = {}
    for part in (text, *text.split("\n")):
        plain = _SPACE.sub(" ", part).strip().lower()
        if plain:
            h = xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass"))
            out.setdefault(h - (h >> 63 << 64), len(plain))
    return out


def parsed(df: DataFrame) -> DataFrame:
    """(conv, turn, own, owned, quoted) of (conv, turn, text); owned is hash -> characters, quoted has the least level of each hash too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                own, owned, quoted = [], [], []
                for t in texts[a:b]:
                    passages = levels(t or "")
                    own.append(own_text(passages))
                    owned.append(list(hashes(own[-1]).items()))
                    found: dict[int, dict] = {}
                    for level, passage in sorted((x for x in passages if x[0]), key=lambda x: x[0]):
                        for h, weight in hashes(passage).items():
                            found.setdefault(h, {"hash": h, "weight": weight, "level": level})
                    quoted.append(list(found.values()))
                kind = pa.map_(pa.int64(), pa.int64())
                quote = pa.list_(pa.struct([("hash", pa.int64()), ("weight", pa.int64()), ("level", pa.int32())]))
                columns = [batch.column("conv").slice(a, b - a), batch.column("turn").slice(a, b - a), pa.array(own), pa.array(owned, kind), pa.array(quoted, quote)]
                yield pa.RecordBatch.from_arrays(columns, ["conv", "turn", "own", "owned", "quoted"])

    made = T.StructType.fromDDL("own string, owned map<bigint,bigint>, quoted array<struct<hash:bigint,weight:bigint,level:int>>")
    return df.mapInArrow(run, T.StructType([df.schema["conv"], df.schema["turn"], *made.fields]))


def parents(messages: DataFrame) -> DataFrame:
    """(conv, turn, to_conv, to_turn) of parsed messages that quote one."""
    quotes = messages.select("conv", "turn", F.inline("quoted"), F.lit(False).alias("original"))
    owns = messages.select("conv", "turn", F.explode("owned").alias("hash", "weight"), F.lit(0).alias("level"), F.lit(True).alias("original"))
    before = W.partitionBy("conv", "hash").orderBy("turn", "original").rangeBetween(W.unboundedPreceding, W.currentRow)
    near = quotes.union(owns).withColumn("to_turn", F.max(F.when(F.col("original"), F.col("turn"))).over(before)).filter("not original")
    here = near.filter("to_turn < turn").select("conv", "turn", "level", "weight", F.col("conv").alias("to_conv"), "to_turn")
    lost = near.filter("to_turn is null or to_turn >= turn").select("conv", "turn", "hash", "level", "weight")
    first = owns.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("to"))
    there = lost.join(first, "hash").filter(F.col("to") < F.struct("conv", "turn")).select("conv", "turn", "level", "weight", "to.conv", "to.turn").toDF("conv", "turn", "level", "weight", "to_conv", "to_turn")
    sums = here.union(there).groupBy("conv", "turn", "level", "to_conv", "to_turn").agg(F.sum("weight").alias("weight"))
    best = sums.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "weight", "to_conv", "to_turn")).alias("best"))
    return best.select("conv", "turn", "best.to_conv", "best.to_turn")


def conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, own, to_conv, to_turn, root_conv, root_turn, depth) of every row."""
    messages = stored(parsed(df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"))), "messages")
    links = stored(parents(messages), "parents")
    # up: the message so many steps above; those that have not reached a root go twice as far
    # in each round, the others stay as they are
    up = going = stored(links.select("conv", "turn", F.col("to_conv").alias("uc"), F.col("to_turn").alias("ut"), F.lit(1).cast("long").alias("steps")), "steps")
    ended = None
    while True:
        on = up.select(F.col("conv").alias("uc"), F.col("turn").alias("ut"), F.col("uc").alias("nc"), F.col("ut").alias("nt"), F.col("steps").alias("more"))
        met = going.join(on, ["uc", "ut"], "left")
        step = met.select("conv", "turn", F.coalesce("nc", "uc").alias("uc"), F.coalesce("nt", "ut").alias("ut"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("nc").isNotNull().alias("moved"))
        step = stored(step, "steps")
        still = step.filter("not moved").drop("moved")
        ended = still if ended is None else ended.union(still)
        going = step.filter("moved").drop("moved")
        up = ended.union(going)
        if going.isEmpty():
            break
    placed = links.join(up, ["conv", "turn"])
    return messages.select("conv", "turn", "own").join(placed, ["conv", "turn"], "left").select(
        "conv", "turn", "own", "to_conv", "to_turn", F.coalesce("uc", "conv").alias("root_conv"), F.coalesce("ut", "turn").alias("root_turn"), F.coalesce("steps", F.lit(0)).alias("depth")
    )


def quoting(df: DataFrame, depth: int = 2, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """(conv, turn, text): each message above which the depth messages before it are quoted, the older the deeper."""
    order = W.partitionBy(conv).orderBy(turn, text)
    body = F.coalesce(F.col(text), F.lit(""))
    quoted = [F.regexp_replace(F.lag(body, k).over(order), "(?m)^", "> " * k) for k in range(depth, 0, -1)]
    return df.select(F.col(conv), F.col(turn), F.concat_ws("\n", *quoted, body).alias(text))
