"""Quality rules whose thresholds have a controlled risk.

Built-in functions only. Every text gets counts (words, symbols, repeated lines and
word windows ...). Two fixed limits make the base verdict. Beside it, each rule of
RULES rejects texts with a ratio above a cutoff, and how strict the rules are is learned.
The cutoffs of all rules, from the loosest on and in turn (the first of each rule, the
second of each ...), are steps of one path; a setting has all cutoffs up to some step, so
settings are nested. On the labelled rows, separately for each stratum, a setting is valid if
the exact binomial upper bound of its false rejections lies below RISK: of the rows
labelled good, the share that the base verdict keeps and any of the setting's rules
rejects. The settings are tested in the order of the path and the last before the first
failure is taken, which needs no correction; over strata the error probability ERROR is
shared (Bonferroni). So with probability 1 - ERROR no stratum loses more than RISK of its good
rows to all rules together, beside what the base verdict takes, which nothing here chooses. A
stratum without a valid setting, as in small tables, has the base verdict only.

Edge cases: null and blank texts have no words and fail the base verdict; the null
stratum is a stratum; unlabelled tables have the base verdict only; a row that is
labelled more than once counts once, as good if any label says so; rows with one id share its label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, n_words, stored

#: Least words, and the most per cent of words in repeated windows, of the base verdict.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3
#: False rejections allowed to all rules in a stratum, and the chance that any stratum has more.
RISK, ERROR = 0.01, 0.05
#: Ratios that rules look at, each with its cutoffs from the loosest on.
RULES = {
    "symbols_per_word": (3.0, 2.5, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2),
    "marks_per_word": (3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3),
    "capitals_per_char": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeated_lines": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeated_words": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
}


def counted(df: DataFrame, text: str = "text") -> DataFrame:
    """df without the text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_marks, n_capitals.

    n_repeat_words: each word window is a 64-bit hash with its place. Sorted, equal windows are
    neighbours, and their places, sorted, cover WINDOW words each. Most texts repeat no
    window, which a hash set tells without sorting.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern)).cast("long")
    none = F.array().cast("array<bigint>")
    df = df.withColumns(
        {
            "n_words": n_words(t),
            "word_chars": F.length(F.translate(t, " \t\n\x0b\f\r", "")).cast("long"),
            "n_symbols": count(r"[#*$%&|<>]"),
            "n_marks": count(r"[!?]"),
            "n_capitals": count(r"\p{Lu}"),
            "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)),
            "_words": F.regexp_extract_all(t, F.lit(WORD), 0),
        }
    ).drop(text)
    size = F.size("_words") - (WINDOW - 1)
    window = lambda w, i: F.xxhash64(w, *[F.element_at("_words", i + 1 + k) for k in range(1, WINDOW)])
    df = df.withColumns(
        {
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_keys": F.when(size > 0, F.transform(F.slice("_words", F.lit(1), size), window)).otherwise(none),
        }
    ).drop("_lines", "_words")
    placed = F.sort_array(F.transform("_keys", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_keys")) < F.size("_keys"), placed).otherwise(F.array().cast("array<struct<h:bigint,at:int>>")))
    key = lambda i: F.try_element_at(F.col("_sorted"), i).getField("h")
    # element_at counts from 1: i is the neighbour before, i + 2 the one after
    same = lambda x, y: F.coalesce(x == y, F.lit(False))
    again = F.filter("_sorted", lambda x, i: same(x.h, key(F.when(i > 0, i))) | same(x.h, key(i + 2)))
    df = df.withColumn("_again", F.sort_array(F.transform(again, lambda x: x.at.cast("long"))))
    cover = F.aggregate(
        "_again",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total")),
        lambda held, p: F.struct((p + WINDOW).alias("end"), (held.total + p + WINDOW - F.greatest(held.end, p)).alias("total")),
        lambda held: held.total,
    )
    return df.withColumn("n_repeat_words", cover).drop("_keys", "_sorted", "_again")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def ratios() -> dict[str, Column]:
    """What each rule looks at; 0 for texts without words."""
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {
        "symbols_per_word": part("n_symbols", "n_words"),
        "marks_per_word": part("n_marks", "n_words"),
        "capitals_per_char": part("n_capitals", "word_chars"),
        "repeated_lines": part("n_dup_lines", "n_lines"),
        "repeated_words": part("n_repeat_words", "n_words"),
    }


def log_binomial_cdf(n: Column, k: Column, p: float) -> Column:
    """ln P(X <= k) for X ~ Binomial(n, p), by the ratio of neighbouring terms."""
    first = n * F.log1p(F.lit(-p))

    def step(held: Column, i: Column) -> Column:
        term = held.term + F.log((n - i + 1) / i) + F.log(F.lit(p / (1 - p)))
        top = F.greatest(held.total, term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(held.total - top) + F.exp(term - top))).alias("total"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, F.struct(first.alias("term"), first.alias("total")), step, lambda held: held.total)


#: Steps of the path: as many for each rule as the longest list of cutoffs has.
STEPS = len(RULES) * max(map(len, RULES.values()))


def first_step() -> Column:
    """The first step of the path at which a rule rejects the row; null if none does."""
    found = []
    for r, (rule, cuts) in enumerate(RULES.items()):
        passed = sum(((F.col(rule) <= c).cast("int") for c in cuts), F.lit(0))
        found.append(F.when(passed < len(cuts), passed * len(RULES) + r))
    return F.least(*found)


def settings(good: DataFrame) -> DataFrame:
    """(stratum, step): the last step of the strictest valid setting, for strata that have one.

    good has stratum and step, the first step that rejects the row (null: none), for rows labelled good.
    """
    strata = good.select("stratum").distinct().agg(F.count("*").alias("strata"))
    rows = good.groupBy("stratum", F.coalesce("step", F.lit(STEPS)).alias("step")).agg(F.count("*").alias("rows"))
    every = W.partitionBy("stratum")
    upto = every.orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.withColumns({"n": F.sum("rows").over(every), "k": F.sum("rows").over(upto)}).crossJoin(F.broadcast(strata))  # one row
    # more losses than the risk's share have a chance of at least a half (a binomial's median is no further than the next
    # whole number from its mean), so no sum of terms is longer than that share
    summed = lambda k: log_binomial_cdf(F.col("n"), k, RISK) <= F.log(F.lit(ERROR) / F.col("strata"))
    valid = lambda k: F.when(k > F.col("n") * RISK, False).otherwise(summed(F.least(k, F.ceil(F.col("n") * RISK))))
    # between the steps that reject a row first, settings reject the same rows
    failed = F.min(F.when((F.col("step") < STEPS) & ~valid(F.col("k")), F.col("step")))
    found = sums.groupBy("stratum").agg(failed.alias("failed"), F.max(valid(F.lit(0).cast("long"))).alias("any"))
    return found.filter("any").select("stratum", (F.coalesce("failed", F.lit(STEPS)) - 1).alias("step")).filter("step >= 0")


def judged(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", stratum: str = "lang", good: str = "quality") -> DataFrame:
    """(id, counts, base_failed, kept) of every row; labels has id and good (1: must be kept)."""
    marked = df.select(F.col(id).alias("id"), F.col(stratum).alias("stratum"), F.col(text).alias("text"))
    known = stored(counted(marked), "counts").withColumn("base_failed", base_failed()).withColumns(ratios())
    known = known.withColumn("step", first_step())
    wanted = labels.filter(F.col(good) == 1).select(F.col(id).alias("id")).distinct()
    labelled = known.join(wanted, "id", "left_semi").select("stratum", F.when(~F.col("base_failed"), F.col("step")).alias("step"))
    last = stored(settings(labelled), "settings")
    k, s = known.alias("k"), last.alias("s")
    met = k.join(s, F.col("k.stratum").eqNullSafe(F.col("s.stratum")), "left")
    rejected = F.col("k.base_failed") | F.coalesce(F.col("k.step") <= F.col("s.step"), F.lit(False))
    return met.select("k.*", (~rejected).alias("kept")).drop("step").withColumnRenamed("id", id)
