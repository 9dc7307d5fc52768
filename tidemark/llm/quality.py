"""Quality rules whose limits come from mergeable quantile sketches of each language and source.

Everything is DataFrame work. A document is measured in its own row. A sketch is a set of counts by
bucket: a value keeps its leading bits, which bounds the relative error by 1/32, and sketches merge
by adding counts, so map-side partial sums do most of the work and a hot source is no task of its
own. From the sketch of a (language, source) come median and quartiles, from these the limits

    median - REACH * max(upper quartile - median, grain)
    median + REACH * max(median - lower quartile, grain)

Each side uses the half of the distribution that lies on the other side, so that junk, which
stretches one tail, doesn't widen the limit that should catch it. The sketch of every language is merged
with that of all, scaled to `prior_docs` documents, and the sketch of every source with the merged one of
its language, scaled alike: the smaller a source, the nearer its limits are to its language's.
The limits are joined to the measures, and a document outside any of them is rejected.

Null text has no words and fails the base rule. Null language or source is a group like any other.
Repeated rows count and are judged each. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.session import pin

LEAST_WORDS = 10
MOST_REPEATED = 20
#: Documents that the sketch of the whole counts for beside that of its part.
PRIOR_DOCS = 20
REACH = 8
#: Measure: the smallest spread that counts (thousandths; hundredths of a character for word_length).
GRAIN = {"symbols": 5, "word_length": 10, "dup_lines": 40, "repeats": 25, "capitals": 15}
BITS = 6
WINDOW = 5


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals.

    Array work goes through one column after another, so that each array is made once.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    left = docs.columns
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        *left,
        F.filter(F.split(body, common.SPACE_CLASS + "+"), lambda w: w != "").alias("_words"),
        lines.alias("_lines"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.regexp_replace(body, r"[A-Z]+", ""))).cast("long").alias("n_capitals"),
    )
    step = step.select(
        *left,
        "n_symbols",
        "n_capitals",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    kept = [*left, "n_symbols", "n_capitals", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    hashes = F.col("_hashes")
    step = step.select(
        *kept,
        F.transform(
            F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WINDOW))),
        ).alias("_windows"),
    )
    windows = F.col("_windows")
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    step = step.select(
        *kept,
        F.when(
            some, F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        ).alias("_sorted"),
    )
    ordered = F.col("_sorted")
    again = F.transform(
        ordered,
        lambda x, k: F.when(
            (F.get(ordered, k - 1)["h"] == x["h"]) | (F.get(ordered, k + 1)["h"] == x["h"]), x["i"]
        ),
    )
    step = step.select(*kept, F.sort_array(F.filter(again, lambda i: i.isNotNull())).alias("_starts"))
    starts = F.col("_starts")
    gaps = F.zip_with(
        F.slice(starts, 2, F.size(starts)),
        F.slice(starts, 1, F.size(starts) - 1),
        lambda b, a: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(gaps, F.lit(WINDOW).cast("long"), lambda a, g: a + g)
    return step.select(*kept, F.when(starts.isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)


def measures() -> dict[str, Column]:
    """Whole numbers to be limited, from the counts of a document with words."""

    def share(part: str, whole: str, scale: int = 1000) -> Column:
        return F.expr(f"{scale} * {part} div greatest({whole}, 1)")

    return {
        "symbols": share("n_symbols", "word_chars"),
        "word_length": share("word_chars", "n_words", 100),
        "dup_lines": share("greatest(n_dup_lines - 1, 0)", "n_lines"),  # one is common in short texts
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
    }


def bucket(value: str) -> Column:
    """The value with its leading bits only."""
    shift = f"greatest(length(bin({value})) - {BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: sketches that merge by adding n."""
    pairs = F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("value")) for k, v in measures().items()))
    return (
        counts.filter("n_words > 0")
        .select("lang", "source", F.explode(pairs).alias("m"))
        .select("lang", "source", "m.measure", bucket("m.value").alias("bucket"))
        .groupBy("lang", "source", "measure", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """A row for each merged sketch: its buckets with their counts, of which there are few, and all documents."""
    counts = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    pair = F.struct("bucket", F.col("n").cast("double").alias("n"))
    return counts.groupBy(*by, "measure").agg(F.collect_list(pair).alias("sketch"), F.sum("n").alias("docs"))


def scaled(sketch: Column, docs: Column, to: float) -> Column:
    return F.transform(sketch, lambda x: F.struct(x["bucket"].alias("bucket"), (x["n"] * to / docs).alias("n")))


def quartiles(sketch: Column, docs: Column) -> Column:
    """The quartiles q1 to q3: the first bucket that reaches the share."""
    names = [f"q{k}" for k in (1, 2, 3)]

    def step(a: Column, x: Column) -> Column:
        at = a["at"] + x["n"]
        reached = (F.coalesce(a[q], F.when(4 * at >= k * docs, x["bucket"])).alias(q) for k, q in enumerate(names, 1))
        return F.struct(at.alias("at"), *reached)

    none = F.lit(None).cast("long")
    return F.aggregate(F.array_sort(sketch), F.struct(F.lit(0.0).alias("at"), *(none.alias(q) for q in names)), step)


def limits(sketch: DataFrame, prior_docs: float = PRIOR_DOCS) -> DataFrame:
    """One row for each language and source: the lower and upper limit of each measure."""
    parts = [merged(sketch, "lang", "source"), merged(sketch, "lang"), merged(sketch)]
    a, b, c = (p.select(*[F.col(x).alias(f"{x}{i}") for x in p.columns]) for i, p in enumerate(parts))
    prior = scaled(F.col("sketch2"), F.col("docs2"), prior_docs)
    languages = b.join(c, b["measure1"] == c["measure2"]).select(
        "lang1",
        "measure1",
        scaled(F.concat("sketch1", prior), F.col("docs1") + prior_docs, prior_docs).alias("prior1"),
    )
    same = F.col("lang0").eqNullSafe(F.col("lang1")) & (F.col("measure0") == F.col("measure1"))
    chosen = a.join(languages, same).withColumn(
        "_q", quartiles(F.concat("sketch0", "prior1"), F.col("docs0") + prior_docs)
    )

    def q(k: int) -> Column:
        return F.col("_q")[f"q{k}"]

    grain = reduce(lambda w, kv: w.when(F.col("measure0") == kv[0], F.lit(kv[1])), GRAIN.items(), F.when(F.lit(False), 0))
    fences = chosen.select(
        F.col("lang0").alias("lang"),
        F.col("source0").alias("source"),
        F.col("measure0").alias("measure"),
        (q(2) - REACH * F.greatest(q(3) - q(2), grain)).alias("low"),
        (q(2) + REACH * F.greatest(q(2) - q(1), grain)).alias("high"),
    )
    return fences.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in GRAIN for side in ("low", "high"))
    )


def judged(counts: DataFrame, limit: DataFrame) -> DataFrame:
    """`counts` joined with the limits of its language and source, with base_failed and kept."""
    right = common.size_checked(limit.withColumnsRenamed({"lang": "_lang", "source": "_source"}), "_lang", "_source")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    inside = reduce(
        lambda a, b: a & b,
        (v.between(F.col(f"{k}_low"), F.col(f"{k}_high")) for k, v in measures().items()),
    )
    joined = counts.join(right, same, "left").withColumn("base_failed", base_failed())
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))


def judge(docs: DataFrame, prior_docs: float = PRIOR_DOCS) -> DataFrame:
    """One row per document: its counts, base_failed and kept. The texts are read once."""
    rows = docs.select("doc_id", "text", "lang", "source")
    counts = pin(counted(rows).drop("text"))
    return judged(counts, limits(sketches(counts), prior_docs))


def keep_good(docs: DataFrame, prior_docs: float = PRIOR_DOCS) -> DataFrame:
    """The documents that pass, with all their columns.

    Rows are written once with their counts beside them, so that a filter on the counts isn't pushed
    into their making; the sketches read the counts only.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    counts = common.written(counted(docs.select(row, "text", "lang", "source")).drop("text"))
    return judged(counts, limits(sketches(counts), prior_docs)).filter("kept").select("_row.*")
