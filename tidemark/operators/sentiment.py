"""Headline sentiment by keyword."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where
from tidemark.schema import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS


def _mentions(text: Column, keywords: Sequence[str], word_bounds: bool) -> Column:
    """Any keyword in the lower-cased text; a plain substring unless word bounds are asked for."""
    if word_bounds:
        return text.rlike(r"\b(" + "|".join(keywords) + r")\b")
    found = text.contains(keywords[0])
    for word in keywords[1:]:
        found = found | text.contains(word)
    return found


def headline_class(
    headlines: DataFrame, headline: str = "headline", word_bounds: bool = False
) -> DataFrame:
    """positive or negative when only one side's keywords occur, else neutral."""
    text = F.lower(headline)
    good = _mentions(text, POSITIVE_KEYWORDS, word_bounds)
    bad = _mentions(text, NEGATIVE_KEYWORDS, word_bounds)
    return headlines.withColumns({"_good": good, "_bad": bad}).withColumn(
        "sentiment",
        F.when(F.col("_good") & ~F.col("_bad"), "positive")
        .when(F.col("_bad") & ~F.col("_good"), "negative")
        .otherwise("neutral"),
    ).drop("_good", "_bad")


def sentiment(classified: DataFrame, key: str = "crypto_id") -> DataFrame:
    """Counts, score and label per asset; the label looks at the unrounded score."""
    kind = F.col("sentiment")
    counted = classified.groupBy(key).agg(
        count_where(kind == "positive").alias("positive_count"),
        count_where(kind == "negative").alias("negative_count"),
        count_where(kind == "neutral").alias("neutral_count"),
        F.count(F.lit(1)).alias("total_headlines"),
    )
    score = (
        (F.col("positive_count") - F.col("negative_count"))
        / F.greatest("total_headlines", F.lit(1))
        * 100
    )
    label = F.when(score > 20, "BULLISH").when(score < -20, "BEARISH").otherwise("NEUTRAL")
    return counted.withColumns(
        {"sentiment_score": F.round(score, 2), "sentiment_label": label}
    )


def sentiment_summary(scored: DataFrame) -> DataFrame:
    """Number of assets per label; all three labels appear."""
    labels = scored.sparkSession.createDataFrame(
        [("BULLISH",), ("BEARISH",), ("NEUTRAL",)], "sentiment_label string"
    )
    counts = scored.groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("_n"))
    return F.broadcast(labels).join(counts, "sentiment_label", "left").select(
        "sentiment_label", F.coalesce("_n", F.lit(0)).alias("assets")
    )
