"""Price-band summaries per city and year."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.scalars import BAND_LABELS, bracketed, two_decimals
from lotwise.functions.words import STOP_WORDS, keep_word, raw_words
from lotwise.operators.aggregates import nested_in_order
from lotwise.operators.models import YEARS

GROUP = ("city", "year", "band")


def market_rule(
    city: str = "city", price: str = "price", days: str = "daysonmarket", year: str = "year",
    years: tuple[int, int] = YEARS,
) -> Column:
    return (
        F.col(city).isNotNull()
        & (F.col(city) != "")
        & (F.col(price) > 0)
        & ~F.isnan(price)
        & (F.col(days) >= 0)
        & F.col(year).between(*years)
    )


def valid_market(df: DataFrame, **names) -> DataFrame:
    """Rows with a city, a positive price, days not negative and a year in range."""
    return df.where(market_rule(**names))


def band_stats(df: DataFrame, keys: Sequence[str] = GROUP, days: str = "daysonmarket") -> DataFrame:
    """Per (city, year, band): listings and mean days on market."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(days).alias("avg_days")
    )


def band_grid(
    df: DataFrame, labels: Sequence[str] = BAND_LABELS, days: str = "daysonmarket"
) -> DataFrame:
    """One row per (city, year) and band, absent bands as zeros; one shuffle, no join."""
    wide = df.groupBy("city", "year").agg(
        *[F.count_if(F.col("band") == b).alias(f"n_{b}") for b in labels],
        *[F.avg(F.when(F.col("band") == b, F.col(days))).alias(f"avg_{b}") for b in labels],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("band_no"),
                F.lit(b).alias("band"),
                F.col(f"n_{b}").alias("n"),
                F.coalesce(F.col(f"avg_{b}"), F.lit(0.0)).alias("avg_days"),
            )
            for i, b in enumerate(labels)
        ]
    )
    return wide.select("city", "year", F.inline(rows))


def band_pivot(
    df: DataFrame, labels: Sequence[str] = BAND_LABELS, days: str = "daysonmarket"
) -> DataFrame:
    """One row per (city, year), a pair of columns per band, absent bands as zeros."""
    return (
        df.groupBy("city", "year")
        .pivot("band", list(labels))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(days).alias("avg_days"))
        .fillna(0)
    )


def word_stream(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    stop: Iterable[str] = STOP_WORDS,
    min_len: int = 3,
    punct: str = "",
) -> DataFrame:
    """One row per kept word; whole texts never leave their task."""
    words = df.select(*keys, F.explode(raw_words(F.col(text), punct)).alias("word"))
    return words.where(keep_word(F.col("word"), stop, min_len))


def word_counts(df: DataFrame, keys: Sequence[str], text: str, **options) -> DataFrame:
    """Occurrences of each kept word per group."""
    words = word_stream(df, keys, text, **options)
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def drop_stopwords(words: DataFrame, stop: DataFrame, word: str = "word") -> DataFrame:
    """Remove the words listed in a table, best before they are counted.

    Spark broadcasts the list if its size is known to be small, as for a file or a range.
    """
    return words.join(stop.select(word).distinct(), word, "left_anti")


def top_words(counts: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """Per group: the ``k`` most frequent words, ties in alphabetical order.

    The rank filter also runs before the shuffle, so a task passes on at most ``k``
    words per group.
    """
    order = [F.desc("n"), F.asc("word")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    best = counts.withColumn("place", place).where(F.col("place") <= k)
    picked = nested_in_order(["word"], [F.col("place")])
    return best.groupBy(*keys).agg(picked.getField("word").alias("top_words"))


def band_profile(
    df: DataFrame,
    text: str = "text",
    k: int = 3,
    keys: Sequence[str] = GROUP,
    days: str = "daysonmarket",
    stop: Iterable[str] = STOP_WORDS,
    min_len: int = 3,
    punct: str = "",
) -> DataFrame:
    """Per (city, year, band): listings, mean days on market and top words.

    Reads the listings once: each contributes its words and one row without a word,
    which carries the days. Counting by (keys, word) then yields the word counts and
    the group statistics together, without a join, and a group of which no word is
    kept still has its row.
    """
    keys = list(keys)
    # Cast to an array of nullable strings: the null element stands for the listing.
    listing = F.array(F.lit(None).cast("string"))
    found = F.coalesce(raw_words(F.col(text), punct), F.array().cast("array<string>"))
    words = df.select(*keys, days, F.explode(F.concat(listing, found)).alias("word"))
    is_listing = F.col("word").isNull()
    counts = (
        words.where(is_listing | keep_word(F.col("word"), stop, min_len))
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(is_listing, F.col(days))).alias("days"))
    )
    order = [is_listing.desc(), F.desc("n"), F.asc("word")]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    best = counts.withColumn("place", place).where(F.col("place") <= k + 1)
    ranked = F.when(~is_listing, F.struct("place", "word"))
    return (
        best.groupBy(*keys)
        .agg(
            F.max(F.when(is_listing, F.col("n"))).alias("n"),
            F.max(F.when(is_listing, F.col("days"))).alias("days"),
            F.array_sort(F.collect_list(ranked)).getField("word").alias("top_words"),
        )
        .select(*keys, "n", (F.col("days") / F.col("n")).alias("avg_days"), "top_words")
    )


def complete_bands(profile: DataFrame, labels: Sequence[str] = BAND_LABELS) -> DataFrame:
    """Per (city, year): array of all bands in order, absent ones as 0, 0.0 and []."""
    entry = F.struct("n", "avg_days", "top_words")
    wide = profile.groupBy("city", "year").agg(
        *[F.max(F.when(F.col("band") == b, entry)).alias(f"band_{b}") for b in labels]
    )
    bands = F.array(
        *[
            F.struct(
                F.lit(b).alias("band"),
                F.coalesce(F.col(f"band_{b}.n"), F.lit(0)).alias("n"),
                F.coalesce(F.col(f"band_{b}.avg_days"), F.lit(0.0)).alias("avg_days"),
                F.coalesce(F.col(f"band_{b}.top_words"), F.array().cast("array<string>")).alias("top_words"),
            )
            for b in labels
        ]
    )
    return wide.select("city", "year", bands.alias("bands"))


def city_year_report(complete: DataFrame) -> DataFrame:
    """Rows (city, year, line); write them ordered by (city, year)."""

    def band_text(band: Column) -> Column:
        return F.concat(
            F.lit("FasciaPrezzo: "), band["band"],
            F.lit(", NumAuto: "), band["n"].cast("string"),
            F.lit(", AvgDaysOnMarket: "), two_decimals(band["avg_days"]),
            F.lit(", TopWords: "), bracketed(band["top_words"], quote=True),
        )

    line = F.concat(
        F.lit("City: "), F.col("city"), F.lit(", Year: "), F.col("year").cast("string"),
        F.lit("\tReportFasce: ["), F.array_join(F.transform("bands", band_text), "; "), F.lit("]"),
    )
    return complete.select("city", "year", line.alias("line"))
