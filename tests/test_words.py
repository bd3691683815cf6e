"""Token and word counts against plain Python over whole texts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from lotwise.functions.words import STOP_WORDS, tokens
from lotwise.operators import bands
from workload.jobs import GROUP, text_d


def by_hand(text):
    kept = re.sub(r"[^\w\s]", "", text.lower()).split()
    return [w for w in kept if len(w) > 2 and w not in set(STOP_WORDS)]


def test_tokens_equal_python(spark, sf_dir):
    rows = text_d(spark, sf_dir).select("text", tokens(F.col("text")).alias("t")).collect()
    assert rows
    for row in rows:
        assert row.t == by_hand(row.text)


def test_profile_equals_python(spark, sf_dir):
    df = text_d(spark, sf_dir)
    words, days = defaultdict(Counter), defaultdict(list)
    for row in df.select(*GROUP, "daysonmarket", "text").collect():
        key = (row.city, row.year, row.band)
        words[key].update(by_hand(row.text))
        days[key].append(row.daysonmarket)
    got = bands.band_profile(df).collect()
    assert len(got) == len(days)
    for row in got:
        key = (row.city, row.year, row.band)
        best = sorted(words[key].items(), key=lambda item: (-item[1], item[0]))[:3]
        assert row.n == len(days[key])
        assert row.avg_days == sum(days[key]) / len(days[key])
        assert row.top_words == [word for word, _ in best]


def test_group_without_words_keeps_its_row(spark):
    df = spark.createDataFrame(
        [("rome", 2020, "basso", 4, "the and of"), ("rome", 2020, "alto", 6, None)],
        "city string, year int, band string, daysonmarket int, text string",
    )
    rows = {r.band: r for r in bands.band_profile(df).collect()}
    assert rows["basso"].n == 1 and rows["basso"].top_words == []
    assert rows["alto"].avg_days == 6.0 and rows["alto"].top_words == []


def test_hot_group_and_hot_word(spark):
    """A third of all rows in one group, one word in every row."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 500).cast("string")).alias("city"),
        F.lit(2020).alias("year"),
        F.lit("basso").alias("band"),
        (F.col("id") % 7).cast("int").alias("daysonmarket"),
        F.concat(F.lit("common word"), (F.col("id") % 11).cast("string")).alias("text"),
    )
    hot = bands.band_profile(df).where("city = 'hot'").first()
    assert hot.n == 10_000
    assert hot.top_words == ["common", "word0", "word1"]


def test_stop_table_equals_stop_list(spark, sf_dir):
    df = text_d(spark, sf_dir)
    stop = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    table = bands.drop_stopwords(bands.word_counts(df, GROUP, "text", stop=[]), stop)
    listed = bands.word_counts(df, GROUP, "text")
    columns = [*GROUP, "word", "n"]
    assert table.select(columns).exceptAll(listed.select(columns)).isEmpty()
    assert listed.select(columns).exceptAll(table.select(columns)).isEmpty()
    assert listed.where(F.col("word").isin(STOP_WORDS)).isEmpty()
