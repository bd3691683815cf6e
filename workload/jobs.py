"""Projections, filters and the two report families."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.scalars import (
    ALT_BAND_CUTS,
    days_or_default,
    first_nonblank,
    norm_key,
    num,
    price_band,
    whole,
)
from lotwise.functions.words import BLANK_RUN, PUNCTUATION, STOP_WORDS, tokens
from lotwise.operators import bands, models
from lotwise.plans.reports import market_profile, market_report, price_report
from workload.views import D_SQL, L_SQL, X_SQL, dirty_listings, listings, text_listings

GROUP = ["city", "year", "band"]
MARKET = ["city", "price", "year", "daysonmarket"]


def joined(name: str, sep: str = "|"):
    return F.array_join(F.col(name).cast("array<string>"), sep).alias(name)


def valid_l(spark, sf, *extra):
    columns = ("make_name", "model_name", "price", "year", *extra)
    return models.valid_listings(listings(spark, sf, *columns))


def market_l(spark, sf, *extra):
    return bands.valid_market(listings(spark, sf, *MARKET, *extra))


def banded_l(spark, sf, **options):
    return market_l(spark, sf).withColumn("band", price_band(F.col("price"), **options))


def text_d(spark, sf):
    """Valid rows with their text and band, dealt out by id: a file of long texts may be one split."""
    rows = bands.valid_market(
        text_listings(spark, sf).withColumn(
            "text", first_nonblank(F.col("description_cleaned"), F.col("description"))
        )
    )
    dealt = rows.select("doc_id", *MARKET, "text").repartition("doc_id")
    return dealt.withColumn("band", price_band(F.col("price")))


def normalize_key(spark, sf):
    return dirty_listings(spark, sf, "vin", "make_name").select(
        "vin", norm_key(F.col("make_name")).alias("make_key")
    )


def to_double(spark, sf):
    return dirty_listings(spark, sf, "vin", "price").select("vin", num(F.col("price")).alias("price"))


def to_int_via_double(spark, sf):
    return dirty_listings(spark, sf, "vin", "year").select("vin", whole(F.col("year")).alias("year"))


def valid_listing(spark, sf):
    return valid_l(spark, sf, "l_orderkey", "l_linenumber")


def valid_market_row(spark, sf):
    return market_l(spark, sf, "l_orderkey", "l_linenumber")


def default_missing_days(spark, sf):
    # Days come as text here: blank for vins divisible by 6, null or unparseable elsewhere.
    return dirty_listings(spark, sf, "vin", "exterior_color", "owner_count").select(
        "vin",
        days_or_default(
            F.coalesce(F.col("owner_count").cast("string"), F.col("exterior_color")), 0
        ).alias("days"),
    )


def text_fallback(spark, sf):
    return text_listings(spark, sf).select(
        "doc_id", first_nonblank(F.col("description_cleaned"), F.col("description")).alias("text")
    )


def band_of(spark, sf, **options):
    df = listings(spark, sf, "l_orderkey", "l_linenumber", "price")
    return df.select("*", price_band(F.col("price"), **options).alias("band"))


def model_stats(spark, sf):
    return models.group_profile(valid_l(spark, sf)).withColumn("years", joined("years"))


def _rolled(df):
    parts = F.transform(
        "models", lambda m: F.concat_ws(":", m["model_name"], m["n"].cast("string"))
    )
    return df.select("make_name", "n_models", F.array_join(parts, "|").alias("models"))


def make_rollup(spark, sf):
    return _rolled(models.make_rollup(models.group_profile(valid_l(spark, sf))))


def make_rollup_by_count(spark, sf):
    return _rolled(models.make_rollup(models.group_profile(valid_l(spark, sf)), by_count=True))


def model_cities(spark, sf):
    return models.capped_set(valid_l(spark, sf, "city")).withColumn("cities", joined("cities"))


def make_report(spark, sf):
    return price_report(listings(spark, sf, "make_name", "model_name", "price", "year"))


def make_report_cities(spark, sf):
    wanted = ("make_name", "model_name", "price", "year", "city")
    return price_report(listings(spark, sf, *wanted), cities=True)


def tokenize(spark, sf):
    return text_d(spark, sf).select("doc_id", F.array_join(tokens(F.col("text")), " ").alias("tokens"))


def tokenize_plain(spark, sf):
    words = tokens(F.col("text"), stop=[], min_len=1, punct=" ")
    return text_d(spark, sf).select("doc_id", F.array_join(words, " ").alias("tokens"))


def stopword_filter(spark, sf):
    listed = F.explode(F.array(*[F.lit(w) for w in STOP_WORDS]))
    stop = spark.range(1).select(listed.alias("word"))
    words = bands.drop_stopwords(bands.word_stream(text_d(spark, sf), ["city"], "text", stop=[]), stop)
    return words.groupBy("city", "word").agg(F.count(F.lit(1)).alias("n"))


def word_counts(spark, sf):
    return bands.word_counts(text_d(spark, sf), GROUP, "text")


def top_words(spark, sf):
    found = bands.top_words(bands.word_counts(text_d(spark, sf), GROUP, "text"), GROUP)
    return found.withColumn("top_words", joined("top_words"))


def band_stats(spark, sf):
    return bands.band_stats(banded_l(spark, sf))


def band_profile(spark, sf):
    return bands.band_profile(text_d(spark, sf)).withColumn("top_words", joined("top_words"))


def band_grid(spark, sf):
    return bands.band_grid(banded_l(spark, sf))


def band_pivot(spark, sf):
    return bands.band_pivot(banded_l(spark, sf))


def market_grid(spark, sf):
    df = market_profile(text_d(spark, sf)).select("city", "year", F.inline("bands"))
    return df.withColumn("top_words", joined("top_words"))


def city_year_report(spark, sf):
    return market_report(text_d(spark, sf))


QUERIES = {
    "normalize_key": normalize_key,
    "to_double": to_double,
    "to_int_via_double": to_int_via_double,
    "valid_listing": valid_listing,
    "valid_market_row": valid_market_row,
    "default_missing_days": default_missing_days,
    "text_fallback": text_fallback,
    "price_band": band_of,
    "price_band_alt": lambda spark, sf: band_of(spark, sf, cuts=ALT_BAND_CUTS, closed="left"),
    "model_stats": model_stats,
    "make_rollup": make_rollup,
    "make_rollup_by_count": make_rollup_by_count,
    "model_cities": model_cities,
    "make_report": make_report,
    "make_report_cities": make_report_cities,
    "tokenize": tokenize,
    "tokenize_plain": tokenize_plain,
    "stopword_filter": stopword_filter,
    "word_counts": word_counts,
    "top_words": top_words,
    "band_stats": band_stats,
    "band_profile": band_profile,
    "band_grid": band_grid,
    "band_pivot": band_pivot,
    "market_grid": market_grid,
    "city_year_report": city_year_report,
}


# --- the same in SQL ------------------------------------------------------------------------

LISTING_OK = "price > 0 AND NOT isnan(price) AND year BETWEEN 1900 AND 2025 AND make_name <> '' AND model_name <> ''"
MARKET_OK = "city <> '' AND price > 0 AND NOT isnan(price) AND daysonmarket >= 0 AND year BETWEEN 1900 AND 2025"
BAND = "CASE WHEN price < 20000 THEN 'basso' WHEN price <= 50000 THEN 'medio' ELSE 'alto' END"
ALT_BAND = "CASE WHEN price < 15000 THEN 'basso' WHEN price < 35000 THEN 'medio' ELSE 'alto' END"
AVG_PRICE = "avg(price)"

STATS = f"""{L_SQL}, V AS (SELECT * FROM L WHERE {LISTING_OK}),
S AS (SELECT make_name, model_name, count(*) AS n, min(price) AS min_price, max(price) AS max_price,
        {AVG_PRICE} AS avg_price FROM V GROUP BY 1, 2),
Y AS (SELECT make_name, model_name, string_agg(CAST(year AS VARCHAR), '|' ORDER BY year) AS years
      FROM (SELECT DISTINCT make_name, model_name, year FROM V) GROUP BY 1, 2),
C AS (SELECT make_name, model_name, string_agg(city, '|' ORDER BY city) AS cities
      FROM (SELECT *, row_number() OVER (PARTITION BY make_name, model_name ORDER BY city) AS i
            FROM (SELECT DISTINCT make_name, model_name, city FROM V WHERE city <> ''))
      WHERE i <= 5 GROUP BY 1, 2)"""

MODEL_TEXT = """concat('Model: ', model_name, ', Count: ', n, printf(', MinPrice: %.2f', min_price),
  printf(', MaxPrice: %.2f', max_price), printf(', AvgPrice: %.2f', avg_price),
  ', Years: [', replace(years, '|', ', '), ']'"""

MARKET_L = f"{L_SQL}, B AS (SELECT *, {BAND} AS band FROM L WHERE {MARKET_OK})"

TEXT_D = f"""{D_SQL}, T AS (
  SELECT *, CASE WHEN trim(description_cleaned) <> '' THEN description_cleaned ELSE description END AS text,
         {BAND} AS band FROM D WHERE {MARKET_OK})"""

STOP_VALUES = ", ".join("('" + w.replace("'", "''") + "')" for w in STOP_WORDS)

WORDS_D = f"""{TEXT_D}, STOP(word) AS (VALUES {STOP_VALUES}),
W AS (SELECT doc_id, city, year, band, pos, word FROM (
        SELECT doc_id, city, year, band, unnest(a) AS word, generate_subscripts(a, 1) AS pos FROM (
          SELECT *, string_split_regex(regexp_replace(lower(text), '{PUNCTUATION}', '', 'g'), '{BLANK_RUN}') AS a
          FROM T)) WHERE length(word) >= 3),
K AS (SELECT * FROM W WHERE word NOT IN (SELECT word FROM STOP)),
N AS (SELECT city, year, band, word, count(*) AS n FROM K GROUP BY ALL),
TOP AS (SELECT city, year, band, string_agg(word, '|' ORDER BY i) AS top_words FROM (
          SELECT *, row_number() OVER (PARTITION BY city, year, band ORDER BY n DESC, word) AS i FROM N)
        WHERE i <= 3 GROUP BY ALL),
P AS (SELECT city, year, band, count(*) AS n, avg(daysonmarket) AS avg_days FROM T GROUP BY ALL),
PROFILE AS (SELECT city, year, band, n, avg_days, coalesce(top_words, '') AS top_words
            FROM P LEFT JOIN TOP USING (city, year, band)),
GRID AS (SELECT city, year, i, band, coalesce(n, 0) AS n, coalesce(avg_days, 0) AS avg_days,
                coalesce(top_words, '') AS top_words
         FROM (SELECT DISTINCT city, year FROM T)
         CROSS JOIN (VALUES (0, 'basso'), (1, 'medio'), (2, 'alto')) b(i, band)
         LEFT JOIN PROFILE USING (city, year, band))"""

BAND_COLUMNS = ", ".join(
    f"count(*) FILTER (band = '{b}') AS {b}_n, "
    f"coalesce(avg(daysonmarket) FILTER (band = '{b}'), 0) AS {b}_avg_days"
    for b in ("basso", "medio", "alto")
)

ORACLES = {
    "normalize_key": f"WITH {X_SQL} SELECT vin, nullif(lower(trim(make_name)), '') AS make_key FROM X",
    "to_double": f"WITH {X_SQL} SELECT vin, TRY_CAST(price AS DOUBLE) AS price FROM X",
    "to_int_via_double": f"WITH {X_SQL} SELECT vin, CAST(trunc(TRY_CAST(year AS DOUBLE)) AS INT) AS year FROM X",
    "valid_listing": f"""WITH {L_SQL} SELECT make_name, model_name, price, year, l_orderkey, l_linenumber
        FROM L WHERE {LISTING_OK}""",
    "valid_market_row": f"""WITH {L_SQL} SELECT city, price, year, daysonmarket, l_orderkey, l_linenumber
        FROM L WHERE {MARKET_OK}""",
    "default_missing_days": f"""WITH {X_SQL} SELECT vin,
        CASE WHEN trim(d) = '' OR d IS NULL THEN 0 ELSE TRY_CAST(d AS INT) END AS days
        FROM (SELECT vin, coalesce(CAST(owner_count AS VARCHAR), exterior_color) AS d FROM X)""",
    "text_fallback": f"""WITH {D_SQL} SELECT doc_id, CASE WHEN trim(description_cleaned) <> ''
        THEN description_cleaned ELSE description END AS text FROM D""",
    "price_band": f"WITH {L_SQL} SELECT l_orderkey, l_linenumber, price, {BAND} AS band FROM L",
    "price_band_alt": f"WITH {L_SQL} SELECT l_orderkey, l_linenumber, price, {ALT_BAND} AS band FROM L",
    "model_stats": f"WITH {STATS} SELECT * FROM S JOIN Y USING (make_name, model_name)",
    "make_rollup": f"""WITH {STATS} SELECT make_name, count(*) AS n_models,
        string_agg(concat(model_name, ':', n), '|' ORDER BY model_name) AS models FROM S GROUP BY 1""",
    "make_rollup_by_count": f"""WITH {STATS} SELECT make_name, count(*) AS n_models,
        string_agg(concat(model_name, ':', n), '|' ORDER BY n DESC, model_name) AS models FROM S GROUP BY 1""",
    "model_cities": f"WITH {STATS} SELECT * FROM C",
    "make_report": f"""WITH {STATS} SELECT make_name, concat('Make: ', make_name, chr(9), 'Models: [',
        string_agg({MODEL_TEXT}), '; ' ORDER BY model_name), ']') AS line
        FROM S JOIN Y USING (make_name, model_name) GROUP BY 1""",
    "make_report_cities": f"""WITH {STATS} SELECT make_name, concat('Make: ', make_name, chr(9), 'Models: [',
        string_agg({MODEL_TEXT}, ', TopCities: [', '''' || replace(cities, '|', ''', ''') || '''', ']'), '; '
                   ORDER BY n DESC, model_name), ']') AS line
        FROM S JOIN Y USING (make_name, model_name) LEFT JOIN C USING (make_name, model_name) GROUP BY 1""",
    "tokenize": f"""WITH {WORDS_D} SELECT T.doc_id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS tokens
        FROM T LEFT JOIN K ON T.doc_id = K.doc_id GROUP BY 1""",
    "tokenize_plain": f"""WITH {TEXT_D}, W AS (
          SELECT doc_id, unnest(a) AS word, generate_subscripts(a, 1) AS pos FROM (
            SELECT doc_id, string_split_regex(regexp_replace(lower(text), '{PUNCTUATION}', ' ', 'g'),
                   '{BLANK_RUN}') AS a FROM T))
        SELECT T.doc_id, coalesce(string_agg(word, ' ' ORDER BY pos), '') AS tokens
        FROM T LEFT JOIN (SELECT * FROM W WHERE word <> '') W ON T.doc_id = W.doc_id GROUP BY 1""",
    "stopword_filter": f"WITH {WORDS_D} SELECT city, word, count(*) AS n FROM K GROUP BY ALL",
    "word_counts": f"WITH {WORDS_D} SELECT city, year, band, word, n FROM N",
    "top_words": f"WITH {WORDS_D} SELECT city, year, band, top_words FROM TOP",
    "band_stats": f"""WITH {MARKET_L} SELECT city, year, band, count(*) AS n, avg(daysonmarket) AS avg_days
        FROM B GROUP BY ALL""",
    "band_profile": f"WITH {WORDS_D} SELECT * FROM PROFILE",
    "band_grid": f"""WITH {MARKET_L}, S AS (SELECT city, year, band, count(*) AS n,
          avg(daysonmarket) AS avg_days FROM B GROUP BY ALL)
        SELECT city, year, band_no, band, coalesce(n, 0) AS n, coalesce(avg_days, 0) AS avg_days
        FROM (SELECT DISTINCT city, year FROM B)
        CROSS JOIN (VALUES (0, 'basso'), (1, 'medio'), (2, 'alto')) b(band_no, band)
        LEFT JOIN S USING (city, year, band)""",
    "band_pivot": f"WITH {MARKET_L} SELECT city, year, {BAND_COLUMNS} FROM B GROUP BY 1, 2",
    "market_grid": f"WITH {WORDS_D} SELECT city, year, band, n, avg_days, top_words FROM GRID",
    "city_year_report": f"""WITH {WORDS_D} SELECT city, year,
        concat('City: ', city, ', Year: ', year, chr(9), 'ReportFasce: [',
          string_agg(concat('FasciaPrezzo: ', band, ', NumAuto: ', n, printf(', AvgDaysOnMarket: %.2f', avg_days),
            ', TopWords: [', CASE WHEN top_words = '' THEN '' ELSE
              '''' || replace(top_words, '|', ''', ''') || '''' END, ']'), '; ' ORDER BY i), ']') AS line
        FROM GRID GROUP BY 1, 2""",
}
