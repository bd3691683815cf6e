"""Cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import scalars as S
from lotwise.operators import cleaning as C
from lotwise.plans import clean
from workload.folders import work_folder
from workload.views import X_SQL, dirty_listings, table


def x_column(name, make, *columns):
    """Query: vin and one column made of ``columns``."""

    def query(spark, sf):
        return dirty_listings(spark, sf, "vin", *columns).select("vin", make().alias(name))

    return query


def listed_dates(spark, sf):
    df = dirty_listings(spark, sf, "vin", "listed_date")
    return df.withColumn("listed_date", S.to_date_lenient(F.col("listed_date")))


def drop_sparse_columns(spark, sf):
    wanted = ("vin", "owner_count", "horsepower", "listing_color", "engine_cylinders")
    return C.drop_sparse(dirty_listings(spark, sf, *wanted))


def extraction_pairs(spark, sf):
    df = dirty_listings(spark, sf, "engine_cylinders")
    number = S.first_number(F.col("engine_cylinders"), "int")
    return C.extraction_pairs(df, "engine_cylinders", number, n=5)


def option_counts(spark, sf):
    df = dirty_listings(spark, sf, "major_options")
    return C.explode_counts(df, S.parse_list(F.col("major_options")))


def match_rate(spark, sf):
    df = dirty_listings(spark, sf, "power", "horsepower")
    found = C.match_rate(df, S.first_number(F.col("power")), F.col("horsepower").cast("double"))
    return found.select(F.round("match_pct", 4).alias("match_pct"))


def date_parts(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return C.date_parts(orders, "o_orderdate", "order").drop("o_orderdate")


def missing_flags(spark, sf):
    df = dirty_listings(spark, sf, "vin", "power", "owner_count")
    return C.flag_missing(df, ["power", "owner_count"]).drop("power", "owner_count")


def impute_median(spark, sf):
    df = dirty_listings(spark, sf, "vin", "horsepower", "owner_count", "price")
    df = df.withColumn("price", S.num(F.col("price")))
    return C.impute_median(df, ["horsepower", "owner_count", "price"])


def impute_mode(spark, sf):
    df = dirty_listings(spark, sf, "vin", "engine_cylinders", "franchise_make")
    return C.impute_mode(df, ["engine_cylinders", "franchise_make"])


def fill_constant(spark, sf):
    df = dirty_listings(spark, sf, "vin", "exterior_color", "listing_color", "franchise_make")
    return C.fill_like(df, "*color*", "Unknown")


def dedupe_latest(spark, sf):
    no_key = F.col("o_orderkey") % 11 == 0
    orders = table(spark, sf, "orders").select(
        F.when(~no_key, F.col("o_custkey")).alias("o_custkey"), "o_orderkey", "o_orderdate", "o_totalprice"
    )
    return C.dedupe_latest(orders, "o_custkey", "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


def dealers(spark, sf):
    df = dirty_listings(spark, sf, "vin", "franchise_dealer", "franchise_make", "make_name")
    return df.withColumn("franchise_dealer", S.to_bool(F.col("franchise_dealer")))


def count_inconsistent(spark, sf):
    return C.count_inconsistent(dealers(spark, sf), F.col("franchise_dealer"), F.col("franchise_make"))


def conditional_fill(spark, sf):
    wrong = F.col("franchise_dealer") & C.lacks_text(F.col("franchise_make"))
    return C.fill_when(dealers(spark, sf), wrong, "franchise_make", F.col("make_name"))


def cross_fill_counts(spark, sf):
    df = dirty_listings(spark, sf, "exterior_color", "listing_color")
    return C.cross_fill_counts(df, F.col("exterior_color"), F.col("listing_color"))


def unify_columns(spark, sf):
    df = dirty_listings(spark, sf, "vin", "exterior_color", "listing_color")
    return C.unify_columns(df, "unified_color", "listing_color", "exterior_color")


def clean_listings(spark, sf):
    config = clean.CleanConfig()
    cleaned = clean.clean_listings(dirty_listings(spark, sf), config, work_folder(spark))
    options = F.array_join("major_options_list", "|").alias("major_options_list")
    return cleaned.select(*[options if c == "major_options_list" else c for c in cleaned.columns])


QUERIES = {
    "drop_sparse_columns": drop_sparse_columns,
    "strip_units": x_column(
        "back_legroom", lambda: S.strip_unit(F.col("back_legroom"), " in"), "back_legroom"
    ),
    "parse_boolean": x_column(
        "franchise_dealer", lambda: S.to_bool(F.col("franchise_dealer")), "franchise_dealer"
    ),
    "parse_list": x_column(
        "options", lambda: F.array_join(S.parse_list(F.col("major_options")), "|"), "major_options"
    ),
    "list_length": x_column(
        "n_options", lambda: F.size(S.parse_list(F.col("major_options"))), "major_options"
    ),
    "extraction_pairs": extraction_pairs,
    "option_counts": option_counts,
    "first_number": x_column("horsepower", lambda: S.first_number(F.col("power")), "power"),
    "extract_rpm": x_column("rpm", lambda: S.rpm(F.col("power")), "power"),
    "match_rate": match_rate,
    "parse_date": listed_dates,
    "date_parts": date_parts,
    "strip_tags": x_column("description", lambda: S.strip_tags(F.col("description")), "description"),
    "missing_flags": missing_flags,
    "impute_median": impute_median,
    "impute_mode": impute_mode,
    "fill_constant": fill_constant,
    "dedupe_latest": dedupe_latest,
    "count_inconsistent": count_inconsistent,
    "conditional_fill": conditional_fill,
    "cross_fill_counts": cross_fill_counts,
    "unify_columns": unify_columns,
    "clean_listings": clean_listings,
}


def _x(body):
    return f"WITH {X_SQL} {body}"


def _mode(column, relation="X"):
    return f"""(SELECT {column} FROM {relation} WHERE {column} <> '' GROUP BY 1
        ORDER BY count(*) DESC, {column} LIMIT 1)"""


def _median(column, relation="X"):
    return f"(SELECT quantile_cont(CAST({column} AS DOUBLE), 0.5) FROM {relation})"


OPTIONS = (
    "CASE WHEN major_options LIKE '[%' "
    "THEN replace(replace(trim(major_options, '[]'), '''', ''), ', None', '') ELSE '' END"
)
N_OPTIONS = (
    "CASE WHEN major_options NOT LIKE '[%' OR major_options = '[]' THEN 0 "
    "ELSE CAST(len(string_split(major_options, ', ')) AS INT) END"
)

CLEAN_SQL = f"""{X_SQL}, R AS (SELECT vin, nullif(lower(trim(make_name)), '') AS make_name,
  TRY_CAST(replace(nullif(back_legroom, '--'), ' in', '') AS DOUBLE) AS back_legroom, power,
  CAST(horsepower AS DOUBLE) AS horsepower, engine_cylinders,
  coalesce(franchise_dealer = 'True', false) AS franchise_dealer,
  CASE WHEN franchise_dealer = 'True' AND franchise_make = '' THEN nullif(lower(trim(make_name)), '')
       ELSE franchise_make END AS franchise_make,
  exterior_color, listing_color, major_options, TRY_CAST(listed_date AS DATE) AS listed_date, description,
  TRY_CAST(price AS DOUBLE) AS price, CAST(TRY_CAST(year AS DOUBLE) AS INT) AS year,
  replace({OPTIONS}, ', ', '|') AS major_options_list,
  {N_OPTIONS} AS num_major_options,
  TRY_CAST(nullif(regexp_extract(power, '(\\d+)', 1), '') AS DOUBLE) AS horsepower_extracted,
  TRY_CAST(replace(nullif(regexp_extract(power, '@\\s*(\\d[\\d,]*)\\s*RPM', 1), ''), ',', '') AS DOUBLE) AS horsepower_rpm,
  TRY_CAST(nullif(regexp_extract(engine_cylinders, '(\\d+)', 1), '') AS DOUBLE) AS cylinders,
  trim(coalesce(replace(description, '[!@@Additional Info@@!]', ''), '')) AS description_cleaned FROM X),
Q AS (SELECT *, CAST(year(listed_date) AS DOUBLE) AS listed_year, CAST(month(listed_date) AS DOUBLE) AS listed_month,
  CAST(day(listed_date) AS DOUBLE) AS listed_day, CAST(isodow(listed_date) - 1 AS DOUBLE) AS listed_dayofweek,
  CASE WHEN listing_color <> '' THEN listing_color WHEN exterior_color <> '' THEN exterior_color
       ELSE 'Unknown' END AS unified_color FROM R)"""

GAP_NUMBERS = (
    "back_legroom horsepower horsepower_extracted horsepower_rpm cylinders listed_year listed_month "
    "listed_day listed_dayofweek"
).split()
GAP_MODES = "power engine_cylinders franchise_make major_options".split()
GAP_COLORS = "exterior_color listing_color".split()
GAP_TEXTS = "description description_cleaned".split()

CLEAN_SELECT = ", ".join(
    "vin make_name franchise_dealer listed_date description price year major_options_list "
    "num_major_options description_cleaned unified_color".split()
    + [f"coalesce({c}, {_median(c, 'Q')}) AS {c}" for c in GAP_NUMBERS]
    + [f"coalesce(nullif({c}, ''), {_mode(c, 'Q')}) AS {c}" for c in GAP_MODES]
    + [f"coalesce(nullif({c}, ''), 'Unknown') AS {c}" for c in GAP_COLORS]
    + [f"CAST({c} IS NULL AS INT) AS {c}_missing" for c in GAP_NUMBERS]
    + [f"CAST(coalesce({c}, '') = '' AS INT) AS {c}_missing" for c in GAP_MODES + GAP_COLORS + GAP_TEXTS]
)

ORACLES = {
    "drop_sparse_columns": _x("SELECT vin, horsepower, listing_color, engine_cylinders FROM X"),
    "strip_units": _x(
        "SELECT vin, TRY_CAST(replace(nullif(back_legroom, '--'), ' in', '') AS DOUBLE) AS back_legroom FROM X"
    ),
    "parse_boolean": _x("SELECT vin, coalesce(franchise_dealer = 'True', false) AS franchise_dealer FROM X"),
    "parse_list": _x(f"SELECT vin, replace({OPTIONS}, ', ', '|') AS options FROM X"),
    "list_length": _x(f"SELECT vin, {N_OPTIONS} AS n_options FROM X"),
    "extraction_pairs": _x(
        """SELECT DISTINCT engine_cylinders, CAST(regexp_extract(engine_cylinders, '(\\d+)', 1) AS INT) AS extracted
        FROM X WHERE engine_cylinders IS NOT NULL ORDER BY 1 LIMIT 5"""
    ),
    "option_counts": """SELECT item, count(*) AS n FROM (
        SELECT unnest(CASE p_partkey % 9 WHEN 2 THEN [] WHEN 3 THEN [p_type] WHEN 4 THEN [p_type, NULL, p_brand]
                      ELSE [p_type, p_brand] END) AS item FROM part WHERE p_partkey % 9 > 1) GROUP BY 1""",
    "first_number": _x(
        "SELECT vin, TRY_CAST(nullif(regexp_extract(power, '(\\d+)', 1), '') AS DOUBLE) AS horsepower FROM X"
    ),
    "extract_rpm": _x(
        """SELECT vin, TRY_CAST(replace(nullif(regexp_extract(power, '@\\s*(\\d[\\d,]*)\\s*RPM', 1), ''), ',', '')
        AS DOUBLE) AS rpm FROM X"""
    ),
    "match_rate": _x(
        """SELECT round(count(*) FILTER (a IS NOT DISTINCT FROM b OR abs(a - b) <= 1e-8 + 1e-5 * abs(b))
        * 100 / count(*), 4) AS match_pct FROM (
          SELECT TRY_CAST(nullif(regexp_extract(power, '(\\d+)', 1), '') AS DOUBLE) AS a,
                 CAST(horsepower AS DOUBLE) AS b FROM X)"""
    ),
    "parse_date": _x("SELECT vin, TRY_CAST(listed_date AS DATE) AS listed_date FROM X"),
    "date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS order_year,
        CAST(month(o_orderdate) AS INT) AS order_month, CAST(day(o_orderdate) AS INT) AS order_day,
        CAST(isodow(o_orderdate) - 1 AS INT) AS order_dayofweek FROM orders""",
    "strip_tags": _x(
        "SELECT vin, trim(regexp_replace(coalesce(description, ''), '\\[!@@.*?@@!\\]', '', 'g')) AS description FROM X"
    ),
    "missing_flags": _x(
        """SELECT vin, CAST(power IS NULL AS INT) AS power_missing,
        CAST(owner_count IS NULL AS INT) AS owner_count_missing FROM X"""
    ),
    "impute_median": _x(
        f"""SELECT vin, coalesce(horsepower, {_median('horsepower')}) AS horsepower,
        coalesce(owner_count, {_median('owner_count')}) AS owner_count, TRY_CAST(price AS DOUBLE) AS price FROM X"""
    ),
    "impute_mode": _x(
        f"""SELECT vin, coalesce(nullif(engine_cylinders, ''), {_mode('engine_cylinders')}) AS engine_cylinders,
        coalesce(nullif(franchise_make, ''), {_mode('franchise_make')}) AS franchise_make FROM X"""
    ),
    "fill_constant": _x(
        """SELECT vin, coalesce(nullif(exterior_color, ''), 'Unknown') AS exterior_color,
        coalesce(nullif(listing_color, ''), 'Unknown') AS listing_color, franchise_make FROM X"""
    ),
    "dedupe_latest": """SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS i
        FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS o_custkey) FROM orders))
        WHERE i = 1 OR o_custkey IS NULL""",
    "count_inconsistent": _x(
        """SELECT count(*) AS inconsistent FROM X
        WHERE franchise_dealer = 'True' AND coalesce(franchise_make, '') = ''"""
    ),
    "conditional_fill": _x(
        """SELECT vin, coalesce(franchise_dealer = 'True', false) AS franchise_dealer, make_name,
        CASE WHEN franchise_dealer = 'True' AND coalesce(franchise_make, '') = '' THEN make_name
             ELSE franchise_make END AS franchise_make FROM X"""
    ),
    "cross_fill_counts": _x(
        """SELECT count(*) FILTER (coalesce(exterior_color, '') = '' AND listing_color <> '') AS only_second,
        count(*) FILTER (coalesce(listing_color, '') = '' AND exterior_color <> '') AS only_first FROM X"""
    ),
    "unify_columns": _x(
        """SELECT vin, exterior_color, listing_color,
        coalesce(nullif(listing_color, ''), nullif(exterior_color, ''), 'Unknown') AS unified_color FROM X"""
    ),
    "clean_listings": f"WITH {CLEAN_SQL} SELECT {CLEAN_SELECT} FROM Q",
}
