"""Listing-shaped views over the given tables, for Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- L: numeric listings, one per line item -------------------------------------------------

# Prices are multiples of 1/64: six decimals, yet sums and means of them are exact.

LISTING_COLUMNS = (
    "l_orderkey l_linenumber make_name model_name city price year daysonmarket".split()
)


def listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """View L with the asked columns; joins only the tables these columns come from."""
    wanted = columns or tuple(LISTING_COLUMNS)
    df = table(spark, sf_dir, "lineitem")
    if {"make_name", "model_name"} & set(wanted):
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "daysonmarket" in wanted:
        df = df.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    if "city" in wanted:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        df = df.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    exprs = {
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "make_name": "p_brand",
        "model_name": "p_type",
        "city": "n_name",
        "price": "floor(l_extendedprice) + l_linenumber / 64D",
        "year": "year(l_shipdate)",
        "daysonmarket": "datediff(l_shipdate, o_orderdate)",
    }
    return df.select(*[F.expr(exprs[c]).alias(c) for c in wanted])


L_SQL = """L AS (
  SELECT l.l_orderkey, l.l_linenumber, p.p_brand AS make_name, p.p_type AS model_name,
         n.n_name AS city, floor(l.l_extendedprice) + l.l_linenumber / 64::DOUBLE AS price, CAST(year(l.l_shipdate) AS INT) AS year,
         CAST(datediff('day', o.o_orderdate, l.l_shipdate) AS INT) AS daysonmarket
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


# --- D: listings with text ------------------------------------------------------------------

_D_COLUMNS = """doc_id, lang AS city, CAST(2000 + CAST(substr(source, 4) AS INT) AS INT) AS year,
  CAST(n_chars * 20 AS DOUBLE) AS price, CAST(doc_id % 181 AS INT) AS daysonmarket,
  text AS description, CASE WHEN doc_id % 10 = 0 THEN '' ELSE text END AS description_cleaned"""

D_SQL = f"D AS (SELECT {_D_COLUMNS} FROM documents)"


def text_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.col("lang").alias("city"),
        (2000 + F.expr("CAST(substr(source, 4) AS INT)")).alias("year"),
        (F.col("n_chars") * 20).cast("double").alias("price"),
        (F.col("doc_id") % 181).cast("int").alias("daysonmarket"),
        F.col("text").alias("description"),
        F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.col("text")).alias("description_cleaned"),
    )


# --- X: dirty text columns ------------------------------------------------------------------

_X_COLUMNS = {
    "vin": "p_partkey",
    "make_name": "concat(' ', upper(p_brand), ' ')",
    "back_legroom": "CASE WHEN p_partkey % 13 = 0 THEN '--' WHEN p_partkey % 7 = 0 THEN NULL "
    "ELSE concat(CAST(p_size AS VARCHAR(9)), '.5 in') END",
    "power": "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '' "
    "ELSE concat(CAST(100 + p_size AS VARCHAR(9)), ' hp @ ', CAST(1 + p_size % 6 AS VARCHAR(9)), "
    "',500 RPM') END",
    "horsepower": "CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN 1 "
    "ELSE 100 + p_size END",
    "engine_cylinders": "CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE concat(CASE WHEN p_size % 2 = 0 "
    "THEN 'V' ELSE 'I' END, CAST(4 + 2 * (p_size % 3) AS VARCHAR(9))) END",
    "franchise_dealer": "CASE WHEN p_partkey % 3 = 0 THEN 'True' WHEN p_partkey % 3 = 1 THEN 'False' "
    "ELSE NULL END",
    "franchise_make": "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END",
    "exterior_color": "CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 6 = 1 THEN NULL "
    "ELSE 'red' END",
    "listing_color": "CASE WHEN p_partkey % 4 = 1 THEN NULL WHEN p_partkey % 4 = 2 THEN '' "
    "ELSE 'BLUE' END",
    "major_options": "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 = 1 THEN 'oops' "
    "WHEN p_partkey % 9 = 2 THEN '[]' WHEN p_partkey % 9 = 3 THEN concat('[', chr(39), p_type, chr(39), ']') "
    "WHEN p_partkey % 9 = 4 THEN concat('[', chr(39), p_type, chr(39), ', None, ', chr(39), p_brand, chr(39), ']') "
    "ELSE concat('[', chr(39), p_type, chr(39), ', ', chr(39), p_brand, chr(39), ']') END",
    "listed_date": "CASE WHEN p_partkey % 8 = 0 THEN 'bad' ELSE concat('2020-09-', "
    "CAST(10 + p_size % 20 AS VARCHAR(9))) END",
    "description": "CASE WHEN p_partkey % 15 = 0 THEN NULL WHEN p_partkey % 15 = 1 THEN '' "
    "ELSE concat(p_name, ' [!@@Additional Info@@!] ', p_type) END",
    "owner_count": "CASE WHEN p_partkey % 5 = 0 THEN p_size ELSE NULL END",
    "price": "CASE WHEN p_partkey % 10 = 0 THEN 'n/a' WHEN p_partkey % 10 = 1 THEN '' "
    "ELSE CAST(p_retailprice AS VARCHAR(32)) END",
    "year": "concat(CAST(1990 + p_size AS VARCHAR(9)), '.0')",
}


def dirty_listings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    wanted = columns or tuple(_X_COLUMNS)
    return table(spark, sf_dir, "part").selectExpr(*[f"{_X_COLUMNS[c]} AS {c}" for c in wanted])


X_SQL = "X AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _X_COLUMNS.items()) + " FROM part)"


# --- M: long metric table -------------------------------------------------------------------

_M_COLUMNS = """l_returnflag AS job, l_linestatus AS technology,
  CAST(3 + 2 * (l_suppkey % 3) AS INT) AS nodes, l_linenumber AS size_pct"""

M_SQL = (
    f"M AS (SELECT {_M_COLUMNS}, sum(l_quantity) AS time_sec, count(*) AS records "
    "FROM lineitem GROUP BY 1, 2, 3, 4)"
)


def metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("job"),
        F.col("l_linestatus").alias("technology"),
        (3 + 2 * (F.col("l_suppkey") % 3)).cast("int").alias("nodes"),
        F.col("l_linenumber").alias("size_pct"),
        "l_quantity",
    )
    return rows.groupBy("job", "technology", "nodes", "size_pct").agg(
        F.sum("l_quantity").alias("time_sec"), F.count(F.lit(1)).alias("records")
    )


def with_view(view: str, body: str) -> str:
    return f"WITH {view} {body}"
