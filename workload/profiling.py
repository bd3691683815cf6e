"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import frequent, profiling
from workload.views import M_SQL, X_SQL, dirty_listings, metric_table, table


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 4) for n in names})


ORDER_TEXTS = ["o_orderstatus", "o_orderpriority"]
ORDER_NUMBERS = ["o_totalprice", "o_custkey"]
PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
X_TEXTS = (
    "make_name back_legroom power engine_cylinders franchise_dealer franchise_make exterior_color "
    "listing_color major_options listed_date description price year"
).split()
X_TYPES = {"vin": "bigint", "horsepower": "int", "owner_count": "int"}


def placeholder_report(spark, sf):
    """Statuses are the placeholder texts of this table: 'F' and 'O' stand for none."""
    orders = table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "F", "None")
        .when(F.col("o_orderstatus") == "O", "none")
        .otherwise(F.col("o_orderstatus"))
        .alias("status"),
    )
    return rounded(profiling.placeholder_report(orders), "pct")


FREQUENT = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_suppkey", "l_comment_like"]


def frequent_values(spark, sf):
    """The most frequent value of columns with few, many and blank values."""
    rows = table(spark, sf, "lineitem").withColumn(
        "l_comment_like", F.when(F.col("l_orderkey") % 4 == 0, "").otherwise(F.concat("l_returnflag", "l_linenumber"))
    )
    return frequent.most_frequent(rows, FREQUENT)


QUERIES = {
    "frequent_values": frequent_values,
    "table_shape": lambda spark, sf: profiling.table_shape(table(spark, sf, "orders")),
    "column_info": lambda spark, sf: profiling.column_info(dirty_listings(spark, sf)),
    "describe_numeric": lambda spark, sf: rounded(
        profiling.describe_numeric(table(spark, sf, "orders"), ORDER_NUMBERS),
        "mean", "std", "q25", "median", "q75",
    ),
    "describe_text": lambda spark, sf: profiling.describe_text(table(spark, sf, "orders"), ORDER_TEXTS),
    "unique_counts": lambda spark, sf: profiling.unique_counts(table(spark, sf, "part")),
    "missing_report": lambda spark, sf: rounded(
        profiling.missing_report(dirty_listings(spark, sf)), "pct"
    ),
    "placeholder_report": placeholder_report,
    "duplicate_report": lambda spark, sf: profiling.duplicate_report(
        table(spark, sf, "orders"), "o_custkey"
    ),
    "distinct_values": lambda spark, sf: profiling.distinct_values(metric_table(spark, sf), "nodes"),
}


def _union(rows):
    return " UNION ALL ".join(rows)


_FREQUENT_VALUES = {c: c for c in FREQUENT} | {
    "l_quantity": "printf('%.1f', l_quantity)",
    "l_comment_like": "CASE WHEN l_orderkey % 4 <> 0 THEN concat(l_returnflag, l_linenumber) END",
}

ORACLES = {
    "frequent_values": _union(
        f"""(SELECT '{c}' AS "column", CAST({v} AS VARCHAR) AS top, count(*) AS n FROM lineitem
        WHERE {v} IS NOT NULL GROUP BY 2 ORDER BY n DESC, top LIMIT 1)"""
        for c, v in _FREQUENT_VALUES.items()
    ),
    "table_shape": "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders",
    "column_info": f"WITH {X_SQL} "
    + _union(
        f"SELECT '{c}' AS \"column\", '{X_TYPES.get(c, 'string')}' AS dtype, count({c}) AS non_null FROM X"
        for c in [*X_TYPES, *X_TEXTS]
    ),
    "describe_numeric": _union(
        f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM orders"""
        for c in ORDER_NUMBERS
    ),
    "describe_text": _union(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS n, count(*) AS n_unique,
        first({c} ORDER BY n DESC, {c}) AS top, max(n) AS top_n
        FROM (SELECT {c}, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ORDER_TEXTS
    ),
    "unique_counts": _union(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM part" for c in PART_COLUMNS
    ),
    "missing_report": f"WITH {X_SQL} SELECT * FROM ("
    + _union(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing,
        round((count(*) - count({c})) / count(*) * 100, 4) AS pct FROM X"""
        for c in [*X_TYPES, *X_TEXTS]
    )
    + ") WHERE missing > 0",
    "placeholder_report": """WITH O AS (
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS priority, o_orderstatus AS s
        FROM orders)
        SELECT 'priority' AS "column", 'empty' AS placeholder, count(*) FILTER (priority = '') AS n,
               round(count(*) FILTER (priority = '') / count(*) * 100, 4) AS pct FROM O
        UNION ALL
        SELECT 'status', 'none', count(*) FILTER (s IN ('F', 'O')),
               round(count(*) FILTER (s IN ('F', 'O')) / count(*) * 100, 4) FROM O""",
    "duplicate_report": """SELECT count(*) AS duplicated_keys, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
        FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1)""",
    "distinct_values": f"WITH {M_SQL} SELECT DISTINCT nodes FROM M",
}
