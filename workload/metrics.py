"""Metric-table operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions.scalars import BAND_LABELS, price_band
from lotwise.operators import metrics
from workload.jobs import BAND
from workload.views import D_SQL, M_SQL, metric_table, table, text_listings

JOB_KEYS = ["job", "technology", "nodes"]
SIZE_KEYS = ["job", "technology", "size_pct"]
STATUS = {"F": "Filled", "O": "Open"}


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def union_sources(spark, sf):
    customers = table(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "id", "c_acctbal": "balance"}
    )
    suppliers = table(spark, sf, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_acctbal": "balance"})
    return metrics.union_tagged(
        {
            "customer": customers.select("id", "balance", "c_mktsegment"),
            "supplier": suppliers.select("id", "balance", "s_name"),
        }
    )


def coalesce_schemas(spark, sf):
    m = metric_table(spark, sf)
    a = F.when(F.col("nodes") == 3, F.col("size_pct").cast("double"))
    b = F.when(F.col("nodes") == 5, F.col("size_pct") / 2)
    return m.select(*JOB_KEYS, "size_pct", metrics.coalesce_scaled(a, b).alias("size_display"))


def map_labels(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", metrics.map_labels(F.col("o_orderstatus"), STATUS).alias("status")
    )


def normalize_names(spark, sf):
    name = F.concat(F.lower("p_brand"), F.when(F.col("p_size") % 2 == 0, "_spark").otherwise("sql"))
    return table(spark, sf, "part").select("p_partkey", metrics.normalize_names(name).alias("name"))


def throughput(spark, sf):
    m = metric_table(spark, sf)
    m = m.withColumn("time_sec", F.when(F.col("size_pct") == 1, 0.0).otherwise(F.col("time_sec")))
    rates = metrics.throughput(m, "records", "size_pct", "time_sec")
    return rounded(rates, "records_per_sec", "mb_per_sec")


def speedup_vs_smallest(spark, sf):
    out = metrics.ratio_to_first(metric_table(spark, sf), JOB_KEYS, "size_pct", "time_sec")
    return rounded(out, "ideal_speedup", "actual_speedup")


def speedup_vs_baseline(spark, sf):
    out = metrics.ratio_to_baseline(metric_table(spark, sf), SIZE_KEYS, "nodes", 3, "time_sec")
    return rounded(out, "speedup", "ideal_speedup", "efficiency_pct")


def growth_factors(spark, sf):
    out = metrics.growth(metric_table(spark, sf), JOB_KEYS, "size_pct", "time_sec")
    return rounded(out, "dataset_growth", "time_growth", "scaling_factor")


def scaling_verdict(spark, sf):
    out = metrics.scaling_verdict(metric_table(spark, sf), JOB_KEYS, "size_pct", "time_sec")
    return rounded(out, "size_ratio", "time_ratio")


def metric_pivot(spark, sf):
    rows = ["job", "technology", "size_pct"]
    return metrics.pivot_mean(metric_table(spark, sf), rows, "nodes", "time_sec", [3, 5, 7], prefix="nodes_")


def metric_pivot_many(spark, sf):
    m = metrics.throughput(metric_table(spark, sf), "records", "size_pct", "time_sec")
    values = ["time_sec", "records_per_sec"]
    wide = metrics.pivot_mean(m, ["job", "size_pct"], "technology", values, ["F", "O"])
    return rounded(wide, *[f"{t}_{v}" for t in "FO" for v in values])


def metric_grid_zero(spark, sf):
    """Not every source has texts of every band: these cells are 0."""
    d = text_listings(spark, sf).withColumn("band", price_band(F.col("price")))
    wide = metrics.pivot_mean(d, ["city", "year"], "band", "price", BAND_LABELS, prefix="mean_", zero=True)
    return rounded(wide, *[f"mean_{b}" for b in BAND_LABELS])


QUERIES = {
    "union_sources": union_sources,
    "coalesce_schemas": coalesce_schemas,
    "map_labels": map_labels,
    "normalize_names": normalize_names,
    "throughput": throughput,
    "speedup_vs_smallest": speedup_vs_smallest,
    "speedup_vs_baseline": speedup_vs_baseline,
    "growth_factors": growth_factors,
    "scaling_verdict": scaling_verdict,
    "metric_pivot": metric_pivot,
    "metric_pivot_many": metric_pivot_many,
    "metric_grid_zero": metric_grid_zero,
}

FIRST = """first_value(size_pct) OVER w AS s0, first_value(time_sec) OVER w AS t0"""
FIRST_WINDOW = "WINDOW w AS (PARTITION BY job, technology, nodes ORDER BY size_pct)"

ORACLES = {
    "union_sources": """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment, NULL AS s_name,
        'customer' AS engine FROM customer
        UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name, 'supplier' FROM supplier""",
    "coalesce_schemas": f"""WITH {M_SQL} SELECT job, technology, nodes, size_pct,
        CASE nodes WHEN 3 THEN CAST(size_pct AS DOUBLE) WHEN 5 THEN CAST(size_pct AS DOUBLE) / 2 END * 100
        AS size_display FROM M""",
    "map_labels": """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' END
        AS status FROM orders""",
    "normalize_names": "SELECT p_partkey, lower(p_brand) AS name FROM part",
    "throughput": f"""WITH {M_SQL}, Z AS (SELECT * REPLACE (CASE WHEN size_pct = 1 THEN 0 ELSE time_sec END
          AS time_sec) FROM M)
        SELECT *, round(CASE WHEN time_sec > 0 THEN records / time_sec ELSE 0 END, 6) AS records_per_sec,
        round(CASE WHEN time_sec > 0 THEN size_pct / time_sec ELSE 0 END, 6) AS mb_per_sec FROM Z""",
    "speedup_vs_smallest": f"""WITH {M_SQL}, S AS (SELECT *, {FIRST} FROM M {FIRST_WINDOW})
        SELECT job, technology, nodes, size_pct, time_sec, records,
        round(CAST(size_pct AS DOUBLE) / s0, 6) AS ideal_speedup, round(t0 / time_sec, 6) AS actual_speedup FROM S""",
    "speedup_vs_baseline": f"""WITH {M_SQL} SELECT a.job, a.technology, a.nodes, a.size_pct, a.time_sec, a.records,
        round(b.time_sec / a.time_sec, 6) AS speedup, round(a.nodes / 3.0::DOUBLE, 6) AS ideal_speedup,
        round(b.time_sec / a.time_sec / (a.nodes / 3.0::DOUBLE) * 100, 6) AS efficiency_pct
        FROM M a JOIN M b ON a.job = b.job AND a.technology = b.technology AND a.size_pct = b.size_pct
        AND b.nodes = 3""",
    "growth_factors": f"""WITH {M_SQL}, S AS (SELECT *, {FIRST} FROM M {FIRST_WINDOW})
        SELECT job, technology, nodes, size_pct, time_sec, records,
        round(CAST(size_pct AS DOUBLE) / s0, 6) AS dataset_growth, round(time_sec / t0, 6) AS time_growth,
        round(time_sec / t0 / (CAST(size_pct AS DOUBLE) / s0), 6) AS scaling_factor FROM S""",
    "scaling_verdict": f"""WITH {M_SQL}, E AS (SELECT job, technology, nodes,
          max(size_pct)::DOUBLE / min(size_pct) AS sr, arg_max(time_sec, size_pct) / arg_min(time_sec, size_pct) AS tr
          FROM M GROUP BY 1, 2, 3)
        SELECT job, technology, nodes, round(sr, 6) AS size_ratio, round(tr, 6) AS time_ratio,
        CASE WHEN tr < sr THEN 'SUB-linear' WHEN tr > sr THEN 'SUPER-linear' ELSE 'linear' END AS verdict FROM E""",
    "metric_pivot": f"""WITH {M_SQL} SELECT job, technology, size_pct, avg(time_sec) FILTER (nodes = 3) AS nodes_3,
        avg(time_sec) FILTER (nodes = 5) AS nodes_5, avg(time_sec) FILTER (nodes = 7) AS nodes_7
        FROM M GROUP BY 1, 2, 3""",
    "metric_pivot_many": f"WITH {M_SQL} SELECT job, size_pct, "
    + ", ".join(
        f"round(avg({e}) FILTER (technology = '{t}'), 6) AS {t}_{v}"
        for t in "FO"
        for v, e in (("time_sec", "time_sec"), ("records_per_sec", "records / time_sec"))
    )
    + " FROM M GROUP BY 1, 2",
    "metric_grid_zero": f"WITH {D_SQL}, B AS (SELECT *, {BAND} AS band FROM D) SELECT city, year, "
    + ", ".join(f"round(coalesce(avg(price) FILTER (band = '{b}'), 0), 6) AS mean_{b}" for b in BAND_LABELS)
    + " FROM B GROUP BY 1, 2",
}
