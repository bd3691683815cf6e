"""Line dedup: lines that stand on many sites are boilerplate.

Spread is the number of distinct sites (``source``) a line stands on. Occurrences are
counted first: a line with fewer occurrences than sites asked for can't reach them. For the
rest a HyperLogLog sketch of the sites per line hash, merged across tasks, decides clear
cases; lines whose estimate is near the threshold get an exact distinct count. Of a
boilerplate line the occurrence in the smallest (doc_id, text, place) stays, so nothing
vanishes from the corpus altogether; the others are removed.

Lines are compared without spaces at their ends. Blank lines are never removed; a null
source is no site; null text counts as empty. Rows that repeat both doc_id and text are
treated alike. Texts without a removed line stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import stored, table
from workload.folders import work_folder

MIN_SITES = 10
SKETCH_LOG_SIZE = 12
#: Estimates within so many standard errors of the threshold are counted exactly.
NEAR = 6


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_th", F.xxhash64("text"))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, site, pos, h1, h2): every line that is not blank, by a hash of 96 bits."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("th"),
        F.col("source").alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    key = F.trim("line")
    return rows.where(key != "").select(
        "doc_id", "th", "site", "pos", F.xxhash64(key).alias("h1"), F.hash(key).alias("h2")
    )


def wide_lines(lines: DataFrame, min_sites: int, folder: str | None) -> DataFrame:
    """(h1, h2) of the lines that stand on at least ``min_sites`` distinct sites."""
    # Stored ahead of the join, so that the join can split or broadcast what lines are few.
    often = lines.groupBy("h1", "h2").agg(F.count("site").alias("n")).where(F.col("n") >= min_sites)
    often = stored(often.select("h1", "h2"), "often-lines", folder)
    open_lines = lines.join(often, ["h1", "h2"]).where("site IS NOT NULL")
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_LOG_SIZE)).alias("sites")
    judged = stored(open_lines.groupBy("h1", "h2").agg(sketch), "line-sketches", folder)
    slack = max(2.0, NEAR * 1.04 / 2 ** (SKETCH_LOG_SIZE / 2) * min_sites)
    clear = judged.where(F.col("sites") > min_sites + slack).select("h1", "h2")
    near = judged.where(F.col("sites").between(min_sites - slack, min_sites + slack))
    pairs = lines.join(near.select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count("site").alias("sites"))
    return clear.unionByName(exact.where(F.col("sites") >= min_sites).select("h1", "h2"))


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES, folder: str | None = None) -> DataFrame:
    """(doc_id, th, places): the lines to remove from each text."""
    lines = line_rows(docs)
    found = lines.join(stored(wide_lines(lines, min_sites, folder), "wide-lines", folder), ["h1", "h2"])
    found = stored(found.select("doc_id", "th", "pos", "h1", "h2"), "wide-places", folder)
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "th", "pos")).alias("first"))
    first = stored(first, "first-places", folder)
    here = F.struct("doc_id", "th", "pos")
    others = found.join(first, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first")))
    return others.groupBy("doc_id", "th").agg(F.collect_set("pos").alias("places"))


def drop_wide_lines(docs: DataFrame, min_sites: int = MIN_SITES, folder: str | None = None) -> DataFrame:
    """``docs`` with the boilerplate removed from ``text``, and ``n_removed`` lines of each."""
    gone = removed_lines(docs, min_sites, folder).select(
        F.col("doc_id").alias("_id"), F.col("th").alias("_gone_th"), F.col("places").alias("_places")
    )
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    other = F.coalesce("_id", F.lit(-(2**63)))
    rows = with_text_hash(docs).join(gone, (own == other) & (F.col("_th") == F.col("_gone_th")), "left")
    kept = F.when(F.col("_places").isNull(), F.col("text")).otherwise(without("text", "_places"))
    count = F.coalesce(F.size("_places"), F.lit(0)).cast("long")
    return rows.withColumns(
        {"text": kept, "n_removed": F.when(F.col("_places").isNull(), F.lit(0)).otherwise(count)}
    ).drop("_th", "_id", "_gone_th", "_places")


def without(text: str, places: str) -> Column:
    """A text without the lines at these places."""
    lines = F.split(text, "\n")
    rest = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(places)))
    return F.array_join(F.transform(rest, lambda i: F.get(lines, i)), "\n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    made = drop_wide_lines(docs, folder=work_folder(spark))
    text = F.coalesce("text", F.lit(""))
    return made.select(
        "doc_id",
        F.col("n_removed").cast("long").alias("n_removed"),
        F.length(text).cast("long").alias("kept_chars"),
        F.sha2(text.cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, trim(line) AS key FROM l),
w AS (SELECT key, min((doc_id, pos)) AS first FROM k WHERE key <> ''
      GROUP BY key HAVING count(DISTINCT source) >= {MIN_SITES}),
j AS (SELECT k.*, w.key IS NOT NULL AND w.first <> (k.doc_id, k.pos) AS gone FROM k LEFT JOIN w USING (key)),
t AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
      FROM j GROUP BY doc_id)
SELECT doc_id, n_removed, length(kept) AS kept_chars, sha256(kept) AS kept_sha256 FROM t"""

QUERIES = {"op3_line_spread": query}
ORACLES = {"op3_line_spread": ORACLE}
