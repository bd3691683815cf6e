"""A training corpus from raw documents: filter, clean, de-duplicate, decontaminate, tokenize.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. Its
result is written as Parquet to the shared folder and read again as the next one's input.
All stages but the last return the columns of ``documents``, others of any name included.

Null texts count as empty. Rows that repeat an id and a text are copies: near-dedup keeps one. Rows
that share an id, or lack one, but differ in text are documents of their own in every stage.
Of equal candidates the smallest id stays, null ids last. An empty table gives an empty
result in all stages but the first, which needs labelled rows to learn from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm import chunk_bpe, decontaminate, line_spread, quality, simhash_bk
from lotwise.llm.common import stored, table
from workload.folders import work_folder


def rows_of(docs: DataFrame) -> DataFrame:
    """Each row as one column beside its id and text, so that names of other columns can't clash."""
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("th"),
    )


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    score = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = rows_of(docs).select("row", score(F.col("text")).alias("score"))
    return scored.where(F.col("score") >= quality.THRESHOLD).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and documents of which nothing else is left."""
    rows = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row"))
    made = line_spread.drop_wide_lines(rows, folder=work_folder(spark))
    changed = F.col("n_removed") > 0
    rest = made.where(~(changed & (F.trim("text") == "")))
    n = F.length("text").cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("text"), "n_chars": F.when(changed, n).otherwise(F.col("row.n_chars"))}
    return rest.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays, of repeated rows one."""
    groups = simhash_bk.similar_groups(docs.select("doc_id", "text"), work_folder(spark))
    listed = groups.where("NOT kept OR copies > 1").select("key", "th", "kept")
    listed = stored(listed, "near-copies", work_folder(spark))
    key = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("key")
    rows = rows_of(docs).select("row", key, "th")
    alone = rows.join(listed, ["key", "th"], "left_anti").select("row")
    repeated = rows.join(listed.where("kept"), ["key", "th"])
    order = Window.partitionBy("key", "th").orderBy(*[F.col("row")[c] for c in docs.columns if c != "text"])
    one = repeated.withColumn("place", F.row_number().over(order)).where("place = 1").select("row")
    return alone.unionByName(one).select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go: that row, and no other with its id."""
    found = decontaminate.contaminated(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    named = found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct()
    named = stored(named, "contaminated", work_folder(spark))
    rows = rows_of(docs).select("row", "doc_id", "th")
    match = (rows["th"] == named["hash"]) & rows["doc_id"].eqNullSafe(named["id"])
    return rows.join(named, match, "left_anti").select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    made = chunk_bpe.encode_documents(docs.select("doc_id", "text"), path, work_folder(spark))
    return made.select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding and decoding", encoded),
]

#: The classifier can't be written in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}", work_folder(spark))
    return docs
