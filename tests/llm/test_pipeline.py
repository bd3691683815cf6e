"""The pipeline's stages in order, each on what the one before kept."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lotwise.llm import decontaminate, simhash_bk
from lotwise.llm.common import stored, table
from lotwise.llm.registry import ORACLES, QUERIES


def test_every_operator_is_registered():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert "pipeline" in QUERIES and set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id"))
    sizes = [docs.count()]
    before = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stored(stage(spark, docs, sf_dir), "stage", str(tmp_path))
        assert made.columns == docs.columns and made.dtypes == docs.dtypes
        before[name], docs = docs, made
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[-1] > sizes[0] / 2
    # Boilerplate: texts and their lengths agree.
    assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    # Near-duplicates: all pairs of what is left are below the similarity.
    kept = before["benchmark decontamination"].collect()
    sets = [set(simhash_bk.shingle_hashes(r.text.encode(), 5).tolist()) for r in kept]
    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            common = len(a & b)
            assert common < 0.8 * (len(a) + len(b) - common)
    # Benchmark: no document left holds an item.
    items = [decontaminate.plain(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    rest = docs.collect()
    assert not any(item in decontaminate.plain(r.text) for item in items for r in rest)
    # The last stage encodes each of them.
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.encoded(spark, docs, sf_dir).collect()}
    assert ids == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in rest}


def test_stages_take_empty_tables_and_nulls(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], docs.schema
    )
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        assert stage(spark, odd, sf_dir).count() >= 1


def test_near_dedup_keeps_one_of_repeated_rows(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    rows = [(1, "one text of several words", "en", "s", 25)] * 3 + [(2, "quite another text of its own", "en", "s", 29)]
    rows += [(None, "a text without an id", "en", "s", 20)] * 2 + [(None, None, None, None, None)] * 2
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, schema), sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == sorted(set(rows), key=str)


CLEAN = "A clean text that has nothing to do with any of the items and is long enough to stand."


def test_decontamination_removes_the_row_and_not_its_id(spark, sf_dir):
    item = max((r.text for r in table(spark, sf_dir, "benchmark").collect()), key=len)
    rows = [(None, item, "en", "s", 1), (None, CLEAN, "en", "s", 2), (3, "x " + item, "en", "s", 3), (3, CLEAN, "en", "s", 4)]
    rows += [(4, CLEAN, "en", "s", 5)] * 2 + [(5, None, "en", "s", 6), (6, item, "en", "s", 7), (6, item, "en", "s", 7)]
    schema = table(spark, sf_dir, "documents").schema
    got = corpus_pipeline.decontaminated(spark, spark.createDataFrame(rows, schema), sf_dir).collect()
    assert sorted(map(tuple, got), key=str) == sorted((r for r in rows if r[1] in (CLEAN, None)), key=str)


def test_stages_keep_columns_whatever_their_names(spark, sf_dir):
    clashing = ["th", "key", "kept", "_id", "_th", "_n", "n_removed", "_score", "_places", "row", "text_hash", "copies", "own"]
    docs = table(spark, sf_dir, "documents").where("doc_id < 60")
    docs = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id")).alias(c) for c in clashing])
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.dtypes == docs.dtypes, name
        rows = made.collect()
        assert rows and all(r[c] == f"{c}{r.doc_id}" for r in rows for c in clashing), name
    assert corpus_pipeline.encoded(spark, docs, sf_dir).count() == docs.count()


def test_quality_stage_keeps_columns(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents").withColumn("_score", F.lit("mine")).withColumn("row", F.lit(1))
    made = corpus_pipeline.quality_filter(spark, docs, sf_dir)
    assert made.dtypes == docs.dtypes
    assert 0 < made.where("_score = 'mine' AND row = 1").count() < docs.count()
