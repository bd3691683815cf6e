"""Mixing of sources: targets against the iterated definition, spans against the texts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lotwise.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def shares(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again what full sources leave, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = [s for s in rest if share[s] > cap * sizes[s] + 1e-9]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


def corpus():
    names = ["b", "a", None, "Z", "é", "", "tiny", "none"]
    rows = []
    for i in range(400):
        name = "a" if i % 3 == 0 else names[i % 5]
        rows.append((i, " ".join(f"w{i}x{k}" for k in range((i * 37) % 90)), name))
    rows += [(None, "no id here", "a"), (None, None, "a"), (3, None, None), (900, "one two", "tiny"), (901, "", "none")]
    rows += [(902, "same text in two rows", "b")] * 2 + [(903, "long " * 20_000, "b"), (904, " \t\n\v\f\r ", "")]
    return rows


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("mixing"))
    docs = spark.createDataFrame(corpus(), SCHEMA)
    spans, documents, sources = mixing.mixed(docs, folder)
    return mixing.stored(spans, "spans", folder), documents, sources, docs


def test_targets_are_shared_until_none_is_above(made):
    rows, sizes = made[2].collect(), defaultdict(int)
    for _, text, name in corpus():
        sizes[name] += len(WORD.findall(text or ""))
    want = shares(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)


@pytest.mark.parametrize("sizes", [[1, 1, 1000], [0, 5, 0], [10, 0, 10, 10**6], [7], [0], [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]])
def test_targets_of_odd_sizes(spark, sizes):
    rows = [(i, f"s{i:02}", 0, n) for i, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "doc_id long, source string, th long, size long")).collect()
    want = shares({f"s{i:02}": n for i, n in enumerate(sizes)})
    for r in got:
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        assert 0 <= r.quota <= 3 * r.blocks


def test_taken_words_meet_the_targets(made):
    spans, documents, sources, _ = made
    rows = mixing.taken(spans, documents, sources).collect()
    assert len(rows) == len(corpus())
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    got = defaultdict(int)
    for r in spans.collect():
        got[r.number] += r.n_words
    for s in sources.collect():
        assert abs(got[s.number] - s.target) <= 1.5 * mixing.BLOCK_WORDS
    assert sum(r.taken for r in rows) == sum(got.values())


def test_slots_hold_blocks_of_equal_length(made):
    spans, _, sources, _ = made
    last = {r.number: r.blocks - 1 for r in sources.collect()}
    length, blocks = Counter(), {}
    for r in spans.collect():
        length[r.shard, r.slot] += r.n_words
        assert blocks.setdefault((r.shard, r.slot), (r.number, r.round, r.block)) == (r.number, r.round, r.block)
    assert len(set(blocks.values())) == len(blocks), "a block is used once in a round"
    for slot, n in length.items():
        number, _, block = blocks[slot]
        assert n == mixing.BLOCK_WORDS or block == last[number] and n < mixing.BLOCK_WORDS
    assert sorted(slot for _, slot in length) == list(range(len(length)))


def test_words_of_spans(made):
    spans, documents, _, docs = made
    texts = {(i, len(WORD.findall(t or ""))): WORD.findall(t or "") for i, t, _ in corpus()}
    size = {(r.number, r.start): r["size"] for r in documents.where("size > 0").collect()}
    rows = mixing.span_texts(spans, docs).collect()
    assert len(rows) == spans.count()
    for r in rows:
        words = texts[r.doc_id, size[r.number, r.start]]
        assert r.words == " ".join(words[r["first"] : r["first"] + r.n_words])


def test_reruns_agree_whatever_the_partitions(spark, made, tmp_path):
    spans, documents, sources, docs = made
    again = mixing.taken(*mixing.mixed(docs.repartition(7), str(tmp_path)))
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.taken(spans, documents, sources).collect()))


def test_permutations_reach_every_block(spark):
    sources = spark.createDataFrame([(0, 1, 3), (1, 64, 150), (2, 1000, 3000)], "number long, blocks long, quota long")
    slots = sources.select(
        F.lit(0).alias("shard"), F.lit(0).alias("slot"), "number", F.explode(F.sequence(F.lit(0), F.col("quota") - 1)).alias("turn")
    )
    blocks = defaultdict(list)
    for r in mixing.permuted(slots, sources).collect():
        blocks[r.number, r.round].append(r.block)
    for (number, turn), got in blocks.items():
        n = {0: 1, 1: 64, 2: 1000}[number]
        assert len(set(got)) == len(got) and set(got) <= set(range(n))
        if number == 2:
            assert len(got) == 1000
    assert blocks[2, 0] != blocks[2, 1]


def test_shards_draw_multinomial_counts(spark):
    sources = spark.createDataFrame([(0, 30_000), (1, 10_000), (2, 960)], "number long, quota long")
    sources = sources.selectExpr("*", "element_at(array(0L, 30000L, 40000L), CAST(number + 1 AS INT)) AS low")
    rows = mixing.drawn(sources, 40_960).groupBy("shard", "number").count().collect()
    assert sum(r["count"] for r in rows) == 40_960
    big = [r["count"] for r in rows if r.number == 0]
    assert len(big) == 10 and len(set(big)) > 1 and all(abs(n - 3000) < 200 for n in big)


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    run = lambda rows, schema: mixing.taken(*mixing.mixed(spark.createDataFrame(rows, schema), str(tmp_path))).collect()
    assert run([], SCHEMA) == []
    assert [tuple(r) for r in run([(1, None, "a")], SCHEMA)] == [(1, 0, 0, 0.0, 0)]
    schema = "doc_id int, text string, source string, size string, start int, number string, block int"
    rows = run([(5, "a b c", "x", "s", 1, "n", 2)], schema)
    assert [tuple(r) for r in rows] == [(5, 3, 3, 3.0, 3)]
