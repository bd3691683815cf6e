"""Ranked search against a plain loop over all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lotwise.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [] if text is None else TERM.findall(text.translate(FOLD))


def plain(docs, items, best):
    """Sorted (item_id, rank, doc_id, score), by the formula and a full sort."""
    held = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    held = [(doc_id, tf) for doc_id, tf in held if tf]
    n_docs, length = len(held), sum(tf.total() for _, tf in held)
    df = Counter(t for _, tf in held for t in tf)
    out = []
    for item_id, text in {(i, t) for i, t in items if t is not None}:
        found = []
        for doc_id, tf in held:
            m = 100 - 50 + (50 * tf.total() * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in set(words(text))
                if t in tf
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(found)[:best], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items, best=5, schema="doc_id long, text string", **options):
    docs = spark.createDataFrame(docs, schema)
    items = spark.createDataFrame(items, "item_id long, text string")
    made = lexical.ranked(docs, items, best, **options)
    return sorted(map(tuple, made.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(150)] + ["Été", "ÉTÉ", "naïve", "x-y", "a_b", "漢字", "É", "The"]
    pick = lambda k: " ".join(vocab[min(int(rng.expovariate(0.05)), len(vocab) - 1)] for _ in range(k))
    docs = [(i, pick(rng.randint(0, 60))) for i in range(n)]
    return docs, [(i, pick(rng.randint(0, 200))) for i in range(8)]


@pytest.mark.parametrize("postings,block_bytes", [(400_000, 8_000_000), (90, 300)])
def test_equals_a_full_sort(spark, monkeypatch, postings, block_bytes):
    monkeypatch.setattr(lexical, "CHUNK_POSTINGS", postings)
    docs, items = corpus(300)
    copies = [(1000 + i, docs[7][1]) for i in range(40)]  # equal scores go by id
    odd = [(None, docs[7][1]), (None, None), (2, None), (5, ""), (6, "--- !"), (7, docs[7][1]), (7, docs[7][1])]
    odd += [(9000, "w1 " * 40_000 + "long Tail_end\x00nul")]
    more = [(1, items[1][1]), (1, "w1 the Été"), (None, "w2 w3"), (50, None), (51, ""), (52, "nowhere"), (53, "TAIL nul")]
    got = found(spark, docs + copies + odd, items + more, block_bytes=block_bytes)
    assert got == plain(docs + copies + odd, items + more, 5)


def test_empty_tables_and_clashing_columns(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "..")], [(1, "a")]) == []
    schema = "doc_id int, text string, terms string, n string, score int, item_id int"
    assert found(spark, [(1, "A b", "x", "y", 2, 3), (2, "c", "x", "y", 2, 3)], [(4, "a")], schema=schema) == plain(
        [(1, "A b"), (2, "c")], [(4, "a")], 5
    )


def test_terms_are_runs_of_bytes_or_characters():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aZ09 \x00\x7f/:@[`{éÉß漢🙂\x85 ") for _ in range(40))
        assert [t.decode() for t in lexical.terms(text.encode())] == words(text)


def test_masks_below_the_best_are_not_evaluated():
    n = 5000
    sizes = np.concatenate([np.full(100, 3), np.ones(n - 100, np.int64)])
    held = np.concatenate([np.tile([0, 1, 2], 100), np.zeros(n - 100, np.int64)])
    chunk = lexical.Chunk(pa.array(range(n)), sizes, sizes, held, np.ones(len(held), np.int64), n, int(sizes.sum()), 3)
    docs, scores, seen = chunk.best(np.arange(3), np.array([10, 100, 100]), 1, 50)
    assert seen == 1 and sorted(docs.tolist()) == list(range(100)) and len(set(scores.tolist())) == 1
