"""Alignment of two tokenizers against the libraries and plain loops."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lotwise.llm import align
from lotwise.llm.chunk_bpe import byte_values

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "plain words, and some more words.",
    "plain words, and some more words.",
    None,
    "",
    " ",
    "  two  spaces  everywhere ",
    "line\n breaks \n\tand tabs\r\n here  too　 x",
    "ñandú Öl ①② ﬁne é 日本語 中文 🙂🙂 \u0000 zero",
    "a mark ▁ that the second can't give back",
    "<|endoftext|> and <s> </s> <0x41> are plain",
    "it's we'll I'd 'quoted' 123 4567 ...!!!",
    "x" * 300,
    "\x1c \x1d  odd\x85 spaces  end",
    "abc " * 30_000 + "  tail",
]


def plain(texts):
    """(n_a, n_b, groups, links) per text, by the libraries and sets of ends."""
    a_coder = Tokenizer.from_file(A_PATH)
    a_coder.encode_special_tokens = True
    b_coder = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    value = byte_values()
    out = []
    for text in texts:
        whole = (" " + (text or "")).encode()
        found = a_coder.encode(" " + (text or ""), add_special_tokens=False)
        a = [(i, bytes(value[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        b = []
        for i in b_coder.encode(text or ""):
            name = b_coder.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if b_coder.is_byte(i) else name.replace("▁", " ").encode()))
        if not text or any(b"".join(raw for _, raw in side) != whole for side in (a, b)):
            out.append(([], [], "", []))
            continue
        ends = [np.cumsum([len(raw) for _, raw in side]).tolist() for side in (a, b)]
        groups, links, x, y = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            u, v = ends[0].index(cut, x) + 1, ends[1].index(cut, y) + 1
            groups.append(",".join(str(a[i][0]) for i in range(x, u)) + "|" + ",".join(str(b[i][0]) for i in range(y, v)))
            for i in range(x, u):
                for j in range(y, v):
                    if ends[0][i] - len(a[i][1]) < ends[1][j] and ends[1][j] - len(b[j][1]) < ends[0][i]:
                        links.append((a[i][0], b[j][0]))
            x, y = u, v
        out.append(([i for i, _ in a], [i for i, _ in b], ";".join(groups), links))
    return out


def expected(rows):
    made = plain([text for _, text in rows])
    counts = Counter(link for *_, links in made for link in links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (
                -1 if doc_id is None else doc_id,
                len(a),
                len(b),
                groups.count(";") + 1 if groups else 0,
                len(links),
                sum(counts[x] == most[x[1]] for x in links),
                sum(counts[x] for x in links),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for (doc_id, _), (a, b, groups, links) in zip(rows, made)
        )
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def scored(spark, rows, schema="doc_id long, text string"):
    made = align.link_scores(spark.createDataFrame(rows, schema), A_PATH, B_PATH)
    assert set(COLUMNS) <= set(made.columns)
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in made.select(*COLUMNS).collect())


def test_scores_equal_the_libraries(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "repeated row"), (3, "repeated row"), (None, "no id")]
    assert scored(spark, rows) == expected(rows)


def test_documents_equal_the_libraries(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    made = align.op11_token_alignment(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, made)) == expected(rows)


def test_clashing_columns_and_empty_table(spark):
    rows = [(7, "some text", 1, "x", 2)]
    made = scored(spark, rows, "doc_id int, text string, part int, links string, count int")
    assert made == expected([(7, "some text")])
    assert scored(spark, []) == []


def test_alignments_hold_ids_and_groups(spark):
    row = align.alignments(spark.createDataFrame([(1, TEXTS[7]), (2, None)], "doc_id long, text string"), A_PATH, B_PATH)
    first, second = sorted(row.collect())
    a, b, groups, _ = plain([TEXTS[7]])[0]
    assert (first.a, first.b) == (a, b)
    assert [x.count(",") + 1 for g in groups.split(";") for x in g.split("|")] == [
        n for pair in zip(first.group_a, first.group_b) for n in pair
    ]
    assert (second.a, second.b, second.group_a, second.group_b) == ([], [], [], [])


def test_store_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(align, "KNOWN_WORDS", 5)
    coders = align.BothCoders(A_PATH, B_PATH)
    for text in ("one two three four", "five six one two", "seven eight nine ten eleven twelve"):
        a, n_a, b, n_b = coders.encode(pa.array([text]))
        want = plain([text])[0]
        assert (a.tolist(), b.tolist()) == (want[0], want[1])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 90)), max_size=5))
def test_shared_cuts_are_the_common_ends(texts):
    ends_a, ends_b, roots, base = [], [], [], 0
    for a, b, last in texts:
        ends_a += [base + x for x in sorted(a | {last})]
        ends_b += [base + x for x in sorted(b | {last})]
        roots.append(len(ends_a) - 1)
        base += last
    ends_a, ends_b = np.array(ends_a, np.int64), np.array(ends_b, np.int64)
    cuts = align.shared_cuts(ends_a, ends_b, np.array(roots, np.int64))
    assert ends_a[cuts].tolist() == np.intersect1d(ends_a, ends_b).tolist()


def test_long_stretch_without_a_cut():
    ends_a, ends_b = np.arange(2, 400_002, 2), np.concatenate([np.arange(1, 400_000, 2), [400_000]])
    assert align.shared_cuts(ends_a, ends_b, np.array([199_999])).tolist() == [199_999]


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_spelt_groups(text):
    made = align.Aligned(pa.array([text, None, text]), A_PATH, B_PATH)
    want = plain([text])[0][2].encode()
    assert made.spelt() == [want, b"", want]
