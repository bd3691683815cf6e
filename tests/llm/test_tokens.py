"""Token stores and BPE with chunk reuse against the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lotwise.llm import chunk_bpe, wavelet

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = list("abAB zZ  \n\t'sS.,!12éÉßİŁſΣς  ́eẞ漢字\r") + ["<|endoftext|>", "'ll", "<|endof", "   "]


def odd_texts(n, length, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, length))) for _ in range(n)]


def table(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with those the operators use."""
    made = [(i, t, "x", 1, b"z") for i, t in rows]
    return spark.createDataFrame(made, "doc_id long, text string, th string, seq int, z binary")


def test_words_are_encoded_as_in_the_library():
    library, texts = Tokenizer.from_file(WORDS), odd_texts(1500, 40) + ["", "  "]
    flat, sizes = wavelet.WordCoder(WORDS).encode(pa.array(texts))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert flat[edges[i] : edges[i + 1]].tolist() == want, text


def test_wavelet_matrix_answers():
    ids = np.random.default_rng(1).integers(0, 49000, 3000).astype(np.uint16)
    ids[::7] = 5
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids).to_bytes())
    places = np.flatnonzero(ids == 5)
    assert (matrix.ids() == ids).all()
    assert all(matrix.access(i) == ids[i] for i in range(0, 3000, 31))
    assert matrix.find(5) == places.tolist() and matrix.select(5, 9) == places[9]
    assert matrix.rank(5, 1234) == (ids[:1234] == 5).sum()
    assert matrix.rank(70000) == 0 and matrix.find(48999 + 1) == []
    with pytest.raises(IndexError):
        matrix.select(5, len(places))


def test_token_store_in_small_shards(spark, tmp_path):
    texts = [(i, t) for i, t in enumerate(odd_texts(60, 50))] + [(None, "first"), (7, "again"), (90, None)]
    path = str(tmp_path / "tokens")
    wavelet.write_tokens(table(spark, texts), path, WORDS, shard_tokens=100)
    docs = wavelet.with_starts(wavelet.read_tokens(spark, path), wavelet.read_shards(spark, path)).collect()
    library = Tokenizer.from_file(WORDS)
    want = {(i, tuple(library.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in texts}
    assert {(d.doc_id, tuple(np.frombuffer(d.ids, "<u4").tolist())) for d in docs} == want
    ordered = sorted(docs, key=lambda d: d.start)
    keys = [-1 if d.doc_id is None else d.doc_id for d in ordered]
    assert keys == sorted(keys) and len(docs) == len(texts)
    assert [d.start for d in ordered] == np.cumsum([0, *[d.n_tokens for d in ordered]])[:-1].tolist()
    token = ordered[5].ids[:4]
    token = int.from_bytes(token, "little")
    n = sum(np.frombuffer(d.ids, "<u4").tolist().count(token) for d in docs)
    assert wavelet.count_token(spark, path, token).agg({"n": "sum"}).first()[0] == n
    assert wavelet.find_token(spark, path, token).count() == n
    assert wavelet.read_shards(spark, path).count() > 3


def test_token_query_crc(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in wavelet.query(spark, sf_dir).collect()}
    library, start = Tokenizer.from_file(WORDS), 0
    for row in sorted(rows):
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [1]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert tuple(got[row.doc_id])[1:] == (start, len(ids), crc)
        start += len(ids)


def test_joins_are_repaired():
    library, coder = Tokenizer.from_file(BYTES), chunk_bpe.encoding(BYTES)
    code = lambda raw: chunk_bpe.encode(coder, raw)
    rng = random.Random(2)
    for text in odd_texts(400, 60, 3) + ["x" * 50, "no-space" * 20, ""]:
        raw, want = text.encode(), library.encode(text, add_special_tokens=False).ids
        assert code(raw).tolist() == want
        if len(text) > 1:
            at = len(text[: rng.randrange(1, len(text))].encode())
            a, b = raw[:at], raw[at:]
            assert chunk_bpe.join(a, code(a), b, code(b), code).tolist() == want, text


def test_chunks_are_cut_by_content():
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefgh éß") for _ in range(20000)).encode()
    cut = {body[a:b] for a, b in zip([0, *chunk_bpe.cut(body)], chunk_bpe.cut(body))}
    moved = b"inserted " + body
    again = {moved[a:b] for a, b in zip([0, *chunk_bpe.cut(moved)], chunk_bpe.cut(moved))}
    assert len(cut) > 10 and len(cut & again) >= len(cut) - 2
    assert all(x.decode() for x in cut)


def test_encoding_with_shared_chunks(spark, tmp_path):
    rng = random.Random(5)
    body = " ".join("".join(rng.choice("abcdeé<|") for _ in range(6)) for _ in range(3000))
    texts = [(1, body), (2, "x " + body), (3, body), (3, body), (None, body[:9000]), (4, None), (5, "")]
    texts += [(10 + i, t) for i, t in enumerate(odd_texts(40, 80, 6))]
    got = chunk_bpe.encode_documents(table(spark, texts), BYTES, str(tmp_path)).collect()
    library = Tokenizer.from_file(BYTES)
    want = [(i, tuple(library.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in texts]
    found = [(r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded) for r in got]
    assert sorted(found, key=str) == sorted(want, key=str)
    assert sum(r.n_shared for r in got) > 20


def counted(code):
    """``code`` and the bytes it has encoded so far."""
    seen = [0]

    def run(raw):
        seen[0] += len(raw)
        return code(raw)

    return run, seen


@pytest.mark.parametrize("kind", ["words", "漢字仮名交じり文é", "x\n\n", "a  b\t", "ab12"])
def test_long_texts_are_put_together_in_linear_time(kind):
    rng = random.Random(8)
    library, coder = Tokenizer.from_file(BYTES), chunk_bpe.encoding(BYTES)
    plain = lambda raw: chunk_bpe.encode(coder, raw)
    if kind == "words":
        known = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]
        text = " ".join(rng.choices(known, k=400_000))
    else:
        text = "".join(rng.choices(kind, k=100_000))
    raw = text.encode()
    ends = chunk_bpe.cut(raw)
    for share in (0.5, 1.0):
        given = {i: plain(raw[a:b]) for i, (a, b) in enumerate(zip([0, *ends], ends)) if rng.random() < share}
        code, seen = counted(plain)
        got = chunk_bpe.assemble(raw, given, code)
        assert got.tolist() == library.encode(text, add_special_tokens=False).ids
        assert seen[0] <= 4 * len(raw)


def test_empty_tables(spark, tmp_path):
    empty = table(spark, []).limit(0)
    assert chunk_bpe.encode_documents(empty, BYTES, str(tmp_path)).count() == 0
    wavelet.write_tokens(empty, str(tmp_path / "none"), WORDS)
    assert wavelet.read_tokens(spark, str(tmp_path / "none")).count() == 0
