"""Byte-level BPE with content-defined chunk reuse.

A rolling hash cuts texts into chunks. Chunks that documents share are encoded once,
by the document with the smallest id that holds them; every other chunk belongs to one
document and is encoded where its text is. Tokens next to a chunk join may differ from
those of the whole text, so the joins are repaired: both sides are cut back to a place
where the tokens must break, and what lies between is encoded again, until both ends
agree with the tokens the chunks have.

Null text counts as empty. Empty texts have no tokens. Rows may repeat; each gives a row.
Time is linear in the length of a text; a text is held by one task.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import map_batches, map_slices, packed, signed, stored, table, text_hash, texts, utf8
from workload.folders import work_folder

#: Pre-tokens of the vocabulary: fixed value of its format.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 16
CHUNK_BITS = 10


def byte_values() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary of a tokenizer file, whose ids are its merge ranks."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    value = byte_values()
    vocab = spec["model"]["vocab"]
    ranks = {bytes(value[c] for c in t): i for t, i in vocab.items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
    if any(vocab["".join(m)] != 256 + i for i, m in enumerate(merges)):
        raise ValueError("the ids of this vocabulary don't follow its merges")
    return tiktoken.Encoding(
        "byte_bpe", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens=special
    )


def encode(coder: tiktoken.Encoding, raw: bytes) -> np.ndarray:
    return np.asarray(coder.encode_to_numpy(raw.decode("utf-8"), allowed_special="all"), dtype=np.uint32)


def pack(ids: np.ndarray) -> bytes:
    """Ids below 65536 as compressed 16-bit integers, for the shuffles of shared chunks."""
    kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    return kind[-1].encode() + zstandard.compress(ids.astype(kind).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    kind = "<u" + raw[:1].decode()
    return np.frombuffer(zstandard.decompress(raw[1:]), kind).astype(np.uint32)


def cut(raw: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the chunks of a text: where a hash of the last 16 bytes has ``bits`` zero bits."""
    n = len(raw)
    if n <= WINDOW:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    h, span, power = data.astype(np.uint32), 1, np.uint32(0x01000193)
    with np.errstate(over="ignore"):
        while span < WINDOW:
            h = h[:-span] * power + h[span:]
            power, span = power * power, span * 2
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    ends = np.flatnonzero(h == 0) + WINDOW
    ends = ends[ends < n]
    ends = ends[(data[ends] & 0xC0) != 0x80]  # not inside a character
    return [*ends.tolist(), n]


def breaks(raw: bytes) -> np.ndarray:
    """The places where tokens must break, whatever stands around them.

    Tokens break between a visible ASCII character and a space or line feed: white space
    only starts a token or fills one.
    """
    data = np.frombuffer(raw, np.uint8)
    space = (data[1:] == 0x20) | (data[1:] == 0x0A)
    return np.flatnonzero(space & (data[:-1] >= 0x21) & (data[:-1] <= 0x7E)) + 1


def take_last(runs: list[np.ndarray], count: int) -> np.ndarray:
    """Remove the last ``count`` ids from ``runs`` and return them, fewer if there are no more."""
    taken = []
    while count and runs:
        run = runs.pop()
        if len(run) > count:
            runs.append(run[: len(run) - count])
            run = run[len(run) - count :]
        taken.append(run)
        count -= len(run)
    return np.concatenate(taken[::-1]) if taken else np.zeros(0, np.uint32)


def add_piece(
    runs: list[np.ndarray],
    raw: bytes,
    places: np.ndarray,
    span: tuple[int, int],
    ids: np.ndarray,
    code: Callable[[bytes], np.ndarray],
) -> None:
    """Add the ids of the piece ``span`` of ``raw`` to ``runs``, the ids of all before it.

    Only what lies between the breaks ``places`` next to the join is encoded anew; where the
    ids of either side don't agree with that, the next break further out is taken.
    """
    start, end = span
    after = int(np.searchsorted(places, start))
    if not start or start == end or (after < len(places) and places[after] == start):
        runs.append(ids)
        return
    before = after - 1
    while True:
        p = int(places[before]) if before >= 0 else 0
        q = int(places[after]) if after < len(places) and places[after] < end else end
        tail, head = code(raw[p:start]), code(raw[start:q])
        had = take_last(runs, len(tail))
        fits_left, fits_right = np.array_equal(had, tail), np.array_equal(ids[: len(head)], head)
        if fits_left and fits_right:
            runs += [code(raw[p:q]), ids[len(head) :]]
            return
        if p == 0 and q == end:
            runs[:] = [code(raw[:end])]
            return
        runs.append(had)
        before -= not fits_left
        after += not fits_right


def join(
    left: bytes, a: np.ndarray, right: bytes, b: np.ndarray, code: Callable[[bytes], np.ndarray]
) -> np.ndarray:
    """Tokens of ``left + right`` from the tokens of both, encoding anew only around the join."""
    raw, runs = left + right, [a]
    add_piece(runs, raw, breaks(raw), (len(left), len(raw)), b, code)
    return np.concatenate(runs)


def pieces_of(
    raw: bytes, places: np.ndarray, shared: dict[int, np.ndarray]
) -> list[tuple[int, int, np.ndarray | None]]:
    """(start, end, ids) of the pieces that a text is put together from, ids None where not given.

    Neighbours without ids are one piece. So are neighbours that hold no break, even if they
    have ids: every join between them would encode all of them anew.
    """
    ends = cut(raw) if shared else [len(raw)]
    inside = np.searchsorted(places, ends) - np.searchsorted(places, [0, *ends[:-1]], side="right")
    pieces: list[tuple[int, int, np.ndarray | None]] = []
    start, closed = 0, False
    for i, (end, held) in enumerate(zip(ends, inside.tolist())):
        ids = shared.get(i)
        if pieces and ((closed and not held) or (ids is None and pieces[-1][2] is None)):
            pieces[-1] = (pieces[-1][0], end, None)
            closed = closed and not held
        else:
            pieces.append((start, end, ids))
            closed = not held
        start = end
    return pieces


def assemble(raw: bytes, shared: dict[int, np.ndarray], code: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """Tokens of a text, given those of some of its chunks by their place.

    Takes time linear in the text: each join touches its two neighbours only.
    """
    places, runs = breaks(raw), []
    for start, end, ids in pieces_of(raw, places, shared):
        add_piece(runs, raw, places, (start, end), code(raw[start:end]) if ids is None else ids, code)
    return np.concatenate(runs) if runs else np.zeros(0, np.uint32)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, seq, h1, h2): the chunks of all texts by a hash of 128 bits."""

    def make():
        def step(batch):
            ids, th, seq, h1, h2 = [], [], [], [], []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                start, ends = 0, cut(raw)
                mask = (1 << 64) - 1
                for i, end in enumerate(ends):
                    h = xxhash.xxh3_128_intdigest(raw[start:end])
                    h1.append(h >> 64)
                    h2.append(h & mask)
                    seq.append(i)
                    start = end
                ids += [doc_id] * len(ends)
                th += [text_hash(raw)] * len(ends)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(th, pa.int64()),
                    pa.array(seq, pa.int32()),
                    pa.array(signed(h1)),
                    pa.array(signed(h2)),
                ],
                ["doc_id", "th", "seq", "h1", "h2"],
            )

        return step

    return map_slices(texts(docs), make, "doc_id long, th long, seq int, h1 long, h2 long")


def encode_documents(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, n_shared, decoded) of every row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit integers, ``decoded`` is the text that they
    give, and ``n_shared`` counts the chunks whose tokens came from elsewhere.
    """
    chunks = stored(chunk_rows(docs), "chunks", folder)
    # One row for each shared chunk: which row of the table encodes it.
    owner = F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), "th", "seq"))
    first = chunks.groupBy("h1", "h2").agg(owner.alias("o"), F.count(F.lit(1)).alias("n")).where("n > 1")
    duties = (
        first.select("h1", "h2", F.nullif("o.d", F.lit(-(2**63))).alias("doc_id"), "o.th", "o.seq")
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("seq", "h1", "h2")).alias("duties"))
    )
    # The filter holds for every row; both joins below have it, so that they share one shuffle.
    whole = packed(docs).where("th IS NOT NULL")
    rows = with_key(whole).join(with_key(duties).drop("doc_id", "th"), ["key", "th_key"])
    once = map_batches(rows.select("doc_id", "z", "duties"), functools.partial(_encode_duties, tokenizer), DUTY)
    # Not stored: in one plan both joins read the same shuffle of the texts.
    uses = (
        chunks.join(once.dropDuplicates(["h1", "h2"]), ["h1", "h2"])
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.struct("seq", "ids")).alias("shared"))
    )
    rows = with_key(whole).join(with_key(uses).drop("doc_id", "th"), ["key", "th_key"], "left")
    rows = rows.select("doc_id", "z", "shared")
    return map_batches(rows, functools.partial(_encode_rows, tokenizer), ENCODED)


DUTY = "h1 long, h2 long, ids binary"
ENCODED = "doc_id long, ids binary, n_tokens long, n_shared long, decoded string"


def with_key(df: DataFrame) -> DataFrame:
    """Null ids join as well: a key that is never null."""
    return df.withColumns({"key": F.coalesce("doc_id", F.lit(-(2**63))), "th_key": F.col("th")})


def _encode_duties(tokenizer: str, batches):
    coder, unpress = encoding(tokenizer), zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            raw = unpress.decompress(batch.column("z")[i].as_py())
            ends = cut(raw)
            h1, h2, ids = [], [], []
            for duty in batch.column("duties")[i].as_py():
                start = ends[duty["seq"] - 1] if duty["seq"] else 0
                h1.append(duty["h1"])
                h2.append(duty["h2"])
                ids.append(pack(encode(coder, raw[start : ends[duty["seq"]]])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(ids, pa.binary())],
                ["h1", "h2", "ids"],
            )


def _encode_rows(tokenizer: str, batches):
    coder, unpress = encoding(tokenizer), zstandard.ZstdDecompressor()
    code = functools.partial(encode, coder)
    for batch in batches:
        out, size = [], 0
        for i in range(batch.num_rows):
            raw = unpress.decompress(batch.column("z")[i].as_py())
            given = batch.column("shared")[i].as_py() or []
            shared = {x["seq"]: unpack(x["ids"]) for x in given}
            ids = assemble(raw, shared, code)
            back = coder.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")
            out.append((batch.column("doc_id")[i].as_py(), ids.tobytes(), len(ids), len(shared), back))
            size += len(raw)
            if size > 4_000_000:
                yield _encoded_batch(out)
                out, size = [], 0
        if out:
            yield _encoded_batch(out)


def _encoded_batch(rows):
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
    names = ["doc_id", "ids", "n_tokens", "n_shared", "decoded"]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return encode_documents(docs, path, work_folder(spark)).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "n_shared",
    )


QUERIES = {"op7_chunk_bpe": query}
ORACLES = {}
