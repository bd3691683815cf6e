"""Token ids of documents as wavelet matrices, one compressed file image per shard.

Documents are sorted by id across the cluster, encoded, and packed into shards of a
bounded number of tokens. A shard holds the bit planes of its ids, highest bit first, each
plane in the order that the planes above it give, with counts of set bits for rank and
select. One image answers which token stands at a place, how often a token occurs up to a
place, and where it occurs, without the other shards.

Images are rows of a Parquet table: part and seq in order of doc_id, the ids and lengths of
the documents, and the image. Null text counts as empty, and an empty document is its end
token alone. Rows with a null id come first; rows that repeat an id are neighbours.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotwise.llm.chunk_bpe import byte_values
from lotwise.llm.common import Stretch, map_batches, slices, table, texts
from lotwise.session import shared_path
from workload.folders import work_folder

SHARD_TOKENS = 1 << 22
COUNT_EVERY = 512
END_ID = 1
#: A task keeps the ids of so many words; beyond that it starts anew.
KNOWN_WORDS = 400_000

#: Words for which splitting and lower case need no more than these rules: ASCII and
#: precomposed Latin letters. All other words go through the tokenizer itself.
SIMPLE = regex.compile(r"[\x21-\x7eÀ-įı-ſ]+")
#: Pieces of a word in this vocabulary: fixed value of its format.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordCoder:
    """Ids of texts under a vocabulary with word ends, where white space only separates.

    Each distinct word is encoded once for as long as a bounded store keeps it. Line feed stands for the end of a word,
    which no word can hold, so that the merges become those of a plain byte vocabulary.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {x["content"] for x in spec["added_tokens"]}
        self.special = sorted(special)
        value, suffix = byte_values(), spec["model"]["end_of_word_suffix"]
        ranks = {}
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                ends = token.endswith(suffix) and token != suffix
                stem = token[: -len(suffix)] if ends else token
                ranks[bytes(value[c] for c in stem) + (b"\n" if ends else b"")] = i
        self.coder = tiktoken.Encoding(
            "words", pat_str=r"[^\n\r]*\n", mergeable_ranks=ranks, special_tokens={}
        )
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for raw, i in ranks.items() if raw.endswith(b"\n") and raw != b"\n"]] = True
        self.index: dict[str, int] = {}
        self.store = Stretch()

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and where each word's ids begin."""
        simple = [
            bool(SIMPLE.fullmatch(w)) and not any(s in w for s in self.special) for w in words
        ]
        plain = [w for w, ok in zip(words, simple) if ok]
        flat, sizes = self._plain(plain)
        if len(plain) == len(words):
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        rest = [w for w, ok in zip(words, simple) if not ok]
        other = [e.ids for e in self.tokenizer.encode_batch(rest, add_special_tokens=False)]
        all_sizes = np.zeros(len(words), np.int64)
        where = np.array(simple, bool)
        all_sizes[where], all_sizes[~where] = sizes, [len(x) for x in other]
        begins = np.concatenate([[0], np.cumsum(all_sizes)])
        out = np.zeros(begins[-1], np.uint32)
        out[np.repeat(where, all_sizes)] = flat
        out[~np.repeat(where, all_sizes)] = np.array([i for x in other for i in x], np.uint32)
        return out, begins

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        line = PIECES.sub(r"\g<0>\n", "\r".join(words).lower() + "\r")
        ids = np.asarray(self.coder.encode_to_numpy(line), np.uint32)
        marks = np.frombuffer(line.encode("utf-8"), np.uint8)
        marks = marks[(marks == 10) | (marks == 13)]
        pieces = np.cumsum(marks == 10)[marks == 13]  # of all words up to each
        done = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])  # tokens up to each piece
        return ids, np.diff(np.concatenate([[0], done[pieces]]))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(column.cast(pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        codes = coded.indices.to_numpy()
        flat, sizes = self.known_words(coded.dictionary.to_pylist(), codes)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return flat.astype(np.uint32), np.diff(upto[edges])

    def known_words(self, words: list[str], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that ``codes`` names, in a row, and the size of each.

        Words of earlier batches of a task are taken from a store, up to a bound.
        """
        if len(self.index) + len(words) > KNOWN_WORDS:
            self.index, self.store = {}, Stretch()
        places = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            places[missing] = len(self.index) + np.arange(len(new))
            self.index.update(zip(new, places[missing].tolist()))
            flat, begins = self.words(new)
            self.store.add(flat.astype(np.int32), np.diff(begins))
        return self.store.runs(places[codes])


@functools.lru_cache(maxsize=2)
def coder_of(path: str) -> WordCoder:
    return WordCoder(path)


class WaveletMatrix:
    """Bit planes of a sequence of ids; see the module text."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int]):
        self.size, self.planes, self.zeros = size, planes, zeros
        self.counts: list[np.ndarray] | None = None

    @classmethod
    def of(cls, ids: np.ndarray, width: int = 16) -> WaveletMatrix:
        planes, zeros = [], []
        for level in range(width - 1, -1, -1):
            bits = (ids >> level).astype(np.uint8) & 1
            ones = bits.view(bool)
            low = ids[~ones]
            planes.append(np.packbits(bits))
            zeros.append(len(low))
            ids = np.concatenate([low, ids[ones]])
        return cls(int(len(ids)), planes, zeros)

    def to_bytes(self) -> bytes:
        press = zstandard.ZstdCompressor(level=1)
        parts = []
        for plane, counts in zip(self.planes, self._counts()):
            parts += [press.compress(plane.tobytes()), press.compress(counts.astype("<u4").tobytes())]
        head = json.dumps({"n": self.size, "zeros": self.zeros, "sizes": [len(x) for x in parts]}).encode()
        return b"".join([b"WMX1", len(head).to_bytes(4, "little"), head, *parts])

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        if raw[:4] != b"WMX1":
            raise ValueError("not a wavelet matrix")
        at = 8 + int.from_bytes(raw[4:8], "little")
        head = json.loads(raw[8:at])
        unpress, parts = zstandard.ZstdDecompressor(), []
        for size in head["sizes"]:
            parts.append(unpress.decompress(raw[at : at + size]))
            at += size
        made = cls(head["n"], [np.frombuffer(x, np.uint8) for x in parts[::2]], head["zeros"])
        made.counts = [np.frombuffer(x, "<u4") for x in parts[1::2]]
        return made

    def _counts(self) -> list[np.ndarray]:
        """Set bits of each plane before every ``COUNT_EVERY``-th place."""
        if self.counts is None:
            self.counts = []
            for plane in self.planes:
                padded = np.pad(plane, (0, -len(plane) % (COUNT_EVERY // 8)))
                ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, COUNT_EVERY // 64)
                self.counts.append(np.concatenate([[0], np.cumsum(ones.sum(axis=1))]).astype(np.uint32))
        return self.counts

    def _ones(self, level: int, at: int) -> int:
        """Set bits of a plane before a place."""
        block = at // COUNT_EVERY
        bits = np.unpackbits(self.planes[level][block * (COUNT_EVERY // 8) : (at + 7) // 8])
        return int(self._counts()[level][block]) + int(bits[: at - block * COUNT_EVERY].sum())

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the ``k``-th bit of this value in a plane, from 0."""
        counts = self._counts()[level].astype(np.int64)
        if not bit:
            counts = np.minimum(np.arange(len(counts)) * COUNT_EVERY, self.size) - counts
        block = int(np.searchsorted(counts, k, side="right")) - 1
        step = COUNT_EVERY // 8
        bits = np.unpackbits(self.planes[level][block * step : (block + 1) * step])
        bits = bits[: self.size - block * COUNT_EVERY]
        return block * COUNT_EVERY + int(np.flatnonzero(bits == bit)[k - int(counts[block])])

    def access(self, at: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = int(self.planes[level][at // 8] >> (7 - at % 8)) & 1
            ones = self._ones(level, at)
            at = zeros + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before ``end`` stand below the last plane."""
        a, width = 0, len(self.zeros)
        if token >> width:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            p, q = self._ones(level, a), self._ones(level, end)
            a, end = (zeros + p, zeros + q) if token >> (width - 1 - level) & 1 else (a - p, end - q)
        return a, end

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of a token before a place."""
        a, b = self._range(token, self.size if end is None else end)
        return b - a

    def find(self, token: int) -> list[int]:
        """All places of a token, ascending."""
        a, b = self._range(token, self.size)
        return [self._place(token, k) for k in range(a, b)]

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th occurrence of a token, from 0."""
        a, b = self._range(token, self.size)
        if not 0 <= k < b - a:
            raise IndexError(k)
        return self._place(token, a + k)

    def _place(self, token: int, at: int) -> int:
        width = len(self.zeros)
        for level in range(width - 1, -1, -1):
            bit = token >> (width - 1 - level) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """The whole sequence."""
        values = np.zeros(self.size, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.size).view(bool)
            above = np.empty_like(values)
            above[~ones] = values[: self.zeros[level]]
            above[ones] = values[self.zeros[level] :] | (1 << (len(self.zeros) - 1 - level))
            values = above
        return values


SHARD = "part int, seq int, doc_ids array<long>, sizes array<long>, n_tokens long, matrix binary"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode every text, add the end id, and write the shards in ascending order of doc_id."""
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    rows = rows.repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("th"))
    rows = rows.sortWithinPartitions(F.asc_nulls_first("doc_id"), "th").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = coder_of(tokenizer), TaskContext.get().partitionId()
        held, sizes, ids, seq = 0, [], [], 0
        parts: list[np.ndarray] = []

        def shard():
            matrix = WaveletMatrix.of(np.concatenate(parts))
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            values = [part, seq, ids, sizes, matrix.size, matrix.to_bytes()]
            names = ["part", "seq", "doc_ids", "sizes", "n_tokens", "matrix"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for piece in slices(batch):
                flat, lengths = coder.encode(piece.column("text"))
                if end_id is not None:
                    flat = np.insert(flat, np.cumsum(lengths), end_id)
                    lengths = lengths + 1
                edges = np.concatenate([[0], np.cumsum(lengths)])
                if len(flat) and flat.max() >= 1 << 16:
                    raise ValueError("shards hold ids below 65536")
                flat = flat.astype(np.uint16)
                for i, doc_id in enumerate(piece.column("doc_id").to_pylist()):
                    parts.append(flat[edges[i] : edges[i + 1]])
                    ids.append(doc_id)
                    sizes.append(int(lengths[i]))
                    held += int(lengths[i])
                    if held >= shard_tokens:
                        yield shard()
                        held, sizes, ids, seq, parts = 0, [], [], seq + 1, []
        if ids:
            yield shard()

    shards = map_batches(rows, encode, SHARD)
    shards.write.option("compression", "uncompressed").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_bases(shards: DataFrame) -> DataFrame:
    """(part, seq, base): tokens in all shards before each.

    The windows run over one row per part, then over the shards of each part.
    """
    sizes = shards.select("part", "seq", "n_tokens")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    total = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = total.select(
        "part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_base")
    )
    own = F.sum("n_tokens").over(before.partitionBy("part").orderBy("seq"))
    return (
        sizes.join(parts, "part")
        .withColumn("base", F.col("part_base") + F.coalesce(own, F.lit(0)))
        .select("part", "seq", "base")
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, doc_id, place, n_tokens, ids): documents from the shards.

    ``place`` is where a document begins in its shard; ids are little-endian 32-bit integers.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                flat = WaveletMatrix.from_bytes(row["matrix"].as_py()).ids().astype("<u4")
                sizes = row["sizes"].values.to_numpy()
                edges = np.concatenate([[0], np.cumsum(sizes)])
                n = len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, row["part"].as_py(), np.int32)),
                        pa.array(np.full(n, row["seq"].as_py(), np.int32)),
                        row["doc_ids"].values,
                        pa.array(edges[:-1]),
                        pa.array(sizes),
                        pa.array([flat[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    ["part", "seq", "doc_id", "place", "n_tokens", "ids"],
                )

    schema = "part int, seq int, doc_id long, place long, n_tokens long, ids binary"
    return map_batches(read_shards(spark, path), decode, schema)


def with_starts(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """Add ``start``, the tokens of all documents before: a join on the shard, so drop ids first."""
    return docs.join(shard_bases(shards), ["part", "seq"]).withColumn(
        "start", F.col("base") + F.col("place")
    )


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, seq, n): occurrences of a token in each shard, by rank alone."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [WaveletMatrix.from_bytes(x.as_py()).rank(token) for x in batch.column("matrix")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("seq"), pa.array(n, pa.int64())], ["part", "seq", "n"]
            )

    return map_batches(read_shards(spark, path), count, "part int, seq int, n long")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, place): every occurrence of a token, by select alone."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = np.array(WaveletMatrix.from_bytes(batch.column("matrix")[i].as_py()).find(token), np.int64)
                edges = np.cumsum(batch.column("sizes")[i].values.to_numpy())
                own = np.searchsorted(edges, found, side="right")
                begins = np.concatenate([[0], edges])[own]
                ids = batch.column("doc_ids")[i].values.take(pa.array(own))
                yield pa.RecordBatch.from_arrays([ids, pa.array(found - begins)], ["doc_id", "place"])

    return map_batches(read_shards(spark, path), find, "doc_id long, place long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens", work_folder(spark))
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    digests = read_tokens(spark, path).select(
        "part", "seq", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    starts = with_starts(digests, read_shards(spark, path))
    return starts.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op1_wavelet_tokens": query}
ORACLES = {}
