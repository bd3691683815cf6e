"""Alignment of two tokenizers over the same bytes: groups, links and link counts.

Both tokenizers cut the bytes of a space and the text. Places where a token of each ends are
shared cuts. They are found by divide and conquer: the end nearest the middle of an interval
that both share is located by bisection, both halves go on, and an interval without a cut
inside is a group. All intervals of a slice of texts are divided together, level by level.
A link is a pair of tokens whose bytes overlap, and every link lies within a group.

How often two ids are linked in the whole corpus is counted per slice first; a slice hands out
each of its different pairs once and gets their counts back, so what is shuffled is the
pairs of slices and not the links of documents. Links wait as sorted, compressed pair numbers.

Null and empty texts have no tokens, nor have texts whose bytes a tokenizer doesn't give back.
A long text is a slice of its own. Rows may repeat or lack an id: each gives a row and counts.
Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.chunk_bpe import byte_values, encoding
from lotwise.llm.common import Stretch, map_batches, map_slices, slices, stored, table, texts
from workload.folders import work_folder

#: Pairs of a slice travel in rows of at most so many.
PAIR_ROWS = 4096

#: A task keeps the ids of so many words; beyond that it starts anew.
KNOWN_WORDS = 400_000
#: Texts that are empty, or where a space doesn't stand between a visible character and another
#: one: white space of either library's definition, fixed values.
ODD_SPACES = r"^$|^ | $|[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] "


class ByteTokens:
    """Ids of a byte-level vocabulary; strings of special tokens are plain text."""

    def __init__(self, path: str):
        self.coder: tiktoken.Encoding = encoding(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        value = byte_values()
        special = {x["content"] for x in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes(value[c] for c in token)
        self.sizes = np.array([len(x) for x in self.bytes], np.int32)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a space and the text."""
        return np.asarray(self.coder.encode_to_numpy(" " + text, disallowed_special=()), np.int32)


class PieceTokens:
    """Ids of a piece vocabulary that marks spaces and puts one before each text."""

    def __init__(self, path: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:-1], 16)])
            if self.pieces.is_byte(i)
            else name.replace("▁", " ").encode("utf-8")
            for i, name in enumerate(names)
        ]
        self.sizes = np.array([len(x) for x in self.bytes], np.int32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1) if texts else []

    def gives(self, ids: list[int], text: str) -> bool:
        """Whether the bytes of the tokens are those of a space and the text."""
        return b"".join(map(self.bytes.__getitem__, ids)) == b" " + text.encode("utf-8")


class BothCoders:
    """Ids of texts under both tokenizers.

    Tokens of either break before a space that follows a visible character. In a text whose
    spaces all stand so, words are encoded on their own, each different one once for as
    long as a bounded store keeps it. Other texts are encoded whole.
    """

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        if any(" " in x.lstrip(b" ").decode("utf-8", "replace") for x in self.b.bytes):
            raise ValueError("a piece of this vocabulary holds a space after another character")
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.of_a, self.of_b, self.right = Stretch(), Stretch(), np.zeros(0, bool)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the store has each word; new ones are added."""
        if len(self.index) + len(words) > KNOWN_WORDS:
            self._forget()
        places = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            places[missing] = len(self.index) + np.arange(len(new))
            self.index.update(zip(new, places[missing].tolist()))
            ids = self.a.encode(" ".join(new))
            upto = np.searchsorted(np.cumsum(self.a.sizes[ids]), np.cumsum([1 + len(w.encode("utf-8")) for w in new]))
            self.of_a.add(ids, np.diff(upto + 1, prepend=0))
            made = self.b.encode(new)
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            self.of_b.add(np.fromiter(chain.from_iterable(made), np.int32, sizes.sum()), sizes)
            right = np.fromiter(map(self.b.gives, made, new), bool, len(new))
            self.right = np.concatenate([self.right, right])
        return places

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row and how many each has, for either tokenizer.

        Texts whose bytes don't come back have none.
        """
        by_word = ~pc.match_substring_regex(column, ODD_SPACES).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(column.filter(pa.array(by_word)).cast(pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        which = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        wrong = np.concatenate([[0], np.cumsum(~self.right[which])])
        right = np.diff(wrong[edges]) == 0
        which = which[np.repeat(right, np.diff(edges))]
        edges = np.concatenate([[0], np.cumsum(np.where(right, np.diff(edges), 0))])
        whole = column.filter(pa.array(~by_word)).to_pylist()
        pieces = [
            x if self.b.gives(x, text) else [] for x, text in zip(self.b.encode(whole), whole)
        ]
        bytewise = [self.a.encode(text) if x else [] for x, text in zip(pieces, whole)]
        out = []
        for store, others in ((self.of_a, bytewise), (self.of_b, pieces)):
            flat, sizes = store.runs(which)
            n = np.zeros(len(column), np.int64)
            n[by_word] = np.diff(np.concatenate([[0], np.cumsum(sizes)])[edges])
            n[~by_word] = [len(x) for x in others]
            if whole:
                both, here = np.zeros(n.sum(), np.int32), np.repeat(by_word, n)
                both[here], both[~here] = flat, np.concatenate([np.asarray(x, np.int32) for x in others])
                flat = both
            out += [flat, n]
        return tuple(out)


@functools.lru_cache(maxsize=2)
def both_coders(a_path: str, b_path: str) -> BothCoders:
    return BothCoders(a_path, b_path)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` of all ends that ``ends_b`` has too.

    Both are increasing byte offsets. ``roots`` are the places in ``ends_a`` of the last token of
    each text, which are shared. An interval holds the tokens from ``low`` to ``high``; ends
    around its middle are tried in rings of doubling width until one is shared or none is left.
    """
    shared = np.zeros(int(ends_a.max(initial=0)) + 1, bool)
    shared[ends_b] = True
    ends_a = ends_a.astype(np.int32 if len(shared) < 1 << 30 else np.int64)
    roots = roots.astype(ends_a.dtype)
    begins = np.concatenate([ends_a[:0], [0], ends_a]).astype(ends_a.dtype)
    is_cut = shared[ends_a]  # of an end, once it has been tried
    found, high = [roots], roots
    low = np.concatenate([roots[:0], [0], roots[:-1] + 1]).astype(roots.dtype) if len(roots) else roots
    while True:
        more = np.flatnonzero(low < high)
        if not len(more):
            return np.sort(np.concatenate(found)).astype(np.int64)
        low, high = low[more], high[more]
        middle = np.searchsorted(ends_a, begins[low] + ((ends_a[high] - begins[low]) >> 1)).astype(low.dtype)
        middle = np.minimum(middle, high - 1)
        cut = np.where(is_cut[middle], middle, -1).astype(low.dtype)
        open_, near = np.flatnonzero((cut < 0) & (high - low > 1)), 1
        while len(open_):
            mid, lo, hi, far = middle[open_], low[open_], high[open_] - 1, 2 * near
            first = np.concatenate([np.maximum(mid - far + 1, lo), mid + near])
            last = np.concatenate([mid - near, np.minimum(mid + far - 1, hi)])
            n = np.maximum(last - first + 1, 0).astype(np.int64)
            upto = np.cumsum(n)
            tried = np.arange(upto[-1]) + np.repeat(first - upto + n, n)
            hit = np.flatnonzero(is_cut[tried])
            if len(hit):
                owner = np.searchsorted(upto, hit, side="right") % len(open_)
                tried = tried[hit]
                order = np.lexsort((np.abs(tried - mid[owner]), owner))
                owner, tried = owner[order], tried[order]
                nearest = np.flatnonzero(np.diff(owner, prepend=-1))
                cut[open_[owner[nearest]]] = tried[nearest]
            open_ = open_[(cut[open_] < 0) & ((mid - far >= lo) | (mid + far <= hi))]
            near = far
        halved = np.flatnonzero(cut >= 0)
        cut, low, high = cut[halved], low[halved], high[halved]
        found.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut, high])


class Aligned:
    """The alignment of a slice of texts; arrays run over all its texts that have tokens."""

    def __init__(self, column: pa.Array, a_path: str, b_path: str):
        coders = both_coders(a_path, b_path)
        column = pc.fill_null(column.cast(pa.string()), "")
        self.a, self.n_a, self.b, self.n_b = coders.encode(column)
        self.ends_a = np.cumsum(coders.a.sizes[self.a], dtype=np.int64)
        self.ends_b = np.cumsum(coders.b.sizes[self.b], dtype=np.int64)
        last = np.cumsum(self.n_a[self.n_a > 0]) - 1
        #: places in ``a`` and ``b`` of the last token of each group
        self.cuts_a = shared_cuts(self.ends_a, self.ends_b, last)
        self.cuts_b = np.searchsorted(self.ends_b, self.ends_a[self.cuts_a])
        self.n_groups = np.diff(np.searchsorted(self.cuts_a, np.cumsum([0, *self.n_a])))

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b`` of all links, and how many each text has.

        The ends of both sides cut a group into pieces; each piece belongs to one link.
        """
        size = int(self.ends_a.max(initial=0)) + 1
        of_a, of_b = np.zeros(size, bool), np.zeros(size, bool)
        of_a[self.ends_a], of_b[self.ends_b] = True, True
        ends = np.flatnonzero(of_a | of_b)
        of_a, of_b = of_a[ends], of_b[ends]
        return np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b, self.n_a + self.n_b - self.n_groups

    def spelt(self) -> list[bytes]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        a_ends, b_ends = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        a_ends[self.cuts_a], b_ends[self.cuts_b] = True, True
        group_a, group_b = np.cumsum(a_ends) - a_ends, np.cumsum(b_ends) - b_ends
        b_upto, a_upto = np.concatenate([[-1], self.cuts_b]) + 1, self.cuts_a + 1
        codes = np.zeros(len(self.a) + len(self.b), np.int32)
        codes[np.arange(len(self.a)) + b_upto[group_a]] = self.a * 3 + a_ends
        codes[np.arange(len(self.b)) + a_upto[group_b]] = self.b * 3 + 2 * b_ends
        words, sizes = _spellings(int(codes.max(initial=0)) // 3 + 1)
        line = words[codes].tobytes().replace(b"\0", b"")
        upto = np.concatenate([[0], np.cumsum(sizes[codes])])
        edges = upto[np.cumsum([0, *(self.n_a + self.n_b)])].tolist()
        return [line[x:y][:-1] for x, y in zip(edges, edges[1:])]


@functools.lru_cache(maxsize=4)
def _spellings(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id with each mark behind it, filled up with zero bytes, and the sizes without."""
    words = [str(i).encode() + mark for i in range(n) for mark in (b",", b"|", b";")]
    return np.array(words, "S"), np.array([len(w) for w in words])


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document its ids under both tokenizers and, per group, how many of each it has."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = Aligned(batch.column("text"), a_path, b_path)
            sizes = [np.diff(np.concatenate([[-1], x])) for x in (made.cuts_a, made.cuts_b)]
            lists = [(made.a, made.n_a), (made.b, made.n_b), *((x, made.n_groups) for x in sizes)]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(
                        pa.ListArray.from_arrays(np.cumsum([0, *n]).astype(np.int32), x.astype(np.int32))
                        for x, n in lists
                    ),
                ],
                ["doc_id", "a", "b", "group_a", "group_b"],
            )

        return step

    schema = "doc_id long, a array<int>, b array<int>, group_a array<int>, group_b array<int>"
    return map_slices(texts(docs), make, schema)


DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SLICE = f"part int, seq int, {DOC}, links binary, pair int, pair_a array<int>, pair_b array<int>, n array<long>"


def linked(docs: DataFrame, a_path: str, b_path: str, folder: str | None = None) -> DataFrame:
    """Stored: a row per document with its links, and rows with the pairs of each slice.

    ``part`` and ``seq`` name the slice. ``links`` are the numbers of the linked pairs of
    the slice, sorted; ``pair`` is the number of the first pair of a row of pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, part, seq = zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch):
                yield from step(piece, press, part, seq)
                seq += 1

    def step(piece: pa.RecordBatch, press, part: int, seq: int) -> Iterator[pa.RecordBatch]:
        made = Aligned(piece.column("text"), a_path, b_path)
        at_a, at_b, n_links = made.links()
        where, keys = pd.factorize(made.a[at_a].astype(np.int64) << 32 | made.b[at_b])
        n = np.bincount(where, minlength=len(keys))
        edges = np.cumsum([0, *n_links]).tolist()
        links = [press.compress(_steps(where[x:y])) for x, y in zip(edges, edges[1:])]
        spelt = [hashlib.sha256(x).hexdigest() if x else "" for x in made.spelt()]
        rows = piece.num_rows
        numbers = [made.n_a, made.n_b, made.n_groups, n_links]
        yield _row_batch(part, seq, rows, [piece.column("doc_id"), *numbers, spelt, links], [None] * 4)
        for at in range(0, len(keys), PAIR_ROWS):
            some = slice(at, at + PAIR_ROWS)
            pairs = [[at], [keys[some] >> 32], [keys[some] & 0xFFFFFFFF], [n[some]]]
            yield _row_batch(part, seq, 1, [None] * 7, pairs)

    return stored(map_batches(texts(docs), run, SLICE), "aligned", folder)


_FIELDS = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("links", pa.binary()), ("pair", pa.int32())]
    + [("pair_a", pa.list_(pa.int32())), ("pair_b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))]
)


def _row_batch(part: int, seq: int, rows: int, doc: list, pairs: list) -> pa.RecordBatch:
    columns = [[part] * rows, [seq] * rows, *doc, *pairs]
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(rows, f.type)
            if x is None
            else x
            if isinstance(x, pa.Array)
            else pa.array(x, f.type)
            for x, f in zip(columns, _FIELDS)
        ],
        schema=_FIELDS,
    )


def _steps(values: np.ndarray) -> bytes:
    """Sorted values as their differences, which compress well."""
    return np.diff(np.sort(values), prepend=0).astype("<u4").tobytes()


def pair_counts(slices_of: DataFrame, folder: str | None = None) -> DataFrame:
    """Stored (a, b, count, best): how often ids are linked, and whether ``b`` has no better."""
    pairs = _pairs(slices_of)
    counts = stored(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts", folder)
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    best = (F.col("count") == F.col("most")).alias("best")
    return counts.join(most, "b").select("a", "b", "count", best)


def _pairs(slices_of: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(F.col("pair_a").alias("a"), F.col("pair_b").alias("b"), "n")
    rows = slices_of.where("pair_a IS NOT NULL").select("part", "seq", "pair", F.posexplode(zipped))
    place = (F.col("pair") + F.col("pos")).alias("place")
    return rows.select("part", "seq", place, "col.a", "col.b", "col.n")


def link_scores(docs: DataFrame, a_path: str, b_path: str, folder: str | None = None) -> DataFrame:
    """Per document the sizes of its alignment, and its links scored by corpus-wide counts.

    ``n_best`` are the links that no other link of their second id beats, ``count_sum`` the sum
    of the counts of all links.
    """
    made = linked(docs, a_path, b_path, folder)
    counts = pair_counts(made, folder)
    known = _pairs(made).join(counts, ["a", "b"])
    known = known.selectExpr("part AS of_part", "seq AS of_seq", "place", "count", "best")
    rows = made.where("links IS NOT NULL").select("part", "seq", *[x.split()[0] for x in DOC.split(", ")], "links")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy()
        sums = []
        for raw in left.column("links").to_pylist():
            at = np.cumsum(np.frombuffer(zstandard.decompress(raw), "<u4"), dtype=np.int64)
            sums.append((int(best[at].sum()), int(count[at].sum())))
        kept = left.drop_columns(["part", "seq", "links"])
        for i, name in enumerate(("n_best", "count_sum")):
            kept = kept.append_column(name, pa.array([x[i] for x in sums], pa.int64()))
        return kept

    both = rows.groupBy("part", "seq").cogroup(known.groupBy("of_part", "of_seq"))
    return both.applyInArrow(score, f"{DOC}, n_best long, count_sum long")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A byte-level and a piece vocabulary aligned over every document."""
    return link_scores(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
        work_folder(spark),
    )


QUERIES = {"op11_token_alignment": op11_token_alignment}

#: SQL has no tokenizers: tested against the two libraries and a plain alignment.
ORACLES: dict[str, str] = {}
