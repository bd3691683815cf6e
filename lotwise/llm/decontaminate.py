"""Benchmark decontamination by the q-gram lemma.

Every benchmark item is cut into overlapping windows of 100 characters at a stride of 10, so
a passage of 109 characters or more of an item is found wherever it begins; an item of up to
100 characters is one window and needs all of it, less the edits. A stretch of a document
within the edit budget of a window shares at least ``n + 1 - q * (edits + 1)`` q-grams with
it, whose diagonals (place in the document minus place in the window) differ by at most the
budget. So shared q-grams are counted in overlapping bands of diagonals, and bands that
reach the bound are verified by a banded alignment. All else can't match.

Texts are compared in lower case with runs of white space as one space. Null text counts as
empty. Windows with too few characters for the bound are searched with shorter q-grams, down
to single characters; an empty item matches nothing. Repeated rows and items each count.
The benchmark is the query set: it is held in blocks of bounded size, and every block meets
all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import map_slices, rolling, signed, table, texts

WINDOW = 100
#: A verbatim stretch of an item is found for certain from WINDOW + STEP - 1 characters on.
STEP = 10
EDIT_RATE = 0.06
Q = 10
#: Characters of the benchmark in one block, which every task holds.
BLOCK_CHARS = 800_000
FILTER_BITS = 22


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass(frozen=True)
class Pattern:
    """A window of an item with its edit budget and the q-grams it has to share."""

    item: int
    number: int
    text: np.ndarray
    q: int
    edits: int
    bound: int


def patterns(items: list[tuple[int, str]], q: int = Q) -> list[Pattern]:
    out: list[Pattern] = []
    for item, text in items:
        whole = codes(plain(text))
        n = len(whole)
        starts = list(range(0, max(1, n - WINDOW + 1), STEP))
        if n > WINDOW and starts[-1] != n - WINDOW:
            starts.append(n - WINDOW)
        for start in starts if n else []:
            part = whole[start : start + WINDOW]
            edits, own = int(len(part) * EDIT_RATE), q
            while own > 1 and len(part) + 1 - own * (edits + 1) < 1:
                own -= 1
            out.append(Pattern(item, len(out), part, own, edits, len(part) + 1 - own * (edits + 1)))
    return out


class Index:
    """The q-grams of patterns of one length q, by hash: which pattern, and where in it."""

    def __init__(self, found: list[Pattern], q: int):
        self.q, self.patterns = q, {p.number: p for p in found}
        grams = [rolling(p.text, q) for p in found]
        hashes = np.concatenate(grams)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.owner = np.repeat([p.number for p in found], [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.known = np.zeros(1 << FILTER_BITS, bool)
        self.known[(self.hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        self.least = min(p.bound for p in found)
        last = max(self.patterns) + 1
        self.bounds, self.widths = np.full(last, np.iinfo(np.int64).max), np.ones(last, np.int64)
        for p in found:
            self.bounds[p.number], self.widths[p.number] = p.bound, p.edits + 1

    def candidates(self, text: np.ndarray) -> Iterator[tuple[Pattern, int, int]]:
        """(pattern, lowest and highest diagonal) of the bands that reach the bound."""
        h = rolling(text, self.q)
        at = np.flatnonzero(self.known[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if len(at) < self.least:
            return
        a = np.searchsorted(self.hashes, h[at], side="left")
        b = np.searchsorted(self.hashes, h[at], side="right")
        n = b - a
        if n.sum() < self.least:
            return
        total = np.concatenate([[0], np.cumsum(n)])
        hit = np.repeat(a - total[:-1], n) + np.arange(total[-1])
        # Cells of budget and one diagonals; two neighbours are a band, and bands overlap.
        owner = self.owner[hit]
        enough = np.bincount(owner, minlength=len(self.bounds))[owner] >= self.bounds[owner]
        hit, owner = hit[enough], owner[enough]
        diagonal = np.repeat(at, n)[enough] - self.place[hit] + WINDOW
        span = np.int64(len(text) + 2 * WINDOW + 2)
        keys, counts = np.unique(owner * span + diagonal // self.widths[owner], return_counts=True)
        following = np.minimum(np.searchsorted(keys, keys + 1), max(len(keys) - 1, 0))
        paired = counts + np.where(keys[following] == keys + 1, counts[following], 0)
        for key in keys[paired >= self.bounds[keys // span]].tolist():
            pattern, width = self.patterns[key // span], int(self.widths[key // span])
            low = key % span * width - WINDOW
            yield pattern, low, low + 2 * width - 1


def aligned(pattern: np.ndarray, text: np.ndarray, budget: int) -> tuple[int, int]:
    """Least edits between the pattern and any stretch of ``text``, and where that ends.

    ``text`` is the band: it is a few budgets longer than the pattern, so each row of the
    alignment is one vector.
    """
    row = np.zeros(len(text) + 1, np.int32)
    steps = np.arange(len(text) + 1, dtype=np.int32)
    for i, char in enumerate(pattern, 1):
        nxt = row + 1
        np.minimum(nxt[1:], row[:-1] + (text != char), out=nxt[1:])
        row = np.minimum.accumulate(nxt - steps) + steps
        if i % 16 == 0 and row.min() > budget:
            return budget + 1, 0
    end = int(row.argmin())
    return int(row[end]), end


class Finder:
    """All patterns of a benchmark block."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q):
        found = patterns(items, q)
        kinds = sorted({p.q for p in found})
        self.indexes = [Index([p for p in found if p.q == k], k) for k in kinds]

    def matches(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, windows found, least edits, begin, end) with places in the compared text."""
        own = codes(plain(text))
        hits: dict[int, dict[int, tuple[int, int, int]]] = {}
        for index in self.indexes:
            for pattern, low, high in index.candidates(own):
                start = max(0, low - pattern.edits)
                stop = high + len(pattern.text) + pattern.edits
                edits, end = aligned(pattern.text, own[start:stop], pattern.edits)
                if edits <= pattern.edits:
                    spot = (edits, max(0, start + end - len(pattern.text)), start + end)
                    best = hits.setdefault(pattern.item, {})
                    best[pattern.number] = min(best.get(pattern.number, spot), spot)
        return [
            (item, len(best), min(x[0] for x in best.values()),
             min(x[1] for x in best.values()), max(x[2] for x in best.values()))
            for item, best in sorted(hits.items())
        ]


FOUND = "doc_id long, item_id long, n_windows int, edits int, begin long, end long, text_hash long"


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, n_windows, edits, begin, end, text_hash): items of which a document holds a window.

    ``text_hash`` is Spark's ``xxhash64`` of the text, as ids alone don't name a row that lacks
    one or shares it.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = total // block_chars + 1
    found = None
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        shared = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in mine.collect()])

        def make(shared=shared):
            finder = Finder(shared.value)

            def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
                rows = [
                    (doc_id, *match, xxhash.xxh64_intdigest(text.encode("utf-8"), 42))
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for match in finder.matches(text)
                ]
                if not rows:
                    return None
                *columns, hashes = zip(*rows)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                names = ["doc_id", "item_id", "n_windows", "edits", "begin", "end", "text_hash"]
                arrays = [pa.array(x, k) for x, k in zip(columns, kinds)]
                return pa.RecordBatch.from_arrays([*arrays, pa.array(signed(hashes))], names)

            return step

        one = map_slices(texts(docs), make, FOUND)
        found = one if found is None else found.unionByName(one)
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op6_decontaminate": query}
ORACLES = {}
