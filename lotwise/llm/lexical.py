"""Ranked lexical search: the best documents of a table for each item of a query set.

One scan turns each document into its length and the counts of those terms that items use.
Those small rows give the corpus statistics and are then searched in chunks. Within a chunk the
documents that hold a term are a bitmap; an item's bitmaps, put side by side, give each document
a mask of the terms it matches. Documents with equal masks form a group whose score is at most
the sum of what its terms can reach; groups are evaluated from the highest bound down until
none that is left can reach the item's best so far. A task passes on the best of each item.

The query set goes to the tasks in blocks of bounded size, each with a scan of its own, so
that no broadcast grows with it; every item is ranked against all documents.

Null texts have no terms and match nothing; documents without terms count nowhere. Equal scores
go by ascending doc_id, rows without an id last. Each row is a document of its own, also if
it repeats another; items repeated with id and text are ranked once, and items that share an id
alone are ranked each. Long texts are counted whole. Other columns are not looked at. Empty
tables give an empty result.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import map_batches, map_slices, stored, table, text_hash, texts, utf8
from workload.folders import work_folder

BEST = 50
#: A block holds items of about so many bytes of text.
BLOCK_BYTES = 8_000_000
#: A chunk holds documents with about so many different item terms in all.
CHUNK_POSTINGS = 400_000
#: Documents that are evaluated together.
BATCH = 256

#: Letters A-Z to a-z, and every ASCII byte that is neither letter nor digit to a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and digits and of all other characters."""
    return raw.translate(_FOLD).split()


def numbered(rows: list[tuple[int | None, str]]) -> tuple[dict[bytes, int], list]:
    """The terms of a block by number, and per item its id, a hash of it and its distinct terms."""
    numbers: dict[bytes, int] = {}
    items = []
    for item_id, text in rows:
        raw = text.encode("utf-8")
        held = [numbers.setdefault(t, len(numbers)) for t in dict.fromkeys(terms(raw))]
        items.append((item_id, text_hash(raw), np.array(held, np.int64)))
    return numbers, items


def weight(df: int, n_docs: int) -> int:
    """How much a term counts that stands in ``df`` of ``n_docs`` documents."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def counted(docs: DataFrame, numbers: Broadcast, folder: str | None = None) -> DataFrame:
    """Stored (doc_id, n, terms, tfs): documents with terms, their length and their item terms."""

    def make():
        index = numbers.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, lengths, found, tfs, sizes = [], [], [], [], [0]
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                words = terms(raw)
                if not words:
                    continue
                have = Counter(map(index.get, words))
                have.pop(None, None)
                ids.append(doc_id)
                lengths.append(len(words))
                found.extend(have.keys())
                tfs.extend(have.values())
                sizes.append(len(found))
            offsets = pa.array(sizes, pa.int32())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

        return step

    made = map_slices(texts(docs), make, "doc_id long, n long, terms array<int>, tfs array<long>")
    return stored(made, "lexical-counts", folder)


class Chunk:
    """Postings of some documents: per term the documents that hold it and what it adds there."""

    def __init__(
        self,
        ids: pa.Array,
        n: np.ndarray,
        sizes: np.ndarray,
        held: np.ndarray,
        tfs: np.ndarray,
        n_docs: int,
        length: int,
        n_terms: int,
    ):
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids = ids.fill_null(0).to_numpy()
        m = 50 + (50 * n * n_docs) // length
        doc = np.repeat(np.arange(len(n)), sizes)
        part = (1_000_000_000 * tfs) // (1000 * tfs + 20 * m[doc])
        order = np.argsort(held, kind="stable")
        self.doc, self.part = doc[order], part[order]
        self.begins = np.searchsorted(held[order], np.arange(n_terms + 1))
        #: the most that a term adds in this chunk, before its weight
        self.most = np.zeros(n_terms, np.int64)
        present = np.flatnonzero(np.diff(self.begins))
        if len(present):
            self.most[present] = np.maximum.reduceat(self.part, self.begins[present])

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.begins[term], self.begins[term + 1])
        return self.doc[span], self.part[span]

    def groups(self, item_terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct masks as rows of bits, the matched documents by group, and where each begins."""
        lists = [self.doc[self.begins[t] : self.begins[t + 1]] for t in item_terms.tolist()]
        matched = np.zeros(len(self.no_id), bool)
        for held in lists:
            matched[held] = True
        docs = np.flatnonzero(matched)
        place = np.cumsum(matched) - 1
        masks = np.zeros((len(docs), (len(lists) + 63) // 64), np.uint64)
        for k, held in enumerate(lists):
            masks[place[held], k // 64] |= np.uint64(1 << (k % 64))
        order = np.lexsort(masks.T)
        masks, docs = masks[order], docs[order]
        new = np.ones(len(docs), bool)
        new[1:] = (masks[1:] != masks[:-1]).any(axis=1)
        begins = np.flatnonzero(new)
        return masks[begins], docs, np.concatenate([begins, [len(docs)]])

    def scores(self, docs: np.ndarray, item_terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of these documents, which are in ascending order."""
        total = np.zeros(len(docs), np.int64)
        for t, w in zip(item_terms.tolist(), weights.tolist()):
            held, part = self.posting(t)
            if w and len(held):
                at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                total += np.where(held[at] == docs, w * part[at], 0)
        return total

    def best(
        self, item_terms: np.ndarray, weights: np.ndarray, floor: int, k: int
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents that may be among the best ``k`` and reach ``floor``, their scores, masks evaluated.

        Documents at the score of the k-th are all returned, as ids decide between them.
        """
        masks, docs, begins = self.groups(item_terms)
        adds = weights * self.most[item_terms]
        bounds = np.zeros(len(masks), np.int64)
        for j, add in enumerate(adds.tolist()):
            bounds += add * ((masks[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
        order = np.argsort(-bounds, kind="stable")
        sizes = np.diff(begins)[order]
        floor, at, have = max(floor, 1), 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        upto = np.cumsum(sizes)
        while at < len(order) and bounds[order[at]] >= floor:
            done = upto[at - 1] if at else 0
            until = max(at + 1, int(np.searchsorted(upto, done + BATCH, side="right")))
            until = max(at + 1, at + int(np.searchsorted(-bounds[order[at:until]], -floor, side="right")))
            some = np.sort(np.concatenate([docs[begins[g] : begins[g + 1]] for g in order[at:until].tolist()]))
            score = self.scores(some, item_terms, weights)
            kept = score >= floor
            have = np.concatenate([have[0], some[kept]]), np.concatenate([have[1], score[kept]])
            if len(have[1]) >= k:
                floor = max(floor, int(np.partition(have[1], len(have[1]) - k)[len(have[1]) - k]))
                kept = have[1] >= floor
                have = have[0][kept], have[1][kept]
            at = until
        return have[0], have[1], at


def best_of(found: np.ndarray, k: int) -> np.ndarray:
    """The best ``k`` columns of (score, whether it has no id, id): high scores, then small ids."""
    return found[:, np.lexsort((found[2], found[1], -found[0]))[:k]]


def searched(
    counts: DataFrame, block: Broadcast, weights: Broadcast, n_docs: int, length: int, best: int
) -> DataFrame:
    """(item_id, item_hash, doc_id, score): the best documents of each task for each item of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight_of = block.value, weights.value
        top = [np.zeros((3, 0), np.int64) for _ in items]
        for chunk in chunks(batches):
            for place, (_, _, item_terms) in enumerate(items):
                held = item_terms[chunk.begins[item_terms + 1] > chunk.begins[item_terms]]
                if len(held):
                    have = top[place]
                    floor = int(have[0, -1]) if have.shape[1] == best else 1
                    docs, scores, _ = chunk.best(held, weight_of[held], floor, best)
                    new = np.stack([scores, chunk.no_id[docs], chunk.ids[docs]])
                    top[place] = best_of(np.concatenate([have, new], axis=1), best)
        sizes = [found.shape[1] for found in top]
        if sum(sizes):
            score, no_id, doc_id = np.concatenate(top, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([item[0] for item, n in zip(items, sizes) for _ in range(n)], pa.int64()),
                    pa.array([item[1] for item, n in zip(items, sizes) for _ in range(n)], pa.int64()),
                    pa.array(doc_id, pa.int64(), mask=no_id.astype(bool)),
                    pa.array(score, pa.int64()),
                ],
                ["item_id", "item_hash", "doc_id", "score"],
            )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
        for batch in batches:
            upto = batch.column("terms").offsets.to_numpy().astype(np.int64)
            upto -= upto[0]
            held, tfs = (batch.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
            ids, n, at = batch.column("doc_id"), batch.column("n").to_numpy(), 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + CHUNK_POSTINGS, side="right")) - 1)
                span = slice(upto[at], upto[to])
                sizes = np.diff(upto[at : to + 1])
                yield Chunk(
                    ids[at:to], n[at:to], sizes, held[span], tfs[span], n_docs, length, len(weights.value)
                )
                at = to

    return map_batches(counts, run, "item_id long, item_hash long, doc_id long, score long")


def blocks(items: DataFrame, block_bytes: int, folder: str | None = None) -> Iterator[list]:
    """The distinct items with a text, in blocks of at most ``block_bytes`` and one item more."""
    wanted = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = F.octet_length("text").cast("long").alias("size")
    wanted = stored(wanted.distinct().select("item_id", "text", size), "lexical-items", folder)
    bins = (wanted.agg(F.sum("size")).first()[0] or 0) // block_bytes + 1
    binned = wanted.withColumn("bin", F.pmod(F.xxhash64("item_id", "text"), F.lit(bins)))
    order = Window.partitionBy("bin").orderBy("item_id", "text")
    before = F.sum("size").over(order) - F.col("size")
    placed = binned.withColumn("part", F.floor(before / block_bytes))
    for b, last in sorted(placed.groupBy("bin").agg(F.max("part")).collect()):
        for part in range(last + 1):
            inside = placed.where((F.col("bin") == b) & (F.col("part") == part))
            rows = inside.select("item_id", "text").collect()
            yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    folder: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score, item_hash): the ``best`` documents above zero for each item."""
    context, made = docs.sparkSession.sparkContext, []
    for rows in blocks(items, block_bytes, folder):
        numbers, block = numbered(rows)
        sent = [context.broadcast(numbers), context.broadcast(block)]
        counts = counted(docs, sent[0], folder)
        n_docs, length = counts.agg(F.count("*"), F.sum("n")).first()
        if n_docs:
            df = dict(counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
            weights = np.array([weight(df.get(t, 0), n_docs) for t in range(len(numbers))], np.int64)
            sent.append(context.broadcast(weights))
            made.append(stored(searched(counts, sent[1], sent[2], n_docs, length, best), "lexical-best", folder))
        for x in sent:
            x.unpersist()
    if not made:
        schema = "item_id long, rank int, doc_id long, score long, item_hash long"
        return docs.sparkSession.createDataFrame([], schema)
    order = Window.partitionBy("item_id", "item_hash").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    rank = F.row_number().over(order).alias("rank")
    found = functools.reduce(DataFrame.unionByName, made)
    return found.select("item_id", rank, "doc_id", "score", "item_hash").where(F.col("rank") <= best)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for each item of the benchmark."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ranked(docs, items, folder=work_folder(spark)).drop("item_hash")


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLDED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUERIES = {"op12_lexical_search": op12_lexical_search}

ORACLES = {
    "op12_lexical_search": f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLDED.format("text")}, '{_TERM}')) AS term FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
stats AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS len FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, stats GROUP BY term, n_docs
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED.format("text")}, '{_TERM}')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // len))))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), stats
  GROUP BY 1, 2
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 50
"""
}
