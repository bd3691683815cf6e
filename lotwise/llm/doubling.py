"""Substring dedup over words by level-wise doubling.

A window of ``n`` words is looked for by the smallest hash of a quarter of its length that
it holds, its seed: equal windows have equal seeds at equal offsets, and neighbouring
windows share a seed, so seeds are few. Only seeds that occur again are extended to twice
the length, to the right and to the left; only windows around an extension that occurs
again are extended once more, to the full length. Seeds whose windows are repeated all
together (the words that their windows cover are equal) need no last level.

Windows are judged on the input. A word goes if any window over it occurs anywhere else,
the same document included. Null text has no words; texts below ``n`` words stay whole.
Rows that repeat a document repeat its windows, so they lose them too.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import map_batches, map_slices, mixed, packed, rolling, signed, sliding
from lotwise.llm.common import stored, table, text_hash, texts, utf8
from workload.folders import work_folder

WORDS = 35
NULL_ID = -(2**63)


@dataclass(frozen=True)
class Levels:
    """Lengths of the levels for windows of ``n`` words."""

    n: int

    @property
    def seed(self) -> int:
        return max(1, (self.n + 3) // 4)

    @property
    def twice(self) -> int:
        return min(2 * self.seed, self.n)


@dataclass
class Windows:
    """The windows of a text by their seeds. Windows of one seed are neighbours."""

    hashes: np.ndarray
    seed_hashes: np.ndarray
    twice_hashes: np.ndarray
    seeds: np.ndarray  # place of each seed
    first: np.ndarray  # its first window
    last: np.ndarray  # its last window


def hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def windows(hashes: np.ndarray, levels: Levels, extend: bool = True) -> Windows:
    """Windows over a sequence given by a hash of each of its parts; ``extend`` hashes level two."""
    none = np.zeros(0, np.int64)
    short = rolling(hashes, levels.seed)
    twice = rolling(hashes, levels.twice) if extend else none.astype(np.uint64)
    if len(hashes) < levels.n:
        return Windows(hashes, short, twice, none, none, none)
    # The place fills the low half, in every text alike, so that ties go to the left.
    low = np.uint64((1 << 32) - 1)
    ranked = (short & ~low) | np.arange(len(short), dtype=np.uint64)
    seed_of = (sliding(ranked, levels.n - levels.seed + 1, np.minimum) & low).astype(np.int64)
    edges = np.flatnonzero(np.diff(seed_of)) + 1
    first = np.concatenate([[0], edges])
    last = np.concatenate([edges, [len(seed_of)]]) - 1
    return Windows(hashes, short, twice, seed_of[first], first, last)


def seed_rows(docs: DataFrame, levels: Levels) -> DataFrame:
    """One row for each seed: its hash, the hashes of its extensions, that of all its words."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for key, raw in zip(batch.column("key").to_pylist(), utf8(batch.column("text"))):
                w = windows(hashed(raw.split()), levels)
                if not len(w.seeds):
                    continue
                size = len(w.seeds)
                line = w.hashes.tobytes()
                spans = zip((w.first * 8).tolist(), ((w.last + levels.n) * 8).tolist())
                whole = signed([xxhash.xxh3_64_intdigest(line[a:b]) for a, b in spans])
                right = _at(w.twice_hashes, w.seeds)
                left = _at(w.twice_hashes, w.seeds - (levels.twice - levels.seed))
                values = (
                    w.seed_hashes[w.seeds].view(np.int64), right, left, whole, w.seeds.astype(np.int32),
                    np.full(size, key), np.full(size, text_hash(raw)),
                )
                for have, value in zip(out, values):
                    have.append(value)
            if not out[0]:
                return None
            names = ["seed", "right", "left", "whole", "place", "key", "th"]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names)

        return step

    schema = "seed long, right int, left int, whole long, place int, key long, th long"
    return map_slices(keyed(docs), make, schema)


def _at(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """32 bits of the hashes at these places, 0 where a place is outside of the text."""
    inside = (places >= 0) & (places < len(hashes))
    out = np.zeros(len(places), np.int32)
    out[inside] = (hashes[places[inside]] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    return texts(docs).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("key"), "text")


def repeated_windows(docs: DataFrame, whole: DataFrame, n: int, folder: str | None) -> DataFrame:
    """(key, th, all_of, starts): seeds whose windows are all repeated, and single windows.

    ``whole`` are the packed texts, for the last level.
    """
    levels = Levels(n)
    seeds = stored(seed_rows(docs, levels), "seeds", folder)
    # Level one: seeds that occur again.
    # Stored ahead of the join, which can then split the rows of a hot seed.
    again = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    again = stored(again, "seeds-again", folder)
    open_seeds = stored(seeds.join(again, "seed"), "open-seeds", folder)
    # Seeds whose words are those of another: all their windows are repeated.
    same = open_seeds.groupBy("seed", "whole").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("key", "th", "place", "right", "left")).alias("one"),
    )
    same = stored(same, "seed-words", folder)
    settled = open_seeds.join(same.where("n > 1").select("seed", "whole"), ["seed", "whole"])
    settled = settled.groupBy("key", "th").agg(F.collect_set("place").alias("all_of"))
    # Level two: of seeds with different words around, the extensions that occur again.
    ones = same.select("seed", "one.*")
    rights = ones.groupBy("seed", "right").agg(F.count(F.lit(1)).alias("n_right"))
    lefts = ones.groupBy("seed", "left").agg(F.count(F.lit(1)).alias("n_left"))
    extended = (
        ones.join(rights, ["seed", "right"])
        .join(lefts, ["seed", "left"])
        .where("n_right > 1 OR n_left > 1")
        .groupBy("key", "th")
        .agg(
            F.collect_list(
                F.struct(
                    "place", (F.col("n_right") > 1).alias("right"), (F.col("n_left") > 1).alias("left")
                )
            ).alias("open")
        )
    )
    # Last level: single windows by their full length.
    rows = whole.join(extended, ["key", "th"]).select("key", "th", "z", "open", "doc_id")

    def spell(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                w = windows(hashed(unpress.decompress(batch.column("z")[i].as_py()).split()), levels)
                first = dict(zip(w.seeds.tolist(), zip(w.first.tolist(), w.last.tolist())))
                starts: list[int] = []
                for seed in batch.column("open")[i].as_py():
                    place = seed["place"]
                    a, b = first[place]
                    # To the right the extension lies in windows that start late enough.
                    late = place + levels.twice - n
                    early = place - (levels.twice - levels.seed)
                    starts += [
                        s for s in range(a, b + 1) if (seed["right"] and s >= late) or (seed["left"] and s <= early)
                    ]
                spots = np.array(starts, np.int64)
                if not len(spots):
                    continue
                one = rolling(w.hashes, n)[spots].view(np.int64)
                two = rolling(mixed(w.hashes), n)[spots].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one),
                        pa.array(two),
                        pa.array(np.full(len(spots), batch.column("key")[i].as_py())),
                        pa.array(np.full(len(spots), batch.column("th")[i].as_py())),
                        pa.array(spots.astype(np.int32)),
                    ],
                    ["h1", "h2", "key", "th", "start"],
                )

    spelt = stored(map_batches(rows, spell, "h1 long, h2 long, key long, th long, start int"), "windows", folder)
    twice = spelt.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    twice = stored(twice, "windows-again", folder)
    single = spelt.join(twice, ["h1", "h2"]).groupBy("key", "th").agg(F.collect_set("start").alias("starts"))
    return settled.join(single, ["key", "th"], "full")


def drop_repeats(docs: DataFrame, n: int = WORDS, folder: str | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words of repeated windows.

    ``kept`` are the words left, joined by one space.
    """
    levels = Levels(n)
    whole = packed(docs).withColumn("key", F.coalesce("doc_id", F.lit(NULL_ID)))
    found = stored(repeated_windows(docs, whole, n, folder), "repeats", folder)
    rows = whole.join(found, ["key", "th"], "left").select("doc_id", "z", "all_of", "starts")

    def remove(batches):
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                raw = unpress.decompress(batch.column("z")[i].as_py())
                all_of, starts = (batch.column(c)[i].as_py() or [] for c in ("all_of", "starts"))
                words = raw.split()
                if not all_of and not starts:
                    out.append((batch.column("doc_id")[i].as_py(), len(words), 0, b" ".join(words)))
                    continue
                w = windows(hashed(words), levels)
                change = np.zeros(len(words) + 1, np.int64)
                hit = np.isin(w.seeds, all_of)
                np.add.at(change, w.first[hit], 1)
                np.add.at(change, w.last[hit] + n, -1)
                spots = np.array(starts, np.int64)
                np.add.at(change, spots, 1)
                np.add.at(change, spots + n, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = [x for x, g in zip(words, gone.tolist()) if not g]
                out.append((batch.column("doc_id")[i].as_py(), len(words), int(gone.sum()), b" ".join(kept)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(x, k) for x, k in zip(zip(*out), kinds)]
            arrays[3] = arrays[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept"])

    return map_batches(rows, remove, "doc_id long, n_words long, n_removed long, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = drop_repeats(table(spark, sf_dir, "documents"), folder=work_folder(spark))
    return made.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM d),
s AS (SELECT r, pos, word, CASE WHEN pos + 34 <= n THEN
        md5(string_agg(word, ' ') OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS h
      FROM p),
t AS (SELECT r, pos, word, h IS NOT NULL AND count(*) OVER (PARTITION BY h) > 1 AS again FROM s),
g AS (SELECT r, pos, word, bool_or(again) OVER (PARTITION BY r ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM t),
k AS (SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM g GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""

QUERIES = {"op4_doubling": query}
ORACLES = {"op4_doubling": ORACLE}
