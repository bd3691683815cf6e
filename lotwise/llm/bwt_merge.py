"""Substring dedup over bytes with merged Burrows-Wheeler transforms.

Every window of ``n`` bytes has a seed, the smallest hash of a quarter of its length in it,
so equal windows have equal seeds at equal offsets. Seeds that occur once end the search
for their windows. For the others the bytes that the windows of a seed cover, its span, are
what may hold repeats: of equal spans the first goes on for all, the rest are repeats of it.

The different spans of the seeds of a bucket are the text of the bucket. They are dealt to
shards, each shard gets a Burrows-Wheeler transform, and the transforms are merged by
refining the interleave: it starts in shard order, and each round takes one more leading
byte into account by passing the interleave once through the symbols of the transforms, or
eight bytes by following the transforms eight times. No suffix is compared or sorted again. Where a border between neighbours appears in round k,
they have k - 1 bytes in common; a suffix with borders on both sides has its place, and the
next rounds pass only the others, interval by interval. After ``n`` rounds the intervals without a border are the
repeated windows, and of each interval all but its first window go.

Seeds with more spans than a bucket may hold have their single windows compared by 128 bits
of hash instead, which splits them over the cluster; nothing is left out.

Windows are judged on the input; earlier means a smaller doc_id, then an earlier start.
Null text counts as empty. A null id comes before all others. Rows that share an id but not
the text are ordered by a hash of it; rows that share both are one document, so neither is
earlier, and both get the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import SLICE_BYTES, map_batches, map_slices, mixed, packed, rolling, signed
from lotwise.llm.common import stored, table, text_hash, utf8
from lotwise.llm.doubling import NULL_ID, Levels, Windows, keyed, windows
from workload.folders import work_folder

BYTES = 100
#: Spans of one seed that meet in a bucket at most, and bytes of a bucket that are merged at once.
BUCKET_SPANS = 4096
BUCKET_BYTES = 1 << 17
SHARDS = 2
#: Symbols of nine bits that sort as one integer.
PACKED = 7
#: Rounds of a merge in one pass, at most 8: so many symbols fit an integer.
AT_ONCE = 8


def hashed_bytes(raw: bytes) -> np.ndarray:
    return mixed(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1))


def byte_windows(raw: bytes, n: int) -> Windows:
    return windows(hashed_bytes(raw), Levels(n), extend=False)


def spans_of(docs: DataFrame, n: int) -> DataFrame:
    """(seed, whole, first, more, key, th): each seed with a hash of the bytes its windows cover.

    ``first`` is its first window, which no other seed of the text has, ``more`` how many follow it.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            out: list[list[np.ndarray]] = [[] for _ in range(6)]
            for key, raw in zip(batch.column("key").to_pylist(), utf8(batch.column("text"))):
                w = byte_windows(raw, n)
                if not len(w.seeds):
                    continue
                ends = zip(w.first.tolist(), (w.last + n).tolist())
                whole = signed([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in ends])
                size = len(w.seeds)
                values = (
                    w.seed_hashes[w.seeds].view(np.int64), whole, w.first.astype(np.int32),
                    (w.last - w.first).astype(np.int32), np.full(size, key), np.full(size, text_hash(raw)),
                )
                for have, value in zip(out, values):
                    have.append(value)
            if not out[0]:
                return None
            names = ["seed", "whole", "first", "more", "key", "th"]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names)

        return step

    return map_slices(keyed(docs), make, "seed long, whole long, first int, more int, key long, th long")


# --- Burrows-Wheeler transforms of small collections ----------------------------------------


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffix array of a collection: ``text`` holds bytes + 1, and 0 at ``ends``.

    The terminators differ, the one of an earlier member is smaller. By doubling from
    ``PACKED`` symbols on; a suffix that differs from its neighbours is not looked at again.
    """
    n = len(text)
    sizes = np.diff(ends, prepend=-1)
    left = np.repeat(ends, sizes) - np.arange(n)  # symbols before the terminator
    padded = np.concatenate([text.astype(np.int64), np.zeros(PACKED, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(PACKED):
        key = key << 9 | np.where(left >= k, padded[k : k + n], 0)
    order = np.argsort(key, kind="stable")
    # A key that holds a terminator is that of one suffix; equal ones are in member order.
    fresh = left[order] < PACKED
    fresh[0] = True
    fresh[1:] |= np.diff(key[order]) != 0
    slots, span = np.arange(n), PACKED
    rank = np.empty(n, np.int64)
    rank[order] = slots[fresh][np.cumsum(fresh) - 1]
    slots = slots[~alone(fresh)]
    while len(slots):
        same = order[slots]
        key = rank[same] * n + rank[same + span]
        by = np.argsort(key, kind="stable")
        same, fresh = same[by], np.diff(key[by], prepend=-1) != 0
        order[slots] = same
        rank[same] = slots[fresh][np.cumsum(fresh) - 1]
        slots, span = slots[~alone(fresh)], 2 * span
    return order


def alone(border: np.ndarray) -> np.ndarray:
    """Which places have a border on both sides."""
    return border & np.append(border[1:], True)


class Shard:
    """Members of a collection, their suffix array and transform."""

    def __init__(self, members: list[bytes]):
        sizes = np.fromiter(map(len, members), np.int64, len(members))
        self.begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        # The byte 255 is no part of UTF-8, so 0 is free for the terminators.
        text = np.zeros(int(sizes.sum()) + len(members), np.uint8)
        ends = self.begins + sizes
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(members), np.uint8) + 1
        self.order = suffix_order(text, ends)
        self.members = len(members)
        # The symbol before the start of a member is its terminator.
        before = self.order - 1
        at_start = np.zeros(len(text), bool)
        at_start[self.begins] = True
        self.transform = np.where(at_start[self.order], 0, text[before])


def merged(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms: (suffixes, first) of what shares its first ``rounds`` symbols.

    The suffixes stand interval by interval, each as its place in the transforms laid end to
    end; ``first`` marks the first of an interval, in which shards and their suffixes are in
    order. Up to ``AT_ONCE`` rounds are taken in one pass through the transforms. A suffix
    that differs from both neighbours has its place and leaves the interleave: what stands a
    symbol to the left of it differs as well. An interval whose suffixes all follow the same
    symbols moves on as it is.
    """
    sizes = [len(s.transform) for s in shards]
    symbols = np.concatenate([s.transform for s in shards])
    longer = np.empty(len(symbols), np.intp)  # the suffix a symbol longer
    for begin, shard in zip(np.cumsum([0, *sizes]).tolist(), shards):
        order = np.argsort(shard.transform, kind="stable")
        longer[begin + order] = np.arange(begin, begin + len(order))
    # The last 1, 2, 4, .. symbols in front of each suffix, whether a terminator is one of
    # them, and the suffix that starts with them.
    passes = [(1, symbols.astype(np.uint64), symbols == 0, longer)]
    while 2 * passes[-1][0] <= AT_ONCE:
        span, front, ended, longer = passes[-1]
        both = front | front.take(longer) << np.uint64(8 * span)
        passes.append((2 * span, both, ended | ended.take(longer), longer.take(longer)))
    suffixes, first = np.arange(len(symbols)), np.zeros(len(symbols), bool)
    first[:1] = True
    done = 0
    while done < rounds and len(suffixes):
        span, front, ended, longer = next(x for x in reversed(passes) if done + x[0] <= rounds)
        done += span
        key, alone_now = front.take(suffixes), ended.take(suffixes)
        suffixes = longer.take(suffixes)
        divides = alone_now.copy()  # terminators are all different
        divides[1:] |= (key[1:] != key[:-1]) & ~first[1:]
        interval = np.cumsum(first, dtype=np.int32) - 1
        hit = np.zeros(interval[-1] + 1, bool)
        hit[interval[divides]] = True
        divided = hit.take(interval)
        part, rest = np.flatnonzero(divided), np.flatnonzero(~divided)
        part = part[np.argsort(key[part], kind="stable")]
        border = alone_now[part]
        border[:1] = True
        border[1:] |= (key[part[1:]] != key[part[:-1]]) | (interval[part[1:]] != interval[part[:-1]])
        left = np.flatnonzero(~alone(border))
        suffixes = np.concatenate([suffixes.take(rest), suffixes.take(part.take(left))])
        first = np.concatenate([first.take(rest), border.take(left)])
    return suffixes, first


def repeated_starts(members: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``n`` bytes that occur more than once in the members.

    Returns (interval, member, offset) of each, one interval number for equal windows.
    """
    count = max(1, min(SHARDS, len(members)))
    dealt = [range(i, len(members), count) for i in range(count)]
    shards = [Shard([members[k] for k in mine]) for mine in dealt]
    # A window that held a terminator would be alone, so those left are whole.
    found, first = merged(shards, n)
    begins = np.cumsum([0, *(len(s.transform) for s in shards)])
    which = np.searchsorted(begins, found, side="right") - 1
    member, offset = np.empty(len(found), np.int64), np.empty(len(found), np.int64)
    for i, (shard, mine) in enumerate(zip(shards, dealt)):
        here = which == i
        start = shard.order[found[here] - begins[i]]
        own = np.searchsorted(shard.begins, start, side="right") - 1
        member[here] = np.array(mine)[own]
        offset[here] = start - shard.begins[own]
    return np.cumsum(first), member, offset


# --- The search -----------------------------------------------------------------------------

SPELT = "seed long, span binary, h1 long, h2 long, key long, th long, start int"


def repeats(docs: DataFrame, whole: DataFrame, n: int, folder: str | None) -> DataFrame:
    """(key, th, all_of, starts): runs of windows that all occur earlier, and single windows."""
    seeds = stored(spans_of(docs, n), "all-spans", folder)
    again = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    # Stored first, so that a hot seed can be split in the join.
    open_seeds = stored(seeds.join(stored(again, "open-seeds", folder), "seed"), "open-spans", folder)
    place = F.struct("key", "th", "first", "more")
    same = stored(
        open_seeds.groupBy("seed", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("one")),
        "spans",
        folder,
    )
    later = open_seeds.join(same.where("n > 1").select("seed", "whole", "one"), ["seed", "whole"])
    later = later.where(~place.eqNullSafe(F.col("one")))
    settled = later.groupBy("key", "th").agg(F.collect_set(F.struct("first", "more")).alias("all_of"))
    sizes = same.groupBy("seed").agg(F.count(F.lit(1)).alias("spans")).where("spans > 1")
    ones = same.join(sizes, "seed").select(
        "seed", "one.*", (F.col("spans") > BUCKET_SPANS).alias("large")
    )
    wanted = ones.groupBy("key", "th").agg(F.collect_list(F.struct("first", "more", "seed", "large")).alias("open"))
    # Repeated rows are spelt once, or one of them would count as earlier than the other.
    rows = whole.join(wanted, ["key", "th"]).select("key", "th", "z", "open").dropDuplicates(["key", "th"])
    spelt = stored(map_batches(rows, _spell(n), SPELT), "spelt-spans", folder)
    bucketed = spelt.where("span IS NOT NULL").select("seed", "span", "key", "th", "start")
    bucketed = bucketed.repartition("seed").sortWithinPartitions("seed")
    merged_hits = map_batches(bucketed, _merge(n), "key long, th long, start int")
    # Windows of seeds with too many spans for one bucket.
    single = spelt.where("span IS NULL").select("h1", "h2", "key", "th", "start")
    window = F.struct("key", "th", "start")
    first = single.groupBy("h1", "h2").agg(F.min(window).alias("one"), F.count(F.lit(1)).alias("n"))
    other_hits = single.join(first.where("n > 1"), ["h1", "h2"]).where(~window.eqNullSafe(F.col("one")))
    hits = merged_hits.unionByName(other_hits.select("key", "th", "start"))
    starts = hits.groupBy("key", "th").agg(F.collect_set("start").alias("starts"))
    return settled.join(starts, ["key", "th"], "full")


def _fields(column: pa.Array, row: int) -> list[np.ndarray]:
    """The fields of a list of structs, null as empty."""
    if not column[row].is_valid:
        return [np.zeros(0, np.int64) for _ in range(column.type.value_type.num_fields)]
    return [x.to_numpy(zero_copy_only=False) for x in column[row].values.flatten()]


def _spell(n: int):
    """The bytes of each open span, or the hashes of its windows."""
    none = np.zeros(0, np.int64)

    def batch_of(parts: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        names = ["seed", "span", "h1", "h2", "key", "th", "start"]
        seeds, spans, one, two, keys, ths, starts = zip(*parts)
        flat = [np.concatenate(seeds), [x for some in spans for x in some], *map(np.concatenate, (one, two, keys, ths, starts))]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(flat, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            keys, ths, zs = (batch.column(c).to_pylist() for c in ("key", "th", "z"))
            parts, held = [], 0
            for i, (key, th, z) in enumerate(zip(keys, ths, zs)):
                raw = unpress.decompress(z)
                first, more, seed, large = _fields(batch.column("open"), i)
                small = ~large
                spans = [raw[a : a + m + n] for a, m in zip(first[small].tolist(), more[small].tolist())]
                spots, one, two = none, none, none
                if large.any():
                    runs = zip(first[large].tolist(), more[large].tolist())
                    spots = np.concatenate([np.arange(a, a + m + 1) for a, m in runs])
                    hashes = hashed_bytes(raw)
                    one, two = (rolling(x, n)[spots].view(np.int64) for x in (hashes, mixed(hashes)))
                void, size = np.zeros(len(spans), np.int64), len(spans) + len(spots)
                parts.append(
                    (
                        np.concatenate([seed[small], np.zeros(len(spots), np.int64)]),
                        spans + [None] * len(spots),
                        np.concatenate([void, one]),
                        np.concatenate([void, two]),
                        np.full(size, key),
                        np.full(size, th),
                        np.concatenate([first[small], spots]),
                    )
                )
                held += sum(map(len, spans)) + 40 * size
                if held >= SLICE_BYTES:
                    yield batch_of(parts)
                    parts, held = [], 0
            if parts:
                yield batch_of(parts)

    return run


def _merge(n: int):
    """Windows that occur earlier in the bucket; whole seeds at a time, sorted by seed."""

    def flush(held: list[tuple[int, bytes, int, int, int]]) -> pa.RecordBatch | None:
        held.sort(key=lambda x: (x[2], x[3], x[4]))  # in the order of what is earlier
        interval, member, offset = repeated_starts([x[1] for x in held], n)
        starts = np.array([x[4] for x in held], np.int64)[member] + offset
        # Members are in order and windows of one text share no two seeds: the first window
        # of an interval is the one of the smallest member, then offset.
        order = np.lexsort((starts, member, interval))
        first = np.ones(len(order), bool)
        first[1:] = interval[order][1:] != interval[order][:-1]
        gone = order[~first]
        if not len(gone):
            return None
        keys, ths = (np.array([x[c] for x in held], np.int64) for c in (2, 3))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys[member[gone]]),
                pa.array(ths[member[gone]]),
                pa.array(starts[gone].astype(np.int32)),
            ],
            ["key", "th", "start"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, int, int, int]] = []
        size = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("seed", "span", "key", "th", "start")]
            for row in zip(*columns):
                if size >= BUCKET_BYTES and row[0] != held[-1][0]:
                    if (out := flush(held)) is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held and (out := flush(held)) is not None:
            yield out

    return run


def drop_repeats(docs: DataFrame, n: int = BYTES, folder: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): texts without what occurs earlier.

    ``kept`` are the bytes left, as binary, since a cut may split a character.
    """
    whole = packed(docs).withColumn("key", F.coalesce("doc_id", F.lit(NULL_ID)))
    found = stored(repeats(docs, whole, n, folder), "byte-repeats", folder)
    rows = whole.join(found, ["key", "th"], "left").select("doc_id", "z", "all_of", "starts")

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            out, held = [], 0
            for i, (doc_id, z) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("z").to_pylist())):
                raw = kept = unpress.decompress(z)
                removed = runs = 0
                first, more = _fields(batch.column("all_of"), i)
                starts = batch.column("starts")[i].as_py() or []
                if len(first) or starts:
                    change = np.zeros(len(raw) + 1, np.int64)
                    spots = np.array(starts, np.int64)
                    np.add.at(change, np.concatenate([first, spots]), 1)
                    np.add.at(change, np.concatenate([first + more, spots]) + n, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed = int(gone.sum())
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((doc_id, len(raw), removed, runs, kept))
                held += len(kept)
                if held >= SLICE_BYTES:
                    yield batch_of(out)
                    out, held = [], 0
            if out:
                yield batch_of(out)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return map_batches(rows, remove, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = drop_repeats(table(spark, sf_dir, "documents"), folder=work_folder(spark))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


_LEADS = " || ".join(
    ["s"] + [f"coalesce(lead(s, {10 * k}) OVER w, '')" for k in range(1, 10)]
)

# Bytes as pairs of hex digits; the hundred from a byte on are ten runs of ten.
ORACLE = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(regexp_extract_all(h, '..')) AS b, unnest(range(0, length(h) // 2)) AS pos, length(h) // 2 AS n FROM d),
u AS (SELECT doc_id, pos, n, b, string_agg(b, '') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS s FROM p),
m AS (SELECT doc_id, pos, b, CASE WHEN pos + 100 <= n THEN md5({_LEADS}) END AS m FROM u WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
t AS (SELECT doc_id, pos, b, m IS NOT NULL AND row_number() OVER (PARTITION BY m ORDER BY doc_id, pos) > 1 AS again FROM m),
g AS (SELECT doc_id, pos, b, bool_or(again) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM t),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM g),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_spans,
             string_agg(b, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

QUERIES = {"op10_bwt_merge": query}
ORACLES = {"op10_bwt_merge": ORACLE}
