"""SimHash near-duplicates found with BK-trees.

Fingerprints are made distinct first, so a group of copies is one fingerprint. Two
fingerprints that differ in at most two of 64 bits agree in at least two of four blocks
of 16 bits. The fingerprints that agree in two given blocks form a bucket; each bucket is
cut into shards of bounded size, each with a BK-tree: a node's children are keyed by
their distance to it, and a search follows only the edges whose distance lies within the
radius of the node's own. Every fingerprint of a bucket searches all trees of the bucket.
Thus the trees that meet a query are bounded in size and number by the bucket, where a
broadcast of all trees to all queries would grow with the square of the corpus.

Texts that are null or hold no word have the fingerprint zero. Null ids are allowed; a
component has the smallest id that is not null. Repeated rows each give a row.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.llm.common import map_batches, map_slices, signed, slices, stored, table, texts, utf8
from lotwise.llm.graph import components
from workload.folders import work_folder

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints in one tree at most, on average; buckets with more have several trees.
TREE_SIZE = 4096
BLOCK_BITS = 16
BLOCKS = 4


def shingle_hashes(raw: bytes, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the word shingles of a text, repeats included; of all its words if too few."""
    found = raw.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    line = b" ".join(found)
    width = min(words, len(found))
    sizes = np.fromiter(map(len, found), np.int64, len(found)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = len(found) - width + 1
    pairs = zip(starts[:last].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(raw: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of a text as an unsigned 64-bit integer."""
    return majority(shingle_hashes(raw, words))


def majority(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(most, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit integer."""

    def make():
        def step(batch):
            fps = np.array([fingerprint(x, words) for x in utf8(batch.column("text"))], np.uint64)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"]
            )

        return step

    return map_slices(texts(docs), make, "doc_id long, fp long")


class BKTree:
    """Integers by Hamming distance: the child of a node under d differs from it in d bits."""

    def __init__(self, values: list[int]):
        self.root: tuple[int, dict] | None = None
        for value in values:
            self.add(value)

    def add(self, value: int) -> None:
        if self.root is None:
            self.root = (value, {})
            return
        node = self.root
        while True:
            distance = (node[0] ^ value).bit_count()
            if distance == 0:
                return
            child = node[1].get(distance)
            if child is None:
                node[1][distance] = (value, {})
                return
            node = child

    def within(self, value: int, radius: int) -> list[int]:
        found, open_nodes = [], [self.root] if self.root else []
        while open_nodes:
            own, children = open_nodes.pop()
            distance = (own ^ value).bit_count()
            if distance <= radius:
                found.append(own)
            for d in range(max(1, distance - radius), distance + radius + 1):
                if d in children:
                    open_nodes.append(children[d])
        return found


    def nearest(self, value: int, radius: int, count: int) -> list[int]:
        """The ``count`` closest other values within ``radius``, ties to the smallest."""
        best: list[tuple[int, int]] = []
        open_nodes = [self.root] if self.root else []
        while open_nodes:
            own, children = open_nodes.pop()
            distance = (own ^ value).bit_count()
            if own != value and distance <= radius:
                bisect.insort(best, (distance, own))
                if len(best) >= count:
                    del best[count:]
                    radius = min(radius, best[-1][0])
            for d in range(max(1, distance - radius), distance + radius + 1):
                if d in children:
                    open_nodes.append(children[d])
        return [own for _, own in best]


def bucket_keys(fp: Column) -> Column:
    """One key for each pair of blocks: the number of the pair and the bits of both."""
    block = [
        F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for i in range(BLOCKS)
    ]
    pairs = itertools.combinations(range(BLOCKS), 2)
    keys = [
        F.lit(n << 32) + F.shiftleft(block[i], BLOCK_BITS) + block[j] for n, (i, j) in enumerate(pairs)
    ]
    return F.array(*keys)


def near_pairs(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): distinct fingerprints within ``radius`` bits, once each. ``fps`` is distinct."""
    if radius > BLOCKS - 2:
        raise ValueError(f"{BLOCKS} blocks find at most {BLOCKS - 2} differing bits")
    members = fps.select("fp", F.explode(bucket_keys(F.col("fp"))).alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = members.join(sizes, "bucket").withColumn("shards", F.ceil(F.col("n") / tree_size))
    stored_in = members.select(
        "bucket",
        F.pmod(F.xxhash64("fp"), F.col("shards")).alias("shard"),
        F.lit(0).alias("asks"),
        "fp",
    )
    asked = members.select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.lit(1).alias("asks"),
        "fp",
    )
    rows = stored_in.unionByName(asked).repartition("bucket", "shard")
    rows = rows.sortWithinPartitions("bucket", "shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, values, tree = None, [], None
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "shard", "asks", "fp")]
            for bucket, shard, asks, fp in zip(*columns):
                fp &= (1 << 64) - 1
                if (bucket, shard) != key:
                    key, values, tree = (bucket, shard), [], None
                if not asks:
                    values.append(fp)
                    continue
                tree = tree or BKTree(values)
                out += [(min(fp, x), max(fp, x)) for x in tree.within(fp, radius) if x != fp]
            if out:
                a, b = (np.array(x, np.uint64).view(np.int64) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return map_batches(rows, search, "a long, b long").distinct()


def near_groups(docs: DataFrame, folder: str | None = None, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest id that links reach."""
    rows = stored(fingerprints(docs, words), "fingerprints", folder)
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = near_pairs(rows.select("fp").distinct())
    linked = components(links, folder).withColumnRenamed("node", "fp").join(groups, "fp")
    roots = linked.groupBy("root").agg(F.min("least").alias("joint"))
    linked = linked.join(roots, "root").select("fp", "joint")
    known = groups.join(linked, "fp", "left").select(
        "fp", F.coalesce("joint", "least").alias("component_id")
    )
    # Stored ahead of the join, which can then split the rows of a fingerprint of many texts.
    known = stored(known, "groups-of-fingerprints", folder)
    return rows.join(known, "fp").select("doc_id", "fp", "component_id")


def pressed(rows: DataFrame) -> DataFrame:
    """(th, z): the texts of ``rows`` (th, text) compressed."""

    def make():
        press = zstandard.ZstdCompressor(level=3)

        def step(batch):
            z = pa.array([press.compress(x) for x in utf8(batch.column("text"))], pa.binary())
            return pa.RecordBatch.from_arrays([batch.column("th"), z], ["th", "z"])

        return step

    return map_slices(rows.select("th", "text"), make, "th long, z binary")


# --- Near-duplicates by the similarity of their shingles --------------------------------------

SIMILAR_WORDS = 5
SIMILARITY = 0.8
#: Buckets for each text: two texts of similarity 0.8 meet in none with a chance of 3e-5; the
#: exact pass by prefixes finds them.
BANDS = 20
BAND_ROWS = 4
#: Fingerprints of texts of similarity 0.8 differ in about 10 bits. Pairs further apart and
#: partners beyond the nearest in a shard are found by the exact pass.
SIMILAR_RADIUS = 24
NEAREST = 4
#: Rounds that compare one text of each group before all that are left are compared.
ROUNDS = 2
#: Shingles that prefixes take last, and the sample that they are counted in.
COMMON_SHINGLES = 1 << 18
SAMPLE_TEXTS = 50_000
#: Compressed bytes of texts that are worked on before their results go out.
PRESSED_BYTES = 250_000
#: Against rounding: bounds are this much too wide rather than too narrow.
SLACK = 1e-6


@functools.cache
def _multipliers() -> np.ndarray:
    rng = np.random.default_rng(11)
    return rng.integers(1, 1 << 63, (1, BANDS * BAND_ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(hashes: np.ndarray) -> list[int]:
    """Keys of the buckets of a text: hashes of the least values of its shingles."""
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 2048):
            block = hashes[at : at + 2048, None] * _multipliers()
            least = np.minimum(least, block.min(axis=0))
    rows = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh3_64_intdigest(rows[i].tobytes(), i) for i in range(BANDS)]


def prefix_size(n: int, similarity: float) -> int:
    """Shingles of a set of ``n`` of which a set of this similarity holds at least one."""
    return n - max(1, math.ceil(similarity * n - SLACK)) + 1


def common_shingles(whole: DataFrame) -> np.ndarray:
    """Hashes of the shingles that most texts hold, the rarest of them first; by a bounded sample.

    They only set the order in which prefixes are taken. Any order finds all pairs, this one
    with fewer texts in a bucket.
    """
    every = whole.count() // SAMPLE_TEXTS + 1

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            for z in batch.column("z"):
                found = np.unique(shingle_hashes(unpress.decompress(z.as_py()), SIMILAR_WORDS))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["w"])

    sample = whole.where(F.pmod("th", F.lit(every)) == 0).select("z")
    seen = map_batches(sample, spell, "w long").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    most = seen.where("n > 2").orderBy(F.desc("n"), "w").limit(COMMON_SHINGLES)
    return np.array([r["w"] for r in most.collect()][::-1], np.int64).view(np.uint64)


def signatures(whole: DataFrame, similarity: float, folder: str | None = None) -> DataFrame:
    """(th, fp, n, keys, prefix) of the texts (th, z) that hold a word.

    Fingerprints are majorities over distinct shingles, as similarity is judged on sets:
    repeats of a line don't move them. ``n`` is the number of distinct shingles and ``prefix`` as many of them as a similar text
    can't miss, the shingles of few texts first and in one order for all texts.
    """
    common = common_shingles(whole)
    order = np.argsort(common)
    shared = whole.sparkSession.sparkContext.broadcast((common[order], order + 1))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        known, ranks = shared.value
        for batch in (piece for whole_batch in batches for piece in slices(whole_batch, "z", PRESSED_BYTES)):
            th, fps, sizes, keys, prefixes = [], [], [], [], []
            for own, z in zip(batch.column("th").to_pylist(), batch.column("z")):
                hashes = shingle_hashes(unpress.decompress(z.as_py()), SIMILAR_WORDS)
                if not len(hashes):
                    continue
                distinct = np.unique(hashes)
                rank = np.zeros(len(distinct), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, distinct), len(known) - 1)
                    rank = np.where(known[at] == distinct, ranks[at], 0)
                first = np.argsort(rank, kind="stable")[: prefix_size(len(distinct), similarity)]
                th.append(own)
                fps.append(majority(distinct))
                sizes.append(len(distinct))
                keys.append(signed(band_keys(distinct)))
                prefixes.append(distinct[first].view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(th, pa.int64()), pa.array(signed(fps)), pa.array(sizes, pa.int64()),
                    pa.array(keys, longs), pa.array(prefixes, longs),
                ],
                ["th", "fp", "n", "keys", "prefix"],
            )

    schema = "th long, fp long, n long, keys array<long>, prefix array<long>"
    return stored(map_batches(whole.select("th", "z"), sign, schema), "signatures", folder)


def similar_candidates(signs: DataFrame, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): for each text of ``signatures`` and bucket the texts with the nearest fingerprints.

    Buckets are those of equal least shingle hashes, cut into shards with a BK-tree each. A
    text asks every shard of its buckets for the nearest, so a group of any size gives each
    of its texts a few links, never all pairs. These links join most of a group; what they
    miss, as others are nearer or no bucket is shared, is left to ``crossing``.
    """
    members = signs.select("th", "fp", F.explode("keys").alias("bucket"))
    # Texts of one fingerprint are linked to the first of them and to the rest through it.
    same = members.groupBy("bucket", "fp").agg(F.min("th").alias("first"), F.count("th").alias("texts"))
    twins = same.where("texts > 1").select("bucket", "fp", F.col("first").alias("a"))
    stars = members.join(twins, ["bucket", "fp"]).select("a", F.col("th").alias("b")).where("a <> b")
    sizes = same.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = same.join(sizes, "bucket").withColumn("shards", F.ceil(F.col("n") / tree_size))
    shard = F.pmod(F.xxhash64("fp"), F.col("shards"))
    held = same.select("bucket", shard.alias("shard"), F.lit(0).alias("asks"), "fp", "first")
    asked = same.select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"),
        F.lit(1).alias("asks"),
        "fp",
        "first",
    )
    rows = held.unionByName(asked).repartition("bucket", "shard")
    rows = rows.sortWithinPartitions("bucket", "shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, tree = None, {}, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "shard", "asks", "fp", "first")]
            for bucket, part, asks, fp, th in zip(*columns):
                fp &= (1 << 64) - 1
                if (bucket, part) != key:
                    key, first, tree = (bucket, part), {}, None
                if not asks:
                    first[fp] = th
                    continue
                tree = tree or BKTree(list(first))
                near = [first[x] for x in tree.nearest(fp, SIMILAR_RADIUS, NEAREST)]
                out += [(min(th, x), max(th, x)) for x in near]
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_batches(rows, search, "a long, b long").unionByName(stars).distinct()


def several_roots(entries: DataFrame) -> DataFrame:
    """The entries of shingles whose texts are not yet all in one group."""
    shingle = Window.partitionBy("w")
    made = entries.withColumn("low", F.min("root").over(shingle)).withColumn("high", F.max("root").over(shingle))
    return made.where("low < high").select("w", "th", "n", "rem", "root")


def enough(rem_a, rem_b, n_a, n_b, similarity: float):
    """Whether sets can be similar whose first common shingle leaves so many of each to come.

    Similarity t asks for t / (1 + t) of both sizes in common. Numbers or columns alike.
    """
    least = (n_a + n_b) * (similarity / (1 + similarity)) - SLACK
    return (rem_a >= least) & (rem_b >= least)


def neighbours(entries: DataFrame, similarity: float) -> DataFrame:
    """(a, b, ra, rb): one text of each group in a bucket with one of the group that follows."""
    one = entries.groupBy("w", "root").agg(F.max(F.struct("rem", "n", "th")).alias("x"))
    before = Window.partitionBy("w").orderBy("x.n", "root")
    both = one.withColumn("y", F.lag("x").over(before)).withColumn("yr", F.lag("root").over(before))
    both = both.where(enough(F.col("x.rem"), F.col("y.rem"), F.col("x.n"), F.col("y.n"), similarity))
    return both.select(
        F.col("x.th").alias("a"), F.col("y.th").alias("b"), F.col("root").alias("ra"), F.col("yr").alias("rb")
    ).dropDuplicates(["a", "b"])


def crossing(entries: DataFrame, similarity: float, tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b, ra, rb): all texts of different groups that can be similar, by prefixes.

    Two similar texts share a shingle of their prefixes, and behind the first one they share
    enough is left of both. Large buckets are cut into shards that all their members ask.
    """
    sizes = entries.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / tree_size).alias("shards"))
    members = entries.join(sizes, "w")
    shard = F.pmod(F.xxhash64("th"), F.col("shards"))
    rest = ["th", "n", "rem", "root"]
    held = members.select("w", shard.alias("shard"), F.lit(0).alias("asks"), *rest)
    shards = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    asked = members.select("w", shards.alias("shard"), F.lit(1).alias("asks"), *rest)
    rows = held.unionByName(asked).repartition("w", "shard").sortWithinPartitions("w", "shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kept, block = None, [], None

        def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
            columns = np.concatenate(found, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["a", "b", "ra", "rb"])

        for batch in batches:
            found, size = [], 0
            columns = [batch.column(c).to_pylist() for c in ("w", "shard", "asks", *rest)]
            for w, part, asks, th, n, rem, root in zip(*columns):
                if (w, part) != key:
                    key, kept, block = (w, part), [], None
                if not asks:
                    kept.append((th, n, rem, root))
                    continue
                if block is None:
                    block = np.array(kept, np.int64).reshape(-1, 4).T
                ths, ns, rems, roots = block
                hit = (ths > th) & (roots != root) & enough(rem, rems, n, ns, similarity)
                if hit.any():
                    others = ths[hit]
                    found.append(
                        np.stack([np.full(len(others), th), others, np.full(len(others), root), roots[hit]])
                    )
                    size += len(others)
                    if size > 100_000:
                        yield batch_of(found)
                        found, size = [], 0
            if found:
                yield batch_of(found)

    return map_batches(rows, search, "a long, b long, ra long, rb long").dropDuplicates(["a", "b"])


def verified(pairs: DataFrame, texts_: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` whose texts a and b are similar, judged on the whole texts."""
    columns = pairs.columns
    left = pairs.join(texts_.select(F.col("th").alias("a"), F.col("z").alias("za")), "a")
    both = left.join(texts_.select(F.col("th").alias("b"), F.col("z").alias("zb")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()

        def shingles(z) -> np.ndarray:
            return np.unique(shingle_hashes(unpress.decompress(z.as_py()), SIMILAR_WORDS))

        for batch in (piece for whole in batches for piece in slices(whole, "za", PRESSED_BYTES)):
            near = []
            for za, zb in zip(batch.column("za"), batch.column("zb")):
                a, b = shingles(za), shingles(zb)
                common = len(np.intersect1d(a, b, assume_unique=True))
                near.append(common >= similarity * (len(a) + len(b) - common))
            yield batch.select(columns).filter(pa.array(near, pa.bool_()))

    return map_batches(both.select(*columns, "za", "zb"), verify, ", ".join(f"{c} long" for c in columns))


def similar_roots(texts_: DataFrame, similarity: float, folder: str | None = None) -> DataFrame:
    """(th, root): the group of each text (th, z), one root for all that links reach.

    Nearest fingerprints give links for most of each group. Then texts that are still apart
    and share a shingle of their prefixes are compared: first one text of each group with
    one of the next, for as long as that joins groups, then all that are left. So no link
    between two groups is missed, and a large group costs no comparison of all its pairs.
    """
    signs = signatures(texts_, similarity, folder)
    pairs = stored(similar_candidates(signs), "candidates", folder)
    joined = components(verified(pairs, texts_, similarity), folder).withColumnRenamed("node", "th")
    roots = texts_.select("th").join(joined, "th", "left").withColumn("root", F.coalesce("root", "th"))
    roots = stored(roots, "roots", folder)
    shingle = Window.partitionBy("w")
    entries = signs.select("th", "n", F.posexplode("prefix").alias("place", "w"))
    entries = entries.select("w", "th", "n", (F.col("n") - F.col("place")).alias("rem"))
    entries = entries.withColumn("low", F.min("th").over(shingle)).withColumn("high", F.max("th").over(shingle))
    entries = entries.where("low < high").drop("low", "high").join(roots, "th")
    entries = stored(several_roots(entries), "shared-shingles", folder)
    rounds = ROUNDS
    while rounds >= 0 and not joins_none(entries):
        whole = rounds == 0
        found = crossing(entries, similarity) if whole else neighbours(entries, similarity)
        links = stored(verified(stored(found, "crossing", folder), texts_, similarity), "crossing-links", folder)
        if joins_none(links):
            rounds = -1 if whole else 0
            continue
        rounds -= 1
        moved = components(links.select(F.col("ra").alias("a"), F.col("rb").alias("b")), folder)
        moved = stored(moved.select(F.col("node").alias("root"), F.col("root").alias("joint")), "joined", folder)
        roots = stored(_moved(roots, moved), "roots", folder)
        entries = stored(several_roots(_moved(entries, moved)), "shared-shingles", folder)
    return roots


def joins_none(rows: DataFrame) -> bool:
    return not rows.take(1)


def _moved(rows: DataFrame, moved: DataFrame) -> DataFrame:
    return rows.join(moved, "root", "left").withColumn("root", F.coalesce("joint", "root")).drop("joint")


def similar_groups(
    docs: DataFrame, folder: str | None = None, similarity: float = SIMILARITY
) -> DataFrame:
    """(key, th, kept, copies): the rows of ``docs`` and whether they stay, one of each group.

    Groups are joined by all pairs of texts whose sets of five-word shingles have this
    similarity or more, verified on the whole texts. The row with the smallest id stays,
    null ids last. Rows equal in id and text are one row here, ``copies`` is their number; of
    these the caller has to keep one.
    """
    rows = with_text_hash(texts(docs)).withColumn("key", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    texts_ = stored(pressed(rows).groupBy("th").agg(F.first("z").alias("z")), "texts", folder)
    roots = similar_roots(texts_, similarity, folder)
    grouped = stored(rows.select("key", "th").join(roots, "th"), "groups", folder)
    first = grouped.groupBy("root").agg(F.min(F.struct("key", "th")).alias("first"))
    copies = grouped.groupBy("key", "th", "root").agg(F.count(F.lit(1)).alias("copies"))
    return copies.join(first, "root").select(
        "key", "th", F.struct("key", "th").eqNullSafe(F.col("first")).alias("kept"), "copies"
    )


def with_text_hash(docs: DataFrame) -> DataFrame:
    """Add ``th``, the hash of the text that ``similar_groups`` names it by."""
    return docs.withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), work_folder(spark))
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return groups.select("doc_id", shown, "component_id")


QUERIES = {"op2_simhash_bk": query}
ORACLES = {}
