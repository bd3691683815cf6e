"""Quality classifier: random-indexing word vectors and a small calibrated network.

Every token has a fixed sparse random index vector. The vector of a token is the sum of the
index vectors of its neighbours over the whole corpus, so tokens of like surroundings get
like vectors. Tokens are hashed to ``rows`` rows, a parameter: the table is broadcast and has
``rows`` + ``SHAPE_ROWS`` vectors of ``DIMS`` 32-bit numbers whatever the corpus, 19 MB by default.
Words that share a row share a vector; a caller with a larger vocabulary asks for more rows.
There are two streams: words, and shapes of words (``Word!!`` is ``Aa!``). A
document is the mean of its vectors in both streams and four plain statistics. A network of
two layers in numpy, trained on a bounded sample of labelled rows, scores it; a temperature
fitted on rows held back from training makes the scores probabilities.

Null text counts as empty; it is scored like any other. Labels, language, source and
doc_id are no inputs. Rows with a null label are not learnt from. Repeated rows each get a
score, equal texts the same. Other columns of the tables are not read. A text is read whole by
one task, which holds the numbers of its words and of about ``SLICE`` bytes of others.
An empty table of documents gives no scores; without labels all texts score alike.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import map_batches, mixed, ship, slices, table, texts

#: Rows of the table of vectors for words and for shapes, and entries of a vector.
ROWS = 1 << 16
SHAPE_ROWS = 1 << 13
DIMS = 64
WINDOW = 2
NONZERO = 2
BLOCKS = 32
#: Labelled rows that the network learns from at most; the smallest by a hash of doc_id.
TRAIN_ROWS = 20_000
HIDDEN = 32
EPOCHS = 40
THRESHOLD = 0.7
#: Bytes of text whose words are in memory as numbers at a time.
SLICE = 1_000_000


@functools.cache
def index_vectors(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of the index vectors of ``size`` rows.

    One row follows, for neighbours that repeat the token itself.
    """
    rng = np.random.default_rng(7)
    places = rng.integers(0, DIMS, (size + 1, NONZERO))
    return places, rng.choice([-1.0, 1.0], (size + 1, NONZERO))


@functools.cache
def classes() -> np.ndarray:
    """For each code point the one that stands for it in a shape."""
    letters = {"Lu": "A", "Lt": "A"} | dict.fromkeys(["Ll", "Lm", "Lo", "Mn", "Mc", "Me"], "a")
    letters |= dict.fromkeys(["Nd", "Nl", "No"], "0")
    points = range(sys.maxunicode + 1)
    return np.array([ord(letters.get(unicodedata.category(chr(x)), chr(x))) for x in points], np.uint32)


def sequence_hashes(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash for each of the sequences of these sizes that ``values`` holds in a row, none empty."""
    begins = np.cumsum(sizes) - sizes
    place = (np.arange(len(values)) - np.repeat(begins, sizes)).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        spread = mixed(values.astype(np.uint64) + place * np.uint64(0x9E3779B97F4A7C15))
    return mixed(np.add.reduceat(spread, begins))


def shapes(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of the shape of each word, from the code points of all words in a row.

    A shape has one letter for each run of capitals, of other letters, of digits, or of one
    and the same sign.
    """
    kinds = classes()[points]
    begins = np.cumsum(sizes) - sizes
    starts = np.ones(len(kinds), bool)
    starts[1:] = kinds[1:] != kinds[:-1]
    starts[begins] = True
    first = (np.cumsum(starts) - 1)[begins]
    runs = kinds[starts]
    return sequence_hashes(runs, np.diff([*first, len(runs)]))


def rows_of(words: pa.LargeStringArray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, row of its shape, and its length. Words are distinct, not empty."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    size = pc.utf8_length(words).to_numpy().astype(np.int64)
    word = sequence_hashes(raw, np.diff(ends)) % np.uint64(rows)
    form = shapes(points, size) % np.uint64(SHAPE_ROWS)
    return word.astype(np.int64), rows + form.astype(np.int64), size


def streams(column: pa.Array, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of all words and of all shapes, their documents, their codes and lengths."""
    lists = pc.ascii_split_whitespace(column.cast(pa.large_string()))
    parts = lists.flatten()
    doc = np.repeat(np.arange(len(column)), np.diff(lists.offsets.to_numpy()))
    real = pc.not_equal(parts, "")
    coded, doc = parts.filter(real).dictionary_encode(), doc[real.to_numpy(zero_copy_only=False)]
    codes = coded.indices.to_numpy()
    word, form, size = rows_of(coded.dictionary, rows)
    return word[codes], form[codes], doc, codes, size[codes]


def cooccurrence(column: pa.Array, rows: int = ROWS) -> np.ndarray:
    """Sums of the neighbours' index vectors for every row, as a flat array."""
    same_row = rows + SHAPE_ROWS
    places, signs = index_vectors(same_row)
    words, forms, doc, _, _ = streams(column, rows)
    keys, weights = [], []
    for ids in (words, forms):
        for step in range(1, WINDOW + 1):
            a, b, inside = ids[:-step], ids[step:], doc[:-step] == doc[step:]
            a, b = a[inside], b[inside]
            same = a == b
            for own, near in ((a, np.where(same, same_row, b)), (b, np.where(same, same_row, a))):
                for k in range(NONZERO):
                    keys.append(own * DIMS + places[near, k])
                    weights.append(signs[near, k])
    size = same_row * DIMS
    return np.bincount(np.concatenate(keys), np.concatenate(weights), size).astype(np.int64)


def word_vectors(docs: DataFrame, rows: int = ROWS) -> np.ndarray:
    """The table of vectors, from all texts of ``docs``; ``rows`` is a multiple of ``BLOCKS``.

    Tasks send their sums in blocks of rows; blocks are summed in two steps, one block at a
    time in a task. What comes back to the driver has the fixed size of the table.
    """

    if rows < 1 or rows % BLOCKS:
        raise ValueError(f"rows has to be a multiple of {BLOCKS}")
    size = rows + SHAPE_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * DIMS, np.int64)
        for batch in batches:
            for piece in slices(batch, limit=SLICE):
                total += cooccurrence(piece.column("text"), rows)
        yield _block_rows(list(enumerate(total.reshape(BLOCKS, -1))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("sums")):
                sums[block] = sums.get(block, 0) + np.frombuffer(zstandard.decompress(raw.as_py()), np.int64)
        if sums:
            yield _block_rows(sorted(sums.items()))

    schema = "block int, sums binary"
    parts = map_batches(texts(docs).select("text"), count, schema)
    parts = parts.withColumn("salt", F.spark_partition_id() % 16).repartition("block", "salt")
    parts = map_batches(parts.select("block", "sums"), add, schema).repartition("block")
    flat = np.zeros((BLOCKS, size * DIMS // BLOCKS))
    for row in map_batches(parts, add, schema).collect():
        flat[row["block"]] = np.frombuffer(zstandard.decompress(row["sums"]), np.int64)
    vectors = flat.reshape(size, DIMS)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1)
    for stream in (vectors[:rows], vectors[rows:]):
        used = np.abs(stream).sum(axis=1) > 0
        if used.any():
            stream[used] -= stream[used].mean(axis=0)
    return vectors.astype(np.float32)


def _block_rows(items: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    blocks, sums = [b for b, _ in items], [zstandard.compress(x.tobytes()) for _, x in items]
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(sums, pa.binary())], ["block", "sums"]
    )


def features(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of inputs for each text."""
    words, forms, doc, codes, sizes = streams(column, len(vectors) - SHAPE_ROWS)
    n = len(column)
    counts = np.bincount(doc, minlength=n).astype(np.float64)
    out = np.zeros((n, 2 * DIMS + 4), np.float32)
    some = np.flatnonzero(counts > 0)
    if len(some):
        ends = np.cumsum(counts[some]).astype(np.int64).tolist()
        for i, a, b in zip(some.tolist(), [0, *ends], ends):
            out[i, :DIMS] = vectors.take(words[a:b], axis=0).sum(axis=0) / (b - a)
            out[i, DIMS : 2 * DIMS] = vectors.take(forms[a:b], axis=0).sum(axis=0) / (b - a)
        again = np.zeros(len(doc), bool)
        again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
        pairs = np.unique(doc.astype(np.int64) << 32 | codes)
        stats = out[:, 2 * DIMS :]
        stats[:, 0] = np.log1p(counts)
        stats[:, 1] = np.bincount(pairs >> 32, minlength=n) / np.maximum(counts, 1)
        stats[:, 2] = np.bincount(doc, again, minlength=n) / np.maximum(counts, 1)
        stats[:, 3] = np.bincount(doc, sizes, minlength=n) / np.maximum(counts, 1)
    return out


def _features_of(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features in slices of bounded size."""
    batch = pa.RecordBatch.from_arrays([pc.fill_null(column, "")], ["text"])
    parts = [features(x.column("text"), vectors) for x in slices(batch, limit=SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, 2 * DIMS + 4), np.float32)


@dataclass
class Network:
    """Standardised inputs, a hidden layer, one output over a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return (hidden @ self.w2 + self.b2).astype(np.float64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the temperature on the last fifth."""
    inputs = x.shape[1]
    fifth = np.arange(len(x)) % 5 == 4
    tx, ty = (x[~fifth], y[~fifth]) if len(x) >= 10 else (x, y)
    rng = np.random.default_rng(3)
    mean = tx.mean(axis=0) if len(tx) else np.zeros(inputs)
    scale = tx.std(axis=0) + 1e-3 if len(tx) else np.ones(inputs)
    net = Network(
        mean, scale,
        rng.normal(0, inputs**-0.5, (inputs, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN), 0.0,
    )
    if not len(tx):
        return net
    z = (tx - mean) / scale
    p = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rate = 3e-3 * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = order[at : at + 128]
            a = z[rows]
            h = np.tanh(a @ p[0] + p[1])
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -60, 60))) - ty[rows]) / len(rows)
            gh = np.outer(g, p[2]) * (1 - h * h)
            grads = [a.T @ gh + 1e-3 * p[0], gh.sum(axis=0), h.T @ g + 1e-3 * p[2], np.array([g.sum()])]
            t += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p[0], p[1], p[2], float(p[3][0])
    if len(x) >= 10:
        raw, truth = net.logits(x[fifth]), y[fifth]
        grid = np.exp(np.linspace(-1.5, 2.5, 81))
        losses = [np.mean(np.logaddexp(0, raw / t) - truth * raw / t) for t in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def is_held_out() -> Column:
    """Whether crc32 of the id as text is 2 mod 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, quality) of at most ``rows`` labelled documents that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    known = known.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~is_held_out())
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    found = texts(docs).join(F.broadcast(known), "doc_id")  # at most ``rows`` rows
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", F.xxhash64("text")).limit(rows)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, rows: int = ROWS):
    """Learn from ``docs`` and ``labels``; returns a function from a text column to its score."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(word_vectors(docs, rows))

    def inputs(column: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in _features_of(column, shared.value)], pa.binary())

    as_inputs = F.arrow_udf(inputs, "binary")
    known = (
        labelled_sample(docs, labels, train_rows)
        .select("doc_id", "quality", as_inputs("text").alias("x"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("quality", "ascending"), ("x", "ascending")])
    )
    order = np.argsort([xxhash.xxh32_intdigest(str(i)) for i in known["doc_id"].to_pylist()], kind="stable")
    x = np.frombuffer(b"".join(known["x"].to_pylist()), np.float32).reshape(-1, 2 * DIMS + 4)
    net = train(x[order].astype(np.float64), known["quality"].to_numpy().astype(np.float64)[order])

    def scores(column: pa.Array) -> pa.Array:
        return pa.array(net.score(_features_of(column, shared.value)), pa.float64())

    return F.arrow_udf(scores, "double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = fit(docs, table(spark, sf_dir, "labels"))
    made = texts(docs).select("doc_id", is_held_out().alias("held_out"), score("text").alias("score"))
    return made.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op9_quality": query}
ORACLES = {}
