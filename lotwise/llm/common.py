"""Shared pieces of the text operators: tables, stored intermediates, bounded batches."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import shared_path

#: Python works on slices of about so many bytes of text, whatever size Spark's batches have.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, null text as empty: other columns can't clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def stored(df: DataFrame, name: str, folder: str | None, compression: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared folder and read it back: a cut that survives lost executors."""
    path = shared_path(df.sparkSession, name, folder)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes; a longer row stands alone."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
    schema: str,
    column: str = "text",
) -> DataFrame:
    """Arrow map over slices of bounded size; ``make`` runs once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for piece in slices(batch, column):
                out = step(piece)
                if out is not None and out.num_rows:
                    yield out

    return map_batches(df, run, schema)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Arrow map over whole batches, with this package at hand on every executor."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors the code of the repository, whatever their Python path is."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        stage = Path(tempfile.mkdtemp(prefix="lotwise-code-"))
        for package in ("lotwise", "workload"):
            shutil.copytree(
                root / package, stage / "code" / package, ignore=shutil.ignore_patterns("__pycache__")
            )
        context.addPyFile(shutil.make_archive(str(stage / "lotwise-code"), "zip", stage / "code"))
        _shipped.add(context.applicationId)


def utf8(column: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, z): documents with a hash of the text and the text compressed.

    ``doc_id`` and ``th`` together name a row; rows equal in both have the same text.
    Compressed texts make the shuffles of whole texts about a third cheaper.
    """

    def make():
        press = zstandard.ZstdCompressor(level=3)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = utf8(batch.column("text"))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(signed([xxhash.xxh3_64_intdigest(x) for x in raw])),
                    pa.array([press.compress(x) for x in raw], pa.binary()),
                ],
                ["doc_id", "th", "z"],
            )

        return step

    return map_slices(texts(docs), make, "doc_id long, th long, z binary")


class Stretch:
    """Growing flat store of runs of ids."""

    def __init__(self):
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        used, more = int(self.ends[-1]), len(flat)
        if used + more > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(used + 2 * more, np.int32)])
        self.flat[used : used + more] = flat
        self.ends = np.concatenate([self.ends, used + np.cumsum(sizes, dtype=np.int64)])

    def runs(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these runs in a row, and the size of each run."""
        begins = self.ends[which]
        sizes = self.ends[which + 1] - begins
        upto = np.cumsum(sizes)
        return self.flat[np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins - upto + sizes, sizes)], sizes


def text_hash(raw: bytes) -> int:
    """The ``th`` of a text, as a signed 64-bit integer."""
    return int(signed([xxhash.xxh3_64_intdigest(raw)])[0])


def signed(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` values, by doubling; empty if there are too few.

    ``values`` are unsigned 64-bit integers. A run's hash depends on its values alone.
    """
    if len(values) < length:
        return np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    have: np.ndarray | None = None
    done, power, level, span = 0, base, values.astype(np.uint64), 1
    with np.errstate(over="ignore"):
        while True:
            if length & span:
                if have is None:
                    have = level
                else:
                    n = len(values) - done - span + 1
                    have = have[:n] * power + level[done : done + n]
                done += span
            if span * 2 > length:
                return mixed(have)
            level = level[:-span] * power + level[span:]
            power, span = power * power, span * 2


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish hashes so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(31))
        h = h * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


def sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """Minimum or maximum of all runs of ``width`` values, by doubling."""
    have, span = values, 1
    while span * 2 <= width:
        have = pick(have[:-span], have[span:])
        span *= 2
    rest = width - span
    return pick(have[: len(have) - rest], have[rest:]) if rest else have
