"""Shared helpers: tables, scratch tables, size-checked broadcasts, hashing of words in numpy."""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.tables import discard
from orderloom.session import shared_dir


def ship(module: str) -> None:
    """Send a module's functions to the workers by value: they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)

def share(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of a class of this package, its class included.

    A broadcast names classes by their module, which workers need not have; these bytes hold
    them. `shared_value` unpacks them once in a worker process.
    """
    return spark.sparkContext.broadcast({"data": cloudpickle.dumps(value)})


def shared_value(shared: Broadcast) -> object:
    held = shared.value
    if "value" not in held:
        held["value"] = pickle.loads(held["data"])
    return held["value"]


# White space of the word contracts: space and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"
# A side of at most this many narrow rows (about 16 bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000
# Bytes of an Arrow batch, and of text that numpy works on at a time.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes too, so that very long rows do not add up in a worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "2147483647").rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


# Scratch tables made since each `finished` that is under way.
_MADE: list[list[str]] = []


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: a lost executor loses nothing."""
    path = shared_dir(df.sparkSession, label)
    if _MADE:
        _MADE[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`scratch`, and the number of its rows, counted by the tasks that write them."""
    seen = Observation()
    held = scratch(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return held, seen.get["n"]


def finished(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """`scratch` of what `build` returns; the scratch tables made on the way are then deleted."""
    return finished_counted(spark, label, build)[0]


def finished_counted(
    spark: SparkSession, label: str, build: Callable[[], DataFrame]
) -> tuple[DataFrame, int]:
    """`finished`, and the number of rows, counted by the tasks that write them."""
    seen = Observation()
    _MADE.append([])
    try:
        df = build().observe(seen, F.count(F.lit(1)).alias("n"))
        path = shared_dir(spark, label)
        df.write.parquet(path)
    finally:
        for made in _MADE.pop():
            discard(spark, made)
    if _MADE:
        _MADE[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


def small(df: DataFrame, rows: int | None = None, at_most: int | None = None) -> DataFrame:
    """Mark a narrow, already written table for broadcast if its counted rows allow it.

    Rows that the caller knows, or a known bound on them that allows it, are not counted again:
    each count is a query of its own, whose plan and threads take memory of the driver.
    """
    if rows is None and at_most is not None and at_most <= BROADCAST_ROWS:
        rows = at_most
    total = df.count() if rows is None else rows
    return F.broadcast(df) if total <= BROADCAST_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly where the scan gives fewer tasks than the cluster has cores."""
    return df.hint("rebalance")


# ---- numpy: word hashes over the bytes of many texts at once ---------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def row_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `most` bytes of text, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes):
        yield start, len(sizes)


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTE_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
# A-Z count as a-z.
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[65:91] = _BYTE_CODES[97:123]
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = _powers(base, max(n, SLICE_BYTES))
        if n <= SLICE_BYTES:
            _POWERS[int(base)] = held
    return held[:n]


def _piece_words(data: np.ndarray, starts: np.ndarray, lower: bool):
    white = _WHITE[data]
    begin = ~white
    begin[1:] &= white[:-1]
    first = starts[starts < len(data)]
    begin[first] = ~white[first]
    end = ~white
    end[:-1] &= white[1:]
    last = starts[(starts > 0) & (starts <= len(data))] - 1
    end[last] = ~white[last]
    s, e = np.flatnonzero(begin), np.flatnonzero(end)
    codes = (_LOWER_CODES if lower else _BYTE_CODES)[data]
    total = np.cumsum(codes * powers(_BASE, len(data)))
    upto = total[e]
    upto[s > 0] -= total[s[s > 0] - 1]
    return _mix(upto * powers(_BASE_INVERSE, len(data))[s]), s


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin.

    The words of row i are hashes[at[i]:at[i + 1]]. A text much longer than SLICE_BYTES is
    worked on in pieces that end at white space.
    """
    data, offsets = byte_view(column)
    hashes, begins, lo = [], [], 0
    while lo < len(data):
        hi = min(len(data), lo + 2 * SLICE_BYTES)
        if hi < len(data):
            while hi < len(data) and not _WHITE[data[hi]]:
                hi += 1
        inside = offsets[(offsets >= lo) & (offsets <= hi)] - lo
        h, s = _piece_words(data[lo:hi], inside, lower)
        hashes.append(h)
        begins.append(s + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


_STEPS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                     0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; of the whole sequence if it is shorter."""
    if len(words) == 0:
        return words
    n = min(width, len(words))
    out = np.full(len(words) - n + 1, np.uint64(n))
    for i in range(n):
        out = _mix(out * _STEPS[i % 5] + words[i : len(words) - n + 1 + i])
    return out
