"""Helpers shared by the operators: inputs, words, vectorised hashes, worker files."""

from __future__ import annotations

import ctypes
import functools
import hashlib
import mmap
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

#: A word is a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"
#: Texts are handled in slices of about so many bytes, whatever Spark's batch size is.
SLICE_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def _package_zip() -> str:
    root = Path(__file__).resolve().parents[2]
    path = Path(tempfile.mkdtemp(prefix="workwindow-code-")) / "workwindow_code.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted((root / "workwindow").rglob("*.py")):
            out.write(source, source.relative_to(root))
    return str(path)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run, once a session."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_package_zip())
        _shipped.add(context.applicationId)


def width(spark: SparkSession) -> int:
    """Tasks that a shuffle by hand should have: what the session is set to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


@functools.cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # a C library without it
        return lambda _: None


def parts_of(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """All slices of all batches of a task. Python workers live on after a task, so at
    its end what is free goes back to the system."""
    for batch in batches:
        yield from slices(batch, column, limit)
        del batch
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of ``column``, one row at least."""
    if not batch.num_rows:
        return
    _, offsets = text_buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; null counts as empty."""
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(
    1, 1 << 63, 256, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte range; one pass of prefix sums serves all of them. The length
    goes in as well."""
    power, inverse = _powers_to(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * power[: len(data)], out=prefix[1:])
    hashes = (prefix[ends] - prefix[starts]) * inverse[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of all rows start and end; no word reaches over a row's end."""
    inside = ~_IS_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cut[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all rows, and the first word of each row (one more at the end)."""
    starts, ends = word_ranges(data, offsets)
    return range_hashes(data, starts, ends), np.searchsorted(starts, offsets)


_GRAM = [np.uint64(pow(0xC2B2AE3D27D4EB4F, k + 1, 1 << 64)) for k in range(16)]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, at its first word; rows are not looked at."""
    total = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        total += words[k : k + len(total)] * _GRAM[k]
    return mix(total)


def runs_in_rows(first: np.ndarray, n: int) -> np.ndarray:
    """The places of all runs of ``n`` words that lie in one row, given each row's first word."""
    inside = np.ones(max(0, int(first[-1]) - n + 1), bool)
    for k in range(1, n):
        at = first[1:-1] - k
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return np.flatnonzero(inside)


def twins(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur twice or more, and has it occurred before."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    repeated, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    repeated[order[1:]] = same
    later[order[1:]] = same
    repeated[order[:-1]] |= same
    return repeated, later


def shared_bytes(spark: SparkSession, name: str, content: bytes) -> str:
    """Ship bytes of a bounded size to every executor as a file; returns its name.

    Executors fetch it when they start a task, also those that replace lost ones.
    """
    digest = hashlib.sha256(content).hexdigest()[:16]
    full = f"{name}-{digest}.bin"
    folder = os.path.join(tempfile.gettempdir(), f"workwindow-files-{os.getpid()}")
    path = os.path.join(folder, full)
    if not os.path.exists(path):
        os.makedirs(folder, exist_ok=True)
        with open(path, "wb") as out:
            out.write(content)
    spark.sparkContext.addFile(path)
    return full


def mapped_bytes(name: str) -> mmap.mmap:
    """Memory-map a file that ``shared_bytes`` has shipped, inside a task."""
    with open(SparkFiles.get(name), "rb") as file:
        return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
