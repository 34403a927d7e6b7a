"""Helpers shared by the corpus operators: reading a table, scratch tables, and
word / shingle hashing over whole batches of texts with numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. In UTF-8 all of these
are single bytes that never occur inside another character, so the hashing
works on bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import materialize, scratch_path  # noqa: F401 - re-used by the operators

CHUNK_BYTES = 2 << 20  # texts hashed in one numpy pass (a longer text is a pass of its own)

_MUL = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(int(_MUL), -1, 1 << 64))
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # lower-cases A-Z
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (murmur3's)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("mul", ())) < n:
        for name, base in (("mul", _MUL), ("inv", _INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["mul"], _powers["inv"]


def byte_chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``limit`` bytes each."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of each text, and each text's offset into them
    (one more offset than texts)."""
    blob = np.frombuffer(b"\n".join(texts), np.uint8)
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=bounds[1:])
    if not blob.size:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    edge = np.diff((~_SPACE[blob]).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    mul, inv = _power(blob.size)
    sums = np.zeros(blob.size + 1, np.uint64)
    np.cumsum(_BYTE[blob] * mul[: blob.size], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inv[starts]), np.searchsorted(starts, bounds)


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each run of ``width`` words of each text, repeats
    included, and each text's offset. A text with fewer words has one run, all
    of its words; a text without words has none."""
    words, at = word_hashes(texts)
    counts = np.diff(at)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out_at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(runs, out=out_at[1:])
    first = np.repeat(at[:-1] - out_at[:-1], runs) + np.arange(out_at[-1])  # each run's first word
    length = np.repeat(np.minimum(counts, width), runs)
    acc = length.astype(np.uint64)
    for k in range(width):
        on = length > k
        step = acc[on] * _SHINGLE + words[first[on] + k]
        acc[on] = step
    return mix64(acc), out_at


def utf8(values: list[str | None]) -> list[bytes]:
    """Null counts as empty. Lone surrogates (not valid UTF-8) can't come from Spark."""
    return [(v or "").encode() for v in values]
