"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once; the top bits of the hash choose a bin and
each bin keeps its smallest hash. Empty bins are filled by optimal
densification: a bin tries other bins in an order given by a hash of its number
until it meets a filled one (the same order for every document, so equal bins
stay equal). A fingerprint packs the low bits of the bins. Two fingerprints'
share of equal bins, corrected for bits that agree by chance, estimates the
shingle sets' Jaccard similarity.

Scale: a fingerprint needs its own text only. To compare each document with the
next one by id, rows are range-partitioned by id once (with the first row of the
following range copied to the end of each range) and streamed in order, so no
task holds more than a batch and no window spans the table.

Defined results: a null text is empty; a text without words has the empty set,
whose fingerprint equals that of every other such text (likeness 1) and is unlike
all others (0); a text with fewer words than a shingle is one shingle. Rows with a
null id come last; rows with equal ids are ordered by text. A text is hashed whole, in time linear in its length and about 35
bytes a byte of it. An empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import byte_chunks, mix64, shingle_hashes, table, utf8

BINS = 256  # a power of two
BITS = 4
WORDS = 5
NO_WORDS = ""
# The following lay rows out and change no result.
RANGE_ROWS = 2_000  # rows of an id range, on average and where there are enough partitions
RANGES_PER_PARTITION = 4
KNOTS = 256
SLICE_ROWS = 512


def _donors(bins: int) -> Iterator[np.ndarray]:
    """For each attempt, the bin that every bin looks at."""
    attempt = 0
    while True:
        attempt += 1
        yield (mix64(np.arange(bins, dtype=np.uint64) + np.uint64(attempt << 20)) % np.uint64(bins)).astype(np.int64)


def signatures(texts: list[bytes], bins: int = BINS, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(densified bins of each text, whether it has any word)."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    hashes, at = shingle_hashes(texts, words)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    sig = np.full(len(texts) * bins, none, np.uint64)
    np.minimum.at(sig, doc * bins + (hashes >> shift).astype(np.int64), hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    sig = sig.reshape(len(texts), bins)
    filled = sig != none
    some = filled.any(1)
    out = sig.copy()
    row, empty = np.nonzero(~filled & some[:, None])
    for donor in _donors(bins):
        if not len(row):
            break
        found = donor[empty]
        hit = filled[row, found]
        out[row[hit], empty[hit]] = sig[row[hit], found[hit]]
        row, empty = row[~hit], empty[~hit]
    return out, some


def packed_bits(sig: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low ``bits`` of each bin, as bytes. A bin's number is mixed in first, so
    that copies of one value in several bins agree by chance independently."""
    low = mix64(sig ^ mix64(np.arange(sig.shape[1], dtype=np.uint64) + np.uint64(1))) & np.uint64((1 << bits) - 1)
    flat = ((low[..., None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(flat.reshape(len(sig), -1), axis=1)


def fingerprints(texts: list[bytes], bins: int = BINS, bits: int = BITS, words: int = WORDS) -> list[str]:
    """Lowercase hex of the packed bits; empty for a text without words."""
    out: list[str] = []
    for i, j in byte_chunks(texts):
        sig, some = signatures(texts[i:j], bins, words)
        out += [p.tobytes().hex() if s else NO_WORDS for p, s in zip(packed_bits(sig, bits), some, strict=True)]
    return out


def likeness(a: str, b: str, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints: the share of equal bins
    without those that agree by chance."""
    if not a or not b:
        return float(a == b)
    x = np.frombuffer(bytes.fromhex(a), np.uint8) ^ np.frombuffer(bytes.fromhex(b), np.uint8)
    same = 1.0 - np.unpackbits(x).reshape(-1, bits).any(1).mean()
    chance = 0.5**bits
    return float(max(0.0, (same - chance) / (1.0 - chance)))


def id_ranges(docs: DataFrame, n_ranges: int) -> Column:
    """The number of each row's id range, ranges going down the ids (null ids are in
    the last). Quantiles (at most KNOTS numbers on the driver) split the ids; each
    part between two quantiles is split evenly."""
    knots = min(KNOTS, n_ranges)
    at = docs.agg(F.percentile_approx("doc_id", [i / knots for i in range(knots + 1)], 1000)).first()[0]
    if not at:
        return F.lit(0)
    cuts = sorted(set(at))
    fine = -(-n_ranges // knots)
    x = F.col("doc_id")

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            first, width = cuts[lo], (cuts[lo + 1] if lo + 1 < len(cuts) else cuts[lo] + 1) - cuts[lo]
            inside = F.floor((x - first).cast("double") * fine / F.lit(float(width)))
            return F.lit(lo * fine) + F.least(F.greatest(inside, F.lit(0)), F.lit(fine - 1))
        mid = (lo + hi + 1) // 2
        return F.when(x < cuts[mid], tree(lo, mid - 1)).otherwise(tree(mid, hi))

    last = F.lit(len(cuts) * fine)
    return F.when(x.isNull(), last).otherwise(last - tree(0, len(cuts) - 1))


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(range, copy, doc_id, text), sorted down the ids inside each range: every row
    once (copy false), and behind the last row of a range the following range's first
    row (copy true; behind the last range the very first row)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    most = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(1, min(most, docs.count() // range_rows))
    rows = docs.withColumn("range", id_ranges(docs, n_ranges).cast("long"))
    heads = rows.groupBy("range").agg(F.max("doc_id").alias("head"))
    down = Window.orderBy("range")
    heads = heads.select("range", "head", F.coalesce(F.lag("range").over(down), F.max("range").over(Window.partitionBy())).alias("to"))
    # at most RANGES_PER_PARTITION + KNOTS rows for each shuffle partition's worth of ranges
    rows = rows.join(F.broadcast(heads), "range")
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))
    first = F.struct(F.col("to").alias("range"), F.lit(True).alias("copy"))
    rows = rows.withColumn("place", F.explode(F.when(F.col("doc_id").eqNullSafe(F.col("head")), F.array(own, first)).otherwise(F.array(own))))
    rows = rows.select("place.range", "place.copy", "doc_id", "text")
    return rows.repartition("range").sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text")


def edited(text: str, following: str) -> str:
    """``text`` whose last half (rounded down) is replaced by as much of ``following``'s start."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, bins: int = BINS, bits: int = BITS, words: int = WORDS) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next document is the one with the next smaller id;
    after the last comes the first."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, whose next row is still to come
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS).to_pydict()
                prints = fingerprints(utf8(part["text"]), bins, bits, words)
                pairs = []
                for row in zip(part["range"], part["copy"], part["doc_id"], part["text"], prints, strict=True):
                    if held and not held[1] and held[0] == row[0]:
                        pairs.append((held, row))
                    held = row
                changed = [edited(a[3], b[3]).encode() for a, b in pairs]
                marks = fingerprints(changed, bins, bits, words)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([a[2] for a, _ in pairs], id_type),
                    "n_chars": pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
                    "fingerprint": pa.array([a[4] for a, _ in pairs], pa.string()),
                    "edited_fingerprint": pa.array(marks, pa.string()),
                    "near_edited": pa.array([likeness(a[4], m, bits) for (a, _), m in zip(pairs, marks, strict=True)], pa.float64()),
                    "near_next": pa.array([likeness(a[4], b[4], bits) for a, b in pairs], pa.float64()),
                })

    id_name = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    out = f"doc_id {id_name}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs).mapInArrow(compare, out)


def query(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))
