"""Best-fit packing with certified bin counts.

Texts become token ids (byte-level BPE from a tokenizer file, as bpe_tree encodes it, then an end id).
A document longer than a sequence is cut into whole-sequence pieces, the first
piece being the shorter one; whole pieces are sequences of their own. The rest is
packed by best-fit decreasing inside partitions of a bounded number of pieces.
Each partition has a lower bound on its bins from dual-feasible functions. A
partition whose bin count equals its bound is certified and done; the others
(those with gaps) exchange their pieces: they are dealt anew into other
partitions and packed again; a deal is kept if it lowers their sum of bins, and the exchange ends when all are certified or
two deals in a row close no gap.

Scale: only ids' checksums and lengths leave the tokenizing tasks; texts are never
shuffled. Partitions hold ``part_pieces`` pieces each on average, whatever the
table's size. The number of partitions with gaps falls from round to round.

Defined results: a null or empty text is one piece, the end id; strings of special tokens are their id; repeated rows (also with equal or null ids) are
packed as separate documents; a text of any length is cut into as many pieces as it needs, in time linear in it; an empty table has no sequences; columns other than doc_id and text are not read. Sequence ids are
unique numbers without further meaning.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe_tree import codec, tokenizer_path
from ledgerline.llm.common import materialize, table

CAPACITY = 2048
END_ID = 0
PART_PIECES = 20_000
FAILED_DEALS = 2  # deals in a row that close no gap before the exchange ends


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs``."""
    tail = np.array([end_id], "<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path)
        for b in batches:
            of, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(b.column(1)):
                ids = tokens.encode(text.as_py() or "") + tail
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, at in enumerate([0, *range(first, n, capacity)]):
                    size = capacity if k else first
                    of.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(of, pa.int32())), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tokenize, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by dual-feasible functions: the sizes
    themselves, f_t (sizes over capacity - t count whole, sizes under t count
    nothing) for every t, and u_k (sizes rounded to k-ths) for small k."""
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1).astype(np.int64), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """The same bound from the number of pieces of each length (0 to ``capacity``)."""
    if not counts.any():
        return 0
    sizes = np.arange(capacity + 1, dtype=np.int64)
    total, number = np.cumsum(counts * sizes), np.cumsum(counts)
    best = -(-int(total[-1]) // capacity)
    t = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for k in range(1, 21):
        # (k + 1) * x / c: an exact multiple keeps its size, others are rounded down to k-ths
        scaled = (k + 1) * sizes
        units = np.where(scaled % capacity == 0, sizes * k, scaled // capacity * capacity)
        best = max(best, -(-int((units * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece, and the number of bins. Bins are kept by free
    space (at most ``capacity`` values), so a piece costs one search."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_free: dict[int, list[int]] = {}
    frees: list[int] = []
    n_bins = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect_left(frees, size)
        if at < len(frees):
            free = frees[at]
            b = by_free[free].pop()
            if not by_free[free]:
                del by_free[free], frees[at]
        else:
            free, b = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = b, capacity - free
        if rest := free - size:
            if rest not in by_free:
                by_free[rest] = []
                insort(frees, rest)
            by_free[rest].append(b)
    return bins, offsets, n_bins


def pack_partitions(rest: DataFrame, parts: int, round_no: int, capacity: int) -> DataFrame:
    """Deals ``rest`` into ``parts`` and packs each: adds part, bin, offset, n_bins, bound."""
    # the deal follows the row's values, so a lost task's rerun deals alike
    dealt = rest.drop("part", "bin", "offset", "n_bins", "bound").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece", "start", "length", "ids_crc32", F.lit(round_no)), F.lit(max(1, parts)))
    )

    def pack(pieces: pa.Table) -> pa.Table:
        # in the order of the values: a rerun packs alike, whatever order the rows came in
        pieces = pieces.sort_by([(c, "ascending") for c in ("length", "ids_crc32", "doc_id", "piece")])
        lengths = pieces["length"].to_numpy()
        bins, offsets, n = best_fit_decreasing(lengths, capacity)
        same = np.ones(len(lengths), np.int64)
        added = {"bin": bins, "offset": offsets, "n_bins": same * n, "bound": same * lower_bound(lengths, capacity)}
        for name, values in added.items():
            pieces = pieces.append_column(name, pa.array(values, pa.int64()))
        return pieces

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.groupBy("part").applyInArrow(pack, f"{fields}, bin long, offset long, n_bins long, bound long")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, failed_deals: int = FAILED_DEALS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize(pieces(docs, path or tokenizer_path(), capacity, end_id), "pack-pieces")
    out_cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = cut.filter(F.col("length") == capacity)
    # sequence ids: 2k for whole pieces, odd numbers for packed bins, each deal with a range of its own
    done = [whole.withColumns({"sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")}).select(*out_cols)]
    rest = cut.filter(F.col("length") < capacity)
    n = rest.count()
    if not n:
        return done[0]
    parts = -(-n // part_pieces)
    taken = 0  # numbers of partitions of earlier deals

    def finish(packed: DataFrame) -> None:
        number = ((F.col("part") + taken) * (1 << 24) + F.col("bin")) * 2 + 1
        done.append(packed.withColumn("sequence_id", number.cast("long")).select(*out_cols))

    packed = materialize(pack_partitions(rest, parts, 0, capacity), "pack-round0")
    deal = failed = 0
    while failed < failed_deals:
        tally = packed.select("part", "n_bins", "bound").distinct().filter("n_bins > bound").agg(F.count("*"), F.sum("n_bins")).first()
        gaps, bins = tally[0], tally[1]
        if gaps < 2:  # certified, or no other partition to exchange with
            break
        deal += 1
        again = materialize(pack_partitions(packed.filter("n_bins > bound"), gaps, deal, capacity), f"pack-round{deal}")
        if again.select("part", "n_bins").distinct().agg(F.sum("n_bins")).first()[0] >= bins:
            failed += 1  # closes no gap: the earlier packing stays, and is dealt anew
            continue
        finish(packed.filter("n_bins <= bound"))
        taken, parts, failed, packed = taken + parts, gaps, 0, again
    finish(packed)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences used, sequences that any packing of these pieces needs), over the whole table.
    As many numbers as there are lengths reach the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in packed.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return packed.select("sequence_id").distinct().count(), bound_of_counts(counts, capacity)


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
