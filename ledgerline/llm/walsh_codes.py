"""Vector code compression by integer Walsh-Hadamard transforms.

Components become integers (floor of ``scale`` times the value), vectors are cut into equal parts, and each part is coded
by the index of the nearest entry of its position's codebook. Distances are
never taken in floating point: parts and entries are padded with zeros to a power of two P and
transformed by the integer Walsh-Hadamard transform, which multiplies every squared distance by P. Squared
differences of coefficients are added in sequency order (few sign changes
first), for blocks of coefficients that double in size; an entry goes as soon as its partial sum exceeds the whole
sum of the entry that looked nearest on the first coefficient. What is left has whole sums, so the nearest entry and
its distance are exact. Numbers too large for 64 bits go through the same code as Python integers.

Codebooks start as the parts of the first vectors and are learnt by rounds of
assigning and averaging (rounded down) over all vectors.

Scale: every round reads the vectors once and shuffles one row of sums for each task, part, entry and
40-bit digit of the sums (pre-aggregated in the task, then by Spark); the codebooks (parts x entries x
width integers) are all that the driver holds and tasks receive. Nothing is grouped by vector or label but one sum for each label.

Defined results: vectors that are null or hold a null or non-finite component are dropped. A
vector shorter than the longest, or a length that the parts don't divide, counts as padded with zeros at its end;
empty vectors are kept, all zeros. Rows with a null id are kept and come last when
codebooks start; equal ids are ordered by their vectors, repeated rows count as often as they occur. Fewer rows than entries give as many entries as rows.
Distance ties go to the lower index. A distance (or a label's sum of them) beyond a 64-bit integer is null. An
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
DIGIT_BITS = 40  # sums leave a task in signed digits of so many bits: millions of tasks add up in 64
ROWS = 4_096  # rows coded at once


def usable(vector: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    return F.coalesce(F.forall(F.col(vector).cast("array<double>"), finite), F.lit(False))


# --- integers and transforms -------------------------------------------------------------


def floor_of(x: float, scale: int) -> int:
    """floor(scale * x), exactly: from 2**52 on x is an integer."""
    return int(x) * scale if abs(x) >= 2**52 else math.floor(x * scale)


def integers(rows: pa.Array, length: int, scale: int) -> np.ndarray:
    """(rows, length) integers of vectors, padded with zeros; 64-bit ones where all that is computed from them fits, else Python's."""
    rows = rows.cast(pa.list_(pa.float64()))
    sizes = np.diff(rows.offsets.to_numpy())
    values = rows.flatten().to_numpy(zero_copy_only=False)
    limit = 2**30 / max(1, padded(length)) / scale
    if not len(values) or np.abs(values).max() < limit:
        flat, out = np.floor(values * scale).astype(np.int64), np.zeros((len(rows), length), np.int64)
    else:
        flat, out = np.array([floor_of(float(x), scale) for x in values], object), np.zeros((len(rows), length), object)
    out[np.arange(length) < sizes[:, None]] = flat
    return out


def padded(width: int) -> int:
    return 1 << max(0, width - 1).bit_length()


def sequency_order(size: int) -> np.ndarray:
    """Natural indexes of the transform's coefficients by their number of sign changes: the bit-reversed Gray code."""
    k = np.arange(size)
    gray, out = k ^ (k >> 1), np.zeros(size, np.int64)
    for _ in range(size.bit_length() - 1):
        out, gray = (out << 1) | (gray & 1), gray >> 1
    return out


def transform(parts: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of the last axis, zero-padded, in sequency order."""
    width = parts.shape[-1]
    size = padded(width)
    out = np.zeros((*parts.shape[:-1], size), parts.dtype)
    out[..., :width] = parts
    half = 1
    while half < size:
        pairs = out.reshape(*out.shape[:-1], size // (2 * half), 2, half)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(out.shape)
        half *= 2
    return out[..., sequency_order(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each transformed part: the index of the nearest transformed entry (ties to the lower one) and their squared
    distance times the padded width."""
    size = x.shape[1]
    partial = (x[:, :1] - entries[None, :, 0]) ** 2
    guess = entries[partial.argmin(axis=1)]
    bound = ((x - guess) ** 2).sum(axis=1)
    rows, left = np.nonzero(partial <= bound[:, None])
    sums, at, step = partial[rows, left], 1, 1
    while at < size:
        to = min(size, at + step)
        sums = sums + ((x[rows, at:to] - entries[left, at:to]) ** 2).sum(axis=1)
        alive = sums <= bound[rows]
        rows, left, sums = rows[alive], left[alive], sums[alive]
        at, step = to, 2 * step
    # rows ascend, and a row's entries too; every row has kept its guess
    first = np.flatnonzero(np.diff(rows, prepend=-1))
    least = np.repeat(np.minimum.reduceat(sums, first), np.diff(first, append=len(rows))) if len(rows) else sums
    hits = np.flatnonzero(sums == least)
    picked = hits[np.unique(rows[hits], return_index=True)[1]]
    return left[picked], sums[picked]


# --- codebooks -------------------------------------------------------------------------------


@dataclass
class Codebooks:
    """entries[part][entry] is a list of ``width`` Python integers."""

    entries: list[list[list[int]]]
    width: int
    scale: int = SCALE

    @property
    def parts(self) -> int:
        return len(self.entries)

    def components(self) -> str:
        return ",".join(str(x) for part in self.entries for entry in part for x in entry)

    def transformed(self, dtype) -> np.ndarray:
        n = len(self.entries[0])
        return transform(np.array([x for p in self.entries for e in p for x in e], dtype).reshape(self.parts, n, self.width))

    def fits(self) -> bool:
        largest = max((abs(x) for p in self.entries for e in p for x in e), default=0)
        return largest * padded(self.width) < 2**30

    def assign(self, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of rows: integers (rows, parts, width), indexes (rows, parts) and squared distances (rows, parts)."""
        fits, size = self.fits(), padded(self.width)
        books = {np.dtype(object): self.transformed(object)} | ({np.dtype(np.int64): self.transformed(np.int64)} if fits else {})
        for at in range(0, len(vectors), ROWS):
            whole = integers(vectors.slice(at, ROWS), self.parts * self.width, self.scale)
            whole = whole if fits else whole.astype(object)
            parts = whole.reshape(len(whole), self.parts, self.width)
            x, book = transform(parts), books[whole.dtype]
            found = [nearest(x[:, p], book[p]) for p in range(self.parts)]
            yield parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1) // size


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int) -> Codebooks | None:
    """The parts of the first ``entries`` rows by id; None for an empty table. Two bounded values reach the driver."""
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    cut = []
    for p in range(parts):
        cut.append([])
        for r in rows:
            whole = [floor_of(x, scale) for x in r.vector] + [0] * (parts * width - len(r.vector))
            cut[-1].append(whole[p * width : (p + 1) * width])
    return Codebooks(cut, width, scale)


def digits(value: int) -> list[int]:
    sign, value, out = (1, -1)[value < 0], abs(value), []
    while value or not out:
        out.append(sign * (value & ((1 << DIGIT_BITS) - 1)))
        value >>= DIGIT_BITS
    return out


def one_round(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Assigns every part, and replaces each entry by the mean of its parts, rounded down; unused entries stay."""
    width = books.width
    names = [f"s{i}" for i in range(width)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_entries = len(books.entries[0])
        counts = np.zeros((books.parts, n_entries), np.int64)
        totals = np.zeros((books.parts, n_entries, width), object)
        for b in batches:
            for parts, index, _ in books.assign(b.column(0)):
                for p in range(books.parts):
                    order = np.argsort(index[:, p], kind="stable")
                    used, first, n = np.unique(index[order, p], return_index=True, return_counts=True)
                    counts[p, used] += n
                    if width:
                        totals[p, used] += np.add.reduceat(parts[order, p], first, axis=0).astype(object)
        rows = []
        for p, e in zip(*np.nonzero(counts), strict=True):
            split = [digits(x) for x in totals[p, e]]
            for d in range(max(map(len, split), default=1)):
                rows.append([int(p), int(e), d, int(counts[p, e]) if d == 0 else 0, *(x[d] if d < len(x) else 0 for x in split)])
        columns = ["part", "entry", "digit", "n", *names]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(columns))], names=columns)

    found = vectors.select("vector").mapInArrow(sums, ", ".join(f"{c} long" for c in ("part", "entry", "digit", "n", *names)))
    # as many rows as codebook entries and digits
    rows = found.groupBy("part", "entry", "digit").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect()
    counts: dict[tuple[int, int], int] = {}
    totals: dict[tuple[int, int], list[int]] = {}
    for r in rows:
        key = (r["part"], r["entry"])
        counts[key] = counts.get(key, 0) + r["n"]
        totals[key] = [t + (r[s] << (DIGIT_BITS * r["digit"])) for t, s in zip(totals.get(key, [0] * width), names, strict=True)]
    entries = [[[t // counts[p, e] for t in totals[p, e]] if (p, e) in counts else old for e, old in enumerate(part)] for p, part in enumerate(books.entries)]
    return Codebooks(entries, width, books.scale)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of usable vectors (columns id, vector); None for an empty table."""
    books = first_codebooks(vectors, parts, entries, scale)
    for _ in range(rounds if books else 0):
        books = one_round(vectors, books)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """The columns of usable vectors but the vector, with code (two hex digits for each part's index) and error."""
    kept = [c for c in vectors.columns if c != "vector"]
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields if f.name != "vector"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, errors = [], []
            for _, index, distance in books.assign(b.column(b.schema.get_field_index("vector"))):
                codes += [row.tobytes().hex() for row in index.astype(np.uint8)]
                errors += [e if e < 2**63 else None for e in map(int, distance.astype(object).sum(axis=1))]
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=[*kept, "code", "error"])

    return vectors.mapInArrow(coded, ", ".join([*types, "code string", "error long"]))


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code, error, label_error) of every usable row, and the codebooks. At most 256 entries."""
    vectors = embeddings.filter(usable("embedding")).select(
        F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("vector"))
    books = train(vectors, parts, entries, rounds, scale)
    if books is None:
        rows = vectors.select(F.col("id").alias("vec_id"), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return rows, None
    coded = materialize(encode(vectors, books), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.when((F.count(F.lit(1)) == F.count("error")) & (total < F.lit(str(2**63)).cast("decimal(38,0)")), total).cast("long")
    labels = coded.groupBy(F.col("label").alias("_label")).agg(whole.alias("label_error"))
    rows = coded.join(labels, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select(F.col("id").alias("vec_id"), "label", "code", "error", "label_error"), books


def query(spark, sf_dir: str) -> DataFrame:
    rows, books = compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256((books.components() if books else "").encode()).hexdigest()
    return rows.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle() -> str:
    """DuckDB SQL: plain squared distances, one pair of CTEs for each round."""
    ctes = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, embedding,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"dims AS (SELECT (max(len(v)) + {PARTS - 1}) // {PARTS} AS w FROM kept)",
        """padded AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn, vec_id, label,
            list_concat(v, list_transform(range(0, CAST(w * 8 - len(v) AS BIGINT)), lambda x: CAST(0 AS BIGINT))) AS v, w FROM kept, dims)""",
        f"cells AS MATERIALIZED (SELECT rn, vec_id, label, p, w, list_slice(v, p * w + 1, (p + 1) * w) AS v FROM padded, range({PARTS}) AS parts(p))",
        f"c0 AS MATERIALIZED (SELECT p, rn - 1 AS e, v FROM cells WHERE rn <= {ENTRIES})",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(f"""a{r} AS MATERIALIZED (SELECT x.rn, x.p, any_value(x.v) AS v, any_value(x.w) AS w,
            min({ENTRIES} * CAST(list_sum(list_transform(range(1, x.w + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS BIGINT) + c.e) AS best
            FROM cells x JOIN c{r} c ON x.p = c.p GROUP BY x.rn, x.p)""")
        if r < ROUNDS:
            ctes.append(f"""m{r} AS (SELECT p, best % {ENTRIES} AS e, i, sum(v[i]) AS s, count(*) AS n
                FROM a{r}, (SELECT unnest(range(1, w + 1)) AS i FROM dims) GROUP BY ALL)""")
            ctes.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.p, c.e, coalesce(any_value(n.v), any_value(c.v)) AS v FROM c{r} c
                LEFT JOIN (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{r} GROUP BY p, e) n
                ON c.p = n.p AND c.e = n.e GROUP BY c.p, c.e)""")
    ctes.append(f"""coded AS (SELECT rn, string_agg(printf('%02x', CAST(best % {ENTRIES} AS BIGINT)), '' ORDER BY p) AS code,
        CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rn)""")
    ctes.append(f"""digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS h FROM c{ROUNDS})""")
    return "WITH " + ",\n".join(ctes) + """
SELECT p.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY p.label) AS BIGINT) AS label_error, d.h AS codebooks_sha256
FROM padded p JOIN coded c ON p.rn = c.rn, digest d"""


ORACLE = oracle()
