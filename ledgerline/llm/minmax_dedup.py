"""Near-duplicate documents by min-max hashing, confirmed on full shingle sets.

Each document's shingles are hashed once; each of ``PERMUTATIONS`` cheap permutations
of the hashes gives two signature values, its minimum and its maximum, so half as
many permutations are evaluated as values are banded. Documents that agree in a
whole band share a bucket and are candidates.

1. Documents with equal shingle sets are one class; its smallest id stands for it.
2. In each bucket every class is paired with the bucket's smallest id, the pairs
   are confirmed on the full sets, and linked classes get a common label (connected
   components). A bucket costs pairs in proportion to its size, not to its square.
3. While buckets still hold several labels and it pays, their classes are dealt into small
   cells, anew in each round, and each class proposes a few partners of another label whose
   signatures agree most. A round confirms at most ``PROPOSALS`` pairs a class, and every link it
   finds joins two labels, so texts assembled from one stock of paragraphs come together
   in a few rounds, without all the pairs between them.
4. Classes of buckets that hold several labels even then are compared further, except for
   pairs that can't be similar by an exact prefix, position and size filter on their
   shingles, and for pairs whose signatures agree in far too few values. Large groups of
   near copies, or of texts around one common passage, leave few pairs there.

Nothing is capped: step 3 only decides which pairs step 4 need not look at. A pair just at the threshold is missed with the probability that it shares no
band, (1 - 0.85^4)^24 < 3e-8 (at 0.8: 4e-6), or that its signatures agree too little, about 1e-8.

Scale: signatures are written once and narrow; texts move only for documents in
buckets with several classes, and for the pairs that are confirmed.
Bucket sizes come from partial aggregates; a bucket with a third of all classes is
joined to its one leader, which AQE's skew join splits. Labels are spread by
large-star / small-star rounds, each written to the shared folder.

Defined results: a null text is empty; documents without words are linked with
nothing (n_shingles 0, kept); rows repeating an id are one document for linking; a row without
an id is linked with nothing, has a null component and is kept. A text is hashed whole, in time linear in its length and about 35
bytes a byte of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerline.llm.common import byte_chunks, fresh, materialize, mix64, shingle_hashes, table, utf8

PERMUTATIONS = 48
BAND_ROWS = 4
ORDER_SAMPLE, ORDER_LEAST = 8_000, 4
CELL_CLASSES = 16  # classes of a bucket that meet in one round, on average
PROPOSALS = 4  # partners a class proposes in one round
WORTH_TRYING = 50  # rounds go on while one of so many proposed pairs is a link
LOW_BITS = 0x1111111111111111


class Likeness(NamedTuple):
    """Documents are linked when 100 * intersection >= percent * union of their sets of
    distinct runs of ``words`` words."""

    words: int = 5
    percent: int = 80


def permutations(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def min_max(hashes: np.ndarray, at: np.ndarray, n: int = PERMUTATIONS) -> np.ndarray:
    """Signatures of the non-empty sets ``hashes[at[i]:at[i + 1]]``: n minima, then n maxima."""
    mul, add = permutations(n)
    out = np.empty((len(at) - 1, 2 * n), np.uint64)
    for k in range(n):
        x = hashes * mul[k] + add[k]
        x ^= x >> np.uint64(32)
        x *= mul[k]
        out[:, k] = np.minimum.reduceat(x, at[:-1])
        out[:, n + k] = np.maximum.reduceat(x, at[:-1])
    return out


def band_keys(signature: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit bucket per band. A band takes values ``bands`` apart, so a
    permutation's minimum and maximum are in different bands or far apart."""
    bands = signature.shape[1] // rows
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), bands)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r * bands : (r + 1) * bands])
    return key


def low_bits(signature: np.ndarray) -> np.ndarray:
    """Four mixed bits of each signature value, sixteen values to a number."""
    low = mix64(signature) & np.uint64(15)
    out = np.zeros((len(signature), signature.shape[1] // 16), np.uint64)
    for k in range(16):
        out |= low[:, k::16] << np.uint64(4 * k)
    return out


def distinct_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and offsets."""
    hashes, at = shingle_hashes(texts, words)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    order = np.lexsort((hashes, doc))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    counts = np.bincount(doc[new], minlength=len(texts))
    return hashes[new], np.concatenate([[0], np.cumsum(counts)])


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands, bits): size and 128-bit hash of the set, its buckets, and four bits of each signature value."""
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), utf8(b.column(1).to_pylist())
            for i, j in byte_chunks(texts):
                hashes, at = distinct_sets(texts[i:j], words)
                sizes = np.diff(at)
                some = np.flatnonzero(sizes)
                bands: list = [None] * (j - i)
                bits: list = [None] * (j - i)
                whole = np.zeros((2, j - i), np.uint64)
                if len(some):
                    begin = at[some]
                    signature = min_max(hashes, np.append(begin, at[-1]))
                    for k, bucket, low in zip(some.tolist(), band_keys(signature).view(np.int64), low_bits(signature).view(np.int64), strict=True):
                        bands[k], bits[k] = bucket, low
                    for k, salt in enumerate((np.uint64(1), np.uint64(1 << 40))):
                        whole[k, some] = np.add.reduceat(mix64(hashes + salt), begin)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(i, j - i).cast(id_type),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_a": pa.array(whole[0].view(np.int64), pa.int64()),
                    "set_b": pa.array(whole[1].view(np.int64), pa.int64()),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                    "bits": pa.array(bits, pa.list_(pa.int64())),
                })

    out = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, set_a long, set_b long, bands array<long>, bits array<long>"
    return docs.select("doc_id", "text").mapInArrow(sketch, out)


def compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(a, b, common, all) of ``pairs`` (a, b): the sizes of the intersection and the
    union of their full sets. The b side is joined first, so that a leader (a) that
    many pairs share moves with the last join only."""
    right = pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                left, right = (utf8(b.column(k).slice(at, 256).to_pylist()) for k in (2, 3))
                index = {t: i for i, t in enumerate(dict.fromkeys(left + right))}  # a leader's text is hashed once
                hashes, off = distinct_sets(list(index), words)
                sets = [hashes[off[i] : off[i + 1]] for i in range(len(index))]
                pair = [(sets[index[x]], sets[index[y]]) for x, y in zip(left, right, strict=True)]
                common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in pair]
                union = [len(x) + len(y) - n for (x, y), n in zip(pair, common, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 256), b.column(1).slice(at, 256), pa.array(common, pa.int64()), pa.array(union, pa.int64())], names=["a", "b", "common", "all"]
                )

    t = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(compare, f"a {t}, b {t}, common long, all long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over ``edges`` (a, b), by alternating
    large-star and small-star rounds until every node hangs on its label directly."""
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # large star: each node's larger neighbours are tied to its smallest one
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: each node's smaller neighbours, and the node, are tied to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "dedup-labels")
        twice = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
        onward = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi")
        if twice.union(onward).isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sketch = materialize(sketches(docs, like.words), "dedup-sketches")
    named = sketch.filter("n_shingles > 0 and doc_id is not null")
    of_class = ["set_a", "set_b", "n_shingles"]
    classes = materialize(named.groupBy(*of_class).agg(F.min("doc_id").alias("rep")), "dedup-classes")
    buckets = named.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *of_class])
    buckets = buckets.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader <> last").select("bucket", "leader")
    # classes in buckets with others, and each bucket's leader
    members = materialize(buckets.join(shared, "bucket").distinct(), "dedup-buckets")
    texts = docs.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    texts = materialize(texts, "dedup-texts")

    # rows that repeat an id and are in several classes: the id ties them
    repeated = named.groupBy("doc_id").agg(F.countDistinct(*of_class).alias("sets")).filter("sets > 1")
    ties = named.join(repeated, "doc_id").join(classes, of_class).filter("doc_id <> rep")
    ties = ties.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    pairs = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tried = materialize(pairs, "dedup-leaders")
    labels = components(linked(tried, texts, like).union(ties).distinct())
    edges = lambda: labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    signatures = named.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", *of_class]).select(F.col("doc_id").alias("node"), "bits").distinct()
    turn, asked, made = 0, 1, 1
    while made * WORTH_TRYING >= max(asked, 1):
        pairs = materialize(proposals(open_buckets(members, labels), signatures, tried, like, turn), "dedup-proposals")
        links = linked(pairs, texts, like)
        turn, asked, made, tried = turn + 1, pairs.count(), links.count(), tried.union(pairs)
        if made:
            labels = components(edges().union(links))
    open_nodes = materialize(open_buckets(members, labels).select("node", "label").distinct(), "dedup-open")
    if not open_nodes.isEmpty():
        pairs = materialize(prefix_pairs(open_nodes, texts, like).join(tried, ["a", "b"], "left_anti"), "dedup-pairs")
        labels = components(edges().union(linked(pairs, texts, like)))

    out = sketch.select("doc_id", *of_class).join(classes, of_class, "left").withColumn("rep", F.when(F.col("doc_id").isNotNull(), F.col("rep")))
    out = out.join(labels, F.col("rep") == F.col("node"), "left")
    out = out.withColumn("component_id", F.coalesce("label", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def linked(pairs: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    same = compared(pairs, texts, like.words).filter(F.col("common") * 100 >= F.col("all") * like.percent).select("a", "b")
    return materialize(same, "dedup-links")


def common_shingles(nodes: DataFrame, texts: DataFrame, words: int, sample: int = ORDER_SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, sorted, and how often they occur in a bounded sample of the nodes' sets (those that
    occur at least ORDER_LEAST times). Only the order of shingles comes from it, which decides how
    much work prefix_pairs has, not what it finds."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                hashes, _ = distinct_sets(utf8(b.column(0).slice(at, 256).to_pylist()), words)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], names=["shingle"])

    drawn = nodes.select("node").distinct().orderBy(F.xxhash64("node"), "node").limit(sample)
    rows = texts.join(F.broadcast(drawn.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi").select("text")
    often = rows.mapInArrow(emit, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") >= ORDER_LEAST)
    known = often.toArrow()  # at most the sample's shingles / ORDER_LEAST rows
    order = np.argsort(known["shingle"].to_numpy())
    return known["shingle"].to_numpy()[order], known["n"].to_numpy()[order]


def signature_bits(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Four low bits of each signature value of the sets ``hashes[at[i]:at[i + 1]]``, packed into signed 64-bit numbers."""
    out = np.zeros((len(at) - 1, 2 * PERMUTATIONS // 16), np.uint64)
    some = np.flatnonzero(np.diff(at))
    if len(some):
        out[some] = low_bits(min_max(hashes.view(np.uint64), np.append(at[some], at[-1])))
    return out.view(np.int64)


def unequal_values(x: list[Column], y: list[Column]) -> Column:
    """How many of two signatures' four-bit values differ: unequal values leave a bit in
    their field of the exclusive or."""
    differ = [a.bitwiseXOR(b) for a, b in zip(x, y, strict=True)]
    pairs = [d.bitwiseOR(F.shiftrightunsigned(d, 1)) for d in differ]
    return sum((F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 2)).bitwiseAND(F.lit(LOW_BITS))) for d in pairs), F.lit(0))


def least_equal(percent: int, deviations: float = 6.3) -> int:
    """How many four-bit values of similar sets' signatures are equal at least, but for
    a chance of about one in 10^8 (6.3 standard deviations; for pairs just at the threshold)."""
    n, j = 2 * PERMUTATIONS, percent / 100
    p = j + (1 - j) / 16
    return int(n * p - deviations * (n * p * (1 - p)) ** 0.5)


def open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, bucket, label, low, size) of the buckets that hold several labels, with the
    smallest of them and the number of classes."""
    found = members.join(labels, "node", "left").select("node", "bucket", F.coalesce("label", "node").alias("label"))
    of_bucket = found.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    return found.join(of_bucket.filter("low <> high").drop("high"), "bucket")


def proposals(open_rows: DataFrame, signatures: DataFrame, tried: DataFrame, like: Likeness, turn: int) -> DataFrame:
    """(a, b): for each node outside its bucket's smallest label (its largest group, as a rule), at most
    PROPOSALS partners of another label, those whose signatures agree most among the nodes it
    meets, without the pairs ``tried`` (a, b). A bucket is dealt into cells of about CELL_CLASSES
    nodes, by a hash that each turn changes."""
    cells = F.greatest(F.lit(1), F.ceil(F.col("size") / CELL_CLASSES))
    dealt = open_rows.withColumn("cell", F.pmod(F.xxhash64("node", F.lit(turn)), cells)).drop("size")
    dealt = materialize(dealt.join(signatures, "node"), "dedup-cells")
    x, y = dealt.filter("label <> low").alias("x"), dealt.alias("y")
    values = range(2 * PERMUTATIONS // 16)
    unequal = unequal_values([F.col("x.bits")[k] for k in values], [F.col("y.bits")[k] for k in values])
    met = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.cell") == F.col("y.cell")) & (F.col("x.label") != F.col("y.label"))
    met = met & (unequal <= 2 * PERMUTATIONS - least_equal(like.percent, 0))
    ends = [f("x.node", "y.node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    meetings = x.join(y, met).select(F.col("x.node").alias("x"), *ends, F.pmod("x.bucket", F.lit(PROPOSALS)).alias("nth"), unequal.alias("unequal"))
    meetings = meetings.join(tried, ["a", "b"], "left_anti")
    best = meetings.groupBy("x", "nth").agg(F.min(F.struct("unequal", "a", "b")).alias("best"))
    return best.select("best.a", "best.b").distinct()


def prefix_pairs(nodes: DataFrame, texts: DataFrame, like: Likeness) -> DataFrame:
    """(a, b): every pair of ``nodes`` (node, label) with different labels that can be similar.

    Prefix filter: with all sets in one order of shingles, rare ones first, similar sets share a
    shingle among the first (1 - threshold) of each; and if their first common one is
    at places i and j, at most the min(|x| - i, |y| - j) shingles from there on are common, which must
    reach the overlap that the threshold asks for sets of these sizes. Near copies whose own shingles
    use up that allowance meet nobody, however large their group is. Of the pairs that meet, those
    whose signatures agree in far too few values (``least_equal``) are left out as well."""
    words, percent = like
    hashes, counts = common_shingles(nodes, texts, words)
    id_type = nodes.schema["node"].dataType.simpleString()
    names = [f"bits{k}" for k in range(2 * PERMUTATIONS // 16)]

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                flat, off = distinct_sets(utf8(part.column(2).to_pylist()), words)
                flat = flat.view(np.int64)
                rank = np.zeros(len(flat), np.int64)
                if len(hashes):
                    place = np.minimum(np.searchsorted(hashes, flat), len(hashes) - 1)
                    rank = np.where(hashes[place] == flat, counts[place], 0)
                sizes = np.diff(off)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                order = np.lexsort((flat, rank, doc))
                pos = np.arange(len(flat)) - off[doc]
                bits = signature_bits(flat, off)
                keep = pos <= sizes[doc] - -(-percent * sizes[doc] // 100)
                row = pa.array(doc[keep])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), *map(pa.array, (sizes[doc[keep]], pos[keep], flat[order][keep], *bits[doc[keep]].T))],
                    names=["node", "label", "n", "pos", "shingle", *names],
                )

    rows = texts.join(nodes, F.col("doc_id") == F.col("node")).select("node", "label", "text")
    tokens = materialize(rows.mapInArrow(prefixes, f"node {id_type}, label {id_type}, n long, pos long, shingle long, " + ", ".join(f"{c} long" for c in names)), "dedup-prefixes")
    lists = tokens.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("shingle", "low")
    tokens = materialize(tokens.join(lists, "shingle"), "dedup-lists")
    # of the list's smallest label (its largest group, as a rule) no two nodes need to meet
    x, y = tokens.filter("label <> low").alias("x"), tokens.alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    overlap = F.least(nx - F.col("x.pos"), ny - F.col("y.pos"))
    fits = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") != F.col("y.label")) & (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent)
    fits = fits & (overlap * (100 + percent) >= (nx + ny) * percent)
    unequal = unequal_values([F.col(f"x.{c}") for c in names], [F.col(f"y.{c}") for c in names])
    fits = fits & (unequal <= 2 * PERMUTATIONS - least_equal(percent))
    ends = [f("x.node", "y.node").alias(c) for f, c in ((F.least, "a"), (F.greatest, "b"))]
    return x.join(y, fits).select(*ends).distinct()


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the smallest id (of rows repeating
    it, the one whose text is first in order). Rows without an id stay."""
    kept = near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    place = fresh(docs, "place")
    named = docs.join(kept, "doc_id", "left_semi").withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
    return named.filter(F.col(place) == 1).drop(place).select(*docs.columns).unionByName(docs.filter("doc_id is null"))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Likeness(3, 85))
