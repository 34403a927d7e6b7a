"""Mixing sources to target weights with a low-discrepancy schedule.

DataFrame functions only. Every source's documents, in a shuffled order, form
a tape of words that repeats as often as the source's target asks. The tape is
cut into blocks of equal words. The mix has 2**m slots; slot i carries the
van der Corput point of i, which the cumulative targets map to a source, and
the rank of the slot among its source's slots names the block it takes. Since
2**m such points are evenly spaced, each source gets its share of the slots to
within one, and any run of slots holds the sources in nearly their weights. A
source too small for a point gets one short slot of its own after the 2**m.

Scale: sizes and order keys are the only columns that move. Running sums and
ranks are taken inside buckets (of the shuffled order, and of slots) and shifted
by the sums of earlier buckets, so a source holding a third of all rows is spread
over many tasks. Nothing but five totals reaches the driver.

Defined results: a null text counts no words; a source without words has target
0; a null source is a source of its own, last; repeated rows are separate
documents; an empty table gives an empty mix. Texts of any length are counted in linear time, by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import fresh, materialize, table

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 4_000  # rows of one running-sum bucket; changes the layout, not the result


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, sid, source_size, target, quota): targets share all words by
    weight (given by the sources' order, repeating); a source whose share is
    above ``max_epochs`` times its size stops there and the rest is shared again.

    The windows over all sources run in one task; it has one narrow row for each source.
    One pass instead of rounds: sources are taken by rising size/weight. Those
    below the level that the rest could fill stop at their bound, and the level
    only rises, so they are a prefix of that order."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    s = by_source.withColumn("sid", F.row_number().over(in_order) - 1)
    s = s.withColumn("w", F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), F.col("sid") % len(weights) + 1))
    s = s.withColumn("bound", F.col("source_size") * max_epochs)
    rising = Window.orderBy(F.col("bound") / F.col("w"), "sid")
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    exact = lambda c: c.cast("decimal(38,0)")  # noqa: E731 - the products may not fit a long
    s = s.withColumns({
        "total": F.sum("source_size").over(whole),
        "stopped": F.coalesce(F.sum("bound").over(before), F.lit(0)),
        "left": F.sum("w").over(after),
    })
    s = s.withColumn("full", exact(F.col("bound")) * F.col("left") < exact(F.col("total") - F.col("stopped")) * F.col("w"))
    s = s.withColumns({
        "kept": F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0)).over(whole),
        "open": F.sum(F.when(F.col("full"), F.lit(0)).otherwise(F.col("w"))).over(whole),
    })
    share = F.col("w").cast("double") * (F.col("total") - F.col("kept")).cast("double") / F.col("open").cast("double")
    s = s.withColumn("target", F.when(F.col("full"), F.col("bound").cast("double")).otherwise(share))
    # a share that rounds up may not ask for more than the bound
    s = s.withColumn("quota", F.least(F.floor("target"), F.col("bound")))
    return s.select("source", "sid", "source_size", "target", "quota")


def tape_offsets(docs: DataFrame, keys: list[str], n_buckets: int) -> DataFrame:
    """Adds ``at``: the words before each document on its source's tape."""
    docs = docs.withColumn("order_key", F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    docs = docs.withColumn("bucket", F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("long") * n_buckets / (1 << 32)))
    inside = Window.partitionBy("sid", "bucket").orderBy("order_key", "doc_id", "size", *keys)
    docs = docs.withColumn("in_bucket", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    docs = docs.withColumn("row_no", F.row_number().over(inside))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = docs.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("earlier"))
    return docs.join(sums, ["sid", "bucket"]).withColumn("at", F.col("earlier") + F.col("in_bucket"))


def slot_sources(targets: DataFrame, m: int, n_sources: int, all_words: int) -> DataFrame:
    """(slot, sid, quota, n_slots): each of the 2**m slots with its point's source,
    and one more slot for each source with a quota that no point falls into.

    Points are looked up by equal cells of the unit interval, finer than the
    sources, so the lookup is an equi-join."""
    n = 1 << m
    up_to = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    t = targets.withColumn("cum", F.sum("quota").over(up_to))
    edge = lambda c: F.ceil(c.cast("double") * n / F.lit(float(all_words)))
    t = t.select("sid", "quota", edge(F.col("cum") - F.col("quota")).alias("lo"), edge(F.col("cum")).alias("hi")).filter("quota > 0")
    t = t.withColumn("pointless", F.sum(F.when(F.col("lo") < F.col("hi"), 0).otherwise(1)).over(up_to))
    more = t.filter("lo >= hi").select((F.col("pointless") + (n - 1)).alias("slot"), "sid", "quota", F.lit(1).cast("long").alias("n_slots"))
    t = t.filter("lo < hi")
    shift = max(0, m - max(6, (64 * n_sources - 1).bit_length()))
    cells = t.withColumn("cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright(F.col("hi") - 1, shift))))
    spark = targets.sparkSession
    slots = spark.range(n).withColumnRenamed("id", "slot")
    reversed_bits = F.conv(F.reverse(F.lpad(F.bin("slot"), m, "0")), 2, 10).cast("long") if m else F.lit(0).cast("long")
    slots = slots.withColumn("point", reversed_bits).withColumn("cell", F.shiftright("point", shift))
    slots = slots.join(cells, "cell").filter("point >= lo and point < hi").select("slot", "sid", "quota", (F.col("hi") - F.col("lo")).alias("n_slots"))
    return slots.unionByName(more)


def ranked_slots(slots: DataFrame, m: int) -> DataFrame:
    """Adds ``block``: the rank of the slot among its source's slots."""
    shift = min(m, (BUCKET_ROWS - 1).bit_length())
    slots = slots.withColumn("part", F.shiftright("slot", shift))
    inside = Window.partitionBy("sid", "part").orderBy("slot")
    counts = slots.groupBy("sid", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = slots.withColumn("in_part", F.row_number().over(inside) - 1).join(counts, ["sid", "part"])
    return ranked.withColumn("block", F.col("earlier") + F.col("in_part")).drop("part", "in_part", "earlier")


def schedule(docs: DataFrame, text: Column | None = None, keys: tuple[str, ...] = (), block_words: int = 256, max_epochs: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs`` (doc_id, source, text, and ``keys`` that tell rows apart).

    Returns (documents, mix): documents with size, source_size, target and
    ``row_no`` / ``bucket`` / ``sid`` that name the row; mix with one row for each
    part of a document in a slot: (sid, bucket, row_no, slot, epoch, first_word, words).
    The last block of a source takes what is left of its target (under two blocks)."""
    text = F.col("text") if text is None else text
    sized = docs.select("doc_id", "source", *keys, word_count(text).alias("size"))
    sized = materialize(sized, "mix-sizes")  # the texts are read once
    targets = materialize(source_targets(sized, max_epochs), "mix-targets")
    total = targets.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count("*")).first()
    n_rows = sized.count()
    all_words, n_sources = int(total[0]), int(total[1])
    m = max(0, (-(-all_words // block_words) - 1).bit_length())
    block = max(1, -(-all_words // (1 << m)))
    placed = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = materialize(tape_offsets(placed, list(keys), max(1, n_rows // BUCKET_ROWS)), "mix-tape")
    slots = ranked_slots(slot_sources(targets, m, n_sources, max(1, all_words)), m)

    size = F.col("source_size")
    parts = placed.filter("size > 0 and quota > 0").select("sid", "bucket", "row_no", "at", "size", "source_size", "quota")
    parts = parts.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / size))))
    parts = parts.withColumn("begin", F.col("epoch") * size + F.col("at"))
    parts = parts.withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota"))).filter("begin < end")
    parts = parts.withColumn("cut", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))))
    # the tape's last block has no slot of its own when the shares round down: it belongs to the one before
    slots = slots.withColumn("cut", F.explode(F.when(F.col("block") == F.col("n_slots") - 1, F.sequence(F.col("block"), F.greatest(F.col("block"), F.floor((F.col("quota") - 1) / block)))).otherwise(F.array("block"))))
    mix = parts.join(slots.select("sid", "cut", "slot"), ["sid", "cut"])
    begin, end = F.greatest("begin", F.col("cut") * block), F.least("end", (F.col("cut") + 1) * block)
    mix = mix.select("sid", "bucket", "row_no", "slot", "epoch", (begin - F.col("begin")).alias("first_word"), (end - begin).alias("words"))
    return placed, mix


def taken_words(docs: DataFrame, keys: tuple[str, ...] = (), **options: object) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, ``keys``."""
    placed, mix = schedule(docs, keys=keys, **options)
    row = ["sid", "bucket", "row_no"]
    taken = mix.groupBy(*row).agg(F.sum("words").alias("taken"))
    out = placed.join(taken, row, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("doc_id", *keys, "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """The mix as documents: each as often as it was taken whole, and the one
    document a source's target cuts also with its first words only. All columns
    are kept; n_chars (if there) follows a cut text. Rows without words carry
    nothing into a mix and are left out."""
    cols = docs.columns
    row, size, taken, copy = (fresh(docs, n) for n in ("mix_row", "mix_size", "mix_taken", "mix_copy"))
    tagged = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "mix-input")
    amounts = taken_words(tagged, keys=(row,), **options).filter("taken > 0").select(row, F.col("size").alias(size), F.col("taken").alias(taken))
    rows = tagged.join(amounts, row)
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col(taken) / F.col(size)))))
    cut = F.col(copy) * F.col(size) > F.col(taken)
    words = (F.col(taken) % F.col(size)).cast("int")
    head = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words), " ")
    rows = rows.withColumn("text", F.when(cut, head).otherwise(F.col("text")))
    if "n_chars" in cols:
        rows = rows.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*cols)


def query(spark, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


#: The running sums need no buckets here; a document's words are those of its
#: source's tape before the quota, whichever slot they fall into.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all("text", '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS w, sum(source_size) OVER () AS total FROM s
), f AS (
  SELECT *, 3 * source_size::HUGEINT * sum(w) OVER (ORDER BY 3 * source_size / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         < (total - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w AS is_full FROM w
), g AS (
  SELECT *, total - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER () AS rest, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS open_w FROM f
), t AS (
  SELECT source, sid, source_size,
         CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE w::DOUBLE * rest::DOUBLE / open_w::DOUBLE END AS target,
         least(floor(CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE w::DOUBLE * rest::DOUBLE / open_w::DOUBLE END)::BIGINT, 3 * source_size) AS quota FROM g
), d AS (
  SELECT d.doc_id, d.size, n.source_size, n.target, n.quota,
         sum(d.size) OVER (PARTITION BY n.sid ORDER BY md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS pos
  FROM sized d JOIN t n ON d.source IS NOT DISTINCT FROM n.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size = 0 THEN 0
             ELSE quota // source_size * size + least(size, greatest(0, quota % source_size - pos)) END)::BIGINT AS taken
FROM d
"""
