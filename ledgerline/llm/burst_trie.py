"""Prefix tries of conversations, as burst tries.

A conversation is a sequence of turns; a turn's id is the hash (SHA-256, 128 bits) of its role and text. The root container
holds all conversations. A container with more than ``limit`` turns is burst
by next turn id: it becomes a trie head with one container for each next turn,
and so on. A head is known by the path of turn ids to it (an xor of 128 hashed bits of each
position and id, which running sums give for all turns at once), so all bursts are one aggregate: paths
under which more than ``limit`` turns lie are heads, and a conversation's suffix after its last head lies in one container. Containers are
dealt over shards, their suffixes sorted and swept into nodes, a container at a time.
Heads get their numbers from aggregates over the turns they are on, and sums over their subtrees from running sums along paths.

Scale: only ids, lengths and keys of turns are shuffled, never texts. Nothing gathers a
conversation, a head or a group of copies in one task: turns are numbered, and paths hashed, in range partitions whose
running sums are shifted by those of earlier partitions (as many rows as partitions, broadcast);
heads are partial aggregates; a container is at most ``limit`` turns by construction. Only the hash of the ids that end at one
node, a sequential function of them all, is one task's work for each node, over ids joined to texts beforehand.

Defined results: rows without a conversation id take no part; null roles and texts are empty; turns are ordered by
number, nulls first, and equal numbers by turn id, so repeated rows are turns of their own, in any order; an empty
table gives no rows; columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize, table

LIMIT = 2_000  # turns in a container
BLOCK = 100  # conversations that share a base
SHARED = 6  # a conversation takes fewer than so many turns from its base
CHUNK_IDS = 50_000  # ids joined to one text
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- running sums -----------------------------------------------------------------------------


def _running(op: np.ufunc, values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, carry: int | None) -> np.ndarray:
    """Running ``op`` (add or bitwise_xor) of each segment; the first one goes on from ``carry``."""
    undo = np.subtract if op is np.add else np.bitwise_xor
    total = op.accumulate(values)
    before = np.where(starts > 0, total[starts - 1], 0)
    if carry is not None:
        before[0] = -carry if op is np.add else carry
    return undo(total, np.repeat(before, sizes))


def running(df: DataFrame, group: str, order: list[Column], add: dict[str, str], xor: dict[str, str], name: str) -> DataFrame:
    """Running sums and xors of long columns (input column to output column) over the rows of each
    group in order, this row included. ``group`` is a long; the result is written once."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ops = [(np.add, i, o) for i, o in add.items()] + [(np.bitwise_xor, i, o) for i, o in xor.items()]
    keys = [F.col(group), *order]
    ranged = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"{o} long" for *_, o in ops] + ["_part int"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last: int | None = None
        carries = [0] * len(ops)
        for b in batches:
            if not len(b):
                continue
            ids = b.column(b.schema.get_field_index(group)).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            sizes = np.diff(starts, append=len(ids))
            columns = []
            for k, (op, source, _) in enumerate(ops):
                values = b.column(b.schema.get_field_index(source)).to_numpy().astype(np.int64)
                out = _running(op, values, starts, sizes, carries[k] if ids[0] == last else None)
                carries[k] = int(out[-1])
                columns.append(pa.array(out))
            last = ids[-1]
            columns.append(pa.array(np.full(len(ids), part, np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*b.schema.names, *(o for *_, o in ops), "_part"])

    pinned = materialize(ranged.mapInArrow(sweep, fields), name)
    # groups in several partitions: the first or last group of each (at most one more row than partitions)
    ends = pinned.groupBy("_part").agg(F.min(group).alias("a"), F.max(group).alias("b"))
    spread = ends.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("_group")).groupBy("_group").count().filter("count > 1")
    sums = [F.sum(i).alias(o) for i, o in add.items()] + [F.bit_xor(i).alias(o) for i, o in xor.items()]
    totals = (pinned.join(F.broadcast(spread.select("_group")), F.col(group) == F.col("_group"), "left_semi")
              .groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(*sums))
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_g", "_p", *[F.sum(o).over(earlier).alias(f"_b_{o}") for o in add.values()], *[F.bit_xor(o).over(earlier).alias(f"_b_{o}") for o in xor.values()])
    joined = pinned.join(F.broadcast(before), (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p")), "left")
    zero = F.lit(0).cast("long")
    return joined.select(
        *df.columns,
        *[(F.col(o) + F.coalesce(F.col(f"_b_{o}"), zero)).alias(o) for o in add.values()],
        *[F.col(o).bitwiseXOR(F.coalesce(F.col(f"_b_{o}"), zero)).alias(o) for o in xor.values()],
    )


# --- rebuilt conversations -----------------------------------------------------------------------


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, tid, size, pos): turns in order, numbered from 1."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.substr(whole, F.lit(1), F.lit(32))).alias("tid"),
        F.length(text).cast("long").alias("size"), F.lit(1).cast("long").alias("one"))
    order = [F.col("turn").asc_nulls_first(), F.col("tid")]
    return running(turns, "conv_id", order, {"one": "pos"}, {}, "trie-turns").select("conv_id", "tid", "size", "pos")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """(c, i, tid, size, left): every conversation's turns after it took its first ones from its
    base, and row 0 for the root; ``left`` turns follow."""
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("conv_id")
    bases = counts.select(F.col("conv_id").alias("_base"), F.col("n").alias("_base_n"))
    convs = counts.withColumns({"h": F.crc32(c.cast("string").cast("binary")) % SHARED, "base": c - c % BLOCK})
    convs = convs.join(bases, F.col("base") == F.col("_base"), "left")
    used = F.least("h", F.coalesce("_base_n", F.lit(0).cast("long")))
    convs = materialize(convs.select("conv_id", "h", "base", used.alias("used"), (used + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))).alias("length")), "trie-conversations")
    none = F.lit(None).cast("binary")
    zero = F.lit(0).cast("long")
    root = convs.select(c.alias("c"), zero.alias("i"), none.alias("tid"), zero.alias("size"), F.col("length").alias("left"))
    first = turns.filter((F.col("pos") < SHARED) & (c % BLOCK == 0)).select(F.col("conv_id").alias("_of"), "tid", "size", "pos")
    taken = convs.join(first, (F.col("base") == F.col("_of")) & (F.col("pos") <= F.col("used"))).select(
        c.alias("c"), F.col("pos").alias("i"), "tid", "size", (F.col("length") - F.col("pos")).alias("left"))
    at = F.col("pos") - F.col("h") + F.col("used")
    own = turns.join(convs, "conv_id").filter(F.col("pos") > F.col("h")).select(c.alias("c"), at.alias("i"), "tid", "size", (F.col("length") - at).alias("left"))
    return root.unionByName(taken).unionByName(own)


def with_paths(rows: DataFrame) -> DataFrame:
    """Adds the key of each row's path (k1, k2) and of its parent's (p1, p2)."""
    keyed = rows.withColumns({
        f"h{k}": F.when(F.col("i") > 0, F.xxhash64(F.lit(k), "tid", "i")).otherwise(F.lit(0).cast("long")) for k in (1, 2)})
    paths = running(keyed, "c", [F.col("i")], {}, {"h1": "k1", "h2": "k2"}, "trie-paths")
    return paths.withColumns({f"p{k}": F.col(f"k{k}").bitwiseXOR(F.col(f"h{k}")) for k in (1, 2)}).drop("h1", "h2")


# --- containers ------------------------------------------------------------------------------------


def swept(depth: int, suffixes: list[tuple[list[bytes], int, list[int]]]) -> list[list]:
    """The nodes of one container: its suffixes (turn ids, conversation, sizes; all with the same first
    turn, at ``depth``) are sorted, and neighbours share the nodes of their common prefix. Rows of conv_id, depth,
    parent_conv_id (null for the first), n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    suffixes.sort()
    out: list[list] = []
    path: list[list] = []  # open nodes: [n, smallest, children, leaves, saved, size, ends, rows of children]

    def close(keep: int) -> None:
        while len(path) > keep:
            n, least, children, leaves, saved, size, ends, below = path.pop()
            if ends:
                ends.sort()
                least = min(least, ends[0]) if least is not None else ends[0]
                n += len(ends)
            leaves = leaves or 1
            saved += (n - 1) * size
            for row in below:
                out[row][2] = least
            digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest() if ends else NO_ENDS
            out.append([least, depth + len(path), None, n, children, leaves, saved, digest])
            if path:
                up = path[-1]
                up[0] += n
                up[1] = least if up[1] is None else min(up[1], least)
                up[2] += 1
                up[3] += leaves
                up[4] += saved
                up[7].append(len(out) - 1)

    last: list[bytes] = []
    for tids, conv, sizes in suffixes:
        common = 0
        for a, b in zip(last, tids):  # noqa: B905 - up to the shorter one
            if a != b:
                break
            common += 1
        close(common)
        path.extend([0, None, 0, 0, 0, size, [], []] for size in sizes[common:])
        path[-1][6].append(conv)
        last = tids
    close(0)
    return out


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def container_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of all containers, from rows (t1, t2, b: the path key and depth of the
    container's first turn; u1, u2: its parent's; c, i, tid, size), with (b, u1, u2) on the first nodes of containers."""
    shards = rows.repartition("t1", "t2", "b").sortWithinPartitions("t1", "t2", "b", "c", "i")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 7 + [pa.string()] + [pa.int64()] * 3
        names = [f.split()[0] for f in NODE.split(", ")] + ["b", "u1", "u2"]
        held: list[list] = []

        def emit() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*held), kinds, strict=True)], names=names)
            held.clear()
            return batch

        key, suffixes = None, []

        def finish() -> None:
            nodes = swept(key[2], suffixes)
            held.extend([*n, None, None, None] for n in nodes[:-1])
            held.append([*nodes[-1], key[2], key[3], key[4]])

        for b in batches:
            for t1, t2, depth, u1, u2, conv, tid, size in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("t1", "t2", "b", "u1", "u2", "c", "tid", "size")), strict=True):
                if (t1, t2, depth, u1, u2) != key:
                    if suffixes:
                        finish()
                    key, suffixes = (t1, t2, depth, u1, u2), []
                if not suffixes or suffixes[-1][1] != conv:
                    suffixes.append(([], conv, []))
                suffixes[-1][0].append(tid)
                suffixes[-1][2].append(size)
            if len(held) > 50_000:
                yield emit()
        if suffixes:
            finish()
        if held:
            yield emit()

    return shards.select("t1", "t2", "b", "u1", "u2", "c", "i", "tid", "size").mapInArrow(sweep, f"{NODE}, b long, u1 long, u2 long")


# --- heads --------------------------------------------------------------------------------------------


def ends_of(rows: DataFrame) -> DataFrame:
    """(e0, e1, e2, ends_sha256): the hash of the sorted conversation ids (c) of each node (i, k1, k2)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["i", "k1", "k2"]
    ranged = rows.select(*keys, "c").repartitionByRange(n, *keys, "c").sortWithinPartitions(*keys, "c")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of one node in a row: a text for each run of up to CHUNK_IDS; runs are ordered by their first id."""
        key, ids = None, []

        def run() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"i": [key[0]], "k1": [key[1]], "k2": [key[2]], "c": [ids[0]], "ids": [",".join(map(str, ids))]})

        for b in batches:
            for *k, c in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in (*keys, "c")), strict=True):
                if ids and (k != key or len(ids) == CHUNK_IDS):
                    yield run()
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield run()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            for *k, ids in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in (*keys, "ids")), strict=True):
                if k == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    yield pa.RecordBatch.from_pydict({"e0": [key[0]], "e1": [key[1]], "e2": [key[2]], "ends_sha256": [state.hexdigest()]})
                key, state = k, hashlib.sha256(ids.encode())
        if key:
            yield pa.RecordBatch.from_pydict({"e0": [key[0]], "e1": [key[1]], "e2": [key[2]], "ends_sha256": [state.hexdigest()]})

    runs = ranged.mapInArrow(join, "i long, k1 long, k2 long, c long, ids string")
    return runs.repartition(*keys).sortWithinPartitions(*keys, "c").mapInArrow(digest, "e0 long, e1 long, e2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    rows = with_paths(rebuilt_turns(numbered_turns(conversations)))
    key = ["i", "k1", "k2"]
    on = lambda a, b, c: (F.col("i") == F.col(a)) & (F.col("k1") == F.col(b)) & (F.col("k2") == F.col(c))

    # burst: paths with more than ``limit`` turns below them, and the root
    found = rows.groupBy(*key).agg(F.sum(F.col("left") + 1).alias("turns"), F.count(F.lit(1)).alias("n"), F.min("c").alias("rep"),
                                   F.first("size").alias("size"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    heads = materialize(found.filter((F.col("turns") > limit) | (F.col("i") == 0)), "trie-heads")
    head_of = heads.select(F.col("i").alias("_i"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "turns", "n", "rep")
    rows = materialize(rows.join(head_of, on("_i", "_k1", "_k2"), "left").drop("_i", "_k1", "_k2"), "trie-burst")
    on_heads, in_containers = rows.filter(F.col("rep").isNotNull()), rows.filter(F.col("rep").isNull())

    # containers: a conversation's turns after its last head
    tops = in_containers.groupBy(F.col("c").alias("_c")).agg(F.min(F.struct("i", "k1", "k2", "p1", "p2")).alias("_top"))
    placed = in_containers.join(tops, F.col("c") == F.col("_c")).select(
        F.col("_top.k1").alias("t1"), F.col("_top.k2").alias("t2"), F.col("_top.i").alias("b"), F.col("_top.p1").alias("u1"), F.col("_top.p2").alias("u2"), "c", "i", "tid", "size")
    nodes = materialize(container_nodes(placed), "trie-nodes")
    first = nodes.filter(F.col("b").isNotNull())

    # sums over the subtrees of heads: what a head or a container adds lies on the path of its smallest conversation
    below = first.select(F.col("conv_id").alias("_c"), (F.col("b") - 1).alias("_i"), F.col("n_leaves").alias("_leaves"), F.col("saved_tokens").alias("_saved"))
    own = F.col("rep") == F.col("c")
    zero = F.lit(0).cast("long")
    added = on_heads.join(below, (F.col("c") == F.col("_c")) & (F.col("i") == F.col("_i")), "left").select(
        "c", *key, "left",
        (F.coalesce("_leaves", zero) + F.when(own & (F.col("turns") == F.col("n")), F.lit(1)).otherwise(F.lit(0))).cast("long").alias("leaves"),
        (F.coalesce("_saved", zero) + F.when(own, (F.col("n") - 1) * F.col("size")).otherwise(zero)).cast("long").alias("saved"))
    along = running(added, "c", [F.col("i").desc()], {"leaves": "n_leaves", "saved": "saved_tokens"}, {}, "trie-sums")
    totals = along.groupBy(*[F.col(x).alias(f"_t_{x}") for x in key]).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    parents = first.select(F.col("b").alias("i"), F.col("u1").alias("p1"), F.col("u2").alias("p2")).unionByName(heads.filter("i > 0").select("i", "p1", "p2"))
    children = parents.groupBy((F.col("i") - 1).alias("_c_i"), F.col("p1").alias("_c_k1"), F.col("p2").alias("_c_k2")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = ends_of(on_heads.filter(F.col("left") == 0))
    parent_of = heads.select(F.col("i").alias("_p_i"), F.col("k1").alias("_p_k1"), F.col("k2").alias("_p_k2"), F.col("rep").alias("parent_conv_id"))

    def parent(depth: str, a: str, b: str) -> Column:
        return (F.col(depth) - 1 == F.col("_p_i")) & (F.col(a) == F.col("_p_k1")) & (F.col(b) == F.col("_p_k2"))

    columns = [f.split()[0] for f in NODE.split(", ")]
    head_nodes = (heads.join(totals, on("_t_i", "_t_k1", "_t_k2")).join(children, on("_c_i", "_c_k1", "_c_k2"), "left")
                  .join(ends, on("e0", "e1", "e2"), "left").join(parent_of, parent("i", "p1", "p2"), "left"))
    head_nodes = head_nodes.select(
        F.col("rep").alias("conv_id"), F.col("i").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    top_nodes = first.drop("parent_conv_id").join(parent_of, parent("b", "u1", "u2")).select(*columns)
    return head_nodes.unionByName(top_nodes).unionByName(nodes.filter(F.col("b").isNull()).select(*columns))


def query(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


#: crc32 of a text of ASCII digits, bit by bit (the polynomial is the usual reversed one)
_CRC = """CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({x}, ''), lambda s: CAST(ascii(s) AS BIGINT))),
    lambda acc, byte: list_reduce(list_prepend(xor(acc, byte), CAST(range(8) AS BIGINT[])),
        lambda a, k: xor(a // 2, CASE WHEN a % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END))), CAST(4294967295 AS BIGINT)) AS BIGINT)"""

ORACLE = f"""WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS size,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid FROM conversations WHERE conv_id IS NOT NULL),
o AS MATERIALIZED (SELECT conv_id, tid, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tid) AS pos FROM t),
n AS (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id),
c AS MATERIALIZED (SELECT n.conv_id, x.h, n.conv_id - n.conv_id % {BLOCK} AS base, least(x.h, coalesce(b.n, 0)) AS used
    FROM n JOIN (SELECT conv_id, {_CRC.format(x="CAST(conv_id AS VARCHAR)")} % {SHARED} AS h FROM n) x USING (conv_id)
    LEFT JOIN n b ON b.conv_id = n.conv_id - n.conv_id % {BLOCK}),
r AS (SELECT c.conv_id, o.pos AS i, o.tid, o.size FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
    UNION ALL SELECT c.conv_id, o.pos - c.h + c.used, o.tid, o.size FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
p AS MATERIALIZED (SELECT c.conv_id, coalesce(any_value(x.path), []) AS path, coalesce(any_value(x.sizes), []) AS sizes FROM c
    LEFT JOIN (SELECT conv_id, list(tid ORDER BY i) AS path, list(size ORDER BY i) AS sizes FROM r GROUP BY conv_id) x ON x.conv_id = c.conv_id
    GROUP BY c.conv_id),
m AS (SELECT conv_id, d, len(path) AS l, path, sizes, array_to_string(list_slice(path, 1, d), ',') AS k,
    array_to_string(list_slice(path, 1, d - 1), ',') AS up FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM p)),
v AS MATERIALIZED (SELECT d, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n, coalesce(any_value(sizes[d]), 0) AS size,
    any_value(list_slice(path, 1, d)) AS path, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE l = d), '') AS ends FROM m GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM v WHERE d > 0 GROUP BY ALL),
w AS (SELECT v.*, coalesce(kids.n, 0) AS children FROM v LEFT JOIN kids ON kids.d = v.d AND kids.k = v.k),
s AS (SELECT e AS d, array_to_string(list_slice(path, 1, e), ',') AS k, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * size) AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n AS n_convs, w.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
    CAST(s.saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN s ON s.d = w.d AND s.k = w.k LEFT JOIN v u ON u.d = w.d - 1 AND u.k = w.up"""
