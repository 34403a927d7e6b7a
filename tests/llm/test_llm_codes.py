"""Token ids, vector codes and conversation tries against the tokenizers library and brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import bpe_tree, burst_trie, queries, walsh_codes

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# --- op11

BITS = ["a", "b", "e", "the", "ing", " ", "  ", "\n", "\t", "'s", "'r", "e", "1", "23", "é", "中", "文", "!", "''", "<|endoftext|>", "<|endof", " ", "\x1c", "😀", "ß", "'"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(bpe_tree.tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def odd_texts(n, seed, sizes=(3, 10, 40, 120)):
    rng = random.Random(seed)
    return ["".join(rng.choices(rng.sample(BITS, rng.randint(1, 6)), k=rng.choice(sizes))) for _ in range(n)]


def test_trees_of_small_leaves_equal_the_library(library, monkeypatch):
    monkeypatch.setattr(bpe_tree, "SLICE_CHARS", 12)
    codec = bpe_tree.Codec(bpe_tree.tokenizer_path(), leaf_bytes=32)
    for text in odd_texts(3000, 11):
        expected = ids_of(library, text)
        assert codec.encode(text) == expected
        cut = list(codec.cut(text, 5, 7))  # parts end inside units, pre-tokens and characters
        assert codec.join_parts([run for run, _ in cut], [codec.encode_part(*c) for c in cut]) == expected
        assert codec.decode(expected) == library.decode(np.frombuffer(expected, "<u4").tolist(), skip_special_tokens=False) == text


def test_long_unsplit_texts_equal_the_library(library):
    rng = random.Random(5)
    codec = bpe_tree.Codec(bpe_tree.tokenizer_path(), leaf_bytes=512)
    for text in ("".join(map(chr, rng.choices(range(0x4E00, 0x9FFF), k=60_000))), "a" * 50_000, " " * 50_000, "http://" * 8_000, "".join(rng.choices("etaoinshr", k=60_000)), "0" * 10_000):
        assert codec.encode(text) == ids_of(library, text)
        assert codec.decode(codec.encode(text)) == text


def test_a_window_grows_until_both_sides_agree():
    codec = bpe_tree.Codec(bpe_tree.tokenizer_path())
    rng = random.Random(6)
    for _ in range(500):
        whole = "".join(rng.choices("aehlnorst", k=rng.randint(2, 90))).encode()
        at = rng.randint(1, len(whole) - 1)
        assert codec.join(codec.encode_bytes(whole[:at]), codec.encode_bytes(whole[at:])) == codec.encode_bytes(whole)


def test_documents_are_encoded_and_decoded(spark, library):
    texts = [None, "", *odd_texts(150, 12), "中文" * 300, "x" * 900, "x" * 900, "a b " * 300]
    rows = [(None if i == 5 else i % 100, t, "en", None, 7, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + ", ids string")
    for long_chars in (100, 1_000_000):  # cut into parts or whole
        encoded = bpe_tree.encode_documents(docs, long_chars=long_chars, part_chars=50, piece_bytes=61)
        got = bpe_tree.decode_documents(encoded).collect()
        expected = [(i, len(ids_of(library, t)) // 4, ids_of(library, t), t or "") for i, t, *_ in rows]
        key = lambda r: (r[3], -1 if r[0] is None else r[0])
        assert sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got), key=key) == sorted(expected, key=key)
    assert bpe_tree.decode_documents(bpe_tree.encode_documents(docs.limit(0))).count() == 0


def test_bpe_query_holds_every_document(spark, library):
    got = {r.doc_id: r for r in queries.QUERIES["op11_tree_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = ids_of(library, d.text)
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())


# --- op12


def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{row: (code, error)} and the codebooks, with Python integers and plain squared distances."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-max((len(v) for _, v in kept), default=0) // parts)
    cells = []
    for _, v in kept:
        whole = [math.floor(Fraction(x) * scale) for x in v] + [0] * (parts * width - len(v))
        cells.append([whole[p * width : (p + 1) * width] for p in range(parts)])
    books = [[c[p] for c in cells[:entries]] for p in range(parts)]

    def find(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = defaultdict(list)
            for c in cells:
                of[find(p, c[p])[1]].append(c[p])
            books[p] = [[sum(xs) // len(of[k]) for xs in zip(*of[k], strict=True)] if k in of else e for k, e in enumerate(books[p])]
    found = [[find(p, c[p]) for p in range(parts)] for c in cells]
    return [("".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f)) for f in found], ",".join(str(x) for b in books for e in b for x in e)


def vectors(n, size, spread, seed):
    rng = np.random.default_rng(seed)
    return [np.round(rng.normal(0, spread, size), 3).tolist() for _ in range(n)]


@pytest.mark.parametrize(
    ("size", "spread", "n"), [(64, 0.1, 150), (24, 1.0, 90), (20, 3e4, 60), (40, 1e15, 40), (8, 1e300, 30), (8, 0.001, 100), (16, 1.0, 5)]
)
def test_codes_equal_plain_distances(spark, size, spread, n):
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors(n, size, spread, size))]
    rows += [(n, None, 1), (n + 1, [1.0, None], 1), (n + 2, [float("nan")] * size, 2), (n + 3, [float("-inf")] * size, 2)]
    rows += [(4, rows[3][1], 2), (None, rows[2][1], None), (1, rows[1][1], 1), (n + 4, rows[0][1][: size // 2], 7), (n + 5, [], 7)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, code string")
    got, books = walsh_codes.compress(df.repartition(3))
    expected, components = brute_codes(rows)
    assert books.components() == components
    got = got.collect()
    assert sorted((r.code, r.error) for r in got) == sorted((c, e if e < 2**63 else None) for c, e in expected) or any(e >= 2**63 for _, e in expected)
    assert sorted(r.code for r in got) == sorted(c for c, _ in expected)
    assert sum(r.error is None for r in got) == sum(e >= 2**63 for _, e in expected)
    for label in {r.label for r in got}:
        errors = [r.error for r in got if r.label == label]
        whole = None if None in errors or sum(errors) >= 2**63 else sum(errors)
        assert {r.label_error for r in got if r.label == label} == {whole}


def test_transform_scales_squared_distances():
    rng = np.random.default_rng(4)
    for width in (1, 2, 3, 8, 13):
        x, y = rng.integers(-900, 900, (2, 50, width))
        a, b = walsh_codes.transform(x), walsh_codes.transform(y)
        assert a.shape[1] == walsh_codes.padded(width)
        assert (((a - b) ** 2).sum(1) == a.shape[1] * ((x - y) ** 2).sum(1)).all()
    signs = walsh_codes.transform(np.eye(16, dtype=np.int64)).T  # a row of the transform each
    assert (np.diff(signs, axis=1) != 0).sum(1).tolist() == list(range(16))


def test_nearest_takes_the_lower_of_equal_entries():
    entries = np.array([[3, 3], [0, 0], [3, 3], [0, 0]])
    index, distance = walsh_codes.nearest(walsh_codes.transform(np.array([[3, 3], [1, 0], [2, 1]])), walsh_codes.transform(entries))
    assert index.tolist() == [0, 1, 0] and (distance // 2).tolist() == [0, 1, 5]


def test_codes_of_an_empty_table(spark):
    df = spark.createDataFrame([(1, None, 2)], "vec_id long, embedding array<float>, label int")
    rows, books = walsh_codes.compress(df)
    assert rows.count() == 0 and books is None


# --- op13


def brute_trie(rows):
    """Nodes of the trie, by prefixes of lists."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tid = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, tid, (role, text)))
    own = {c: [t[3] for t in sorted(turns, key=lambda t: t[:3])] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in rebuilt.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children.get(p, 0), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, who in members.items()
    )


def conversation_rows(n, seed, copies=0, long_turns=0):
    rng = random.Random(seed)
    first = [("system", "be kind"), ("user", "hi"), (None, ""), ("user", None)]
    rows = []
    for c in rng.sample(range(-250, 20 * n), n):
        turns = [rng.choice(first) for _ in range(rng.randint(0, 2))] + [(rng.choice("ua"), rng.choice("abc") * rng.randint(0, 3)) for _ in range(rng.randint(1, 6))]
        rows += [(c, rng.choice([None, i, i, i]), role, text) for i, (role, text) in enumerate(turns)]
    for c in range(copies):  # one large group of copies, with a common opening
        rows += [(100_000 + c, i, "u", f"copy {i}") for i in range(8)]
    rows += [(200_000, i, "a", f"long {i % 7}") for i in range(long_turns)] + [(200_001, i, "a", f"long {i % 7}") for i in range(long_turns // 2)]
    return rows + [(None, 1, "u", "nobody's"), rows[0], rows[0]]


@pytest.mark.parametrize(("limit", "copies", "long_turns"), [(3, 40, 50), (25, 40, 300), (2_000, 5, 30)])
def test_trie_equals_prefixes_of_lists(spark, limit, copies, long_turns):
    rows = conversation_rows(120, limit, copies, long_turns)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, depth string").repartition(3)
    got = sorted(map(tuple, burst_trie.prefix_trie(df, limit).collect()))
    assert got == brute_trie(rows)


def test_trie_of_few_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert burst_trie.prefix_trie(df).count() == 0
    turnless = [(105, 0, "u", "x"), (3, 0, "u", "a")]  # 105 takes five turns from 100, which isn't there
    df = spark.createDataFrame(turnless, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, burst_trie.prefix_trie(df).collect())) == brute_trie(turnless)


def test_running_sums_go_on_across_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 1, 2, 5, 9]), i, rng.randint(-9, 9), rng.getrandbits(60)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, o long, a long, x long").repartition(5)
    got = burst_trie.running(df, "g", [df["o"].desc()], {"a": "sum"}, {"x": "xor"}, "test-running").collect()
    total, mixed = defaultdict(int), defaultdict(int)
    expected = {}
    for g, o, a, x in sorted(rows, key=lambda r: -r[1]):
        total[g] += a
        mixed[g] ^= x
        expected[g, o] = (total[g], mixed[g])
    assert {(r.g, r.o): (r.sum, r.xor) for r in got} == expected
