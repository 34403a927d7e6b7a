"""Search, near duplicates, mixing, packing, link trust and the pipeline against brute force."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import cover_tree, link_trust, minmax_dedup, mixing, packing, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(frame, cols):
    return sorted(map(tuple, frame[cols].astype(object).where(frame[cols].notna(), None).values.tolist()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    expected = con.sql(queries.ORACLE_SQL[name]).df()
    assert set(got.columns) == set(expected.columns) and len(got) > 0
    assert rows_of(got, list(expected.columns)) == rows_of(expected, list(expected.columns))


# --- op3


def brute_top_k(vectors, k):
    out = []
    for q, v in vectors:
        if q is not None and q % 50 == 0 and v is not None:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), n) for n, w in vectors if n is not None and n != q and w is not None and len(w) == len(v))
            scores = sorted((-max(1 - 2**63, min(2**63 - 1, -s)), n) for s, n in scores)  # the nearest 64-bit integer
            out += [(q, i + 1, n, -s) for i, (s, n) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("largest", [3, 40, 1 << 28, 1 << 61])
def test_top_k_against_all_pairs(spark, largest):
    rng = random.Random(largest)
    vectors = [(i, [rng.randint(-largest, largest) for _ in range(6)]) for i in range(400)]
    vectors += [(1000 + i, vectors[7][1]) for i in range(120)] + [(2000, None), (2050, [1, 2])]
    df = spark.createDataFrame(vectors, "vec_id long, vector array<long>")
    got = cover_tree.top_k(df, df["vec_id"] % 50 == 0, block_rows=90, group_rows=5)
    assert sorted(map(tuple, got.collect())) == brute_top_k(vectors, 5)
    assert cover_tree.top_k(df.limit(0), df["vec_id"] % 50 == 0).count() == 0


def test_trees_cover_and_prune():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 8)) * 100
    points = np.floor(centres[rng.integers(0, 20, 3000)] + rng.standard_normal((3000, 8)))
    tree = cover_tree.CoverTree(points)
    for n in range(len(tree.centre)):
        inside = tree.order[tree.start[n] : tree.end[n]]
        assert np.linalg.norm(points[inside] - points[tree.centre[n]], axis=1).max() <= tree.radius[n] + 1e-6
        if tree.last[n] > tree.first[n]:
            kids = range(tree.first[n], tree.last[n])
            assert sorted(np.concatenate([tree.order[tree.start[k] : tree.end[k]] for k in kids])) == sorted(inside)
    search = cover_tree.Search(points[:60], np.arange(60), points, np.arange(3000), 5)
    search.run()
    assert search.scored < 0.2 * 60 * 3000


def test_bad_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, -0.25]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0])], "vec_id long, embedding array<float>")
    kept = df.select("vec_id", cover_tree.scaled(df["embedding"]).alias("vector")).filter("vector is not null").collect()
    assert [(r.vec_id, list(r.vector)) for r in kept] == [(0, [256, 512]), (1, [128, -64])]


# --- op7


def shingles(text, width=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} if len(found) >= width else {tuple(found)} if found else set()


def brute_components(rows, width=3, percent=85):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingles(t, width))
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], 0
    for size in (1, 1, 2, 3, 40, 60):
        base = [word() for _ in range(rng.choice([8, 40, 120]))]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            rows.append((n, " ".join(text)))
            n += 1
    chain = [word() for _ in range(60)]
    for _ in range(12):  # each like the one before, the ends unlike
        rows.append((n, " ".join(chain)))
        n += 1
        chain[rng.randrange(60)] = word()
    rows += [(n, None), (n + 1, ""), (n + 2, "Two words"), (n + 3, "two WORDS"), (n + 4, "one"), (n + 5, None)]
    rng.shuffle(rows)
    return rows


def test_components_against_all_pairs(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in minmax_dedup.near_duplicates(docs, minmax_dedup.Likeness(3, 85)).collect()}
    expected = brute_components(rows)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.n_shingles == len(shingles(t)) for (i, t), r in ((x, got[x[0]]) for x in rows))
    assert all(r.kept == (i == expected[i]) for i, r in got.items())


@pytest.mark.parametrize("least", [1, 10_000])
def test_prefix_filter_keeps_every_similar_pair(spark, least, monkeypatch):
    monkeypatch.setattr(minmax_dedup, "ORDER_LEAST", least)  # with and without known common shingles
    rows = [(i, t) for i, t in near_copies(6) if shingles(t)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = texts.selectExpr("doc_id as node", "doc_id as label")
    got = {tuple(r) for r in minmax_dedup.prefix_pairs(nodes, texts, minmax_dedup.Likeness(3, 85)).collect()}
    sets = {i: shingles(t) for i, t in rows}
    similar = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert similar and similar <= got
    one = nodes.withColumn("label", nodes["label"] * 0)
    assert minmax_dedup.prefix_pairs(one, texts, minmax_dedup.Likeness(3, 85)).count() == 0  # one label: nothing left to find


def test_texts_of_one_stock_need_fewer_pairs_than_they_have_links(spark, monkeypatch):
    """44 of 50 paragraphs each: most pairs are just below the threshold, and no bucket is free of them."""
    rng, n = random.Random(1), 1_500
    stock = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(20)) for _ in range(50)]
    rows = [(i, " ".join(p for k, p in enumerate(stock) if k not in left_out)) for i in range(n) for left_out in [set(rng.sample(range(50), 6))]]
    compared, asked = minmax_dedup.compared, []

    def counted(pairs, texts, words):
        asked.append(pairs.count())
        return compared(pairs, texts, words)

    monkeypatch.setattr(minmax_dedup, "compared", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(docs, minmax_dedup.Likeness(5, 80)).collect()}

    sets = [shingles(t, 5) for _, t in rows]
    number = {x: k for k, x in enumerate(set().union(*sets))}
    holds = np.zeros((n, len(number)), np.float32)
    for i, some in enumerate(sets):
        holds[i, [number[x] for x in some]] = 1
    common = np.rint(holds @ holds.T)
    size = holds.sum(1)
    link = common * 100 >= 80 * (size[:, None] + size[None, :] - common)
    label = np.arange(n)
    while True:
        least = np.where(link, label[None, :], n).min(1)
        if (least == label).all():
            break
        label = least
    assert got == dict(enumerate(label.tolist()))
    assert sum(asked) < (link.sum() - n) // 2


def test_dedup_of_odd_rows(spark):
    rows = [(1, "a b c d", 1, "x"), (1, "a b c d", 2, "y"), (2, "A b c d", 3, "z"), (None, "a b c d", 4, "n"), (3, "q r s", 5, "q"), (3, "t u v", 6, "t"), (4, "t u v", 7, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label long, rep string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minmax_dedup.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, None, True), (3, 3, True), (3, 3, True), (4, 3, False)], key=repr)
    kept = minmax_dedup.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "a b c d"), (1, "a b c d"), (3, "q r s")]
    assert minmax_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_min_max_values_are_those_of_each_permutation():
    hashes, at = np.arange(1, 200, dtype=np.uint64) * np.uint64(7919), np.array([0, 50, 199])
    sig = minmax_dedup.min_max(hashes, at, 4)
    mul, add = minmax_dedup.permutations(4)
    for k in range(4):
        x = hashes * mul[k] + add[k]
        x ^= x >> np.uint64(32)
        x *= mul[k]
        assert sig[0, k] == x[:50].min() and sig[1, 4 + k] == x[50:].max()


# --- op8


def mix_table(spark, seed=1):
    rng = random.Random(seed)
    rows = [(i, "w " * rng.randint(0, 60), "en", rng.choice(["a", "b", "b", "b", "B", None]), 7) for i in range(300)]
    rows += [(300, None, None, "a", None), (5, "w w w", None, "a", None), (5, "w w w", None, "a", None), (None, "x y", None, "zz", None)]
    return rows, spark.createDataFrame(rows, DOCS)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = total - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[t] for t in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def test_mix_meets_targets(spark):
    rows, docs = mix_table(spark)
    docs = docs.withColumn("of", docs["source"])
    got = mixing.taken_words(docs, keys=("of",), block_words=16).toPandas()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    targets = brute_targets(sizes)
    assert len(got) == len(rows) and (got.taken <= 3 * got["size"]).all()
    for source, target in targets.items():
        some = got[got.of == source] if source is not None else got[got.of.isna()]
        assert np.allclose(some.target, target) and (some.source_size == sizes[source]).all()
        assert abs(some.taken.sum() - target) <= 16
    again = mixing.taken_words(docs.repartition(7), keys=("of",), block_words=16).toPandas()
    cols = ["doc_id", "of", "size", "taken"]
    assert rows_of(got, cols) == rows_of(again, cols)


def test_slots_spread_and_blocks_are_equal(spark):
    _, docs = mix_table(spark, 2)
    placed, mix = mixing.schedule(docs, block_words=16)
    slots = mix.groupBy("slot").sum("words").toPandas().sort_values("slot")
    assert slots["sum(words)"].median() == slots["sum(words)"].mode()[0]  # equal blocks, but for each source's last
    by_slot = mix.select("slot", "sid").distinct().toPandas().sort_values("slot")
    n = len(by_slot)
    for _, places in by_slot.reset_index(drop=True).groupby("sid").groups.items():
        gaps = np.diff(np.asarray(places))
        if len(gaps):
            assert gaps.max() <= 3 * n / len(places) + 2  # no source waits long


def test_small_sources_take_their_words(spark):
    rows = [(i, "w " * 1000, "en", f"a{i:02}", None) for i in range(20)] + [(100 + i, "w " * 10, "en", f"b{i:03}", None) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.taken_words(docs).toPandas()
    assert len(got) == len(rows) and ((got.target - got.taken).between(0, 1, inclusive="left")).all()
    assert mixing.mixed_documents(docs).select("source").distinct().count() == 320
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert rows_of(got, ["doc_id", "size", "source_size", "target", "taken"]) == rows_of(con.sql(mixing.ORACLE).df(), ["doc_id", "size", "source_size", "target", "taken"])
    _, mix = mixing.schedule(docs)
    assert mix.groupBy("slot").agg({"sid": "min", "words": "sum"}).count() == mix.select("slot", "sid").distinct().count()


def test_mixed_documents_hold_the_taken_words(spark):
    rows, docs = mix_table(spark, 3)
    docs = docs.selectExpr("*", "1 as size", "2 as taken")
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    taken = mixing.taken_words(docs, block_words=16).agg({"taken": "sum"}).first()[0]
    assert mixed.select(mixing.word_count(mixed["text"]).alias("n")).agg({"n": "sum"}).first()[0] == taken
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 and mixing.taken_words(docs.limit(0)).count() == 0
    blank = docs.filter("doc_id = 300")
    assert [(r.target, r.taken) for r in mixing.taken_words(blank).collect()] == [(0.0, 0)]


# --- op9


def test_ids_equal_the_tokenizers():
    from tokenizers import Tokenizer

    theirs, ours = Tokenizer.from_file(packing.tokenizer_path()), packing.codec(packing.tokenizer_path())
    rng = random.Random(6)
    texts = ["", " ", "  a  b ", "a \n b\n\n c", "\u00a0x \u2003y", "it's we'll  don't", "1 22  333", "<|endoftext|> x", "a<|endoftext|><|endoftext|>", "<|endof text|>", "a\x1c b \x85c", "你好 世界 🙂 "]
    texts += ["".join(rng.choice("aB1 .,'\n\t é\u00a0ß你 ") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for t in texts:
        assert np.frombuffer(ours.encode(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids, repr(t)


def test_bounds_hold_and_best_fit_packs():
    rng = np.random.default_rng(1)

    def fewest(lengths, capacity):  # exact, by trying every bin for every piece
        best = [len(lengths)]

        def place(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(lengths):
                best[0] = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + lengths[i] <= capacity:
                    place(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1 :]])
            place(i + 1, [*bins, lengths[i]])

        place(0, [])
        return best[0]

    for _ in range(60):
        lengths = rng.integers(1, 30, 8)
        bins, offsets, n = packing.best_fit_decreasing(lengths, 30)
        assert packing.lower_bound(lengths, 30) <= fewest(sorted(lengths.tolist(), reverse=True), 30) <= n
        for b in range(n):
            mine = np.flatnonzero(bins == b)
            mine = mine[np.argsort(offsets[mine])]
            assert offsets[mine].tolist() == np.concatenate([[0], np.cumsum(lengths[mine])[:-1]]).tolist() and lengths[mine].sum() <= 30


def check_packing(got, texts, capacity):
    tokens = packing.codec(packing.tokenizer_path())
    expected = []
    for d, t in texts:
        ids = tokens.encode(t or "") + b"\0\0\0\0"
        n = len(ids) // 4
        at, piece = 0, 0
        while at < n:
            size = (n % capacity or capacity) if piece == 0 else capacity
            expected.append((d, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
            at, piece = at + size, piece + 1
    assert rows_of(got, ["doc_id", "piece", "start", "length", "ids_crc32"]) == sorted(expected, key=repr)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= capacity


def test_packed_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = packing.query(spark, SF).toPandas()
    check_packing(got, texts, 2048)
    assert got.sequence_id.nunique() <= packing.lower_bound(got.length.to_numpy()) * 1.01 + 1
    exchanged = packing.pack_documents(docs, capacity=64, part_pieces=20)  # many partitions, exchanges
    small = exchanged.toPandas()
    check_packing(small, texts, 64)
    assert packing.certificate(exchanged, 64) == (small.sequence_id.nunique(), packing.lower_bound(small.length.to_numpy(), 64))
    assert small.sequence_id.nunique() <= packing.lower_bound(small.length.to_numpy(), 64) * 1.05 + 3
    odd = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "word " * 5000)]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    check_packing(packing.pack_documents(df).toPandas(), odd, 2048)
    assert packing.pack_documents(df.limit(0)).count() == 0


# --- op10


def test_trust_equals_sql_on_linked_pages(spark):
    rng = random.Random(3)
    hosts = ["a.net", "b.net", "c.example.org", "d.com", "e.com", "f.net", "good.org", "Bad.com"]
    rows = []
    for i in range(300):
        url = f"http://{rng.choice(hosts)}/{rng.choice(['fr', 'de', 'en', 'es'])}/{i}" if i % 17 else rng.choice([None, "nourl", "x://Y.Z?q", "http://org"])
        links = "".join(f"<a class=x href='//{'Bad.com' if url and 'b.net' in url else rng.choice(hosts)}/q'>x</a>" for _ in range(rng.randint(0, 4)))
        rows.append((i, url, links if i % 11 else None))
    pages = spark.createDataFrame(rows + rows[:20], "page_id long, url string, html string")
    got = link_trust.judge(pages).toPandas()
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    expected = con.sql(link_trust.oracle()).df()
    assert rows_of(got, list(expected.columns)) == rows_of(expected, list(expected.columns))
    by_host = got[got.rule.isna()].groupby("host").verdict.agg(set)
    assert by_host["a.net"] == {"allow"} and by_host[""] == {"allow"}
    assert link_trust.judge(pages.limit(0)).count() == 0


def test_no_number_of_steps_decides_a_verdict(spark):
    chain = [(i, f"http://h{i}.net/en/x", f"<a href='http://h{i + 1}.net/'>x</a>") for i in range(39)] + [(39, "http://h39.net/en/x", "<a href='http://bad.com/'>x</a>")]
    other = [(100, "http://bad.com/de/x", ""), (101, "http://good.org/", "<a href='http://friend.net/'>x</a>"), (102, "http://friend.net/en", "")]
    pages = spark.createDataFrame(chain + other, "page_id long, url string, html string")
    got = link_trust.judge(pages).toPandas()
    assert set(got[got.page_id < 40].verdict) == {"block"} and set(got[got.page_id > 100].verdict) == {"allow"}
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    expected = con.sql(link_trust.oracle()).df()
    assert rows_of(got, list(expected.columns)) == rows_of(expected, list(expected.columns))


def test_trust_flows_forward_and_distrust_backward(spark):
    edges = spark.createDataFrame([("good", "friend", 1), ("shady", "bad", 3), ("shady", "other", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("good", "trust", 1.0), ("bad", "distrust", 1.0)], "host string, kind string, share double")
    got = {r.host: r.standing for r in link_trust.standings(edges, seeds).collect()}
    assert got["friend"] == 1.0 and got["shady"] == -1.0 and "other" not in got


# --- pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "personal_data", "mix", "pack"]
    stage = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    lang = stage["language"](spark, docs, SF)
    assert {r.doc_id for r in lang.collect()} == {d for d, t in texts.items() if any(c.isalpha() for c in t or "")}
    deduped = stage["near_duplicates"](spark, lang, SF)
    labels = brute_components([(r.doc_id, r.text) for r in lang.collect()], 5, 80)
    assert sorted(r.doc_id for r in deduped.collect()) == sorted(set(labels.values()))
    masked = stage["personal_data"](spark, deduped, SF)
    assert masked.columns == docs.columns and masked.filter("text like '%@mail%'").count() == 0
    mixed = stage["mix"](spark, masked, SF)
    assert mixed.columns == docs.columns
    out = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= set(labels.values())


def test_every_stage_takes_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None, 1.0), (2, "", "en", "s", 0, 2.0), (None, "text without id", "en", None, None, 3.0), (3, "word " * 3000, "en", "s", None, 4.0), (3, "word " * 3000, "en", "s", None, 4.0)]
    docs = spark.createDataFrame(rows, DOCS + ", score double")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs, SF).count() <= 3 * len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0
