"""Each operator against a plain version, an exact round trip or held-out accuracy, and on odd inputs."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudfeatures.llm import chat, components, decontam, langid, neardup, packing, quality, sharding, topk, toxicity, urls
from fraudfeatures.llm.common import table
from fraudfeatures.llm.components import connected_components

DOC = "doc_id long, text string, lang string, source string, n_chars long, shard string, row_no string, score string"
ODD = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 5, "x", "y", "z"),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 5, None, "y", "z"),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 5, None, "y", "z"),
    (3, None, None, None, None, None, None, None),
    (4, "", "", "", 0, "", "", ""),
    (None, "one two three", "fr", "b", -1, "x", "y", "z"),
    (None, None, None, None, None, None, None, None),
    (5, "12 34 !! \u00e9", "fr", "b", 3, "x", "y", "z"),
    (6, "word " * 30_000, "en", "b", 150_000, "x", "y", "z"),
    (7, "<|endoftext|> \u212b \ufb01 \u0130 x", "en", "b", 9, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def oracle(small, sql):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return con.execute(sql).fetchdf()


def same(spark_df, frame):
    got = spark_df.toPandas()
    assert sorted(got.columns) == sorted(frame.columns)
    columns = sorted(got.columns)
    rows = lambda x: sorted(map(str, x[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(frame)


def word_sets(rows, size):
    out = {}
    for doc_id, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        out[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    return out


def components_of(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near_components(sets, top, bottom):
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and bottom * both >= top * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return components_of(ids, links)


def test_components(spark):
    links = [(1, 2), (3, 2), (9, 4), (4, 8), (8, 7), (7, 6), (6, 5), (5, 5), (20, 21), (21, 22), (22, 19), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = components_of({x for p in links for x in p if x}, [p for p in links if p[0] and p[0] != p[1]])
    assert got == want


def test_components_of_a_long_chain_take_few_tables(spark, monkeypatch):
    """Ascending, descending and shuffled chains of 1,000 ids: tables grow with the logarithm, not with the length."""
    written, frozen = [], components.frozen
    monkeypatch.setattr(components, "frozen", lambda df, name: written.append(name) or frozen(df, name))
    rng = np.random.default_rng(2)
    for order in (np.arange(1000), np.arange(1000)[::-1], rng.permutation(1000)):
        written.clear()
        links = [(int(a), int(b)) for a, b in zip(order, order[1:], strict=False)]
        got = connected_components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
        assert len(got) == 1000 and {r["component"] for r in got} == {0}
        assert len(written) <= 24, written
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("words,similarity", [(3, (85, 100)), (5, (4, 5))])
def test_near_duplicates_against_all_pairs(spark, small, words, similarity):
    docs = table(spark, small, "documents")
    sets = word_sets([(r["doc_id"], r["text"]) for r in docs.collect()], words)
    want = near_components(sets, *similarity)
    got = {r["doc_id"]: r for r in neardup.near_duplicate_groups(docs, words, similarity).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) and r["n_shingles"] == len(sets[i]) for i, r in got.items())


def test_near_duplicates_link_chains_and_large_groups(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 10_000, 120)]
    rows, words = [], list(base)
    for i in range(60):  # a chain that drifts away from its start
        words = list(words)
        words[rng.integers(len(words))] = f"x{i}"
        rows.append((i, " ".join(words)))
    for i in range(100, 260):  # copies of one text, each changed a little
        words = list(base)
        words[rng.integers(len(words))] = f"y{i}"
        rows.append((i, " ".join(words)))
    sets = word_sets(rows, 3)
    want = near_components(sets, 85, 100)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, (85, 100)).collect()}
    assert got == want


def test_near_duplicates_odd_rows(odd, empty):
    got = neardup.near_duplicate_groups(odd, 3, (85, 100)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[3]["kept"] and by[4]["n_shingles"] == 0
    assert by[6]["n_shingles"] == 1 and by[None]["component_id"] is None and by[None]["kept"]
    assert neardup.near_duplicate_groups(empty).collect() == []


def test_communication_matrix_has_its_margins_and_distribution():
    matrix = sharding.communication_matrix([5, 0, 7, 3], [4, 4, 4, 3], 1)
    assert [sum(r) for r in matrix] == [5, 0, 7, 3] and [sum(c) for c in zip(*matrix, strict=True)] == [4, 4, 4, 3]
    seen = Counter(sharding.communication_matrix([3, 3], [2, 4], seed)[0][0] for seed in range(4000))
    for value, chance in ((0, 0.2), (1, 0.6), (2, 0.2)):
        assert abs(seen[value] / 4000 - chance) < 0.03


def test_sharding(spark, small, odd, empty):
    rows = sharding.op2_sharding(spark, small).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, small, "documents").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])
        assert r["law"] == "rows" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.op2_sharding(spark, small).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}
    few = sharding.shuffle_into_shards(odd, 3).collect()
    assert len(few) == len(ODD) and few[0].__fields__[:8] == odd.columns and few[0].__fields__[8:] == ["_shard", "slot"]
    assert sharding.shuffle_into_shards(empty, 3).count() == 0


def test_shuffle_is_uniform(spark):
    """Where a row lands does not depend on where it was."""
    df = spark.range(0, 4000, 1, 4)
    got = sharding.shuffle_into_shards(df, 8, seed=5, blocks=16).collect()
    counts = np.zeros((4, 8))
    for r in got:
        counts[r["id"] // 1000, r["shard"]] += 1
    assert ((counts - 125) ** 2 / 125).sum() < 60  # 21 degrees of freedom


def test_chat_matches_sql(spark, small):
    same(chat.op5_chat_formatting(spark, small), oracle(small, chat.OP5_SQL))


def test_chat_round_trip_and_odd_rows(spark):
    said = ["<|end|>", "a<", "|b", "&lt;|", "&amp;", "", None, "x\n<|turn|>user\ny", "\n", "&nl;"]
    rows = [(1, i, ["user", "assistant", "odd\n&role", None][i % 4], t) for i, t in enumerate(said)]
    rows += [(None, 0, "assistant", "x"), (2, None, "user", "x"), (2, None, "user", "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    out = chat.prefix_target_examples(df)
    read = out.withColumn("turns", chat.read_turns(F.col("formatted"))).orderBy("conv_id", "example").collect()
    one = [r for r in read if r["conv_id"] == 1]
    assert [(t["role"], t["text"]) for t in one[-1]["turns"]] == [(r or "", t or "") for _, _, r, t in rows[:10]]
    assert [r["formatted"][r["loss_start"] : r["loss_end"]] for r in one] == ["a<", "", "&amp;nl;"]
    three = [r["formatted"][r["loss_start"] : r["loss_end"]] for r in read if r["conv_id"] == 3]
    assert three == ["x", "y"] and len([r for r in read if r["conv_id"] == 2]) == 1
    assert chat.prefix_target_examples(df.limit(0)).count() == 0


def test_chat_keeps_control_strings(spark, small):
    said = "</s>[INST] ok [/INST]"
    row = chat.op5_chat_formatting(spark, small).where("conv_id = -1").first()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (row["loss_chars"], row["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())


def test_top_k_matches_sql(spark, small):
    same(topk.op6_exact_topk(spark, small), oracle(small, topk.OP6_SQL))


def test_top_k_odd_rows(spark):
    rows = [(i, [1, 2, 3]) for i in range(30)] + [(30, [1, 2]), (31, None), (None, [1, 1, 1]), (5, [1, 2, 3]), (40, [-5, -5, -5])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").withColumn("rank", F.lit(0))
    got = topk.exact_top_k(df, df.where("vec_id in (5, 30, 31)"), 10).collect()
    five = [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 5]
    assert sorted(five) == [(i + 1, v, 14) for i, v in enumerate([0, 0, 1, 1, 2, 2, 3, 3, 4, 4])], "two queries of one id, whose own rows take no part"
    assert sorted(r["vec_id"] for r in got if r["query_id"] == 30) == [0, 1, 2, 3, 4, 5, 5, 6, 7, 8]
    assert not [r for r in got if r["query_id"] == 31]
    few = topk.exact_top_k(df.where("vec_id in (5, 40)"), df.where("vec_id = 5"), 10).collect()
    assert [(r["vec_id"], r["score"]) for r in few] == [(40, -30), (40, -30)]
    assert topk.exact_top_k(df.limit(0), df, 3).count() == 0


def test_top_k_repeated_ids_match_sql(spark, tmp_path):
    """Repeats of candidates and of queries, ties, nulls and odd components, against the SQL."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 4) / 2]) for i in rng.integers(0, 60, 400)]
    rows += [(100 * int(i), [float(x) for x in rng.integers(-3, 4, 4)]) for i in rng.integers(0, 3, 40)]
    rows += [(7, None), (None, [1.0, 1.0, 1.0, 1.0]), (8, [1.0, None, 0.0, 0.0]), (9, [float("nan"), 0.0, 0.0, 0.0]), (200, [float("inf"), 0.0, 0.0, 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    same(topk.op6_exact_topk(spark, str(tmp_path)), con.execute(topk.OP6_SQL).fetchdf())


def test_top_k_usable(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, None],), ([float("nan")],), ([float("inf")],), (None,)], "v array<float>")
    assert [r[0] for r in df.select(topk.usable(F.col("v"))).collect()] == [True, False, False, False, False]
    assert df.limit(1).select(topk.integer_vector(F.lit([-0.0001, 0.5]).alias("x"))).first()[0] == [-1, 512]


def test_packing_pieces(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packing(rows, packing.op8_packing(spark, small).toPandas())


def test_packing_odd_rows(odd, empty):
    got = packing.pieces_digest(packing.retrieval_packing(odd, packing.tokenizer_path())).toPandas()
    check_packing([(r[0], r[1]) for r in ODD if r[0] and r[0] != 2], got[got.doc_id.notna() & (got.doc_id != 2)], whole=False)
    assert (got.doc_id == 2).sum() >= 2 and got.doc_id.isna().sum() >= 2
    assert packing.retrieval_packing(empty, packing.tokenizer_path()).count() == 0


def check_packing(rows, pieces, whole=True):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.tokenizer_path())
    assert sorted(pieces.doc_id.unique()) == sorted(i for i, _ in rows)
    texts = dict(rows)
    for doc_id, own in pieces.groupby("doc_id"):
        ids, at = np.array([*plain.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for p in own.sort_values("start").itertuples():
            assert (p.start, p.doc_tokens) == (at, len(ids))
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    if whole:
        for _, own in pieces.sort_values("offset").groupby("sequence_id"):
            assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
            total = own.length.sum()
            assert total <= 2048 and total & (total - 1) == 0


def test_packing_prefers_neighbours():
    rng = np.random.default_rng(0)
    texts = [rng.integers(1000 * (i % 4), 1000 * (i % 4) + 200, 500).astype(np.uint16) for i in range(40)]
    index = packing.Bm25(texts, np.ones(2**16), 500.0)
    windows = packing.fill_windows(texts, index, 2048)
    alike = [len({i % 4 for i, _, _ in w}) for w in windows[:6]]
    assert sum(a == 1 for a in alike) >= 4


def test_packing_neighbours_over_shards(spark):
    """Planted pairs share a window however many shards the table has: nine in ten at least."""
    from tokenizers import Tokenizer

    whole = sorted(w[:-4] for w in Tokenizer.from_file(packing.tokenizer_path()).get_vocab() if w.endswith("</w>") and w[:-4].isalpha() and w.isascii())
    rng = np.random.default_rng(8)
    vocabulary = rng.permutation(whole)[:3000].tolist()
    for n in (160, 640, 2560):
        docs = []
        for doc_id in range(n // 2):
            topic = [vocabulary[i] for i in rng.integers(400, 3000, 12)]
            for i in (doc_id, doc_id + n // 2):
                text = [vocabulary[j] for j in rng.integers(0, 400, 150)] + [topic[j] for j in rng.integers(0, 12, 50)]
                docs.append((i, " ".join(rng.permutation(text).tolist())))
        pieces = packing.pieces_digest(packing.retrieval_packing(spark.createDataFrame(docs, "doc_id long, text string"), packing.tokenizer_path(), 256, shard=40)).toPandas()
        if n == 160:
            check_packing(docs, pieces, whole=False)
        assert (pieces.sequence_id // 2**32).nunique() >= n // 80
        held = pieces.groupby("doc_id").sequence_id.agg(set)
        together = np.mean([bool(held[i] & held[i + n // 2]) for i in range(n // 2)])
        print(n, together)
        assert together >= 0.9, (n, together)  # in shards dealt at random 0.25, 0.06 and 0.02 of the pairs could meet


def test_packing_tells_lone_rests_apart():
    keys = [b"aabb", b"aabbcc", b"aacc", b"dd", b"dd", b"ee"]
    for cut in range(7):
        x = pd.DataFrame({"key": keys})
        got = pd.concat(list(packing.told_apart(iter([x.iloc[:cut], x.iloc[cut:]]), "key", 2)))
        assert got["key"].tolist() == keys and got["near"].tolist() == [True, True, False, True, True, False]
    assert list(packing.told_apart(iter([]), "key", 2)) == []


def test_packing_scores_all_terms():
    rng = np.random.default_rng(9)
    texts = [rng.integers(0, 300, 200).astype(np.uint16) for _ in range(30)]
    index, seed = packing.Bm25(texts, np.linspace(1, 2, 2**16), 200.0), np.arange(300, dtype=np.uint16)
    alone = sum(index.scores(seed[i : i + 1]) for i in range(300))
    assert np.allclose(index.scores(seed), alone)
    used = np.arange(30) % 2 == 0
    assert np.allclose(index.without(used).scores(seed), np.where(used, 0, alone))


def test_decontamination(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"t{i}" for i in range(400)]
    draw = lambda n: [vocabulary[i] for i in rng.integers(0, 400, n)]
    items = [(i, draw(int(n))) for i, n in enumerate(rng.integers(5, 60, 40))]
    docs, planted = [], set()
    for doc_id in range(240):
        text = draw(300)
        if doc_id % 2:
            item_id, words = items[doc_id % 40]
            words = list(words)
            for _ in range(int(rng.integers(0, int(0.2 * len(words)) + 1))):
                at, how = int(rng.integers(len(words))), rng.integers(3)
                words[at : at + (how != 1)] = [] if how == 0 else [f"new{doc_id}"]
            at = int(rng.integers(0, 300))
            text[at:at] = words
            planted.add((doc_id, item_id))
        docs.append((doc_id, ("\n" if doc_id % 3 else " ").join(text).upper() + "."))
    docs_df = spark.createDataFrame([*docs, (None, None), (500, "")], "doc_id long, text string").withColumn("edits", F.lit("x"))
    bench = spark.createDataFrame([*((i, " ".join(w)) for i, w in items), (90, None), (91, ""), (None, "x")], "item_id long, text string")
    found = decontam.find_leaks(docs_df, bench).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    want = set()
    for doc_id, text in docs:  # brute force: exact edit distance everywhere
        w = np.array([int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in re.findall(r"\w+", text.lower())], np.uint64)
        for item_id, words in items:
            h = np.array([int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in words], np.uint64)
            if decontam.edits_within(h, w)[0] <= int(0.2 * len(h)):
                want.add((doc_id, item_id))
    assert len((planted & want) - got) <= 0.02 * len(planted)
    assert got <= want and len(got) >= 0.98 * len(want)
    assert all(r["similarity"] >= 0.8 for r in found)
    flags = {r["doc_id"]: r["leak"] for r in docs_df.withColumn("leak", decontam.leaks(F.col("text"), bench)).collect()}
    assert {i for i, leak in flags.items() if leak} == {i for i, _ in got}
    assert decontam.find_leaks(docs_df, bench.limit(0)).count() == 0 and decontam.find_leaks(docs_df.limit(0), bench).count() == 0


def test_decontamination_reaches_its_recall():
    """Items with all the edits that are allowed, in texts of other words, as long as those of the given tables."""
    rng = np.random.default_rng(12)
    items = [(i, " ".join(f"v{x}" for x in rng.integers(0, 20_000, n))) for i, n in enumerate(rng.integers(20, 80, 300).tolist())]
    few, many = (decontam.Index(items, recall=r) for r in (0.5, 0.99))
    assert len(few.bits) < len(many.bits) <= decontam.MOST_WALKS
    found = {len(few.bits): 0, len(many.bits): 0}
    for number, (_, w) in enumerate(many.items):
        text, _ = decontam.edited(w, many.edits[number], rng)
        around = rng.integers(0, 2**63, (2, 150), np.uint64)
        whole = np.concatenate([around[0], text, around[1]])
        assert decontam.edits_within(w, whole)[0] <= many.edits[number]
        for index in (few, many):
            found[len(index.bits)] += any(x[1] == number for x in index.find([whole]))
    assert found[len(many.bits)] >= 0.98 * len(items) and found[len(few.bits)] <= found[len(many.bits)]


def test_recall_that_cannot_be_reached_is_refused(monkeypatch):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(20)]
    assert len(decontam.Index(items, 0.2, 0.99).bits) >= 1
    monkeypatch.setattr(decontam, "MOST_WALKS", 1)
    with pytest.raises(ValueError):
        decontam.Index(items, 0.2, 0.999999)
    assert neardup.least_depth(0.8, 16) >= 1
    with pytest.raises(ValueError):
        neardup.least_depth(0.3, 16)


def test_decontamination_ties_and_long_texts():
    item, cache = " ".join(f"t{i}" for i in range(30)), decontam.WordHashes()
    index = decontam.Index([(0, item), (1, item)])
    filler = " ".join(f"f{i}" for i in range(200_000))
    text = decontam.words(f"{filler} {item} {filler} {item} {filler}", cache)
    assert index.find([text]) == [(0, 0, 200_000, 30, 0), (0, 1, 200_000, 30, 0)], "of two equal places the first"


def test_decontamination_refuses_large_benchmarks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "MOST_ITEMS", 3)
    bench = spark.createDataFrame([(i, f"a b {i}") for i in range(4)], "item_id long, text string")
    with pytest.raises(ValueError, match="in parts"):
        decontam.find_leaks(spark.createDataFrame([(1, "a b 1")], "doc_id long, text string"), bench)


def test_decontamination_lays_unrounded_windows():
    item, cache = " ".join(f"t{i}" for i in range(50)), decontam.WordHashes()
    index, laid = decontam.Index([(0, item)]), []
    keys = index.keys
    index.keys = lambda windows: laid.extend(w.tobytes() for w in windows) or keys(windows)
    want = decontam.words(item, cache).tobytes()
    for before in range(12):
        laid.clear()
        text = decontam.words(" ".join([*(f"f{i}" for i in range(before)), item]), cache)
        assert [x[1:] for x in index.find([text])] == [(0, before, 50, 0)]
        assert want in laid, before


def test_edits_within():
    assert decontam.edits_within(np.array([1, 2, 3]), np.array([9, 1, 3, 9]))[0] == 1
    assert decontam.edits_within(np.array([1, 2, 3]), np.array([9, 1, 2, 3, 9]))[0] == 0
    assert decontam.edits_within(np.array([1, 2, 3]), np.array([], int)) == (3, 0)


def test_language_id(spark, odd, empty):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.fit(langid.training_rows(docs))
    rows = docs.where("lang IS NOT NULL").select("doc_id", "lang", langid.is_held_out(F.col("doc_id")).alias("held_out"), langid.language(F.col("text"), model).alias("found")).where("held_out").collect()
    assert np.mean([r["lang"] == r["found"]["lang_pred"] for r in rows]) > 0.97
    got = [r[0] for r in odd.select(langid.language(F.col("text"), model)).collect()]
    assert [g["lang_pred"] == "und" for g in got] == [not re.search(r"[^\W\d_]", t[1] or "") for t in ODD]
    assert all(0 <= g["score"] <= 1 for g in got)
    assert langid.fit(langid.training_rows(empty)) is None
    assert {r[0]["lang_pred"] for r in odd.select(langid.language(F.col("text"), None)).collect()} == {"und"}


def test_language_gradients():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (5, 7)), rng.integers(0, 2, 5)
    model = langid.train(x, y, ["a", "b"], hidden=3, steps=1)
    for name in ("inputs", "state"):
        setattr(model, name, [a.astype(np.float64) for a in getattr(model, name)])

    def loss(direction):
        return float((model.states(x.T, direction).astype(np.float64) ** 2).sum())

    for direction in (0, 1):
        d_in, d_state = langid._backward(model, x.T, direction, 2 * model.states(x.T, direction))
        for weight, grad in ((model.inputs[direction], d_in), (model.state[direction], d_state)):
            for _ in range(6):
                at = tuple(rng.integers(0, s) for s in weight.shape)
                at = (at[0], int(x[0, 0]), at[2]) if weight.shape[1] == 256 else at
                old, e = weight[at], 1e-3
                weight[at] = old + e
                up = loss(direction)
                weight[at] = old - e
                down = loss(direction)
                weight[at] = old
                assert abs((up - down) / (2 * e) - grad[at]) < 0.02 * (1 + abs(grad[at]))


def area(label, score):
    label, score = np.array(label), np.array(score)
    good, bad = score[label == 1], score[label == 0]
    return ((good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2) if len(good) and len(bad) else 1.0


def test_toxicity(spark, odd, empty):
    data = "/root/testdata/sf0.1"
    labels = table(spark, data, "labels")
    rows = toxicity.op7_toxicity(spark, data).join(labels, "doc_id").where("held_out").collect()
    assert area([r["toxic"] for r in rows], [r["score"] for r in rows]) > 0.9
    machine = toxicity.fit(table(spark, data, "documents").select("doc_id", "text"), labels)
    calm = "the answer is in the other part of the text and nothing more "
    worst = lambda t: machine.worst_of(toxicity.stream(t))
    insult = toxicity.bytes_of(machine.landmarks[0])
    for form in (insult, " ".join(insult), insult[:2] + "*" + insult[2:], insult.upper(), ".".join(insult)):
        assert worst(calm + form + " " + calm) > worst(calm), form
    got = [r[0] for r in odd.select(toxicity.toxicity(F.col("text"), machine)).collect()]
    assert all(0 <= s <= 1 for s in got)
    assert toxicity.fit(empty.select("doc_id", "text"), labels) is None
    assert {r[0] for r in odd.select(toxicity.toxicity(F.col("text"), None)).collect()} == {0.0}


def coded(word):
    return b"\0" + bytes(ord(c) - 96 for c in word) + b"\0"


def subsequence_values(word):
    """All subsequences of four characters within six, by what they weigh: the definition, without codes."""
    out = Counter()
    for at in itertools.combinations(range(len(word)), 4):
        if at[-1] - at[0] < 6:
            out[bytes(word[i] for i in at)] += 0.6 ** (at[-1] - at[0] - 3)
    return out


@pytest.fixture(scope="module")
def machine():
    rng = np.random.default_rng(0)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 10)))
    clean = [[word() for _ in range(30)] for _ in range(60)]
    insults = ["brackwort", "stinkmolch", "dumfbeutel"]
    toxic = [[*(word() for _ in range(30)), insults[i % 3]] for i in range(60)]
    documents = [(0, list(map(coded, ws))) for ws in clean] + [(1, list(map(coded, ws))) for ws in toxic]
    return insults, toxicity.train(documents, landmarks=24)


def test_collapsed_weights_equal_the_kernel(machine):
    """The sum of looked-up weights is the sum over landmarks of coefficients times kernel values."""
    _, m = machine
    marks = [subsequence_values(w) for w in m.landmarks]
    for word in (coded("brackwort"), coded("brackxwort"), coded("abcab"), coded("ab"), m.landmarks[0] + (b"" if m.landmarks[0][-1:] == b"\0" else b"\0")):
        own = subsequence_values(word)
        kernel = [sum(v * own[x] for x, v in mark.items()) / np.sqrt(sum(v * v for v in mark.values())) for mark in marks]
        want = np.dot(kernel, m.coefficients) / toxicity.word_norm(np.array([len(word)]))[0] + m.bias
        assert abs(m.words([word])[0] - want) < 1e-4, word


def test_tolerance_comes_from_the_kernel(machine):
    """Letters put in, left out or changed, which normalization does not touch: still nearer to toxic than clean words are."""
    insults, m = machine
    rng = np.random.default_rng(1)
    clean = [coded("".join(chr(97 + c) for c in rng.integers(0, 26, 9))) for _ in range(300)]
    usual = np.quantile(m.words(clean), 0.99)
    for insult in insults:
        forms = [insult[:4] + "x" + insult[4:], insult[:3] + "q" + insult[3:6] + "z" + insult[6:], insult[:5] + insult[6:], insult[:4] + "x" + insult[5:]]
        assert all(bytes(toxicity.stream(f)) == coded(f) for f in forms), "normalization changes nothing"
        assert (m.words([coded(f) for f in forms]) > usual).all() and m.words([coded(insult)])[0] > 0


def test_quality_views_teach_each_other(spark):
    """Forty labels, and texts that differ in rare words alone: what the page view is sure of tells the text view these words, so that
    documents of a source that says nothing are told apart, too. Without rounds they hardly are."""
    rng = np.random.default_rng(5)
    words = {y: [f"{'bg'[y]}{i}" for i in range(3000)] for y in (0, 1)}
    rows, marks, truth = [], [], {}
    for i in range(2400):
        truth[i] = y = int(rng.random() < 0.5)
        text = [f"c{j}" for j in rng.integers(0, 300, 30)] + [words[y][j] for j in rng.integers(0, 3000, 12)]
        source = f"{'bg'[y]}-site" if i % 3 else "mixed"
        rows.append((i, " ".join(rng.permutation(text).tolist()), "en", source, 200))
    labelled = [i for i in truth if i % 3 and i % 60 in (1, 31)]
    marks = [(i, truth[i]) for i in labelled]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(marks, "doc_id long, quality int")
    areas = {}
    for rounds in (0, 3):
        views = quality.fit(docs, labels, rounds=rounds)
        got = {r["doc_id"]: r["s"] for r in docs.where("source = 'mixed'").select("doc_id", quality.quality_of(docs, views).alias("s")).collect()}
        areas[rounds] = area([truth[i] for i in got], list(got.values()))
    assert areas[0] < 0.8 < 0.95 < areas[3], areas
    again = quality.fit(docs.repartition(7), labels)
    assert np.allclose(again.combination, views.combination, atol=1e-6), "counts over all documents, in any order"


def test_quality_cutoffs():
    decision, label = np.array([-3.0, -2, -2, -1, 0, 1, 2, 3, 4, 5, 6]), np.array([0, 0, 0, 0, 0, 1, 0, 1, 1, 1, 1.0])
    assert quality.cutoffs(decision, label, 0.9) == (0.0, np.inf)
    assert quality.cutoffs(decision, label, 0.8) == (2.0, 1.0)
    assert quality.cutoffs(np.zeros(11), label, 0.9) == (-np.inf, np.inf)  # ties count together


def test_quality(spark, odd, empty):
    data = "/root/testdata/sf0.01"
    labels = table(spark, data, "labels")
    rows = quality.op10_quality(spark, data).join(labels, "doc_id").where("held_out").collect()
    assert area([r["quality"] for r in rows], [r["score"] for r in rows]) > 0.9
    views = quality.fit(table(spark, data, "documents"), labels)
    got = [r[0] for r in odd.select(quality.quality_of(odd, views)).collect()]
    assert len(got) == len(ODD) and all(0 <= s <= 1 for s in got)
    assert quality.fit(empty, labels) is None


def test_url_parts_and_rules(spark):
    cases = [
        ("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
        ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/de", "x.com", "/de", None, None),
        ("http://x.net?a=/b", "x.net", "", None, None),
        ("//x.net/a", "", "", None, None),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("", "", "", None, None),
        (None, "", "", None, None),
    ]
    df = spark.createDataFrame([(c[0], "mine") for c in cases], "url string, host string")
    got = urls.judge(df, None).collect()
    for row, (_, host, path, rule, verdict) in zip(got, cases, strict=True):
        assert (row["_host"], row["path"], row["rule"], row["verdict"]) == (host, path, rule, verdict or "allow")
        assert row["host"] == "mine"


def test_url_suffixes_count_all_labels(spark):
    rows = [(f"http://h{i}.s{i % 5}.com/{i}", int(i % 5 == 0)) for i in range(300)]
    model = urls.fit(spark.createDataFrame(rows, "url string, bad int"), trees=2, labelled_rows=40)
    assert {tuple(r) for r in model.suffixes.collect()} == {(f"s{i}.com", 60, 60.0 * (i == 0)) for i in range(5)}
    assert model.base == 0.2
    own = spark.createDataFrame([(rows[0][0], 1.0), (rows[1][0], 0.0)], "url string, bad double")
    got = urls._assembled(own, "url", model.suffixes, model.base, "features", "bad").orderBy("url").collect()
    for row, bad in zip(got, (59, 0), strict=True):  # its own label is left out
        assert np.allclose(row["features"].toArray()[-2:], [np.log1p(59), (bad + 4) / 79])


def url_parts(url):
    """Host and path by string methods."""
    url = url or ""
    at = url.find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    ends = lambda text, stops: min([len(text), *(text.index(c) for c in stops if c in text)])
    host = rest[: ends(rest, "/?#")]
    path = rest[len(host) :]
    return "".join(c.lower() if c.isascii() else c for c in host), path[: ends(path, "?#")]


def test_url_verdicts_against_plain_version(spark):
    """Host, path and rule of every given page, repeats, odd and long URLs, and the verdict of each that a rule fits."""
    pages = table(spark, "/root/testdata/sf0.01", "pages").select("page_id", "url")
    odd_urls = ["", None, "x", "://", "a://", "HTTP://Sub.Example.ORG/ES/", "http://example.org/es/" + "x/" * 50_000, "a://b.com/fr/?/de/", "a://c.com#/de/", "a://\u00c9.com/de/\n"]
    more = spark.createDataFrame([(-i - 1, u) for i, u in enumerate(odd_urls * 2)], "page_id long, url string")
    pages = pages.unionByName(more)
    model = urls.fit(urls.labelled_urls(pages, table(spark, "/root/testdata/sf0.01", "labels")))
    got = urls.judge(pages, model).collect()
    assert len(got) == pages.count()
    for r in got:
        host, path = url_parts(r["url"])
        fits = [x for x in urls.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.host) + len(x.path), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.host + best.path), r["url"]
        assert r["verdict"] == (best.verdict if best else "block" if r["score"] >= 0.5 else "allow") and 0 <= r["score"] <= 1
    by_url = {}
    assert all(by_url.setdefault(r["url"], r["verdict"]) == r["verdict"] for r in got)


def test_url_trees_on_held_out_urls(spark):
    """The trees learn from three quarters of labelled URLs and judge the last quarter; hosts of one kind are bad."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1200):
        bad = int(rng.random() < 0.3)
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(3)]
        url = f"http://{words[0]}.s{rng.integers(0, 40)}.net/" + (f"{rng.integers(10**8)}?{words[1]}={rng.integers(10**6)}&a=1" if bad != (rng.random() < 0.05) else "/".join(words))
        rows.append((url, bad))
    model = urls.fit(spark.createDataFrame(rows[:900], "url string, bad int"), trees=8)
    scored = {r["url"]: r["score"] for r in urls.judge(spark.createDataFrame(rows[900:], "url string, bad int"), model).collect()}
    assert area([b for _, b in rows[900:]], [scored[u] for u, _ in rows[900:]]) > 0.9


def test_url_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert urls.op3_url_filter(spark, str(tmp_path)).count() == 0
    spark.createDataFrame([(1, "a://x.com/de/1", ""), (2, None, None)], "page_id long, url string, html string").write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["verdict"] for r in urls.op3_url_filter(spark, str(tmp_path)).collect()}
    assert got == {1: "block", 2: "allow"}, "without labels only the rules judge"


def test_url_trees(spark, small):
    rows = [(f"http://good.net/page/{i}", 0) for i in range(150)] + [(f"http://spam.net/x?a={i}&b={i * 7919}&c=1&d=2", 1) for i in range(80)]
    labelled = spark.createDataFrame([*rows, (None, 1), ("http://x.net/", None)], "url string, bad int")
    model = urls.fit(labelled, trees=4)
    new = spark.createDataFrame([("http://good.net/page/777",), ("http://spam.net/x?a=5&b=99999&c=1&d=2",), (None,)], "url string")
    got = urls.judge(new, model).collect()
    assert [r["verdict"] for r in got][:2] == ["allow", "block"] and 0 <= got[2]["score"] <= 1
    assert urls.fit(labelled.where("bad = 0")) is None
    pages = urls.op3_url_filter(spark, small).collect()
    assert len(pages) == table(spark, small, "pages").count() and {r["verdict"] for r in pages} <= {"allow", "block"}
