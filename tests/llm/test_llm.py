"""The training-data operators against brute force, and on nulls, empty, repeated and clashing input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import chat, dedup, jaccard, langid, licenses, mixing, pieces, simhash, topk, toxicity, urls
from tidewire.llm.workload import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, copies long, size string"
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(20_000))
ROWS = [
    (1, "a  b\tc", "en", "s", 7, 0.5, 9, "x"), (2, "a b c", "en", "s", 5, None, None, None), (2, "a b c", "en", "s", 5, None, None, None),
    (3, None, None, None, None, None, None, None), (4, "", "en", None, 0, 1.0, 1, ""), (None, "no id here", None, "t", 1, 1.0, 1, "y"),
    (5, LONG, "en", "t", 1, 1.0, 1, "y"), (6, LONG + " end", "en", "t", 1, 1.0, 1, "y"), (7, "é ▁ 你好 \x00", "xx", "u", 1, 1.0, 1, "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_on_odd_and_empty_rows(spark, odd):
    """All but the last stage give back the columns of documents, clashing names included."""
    for rows, some in ((odd, True), (odd.limit(0), False)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.columns == rows.columns, name
            assert (out.count() > 0) == some, name
        out = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
        assert out.count() == rows.count() and {"ids", "n_pieces"} <= set(out.columns)


def test_stages_decide(spark, odd):
    exact = sorted((r.doc_id or -1) for r in dedup.deduplicated(odd).collect())
    assert exact == [-1, 1, 3, 5, 6, 7]
    near = sorted((r.doc_id or -1) for r in simhash.deduplicated(odd).collect())
    assert 6 not in near and {-1, 3, 5, 7} <= set(near) and 2 not in near


def test_mix_meets_targets(spark, documents):
    rows = mixing.mix(documents).toPandas()
    assert (rows.taken <= 3 * rows["size"]).all() and (rows.taken % rows["size"].clip(lower=1) == 0).all()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), total=("size", "sum"), most=("size", "max"))
    assert (abs(by.taken - by.target) <= by.most).all()
    assert np.isclose(by.target.sum(), rows["size"].sum()) and (by.target <= 3 * by.total + 1e-6).all()
    expected = (rows.rate * rows["size"]).groupby(rows.source).sum()
    assert np.allclose(expected, by.target, rtol=1e-6)
    again = mixing.mix(documents.repartition(5)).toPandas()
    assert rows.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_targets_brute_force(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, None: 500}
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    weight, left, want = dict(zip(["a", "b", "c", None], (1, 2, 3, 1))), sum(sizes.values()), {}
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in sizes if x not in want) for s in sizes if s not in want}
        over = [s for s in share if share[s] >= 3 * sizes[s]]
        if not over:
            break
        for s in over:
            want[s] = 3 * sizes[s]
            left -= want[s]
    assert got == pytest.approx(want | share)


def test_simhash_brute_force(spark, documents, odd):
    copies = documents.limit(40).select((F.col("doc_id") + 10_000).alias("doc_id"), F.concat(F.col("text"), F.lit(" tail")).alias("text"))
    rows = documents.select("doc_id", "text").unionByName(copies).unionByName(odd.select("doc_id", "text"))
    got = simhash.near_groups(rows).collect()
    fps = np.array([r.fp for r in got], dtype=np.int64).view(np.uint64)
    ids = [r.doc_id for r in got]
    label = list(range(len(got)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(got)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            label[root(int(j))] = root(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    assert [r.component_id for r in got] == [least.get(root(i)) for i in range(len(got))]
    plain = documents.select("doc_id", F.split(F.trim(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), r"[\x20\x09-\x0D]+").alias("w")).where("doc_id > 100 AND size(w) >= 4 AND w[0] <> '' AND w[size(w) - 1] <> ''").limit(3).collect()
    texts = {r.doc_id: r.fp for r in got}
    for r in plain:
        shingles = spark.createDataFrame([(" ".join(r.w[i:i + 4]),) for i in range(len(r.w) - 3)], "s string")
        hashes = [x[0] & (2**64 - 1) for x in shingles.select(F.xxhash64("s")).collect()]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert texts[r.doc_id] & (2**64 - 1) == want


def test_near_copies_by_jaccard_brute_force(spark, monkeypatch):
    """The pipeline's stage keeps one text of each component of pairs with five-word Jaccard 0.8 or more."""
    rng = np.random.default_rng(4)
    texts = []
    for base in range(60):
        words = [f"v{x}" for x in rng.integers(0, 5000, int(rng.integers(40, 300)))]
        texts.append(words)
        for edits in (1, 1, 2, 3, 5, 8, 12):
            copy = list(words)
            for at in rng.integers(0, len(copy), max(1, edits * len(copy) // 400)):
                copy[at] = f"new{rng.integers(1 << 30)}"
            texts.append(copy)
    line = [f"common{i}" for i in range(12)]
    texts += [line + [f"u{i}x{k}" for k in range(6)] for i in range(30)] + [["few", "words"], ["few", "Words"], []]
    sets = [{tuple(w.lower() for w in t[i:i + 5]) for i in range(max(1, len(t) - 4))} for t in texts]
    alike = simhash.Forest(len(sets))
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert sum(5 * len(sets[i] & sets[j]) < 4.5 * len(sets[i] | sets[j]) for i, j in pairs) > 50
    alike.join(*np.array(pairs).T)
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for node_rows, node_bytes, unit_bytes in ((1024, 16 << 20, 16 << 20), (1024, 16 << 20, 0), (4, 16 << 20, 4096), (1024, 8192, 0)):
        monkeypatch.setattr(jaccard, "NODE_ROWS", node_rows)
        monkeypatch.setattr(jaccard, "NODE_BYTES", node_bytes)
        monkeypatch.setattr(jaccard, "UNIT_BYTES", unit_bytes)
        kept = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, rows, SF).collect())
        assert kept == sorted(set(alike.label.tolist()))


def test_near_copies_of_the_pipeline_by_simhash_as_well(spark):
    """Texts that SimHash links are one group, though they share too few five-word shingles, as is what either has in common with others."""
    line = " ".join(f"common{i}" for i in range(41))
    far = [(i, f"{line} " * 30 + " ".join(f"own{i}x{k}" for k in range(20))) for i in (7, 8)]
    words = [f"v{k}" for k in range(120)]
    near = [(9, far[0][1] + " end"), (3, " ".join(words)), (4, " ".join([*words, "end"])), (None, "no id"), (5, "alone")]
    rows = spark.createDataFrame([*far, *near], "doc_id long, text string")
    sets = [set(jaccard.shingles(t).tolist()) for _, t in far]
    assert 5 * len(sets[0] & sets[1]) < 4 * len(sets[0] | sets[1])
    assert (simhash.fingerprint(far[0][1]) ^ simhash.fingerprint(far[1][1])).bit_count() <= simhash.RADIUS
    kept = sorted((r.doc_id or -1) for r in corpus_pipeline.drop_near_copies(spark, rows, SF).collect())
    assert kept == [-1, 3, 5, 7]


def test_index_search_is_exact():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 30, dtype=np.uint64)
    values = np.unique(np.concatenate([values, *[values ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)) for _ in range(40)]]))
    values = values[np.argsort(simhash.gray_rank(values))]
    forest, plain = simhash.Forest(len(values)), simhash.Forest(len(values))
    simhash.link_within(values, np.arange(len(values)), forest)
    a, b = np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    plain.join(a, b)
    assert (forest.label == plain.label).all()


def test_large_nodes_are_split(spark, monkeypatch):
    rng = np.random.default_rng(2)
    values = np.unique(np.uint64(0x123456789ABCDEF0) ^ (np.uint64(1) << rng.integers(0, 64, (400, 3)).astype(np.uint64)).sum(axis=1))
    monkeypatch.setattr(simhash, "NODE_ROWS", 32)
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = simhash.components(simhash.links(table).select(F.col("fp").alias("a"), F.col("root").alias("b"))).collect()
    forest = simhash.Forest(len(values))
    forest.join(*np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4))
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    got = simhash.Forest(len(values))
    got.join(np.array([place[r.node] for r in found]), np.array([place[r.root] for r in found]))
    assert (got.label == forest.label).all()


def test_topk_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(120)] + [(500 + i, [0.5] * 8) for i in range(60)]
    rows += [(40, [9.0] * 8), (1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1003, [float("inf")] * 8), (None, [1.0] * 8), (1004, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in topk.top_k(table).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = [(i, np.floor(np.pad(np.array(v, dtype=np.float32).astype(float), (0, 8 - len(v))) * 64).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q in {i for i, _ in usable if i % 20 == 0}:
        vector = min((v.tolist() for i, v in usable if i == q))
        best = sorted((-int(np.dot(vector, v)), i) for i, v in usable if i != q)[:20]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert topk.top_k(table.limit(0)).count() == 0 and topk.top_k(table.where("vec_id = 20")).count() == 0


def test_trees_become_conversations(spark):
    rows = [
        ("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "good", 2.0), ("t", 3, 1, "assistant", "bad", 1.0), ("t", 4, 3, "user", "more </s> \\ <|im_end|>", 5.0),
        ("u", 7, 99, None, None, None), ("c", 1, 2, "user", "x", 0.0), ("c", 2, 1, "user", "y", 0.0), ("c", 3, 1, "user", "z", 0.0), (None, 1, None, "assistant", "n\\<|im_end|", 0.0),
    ]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    out = {(r.tree, r.leaf): r for r in chat.read_back(chat.formatted(chat.branches(messages))).collect()}
    assert set(out) == {("t", 2), ("t", 4), ("u", 7), (None, 1)}
    assert out["t", 4]["rank"] == 1 and out["t", 2]["rank"] == 2
    assert [(t.role, t.text) for t in out["t", 4].turns] == [("user", "q"), ("assistant", "bad"), ("user", "more </s> \\ <|im_end|>")]
    assert out["t", 4].loss_text == "bad" and out["u", 7].turns[0].text == "" and out[None, 1].loss_text == "n\\<|im_end|"
    assert all(c not in t for r in out.values() for t in [r.formatted.replace(chat.START, "").replace(chat.SEP, "").replace(chat.END, "")] for c in chat.CONTROL)
    assert [r.leaf for r in chat.branches(messages, best=1).where("tree = 't'").select("leaf").distinct().collect()] == [4]


def test_url_rules_and_mining(spark):
    pages = [(1, "http://A.Example.com/en/7/x?q"), (2, "https://x.example.com/en/8"), (3, "http://y.example.net/de/81"), (4, "http://y.example.net/de/1#a"), (5, None), (6, "no scheme"), (7, "http://bad.shop/buy?ref=x"), (7, "http://bad.shop/buy?ref=x"), (8, "http://fine.shop/look"), (9, "http://notexample.com/en/7")]
    labelled = [(f"http://{h}.shop/{p}/{i}", h == "bad") for i in range(60) for h, p in (("bad", "buy"), ("fine", "look"))] + [("http://bad.shop/", None)]
    got = {(r.page_id): r for r in urls.judged(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labelled, "url string, blocked boolean")).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [
        ("example.com/en/7", "allow"), ("com/en/", "block"), ("example.net/de/8", "block"), ("net/de/", "allow"),
        (None, "allow"), (None, "allow"), (None, "block"), (None, "allow"), ("com/en/", "block"),
    ]
    assert (got[1].host, got[1].path, got[5].host, got[6].path) == ("a.example.com", "/en/7/x", "", "")
    rules = urls.mined_rules(spark.createDataFrame(labelled, "url string, blocked boolean")).collect()
    assert rules and all(r.confidence >= urls.MIN_CONFIDENCE and len(r["items"]) == 1 for r in rules)
    assert urls.mined_rules(spark.createDataFrame([], "url string, blocked boolean")).count() == 0


def test_licenses_brute_force(spark, documents, odd):
    text = dict(licenses.TEMPLATES)["MIT"]
    words = text.split()
    broken = " ".join(["changed" if i in (20, 50) else w for i, w in enumerate(words)])
    more = spark.createDataFrame([(9001, "pre amble here " * 9 + text.upper() + " post" * 30), (9002, "x " * 11 + broken), (9003, " ".join(words[:20]))], "doc_id long, text string")
    rows = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(more)
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(rows).collect()}
    listed = spark.createDataFrame(list(licenses.TEMPLATES), "doc_id string, text string")
    templates = {r.doc_id: set(r.w[i:i + 5][k] and tuple(r.w[i:i + 5]) for i in range(len(r.w) - 4) for k in (0,)) for r in listed.select("doc_id", licenses.words(F.col("text")).alias("w")).collect()}
    texts = rows.select("doc_id", licenses.words(F.col("text")).alias("w")).collect()
    for r in texts:
        runs = [tuple(r.w[i:i + 5]) for i in range(len(r.w) - 4)]
        for name, shingles in templates.items():
            length, step = licenses._window(len(shingles))
            if len(shingles & set(runs)) < 0.8 * len(shingles):
                assert (r.doc_id, name) not in got
                continue
            best = max(len(shingles & set(runs[max(0, s - step):max(0, s - step) + length + 2 * step])) / len(shingles) for s in range(0, max(1, len(runs)), step))
            assert (best >= 0.8) == ((r.doc_id, name) in got), (r.doc_id, name, best)
    assert (9001, "MIT") in got and (9002, "MIT") in got and (9003, "MIT") not in got
    assert licenses.scan(rows.limit(0)).count() == 0 and licenses.scan(rows, ()).count() == 0


def test_pieces_equal_the_library(documents, odd):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    machine = pieces.Transducer(pieces.load())
    texts = [r.text for r in documents.select("text").limit(80).collect()] + ["", " ", "  a ", "\n\t x", "aaaaaaaaab", "🙂 ▁x", "</s><0x0A>"]
    for text in texts:
        ids = np.frombuffer(machine.encode(text), dtype="<i4").tolist()
        assert ids == library.encode(text)
        assert machine.decode(ids) == text.replace("▁", " ")
    digest = {r.doc_id: r for r in pieces.digests(odd).collect()}
    assert digest[3].n_pieces == 0 and digest[4].round_trip and digest[5].round_trip and not digest[7].round_trip


def test_user_defined_pieces_are_refused(tmp_path):
    def piece(text, kind):
        body = bytes([10, len(text)]) + text + bytes([24, kind])
        return bytes([10, len(body)]) + body

    path = tmp_path / "model"
    path.write_bytes(piece(b"<unk>", 2) + piece(b"a", 1))
    assert pieces.load(str(path))["pieces"] == [("<unk>", 0.0, 2), ("a", 0.0, 1)]
    path.write_bytes(piece(b"<unk>", 2) + piece(b"<sep>", 4))
    with pytest.raises(ValueError, match="user-defined"):
        pieces.load(str(path))


def test_unigram_path_is_shortest():
    model = {"pieces": [("<unk>", 0, 2), ("▁", -3, 1), ("a", -3, 1), ("b", -3, 1), ("ab", -4, 1), ("▁a", -4.5, 1), ("ba", -1, 1)], "bpe": False, "prefix": True}
    machine = pieces.Transducer(model)
    assert [model["pieces"][i][0] for i in machine.shortest("▁aba")] == ["▁a", "ba"]


def test_rare_language_is_learned(spark, monkeypatch):
    """A language that the first texts by id hash do not hold is predicted all the same."""
    monkeypatch.setattr(langid, "MAX_TEXTS", 10)
    rows = [(i, f"the plain words of number {i} in this common tongue", "en") for i in range(400)]
    rows += [(1000 + i, f"жук цап {i} шум ящик", "zz") for i in range(6)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in langid.sampled(table, table.select("doc_id"), 10).collect()} == {"en"}
    assert set(langid.fit(table)["classes"]) == {"en", "zz"}
    assert {r.lang_pred for r in langid.languages(table).where("doc_id >= 1000").collect()} == {"zz"}


def test_models_on_held_out_rows(spark, odd):
    big = "/root/testdata/sf0.01"
    large = "/root/testdata/sf0.1"
    tox = QUERIES["op2_toxicity"](spark, large).join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (tox.predicted == tox.toxic).mean() > 0.9 and tox[tox.toxic == 0].predicted.mean() < 0.03
    lang = QUERIES["op7_langid"](spark, big).join(spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").toPandas()
    assert (lang.lang_pred == lang.lang).mean() > 0.95
    assert all(bool(h) == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(lang.doc_id, lang.held_out))
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(odd, none).collect()} == {0.0}
    got = {r.doc_id: r for r in langid.languages(odd).collect()}
    assert got[3].lang_pred == "und" and got[4].lang_pred == "und" and got[5].lang_pred in ("en", "xx")
    assert {r.lang_pred for r in langid.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
