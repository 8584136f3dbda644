"""Names that clash, huge numbers, forced collisions, spam templates, long bucket lists."""

from __future__ import annotations

import itertools
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewire.llm import chat, dedup, jaccard, langid, licenses, mixing, packing, pieces, simhash, topk, toxicity, tries, urls
from tidewire.llm.workload import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
CLASHES = ["_text", "Score", "a.b", "_own_score", "_0", "_row", "_id", "n", "Kept", "`q`", "places", "component_id", "copies", "rate"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Documents with columns named like the operators' own."""
    rows = [(i, t, "en", "s", 5) for i, t in ((1, "some words of a text here"), (1, "some words of a text here"), (2, None), (3, ""), (None, "x y"), (4, "damn " * 40))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return table.select("*", *[F.lit(f"value of {i}").alias(name) for i, name in enumerate(CLASHES)])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_clashing_names(spark, clashing, name, stage):
    out = stage(spark, clashing, SF)
    rows = out.collect()
    assert len(rows) > 0
    if name != "sentencepiece":
        assert out.columns == clashing.columns
    else:
        assert out.columns == [c for c in clashing.columns if c != "text"] + ["ids", "n_pieces"]
    assert all(list(r.asDict().values())[out.columns.index("a.b")] == "value of 2" for r in rows)


def test_operators_take_clashing_names(spark, clashing):
    labels = clashing.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit(1).alias("Toxic_"), F.lit(1).alias("n"))
    assert toxicity.toxicity(clashing, labels).count() == 6
    assert mixing.mix(clashing).count() == 6 and simhash.near_groups(clashing).count() == 6 and dedup.exact_groups(clashing).count() == 6
    assert langid.languages(clashing).count() == 6 and pieces.digests(clashing).count() == 6 and jaccard.near_groups(clashing).count() == 6
    assert licenses.scan(clashing).count() == 0
    pages = clashing.select("*", F.col("doc_id").alias("page_id"), F.col("text").alias("url"))
    assert urls.judged(pages, spark.createDataFrame([], "url string, blocked boolean")).count() == 6


def test_operators_on_empty_tables(spark, clashing):
    none = clashing.limit(0)
    labels = none.select("doc_id", F.lit(1).alias("toxic"))
    assert toxicity.toxicity(none, labels).count() == langid.languages(none).count() == jaccard.near_groups(none).count() == 0
    assert urls.judged(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url")), spark.createDataFrame([("http://a.b/c", True)], "url string, blocked boolean")).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted(chat.branches(chat.linear(turns))).count() == 0 and tries.trie(tries.sequences(turns)).count() == 0


def test_repeated_turns_and_rows(spark, clashing):
    turns = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "last")], "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.formatted(chat.branches(chat.linear(turns)))).first()
    assert [t.text for t in back.turns] == ["a", "a", "b", "last"]
    labels = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    for rows in (toxicity.toxicity(clashing, labels).where("doc_id = 1").collect(), langid.languages(clashing).where("doc_id = 1").collect()):
        assert len(rows) == 2 and rows[0] == rows[1]


def test_colliding_identifiers_are_noticed(spark, monkeypatch):
    """Two texts whose chunks share an identifier stay apart."""
    rows = spark.createDataFrame([(1, "one text"), (2, "another text"), (3, "one  text"), (4, None)], "doc_id long, text string")
    want = [(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 1)]

    def groups():
        return sorted((r.doc_id, r.keep_id, r.group_size) for r in dedup.exact_groups(rows).collect())

    assert groups() == want and dedup.verified_identifier(rows) is dedup.short_identifier
    weak = lambda chunk: F.struct(F.lit(1).alias("a"), F.lit(2).alias("b"))
    monkeypatch.setattr(dedup, "short_identifier", weak)
    assert dedup.verified_identifier(rows) is dedup.long_identifier and groups() == want


def test_huge_components_take_no_part_in_search(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100, [3e38] * 4), (120, [1e9, 0.0, 0.0, 0.0]), (140, [1e7, 0.0, 0.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    ids = {(r.query_id, r.vec_id) for r in got.collect()}
    assert {q for q, _ in ids} == {0, 20, 40, 140} and not {100, 120} & {v for _, v in ids}


def test_repeated_queries_agree_with_their_sql(spark):
    import duckdb

    table = spark.createDataFrame([(0, [0.5, 0.25]), (0, [0.25, 0.5]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (20, [0.1, 0.1])], "vec_id long, embedding array<float>")
    embeddings = table.toArrow()
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    want = sorted(con.execute(ORACLES["op9_topk"]).fetchall())
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(table).collect()) == want


def test_long_spam_templates_are_mined_in_time(spark):
    long = "/".join(f"part{i}" for i in range(30))
    labelled = [(f"http://spam.shop/{long}", True)] * 100 + [(f"http://fine.shop/item/{i}", False) for i in range(100)]
    # Nearly always together: every URL lacks one of the parts.
    labelled += [("http://more.shop/" + "/".join(f"x{k}" for k in range(30) if k != i % 30), True) for i in range(120)]
    start = time.time()
    rules = urls.mined_rules(spark.createDataFrame(labelled, "url string, blocked boolean")).collect()
    assert time.time() - start < 60
    assert rules and all(r.confidence >= 0.8 and r.support >= urls.MIN_ROWS for r in rules)
    pages = spark.createDataFrame([(1, f"http://spam.shop/{long}"), (2, "http://fine.shop/item/3"), (3, "http://more.shop/x1/x2")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judged(pages, spark.createDataFrame(labelled, "url string, blocked boolean")).collect()}
    assert got == {1: "block", 2: "allow", 3: "block"}


def test_tokens_beyond_those_fp_growth_sees_make_rules(spark):
    """Two parts that block only together stand behind twelve that are blocked more often."""
    busy = [f"f{i}" for i in range(12)]
    labelled = [("/".join(["http://x.shop", *busy[:i % 12], *busy[i % 12 + 1:], "p", "q"]), True) for i in range(48)]
    labelled += [("/".join(["http://x.shop", *busy[i % 12:i % 12 + 5]]), i % 3 > 0) for i in range(60)]
    labelled += [(f"http://x.shop/{part}/{i}", False) for i in range(40) for part in "pq"]
    rules = urls.mined_rules(spark.createDataFrame(labelled, "url string, blocked boolean")).collect()
    assert ["path=p", "path=q"] in [r["items"] for r in rules]
    pages = spark.createDataFrame([(1, "http://x.shop/p/new/q"), (2, "http://x.shop/p/new"), (3, "http://x.shop/q")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judged(pages, spark.createDataFrame(labelled, "url string, blocked boolean")).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow"}


def test_rules_do_not_depend_on_what_fp_growth_sees(spark):
    """Against all sets of tokens, counted."""
    rng = np.random.default_rng(11)
    labelled = []
    for _ in range(400):
        parts = [f"p{i}" for i in range(6) if rng.random() < 0.6]
        spam = {"p1", "p2"} <= set(parts) or {"p3", "p4", "p5"} <= set(parts)
        labelled.append(("http://h.net/" + "/".join(parts), bool(rng.random() < (0.9 if spam else 0.3))))
    df = spark.createDataFrame(labelled, "url string, blocked boolean")
    rows = [(frozenset(r.t), r.blocked) for r in df.select(urls.tokens(F.col("url")).alias("t"), "blocked").collect()]
    want = {}
    for size in range(1, 7):
        for items in itertools.combinations([f"path=p{i}" for i in range(6)], size):
            hits = [blocked for t, blocked in rows if t >= set(items)]
            if len(hits) >= 20 and sum(hits) >= 0.8 * len(hits):
                want[items] = (len(hits), sum(hits) / len(hits))
    want = {i: v for i, v in want.items() if not any(set(j) < set(i) and w[1] >= v[1] for j, w in want.items())}
    assert any(len(i) > 1 for i in want)
    for seen in (1, 99):
        found = {tuple(r["items"]): (r.support, r.confidence) for r in urls.mined_rules(df, max_tokens=seen).collect()}
        assert found == want, seen


def test_rules_of_one_token_by_counting(spark):
    rng = np.random.default_rng(10)
    labelled = [(f"http://h{rng.integers(6)}.net/p{rng.integers(8)}?q{rng.integers(3)}", None) for _ in range(900)]
    labelled = [(u, bool(("h1." in u and rng.random() < 0.95) or ("/p2" in u and rng.random() < 0.9) or rng.random() < 0.1)) for u, _ in labelled]
    df = spark.createDataFrame(labelled, "url string, blocked boolean")
    found = {r["items"][0]: (r.support, round(r.confidence, 9)) for r in urls.mined_rules(df).collect() if len(r["items"]) == 1}
    rows = df.select(urls.tokens(F.col("url")).alias("t"), "blocked").collect()
    want = {}
    for token in {t for r in rows for t in r.t}:
        hits = [r.blocked for r in rows if token in r.t]
        if len(hits) >= urls.MIN_ROWS and sum(hits) >= urls.MIN_CONFIDENCE * len(hits):
            want[token] = (len(hits), round(sum(hits) / len(hits), 9))
    assert set(found) <= set(want) and all(found[t] == want[t] for t in found)
    # A class of tokens that always occur together has one rule.
    assert {f for f in found.values()} == set(want.values())


def test_explicit_rules_in_place_and_by_join(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    none = spark.createDataFrame([], "url string, blocked boolean")
    here = sorted(map(tuple, urls.judged(pages, none).collect()), key=str)
    monkeypatch.setattr(urls, "INLINE_RULES", 0)
    assert sorted(map(tuple, urls.judged(pages, none).collect()), key=str) == here
    want = {}
    for r in pages.collect():
        host = r.url.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].lower() if r.url and "://" in r.url else ""
        rest = r.url.split("://", 1)[1][len(host):] if host else ""
        path = rest.split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want[r.page_id] = (host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow")
    assert {r[0]: r[1:5] for r in here} == want


def test_bucket_tasks_compare_every_pair(spark, monkeypatch):
    """In tasks of a mixed bucket any two members of different labels meet somewhere."""
    monkeypatch.setattr(jaccard, "NODE_ROWS", 8)
    keys = [bytes([i]) * 4 for i in range(60)]
    members = spark.createDataFrame([(bytearray(k), 10, 7) for k in keys], "key binary, size long, node long")
    labels = spark.createDataFrame([(bytearray(k), bytearray(keys[0])) for k in keys[1:40]], "node binary, root binary")
    tasks = {}
    for r in jaccard._mixed_tasks(members, labels).collect():
        tasks.setdefault(r.task, set()).add(bytes(r.key))
    label = {k: keys[0] if i < 40 else k for i, k in enumerate(keys)}
    met = {(a, b) for t in tasks.values() for a in t for b in t}
    assert all((a, b) in met for a in keys for b in keys if label[a] != label[b])
    assert max(map(len, tasks.values())) < 30
    stars = {}
    for r in jaccard._star_tasks(members).collect():
        stars.setdefault(r.task, set()).add(bytes(r.key))
    assert all(min(keys) in t for t in stars.values()) and set().union(*stars.values()) == set(keys)


def test_registered_queries_agree_with_the_library_functions(spark):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for name in ("op1_mix", "op6_simhash", "op10_sentencepiece"):
        assert {r.doc_id for r in QUERIES[name](spark, SF).collect()} == ids
    assert packing.capacities(1500).tolist() == [1024, 256, 128, 64, 16, 8, 4]


def test_training_memory_is_a_few_bytes_an_ngram(monkeypatch):
    """The driver trains: nothing but a number by n-gram may be held for all words at once; chunks do not change the model."""
    monkeypatch.setattr(toxicity, "STEPS", 3)
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    texts = [" ".join("".join(w) for w in letters[rng.integers(0, 26, (200, 9))]) + (" vile" if i % 2 else "") for i in range(300)]
    labels = [i % 2 for i in range(300)]
    ngrams = len(toxicity.subwords([w for w in dict.fromkeys(w for t in texts for w in t.split())])[0])
    tracemalloc.start()
    scores, bias = toxicity.train(texts, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ngrams > 1_000_000 and peak < 35 * ngrams
    monkeypatch.setattr(toxicity, "CHUNK", 700)
    monkeypatch.setattr(toxicity, "WORDS_AT_ONCE", 90)
    again = toxicity.train(texts, labels)
    assert again[1] == bias and np.array_equal(again[0], scores)


@pytest.mark.parametrize("per_task", [100_000, 7])
def test_components_use_no_more_tasks_than_their_edges_need(spark, monkeypatch, per_task):
    """A chain, a star and a pair, dealt over far more partitions than cores."""
    edges = [(i, i + 1) for i in range(100, 130)] + [(500, i) for i in range(200, 220)] + [(900, 901), (901, 900), (7, 7)]
    tasks, cut = [], simhash.cut_lineage
    monkeypatch.setattr(simhash, "cut_lineage", lambda rows: tasks.append(rows.rdd.getNumPartitions()) or cut(rows))
    monkeypatch.setattr(simhash, "EDGES_PER_TASK", per_task, raising=False)
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        found = simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(48)).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = {i: 100 for i in range(101, 131)} | {i: 200 for i in [*range(201, 220), 500]} | {901: 900}
    assert sorted((r.node, r.root) for r in found) == sorted(expected.items())
    assert len(tasks) > 2 and max(tasks[1:]) <= max(spark.sparkContext.defaultParallelism, -(-52 // per_task))
