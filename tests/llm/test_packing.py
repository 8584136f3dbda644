"""Packing, prefix trie and vector codes against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import codebooks, packing, tries
from tidewire.llm.workload import QUERIES

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(20_000))
DOCS = [
    (1, "a  b\tc", 1.0, 7), (1, "a  b\tc", 1.0, 7), (1, "other text of an id", 1.0, 7), (2, None, None, None), (3, "", 2.0, 1), (None, "no id", 1.0, 1),
    (4, LONG, 1.0, 1), (5, "é 你好 \x00 <|endoftext|> \x1c x\x85 y's I'LL  \n\n z", 1.0, 1), (6, " " * 5000 + "x" * 5000, 1.0, 1),
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(FILE)


def check_packing(rows, docs, whole, capacity):
    """Pieces give back every document; sequences are gapless and need no padding."""
    want = sorted((doc is not None, doc or 0, tuple(whole.encode(text or "", add_special_tokens=False).ids) + (0,)) for doc, text in docs)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, tuple(ids.tolist()), r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for doc, pieces in by_doc.items():
        texts = [x[2] for x in want if (x[1] if x[0] else None) == doc]
        assert sum(len(p[1]) for p in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            assert sum((p[1] for p in sorted(pieces)), ()) == texts[0] and {p[2] for p in pieces} == {len(texts[0])}
            assert [p[0] for p in sorted(pieces)] == np.cumsum([0, *(len(p[1]) for p in sorted(pieces))])[:-1].tolist()
    assert {x[1] if x[0] else None for x in want} == set(by_doc)
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0


def test_packing_gives_back_every_document(spark, whole):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, Text double, start long").repartition(3)
    for capacity in (1024, 100):
        check_packing(packing.packed(docs, FILE, capacity).collect(), [(d[0], d[1]) for d in DOCS], whole, capacity)
    assert packing.packed(docs.limit(0), FILE).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet")
    check_packing(packing.packed(table, FILE).collect(), [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()], whole, 1024)


def test_packing_over_many_shards(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(packing, "STRETCH", 50)
    table = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    rows = packing.packed(table, FILE, 256).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()], whole, 256)
    assert len({r.sequence_id >> 32 for r in rows}) > 5


def test_pack_query_digests(spark, whole):
    got = QUERIES["op11_pack"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got:
        ids = np.array([*whole.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids)


def test_assignment_goes_to_the_cheapest_with_room():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1025, 3000).tolist()
    out = packing.assign(lengths)
    cost, whole_docs = defaultdict(float), defaultdict(int)
    for i, _, n, seq, _ in out:
        cost[seq] += packing.LINEAR * n + n * n
        whole_docs[i] += 1
    full = [c for s, c in cost.items() if packing.capacities(sum(lengths))[s] == 1024]
    assert sum(n for _, _, n, _, _ in out) == sum(lengths)
    # A sequence in one piece costs the most; the spread stays within the quadratic part of that.
    assert max(full) <= packing.LINEAR * 1024 + 1024**2 and min(full) >= packing.LINEAR * 1024
    # Brute force: replay each choice against all sequences.
    room, cost = packing.capacities(sum(lengths)).astype(int), np.zeros(len(packing.capacities(sum(lengths))))
    left = dict(enumerate(lengths))
    for i, _, n, seq, offset in out:
        assert left[i] == max(left.values()) and offset == packing.capacities(sum(lengths))[seq] - room[seq]
        fits = [s for s in range(len(room)) if room[s] >= left[i]] or [s for s in range(len(room)) if room[s] > 0]
        assert cost[seq] == min(cost[s] for s in fits) and n == min(left[i], room[seq])
        room[seq] -= n
        left[i] -= n
        cost[seq] += packing.LINEAR * n + n * n


def test_other_tokenizers_go_through_the_library(whole):
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as source:
        encode = packing.encoder(source.read())
    assert encode("Some WORDS here").tolist() == Tokenizer.from_file(path).encode("Some WORDS here", add_special_tokens=False).ids
    text = "".join(np.random.default_rng(5).choice(list("ab é\n\t '.1 你"), 3000))
    assert "".join(packing.stretches(text, 20)) == text
    with open(FILE, encoding="utf-8") as source:
        encode = packing.encoder(source.read())
    parts = [i for part in packing.stretches(text, 20) for i in encode(part).tolist()]
    assert parts == whole.encode(text, add_special_tokens=False).ids


def brute_trie(rows):
    """Rebuilt conversations and their nodes, from plain rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for way in members:
        if way:
            children[way[:-1]].append(way)
    out = {}
    for way in sorted(members, key=len, reverse=True):
        below = [out[w] for w in children[way]]
        saved = (len(members[way]) - 1) * len(way[-1][1].encode()) if way else 0
        out[way] = (
            min(members[way]), len(way), min(members[way[:-1]]) if way else None, len(members[way]), len(below),
            sum(b[5] for b in below) or 1, saved + sum(b[6] for b in below),
            hashlib.sha256(",".join(map(str, sorted(ends[way]))).encode()).hexdigest(),
        )
    return sorted(out.values(), key=str)


def trie_rows(spark, rows, **bounds):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, Turn int, depth string").repartition(3)
    built = tries.trie(tries.shared_starts(tries.sequences(table)), **bounds)
    return sorted(map(tuple, built.collect()), key=str)


def test_trie_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = []
    for conv in range(300):
        # A third of all conversations are equal, others share long beginnings.
        base = [f"t{i}" for i in range(30)] if conv % 3 == 0 else [f"p{i // 3}" for i in range(int(rng.integers(0, 25)))]
        tail = [] if conv % 3 == 0 else [f"é{x}" for x in rng.integers(0, 3, int(rng.integers(0, 6)))]
        rows += [(conv, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(base + tail)]
    rows += [(9, None, None, None), (9, 3, "user", "repeated"), (9, 3, "user", "repeated"), (9, 3, "user", "Another"), (9, 3, "user", "again")]
    rows += [(None, 1, "user", "no conversation"), (1003, 0, "user", ""), (1004, 0, None, "only turn"), (2000, 0, "user", "x" * 100_000)]
    want = brute_trie(rows)
    assert trie_rows(spark, rows) == want
    assert trie_rows(spark, rows, most_suffixes=60, most_turns=1500) == want


def test_trie_of_little(spark):
    assert trie_rows(spark, []) == []
    for rows in ([(3, 0, "a", "b")], [(1, 0, "a", "b"), (2, 0, "a", "b")], [(c, t, "r", "same") for c in range(6) for t in range(12)]):
        want = brute_trie(rows)
        assert trie_rows(spark, rows) == want
        assert trie_rows(spark, rows, most_suffixes=1) == want


def brute_codes(vectors, entries=256):
    """Plain Lloyd rounds in Python integers over (vec_id, embedding, label)."""
    kept = [(i, [math.floor(x * 1024) if abs(x) < 2**40 else int(x) * 1024 for x in v], label) for i, v, label in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max(len(v) for _, v, _ in kept) // 4))
    kept = [(i, v + [0] * (4 * width - len(v)), label) for i, v, label in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    out, books = [["", 0] for _ in kept], []
    for part in range(4):
        x = np.array([v[part * width:(part + 1) * width] for _, v, _ in kept], dtype=object)
        book = x[:entries].copy()
        for last in (0, 0, 0, 0, 1):
            code, far = [], []
            for row in x:
                d = ((book - row) ** 2).sum(axis=1).tolist()
                far.append(min(d))
                code.append(d.index(min(d)))
            if not last:
                for e in set(code):
                    mine = x[[c == e for c in code]]
                    book[e] = mine.sum(axis=0) // len(mine)
        books += [str(v) for row in book for v in row]
        for o, c, d in zip(out, code, far):
            o[0] += f"{c:02x}"
            o[1] += d
    totals = defaultdict(int)
    for (_, _, label), (_, error) in zip(kept, out):
        totals[label] += error
    digest = hashlib.sha256(",".join(books).encode()).hexdigest()
    clip = lambda v: v if v < 2**63 else None
    return sorted(((i, code, clip(error), clip(totals[label]), digest) for (i, _, label), (code, error) in zip(kept, out)), key=str)


def code_rows(spark, vectors, entries=256):
    table = spark.createDataFrame([(*v, "x", 1) for v in vectors], "vec_id long, embedding array<float>, label int, code string, Label int").repartition(3)
    coded, books = codebooks.compressed(table, entries=entries)
    rows = codebooks.label_errors(coded)
    return sorted(((r.vec_id, r.code, r.error, r.label_error, codebooks.digest(books)) for r in rows.collect()), key=str)


def test_codes_brute_force(spark):
    rng = np.random.default_rng(11)
    vectors = [(int(i), np.float32(rng.normal(0, 0.1, 12) + rng.integers(0, 4)).tolist(), None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(500)]
    # Coarse components give many ties.
    vectors += [(600 + i, np.float32(rng.integers(0, 2, 12) / 1024).tolist(), 5) for i in range(200)]
    vectors += [(7, [0.5] * 12, 1), (7, [0.25] * 12, 1), (7, [0.25] * 12, 1), (None, [0.1] * 12, None), (901, [0.5, 0.5], 1), (902, [], 1)]
    vectors += [(903, None, 1), (904, [0.1, None] * 6, 1), (905, [float("nan")] * 12, 1), (906, [float("inf")] * 12, 1)]
    for entries in (256, 17):
        assert code_rows(spark, vectors, entries) == brute_codes(vectors, entries)


def test_codes_of_huge_components(spark):
    rng = np.random.default_rng(12)
    vectors = [(i, np.float32(rng.normal(0, 1, 8)).tolist(), i % 2) for i in range(60)]
    vectors += [(3, [3e38] * 8, 0), (70, [-3e38, 1e20] * 4, 0), (71, [5e5] * 8, 1), (72, [1e12] * 8, 2), (73, [1e5, -1e6] * 4, 3)]
    vectors = [(i, np.float32(v).tolist(), label) for i, v, label in vectors]
    assert code_rows(spark, vectors, 20) == brute_codes(vectors, 20)


def test_codes_of_little(spark):
    assert code_rows(spark, [(1, None, 1)]) == []
    for vectors in ([(1, [1.0, 2.0], 1)], [(1, [], None), (2, [], 1)], [(5, [0.5] * 4, 1)] * 3):
        assert code_rows(spark, vectors) == brute_codes(vectors)


def test_bounds_skip_groups_and_change_nothing():
    rng = np.random.default_rng(13)
    x = rng.integers(-500, 500, (400, 6))
    book = x[:64].copy()
    history, state, scanned = [book[None]], None, []
    for _ in range(6):
        at, bound, stamp, best, n = codebooks.reassigned(x, history, 0, state)
        far = codebooks.squared(x, history[-1][0])
        assert (at == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        scanned.append(n)
        assert len(np.unique(stamp)) <= len(history)
        state, new = (at, bound, stamp), history[-1][0].copy()
        for e in np.unique(at):
            new[e] = x[at == e].sum(axis=0) // (at == e).sum()
        history.append(new[None])
    assert scanned[-1] < scanned[0] / 2
