"""Conversation prefix trie, built as a burst trie.

A conversation is a string over turn ids; an id is 128 bits of the SHA-256 of role and text, so
texts never move. Equal conversations are counted first and travel as one. The trie starts as one
head, the root, over containers: all suffixes that go on with the same next turn. A container of
more than MOST suffixes or turns bursts: the turns all its suffixes share become a path of head
nodes, and what follows is dealt into new containers by its next turn id. Rounds of bursting touch
the oversized containers only and end when there are none, so however many conversations share a
beginning, no task holds more than one bounded container. The others are sorted by Spark, the
containers spread over shards by their id, and swept into nodes, whose sums add up from the leaves;
the sums of a container's top node are then added to the heads above it, round by round upwards.

A conversation's ids, 24 bytes a turn, are one row; nothing else grows with a single key. The ids
of conversations that end at one node are gathered in runs of END_RUN and hashed as a stream.

Rows without conv_id are left out. Null roles and texts are empty; null turns come first; equal
turns are ordered by role, then text. Repeated rows are turns each. Texts of any length only count
their bytes. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import named, self_contained, stored

# Suffixes and turns of a container; ids of one run of ends; nodes of an Arrow batch.
MOST_SUFFIXES, MOST_TURNS = 4096, 1 << 16
END_RUN_BITS = 12
BATCH_NODES = 1 << 14
NO_ENDS = hashlib.sha256(b"").hexdigest()
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"

self_contained(__name__)


def _cut(rows: DataFrame) -> DataFrame:
    return stored(rows, "trie")


def _short(content: Column) -> Column:
    return F.substring(F.unhex(F.sha2(content, 256)), 1, 16)


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): per conversation the ids of its turns, in order, and the bytes of their texts."""
    rows = named(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("known"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    head = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"))
    rows = rows.withColumns({"id": _short(F.concat(head, F.col("text")).cast("binary")), "bytes": F.octet_length("text").cast("long")})

    def collected(turns: DataFrame, *order: str) -> DataFrame:
        return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*order, "id", "bytes"))).alias("turns"))

    def parts(table: DataFrame) -> DataFrame:
        return table.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.bytes").alias("sizes"))

    def alike(a: Column, b: Column) -> Column:
        return a["known"].eqNullSafe(b["known"]) & a["turn"].eqNullSafe(b["turn"]) & (a["role"] == b["role"]) & (a["id"] != b["id"])

    own = collected(rows.drop("text"), "known", "turn", "role")
    after, last = F.slice("turns", 2, F.size("turns")), F.size("turns") - 1
    own = _cut(own.withColumn("tied", F.exists(F.zip_with(F.slice("turns", 1, last), after, alike), lambda x: x)))
    if own.where("tied").isEmpty():
        return parts(own)
    # Only conversations that hold different texts under one turn and role need the texts to be ordered.
    tied = rows.join(own.where("tied").select("conv_id"), "conv_id", "left_semi")
    return parts(own.where("NOT tied")).unionByName(parts(collected(tied, "known", "turn", "role", "text")))


def shared_starts(rows: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversation c begins with the first crc32(c) % `most` turns of c - c % `every`, then has its own turns after as many."""
    own = _cut(rows)
    base = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.col("ids").alias("_ids"), F.col("sizes").alias("_sizes"))
    own = own.withColumn("_h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int"))
    both = own.join(base, own["conv_id"] - own["conv_id"] % every == base["_base"], "left")

    def joined(theirs: str, ours: str) -> Column:
        rest = F.slice(ours, F.col("_h") + 1, F.size(ours))
        return F.when(F.col("_base").isNull(), rest).otherwise(F.concat(F.slice(theirs, 1, F.col("_h")), rest))

    return both.select("conv_id", joined("_ids", "ids").alias("ids"), joined("_sizes", "sizes").alias("sizes"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs (seq, run) to (seq, ends): the digest of all runs of a sequence, joined by commas."""
    seq, state, out = None, None, []
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key == seq:
                state.update(b"," + text.encode())
                continue
            if state is not None:
                out.append((seq, state.hexdigest()))
            seq, state = key, hashlib.sha256(text.encode())
        if len(out) >= BATCH_NODES:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["seq", "ends"])
            out = []
    if state is not None:
        out.append((seq, state.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["seq", "ends"])


def distinct_sequences(rows: DataFrame) -> DataFrame:
    """(ids, sizes, n, conv, ends): each different sequence, its conversations counted, the smallest, and the digest of all."""
    rows = _cut(rows.withColumn("seq", F.sha2(F.array_join(F.transform("ids", F.hex), "").cast("binary"), 256)))
    runs = rows.groupBy("seq", F.shiftright("conv_id", END_RUN_BITS).alias("run")).agg(F.array_sort(F.collect_list("conv_id")).alias("convs"))
    runs = runs.select("seq", "run", F.array_join(F.col("convs").cast("array<string>"), ",").alias("convs"))
    ends = runs.repartition("seq").sortWithinPartitions("seq", "run").select("seq", "convs").mapInArrow(_hashed, "seq string, ends string")
    counted = rows.groupBy("seq", "ids", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv"))
    return counted.join(ends, "seq").drop("seq")


def _suffix(column: str) -> Column:
    return F.slice(column, F.col("at") + 1, F.size(column))


def burst(rows: DataFrame, root_conv: int, most_suffixes: int = MOST_SUFFIXES, most_turns: int = MOST_TURNS) -> tuple[DataFrame, list[DataFrame]]:
    """Containers of bounded size, and per round the heads above them.

    Containers: (key, up, up_conv, at, ids, sizes, n, conv, ends), one row per sequence; `up` is the
    head above and `at` its depth. Heads: (key, up, up_conv, at, path, n, conv, ends): nodes of
    depth at + 1 and on, one per size in `path`; `ends` belongs to the last.
    """
    root = F.lit(bytearray(b""))
    live = rows.where(F.size("ids") > 0).select(
        _short(F.concat(root, F.get("ids", F.lit(0)))).alias("key"), root.alias("up"), F.lit(root_conv).cast("long").alias("up_conv"),
        F.lit(0).alias("at"), "ids", "sizes", "n", "conv", "ends",
    )
    live, bounded, heads = _cut(live), [], []
    while True:
        suffixes, turns = F.count(F.lit(1)), F.sum(F.size("ids") - F.col("at"))
        size = live.groupBy("key").agg(suffixes.alias("suffixes"), turns.alias("turns"), F.sum("n").alias("all_n"), F.min("conv").alias("all_conv"))
        large = size.where((F.col("suffixes") > most_suffixes) | ((F.col("turns") > most_turns) & (F.col("suffixes") > 1)))
        large = _cut(large.select("key", "all_n", "all_conv"))
        if large.isEmpty():
            return _union([*bounded, live]), heads
        bounded.append(live.join(large, "key", "left_anti"))
        bursting = live.join(large, "key")
        # What the first and the last suffix in order share, all in between share.
        ways = bursting.groupBy("key").agg(F.min(F.struct(_suffix("ids").alias("ids"), _suffix("sizes").alias("sizes"))).alias("low"), F.max(_suffix("ids")).alias("high"))
        same = F.zip_with("low.ids", "high", lambda a, b: a.eqNullSafe(b))
        ways = ways.select("key", (F.array_position(same, F.lit(False)) - 1).cast("int").alias("shared"), F.col("low.sizes").alias("path"))
        bursting = _cut(bursting.join(ways.withColumn("path", F.slice("path", 1, F.col("shared"))), "key"))
        to = F.col("at") + F.col("shared")
        ended = bursting.where(F.size("ids") == to).select("key", F.col("ends").alias("_ends"))
        head = bursting.groupBy("key", "up", "up_conv", "at", "path", F.col("all_n").alias("n"), F.col("all_conv").alias("conv")).agg(F.count(F.lit(1)))
        heads.append(_cut(head.join(ended, "key", "left").select("key", "up", "up_conv", "at", "path", "n", "conv", F.col("_ends").alias("ends"))))
        live = _cut(bursting.where(F.size("ids") > to).select(
            _short(F.concat("key", F.get("ids", to))).alias("key"), F.col("key").alias("up"), F.col("all_conv").alias("up_conv"),
            to.alias("at"), "ids", "sizes", "n", "conv", "ends",
        ))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def container_nodes(up: bytes, up_conv: int, at: int, rows: list[tuple]) -> list[tuple]:
    """Nodes of one container, its top node first; `rows` are (ids, sizes, n, conv, ends) in the order of ids."""
    depth, size, parent, conv, n, children, ends = [], [], [], [], [], [], []
    way, before = [], []
    for ids, sizes, count, smallest, mark in rows:
        shared = 0
        while shared < min(len(ids), len(before)) and ids[shared] == before[shared]:
            shared += 1
        del way[shared:]
        for i in range(shared, len(ids)):
            parent.append(way[-1] if way else -1)
            if way:
                children[way[-1]] += 1
            way.append(len(depth))
            depth.append(at + 1 + i)
            size.append(sizes[i])
            conv.append(None)
            n.append(0)
            children.append(0)
            ends.append(NO_ENDS)
        n[way[-1]], conv[way[-1]], ends[way[-1]] = count, smallest, mark
        before = ids
    leaves, saved = [int(c == 0) for c in children], [0] * len(depth)
    # Children stand after their parents, so from the back every node is whole when it is reached.
    for i in reversed(range(len(depth))):
        saved[i] += (n[i] - 1) * size[i]
        if parent[i] >= 0:
            p = parent[i]
            n[p] += n[i]
            conv[p] = conv[i] if conv[p] is None else min(conv[p], conv[i])
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    above = [up_conv if p < 0 else conv[p] for p in parent]
    tops = [up if p < 0 else None for p in parent]
    return list(zip(conv, depth, above, n, children, leaves, saved, ends, tops))


_NODES = pa.schema([
    *((name, pa.int64()) for name in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    ("ends_sha256", pa.string()), ("up", pa.binary()),
])


def _batch(nodes: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), _NODES.types)], schema=_NODES)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by container and suffix to nodes; one container is held at a time."""
    out, rows, here = [], [], None
    for batch in batches:
        for key, up, up_conv, at, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if here is None or key != here[0]:
                if rows:
                    out += container_nodes(*here[1:], rows)
                rows, here = [], (key, up, up_conv, at)
            rows.append(row)
            if len(out) >= BATCH_NODES:
                yield _batch(out)
                out = []
    if rows:
        out += container_nodes(*here[1:], rows)
    if out:
        yield _batch(out)


def _path_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads with the sums below them to the nodes of their paths."""
    for batch in batches:
        out = []
        for up, up_conv, at, path, n, conv, ends, children, leaves, saved in zip(*(column.to_pylist() for column in batch.columns)):
            kept = saved + (n - 1) * np.cumsum(np.array(path, dtype=np.int64)[::-1])[::-1]
            for i, total in enumerate(kept.tolist()):
                last = i == len(path) - 1
                out.append((conv, at + 1 + i, conv if i else up_conv, n, children if last else 1, leaves, total, (ends if last else None) or NO_ENDS, None if i else up))
        if out:
            yield _batch(out)


def trie(rows: DataFrame, most_suffixes: int = MOST_SUFFIXES, most_turns: int = MOST_TURNS) -> DataFrame:
    """All nodes of the trie over (conv_id, ids, sizes), the root included.

    conv_id and parent_conv_id name nodes by their smallest conversation; saved_tokens sums, over
    the subtree, the bytes of each node's text once for every conversation but the first.
    """
    spark = rows.sparkSession
    whole = _cut(distinct_sequences(rows))
    # One row of sums over all conversations.
    root = whole.agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max(F.when(F.size("ids") == 0, F.col("ends"))).alias("ends")).first()
    if root["n"] is None:
        return spark.createDataFrame([], _NODE)
    containers, heads = burst(whole, root["conv"], most_suffixes, most_turns)
    sweep = containers.select("key", "up", "up_conv", "at", _suffix("ids").alias("ids"), _suffix("sizes").alias("sizes"), "n", "conv", "ends")
    sweep = sweep.repartition("key").sortWithinPartitions("key", "ids")
    nodes = _cut(sweep.mapInArrow(_swept, f"{_NODE}, up binary"))
    found = [nodes]

    def sums(tops: DataFrame) -> DataFrame:
        tops = tops.where("up IS NOT NULL").select("up", F.lit(1).cast("long").alias("children"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        return tops.groupBy("up").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])

    below = _cut(sums(nodes))
    for head in reversed(heads):
        full = head.join(below.withColumnRenamed("up", "_key"), head["key"] == F.col("_key"))
        full = full.select("up", "up_conv", F.col("at").cast("long"), "path", "n", "conv", "ends", "children", "leaves", "saved")
        found.append(_cut(full.mapInArrow(_path_nodes, f"{_NODE}, up binary")))
        more = below.unionByName(sums(found[-1])).groupBy("up")
        below = _cut(more.agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")]))
    top = below.where(F.octet_length("up") == 0).first()
    children, leaves, saved = (top["children"], top["leaves"], top["saved"]) if top else (0, 1, 0)
    first = spark.createDataFrame([(root["conv"], 0, None, root["n"], children, leaves, saved, root["ends"] or NO_ENDS)], _NODE)
    return _union([*(f.drop("up") for f in found), first])
