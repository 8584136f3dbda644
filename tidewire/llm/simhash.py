"""SimHash near-dedup with a Gray-order hierarchical index.

A fingerprint sums the bits of the hashes of all word shingles. To find all pairs within RADIUS
differing bits, the 64 bits are cut in RADIUS + 2 blocks: two fingerprints that near agree in two
whole blocks, so for each choice of two blocks those shared bits form an upper node of the index.
Inside a node the fingerprints are sorted by Gray rank; runs of 16 become lower nodes that hold the
bits all members share, and runs of those the next level. Two nodes are compared by the shared bits
in which they conflict: differences add up on the way down, and beyond RADIUS all members are
pruned together. Two nodes already wholly in one component are pruned as well, so a dense group
of copies costs a forest, not all pairs.

An upper node with very many members is split into blocks; each pair of its blocks is a task of
its own. Tasks report only a spanning forest of what they link; connected components are joined by
alternating large-star and small-star steps on those links. Only fingerprints travel.

Nulls: a null text is empty and has fingerprint zero, linked like any other; null ids take part
but never name a component unless all its ids are null. Repeated rows are reported each. An empty
table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, one_of_each, self_contained

SHINGLE, SEED, RADIUS = 4, 42, 4
# Members of a task, rows of a batch of tasks, and children of an index node.
NODE_ROWS, BATCH_ROWS, FAN = 8192, 8192, 16
# Edges that a task reads or writes, about, while components are joined.
EDGES_PER_TASK = 100_000

self_contained(__name__)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the shingles of a text, repeats included, as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    seeded = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [seeded(b" ".join(words), SEED)]
    else:
        hashes = [seeded(b" ".join(run), SEED) for run in zip(*[words[i:] for i in range(shingle)])]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(marks.view(np.int64))], names=["doc_id", "text_md5", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, fp): fp is the fingerprint as a signed 64-bit number."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", digest("text")).mapInArrow(_fingerprints, f"doc_id {kind}, text_md5 string, fp long")


def digest(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_md5")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in Gray order, as unsigned 64-bit numbers."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Connected components of 0..n-1; a label is the smallest member."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                return
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def index_levels(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of (shared ones, shared zeros), members first; each node covers FAN of the level below."""
    levels = [(values, ~values)]
    while len(levels[-1][0]) > FAN:
        starts = np.arange(0, len(levels[-1][0]), FAN)
        levels.append(tuple(np.bitwise_and.reduceat(x, starts) for x in levels[-1]))
    return levels


def link_within(values: np.ndarray, members: np.ndarray, forest: Forest, radius: int = RADIUS) -> None:
    """Joins in `forest` all members whose values (sorted by Gray rank) differ in at most `radius` bits."""
    levels = index_levels(values)

    def bounds(level: int) -> tuple[np.ndarray, np.ndarray]:
        label = forest.label[members]
        starts = np.arange(0, len(values), FAN**level)
        return np.minimum.reduceat(label, starts), np.maximum.reduceat(label, starts)

    def search(level: int, a: np.ndarray, b: np.ndarray) -> None:
        ones, zeros = levels[level]
        for at in range(0, len(a), 1 << 19):
            i, j = a[at:at + (1 << 19)], b[at:at + (1 << 19)]
            low, high = bounds(level)
            apart = ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
            i, j = i[apart], j[apart]
            conflicts = np.bitwise_count((ones[i] & zeros[j]) | (zeros[i] & ones[j]))
            i, j = i[conflicts <= radius], j[conflicts <= radius]
            if level == 0:
                forest.join(members[i], members[j])
                continue
            size = len(levels[level - 1][0])
            for part in range(0, len(i), 1 << 11):
                x = (i[part:part + (1 << 11), None, None] * FAN + np.arange(FAN)[None, :, None])
                y = (j[part:part + (1 << 11), None, None] * FAN + np.arange(FAN)[None, None, :])
                x, y = (z.reshape(-1) for z in np.broadcast_arrays(x, y))
                fits = (x <= y) & (y < size) if level > 1 else (x < y) & (y < size)
                search(level - 1, x[fits], y[fits])

    top = len(levels) - 1
    n = len(levels[top][0])
    a, b = np.triu_indices(n, k=0 if top else 1)
    search(top, a, b)


def _links(group: pa.Table) -> pa.Table:
    """(fp, root): a spanning forest of the links found in a batch of tasks."""
    task, raw = group["task"].to_numpy(), group["fp"].to_numpy().view(np.uint64)
    distinct, member = np.unique(raw, return_inverse=True)
    order = np.lexsort((gray_rank(raw), task))
    task, value, member = task[order], raw[order], member[order]
    edges = np.flatnonzero(np.diff(task)) + 1
    starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(task)]])
    forest = Forest(len(distinct))
    small = (ends - starts) <= FAN
    within = np.repeat(np.where(small, ends, 0), ends - starts)
    # Tasks of one run of members: no upper level to prune by, so all of them are compared together.
    for gap in range(1, FAN):
        i = np.flatnonzero(np.arange(len(task)) + gap < within)
        near = np.bitwise_count(value[i] ^ value[i + gap]) <= RADIUS
        forest.join(member[i[near]], member[i[near] + gap])
    for s, e in zip(starts[~small], ends[~small]):
        link_within(value[s:e], member[s:e], forest)
    linked = forest.label != np.arange(len(distinct))
    return pa.table({"fp": distinct[linked].view(np.int64), "root": distinct[forest.label[linked]].view(np.int64)})


def _masks(radius: int = RADIUS) -> list[int]:
    """For each choice of two of radius + 2 blocks, the mask of their bits, as signed numbers."""
    cuts = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [int(np.array([a | b], dtype=np.uint64).view(np.int64)[0]) for a, b in itertools.combinations(parts, 2)]


def in_tasks(rows: DataFrame, member: str, node_rows: int) -> DataFrame:
    """`rows`(`member`, node, ...) with a task for the node: each pair of blocks of a node of more than `node_rows` is one."""
    half = node_rows // 2
    large = rows.groupBy("node").count().where(F.col("count") > node_rows).select("node", F.ceil(F.col("count") / half).cast("int").alias("blocks"))
    large = cut_lineage(large)
    others = [c for c in rows.columns if c != "node"]
    rows = rows.join(large, "node", "left")
    block = F.pmod(F.xxhash64(member, F.lit("block")), F.col("blocks")).cast("int")
    pairs = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("block"))
    tasks = F.when(F.col("blocks").isNull(), F.array("node")).otherwise(
        F.transform(pairs, lambda j: F.xxhash64("node", F.least("block", j), F.greatest("block", j)))
    )
    return rows.withColumn("block", block).select(*others, F.explode(tasks).alias("task"))


def links(values: DataFrame) -> DataFrame:
    """(fp, root) links among the distinct fingerprints `values`(fp); their components are the answer."""
    nodes = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(_masks())])
    # A hash of the node names it; two nodes that share a name are merely searched together.
    rows = in_tasks(values.select("fp", F.explode(nodes).alias("node")), "fp", NODE_ROWS)
    batches = max(1, values.count() * 15 // BATCH_ROWS)
    batched = rows.withColumn("batch", F.pmod(F.xxhash64("task", F.lit("batch")), F.lit(batches)))
    return batched.groupBy("batch").applyInArrow(_links, "fp long, root long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges`(a, b): root is the smallest node it is connected to.

    Alternates large-star and small-star until nothing moves. Minima are combined before the
    shuffle, and the edge side of each join may be split where a node has very many edges. Rounds add
    no edges, so their count tells how many tasks are enough; each task more leaves files and log entries
    in every stage of every round.
    """
    pair = F.when(F.col("a") > F.col("b"), F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(edges.where("a <> b").select(pair.alias("p")).select("p.a", "p.b").distinct())
    last = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = tuple(state)
        tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-last[0] // EDGES_PER_TASK))
        both = edges.coalesce(tasks).select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(tasks).distinct().coalesce(tasks)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = moved.unionByName(lowest.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a <> b").coalesce(tasks).distinct().coalesce(tasks))


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_md5, fp, component_id, root): component_id is the smallest doc_id the fingerprint is linked to, root names the group."""
    marks = cut_lineage(fingerprints(docs))
    distinct = cut_lineage(marks.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return grouped(marks, distinct, links(distinct.select("fp")), "fp")


def grouped(marks: DataFrame, distinct: DataFrame, linked: DataFrame, by: str) -> DataFrame:
    """`marks`(doc_id, text_md5, `by`) with the component_id and the root of `by`, from links (`by`, root) among `distinct`(`by`, first)."""
    found = components(linked.select(F.col(by).alias("a"), F.col("root").alias("b")))
    rooted = distinct.join(found.select(F.col("node").alias(by), "root"), by, "left").select(by, "first", F.coalesce("root", by).alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(names, "root").select(by, "component_id", "root")
    # The documents stand on the left, so a value with very many of them can be split.
    return marks.join(named, by).select("doc_id", "text_md5", by, "component_id", "root")


def deduplicated(docs: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One document of each group: the one with the smallest id, in the columns of `docs`.

    Groups are those of `near_groups` unless given. Of repeated rows one stays. In a group without any id, every text stays.
    """
    groups = near_groups(docs) if groups is None else groups
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", F.col("text_md5").alias("mark"))
    return one_of_each(docs, kept, digest("text"))
