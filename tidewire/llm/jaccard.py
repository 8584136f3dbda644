"""Near copies by the Jaccard similarity of their sets of five-word shingles, 0.8 or more.

SimHash distances of such texts run far beyond the radius its index can search, so candidates come
from MinHash here: BANDS times ROWS minima of a set's hashes. Two texts of similarity s share some
whole band with probability 1 - (1 - s**ROWS)**BANDS: all but 3 in a million at 0.8, more above.
Candidates are checked by the exact similarity of their sets, and connected components of what
holds are the groups.

Members of a task are compared from one reached member to all not reached yet, so a dense group of
copies costs a forest, not all pairs. Sets that share buckets, directly or through others, are one
task as a rule, so a set travels once, and only if it shares a bucket with another; tasks are
bounded by members and bytes (see `links`).

Words are those of `simhash`; a text of fewer than five words is one shingle, and a null or empty
one the empty set, equal only to itself. Null ids, repeated rows, texts of any length, empty tables
and other columns are as there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, self_contained
from tidewire.llm.simhash import SEED, Forest, components, digest, grouped

SHINGLE, BANDS, ROWS = 5, 32, 5
# Similarity from which two texts are near copies, as a fraction.
SIMILAR = (4, 5)
# Members and bytes of a task within a large unit; bytes of a unit that is one task, and of a batch of
# tasks; shingles hashed at once.
NODE_ROWS, NODE_BYTES = 1024, 16 << 20
UNIT_BYTES, BATCH_BYTES, PART = 16 << 20, 16 << 20, 4096
# Bands searched before what is linked is left out; keys of wanted texts that may be broadcast.
STAR_BANDS, BROADCAST_KEYS = 4, 100_000

_RNG = np.random.default_rng(SEED)
_FLIP = _RNG.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64)
_TIMES = _RNG.integers(0, 2**64, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)

self_contained(__name__)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    runs = zip(*[words[i:] for i in range(SHINGLE)]) if len(words) >= SHINGLE else [words] if words else []
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs], dtype=np.uint64))


def bands(hashes: np.ndarray) -> list[int]:
    """One signed number per band; the empty set has none."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), PART):
        np.minimum(least, ((hashes[None, at:at + PART] ^ _FLIP) * _TIMES).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)], dtype=np.uint64).view(np.int64).tolist()


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(2), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_md5", "key", "size", "bands"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, places, text) to (key, places, hashes); a key is given out once in a task."""
    seen: set[bytes] = set()
    for batch in batches:
        fresh = [i for i, key in enumerate(batch.column(0).to_pylist()) if key not in seen and not seen.add(key)]
        batch = batch.take(pa.array(fresh, pa.int64()))
        sets = pa.array([shingles(x.as_py()).tobytes() for x in batch.column(2)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sets], names=["key", "places", "hashes"])


def link_similar(sets: list[np.ndarray], members: np.ndarray, forest: Forest) -> None:
    """Joins in `forest` the members in one component of the pairs of sets that are similar."""
    over, under = SIMILAR
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(flat, np.cumsum(size)[:-1])
    left, mark = np.arange(len(sets)), np.zeros(len(distinct), dtype=bool)
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            mark[own[at]] = True
            shared = np.bincount(owner[mark[flat]], minlength=len(sets))[left]
            mark[own[at]] = False
            near = under * shared >= over * (size[at] + size[left] - shared)
            if near.any():
                found, left = left[near], left[~near]
                forest.join(members[found], np.full(len(found), members[at]))
                reached.extend(found)
                stays = np.isin(owner, left)
                owner, flat = owner[stays], flat[stays]


def _links(group: pa.Table) -> pa.Table:
    """(key, root): a spanning forest of the links found in a batch of tasks."""
    keys = group["key"].combine_chunks().dictionary_encode()
    member, names, task = keys.indices.to_numpy(), keys.dictionary, group["task"].to_numpy()
    first = np.unique(member, return_index=True)[1]
    sets = [np.frombuffer(group["hashes"][int(i)].as_py(), dtype=np.uint64) for i in first]
    order = np.argsort(task, kind="stable")
    forest = Forest(len(sets))
    for part in np.split(member[order], np.flatnonzero(np.diff(task[order])) + 1):
        part = np.unique(part)
        if (forest.label[part] != forest.label[part[0]]).any():
            link_similar([sets[i] for i in part], part, forest)
    linked = np.flatnonzero(forest.label != np.arange(len(sets)))
    return pa.table({"key": names.take(pa.array(linked)), "root": names.take(pa.array(forest.label[linked]))})


def _verified(docs: DataFrame, distinct: DataFrame, tasks: DataFrame) -> DataFrame:
    """(key, root) links found in `tasks`(key, size, task): the members of a task are compared.

    A set travels once to each batch of tasks it has a part in; batches hold BATCH_BYTES on average.
    """
    tasks = cut_lineage(tasks)
    moved = tasks.agg(F.sum("size")).first()[0] or 0
    batch = F.pmod(F.xxhash64("task", F.lit("batch")), F.lit(max(1, 16 * moved // BATCH_BYTES)))
    places = tasks.groupBy("key").agg(F.collect_set(F.struct("task", batch.alias("batch"))).alias("places"))
    wanted = cut_lineage(distinct.select("key", "text_md5").join(places, "key"))
    # Few texts are wanted as a rule; then the others are not moved to find out.
    few = wanted.count() <= BROADCAST_KEYS and moved * 8 <= BROADCAST_KEYS * 4096
    texts = docs.select("text", digest("text")).join(F.broadcast(wanted) if few else wanted, "text_md5")
    place = "places array<struct<task:bigint,batch:bigint>>"
    sets = texts.select("key", "places", "text").mapInArrow(_sets, f"key binary, {place}, hashes binary")
    rows = sets.select("key", "hashes", F.inline("places"))
    return rows.groupBy("batch").applyInArrow(_links, "key binary, root binary").distinct()


def _blocks(n: Column, size: Column) -> Column:
    """Blocks that so many members of so many shingles are split into, two of which fill a task."""
    return F.greatest(F.ceil(2 * n / NODE_ROWS), F.ceil(16 * size / NODE_BYTES)).cast("int")


def _is_large(n: Column, size: Column) -> Column:
    return (n > NODE_ROWS) | (8 * size > NODE_BYTES)


def _star_tasks(members: DataFrame) -> DataFrame:
    """Tasks for buckets: all members of a small one, or a block of a large one and one member that all its blocks share."""
    bucket = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all"), F.min("key").alias("center"))
    bucket = bucket.select("node", "center", F.when(_is_large(F.col("n"), F.col("all")), _blocks(F.col("n"), F.col("all"))).otherwise(1).alias("blocks"))
    rows = members.join(cut_lineage(bucket), "node")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")).cast("int"))
    block = F.explode(F.when(F.col("key") == F.col("center"), every).otherwise(own)).alias("block")
    return rows.select("key", "size", "node", block).select("key", "size", F.xxhash64("node", "block").alias("task"))


def _mixed_tasks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Tasks for the buckets whose members are not all linked yet: (key, size, task).

    In a large bucket the members of the most frequent label are all linked already, so only the
    others are compared, block by block, with those and with each other.
    """
    rows = members.join(labels.select(F.col("node").alias("key"), "root"), "key", "left").withColumn("label", F.coalesce("root", "key")).drop("root")
    rows = cut_lineage(rows)
    counts = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("s"))
    main = F.max(F.struct("c", "s", "label")).alias("main")
    buckets = counts.groupBy("node").agg(F.count(F.lit(1)).alias("labels"), F.sum("c").alias("n"), F.sum("s").alias("all"), main).where("labels > 1")
    buckets = cut_lineage(buckets.select(
        "node", F.col("main.label").alias("main"), _is_large(F.col("n"), F.col("all")).alias("large"), _blocks(F.col("main.c"), F.col("main.s")).alias("mains"),
        _blocks(F.col("n") - F.col("main.c"), F.col("all") - F.col("main.s")).alias("others"),
    ))
    rows = rows.join(buckets, "node")
    inner = F.col("label") == F.col("main")
    at = F.pmod(F.xxhash64("key", F.lit("block")), F.when(inner, F.col("mains")).otherwise(F.col("others"))).cast("int")

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    with_main = F.transform(numbers("mains"), lambda j: F.xxhash64("node", F.lit("main"), F.col("at"), j))
    rest = F.filter(numbers("others"), lambda j: j != F.col("at"))
    with_rest = F.transform(rest, lambda j: F.xxhash64("node", F.lit("rest"), F.least("at", j), F.greatest("at", j)))
    from_main = F.transform(numbers("others"), lambda i: F.xxhash64("node", F.lit("main"), i, F.col("at")))
    tasks = F.when(~F.col("large"), F.array("node")).when(inner, from_main).otherwise(F.concat(with_main, with_rest))
    return rows.withColumn("at", at).select("key", "size", F.explode(tasks).alias("task"))


def links(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(key, root) links among the sets `distinct`(key, text_md5, size, bands), whose texts are in `docs`.

    Sets that buckets connect form a unit; a unit of bounded size is one task, so its sets travel
    once. The buckets of larger units are searched in two rounds: the first STAR_BANDS of them in
    blocks around one member, which links a dense group of copies; then, of all buckets,
    those whose members are not all linked.
    """
    rows = distinct.select("key", "size", F.posexplode("bands").alias("band", "node"))
    # Similar texts share many bands: of buckets that hold the same members one is searched.
    alike = [F.sum(F.xxhash64("key", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(2)]
    held = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.min("band").alias("band"), *alike).where("n > 1")
    kept = held.groupBy("n", "s0", "s1").agg(F.min(F.struct("band", "node", "least")).alias("b")).select("b.node", "b.least", F.col("b.band").alias("first_band"))
    members = cut_lineage(rows.drop("band").join(kept, "node"))
    joined = components(members.where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")))
    unit = F.coalesce("root", "key").alias("unit")
    placed = members.select("key", "size").distinct().join(joined.withColumnRenamed("node", "key"), "key", "left").select("key", "size", unit)
    placed = cut_lineage(placed)
    large = cut_lineage(placed.groupBy("unit").agg((8 * F.sum("size")).alias("bytes")).where(F.col("bytes") > UNIT_BYTES).select("unit"))
    found = _verified(docs, distinct, placed.join(large, "unit", "left_anti").select("key", "size", F.xxhash64("unit").alias("task")))
    if large.isEmpty():
        return found
    rest = cut_lineage(members.join(placed.join(large, "unit").select("key"), "key", "left_semi"))
    stars = cut_lineage(_verified(docs, distinct, _star_tasks(rest.where(F.col("first_band") < STAR_BANDS))))
    labels = components(stars.select(F.col("key").alias("a"), F.col("root").alias("b")))
    return found.unionByName(stars).unionByName(_verified(docs, distinct, _mixed_tasks(rest, labels)))


def near_groups(docs: DataFrame, alike: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_md5, key, component_id, root): component_id is the smallest doc_id of the group, root names it.

    `alike`(text_md5, root) are groups of texts that another method found; each is linked as a whole.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_md5 string, key binary, size long, bands array<long>"
    marks = cut_lineage(docs.select("doc_id", "text", digest("text")).mapInArrow(_marks, schema))
    sets = marks.groupBy("key").agg(F.min("doc_id").alias("first"), F.min("text_md5").alias("text_md5"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    sets = cut_lineage(sets)
    found = links(docs, sets)
    if alike is not None:
        keyed = marks.select("text_md5", "key").distinct().join(alike.distinct(), "text_md5").select("key", "root").distinct()
        least = keyed.groupBy("root").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        found = found.unionByName(keyed.join(least, "root").select("key", F.col("least").alias("root")))
    return grouped(marks, sets.select("key", "first"), found, "key")
