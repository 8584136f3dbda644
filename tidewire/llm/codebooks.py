"""Vector code compression: product codebooks fitted by k-means with norm-of-sum bounds.

Vectors become integers floor(scale * x) and are cut into equal consecutive parts; each part
position has a codebook of its own, and a vector is stored as the numbers of the nearest entries.

Per vector and part, entries other than the assigned one fall in GROUPS groups; for each group the
state keeps a lower bound on the distance to any of its entries, and the round stamp of the
codebook under which it was measured. All codebooks of the run are retained, so at any later round
a bound falls by the true net displacement of an entry since its stamp, |c(now) - c(then)|: the
norm of the sum of its moves, never more than the sum of their norms that accumulated drifts take
off. The distance to the assigned entry is computed exactly; a group whose bound lies above it
cannot win and is skipped, others are rescanned exactly and get a new bound and stamp.

Each round is one pass of Arrow batches that reads the state of the last, a table in the shared
folder, and writes its own, with the integer sums of its parts per entry among the rows; only sums
over entries, bounded by the codebook's size, reach the driver. The state of the round before is
removed. A vector's state is its components, and for each part 5 bytes a group and one for the
code. No key is shuffled, so no label or id can be hot; errors by label are pre-aggregated.

All results are exact integers: distances are computed in floating point only where all terms
stay below 2^53, and in whole numbers of any size for components beyond that, whose sums travel in
limbs of 30 bits. Bounds are rounded down, so ties always reach the exact scan.

Rows whose vector is null or holds null, NaN or infinity are left out. Shorter vectors count as
padded with zeros, to the longest and then to a multiple of the parts, one component a part at least. The first codebook is the
vectors of the smallest ids (null ids last, equal ids by vector); of fewer rows, all. A null id is
kept. Repeated rows are coded each. An error beyond a 64-bit number is null, and so is the sum of
its label. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, named, self_contained
from tidewire.session import drop_dir, run_dir

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
GROUPS = 16
# Vectors worked on at once, and bits of a limb.
BLOCK, LIMB = 8192, 30
# Bounds are lowered, displacements raised, by this share: more than rounding can add.
SLACK = 1e-6

self_contained(__name__)

Codebook = np.ndarray  # parts x entries x width of a part, of integers


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, embedding, label) of the rows that take part."""
    rows = named(embeddings, "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("embedding").isNotNull() & finite)


def whole_number(x: float, scale: int) -> int:
    """floor(scale * x), exactly for every finite x."""
    return math.floor(x * scale) if abs(x) < 2.0**40 else int(x) * scale


def whole_numbers(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Rows of a list column as integers, padded to `width`; Python integers where some are very large."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    small = bool((np.abs(flat) < 2.0**40).all())
    out = np.zeros((len(vectors), width), dtype=np.int64 if small else object)
    flat = np.floor(flat * scale).astype(np.int64) if small else np.array([whole_number(x, scale) for x in flat.tolist()], dtype=object)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def limit(width: int) -> int:
    """Components below it in size have distances that floating point holds exactly."""
    return math.isqrt(2**51 // max(1, width))


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries, as floats if both are small, else as Python integers."""
    most = limit(x.shape[1])
    if np.abs(x).max(initial=0) < most and np.abs(entries).max(initial=0) < most:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return (a * a).sum(axis=1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    out = np.empty((len(x), len(entries)), dtype=object)
    for j, entry in enumerate(entries.astype(object)):
        step = x.astype(object) - entry
        out[:, j] = (step * step).sum(axis=1)
    return out


def group_starts(entries: int) -> np.ndarray:
    """First entry of each group; groups are runs of entries as even as can be."""
    return np.unique(np.arange(GROUPS) * entries // GROUPS) if entries else np.zeros(0, dtype=np.int64)


def displacements(history: list[Codebook], part: int) -> np.ndarray:
    """(stamp, group): the farthest any entry of the group is now from where it was at the stamp."""
    now = history[-1][part]
    out = np.zeros((len(history), len(group_starts(len(now)))))
    for stamp, book in enumerate(history):
        net = (now - book[part]).astype(np.float64)
        moved = np.sqrt((net * net).sum(axis=1)) * (1 + SLACK)
        out[stamp] = np.maximum.reduceat(moved, group_starts(len(now)))
    return out


def lowered(distance: np.ndarray) -> np.ndarray:
    return np.minimum(np.sqrt(distance.astype(np.float64)) * (1 - SLACK), 1e38).astype(np.float32)


def compact(book: Codebook) -> Codebook:
    """64-bit integers where all components allow it, else Python integers."""
    return book.astype(np.int64) if max((abs(v) for v in book.reshape(-1)), default=0) < 2**50 else book.astype(object)


def reassigned(x: np.ndarray, history: list[Codebook], part: int, state: tuple[np.ndarray, ...] | None) -> tuple[np.ndarray, ...]:
    """Nearest entries under the last codebook: (code, bound, stamp, squared distance, groups scanned).

    `state` is (code, bound, stamp) of an earlier round, bounds and stamps one per group.
    """
    book, now = history[-1][part], len(history) - 1
    starts = group_starts(len(book))
    ends = np.append(starts[1:], len(book))
    if state is None:
        code = np.zeros(len(x), dtype=np.int64)
        bound, stamp = np.full((len(x), len(starts)), -np.inf, dtype=np.float32), np.zeros((len(x), len(starts)), dtype=np.uint8)
    else:
        code, bound, stamp = (np.array(s) for s in state)
    home = np.searchsorted(starts, code, side="right") - 1
    step = x - book[code]
    if np.abs(step).max(initial=0) >= limit(x.shape[1]):
        step = step.astype(object)
    own = (step * step).sum(axis=1)
    reach = bound - displacements(history, part)[stamp, np.arange(len(starts))]
    # Not above the own distance: some entry of the group may be nearer, or as near with a lower number.
    open_ = ~(reach > (np.sqrt(own.astype(np.float64)) * (1 + SLACK))[:, None])
    best, at = own.copy(), code.copy()
    first, second, who = {}, {}, {}
    for g, (lo, hi) in enumerate(zip(starts, ends)):
        rows = np.flatnonzero(open_[:, g])
        if not len(rows):
            continue
        far = squared(x[rows], book[lo:hi])
        place = far.argmin(axis=1)
        near = far[np.arange(len(rows)), place]
        if far.shape[1] > 1:
            rest = far.copy()
            rest[np.arange(len(rows)), place] = np.inf
            second[g] = rest.min(axis=1)
        else:
            second[g] = np.full(len(rows), np.inf)
        first[g], who[g] = near, lo + place
        wins = (near < best[rows]) | ((near == best[rows]) & (who[g] < at[rows]))
        best[rows[wins]] = near[wins] if best.dtype == object else near[wins].astype(best.dtype)
        at[rows[wins]] = who[g][wins]
    for g in first:
        rows = np.flatnonzero(open_[:, g])
        bound[rows, g] = lowered(np.where(who[g] == at[rows], second[g], first[g]))
        stamp[rows, g] = now
    # The entry given up is now one of its group's others.
    left = np.flatnonzero((at != code) & ~open_[np.arange(len(x)), home])
    bound[left, home[left]] = np.minimum(reach[left, home[left]] * np.float32(1 - SLACK), lowered(own[left]))
    stamp[left, home[left]] = now
    return at, bound, stamp, best, int(open_.sum())


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """Non-zero limbs of a whole number, each with its sign; small numbers are one limb."""
    if abs(value) < 2**40:
        if value:
            yield 0, value
        return
    sign, value, at = (1 if value > 0 else -1), abs(value), 0
    while value:
        if value & (1 << LIMB) - 1:
            yield at, sign * (value & (1 << LIMB) - 1)
        value >>= LIMB
        at += 1


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _bytes(column: pa.Array, dtype, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), *shape)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _assigned(history: list[Codebook], scale: int):
    parts, entries, part_width = history[0].shape
    n_groups = len(group_starts(entries))

    def run(block: pa.Table):
        """Rows as integers, and by part code, bound, stamp and squared distance."""
        x = whole_numbers(block["embedding"], parts * part_width, scale)
        state = None
        if "codes" in block.column_names:
            state = (
                _bytes(block["codes"], np.uint8, parts), _bytes(block["bounds"], "<f4", parts, n_groups), _bytes(block["stamps"], np.uint8, parts, n_groups),
            )
        done = []
        for p in range(parts):
            before = None if state is None else (state[0][:, p].astype(np.int64), state[1][:, p], state[2][:, p])
            done.append(reassigned(x[:, p * part_width:(p + 1) * part_width], history, p, before))
        return x, done

    return run


_STATE = "codes binary, bounds binary, stamps binary, part int, entry int, place int, limb int, amount long"


def _round(history: list[Codebook], scale: int, schema: pa.Schema):
    """State rows of one round, and at the end of a task the sums of its parts per entry."""
    parts, entries, width = history[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign, sums, counts = _assigned(history, scale), np.zeros((parts, entries, width), dtype=object), np.zeros((parts, entries), dtype=np.int64)
        for block in _blocks(batches):
            x, done = assign(block)
            for p, (code, *_) in enumerate(done):
                mine = x[:, p * width:(p + 1) * width]
                counts[p] += np.bincount(code, minlength=entries)
                if mine.dtype != object and np.abs(mine).max(initial=0) < 2**53 // max(1, len(mine)):
                    by = np.stack([np.bincount(code, weights=mine[:, j], minlength=entries) for j in range(width)], axis=1).astype(np.int64)
                    sums[p] += by
                else:
                    np.add.at(sums[p], code, mine.astype(object))
            n = len(x)
            own = [block["vec_id"].combine_chunks(), block["embedding"].combine_chunks(), block["label"].combine_chunks()]
            own += [
                _fixed(np.stack([d[0] for d in done], axis=1).astype(np.uint8)),
                _fixed(np.stack([d[1] for d in done], axis=1).astype("<f4")), _fixed(np.stack([d[2] for d in done], axis=1)),
            ]
            own = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in own]
            yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(n, t) for t in schema.types[6:])], schema=schema)
        rows = [(p, e, -1, 0, int(counts[p, e])) for p, e in zip(*np.nonzero(counts))]
        rows += [(p, e, j, limb, amount) for p, e in zip(*np.nonzero(counts)) for j in range(width) for limb, amount in limbs(int(sums[p, e, j]))]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(rows), t) for t in schema.types[:6]), *(pa.array(c, t) for c, t in zip(zip(*rows), schema.types[6:]))], schema=schema,
            )

    return run


def _coded(history: list[Codebook], scale: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _assigned(history, scale)
        for block in _blocks(batches):
            _, done = assign(block)
            codes = np.stack([d[0] for d in done], axis=1).tolist()
            total = [sum(int(v) for v in row) for row in zip(*(d[3].tolist() for d in done))]
            own = [block[c].combine_chunks() for c in ("vec_id", "label")]
            own = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in own]
            yield pa.RecordBatch.from_arrays([
                *own, pa.array(["".join(f"{c:02x}" for c in row) for row in codes], pa.string()),
                pa.array([t if t < 2**63 else None for t in total], pa.int64()),
            ], schema=schema)

    return run


def moved(book: Codebook, sums: list) -> Codebook:
    """The next codebook: floors of the means of each entry's parts; entries without parts stay."""
    total, count = np.zeros(book.shape, dtype=object), np.zeros(book.shape[:2], dtype=object)
    for row in sums:
        if row["place"] < 0:
            count[row["part"], row["entry"]] += row["amount"]
        else:
            total[row["part"], row["entry"], row["place"]] += row["amount"] << LIMB * row["limb"]
    return compact(np.where(count[:, :, None] > 0, total // np.maximum(count, 1)[:, :, None], book.astype(object)))


def digest(book: Codebook) -> str:
    return hashlib.sha256(",".join(str(v) for v in book.reshape(-1)).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebook]:
    """(vec_id, label, code, error) per vector, and the final codebooks."""
    if entries > 256 or rounds > 255:
        raise ValueError("codes are two hex digits and stamps one byte: at most 256 entries and 255 rounds")
    spark, rows = embeddings.sparkSession, usable(embeddings)
    out = "vec_id {}, label {}, code string, error long".format(*(rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")))
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return spark.createDataFrame([], out), np.zeros((parts, 0, 0), dtype=object)
    width = max(1, -(-longest // parts))
    # The first codebook, at most `entries` rows.
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    first = np.zeros((len(seeds), parts * width), dtype=object)
    for i, row in enumerate(seeds):
        first[i, :len(row["embedding"])] = [whole_number(x, scale) for x in row["embedding"]]
    history = [compact(first.reshape(len(seeds), parts, width).transpose(1, 0, 2))]
    state_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + f", {_STATE}"
    folder, state = None, rows
    for _ in range(rounds):
        new = run_dir(spark, "codebooks")
        state.mapInArrow(_round(history, scale, _arrow_schema(spark, state_schema)), state_schema).write.parquet(new)
        if folder is not None:
            drop_dir(spark, folder)
        folder, written = new, spark.read.schema(state_schema).parquet(new)
        sums = written.where("amount IS NOT NULL").groupBy("part", "entry", "place", "limb").agg(F.sum("amount").alias("amount"))
        history.append(moved(history[-1], sums.collect()))
        state = written.where("amount IS NULL").select("vec_id", "embedding", "label", "codes", "bounds", "stamps")
    coded = state.mapInArrow(_coded(history, scale, _arrow_schema(spark, out)), out)
    return coded, history[-1]


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: the errors of all rows of the label, null labels together."""
    coded = cut_lineage(coded)
    error: Column = F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error"))
    totals = coded.groupBy(F.col("label").alias("_label")).agg(error.alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
