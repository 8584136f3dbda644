"""Exact top-k search by distributed histogram selection.

Queries and candidates are dealt in blocks; each pair of blocks is one task that scores all its
pairs by a matrix product. Scores are integers in a range known from the largest norm. Passes
refine, for all queries at once, the histogram bin that holds the kth score, ten bits a pass, until
the kth score is known exactly; a last pass keeps scores at or above it, and ties are broken by id.
A block reports only bins it needs: below its own kth score no bin can hold the global one. So a
pass emits at most k bins a query and block, and the last pass at most k rows.

Rows whose vector is null, or holds null, NaN or infinity, take no part; neither do rows without
id, nor vectors whose scaled length is 2**31 or more, as their scores need not fit 64 bits. Shorter vectors count as padded with zeros. Repeated ids: as a query an id is asked once, with
its smallest vector; as candidates all its rows count, except for the query's own id. Components
are floor(64 x); queries are the ids divisible by 20. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import cut_lineage, named, self_contained

K = 20
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 4096
_PASS_BITS = 10

self_contained(__name__)


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): integer vectors of the rows that take part."""
    rows = named(embeddings, "vec_id", "embedding").where("embedding IS NOT NULL AND vec_id IS NOT NULL")
    whole = F.transform("embedding", lambda x: F.when(F.abs(x) < 2.0**32, F.floor(x.cast("double") * scale)))
    rows = rows.select("vec_id", whole.alias("v")).where(F.forall("v", lambda x: x.isNotNull()))
    return rows.where(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x) < 2.0**62)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded to `width`."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where that is exact."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _near_top(queries: pa.Table, candidates: pa.Table, width: int):
    """For chunks of queries: their rows, the scores, and which scores can be in the top `need` so far."""
    c_ids, c_vec = candidates["vec_id"].to_numpy(), _matrix(candidates["v"], width)
    for at in range(0, queries.num_rows, 256):
        part = queries.slice(at, 256)
        ids, prefix, need = (part[n].to_numpy() for n in ("query_id", "prefix", "need"))
        scores = _scores(_matrix(part["v"], width), c_vec)
        other = ids[:, None] != c_ids[None, :]
        yield part, ids, prefix, need, scores, other, c_ids


def _bins(queries: pa.Table, candidates: pa.Table, width: int, low: int, known: int, shift: int) -> pa.Table:
    """(query_id, bin, n): counts of score >> shift among scores whose higher bits are the prefix."""
    out = []
    for _, ids, prefix, need, scores, other, _ in _near_top(queries, candidates, width):
        scores -= low
        inside = other & ((scores >> known) == prefix[:, None])
        # Scores outside sort last; the kth largest inside bounds the bins that matter.
        ranked = np.where(inside, scores, -1)
        k = min(int(need.max()), ranked.shape[1])
        kth = np.partition(ranked, ranked.shape[1] - k, axis=1)[:, ranked.shape[1] - k]
        rows, cols = np.nonzero(inside & ((ranked >> shift) >= (kth >> shift)[:, None]))
        pairs, n = np.unique(np.stack([rows, ranked[rows, cols] >> shift]), axis=1, return_counts=True)
        out.append(pa.table({"query_id": ids[pairs[0]], "bin": pairs[1], "n": n.astype(np.int64)}))
    return pa.concat_tables(out)


def _winners(queries: pa.Table, candidates: pa.Table, width: int, low: int, k: int) -> pa.Table:
    """(query_id, vec_id, score): scores at or above the kth, of each block the first k."""
    out = []
    for _, ids, prefix, _, scores, other, c_ids in _near_top(queries, candidates, width):
        rows, cols = np.nonzero(other & (scores - low >= prefix[:, None]))
        order = np.lexsort((c_ids[cols], -scores[rows, cols], rows))
        rows, cols = rows[order], cols[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, cols = rows[place < k], cols[place < k]
        out.append(pa.table({"query_id": ids[rows], "vec_id": c_ids[cols], "score": scores[rows, cols]}))
    return pa.concat_tables(out)


def top_k(embeddings: DataFrame, k: int = K, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every`, its k best others."""
    vectors = cut_lineage(quantised(embeddings))
    facts = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)).alias("norm"),
    ).first()
    asked = vectors.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = cut_lineage(asked)
    n_queries = asked.count()
    empty = "query_id long, rank int, vec_id long, score long"
    if not n_queries:
        return embeddings.sparkSession.createDataFrame([], empty)
    width, norm = max(1, facts["width"]), int(facts["norm"])
    low, bits = -norm, max(1, (2 * norm).bit_length())
    q_blocks, c_blocks = -(-n_queries // QUERY_BLOCK), -(-facts["n"] // CANDIDATE_BLOCK)

    def blocks(id_column: str, own: str, n: int, other: str, others: int, rows: DataFrame) -> DataFrame:
        dealt = rows.withColumn(own, F.pmod(F.xxhash64(id_column), F.lit(n)).cast("int"))
        return dealt.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def paired(state: DataFrame, work, schema: str) -> DataFrame:
        theirs = blocks("vec_id", "cb", c_blocks, "qb", q_blocks, vectors)
        ours = blocks("query_id", "qb", q_blocks, "cb", c_blocks, asked.join(state, "query_id"))
        none = pa.schema([pa.field(c.split()[0], pa.int64()) for c in schema.split(", ")])

        def run(q: pa.Table, c: pa.Table) -> pa.Table:
            return work(q, c) if q.num_rows and c.num_rows else none.empty_table()

        return ours.groupBy("qb", "cb").cogroup(theirs.groupBy("qb", "cb")).applyInArrow(run, schema)

    state = asked.select("query_id", F.lit(0).cast("long").alias("prefix"), F.lit(k).cast("long").alias("need"))
    known = bits
    while known > 0:
        shift = max(0, known - _PASS_BITS)
        counts = paired(state, lambda q, c, known=known, shift=shift: _bins(q, c, width, low, known, shift), "query_id long, bin long, n long")
        counts = counts.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        falling = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        counts = counts.withColumn("upto", F.sum("n").over(falling)).join(state, "query_id")
        hit = F.max(F.when(F.col("upto") >= F.col("need"), F.struct("bin", (F.col("need") - F.col("upto") + F.col("n")).alias("need")))).alias("hit")
        # Fewer than k others: every score counts, so the lowest bin is the edge.
        found = counts.groupBy("query_id").agg(hit, F.min("bin").alias("bottom"), F.first("need").alias("need"))
        found = found.select("query_id", F.coalesce("hit.bin", F.lit(0).cast("long") + F.col("bottom")).alias("prefix"), F.coalesce("hit.need", "need").alias("need"))
        state = cut_lineage(found)
        known = shift
    rows = paired(state, lambda q, c: _winners(q, c, width, low, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
