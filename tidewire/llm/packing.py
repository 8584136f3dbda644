"""Cost-balanced packing of documents into fixed-size training sequences.

A document's tokens are its ids by the tokenizer and one closing id. Its cost is estimated as
`linear` times its tokens (projections, feed-forward) plus their square (attention within the
document). Documents go, the costliest first, each to the sequence of the lowest cost so far that
still has room for it whole; where none has, it fills up the cheapest sequence that has any room,
and what is left of it takes its turn again by its own cost. A document of more than a sequence is
first cut into whole sequences and a rest, which is what the rule would do with it.

Sequences hold `capacity` tokens. A share of T tokens gets T // capacity of them, and for the rest
shorter ones of powers of two, which need no padding; so every sequence is filled to its end.

Scale: pieces of at most one sequence are dealt at random into shards of some SHARD_BYTES of text,
which are packed apart: each is a fair sample of all pieces, so costs also balance between shards,
and the shorter sequences are at most ten among a thousand. A long document is spread over shards;
no task holds more than one shard. Texts are read twice, to size the shards and to tokenise, and
only ids are shuffled, once. A piece is dealt by its document's place in its input partition, so
equal rows spread too; that place must be the same when a lost task is run again, as it is for
stored tables.

The ids are those of the `tokenizers` library. For files that hold plain byte-level BPE they are
taken with tiktoken from the vocabulary of that same file, which gives equal ids (tested) four
times as fast; other files go through `tokenizers` itself. Very long texts are encoded in stretches
cut before a blank that a non-blank follows, where a byte-level token always starts.

Nulls: a null text is the empty one, which has only the closing id; a null id is kept as it is.
Repeated rows are packed each. Ties in cost go to the lower sequence, among documents of a cost to
the one with the smaller id (nulls first). An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import named, self_contained

CAPACITY, CLOSING = 1024, 0
# Cost of a token outside attention, in units of one token attending one other: six times a width of 768.
LINEAR = 6 * 768
SHARD_BYTES = 1 << 22
# Characters of a stretch, and ids of an Arrow batch.
STRETCH, BATCH_IDS = 1 << 18, 1 << 20
# Fixed value: how byte-level BPE cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_START = re.compile(r" (?=\S)")

self_contained(__name__)


def byte_letters() -> dict[str, int]:
    """Letter to byte: printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def is_plain(spec: dict) -> bool:
    """Byte-level BPE without options that change its ids, its merges in the order of their ids."""
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(o) for o in options) or spec["normalizer"]:
        return False
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        return False
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [model["vocab"][m] for m in merged]
    return all(a < b for a, b in zip(ids, ids[1:]))


def encoder(file: str) -> Callable[[str], np.ndarray]:
    """Text to ids, without special tokens added, for the contents of a tokenizer file."""
    spec = json.loads(file)
    if is_plain(spec):
        import tiktoken

        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        byte = byte_letters()
        ranks = {bytes(byte[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: plain.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(file)
    return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """The text in parts of `size` characters or more, each but the first starting at a blank before a non-blank."""
    start = 0
    while len(text) - start > size:
        cut = _START.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def _tokenised(file: str, capacity: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, plain = encoder(file), is_plain(json.loads(file))
        task, row = TaskContext.get().partitionId(), 0
        held, n_ids = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                parts = [encode(part) for part in (stretches(text) if plain else [text])]
                ids = np.concatenate([*parts, [CLOSING]]).astype("<u4")
                for start in range(0, len(ids), capacity):
                    held.append((doc.as_py(), start, len(ids), task << 33 | row, ids[start:start + capacity].tobytes()))
                    row += 1
                n_ids += len(ids)
                if n_ids >= BATCH_IDS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
                    held, n_ids = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)

    return run


def capacities(tokens: int, capacity: int = CAPACITY) -> np.ndarray:
    """Room of the sequences that hold exactly `tokens`: whole ones, then falling powers of two."""
    rest = tokens % capacity
    return np.array([capacity] * (tokens // capacity) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1], dtype=np.int64)


def assign(lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece, for documents of given lengths, none above `capacity`."""
    size = capacities(sum(lengths), capacity)
    room, cost = size.copy(), np.zeros(len(size))
    waiting = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    out = []
    while waiting:
        negative, i, start = heapq.heappop(waiting)
        n = -negative
        at = int(np.where(room >= n, cost, np.inf).argmin())
        if room[at] < n:
            at = int(np.where(room > 0, cost, np.inf).argmin())
            heapq.heappush(waiting, (int(room[at]) - n, i, start + int(room[at])))
            n = int(room[at])
        out.append((i, start, n, at, int(size[at] - room[at])))
        room[at] -= n
        cost[at] += linear * n + n * n
    return out


def _packed(capacity: int, linear: float, schema: pa.Schema):
    def run(shard: pa.Table) -> pa.Table:
        shard = shard.take(pc.sort_indices(shard, [("doc_id", "ascending"), ("start", "ascending"), ("deal", "ascending")], null_placement="at_start"))
        doc, tokens, base = shard["doc_id"], shard["doc_tokens"].to_numpy(), shard["start"].to_numpy()
        ids = [x.as_py() for x in shard["ids"]]
        rows = assign([len(x) // 4 for x in ids], capacity, linear)
        i, start, length, seq, offset = (np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else [()] * 5))
        number = shard["shard"][0].as_py()
        return pa.Table.from_arrays([
            doc.take(pa.array(i)).combine_chunks(), pa.array(base[i] + start), pa.array(length), pa.array(tokens[i]), pa.array((number << 32) + seq), pa.array(offset),
            pa.array([ids[k][4 * s:4 * (s + n)] for k, s, n in zip(i, start, length)], pa.binary()),
        ], schema=schema)

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, linear: float = LINEAR) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    `tokenizer` is the path of a tokenizer file the driver can read; tasks get its contents.
    """
    with open(tokenizer, encoding="utf-8") as source:
        file = source.read()
    rows = named(docs, "doc_id", "text")
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    kind = rows.schema["doc_id"].dataType
    head = f"doc_id {kind.simpleString()}, start long"
    arrow = [pa.field("doc_id", _arrow(rows)), pa.field("start", pa.int64())]
    schema = pa.schema([*arrow, pa.field("doc_tokens", pa.int64()), pa.field("deal", pa.int64()), pa.field("ids", pa.binary())])
    cut = rows.mapInArrow(_tokenised(file, capacity, schema), f"{head}, doc_tokens long, deal long, ids binary")
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)))
    schema = pa.schema([*arrow, *(pa.field(n, pa.int64()) for n in ("length", "doc_tokens", "sequence_id", "offset")), pa.field("ids", pa.binary())])
    return dealt.groupBy("shard").applyInArrow(_packed(capacity, linear, schema), f"{head}, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _arrow(rows: DataFrame) -> pa.DataType:
    """Arrow type of the ids."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)
