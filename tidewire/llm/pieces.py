"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from a model file. The normaliser maps a blank to U+2581 and adds the
leading one. The lexicon is a trie of all pieces whose arcs carry minus the piece's score; a
character without a piece leaves by byte fallback, one arc a byte. Composition with a text is the
lattice of pieces over its characters, and the encoding is its shortest path in the tropical
semiring, found position by position.

A unigram model needs no more. In a BPE model, merges decide, not sums of scores; there the lattice
is composed with one more machine, over pairs of neighbouring pieces: a pair is let through if
merging the two strings together gives just that pair, so states are a position and the last
piece. A path all of whose pairs pass is the merge result, and only one does, so the shortest
path is the encoding of the library, exactly. Arcs are computed when first needed and remembered.

No piece spans the start of a word or a character without longer pieces (checked when compiled), so
a text is cut there and each unit's path is remembered: repeated words cost a look-up.

Supported models: identity normaliser, as in the model of the box; others are refused on loading.
Decoding joins pieces and bytes and takes the leading blank away; it gives the text back exactly,
but for U+2581 in a text, which the format itself reads as a blank.

Nulls: a null text is the empty one; it has no pieces. Repeated rows are encoded each, texts of any
length whole. Ties between paths go to the one found first, shorter arcs first. An empty table
gives an empty result. Other columns are kept by `encoded`, but for its own `ids` and `n_pieces`.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import named, self_contained

BLANK = "▁"
# Units remembered by a worker, in each of two halves; pairs likewise.
CACHE = 200_000
# Weight of leaving by bytes; above that of any piece, so it is a last resort.
_BYTE_COST, _FAR = 1e6, float("inf")
_NONE: dict[int, bool] = {}
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

self_contained(__name__)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size = varint()
            yield key >> 3, data[at:at + size]
            at += size


def load(path: str = DEFAULT_MODEL) -> dict:
    """Pieces, scores and kinds of a model file, and its settings."""
    # Field numbers and piece kinds of the public model format.
    pieces, settings = [], {"bpe": False, "prefix": True}
    with open(path, "rb") as file:
        for number, value in _fields(file.read()):
            if number == 1:
                part = dict(_fields(value))
                score = float(np.frombuffer(part.get(2, b"\0\0\0\0"), "<f4")[0])
                pieces.append((part[1].decode(), score, part.get(3, 1)))
            elif number == 2:
                settings["bpe"] = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                spec = dict(_fields(value))
                if spec.get(2) or spec.get(4, 1) or not spec.get(5, 1):
                    raise ValueError("only models with an identity normaliser are supported")
                settings["prefix"] = bool(spec.get(3, 1))
    if any(kind == 4 for _, _, kind in pieces):
        raise ValueError("models with user-defined pieces are not supported")
    return {"pieces": pieces, **settings}


def machine_of(model: dict) -> Transducer:
    """The transducer of a broadcast model, compiled once per worker and kept with its memory."""
    if "machine" not in model:
        model["machine"] = Transducer(model)
    return model["machine"]


class Transducer:
    """The compiled machines, and the memory of paths found."""

    def __init__(self, model: dict):
        normal = {p: i for i, (p, _, kind) in enumerate(model["pieces"]) if kind == 1}
        self.scores = [s for _, s, _ in model["pieces"]]
        self.ids, self.bpe, self.prefix = normal, model["bpe"], model["prefix"]
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model["pieces"]) if kind == 6}
        self.unknown = next(i for i, (_, _, kind) in enumerate(model["pieces"]) if kind == 2)
        self.text = [p if kind == 1 else "" for p, _, kind in model["pieces"]]
        self.raw = [
            p.replace(BLANK, " ").encode() if kind == 1 else bytes([int(p[3:5], 16)]) if kind == 6 else b""
            for p, _, kind in model["pieces"]
        ]
        if any(BLANK in p.lstrip(BLANK) for p in normal):
            raise ValueError("a piece spans the start of a word")
        # Lexicon: a state per prefix; a state's piece, if any, and its arcs by character.
        self.trie: dict = {}
        for piece, number in normal.items():
            state = self.trie
            for ch in piece:
                state = state.setdefault(ch, {})
            state[""] = ((number,), -self.scores[number])
        joined = "".join(sorted({ch for p in normal if len(p) > 1 for ch in p} - {BLANK}))
        self.units = re.compile(f"{BLANK}*[{re.escape(joined)}]+|{BLANK}+|[^{BLANK}]", re.S)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.tested = 0
        # How merging makes each piece: its last two parts, and whether it does at all.
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[int, bool] = {}

    def split(self, piece: int) -> tuple[int, int]:
        """The two pieces whose merging makes a piece last; (piece, piece) for one that merging cannot
        take apart: a single character, or a piece that merging its characters does not give."""
        found = self.halves.get(piece)
        if found is None:
            parts, found = list(self.text[piece]), (piece, piece)
            while len(parts) > 1:
                best = max(((self.scores[n], -i) for i in range(len(parts) - 1) if (n := self.ids.get(parts[i] + parts[i + 1])) is not None), default=None)
                if best is None:
                    break
                i = -best[1]
                if len(parts) == 2:
                    found = (self.ids.get(parts[0], -2), self.ids.get(parts[1], -2))
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            self.halves[piece] = found
            self.made[piece] = len(parts) == 1
        return found

    def passes(self, left: int, right: int) -> bool:
        """Whether the neighbour machine has an arc from one piece to the next; left -1 is the start.

        A piece may stand on a path if merging its characters makes it; bytes always may. Two pieces
        may stand side by side if, while both were made, no merge across their border came first:
        merges are undone from the last one back, and a pair that meets at the border must not have a
        piece of its own that is better than (left of it: at least as good as) the merge undone.
        """
        a, b = self.text[left] if left >= 0 else "", self.text[right]
        if not b or (left >= 0 and not a):
            found = True
        else:
            self.split(right)
            found = self.made[right] and (not a or self.apart(left, right))
        self.tested += 1
        if self.tested > CACHE:
            self.pairs.clear()
            self.tested = 0
        self.pairs.setdefault(left, {})[right] = found
        return found

    def apart(self, a: int, b: int) -> bool:
        scores, text, ids = self.scores, self.text, self.ids
        # What a merge across the border must beat: (score, whether a tie is enough).
        bar, tie = float("-inf"), False
        while True:
            across = ids.get(text[a] + text[b])
            if across is not None and (scores[across] > bar or (tie and scores[across] == bar)):
                return False
            (_, a_right), (b_left, _) = self.split(a), self.split(b)
            whole_a, whole_b = a_right == a, b_left == b
            if whole_a and whole_b:
                return True
            # The later merge is the one of the lower score; on equal scores the right one.
            if not whole_a and (whole_b or scores[a] < scores[b]):
                bar, tie, a = scores[a], False, a_right
            else:
                bar, tie, b = scores[b], True, b_left
            if a < 0 or b < 0:
                return True

    def fallback(self, ch: str) -> tuple[tuple[int, ...], float]:
        """What a character without a piece puts out, and the weight of that arc."""
        return tuple(self.bytes.get(b, self.unknown) for b in ch.encode("utf-8", "replace")), _BYTE_COST

    def arcs(self, unit: str, at: int) -> list[tuple[int, tuple[int, ...], float]]:
        """(end, ids put out, weight) of the lexicon's arcs from a position, shortest first."""
        found = [] if unit[at] in self.ids else [(at + 1, *self.fallback(unit[at]))]
        state, end, n = self.trie, at, len(unit)
        while end < n and (state := state.get(unit[end])) is not None:
            end += 1
            if "" in state:
                found.append((end, *state[""]))
        return found

    def shortest(self, unit: str) -> list[int]:
        """Piece ids on the tropical shortest path through the composed machines, for one unit.

        `weight` and `back` hold the best path known to each position. Arcs are relaxed from left to
        right, and of equal paths the first found stays. With the neighbour machine, the only
        accepted path to a position is the merge result of the text up to there, so a position is
        settled by the first arc that reaches it, in whatever order: then they are settled depth
        first, longest arcs first, and the search ends with the last position.
        """
        n = len(unit)
        weight, last, back = [0.0] + [_FAR] * n, [-1] * (n + 1), [None] * (n + 1)
        if not self.bpe:
            for at in range(n):
                for end, ids, cost in self.arcs(unit, at) if weight[at] < _FAR else ():
                    if weight[at] + cost < weight[end]:
                        weight[end], back[end] = weight[at] + cost, (at, ids)
        else:
            open_, rows = [(0, self.arcs(unit, 0))], self.pairs
            while back[n] is None:
                at, arcs = open_[-1]
                before = last[at]
                row = rows.get(before, _NONE)
                while arcs:
                    end, ids, cost = arcs.pop()
                    if back[end] is None:
                        let = row.get(ids[0])
                        if self.passes(before, ids[0]) if let is None else let:
                            weight[end], last[end], back[end] = weight[at] + cost, ids[-1], (at, ids)
                            if end < n:
                                open_.append((end, self.arcs(unit, end)))
                            break
                else:
                    open_.pop()
        path, at = [], n
        while at:
            at, ids = back[at]
            path.append(ids)
        return [i for ids in reversed(path) for i in ids]

    def ids_of(self, unit: str) -> bytes:
        """A unit's ids, from the older half of the memory or the shortest path."""
        ids = self.older.get(unit)
        if ids is None:
            ids = struct.pack(f"<{len(found)}i", *found) if (found := self.shortest(unit)) else b""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        self.known[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The piece ids of a text as little-endian 32-bit numbers."""
        if not text:
            return b""
        normal = text.replace(" ", BLANK)
        if self.prefix:
            normal = BLANK + normal
        known, out = self.known.get, []
        for unit in self.units.findall(normal):
            ids = known(unit)
            if ids is None:
                ids = self.ids_of(unit)
                known = self.known.get
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return data[1:] if self.prefix and data[:1] == " " else data


def encoded(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """The columns of `docs`, with `ids` (array of int) and `n_pieces`, which replace any of that name
    in whatever case. Columns go to Python and back by position, so their names do not matter."""
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    text = docs.columns.index("text")
    rows = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(shared.value)
        for batch in batches:
            found = [np.frombuffer(machine.encode(t or ""), dtype="<i4") for t in batch.column(text).to_pylist()]
            sizes = np.array([len(f) for f in found], dtype=np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*found, np.zeros(0, "<i4")])))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(sizes)], names=[*batch.schema.names, "ids", "n_pieces"])

    out = rows.mapInArrow(run, f"{fields}, ids array<int>, n_pieces long")
    kept = [(i, name) for i, name in enumerate(docs.columns) if name.lower() not in ("ids", "n_pieces")]
    return out.select(*[F.col(f"_{i}").alias(name) for i, name in kept], "ids", "n_pieces")


def digests(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_pieces, ids_sha256, text_sha256 (of the decoded ids), round_trip: encoded and decoded again.

    ids_sha256 is over the ids as little-endian 32-bit numbers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(model))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = machine.encode(text or "")
                back = machine.decode(np.frombuffer(ids, dtype="<i4").tolist())
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            columns = list(zip(*rows)) or [[]] * 4
            types = (pa.int64(), pa.string(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]], names=["doc_id", "n_pieces", "ids_sha256", "text_sha256", "round_trip"])

    return named(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_pieces long, ids_sha256 string, text_sha256 string, round_trip boolean")
