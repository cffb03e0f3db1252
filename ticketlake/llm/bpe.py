"""Byte-level BPE: recursive DuckDB queries inside each partition.

A piece of text (a match of the split pattern) becomes rows (place, token). The recursive query joins each row and
its successor with the merge table, contracts the leftmost pair of least rank of every piece, and goes on with the
pieces that still have a pair. An ordered aggregation over the rows of a piece gives its bytes back.

Only pieces that a task has not met lately are sent to DuckDB, so the recursion sees distinct pieces, in lots of a
bounded number of bytes. No shuffle, and nothing is kept but a store of pieces per worker, bounded in bytes.

A recursive query keeps every step of every token, so its rows grow with the square of a piece. A piece over LONG_PIECE
bytes (a run of letters without a break, or prose written without blanks) is therefore contracted with a heap of its pairs
by rank and place, in linear memory; its ids are decoded by the same ordered aggregation.

Nulls and empty texts have no tokens (n_tokens 0, digest of no bytes). Rows that repeat are encoded as often as they
occur; a null doc_id is an id like any other. Columns other than the two named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import blocks, narrow

#: Bytes of distinct pieces in one query; pieces beyond LONG_PIECE bytes are contracted with a heap.
LOT_BYTES, LONG_PIECE = 120_000, 200
#: Bytes of remembered pieces and ids, with what Python adds to each; the older half goes when there are more.
REMEMBERED_BYTES, _ADDED = 56_000_000, 190
_TEXT_BLOCK = 1_000_000

# A row's g is piece * 2^32 + byte place; m is the rank of the pair it starts, null if there is none.
_START = """
  SELECT 0 AS step, s.g, s.nxt, s.id, s.nid, r.m
  FROM (SELECT g, id, lead(id) OVER o AS nid, lead(g) OVER o AS nxt FROM start WINDOW o AS (ORDER BY g)) s
  LEFT JOIN merges r ON r.pair = CASE WHEN s.nxt >> 32 = s.g >> 32 THEN s.id::BIGINT * 1048576 + s.nid END
"""
_ONE_PAIR = """
  SELECT s.step + 1 AS step, s.g, CASE WHEN s.g = b.spot THEN b.made ELSE s.id END AS id
  FROM state s JOIN (
    SELECT g >> 32 AS w, min(m) AS made, arg_min(g, m::HUGEINT << 64 | g) AS spot, arg_min(nxt, m::HUGEINT << 64 | g) AS gone
    FROM state WHERE m IS NOT NULL GROUP BY ALL
  ) b ON s.g >> 32 = b.w AND s.g <> b.gone
"""
_AGAIN = f"""
  SELECT n.step, n.g, n.nxt, n.id, n.nid, r.m
  FROM (SELECT step, g, id, lead(id) OVER o AS nid, lead(g) OVER o AS nxt FROM ({_ONE_PAIR}) WINDOW o AS (ORDER BY g)) n
  LEFT JOIN merges r ON r.pair = CASE WHEN n.nxt >> 32 = n.g >> 32 THEN n.id::BIGINT * 1048576 + n.nid END
"""
_ENCODE = f"""
  CREATE OR REPLACE TEMP TABLE found AS
  WITH RECURSIVE state AS ({_START} UNION ALL {_AGAIN}),
  ended AS (SELECT g >> 32 AS w, max(step) AS step FROM state GROUP BY ALL)
  SELECT s.g, s.id FROM state s JOIN ended e ON s.g >> 32 = e.w AND s.step = e.step
"""
_IDS = "SELECT g >> 32 AS w, list(id ORDER BY g) AS parts FROM found GROUP BY ALL ORDER BY w"
_BYTES = "SELECT f.g >> 32 AS w, list(v.piece ORDER BY f.g) AS parts FROM found f JOIN vocabulary v USING (id) GROUP BY ALL ORDER BY w"


def _joined(rows: pa.Table, width: int | None = None) -> Iterator[tuple[int, bytes]]:
    """Each w with its ordered parts, one after the other; they lie so in Arrow's buffers, as numbers of `width` bytes or as texts."""
    for chunk in rows.to_batches():
        lists = chunk.column("parts")
        ends = lists.offsets.to_numpy()
        parts = lists.values
        if width is None:
            ends = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset :][ends]
            data = parts.buffers()[2]
        else:
            ends = (ends.astype(np.int64) + parts.offset) * width
            data = parts.buffers()[1]
        data, stops = data.to_pybytes() if data else b"", ends.tolist()
        for w, start, stop in zip(chunk.column("w").to_pylist(), stops[:-1], stops[1:], strict=True):
            yield w, data[start:stop]


class Coder:
    """One in-memory DuckDB with the merge table of a rank file (lines of base64 token and rank)."""

    def __init__(self, rank_file: str, pattern: str):
        with open(rank_file, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        ranks, pairs = self.ranks, []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append((left * 1048576 + right, rank))
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "160MB", "temp_directory": ""})
        self._table("merges", pa.table({"pair": pa.array([p for p, _ in pairs], pa.int64()), "m": pa.array([m for _, m in pairs], pa.int32())}))
        self._table("vocabulary", pa.table({"id": pa.array(list(ranks.values()), pa.int32()), "piece": pa.array(list(ranks), pa.binary())}))
        self.ids: dict[str, bytes] = {}
        #: Decoded bytes of remembered pieces, where they differ from the piece itself.
        self.other: dict[str, bytes] = {}
        self.held = 0

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def encode_pieces(self, pieces: list[bytes]) -> tuple[list[list[int]], list[bytes]]:
        """Token ids of each piece, and the bytes that those ids stand for."""
        ids, decoded = self.encode_packed(pieces)
        return [np.frombuffer(x, "<u4").tolist() for x in ids], decoded

    def encode_packed(self, pieces: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """As `encode_pieces`, ids as little-endian numbers of four bytes. A piece that is a token is not contracted."""
        ids = [self.ranks[p].to_bytes(4, "little") if p in self.ranks else b"" for p in pieces]
        decoded = [b""] * len(pieces)
        short = [k for k, p in enumerate(pieces) if not ids[k] and 0 < len(p) <= LONG_PIECE]
        whole = [k for k in range(len(pieces)) if ids[k]]
        for k in range(0, len(whole), 10_000):
            self._decode(whole[k : k + 10_000], ids, decoded)
        lot: list[int] = []
        size = 0
        for k in short:
            if lot and size + len(pieces[k]) > LOT_BYTES:
                self._contract(lot, pieces, ids, decoded)
                lot, size = [], 0
            lot.append(k)
            size += len(pieces[k])
        self._contract(lot, pieces, ids, decoded)
        for k, piece in enumerate(pieces):
            if not ids[k] and len(piece) > LONG_PIECE:
                ids[k] = np.array(self.contract_long(piece), "<u4").tobytes()
                self._decode([k], ids, decoded)
        return ids, decoded

    def contract_long(self, piece: bytes) -> list[int]:
        """Token ids of one piece: the leftmost pair of least rank first, until none is left."""
        ranks, size = self.ranks, len(piece)
        after, before = array("q", range(1, size + 1)), array("q", range(-1, size))
        rank_of = array("q", [-1]) * size  # rank of the pair that starts at a place; -1: none, or the place is gone

        def measure(at: int) -> int:
            second = after[at]
            return ranks.get(piece[at : after[second]], -1) if second < size else -1

        heap = []
        for at in range(size - 1):
            rank_of[at] = rank = measure(at)
            if rank >= 0:
                heap.append(rank << 40 | at)
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            rank, at = top >> 40, top & (1 << 40) - 1
            if rank_of[at] != rank:
                continue
            gone = after[at]
            after[at] = after[gone]
            before[after[at]] = at
            rank_of[gone] = -1
            for place in (at, before[at]):
                if place >= 0:
                    rank_of[place] = new = measure(place)
                    if new >= 0:
                        heapq.heappush(heap, new << 40 | place)
        ids, at = [], 0
        while at < size:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def _contract(self, lot: list[int], pieces: list[bytes], ids: list, decoded: list) -> None:
        if not lot:
            return
        lengths = np.array([len(pieces[k]) for k in lot])
        rows = np.repeat(np.arange(len(lot), dtype=np.int64) << 32, lengths)
        rows += np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        tokens = self.single[np.frombuffer(b"".join([pieces[k] for k in lot]), np.uint8)]
        self.con.register("start", pa.table({"g": rows, "id": tokens}))
        self.con.execute(_ENCODE)
        self.con.unregister("start")
        for w, found in _joined(self.con.sql(_IDS).to_arrow_table(), width=4):
            ids[lot[w]] = found
        for w, data in _joined(self.con.sql(_BYTES).to_arrow_table()):
            decoded[lot[w]] = data

    def _decode(self, lot: list[int], ids: list[bytes], decoded: list) -> None:
        for k, data in zip(lot, self._decode_packed([ids[k] for k in lot]), strict=True):
            decoded[k] = data

    def decode(self, lists: Iterable[Iterable[int]]) -> list[bytes]:
        """Bytes of each list of ids, by one ordered aggregation."""
        return self._decode_packed([np.array(list(x), "<u4").tobytes() for x in lists])

    def _decode_packed(self, lists: list[bytes]) -> list[bytes]:
        lengths = np.array([len(x) // 4 for x in lists], np.int64)
        places = np.repeat(np.arange(len(lists), dtype=np.int64) << 32, lengths)
        places += np.arange(len(places)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.con.register("given", pa.table({"g": places, "id": np.frombuffer(b"".join(lists), "<i4")}))
        self.con.execute("CREATE OR REPLACE TEMP TABLE found AS SELECT * FROM given")
        self.con.unregister("given")
        out = [b""] * len(lists)
        for w, data in _joined(self.con.sql(_BYTES).to_arrow_table()):
            out[w] = data
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Remember the ids of some distinct pieces; until the next call all of them are known."""
        words = list(words)
        if self.held > REMEMBERED_BYTES:
            for word in list(self.ids)[: len(self.ids) // 2]:
                self.held -= _weight(word, self.ids.pop(word))
                self.other.pop(word, None)
        new = [w for w in words if w not in self.ids]
        for first in range(0, len(new), _LEARNT):
            part = new[first : first + _LEARNT]
            raw = [w.encode() for w in part]
            ids, decoded = self.encode_packed(raw)
            for word, data, found, back in zip(part, raw, ids, decoded, strict=True):
                self.ids[word] = found
                self.held += _weight(word, found)
                if back != data:
                    self.other[word] = back

    def decoded(self, words: list[str]) -> bytes:
        """What the ids of learnt pieces stand for, one after the other."""
        if not self.other:
            return "".join(words).encode()
        return b"".join([self.other.get(w, w.encode()) for w in words])


#: Pieces learnt at a time.
_LEARNT = 20_000


def _weight(word: str, ids: bytes) -> int:
    return 2 * len(word) + len(ids) + _ADDED


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(rank_file: str, pattern: str) -> Coder:
    """The coder of this worker; it outlives a task, so the merge table is loaded once."""
    key = (rank_file, pattern)
    if key not in _CODERS:
        _CODERS[key] = Coder(*key)
    return _CODERS[key]


def encode(docs: DataFrame, rank_file: str, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens and the token ids of every text, or with `digests` the digests of ids and of the decoded bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(rank_file, pattern)
        for part in blocks(batches, limit=_TEXT_BLOCK):
            split = [own.pattern.findall(text) for text in part.column("text").to_pylist()]
            own.learn(set().union(*split))
            ids = [b"".join(map(own.ids.__getitem__, words)) for words in split]
            columns = [part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if digests:
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()))
                columns.append(pa.array([hashlib.sha256(own.decoded(words)).hexdigest() for words in split], pa.string()))
            else:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = narrow(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    rest = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<bigint>"
    names = ["doc_id", "n_tokens", *[x.split()[0] for x in rest.split(", ")]]
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, {rest}")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of each list of `ids` (null: no bytes), by ordered aggregation in DuckDB."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(rank_file, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                data = own.decode([x or [] for x in part.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "bytes"])

    source = encoded.select("doc_id", F.col("ids").cast("array<bigint>").alias("ids"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, bytes binary")
