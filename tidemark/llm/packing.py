"""Best-fit packing of token sequences, repacked until lower bounds certify the bins."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

CAPACITY = 1024
END_ID = 2
#: Pieces that one task packs, about.
PART = 100_000
#: Rounds of exchange at most; each one deals out anew only the pieces of bins that were given up.
ROUNDS = 8
#: Bins that a part gives up for each bin above its bound, those with most room first.
GIVEN = 16
#: Chunks whose ids a worker remembers before it starts anew.
MEMORY = 300_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary(name: str) -> str:
    """Path of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder(dict):
    """Token ids of texts, as little-endian unsigned 32-bit bytes.

    A text is cut before each space. Where no other white space touches that space, no token
    can reach across the cut, because the tokenizer's words take a space at their start only.
    So the ids of a chunk are the same wherever it stands, and are kept for the next time. A
    text in which white space meets white space, or which holds the special token, is encoded
    whole. ``tokenizer`` is the JSON file; ``ranks`` is the same vocabulary in the form that
    encodes single chunks fast.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = tokenizers.Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        self.part = tiktoken.Encoding(
            "chunks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    def __missing__(self, chunk: str) -> bytes | None:
        if len(self) >= MEMORY:
            self.clear()
        # None: white space touches the space before or after this chunk.
        safe = chunk and not chunk[0].isspace() and not chunk[-1].isspace()
        found = self._ids(self.part.encode_ordinary(" " + chunk)) if safe else None
        self[chunk] = found
        return found

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if "<|" in text:
            return self._ids(self.whole.encode(text, add_special_tokens=False).ids)
        first, *rest = text.split(" ")
        try:
            tail = b"".join(map(self.__getitem__, rest))
        except TypeError:  # a chunk that can't be encoded on its own
            return self._ids(self.whole.encode(text, add_special_tokens=False).ids)
        if first and rest and first[-1].isspace():
            return self._ids(self.whole.encode(text, add_special_tokens=False).ids)
        return self._ids(self.part.encode_ordinary(first)) + tail


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def token_pieces(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, turn): the ids of each text and an end, cut to capacity.

    Only documents of more than ``capacity`` ids are cut, into pieces of exactly that length
    but for the first, which takes the rest. A null text is empty: its end alone. ``turn``
    counts the rows of a task and serves to deal pieces out evenly, whatever their ids.
    """
    files = vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _ENCODERS:
            _ENCODERS[files] = ChunkEncoder(*files)
        encoder, turn = _ENCODERS[files], 0
        for batch in batches:
            ids: list[int | None] = []
            rows: list[tuple[int, int, int, int]] = []
            for id_, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoder.encode(value.as_py() or "") + end
                n = len(data) // 4
                start, k = 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    rows.append((k, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
                    ids.append(id_)
                    start, k = start + length, k + 1
            piece, start, length, crc = np.array(rows, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, type=pa.int64()),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc),
                    pa.array(np.arange(turn, turn + len(ids))),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "turn"],
            )
            turn += len(ids)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(pieces, PIECES + ", turn long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by dual feasible functions.

    Each function maps lengths so that what fits in a bin still sums to one at most; the sum
    over all items then is a bound. Tried: the identity, the functions that round to multiples
    of 1/k, and those that drop items below a threshold and fill up those above its
    complement. All in integers.
    """
    if not len(lengths):
        return 0
    x, counts = np.unique(np.asarray(lengths, dtype=np.int64), return_counts=True)
    k = np.arange(1, 65)[:, None]
    scaled = (k + 1) * x
    rounded = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity) @ counts
    e = np.unique(np.append(x[x <= capacity // 2], 0))[:, None]
    dropped = np.where(x > capacity - e, capacity, np.where(x < e, 0, x)) @ counts
    return int(max((-(-rounded // (k[:, 0] * capacity))).max(), (-(-dropped // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the room left in each bin.

    Items go in order of falling length, each into the bin with the least room that takes it.
    A bit for each possible room tells which rooms some bin has.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []
    there = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = there >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                there ^= 1 << room
        else:
            room, chosen = capacity, len(rooms)
            rooms.append(capacity)
        bins[i], offsets[i] = chosen, capacity - room
        left = room - length
        rooms[chosen] = left
        by_room[left].append(chosen)
        if left:
            there |= 1 << left
    return bins, offsets, np.array(rooms, dtype=np.int64)


PACKED = PIECES + ", sequence_id long, offset long, open boolean"


def _pack_part(capacity: int, turn: int):
    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        lengths = rows["length"].to_numpy()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        gap = len(rooms) - lower_bound(lengths, capacity)
        given = np.zeros(len(rooms), dtype=bool)
        given[np.argsort(-rooms, kind="stable")[: GIVEN * gap]] = True
        given &= rooms > 0
        return rows.drop(columns="part").assign(
            sequence_id=(turn << 56) + (int(key[0]) << 28) + bins, offset=offsets, open=given[bins]
        )

    return pack


def pack_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    part: int = PART,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces are dealt into parts of about ``part`` pieces by their turn, and each part is packed
    by best-fit decreasing. A part whose bins equal its lower bound is certified and done. The
    others give up the bins with most room, a number in proportion to the gap, and those pieces
    meet in fewer parts for the next round; the rounds end when no part has a gap, when one part holds all that is open, or
    after ``ROUNDS``. All rows come out, once each: null and empty texts are a piece of one end,
    repeated rows are separate pieces, ties in length go by doc_id and piece. An empty table
    gives no row. Other columns of ``docs`` play no part.

    The pieces are checkpointed, so no text is encoded twice; each round's result is too. A
    task holds one part and no text.
    """
    open_rows = cut(token_pieces(docs, doc_id, text, capacity, end_id))
    done: list[DataFrame] = []
    for turn in range(ROUNDS):
        count = open_rows.count()
        parts = max(1, -(-count // part))
        dealt = open_rows.withColumn("part", F.col("turn") % parts).drop("turn")
        packed = cut(dealt.groupBy("part").applyInPandas(_pack_part(capacity, turn), PACKED))
        last = parts == 1 or turn == ROUNDS - 1
        settled = packed if last else packed.filter("not open")
        done.append(settled.drop("open"))
        if last:
            break
        open_rows = (
            packed.filter("open")
            .withColumn("turn", F.pmod(F.xxhash64("sequence_id"), F.lit(1 << 40)))
            .drop("sequence_id", "offset", "open")
        )
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result
