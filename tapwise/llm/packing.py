"""Best-fit packing of tokenized documents into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.llm.memory import give_back
from tapwise.llm.scratch import stored
from tapwise.llm.tokens import encoder

CAPACITY = 1024
# Pieces are packed in groups of about so many tokens; a group leaves some one sequence part empty.
GROUP_TOKENS = 1 << 22
BATCH_PIECES = 1000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


class OpenBins:
    """Open bins by remaining capacity: a segment tree that counts them over each range."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, number: int, room: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The tightest bin with room for `least`, and its room; none if no bin has that much."""
        count, node = self.count, least + self.leaves
        if not count[node]:
            # Up to the first range to the right that has a bin, then down its left edge.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each length; longest first, each into the tightest open bin."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins, used = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        length = int(lengths[i])
        found = open_bins.take(length)
        if found is None:
            found, used = (used, capacity), used + 1
        number, room = found
        bins[i], offsets[i] = number, capacity - room
        if room > length:
            open_bins.put(number, room - length)
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document's ids: its text's by `vocabulary`, then `end_id`.

    Documents of at most `capacity` ids are one piece. Longer ones are cut into pieces of
    `capacity`; only the first may be shorter. Columns as in PIECE_SCHEMA, and with `with_ids` the ids
    themselves, as little-endian unsigned 32-bit integers.
    """
    end = np.array([end_id], "<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        n = 6 if with_ids else 5
        columns = [pa.array(c, t) for c, t in zip(list(zip(*rows))[:n], types)]
        return pa.RecordBatch.from_arrays(columns, names=names[:n])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows: list[tuple] = []
            for key, found in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                ids = found + end
                first = len(ids) // 4 % capacity * 4 or 4 * capacity
                bounds = [0, *range(first, len(ids) + 1, 4 * capacity)]
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[a:b]
                    rows.append((key, i, a // 4, (b - a) // 4, zlib.crc32(part), part if with_ids else None))
                if len(rows) >= BATCH_PIECES:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)
        give_back()

    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int = CAPACITY,
    group_tokens: int = GROUP_TOKENS,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all `docs` (doc_id, text), each with the sequence it is packed into and its `offset` there.

    Full pieces are sequences of their own. The others are dealt at random into groups of about
    `group_tokens` tokens, and each group is packed longest first, each piece into the open
    sequence with the least room that is enough. A sequence's pieces lie gapless from offset 0.

    A null or empty text is a document of the end id alone; repeated rows are packed each on its own,
    null doc_ids too; an empty table gives no rows. Other columns of `docs` are not used.
    """
    cut = stored(pieces(docs, vocabulary, end_id, capacity, with_ids))
    part = F.col("length") < capacity
    number = F.monotonically_increasing_id()
    full = cut.where(~part).select("*", (-1 - number).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    total = cut.where(part).agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_fit_decreasing(rows["length"].to_numpy(), capacity)
        first = int(rows["_group"].iloc[0]) << 32
        give_back()
        return rows.drop(columns="_group").assign(sequence_id=first + bins, offset=offsets)

    # The row's own number goes into the draw, so that any number of equal rows spread as well.
    dealt = cut.where(part).withColumn("_group", F.pmod(F.xxhash64(number, "doc_id", "piece"), F.lit(groups)))
    schema = full.schema
    packed = dealt.groupBy("_group").applyInPandas(fill, schema)
    return packed.unionByName(full)
