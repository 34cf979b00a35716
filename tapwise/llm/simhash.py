"""SimHash near-duplicates: pigeonhole blocks, then the Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapwise.llm.components import components
from tapwise.llm.runs import starts, whole_runs
from tapwise.llm.scratch import fresh, stored

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
# Fingerprints are cut into so many blocks; close pairs agree on all but MAX_BITS of them.
BLOCKS = 6
# Fingerprints that share blocks are compared in tiles of two lots of at most so many.
LOT = 2048
HASH_SLICE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is in over half of the hashes of all shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    first = (ends - [len(word) + 1 for word in words])[: len(words) - shingle_words + 1].tolist()
    last = (ends[shingle_words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(first), HASH_SLICE):
        spans = zip(first[at : at + HASH_SLICE], last[at : at + HASH_SLICE])
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], ">u8")
        votes += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, bits) of every document; bits as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle_words) for text in batch.column("text").to_pylist()]
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], names=["doc_id", "bits"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(hashed, "doc_id long, bits long")


def block_keys(max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> Column:
    """One key for each choice of blocks - max_bits blocks of `bits`: the choice's number and their bits."""
    if blocks <= max_bits:
        raise ValueError("there must be more blocks than bits that may differ")
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(bounds, bounds[1:])]
    keys = []
    for number, chosen in enumerate(combinations(masks, blocks - max_bits)):
        mask = sum(chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col("bits").bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def _roots(near: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, from a symmetric matrix of links."""
    roots = np.arange(len(near))
    while True:
        least = np.where(near, roots[None, :], len(near)).min(axis=1)
        least = np.minimum(least, roots)
        least = least[least]
        if (least == roots).all():
            return roots
        roots = least


def links(bits: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, lot: int = LOT) -> DataFrame:
    """Links (a, b) that connect all fingerprints in `bits` within `max_bits` of each other.

    If at most `max_bits` bits differ, at least blocks - max_bits blocks agree, so a close pair
    meets under at least one key. Fingerprints that share a key are compared with each other,
    all of them; where there are more than `lot`, in tiles of two lots each. Of the
    close pairs of a tile only as many are given as connect what they connect.
    """
    keyed = bits.select("bits", F.explode(block_keys(max_bits, blocks)).alias("key"))
    crowded = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > lot))
    lots = F.coalesce(F.ceil(F.col("n") / lot), F.lit(1)).cast("int")
    dealt = (
        keyed.join(crowded, "key", "left")
        .withColumn("lots", lots)
        .withColumn("own", F.pmod(F.xxhash64(F.lit("lot"), "bits"), F.col("lots")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
        .select(
            "key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            "bits",
        )
    )
    group = ["key", "low", "high"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, group):
            values = table.column("bits").to_numpy().view(np.uint64)
            begin = starts(table, group)
            size = np.diff(begin, append=len(values))
            a, b = [], []
            # Most that share a key are two; those are compared all at once.
            two = begin[size == 2]
            close = np.bitwise_count(values[two] ^ values[two + 1]) <= max_bits
            a.append(values[two][close])
            b.append(values[two + 1][close])
            for at, n in zip(begin[size > 2], size[size > 2]):
                own = values[at : at + n]
                near = np.bitwise_count(own[:, None] ^ own[None, :]) <= max_bits
                roots = _roots(near)
                moved = np.flatnonzero(roots != np.arange(n))
                a.append(own[moved])
                b.append(own[roots[moved]])
            a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return (
        dealt.repartition(*[F.col(c) for c in group])
        .sortWithinPartitions(*group, "bits")
        .mapInArrow(verify, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    lot: int = LOT,
) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of `docs` (doc_id, text).

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a text of fewer words
    than a shingle has one shingle, a null text or one without words has fingerprint zero. Documents
    whose fingerprints differ in at most `max_bits` bits are linked; component_id is the
    smallest doc_id that links lead to, the document's own included. Copies share a fingerprint,
    and each fingerprint is compared once, however many documents have it.

    Repeated rows come back as often as they came; a null doc_id comes back with its component,
    of which it is never the name (null if the component has no other doc_id); an empty table
    gives no rows. Other columns of `docs` are not used.
    """
    rows = stored(fingerprints(docs, shingle_words))
    own = rows.groupBy("bits").agg(F.min("doc_id").alias("least"))
    roots = _roots_of(own, max_bits, blocks, lot)
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(roots.join(least, "root").select("bits", "component_id"))
    return rows.join(named, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _roots_of(own: DataFrame, max_bits: int, blocks: int, lot: int) -> DataFrame:
    """`own`, one row for each fingerprint, with `root`: the least fingerprint of its component."""
    own = stored(own)
    roots = components(links(own.select("bits"), max_bits, blocks, lot))
    return own.join(roots, own["bits"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "bits"))


def keep_one(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    lot: int = LOT,
) -> DataFrame:
    """Of each component of linked documents one row of `docs`, with all its columns.

    Links are those of `near_duplicates`. The row with the smallest doc_id stays (a null one only
    if there is no other), and of rows that share it any one.
    """
    bits, row = fresh(docs, "bits"), fresh(docs, "row")
    place = docs.columns.index("text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle_words) for t in batch.column(place).to_pylist()]
            column = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, bits])

    schema = T.StructType([*docs.schema.fields, T.StructField(bits, T.LongType())])
    # Rows are numbered in the stored table, so a row's number stays the same from here on.
    staged = stored(docs.mapInArrow(hashed, schema).withColumn(row, F.monotonically_increasing_id()))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.col(row).alias("row"))
    own = staged.groupBy(F.col(bits).alias("bits")).agg(F.min(first).alias("first"))
    stay = _roots_of(own, max_bits, blocks, lot).groupBy("root").agg(F.min("first").alias("first"))
    stay = stored(stay.select(F.col("first.row").alias(row)))
    # The same way at every size: the rows that stay grow with the documents.
    return staged.join(stay.hint("merge"), row, "left_semi").select(*[F.col(f"`{name}`") for name in docs.columns])
