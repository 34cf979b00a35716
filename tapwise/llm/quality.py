"""Quality by a vote of the nearest labelled neighbours in a latent semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapwise.llm.drawing import drawn_number, share

# Learned from at most about so many labelled documents of each class, drawn by a hash of doc_id.
SAMPLE_PER_CLASS = 2048
TERMS = 2048
DIMENSIONS = 64
# Of the iteration that finds the axes.
STEPS, SEED = 60, 8
NEIGHBOURS = 25
# A neighbour's vote counts as its similarity to this power.
SHARPNESS = 4
TIE = 1e-6
# How far back a word came last is told in powers of two of words, up to the last of these.
RECURRENCES = 16
HELD_OUT_FOLDS, HELD_OUT = 5, 0
MIN_SCORE = 0.3
BLOCK_DOCS = 512


def held_out(doc_id: str = "doc_id", folds: int = HELD_OUT_FOLDS, fold: int = HELD_OUT) -> Column:
    """A null doc_id is in no fold to learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))


def trigram_counts(text: str) -> np.ndarray:
    """Counts of a text's character trigrams, hashed."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if len(points) < 3:
        return np.zeros(TERMS, np.int64)
    mixed = points[:-2] * np.uint32(0x9E3779B1) ^ points[1:-1] * np.uint32(0x85EBCA6B) ^ points[2:] * np.uint32(0xC2B2AE35)
    terms = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - (TERMS - 1).bit_length())
    return np.bincount(terms, minlength=TERMS)


def term_counts(text: str | None) -> np.ndarray:
    """Counts of a text's trigrams, and of its words by how far back the same word came last.

    The first of the latter are words that are new, the next those that repeat the word before, then those
    two or three words back, and so on. A text of fewer than three characters has no counts.
    """
    text = text or ""
    counts = np.zeros(TERMS + RECURRENCES, np.float32)
    if len(text) < 3:
        return counts
    counts[:TERMS] = trigram_counts(text)
    last: dict[str, int] = {}
    back = [0] * RECURRENCES
    for i, word in enumerate(text.split()):
        back[min((i - last.get(word, i)).bit_length(), RECURRENCES - 1)] += 1
        last[word] = i
    counts[TERMS:] = back
    return counts


@dataclass(frozen=True)
class Space:
    """Term weights, the latent axes, and the labelled vectors in it."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, counts: np.ndarray) -> np.ndarray:
        found = weighted(counts, self.idf) @ self.axes
        return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Of all labelled vectors, by exact cosine, the nearest vote with their similarity."""
        scores = np.full(len(counts), self.prior)
        if not len(self.vectors):
            return scores
        cosines = self.place(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.vectors))
        least = np.partition(cosines, len(self.vectors) - k, axis=1)[:, len(self.vectors) - k]
        # All that tie with the last neighbour vote as well, so that their order does not matter.
        votes = np.where(cosines >= least[:, None] - TIE, np.maximum(cosines, 0), 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        told = total > 0
        scores[told] = (votes @ self.labels)[told] / total[told]
        return np.clip(scores, 0.0, 1.0)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Two parts of length 1 each: trigrams, dampened and weighted by how rare they are, and recurrences as they are."""
    parts = np.log1p(counts[:, :TERMS]) * idf, counts[:, TERMS:]
    return np.hstack(
        [part / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12) for part in parts]
    ).astype(np.float32)


def leading_axes(square: np.ndarray, dimensions: int) -> np.ndarray:
    """The leading eigenvectors of a symmetric matrix, by subspace iteration from a seeded start.

    Half as many again are carried along, so that the last ones wanted settle as well.
    """
    drawn = np.random.default_rng(SEED).standard_normal((len(square), dimensions + dimensions // 2))
    basis = np.linalg.qr(drawn)[0]
    for _ in range(STEPS):
        basis = np.linalg.qr(square @ basis)[0]
    _, turn = np.linalg.eigh(basis.T @ square @ basis)
    return (basis @ turn)[:, ::-1][:, :dimensions]


def document_counts(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of all documents, and in how many of them each term is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found[:TERMS] += trigram_counts(text or "") > 0
            found[TERMS] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(found)], names=["term", "n"])

    counts = np.zeros(TERMS + 1, np.int64)
    for row in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return int(counts[TERMS]), counts[:TERMS]


def learn(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> Space:
    """The space and labelled vectors of a sample of the labelled documents that are not held out.

    Terms are weighted by the number of all documents that have them. Of the sample only counts of terms come
    to the driver: at most about 2 * `sample_per_class` rows of TERMS + RECURRENCES numbers. Labels that are null, or of documents that do not exist, are not used.
    """
    known = labels.where(~held_out() & F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    sizes = {row["quality"]: row["n"] for row in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.lit(0)
    for label, n in sizes.items():
        part = F.when(F.col("quality") == label, share(n, sample_per_class)).otherwise(part)
    drawn = known.where(drawn_number("quality", "doc_id") < part)
    # Twice sample_per_class rows at most, but for the luck of the draw: of rows that share a doc_id, one is taken.
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    sample = sample.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(text).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(counts, pa.binary())],
                names=["doc_id", "quality", "counts"],
            )

    schema = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, quality int, counts binary"
    rows = sample.select("doc_id", "quality", "text").mapInArrow(counted, schema).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
    n = rows.num_rows
    prior = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    labels = rows.column("quality").to_numpy()
    counts = np.empty((n, TERMS + RECURRENCES), np.float32)
    for i, row in enumerate(rows.column("counts")):
        counts[i] = np.frombuffer(row.as_buffer(), np.float32)
    del rows
    everything, having = document_counts(docs)
    idf = np.log((everything + 1) / (having + 1)) + 0.1
    # Block by block, so that the driver holds the counts and one square matrix.
    blocks = [counts[at : at + BLOCK_DOCS] for at in range(0, n, BLOCK_DOCS)]
    square = np.zeros((TERMS + RECURRENCES, TERMS + RECURRENCES))
    for block in blocks:
        terms = weighted(block, idf).astype(np.float64)
        square += terms.T @ terms
    axes = leading_axes(square, DIMENSIONS).astype(np.float32)
    space = Space(idf, axes, np.empty((0, DIMENSIONS), np.float32), labels, prior)
    if not n:
        return space
    return Space(idf, axes, np.concatenate([space.place(block) for block in blocks]), labels, prior)


def score(
    docs: DataFrame, space: Space, min_score: float = MIN_SCORE, names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """All columns of `docs` with a score (0 to 1; the higher, the likelier label 1 is) and what is predicted (0 or 1).

    A text that shares no term with any labelled one, an empty or a null text among them, has the share of
    label 1 among all labels learned from, or 0.5 if there are none. Repeated rows are scored each; an empty
    table gives no rows. Columns of `docs` called like one of `names` are replaced.
    """
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(space)
    place = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_DOCS):
                block = batch.slice(at, BLOCK_DOCS)
                counts = np.stack([term_counts(text) for text in block.column(place).to_pylist()])
                found = shared.value.score(counts)
                columns = [*block.columns, pa.array(found), pa.array((found >= min_score).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.IntegerType())])
    return docs.mapInArrow(scored, schema)
