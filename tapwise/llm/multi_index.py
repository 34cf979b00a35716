"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapwise.llm.components import components
from tapwise.llm.drawing import drawn_number, share
from tapwise.llm.runs import starts, whole_runs
from tapwise.llm.scratch import stored

MIN_COSINE = 0.95
# Codebooks and the number of cells to visit are fitted on about so many vectors.
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
# Each half has about sqrt(n / CELL_ROWS) words, so that a cell of the grid holds about CELL_ROWS
# vectors, up to MOST_WORDS.
CELL_ROWS = 128
MOST_WORDS = 1024
# The share of pairs just at the least cosine that the visited cells must hold.
TARGET_RECALL = 0.98
CALIBRATED = 2_000
ROUNDS = 12
# Vectors of a cell are compared in tiles of at most so many visitors and residents.
LOT = 1024
SEED = 11


def _codebook(points: np.ndarray, words: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's k-means; a word that loses all points moves to a random one."""
    book = points[rng.choice(len(points), words, replace=len(points) < words)]
    for _ in range(ROUNDS):
        near = _distances(points, book).argmin(axis=1)
        size = np.bincount(near, minlength=words)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        lost = size == 0
        book = sums / np.maximum(size, 1)[:, None]
        book[lost] = points[rng.integers(len(points), size=lost.sum())]
    return book


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (points**2).sum(axis=1)[:, None] - 2 * points @ book.T + (book**2).sum(axis=1)


def nearest_cells(points: np.ndarray, books: tuple[np.ndarray, np.ndarray], visits: int) -> np.ndarray:
    """The `visits` cells nearest to each point, nearest first: one row of cell numbers per point.

    Multi-sequence traversal: the words of each half are sorted by distance. A cell that is i-th by
    its first word and j-th by its second has (i + 1)(j + 1) - 1 cells that are no farther, so only
    those with (i + 1)(j + 1) <= visits can be among the nearest; of these the least sums are taken.
    """
    half = books[0].shape[1]
    order, sorted_distances = [], []
    for part, book in zip((points[:, :half], points[:, half:]), books):
        distances = _distances(part, book)
        rank = distances.argsort(axis=1, kind="stable")[:, :visits]
        order.append(rank)
        sorted_distances.append(np.take_along_axis(distances, rank, axis=1))
    wide = [rank.shape[1] for rank in order]
    front = [(i, j) for i in range(wide[0]) for j in range(min(wide[1], visits // (i + 1)))]
    i, j = np.array(front).T
    sums = sorted_distances[0][:, i] + sorted_distances[1][:, j]
    first = sums.argsort(axis=1, kind="stable")[:, :visits]
    return np.take_along_axis(order[0][:, i] * len(books[1]) + order[1][:, j], first, axis=1)


def calibrate(sample: np.ndarray, books: tuple[np.ndarray, np.ndarray], least: float, recall: float, rng) -> int:
    """How many cells to visit so that of pairs whose cosine is just `least` the share `recall` is found.

    Each point gets a partner at that cosine in a random direction; a pair is found once either's
    traversal comes to the other's cell.
    """
    points = sample[: min(len(sample), CALIBRATED)]
    away = rng.normal(size=points.shape)
    away -= (away * points).sum(axis=1, keepdims=True) * points
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    partner = least * points + math.sqrt(max(0.0, 1 - least * least)) * away
    cells = len(books[0]) * len(books[1])
    visits = 1
    while True:
        visits = min(visits, cells)
        a, b = nearest_cells(points, books, visits), nearest_cells(partner, books, visits)
        when = np.minimum(
            np.where(a == b[:, :1], np.arange(visits), visits).min(axis=1),
            np.where(b == a[:, :1], np.arange(visits), visits).min(axis=1),
        )
        if (when < visits).mean() >= recall or visits == cells:
            return int(np.sort(when)[math.ceil(recall * len(when)) - 1]) + 1
        visits *= 2


def unit_vectors(column: pa.ChunkedArray | pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimensions)


def usable(vector: str) -> Column:
    """Vectors that can be compared: not null, not empty, all components finite, not all zero."""
    v = F.col(vector)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & sound & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame,
    least: float = MIN_COSINE,
    sample_rows: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    recall: float = TARGET_RECALL,
    lot: int = LOT,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding).

    Each half of the vectors has a codebook; a vector lies in the cell of its two nearest words, and visits the
    cells nearest to it, in the order of distance, as many as find the share `recall` of pairs
    whose cosine is just `least`. Codebooks and that number are fitted on about `sample_rows`
    vectors; every vector is in the index and every vector visits. Each visitor is compared with all residents of
    its cells by cosine in double precision. A pair is linked if either finds the other.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing,
    nor do vectors of different lengths. component_id is the smallest vec_id that links lead
    to, its own included; kept says whether it is its own. Rows that share a vec_id count their links
    each for itself, and link with each other as any two vectors do, but are one in a component. Rows with a
    null vec_id come back with no links, and null kept. An empty table gives no rows. Other
    columns are not used.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")
    )
    comparable = usable("v") & F.col("vec_id").isNotNull()
    good = rows.where(comparable)
    alone = rows.where(~comparable).select("vec_id", F.lit(None).cast("long").alias("n_links"))
    lengths = [r[0] for r in good.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]
    ties = []
    for d in lengths:
        placed, found = _linked(good.where(F.size("v") == d), d, least, sample_rows, cell_rows, recall, lot)
        found = stored(found)
        counts = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("n_links"))
        counted = placed.join(counts, placed["row"] == counts["a"], "left").select("vec_id", "n_links")
        alone = alone.unionByName(counted)
        ties.append(found.where("n = 0").select("a", "b"))
    named = alone
    if ties:
        roots = components(reduce(DataFrame.unionByName, ties))
        named = alone.join(roots, alone["vec_id"] == roots["node"], "left")
    else:
        named = alone.withColumn("root", F.col("vec_id"))
    root = F.coalesce("root", "vec_id")
    return named.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
        (root == F.col("vec_id")).alias("kept"),
    )


def _linked(
    rows: DataFrame, dimensions: int, least: float, sample_rows: int, cell_rows: int, recall: float, lot: int
) -> tuple[DataFrame, DataFrame]:
    """The numbered vectors, and (a, b, n): if n > 0, row a has n links more; if n = 0, vec_ids a and b are connected."""
    spark = rows.sparkSession
    total = rows.count()
    sample_rows = min(sample_rows, max(1, SAMPLE_BYTES // (8 * dimensions)))
    # A draw on id and vector, which is the same in every run; its expected size is the bound. Repeated rows count once.
    draw = drawn_number("vectors", "vec_id", "v")
    drawn = rows.select("vec_id", "v", draw.alias("draw")).where(F.col("draw") < share(total, sample_rows))
    drawn = drawn.dropDuplicates(["vec_id", "v"]).orderBy("draw").limit(sample_rows).select("v").toArrow().column("v")
    rng = np.random.default_rng(SEED)
    if len(drawn):
        sample = drawn.combine_chunks().flatten().to_numpy().reshape(-1, dimensions)
        sample = _unit(sample)
    else:
        sample = rng.normal(size=(2, dimensions))
    sample = sample[rng.permutation(len(sample))]
    words = max(1, min(round(math.sqrt(total / cell_rows)), MOST_WORDS, len(sample)))
    half = dimensions // 2
    books = (_codebook(sample[:, :half], words, rng), _codebook(sample[:, half:], words, rng))
    visits = calibrate(sample, books, least, recall, rng)
    shared = spark.sparkContext.broadcast(books)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column("v").flatten().to_numpy().reshape(-1, dimensions)
            cells = nearest_cells(_unit(points), shared.value, visits)
            raw = [row.tobytes() for row in points]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(raw, pa.binary()), pa.array(list(cells), pa.list_(pa.int64()))],
                names=["vec_id", "v", "cells"],
            )

    # The row's number tells equal rows apart and deals a crowded cell's vectors out evenly.
    placed = rows.mapInArrow(place, "vec_id long, v binary, cells array<long>")
    placed = stored(placed.withColumn("row", F.monotonically_increasing_id()))
    own = F.element_at("cells", 1)
    residents = placed.groupBy(own.alias("cell")).agg(F.count(F.lit(1)).alias("residents"))
    visitors = placed.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("visitors"))
    # One row per cell: at most MOST_WORDS squared, whatever the number of vectors.
    crowds = stored(
        residents.join(visitors, "cell").select(
            "cell",
            F.ceil(F.col("residents") / lot).cast("int").alias("resident_lots"),
            F.ceil(F.col("visitors") / lot).cast("int").alias("visitor_lots"),
        )
    )
    number = F.xxhash64("row")
    staying = (
        placed.withColumn("cell", own).join(crowds, "cell")
        .withColumn("stay", F.pmod(number, F.col("resident_lots")).cast("int"))
        .withColumn("visit", F.explode(F.sequence(F.lit(0), F.col("visitor_lots") - 1)))
        .select("cell", "stay", "visit", F.lit(0).alias("visiting"), "row", "vec_id", "v", "cells")
    )
    coming = (
        placed.withColumn("home", own).withColumn("cell", F.explode("cells")).join(crowds, "cell")
        .withColumn("visit", F.pmod(number, F.col("visitor_lots")).cast("int"))
        .withColumn("stay", F.explode(F.sequence(F.lit(0), F.col("resident_lots") - 1)))
        .select("cell", "stay", "visit", F.lit(1).alias("visiting"), "row", "vec_id", "v", F.array("home").alias("cells"))
    )
    group = ["cell", "stay", "visit"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, group):
            found = [_compare(run, dimensions, least) for run in _cut(table, group)]
            a, b, n = (np.concatenate(c) if c else np.empty(0, np.int64) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (a, b, n)], names=["a", "b", "n"])

    found = (
        staying.unionByName(coming)
        .repartition(*[F.col(c) for c in group])
        .sortWithinPartitions(*group, "visiting")
        .mapInArrow(verify, "a long, b long, n long")
    )
    return placed, found


def _unit(points: np.ndarray) -> np.ndarray:
    largest = np.abs(points).max(axis=1, keepdims=True)
    points = points / largest
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def _cut(table: pa.Table, group: list[str]) -> Iterator[pa.Table]:
    begin = starts(table, group)
    for at, n in zip(begin, np.diff(begin, append=table.num_rows)):
        yield table.slice(int(at), int(n))


def _compare(run: pa.Table, dimensions: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the residents and the visitors of one tile.

    Where both find each other, each counts the link in its own visit; where only the visitor does, it
    counts it for both.
    """
    empty = np.empty(0, np.int64)
    visiting = run.column("visiting").to_numpy()
    split = int(np.searchsorted(visiting, 1))
    if not 0 < split < len(visiting):
        return empty, empty, empty
    points = _unit(unit_vectors(run.column("v"), dimensions))
    ids, row = run.column("vec_id").to_numpy(), run.column("row").to_numpy()
    near = points[split:] @ points[:split].T >= least
    near &= row[split:, None] != row[None, :split]
    if not near.any():
        return empty, empty, empty
    visitor, resident = np.nonzero(near)
    used = np.unique(resident)
    cells = run.column("cells")
    routes = np.array(cells.take(pa.array(used)).to_pylist())
    home = np.array(cells.slice(split).to_pylist())[:, 0]
    # Does the resident's own traversal come to the visitor's cell?
    same = {h: (routes == h).any(axis=1) for h in np.unique(home[np.unique(visitor)])}
    place = np.searchsorted(used, resident)
    mutual = np.empty(len(visitor), bool)
    for h, arrives in same.items():
        of = home[visitor] == h
        mutual[of] = arrives[place[of]]
    counted = np.concatenate([row[split:][visitor], row[:split][resident[~mutual]]])
    a, n = np.unique(counted, return_counts=True)
    tied_a, tied_b = _spanning(visitor, resident, ids[split:], ids[:split])
    return (
        np.concatenate([a, tied_a]),
        np.concatenate([a, tied_b]),
        np.concatenate([n, np.zeros(len(tied_a), np.int64)]),
    )


def _spanning(visitor: np.ndarray, resident: np.ndarray, visitor_ids: np.ndarray, resident_ids: np.ndarray):
    """As many ties as connect what the links connect: each vector with the least of its component."""
    nodes, numbers = np.unique(np.concatenate([visitor_ids[visitor], resident_ids[resident]]), return_inverse=True)
    a, b = numbers[: len(visitor)], numbers[len(visitor) :]
    roots = np.arange(len(nodes))
    while True:
        least = roots.copy()
        np.minimum.at(least, a, roots[b])
        np.minimum.at(least, b, roots[a])
        least = least[least]
        if (least == roots).all():
            break
        roots = least
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[moved], nodes[roots[moved]]
