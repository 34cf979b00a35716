"""Exact top-k inner products by sorted lists, without random access."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapwise.llm.runs import starts, whole_runs
from tapwise.llm.scratch import stored

K = 20
SCALE = 64
# Candidates of a block of sorted lists, and queries that read them together.
LIST_ROWS = 8192
QUERY_ROWS = 2048
# After these shares of the lists have been read, it is looked at who can still qualify.
DEPTHS = (1 / 32, 1 / 8, 1 / 2, 3 / 4, 7 / 8, 15 / 16, 1)
QUERY_LOT = 256
PAIRS_AT_ONCE = 1 << 20


def sound(vector: str) -> Column:
    """Neither null nor empty, and without null or non-finite components."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def _exact_type(most: float):
    """The plainest type in which sums of products up to `most` are exact."""
    if most < 2**24:
        return np.float32
    return np.float64 if most < 2**53 else object


class SortedLists:
    """One list of all candidates for each component, in the order of its value."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        # Ties in score go to the smaller id, that is to the earlier row.
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, axis=0)


class Reading:
    """What some queries know of all candidates' scores after reading every list down to `depth`.

    A query reads a list from the end where its own component has the greatest product: from the top for a positive
    one, from the bottom for a negative one. `seen` sums up, by query and candidate, the products
    of the entries that were read; of no other entry is anything used. What was not read lies beyond the frontier, the
    entries read last: at best it is the frontier's value, at worst the one at the list's other end.
    `entries` counts the entries read.
    """

    def __init__(self, queries: np.ndarray, lists: SortedLists):
        self.lists, self.depth, self.entries = lists, 0, 0
        n, d = lists.values.shape
        # A query has two components for each list, one for its top and one for its bottom.
        self.queries = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
        self.seen = np.zeros((len(queries), n), queries.dtype)
        self.unseen = np.ones((2 * d, n), queries.dtype)

    def keep(self, some: np.ndarray) -> None:
        """Goes on with some of the queries."""
        self.queries, self.seen = self.queries[some], self.seen[some]

    def read_to(self, depth: int) -> None:
        """The next entries of each list, by all queries that read it from that end."""
        lists, n = self.lists, len(self.lists.ids)
        d = lists.values.shape[1]
        fresh = np.zeros_like(self.unseen)
        for j in range(d):
            for part, at in ((lists.order[n - depth : n - self.depth, j], j), (lists.order[self.depth : depth, j], d + j)):
                fresh[at, part] = lists.values[part, j]
                self.unseen[at, part] = 0
        self.seen += self.queries @ fresh
        self.entries += (depth - self.depth) * int(np.count_nonzero(self.queries))
        self.depth = depth

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores, by query and candidate."""
        ordered, n = self.lists.sorted, len(self.lists.ids)
        best = self.queries * np.concatenate([ordered[n - self.depth], ordered[self.depth - 1]])
        worst = self.queries * np.concatenate([ordered[0], ordered[-1]])
        return self.seen + worst @ self.unseen, self.seen + best @ self.unseen


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row."""
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def qualified(query_ids: np.ndarray, queries: np.ndarray, lists: SortedLists, k: int) -> tuple[np.ndarray, int]:
    """By query and candidate, who can be among a query's best k; and how many list entries were read for that.

    The bar of a query is a score that k candidates are known to reach. A candidate whose upper bound is below it
    cannot qualify. A query reads on until none but k candidates can, or all that do are known to tie.
    """
    n = len(lists.ids)
    own = query_ids[:, None] == lists.ids[None, :]
    alive = ~own
    if n <= k or queries.dtype == object:
        return alive, 0
    reading, active = Reading(queries, lists), np.arange(len(queries))
    for share in DEPTHS:
        reading.read_to(max(reading.depth, 1, int(share * n)))
        lower, upper = reading.bounds()
        lower[own[active]] = -np.inf
        bar = _kth(lower, k)[:, None]
        can = alive[active] & (upper >= bar)
        alive[active] = can
        more = can.sum(axis=1) > np.maximum(k, (can & (lower >= bar)).sum(axis=1))
        if not more.any():
            break
        active = active[more]
        reading.keep(more)
    return alive, reading.entries


def search(
    query_ids: np.ndarray, queries: np.ndarray, lists: SortedLists, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, candidate id, score) of every query's best k of these lists, best first.

    Those who can qualify when reading stops get their final scores, and are ranked by them.
    """
    alive, _ = qualified(query_ids, queries, lists, k)
    query, candidate = np.nonzero(alive)
    scores = np.empty(len(query), queries.dtype)
    for at in range(0, len(query), PAIRS_AT_ONCE):
        part = slice(at, at + PAIRS_AT_ONCE)
        scores[part] = (queries[query[part]] * lists.values[candidate[part]]).sum(axis=1)
    # Of a query's survivors, the best k by score, then by id.
    if scores.dtype == object:
        scores = np.array([min(max(int(s), -(2**63)), 2**63 - 1) for s in scores], object)
        order = np.array(sorted(range(len(query)), key=lambda i: (query[i], -scores[i], candidate[i])), np.int64)
    else:
        order = np.lexsort((candidate, -scores, query))
    query, candidate, scores = query[order], candidate[order], scores[order]
    first = np.searchsorted(query, query)
    kept = np.arange(len(query)) - first < k
    query, candidate, scores = query[kept], candidate[kept], scores[kept]
    return query, lists.ids[candidate], scores


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = K,
    list_rows: int = LIST_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's best `k` candidates other than itself.

    Both tables are (vec_id, v: array of whole numbers); the score is the inner product, ties go to the smaller
    vec_id. Candidates are dealt into blocks of about `list_rows`, queries into blocks of about
    `query_rows`, and every block of queries meets every block of candidates once. There,
    each component's values are a sorted list, read in turn from its better end, with lower and upper bounds of
    every score by what was read. A query stops reading when no other candidate can qualify; those who can are
    scored. The best of each meeting are then ranked together.

    Rows with a null vec_id or null v, and candidates of another length than the query, take no part;
    a query with fewer candidates gets all of them; of rows that share a vec_id each is a candidate, ties
    between them fall either way, and none is one of a query of that vec_id, whose rows are one query, the
    least; empty tables give no rows. Scores beyond the range of a long count as its end. Other
    columns are not used.
    """
    queries = queries.where("vec_id is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    candidates = candidates.where("vec_id is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    size = F.size("v").alias("d")
    queries, candidates = stored(queries.select("vec_id", "v", size)), stored(candidates.select("vec_id", "v", size))
    asked, listed = queries.count(), candidates.count()
    query_blocks, list_blocks = max(1, -(-asked // query_rows)), max(1, -(-listed // list_rows))

    def deal(rows: DataFrame, blocks: int, others: int, name: str, other: str, kind: int) -> DataFrame:
        number = F.xxhash64(F.monotonically_increasing_id(), "vec_id")
        return (
            rows.withColumn(name, F.pmod(number, F.lit(blocks)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
            .select("d", "lists", "asks", F.lit(kind).alias("kind"), "vec_id", "v")
        )

    dealt = deal(candidates, list_blocks, query_blocks, "lists", "asks", 0).unionByName(
        deal(queries, query_blocks, list_blocks, "asks", "lists", 1)
    )
    group = ["d", "lists", "asks"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, group):
            begin = starts(table, group)
            for at, n in zip(begin, np.diff(begin, append=table.num_rows)):
                yield from _meeting(table.slice(int(at), int(n)), k)

    met = (
        dealt.repartition(*[F.col(c) for c in group])
        .sortWithinPartitions(*group, "kind")
        .mapInArrow(meet, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _meeting(run: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    kind, ids = run.column("kind").to_numpy(), run.column("vec_id").to_numpy()
    split = int(np.searchsorted(kind, 1))
    if not 0 < split < len(kind):
        return
    dimensions = run.column("d")[0].as_py()
    values = run.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    largest = [max(abs(int(part.max())), abs(int(part.min()))) for part in (values[:split], values[split:])]
    kind_of = _exact_type(max(1, largest[0]) * max(1, largest[1]) * dimensions)
    values = values.astype(kind_of)
    lists = SortedLists(ids[:split], values[:split])
    for at in range(split, len(ids), QUERY_LOT):
        asked = ids[at : at + QUERY_LOT]
        query, found, scores = search(asked, values[at : at + QUERY_LOT], lists, k)
        columns = [asked[query], found, np.array(scores, np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])
