"""Scoring documents by the difference of their cross-entropies under two n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapwise.llm.scratch import stored
from tapwise.llm.tokens import encoder

# Texts are encoded in slices of so many characters, and counted in parts of so many.
SLICE_CHARS = 3_000_000
PART_CHARS = 24_000_000
SIDES = ("background", "target")

# What a task makes of its texts: rows of bigrams (kind 0), and slices of tokens (kind 1).
_COUNTED = "part long, kind int, context int, last int, n long, docs array<long>, sizes array<int>, ids binary"
_SCORES = "doc_id long, n_tokens long, loss_target double, loss_background double"
# A part's losses are sent to it in so many rows.
LOSS_ROWS = 64


def vocabulary_size(path: str) -> int:
    """Of what may come next: every token, and a text's end, which is the number after the last token's."""
    return encoder(path).tokenizer.get_vocab_size(with_added_tokens=True) + 1


def _code_type(size: int):
    """The narrowest type that holds a bigram as one number."""
    return np.uint32 if size * (size + 1) <= 2**32 else np.int64


def _slices(
    batches: Iterator[pa.RecordBatch], path: str, size: int, part_chars: int
) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """Of some texts at once: their part, doc_ids, numbers of tokens with the end, and all tokens in turn.

    `part` is the task's partition in the upper half, and in the lower after how many characters it comes.
    """
    coding, slice_chars = encoder(path), min(SLICE_CHARS, part_chars)
    seen = 0
    for batch in batches:
        length = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(length)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + slice_chars, "right")))
            own = [np.frombuffer(ids, "<u4") for ids in coding.encode(batch.column("text").slice(at, end - at))]
            sizes = np.array([len(ids) + 1 for ids in own], np.int32)
            tokens = np.full(int(sizes.sum()), size - 1, _code_type(size))
            place = np.ones(len(tokens), bool)
            place[np.cumsum(sizes) - 1] = False
            tokens[place] = np.concatenate(own)
            part = int(batch.column("task")[0].as_py()) << 32 | seen // part_chars
            yield part, batch.column("doc_id").slice(at, end - at), sizes, tokens
            seen += int(ends[end - 1] - before)
            at = end


def _bigrams(sizes: np.ndarray, tokens: np.ndarray, size: int) -> np.ndarray:
    """Each token with the one before it, as one number; before a text's first stands `size`."""
    codes = np.empty_like(tokens)
    codes[1:] = tokens[:-1]
    codes[np.cumsum(sizes) - sizes] = size
    codes *= codes.dtype.type(size)
    codes += tokens
    return codes


class _Counts:
    """Sorted bigrams and how often each was added; new ones are merged in when they have become many."""

    def __init__(self, size: int):
        self.codes, self.n = np.empty(0, _code_type(size)), np.empty(0, np.int64)
        self.fresh: list[np.ndarray] = []
        self.waiting = 0

    def add(self, codes: np.ndarray) -> None:
        self.fresh.append(codes)
        self.waiting += len(codes)
        if self.waiting > 4_000_000:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        codes, n = np.unique(np.concatenate(self.fresh), return_counts=True)
        every = np.concatenate([self.codes, codes])
        order = np.argsort(every)
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        self.n = np.add.reduceat(np.concatenate([self.n, n])[order], first)
        self.codes = every[first]
        self.fresh, self.waiting = [], 0


def bigram_counts(texts: DataFrame, path: str, part_chars: int = PART_CHARS, keep: bool = False) -> DataFrame:
    """How often a token follows another in each part of `texts` (doc_id, text, task), as rows of kind 0 of _COUNTED; with
    `keep`, also the tokens themselves, as rows of kind 1.

    Counted over whole texts; a part is what one task reads, or some `part_chars` of it, and is added up there.
    """
    size = vocabulary_size(path)
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    names = [field.split()[0] for field in _COUNTED.split(", ")]

    def rows(*columns) -> pa.RecordBatch:
        n = len(columns[0])
        arrays = [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        now, counts = None, _Counts(size)

        def done() -> Iterator[pa.RecordBatch]:
            counts.merge()
            for at in range(0, len(counts.codes), 100_000):
                codes, n = counts.codes[at : at + 100_000], counts.n[at : at + 100_000]
                yield rows(np.full(len(n), now), np.zeros(len(n), np.int32), codes // size, codes % size, n, None, None, None)

        for part, docs, sizes, tokens in _slices(batches, path, size, part_chars):
            if part != now:
                yield from done()
                now, counts = part, _Counts(size)
            counts.add(_bigrams(sizes, tokens, size))
            if keep:
                ids = zstandard.ZstdCompressor(level=1).compress(tokens.astype("<u4").tobytes())
                yield rows([part], [1], None, None, None, [docs.to_pylist()], [sizes], [ids])
        yield from done()

    return texts.mapInArrow(count, _COUNTED)


def _chance(side: str, scale: float, total: Column, kinds: Column, lower: Column) -> Column:
    """Witten and Bell's: how often it was seen, and as many times as there were different ones the lower order's chance."""
    n = F.col(side) * F.lit(scale)
    return F.when(total > 0, (n + kinds * lower) / (total * F.lit(scale) + kinds)).otherwise(lower)


def bigram_losses(counts: DataFrame, size: int) -> DataFrame:
    """Minus the log chance of every bigram of `counts` (context, last, background, target) under either model.

    Each order is interpolated with the next lower one, the lowest with the uniform distribution over `size` tokens.
    Totals by token are at most `size` rows, whatever the corpus; they are what is broadcast.
    """
    sums = [F.sum(side).alias(f"{side}_total") for side in SIDES]
    kinds = [F.sum((F.col(side) > 0).cast("long")).alias(f"{side}_kinds") for side in SIDES]
    ones = stored(counts.groupBy("last").agg(*[F.sum(side).alias(side) for side in SIDES]))
    found = ones.agg(*[F.coalesce(s, F.lit(0)).alias(n) for s, n in zip((F.sum("background"), F.sum("target")), SIDES)], *kinds).first()
    # Without any target text both models are the background's.
    own = {side: side if found[side] else "background" for side in SIDES}
    least = min(found[own[side]] for side in SIDES)
    scale = {side: least / found[own[side]] if least else 1.0 for side in SIDES}
    for side in SIDES:
        whole, different = (F.lit(found[own[side]]), F.lit(found[f"{own[side]}_kinds"]))
        ones = ones.withColumn(f"{side}_lower", _chance(own[side], scale[side], whole, different, F.lit(1 / size)))
    ones = ones.select("last", *[f"{side}_lower" for side in SIDES])
    contexts = counts.groupBy("context").agg(*sums, *kinds)
    joined = counts.join(F.broadcast(contexts), "context").join(F.broadcast(ones), "last")
    losses = []
    for side in SIDES:
        total, different = F.col(f"{own[side]}_total"), F.col(f"{own[side]}_kinds")
        chance = _chance(own[side], scale[side], total, different, F.col(f"{side}_lower"))
        losses.append((-F.log(chance)).alias(f"loss_{side}"))
    return joined.select("context", "last", *losses)


def score(docs: DataFrame, target: DataFrame, path: str, part_chars: int = PART_CHARS) -> DataFrame:
    """Per document its loss under the target and the background model, for each of its tokens and its end.

    Tokens are ids by the vocabulary file at `path`, which both models share; the models are of bigrams. The background model
    is trained on all of `docs` (doc_id, text), the target model on all of `target` (text). They are matched: one vocabulary, one
    order, one smoothing, and the larger corpus's counts scaled to the mass of the smaller one, so that neither gains
    by its size. A document's loss is the sum over its tokens and its end, divided by `n_tokens`, their number.
    `score` is loss_target - loss_background: the mean of what each token loses by it; the lower, the more like the target.

    Texts are encoded and counted where they are read, part by part. Each different bigram of a part is a row:
    they are added up over all parts, its losses are looked up and sent to the part, and there the part's tokens, which are
    stored meanwhile, are streamed past them. No row is shuffled for each occurrence.

    A null or empty text has one token, its end. With no target texts both models are the same and every
    score is 0. Repeated rows are scored each; an empty table gives no rows. Other columns are not used. A single text
    is encoded whole, so one of very many millions of characters needs an executor that holds some ten times its size.
    """
    size = vocabulary_size(path)
    task = F.spark_partition_id().alias("task")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", task)
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), "text", task)
    counted = stored(bigram_counts(rows, path, part_chars, keep=True))
    parts, tokens = counted.where("kind = 0"), counted.where("kind = 1")
    none = F.lit(0).cast("long")
    both = parts.select("context", "last", F.col("n").alias("background"), none.alias("target")).unionAll(
        bigram_counts(wanted, path, part_chars).select("context", "last", none.alias("background"), F.col("n").alias("target"))
    )
    counts = stored(both.groupBy("context", "last").agg(*[F.sum(side).alias(side) for side in SIDES]))
    losses = parts.select("part", "context", "last").join(bigram_losses(counts, size).hint("merge"), ["context", "last"])
    # As few rows as will do: each costs something on its way to Python, however short it is.
    group = F.pmod(F.xxhash64("context", "last"), F.lit(LOSS_ROWS)).alias("group")
    own = F.collect_list(F.struct("context", "last", "loss_background", "loss_target")).alias("losses")
    losses = losses.groupBy("part", group).agg(own).select(
        "part", F.lit(0).alias("kind"), "losses", *_nulls("docs array<long>, sizes array<int>, ids binary")
    )
    texts = tokens.select(
        "part", F.lit(1).alias("kind"), F.lit(None).cast(losses.schema["losses"].dataType).alias("losses"), "docs", "sizes", "ids"
    )
    placed = losses.unionAll(texts).repartition("part").sortWithinPartitions("part", "kind")
    scored = placed.mapInArrow(_scorer(size), _SCORES)
    return scored.withColumn("score", F.col("loss_target") - F.col("loss_background"))


def _nulls(ddl: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (field.split() for field in ddl.split(", "))]


def _scorer(size: int):
    """Scores slices of tokens (kind 1) by the losses of their part (kind 0), which come first."""

    def score_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        now, lists, known = None, [], None
        for batch in batches:
            part, kind = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(part, prepend=part[:1] - 1) != 0) | (np.diff(kind, prepend=-1) != 0))
            for at, end in zip(edges, [*edges[1:], len(part)]):
                if part[at] != now:
                    now, lists, known = part[at], [], None
                run = batch.slice(at, end - at)
                if kind[at] == 0:
                    found = run.column("losses").flatten()
                    own = [found.field(c).to_numpy() for c in ("context", "last", "loss_target", "loss_background")]
                    codes = own[0].astype(np.int64) * size + own[1]
                    lists.append((codes.astype(_code_type(size)), own[2], own[3]))
                    continue
                if known is None:
                    known = [np.concatenate(c) for c in zip(*lists)]
                    order = np.argsort(known[0])
                    known, lists = [c[order] for c in known], []
                for docs, sizes, ids in zip(*(run.column(c).to_pylist() for c in ("docs", "sizes", "ids"))):
                    tokens = np.frombuffer(zstandard.ZstdDecompressor().decompress(ids), "<u4").astype(_code_type(size))
                    yield _slice_scores(docs, np.array(sizes, np.int64), tokens, known, size)

    return score_parts


def _slice_scores(docs: list, sizes: np.ndarray, tokens: np.ndarray, known: list[np.ndarray], size: int) -> pa.RecordBatch:
    place = np.searchsorted(known[0], _bigrams(sizes, tokens, size))
    begin = np.cumsum(sizes) - sizes
    target, background = (np.add.reduceat(losses[place], begin) / sizes for losses in known[1:])
    columns = [pa.array(docs, pa.int64()), pa.array(sizes), pa.array(target), pa.array(background)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "loss_target", "loss_background"])
