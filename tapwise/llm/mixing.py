"""Mixing sources to target weights, by highest quotients over equal blocks of words.

DataFrame functions only. Of all documents only sizes are ever dealt out; what is planned per
source or per shard is planned on one row per source or shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapwise.llm.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 16
# A source of n words has about sqrt(n / SHARD_SCALE) shards of about sqrt(n * SHARD_SCALE) words:
# at any size neither the shards of a source nor the documents of a shard are too many for a task.
SHARD_SCALE = 4096
SEED = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column | str | int) -> Column:
    """A number below 2**60 drawn from `parts`, the same in every run and engine."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *texts)), 1, 15), 16, 10).cast("long")


def apportion(rows: DataFrame, within: list[str], votes: str, seats: str, order: list[str]) -> DataFrame:
    """`rows` with `quota`: the integer share of `seats` that the highest quotients give each row.

    Sainte-Laguë: a row's quotients are votes / 1, votes / 3, votes / 5, ...; of all rows of a group
    `within`, the `seats` highest quotients win one seat each; ties go by `order`. A row's quota
    is never further than half the rows of its group (times its share) from its exact share, so
    quotients below that range have won for certain, those above have lost, and only those
    between are ranked: some four for each row, however many seats there are. Groups without
    votes get none.
    """
    group = Window.partitionBy(*within)
    drift = F.when(F.col("_all") > 0, F.col(votes) / F.col("_all") * F.col("_n") / 2).otherwise(0.0) + 1
    rows = (
        rows.withColumn("_all", F.sum(votes).over(group))
        .withColumn("_n", F.count(F.lit(1)).over(group))
        .withColumn("_exact", F.when(F.col("_all") > 0, F.col(seats) * (F.col(votes) / F.col("_all"))).otherwise(0.0))
        .withColumn("_sure", F.greatest(F.floor(F.col("_exact") - drift), F.lit(0)).cast("long"))
        .withColumn("_most", F.when(F.col(votes) > 0, F.ceil(F.col("_exact") + drift)).otherwise(F.col("_sure")).cast("long"))
        .withColumn("_open", F.col(seats) - F.sum("_sure").over(group))
    )
    key = [*within, *[c for c in order if c not in within]]
    quotients = rows.where("_most > _sure").select(
        *key, votes, "_open", F.explode(F.sequence("_sure", F.col("_most") - 1)).alias("_j")
    )
    ranked = quotients.withColumn(
        "_rank",
        F.row_number().over(
            group.orderBy((F.col(votes) / (2 * F.col("_j") + 1)).desc(), *[F.col(c) for c in order], "_j")
        ),
    )
    won = ranked.where(F.col("_rank") <= F.col("_open")).groupBy(*key).agg(F.count(F.lit(1)).alias("_won"))
    return (
        rows.join(won, key, "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_all", "_n", "_exact", "_sure", "_most", "_open", "_won")
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: its `rank` by code point (null last), `source_size` and `target`.

    All words are shared by weight. A source whose share is above `most` times its size stops
    there; the rest is shared by weight among the others. Sources stop in the order of size per
    weight, so the level at which the rest is shared follows from running sums in that order.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1)
    full = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    cap = F.col("source_size") * most
    return (
        sources.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight.cast("long"))
        .withColumn("_total", F.sum("source_size").over(everything))
        .withColumn("_before", F.sum(cap).over(full.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_before", F.coalesce("_before", F.lit(0)))
        .withColumn("_rest", F.sum("weight").over(full.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        # The level if this source and all later ones stay below their stop.
        .withColumn("_stops", (F.col("_total") - F.col("_before")).cast("double") * F.col("weight") >= cap * F.col("_rest").cast("double"))
        .withColumn("_level", F.struct((F.col("_total") - F.col("_before")).alias("words"), F.col("_rest").alias("weights")))
        .withColumn("_level", F.first(F.when(~F.col("_stops"), F.col("_level")), ignorenulls=True).over(
            full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn(
            "target",
            F.when(F.col("_stops"), cap.cast("double")).otherwise(
                F.col("weight") * F.col("_level.words") / F.col("_level.weights").cast("double")
            ),
        )
        .select("source", "rank", "source_size", "target", "_total")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_scale: int = SHARD_SCALE,
    seed: int = SEED,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """What a mix of `docs` (doc_id, text, source) takes of each document.

    Sources get blocks of `block_words` words by the highest quotients of their targets; the
    blocks of a source go to its shards by the highest quotients of the shards' sizes. A shard is
    a ring of its documents' words in seeded order; from a seeded block on, it gives as many
    consecutive blocks as its quota says, going round again where the quota is above its size, but
    never more than `most_repeats` times.

    Documents are dealt to shards by doc_id and text, so those that share a doc_id, or have none, are spread
    as others are; only rows that are equal in both lie together, one after another in any order.

    Returns one row per document, repeated rows included: doc_id, source, size, source_size, target, shard,
    taken (words), and where they lie: every word `repeats` times, and once more those `i` with
    (`at` + i) mod `ring` < `run`. A null or empty text has size 0 and takes nothing; a null
    source is a source of its own, the last; an empty table gives no rows. Other columns are
    left out, but for those named in `carry`, which must not bear the names above.
    """
    text = F.md5(F.coalesce("text", F.lit(""))).alias("_text_md5")
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text))
    targets = stored(source_targets(sizes, weights, most_repeats).withColumn(
        "shards", F.greatest(F.ceil(F.sqrt(F.col("source_size") / shard_scale)), F.lit(1)).cast("long")
    ))
    blocks = F.call_function("div", 2 * F.col("_total") + block_words, F.lit(2 * block_words))
    seats = apportion(targets.withColumn("_one", F.lit(1)).withColumn("_blocks", blocks), ["_one"], "target", "_blocks", ["rank"])
    seats = seats.withColumnRenamed("quota", "blocks").select("source", "rank", "source_size", "target", "shards", "blocks")

    known = targets.select(F.col("source").alias("_source"), "rank", "source_size", "target", "shards")
    if carry:
        rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), text, *carry)
    else:
        rows = sizes
    dealt = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    dealt = dealt.withColumn("shard", F.pmod(draw(seed, F.col("doc_id"), F.col("_text_md5")), F.col("shards")))

    shards = dealt.groupBy("rank", "shard").agg(F.sum("size").alias("ring"))
    shards = shards.join(seats.select("rank", "blocks"), "rank")
    quotas = apportion(shards, ["rank"], "ring", "blocks", ["shard"])
    words = F.least(F.col("quota") * block_words, F.col("ring") * most_repeats)
    starts = F.greatest(F.ceil(F.col("ring") / block_words), F.lit(1)).cast("long")
    quotas = (
        quotas.withColumn("words", words)
        .withColumn("repeats", F.expr("case when ring > 0 then words div ring else 0 end"))
        .withColumn("run", F.col("words") - F.col("repeats") * F.col("ring"))
        .withColumn("first", F.pmod(draw(seed, F.col("rank"), F.col("shard")), starts) * block_words)
        .select("rank", "shard", "ring", "repeats", "run", "first")
    )

    order = Window.partitionBy("rank", "shard").orderBy(
        draw(seed + 1, F.col("doc_id"), F.col("_text_md5")), "doc_id", "_text_md5"
    )
    placed = dealt.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(quotas, ["rank", "shard"])

    def covered(end: Column) -> Column:
        """Words of the run that lie before `end` on the ring."""
        ahead = F.least(F.greatest(end - F.col("first"), F.lit(0)), F.col("run"))
        round_again = F.greatest(F.col("first") + F.col("run") - F.col("ring"), F.lit(0))
        return ahead + F.least(end, round_again)

    start = F.col("_end") - F.col("size")
    return (
        placed.withColumn("partly", covered(F.col("_end")) - covered(start))
        .withColumn("taken", F.col("repeats") * F.col("size") + F.col("partly"))
        .withColumn("at", F.when(F.col("ring") > 0, F.pmod(start - F.col("first"), F.col("ring"))).otherwise(0))
        .select("doc_id", "source", "size", "source_size", "target", "rank", "shard", "taken",
                "repeats", "partly", "at", "ring", "run", *carry)
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the documents `mix` takes, with the columns of `docs`.

    A document comes once for each time all of its words are taken, and once more cut to the
    words of its last, partial turn (two documents of a shard at most). Its `n_chars`, if there is
    such a column, is that of the text it has then. Documents without words are not taken.
    """
    names = docs.columns
    # Names of its own, so that columns of `docs` that mix() would also make can't clash.
    inner = {name: f"_doc_{i}" for i, name in enumerate(names)}
    carried = docs.select(
        "doc_id", "text", "source", *[F.col(f"`{name}`").alias(new) for name, new in inner.items()]
    )
    taken = mix(carried, carry=tuple(inner.values()), **options).where("taken > 0")
    copies = F.col("repeats") + F.when(F.col("partly") > 0, 1).otherwise(0)
    taken = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    text = F.col(inner["text"])
    cut = F.array_join(
        F.filter(
            F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)),
            lambda _, i: F.pmod(F.col("at") + i, F.col("ring")) < F.col("run"),
        ),
        "",
    )
    is_cut = (F.col("_copy") > F.col("repeats")) & (F.col("partly") < F.col("size"))
    taken = taken.withColumn("_text", F.when(is_cut, cut).otherwise(text))
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return taken.select(
        *[
            changed[name].alias(name) if name in changed else F.col(new).alias(name)
            for name, new in inner.items()
        ]
    )
