"""Mixing sources to target weights by Sainte-Laguë apportionment.

Every source gets a target number of words: its weight's share of the whole mix, but no more
than ``max_repeats`` times what it has; what is cut off is shared again among the others.
Blocks of ``block_words`` words are then apportioned twice by highest quotients, first to
sources by their targets and then, within a source, to its shards by what they hold.  A shard
takes whole passes over its documents and fills the rest of its quota with blocks in the order
of a seeded hash, the last one cut where the quota ends.

All of it is DataFrame expressions.  The text is scanned once, for its words; everything else
works on one small row per document and, in the last step, per block.  Sources are split into
shards of bounded size, so one source with a third of all rows is many small sorts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cubeloom.llm.common import SPACE_CLASS, WORD, text_of
from cubeloom.session import materialize


@dataclass(frozen=True)
class MixPlan:
    """Weights go round the sources in code-point order, null last."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    total_share: float = 1.5  # words of the mix, as a share of all words
    max_repeats: int = 2
    block_words: int = 64
    shard_words: int = 2_000_000
    seed: int = 20_240_229


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, plan: MixPlan = MixPlan()) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    The share that is cut off at the cap goes to the sources below theirs by weight until no
    source is above: with sources in the order of cap / weight, those before some place are at
    their cap and the others share the rest evenly.  One row per source; the windows run over
    these few rows and no documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(by_name) - 1) % len(plan.weights)
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    ranked = sizes.withColumn("weight", F.get(weights, place)).withColumn(
        "cap", F.col("source_size") * F.lit(float(plan.max_repeats))
    )
    # ties in the ratio do not matter: both are then above or both below
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = ranked.withColumn(
        "level",
        (
            F.sum("source_size").over(everything) * plan.total_share
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
        )
        / F.sum("weight").over(onward),
    ).withColumn("below", F.col("level") * F.col("weight") <= F.col("cap"))
    # the first source below its cap has the level; later ones would only cut off more
    water = F.max(F.when(F.col("below"), F.col("level"))).over(everything)
    return level.withColumn("water", water).select(
        "source",
        "source_size",
        "weight",
        F.when(F.col("water").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("water") * F.col("weight")))
        .alias("target"),
    )


def sainte_lague(
    claims: DataFrame, group: list[str], weight: str, seats: str, order: list[Column]
) -> DataFrame:
    """``claims`` with ``quota``: the group's seats by the highest quotients weight / (2k + 1).

    A divisor method hands out seats in the order of the quotients.  So everyone first gets
    what the method gives at a divisor too large for all seats, and only the few quotients
    between that and a divisor too small are ranked: about three for each claim.
    """
    whole = Window.partitionBy(*group)
    n = F.count(F.lit(1)).over(whole)
    share = F.col(weight) / F.nullif(F.sum(weight).over(whole), F.lit(0.0))

    def at(total: Column) -> Column:
        return F.floor(share * F.greatest(total, F.lit(0)) + 0.5).cast("long")

    bounds = claims.withColumns(
        {
            "_low": F.coalesce(at(F.col(seats) - n), F.lit(0)).cast("long"),
            "_high": F.coalesce(at(F.col(seats) + n), F.lit(0)).cast("long"),
            "_claim": F.row_number().over(whole.orderBy(*order)),
        }
    ).withColumn("_open", F.col(seats) - F.sum("_low").over(whole))
    seat = F.explode(
        F.when(
            F.col("_high") > F.col("_low"), F.sequence(F.col("_low"), F.col("_high") - 1)
        ).otherwise(F.array().cast(T.ArrayType(T.LongType())))
    )
    quotients = bounds.where((F.col("_open") > 0) & (F.col(weight) > 0)).select(
        *group, "_claim", "_open", weight, seat.alias("_seat")
    )
    best = whole.orderBy((F.col(weight) / (2 * F.col("_seat") + 1)).desc(), "_claim", "_seat")
    won = (
        quotients.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") <= F.col("_open"))
        .groupBy(*group, "_claim")
        .agg(F.count(F.lit(1)).alias("_more"))
    )
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*group, "_claim")]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return bounds.alias("b").join(won.alias("w"), condition, "left").select(
        *[F.col(f"b.{c}").alias(c) for c in claims.columns],
        (F.col("b._low") + F.coalesce(F.col("w._more"), F.lit(0))).alias("quota"),
    )


def mix(
    docs: DataFrame,
    plan: MixPlan = MixPlan(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, passes, blocks.

    ``passes`` counts the whole passes over the document, ``blocks`` lists (block number,
    words taken from its start) of the last, partial pass; ``taken`` is the number of words in
    all.  A document without words has no blocks and is taken 0 times; a null source is a
    source of its own and comes last; rows that repeat a doc_id each count.  An empty table
    gives an empty result.  The same rows always give the same mix.
    """
    source = F.col(source_col).cast("string")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        source.alias("source"),
        word_count(text_of(text_col)).alias("size"),
        *([] if row_col is None else [F.col(row_col).alias("row")]),
    )
    # the number of a row only tells rows apart that repeat a doc_id; the order of blocks
    # comes from the seeded hash and, for such rows, from their (equal) contents
    if row_col is None:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    sized = materialize(rows, "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    targets = source_targets(totals, plan)
    blocks = F.round(F.sum("target").over(Window.partitionBy("_all")) / plan.block_words)
    quotas = sainte_lague(
        targets.withColumn("_all", F.lit(0)).withColumn("_seats", blocks.cast("long")),
        ["_all"],
        "target",
        "_seats",
        [F.col("source").isNull(), F.col("source")],
    ).select("source", "source_size", "target", F.col("quota").alias("source_quota"))
    quotas = materialize(
        quotas.withColumn(
            "shards", F.ceil(F.col("source_size") / plan.shard_words).cast("long")
        ),
        "mix-quotas",
    )
    shard = F.pmod(F.xxhash64("doc_id", "size", F.lit(plan.seed)), F.greatest("q.shards", F.lit(1)))
    placed = (
        sized.alias("d")
        .join(F.broadcast(quotas).alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")))
        if _few(quotas)
        else sized.alias("d").join(
            quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source"))
        )
    ).select("row", "doc_id", "d.source", "size", "source_size", "target", "source_quota", shard.alias("shard"))
    shards = placed.groupBy("source", "shard").agg(
        F.sum("size").cast("double").alias("shard_size"), F.first("source_quota").alias("source_quota")
    )
    filled = sainte_lague(shards, ["source"], "shard_size", "source_quota", [F.col("shard")])
    words = F.col("quota") * F.lit(plan.block_words)
    passes = F.least(
        F.lit(plan.max_repeats), F.floor(words / F.nullif(F.col("shard_size"), F.lit(0.0)))
    ).cast("int")
    filled = filled.select(
        "source",
        "shard",
        F.coalesce(passes, F.lit(0)).alias("passes"),
        F.when(
            F.coalesce(passes, F.lit(0)) < plan.max_repeats,
            words - F.coalesce(passes, F.lit(0)) * F.col("shard_size"),
        )
        .otherwise(F.lit(0.0))
        .cast("long")
        .alias("rest"),
    )
    filled = materialize(filled, "mix-shards")
    known = placed.alias("p").join(
        filled.alias("f"),
        F.col("p.source").eqNullSafe(F.col("f.source")) & (F.col("p.shard") == F.col("f.shard")),
    ).select("p.*", "passes", "rest")
    number = F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / plan.block_words))
    )
    pieces = known.where("size > 0 AND rest > 0").select(
        "row",
        "doc_id",
        "source",
        "shard",
        "rest",
        "size",
        number.alias("block"),
    )
    pieces = pieces.withColumn(
        "words",
        F.least(F.lit(plan.block_words), F.col("size") - F.col("block") * plan.block_words),
    )
    seeded = Window.partitionBy("source", "shard").orderBy(
        F.xxhash64("doc_id", "size", "block", F.lit(plan.seed)), "doc_id", "size", "block", "row"
    )
    before = F.coalesce(
        F.sum("words").over(seeded.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    chosen = (
        pieces.withColumn("part", F.least(F.col("words"), F.col("rest") - before))
        .where("part > 0")
        .groupBy("row")
        .agg(
            F.sum("part").alias("part"),
            F.array_sort(F.collect_list(F.struct("block", F.col("part").alias("words")))).alias(
                "blocks"
            ),
        )
    )
    return known.join(chosen, "row", "left").select(
        "doc_id",
        "source",
        "size",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        (F.col("passes") * F.col("size") + F.coalesce("part", F.lit(0))).cast("long").alias("taken"),
        "passes",
        F.coalesce(
            "blocks", F.array().cast("array<struct<block: bigint, words: bigint>>")
        ).alias("blocks"),
        "row",
    )


MAX_BROADCAST_SOURCES = 10_000


def _few(quotas: DataFrame) -> bool:
    """One row per source; a broadcast is proven small by counting them."""
    return quotas.count() <= MAX_BROADCAST_SOURCES


def mixed_texts(
    docs: DataFrame,
    plan: MixPlan = MixPlan(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``docs`` as the mix has them: a row for each whole pass, one for the partial pass.

    The partial pass holds the taken blocks in the order of the text as they stand there: a word
    keeps the white space after it, the first word also that before it, so a text of which all
    blocks are taken is unchanged.  A document that the mix does not take has no row.
    """
    # written with its row numbers: a document of the mix is found by its number
    frozen = materialize(docs.withColumn("__mix_row", F.monotonically_increasing_id()), "mix-docs")
    taken = mix(frozen, plan, id_col, text_col, source_col, "__mix_row").select(
        F.col("row").alias("__mix_row"),
        F.col("passes").alias("__mix_passes"),
        F.col("blocks").alias("__mix_blocks"),
    )
    joined = frozen.join(taken, "__mix_row")
    spaced = rf"((?:\A[{SPACE_CLASS}]+)?{WORD}[{SPACE_CLASS}]*)"
    words = F.regexp_extract_all(text_of(text_col), F.lit(spaced), 1)

    def cut(all_words: Column) -> Column:
        return F.concat_ws(
            "",
            F.flatten(
                F.transform(
                    "__mix_blocks",
                    lambda b: F.slice(
                        all_words,
                        (b["block"] * plan.block_words + 1).cast("int"),
                        b["words"].cast("int"),
                    ),
                )
            ),
        )

    # through a lambda of its own the words are found once, not once per block
    partial = F.transform(F.array(words), cut)
    texts = F.concat(
        F.array_repeat(text_of(text_col), F.col("__mix_passes")),
        F.when(F.size("__mix_blocks") > 0, partial).otherwise(
            F.array().cast("array<string>")
        ),
    )
    out = joined.withColumn("__mix_text", F.explode(texts))
    return out.select(
        *[F.col("__mix_text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    )
