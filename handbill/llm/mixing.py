"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

A source's target is its weight's share of the budget, at most ``max_repeats`` times its size; what
is cut off is shared again by weight. Each source queues its documents in hashed order, and again
from the start while its target lasts. A copy's virtual finish time is its source's words up to its
end divided by the target, so every source is served in proportion to its target and reaches it at
time 1. Copies are put in one global order of finish times and the order is cut at the budget; the
copy that is being served at time 1 counts with the words it got.

All running sums are split: first over equal ranges of the hash (or of the finish time), then
within each range, so a source with a third of all rows is spread over as many tasks as its rows
need. The sums of ranges and the table of sources are the only global orders.

Null texts have size 0, a null source is a source of its own and comes last, null ids are
allowed, repeated rows are mixed one by one, an empty table gives an empty result, and other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, only, pieces, saved, unused

ROWS = 50_000


def targets(sized: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """One row per source: rank, source_size, budget, target."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(
            F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    order = Window.orderBy("ratio", "rank")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    filled = (
        ranked.withColumn("place", F.row_number().over(order))
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                    / (F.sum("weight").over(everything)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    )
    # sources are full in order of ratio; the first that the level does not fill sets the level
    level = F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.col("place")))
    return filled.withColumn("level", level.over(everything)).select(
        "source", "rank", "source_size", "budget",
        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _running(df: DataFrame, keys: list[str], part: str, order: list, size: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``size`` before each row within ``keys``, by ``part`` then ``order``."""
    sums = df.groupBy(*keys, part).agg(F.sum(size).alias("_held"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, part, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys, part).orderBy(*order)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_at", F.row_number().over(within))
        .withColumn("_own", F.coalesce(F.sum(size).over(earlier), F.lit(0)))
        .join(bases, [*keys, part])
        .withColumn(out, F.col("_base") + F.col("_own")).drop("_base", "_own")
    )


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3,
        seed: str = "mix", rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, position.

    ``taken``: words the mix takes, repeats counted; ``position``: words of the mix before the
    document's first copy (NULL if it is not taken).
    """
    sized = saved(only(docs, "doc_id", "source", "text").select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    ), "mix-sizes")
    parts = pieces(sized.count(), rows)
    plan = targets(sized, weights, max_repeats).withColumnRenamed("source", "_source")
    queued = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))))
        .withColumn("part", F.expr(
            f"shiftright(cast(conv(substr(draw, 1, 8), 16, 10) as bigint) * {parts}, 32)"))
    )
    queued = saved(_running(queued, ["rank"], "part", ["draw", "doc_id", "size"], "size", "ahead")
                   .withColumnRenamed("_at", "at").drop("draw"), "mix-queue")
    goal = F.floor(F.col("target"))
    copies = (
        queued.withColumn("turn", F.explode(F.expr(f"sequence(0, {max_repeats - 1})")))
        .withColumn("start", F.col("turn") * F.col("source_size") + F.col("ahead"))
        .where(F.col("start") < goal)
        .withColumn("finish", (F.col("start") + F.col("size")) / F.col("target"))
        .withColumn("words", F.least(F.col("size"), goal - F.col("start")))
        .withColumn("range", F.least(F.floor(F.col("finish") * parts), F.lit(parts)))
    )
    ordered = _running(copies, [], "range", ["finish", "rank", "turn", "part", "at"], "words", "position")
    got = (
        ordered.withColumn("words", F.greatest(
            F.lit(0), F.least(F.col("words"), F.col("budget") - F.col("position"))))
        .groupBy("rank", "part", "at")
        .agg(F.sum("words").alias("taken"), F.min("position").alias("position"))
    )
    return queued.join(got, ["rank", "part", "at"], "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"), "position")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, once per copy taken; a copy taken in part has its first words.

    Documents without words are not in a mix. All columns come back, ``text`` and ``n_chars`` as the words taken.
    Rows alike in id, source and size get what the mix takes of them in any order: such rows are numbered, by
    salted ranges, only where it does not take alike of all of them.
    """
    doc_id, source, size, taken, low, high, nth, turn = unused(
        docs, "_id", "_from", "_size", "_taken", "_low", "_high", "_nth", "_turn")
    key = Window.partitionBy("doc_id", "source", "size")
    got = mix(docs, **options).groupBy("doc_id", "source", "size", "taken").agg(F.count("*").alias("n"))
    got = saved(
        got.withColumn("high", F.sum("n").over(key.orderBy(F.desc("taken"))))
        .withColumn("values", F.count("*").over(key))
        .select(F.col("doc_id").alias(doc_id), F.col("source").alias(source), F.col("size").alias(size),
                F.col("taken").alias(taken), (F.col("high") - F.col("n")).alias(low), F.col("high").alias(high),
                "values"), "mix-taken")

    def alike(right: DataFrame):
        same = zip(("doc_id", "source"), (doc_id, source))
        words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
        return [docs[a].eqNullSafe(right[b]) for a, b in same] + [words == right[size]]

    even = got.where((F.col("values") == 1) & (F.col(taken) > 0)).drop("values", low, high)
    rows = docs.join(even, alike(even))
    uneven = got.where("values > 1").drop("values")
    if not uneven.isEmpty():
        groups = uneven.select(doc_id, source, size).distinct()
        place, part, one, group = unused(docs, "_place", "_part", "_one", "_group")
        numbered = saved(docs.join(groups, alike(groups)).withColumn(place, F.monotonically_increasing_id())
                         .withColumn(group, F.to_json(F.struct(doc_id, source, size)))
                         .withColumn(part, F.col(place) % 64).withColumn(one, F.lit(1)), "mix-alike")
        numbered = _running(numbered.withColumnsRenamed({c: f"x{c}" for c in docs.columns}),
                            [group], part, [place], one, nth).drop("_at", place, part, one, group)
        numbered = numbered.withColumnsRenamed({doc_id: f"y{doc_id}", source: f"y{source}", size: f"y{size}"})
        numbered = numbered.join(uneven, [
            F.col(f"y{doc_id}").eqNullSafe(uneven[doc_id]), F.col(f"y{source}").eqNullSafe(uneven[source]),
            F.col(f"y{size}") == uneven[size], F.col(nth) >= uneven[low], F.col(nth) < uneven[high]])
        numbered = numbered.where(F.col(taken) > 0).select(
            *(F.col(f"`x{c}`").alias(c) for c in docs.columns), doc_id, source, size, taken)
        rows = rows.union(numbered)
    rows = rows.withColumn(turn, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({taken} - 1) DIV {size}"))))
    rest = F.col(taken) - F.col(turn) * F.col(size)
    cut = F.array_join(F.slice(
        F.regexp_extract_all("text", F.lit(f"({WORD})")), F.lit(1), rest.cast("int")), " ")
    whole = rest >= F.col(size)
    new = {"text": F.when(whole, F.col("text")).otherwise(cut)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("n_chars")).otherwise(
            F.length(cut).cast(docs.schema["n_chars"].dataType))
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))
