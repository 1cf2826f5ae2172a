"""Events with similar titles on one day at one place: an exact set-similarity join, then one event per group.

Titles are sets of folded words; two are similar if their Jaccard similarity reaches the threshold. Only titles of
one block (day and place, as in the dedup key) are compared.

- Equal sets of a block are one class, found by an aggregation with map-side partials.
- A set's words are put in order of frequency, rarest first. Sets that are similar share a word among the first
  few of each (the prefix); rarest words make small groups. Groups too large to compare are split by the next
  common words, as many as similar sets must share, with prefixes longer by one each time: no pair is lost.
- A group of more than a few is first compared with its smallest set of each length. Sets known to be connected, here
  or through another group, need no comparison with each other: the members outside the largest connected part are
  compared with the rest of the group, and the exact test is part of the join, so no row stands for a pair that is
  not similar. Groups are split by the comparisons that are left to do (over ``capacity`` a member), and only where the
  parts have fewer of them: near copies of one set share many words, and would meet again in every path of those.
- Connected classes are a group of similar titles.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from handbill.operators.dedup import merged_columns, source_trust
from handbill.operators.graph import components
from handbill.session import saved

# Groups up to this size are compared as they are.
FEW = 50


def title_words(title_norm: Column) -> Column:
    """The different words of a folded title, sorted."""
    words = F.split(title_norm, r"[^\p{L}\p{N}]+")
    return F.array_sort(F.array_distinct(F.filter(words, lambda w: w != "")))


def similar(a: str, b: str, threshold: float) -> Column:
    """Whether two sets of words reach the Jaccard similarity."""
    same = F.size(F.array_intersect(f"{a}.words", f"{b}.words"))
    return same >= threshold * (F.col(f"{a}.n") + F.col(f"{b}.n") - same)


def _by_rarity(classes: DataFrame, threshold: float) -> DataFrame:
    """Classes with words rarest first, their number n, and the length of the prefix."""
    words = classes.select("class", "block", F.explode("words").alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("found"))
    ordered = words.join(counts, "word").groupBy("class", "block").agg(
        F.array_sort(F.collect_list(F.struct("found", "word"))).getField("word").alias("words"))
    n = F.size("words")
    return ordered.withColumn("n", n).withColumn(
        "prefix", n - F.ceil(n * F.lit(threshold) - 1e-9).cast("int") + 1)


def _near_hubs(rows: DataFrame, threshold: float) -> DataFrame:
    """(u, v): classes and the hub they are like. A hub is the smallest class of a group among those of about as many
    words; it is compared with these and with those of up to ``1 / threshold`` times as many."""
    keys = ["block", "path", "band"]
    width = math.log(1 / threshold) * (1 + 1e-9)  # two that are similar lie in one band or in neighbours
    banded = rows.withColumn("band", F.floor(F.log(F.col("n")) / width))
    hubs = banded.groupBy(*keys).agg(F.min_by(F.struct("class", "words", "n"), "class").alias("hub"))
    hubs = hubs.select("block", "path", F.explode(F.array("band", F.col("band") + 1)).alias("band"), "hub.*")
    return banded.alias("one").join(hubs.alias("two"), keys).where(
        (F.col("one.class") != F.col("two.class")) & similar("one", "two", threshold)).select(
        F.col("one.class").alias("u"), F.col("two.class").alias("v"))


def _groups(sets: DataFrame, threshold: float, capacity: int) -> DataFrame:
    """(block, path, class, words, n, root, main, cross): sets that share the words of ``path``.

    In groups of more than a few, root is the smallest class known to be connected with a class, main the root of most
    of them, and cross the number of pairs not known to be connected; main is NULL in the others.
    """
    depth = max(1, math.ceil(threshold / (1 - threshold) - 1e-9))
    few = min(capacity, FEW)
    keys, shown = ["block", "path"], ["block", "path", "class", "words", "n", "root", "main", "cross"]
    rows = sets.withColumn("at", F.explode(F.expr("sequence(0, prefix - 1)"))).withColumn(
        "path", F.array(F.get("words", F.col("at"))))
    done = edges = above = None
    for level in range(1, depth + 1):
        sizes = rows.groupBy(*keys).agg(F.count("*").alias("held"))
        rows = saved(rows.join(sizes.where("held > 1"), keys), "similar-groups")
        small = rows.where(F.col("held") <= few).withColumns({
            "root": F.col("class"), "main": F.lit(None).cast(rows.schema["class"].dataType),
            "cross": F.expr("held * (held - 1) DIV 2")})
        many = rows.where(F.col("held") > few)
        found = _near_hubs(many, threshold).distinct()
        edges = saved(found if edges is None else edges.union(found).distinct(), "similar-hubs")
        rooted = saved(many.join(components(edges).withColumnRenamed("node", "class"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")), "similar-rooted")
        of_root = rooted.groupBy(*keys, "root").agg(F.count("*").alias("c"))
        state = of_root.groupBy(*keys).agg(
            F.max_by("root", F.struct("c", "root")).alias("main"),
            F.expr("(sum(c) * sum(c) - sum(c * c)) DIV 2").alias("cross"))
        rows = small.unionByName(saved(rooted.join(state, keys), "similar-compared"))
        if above is not None:
            # groups that splitting leaves with as many comparisons stay whole
            parts = rows.select(*keys, "cross").distinct().groupBy(
                "block", F.slice("path", 1, level - 1).alias("path")).agg(F.sum("cross").alias("parts"))
            whole = above.select(*keys, "cross").distinct().join(parts, keys).where("parts >= cross").select(*keys)
            done = done.unionByName(above.join(whole, keys, "left_semi").select(*shown))
            whole = whole.select("block", F.col("path").alias("of"))
            rows = saved(rows.withColumn("of", F.slice("path", 1, level - 1)).join(
                whole, ["block", "of"], "left_anti").drop("of"), "similar-split")
        full = F.lit(level < depth) & F.col("main").isNotNull() & (F.col("cross") > capacity * F.col("held"))
        part = rows.where(~full).select(*shown)
        done = part if done is None else done.unionByName(part)
        above = rows.where(full)
        if level == depth or above.isEmpty():
            break
        last = F.least(F.col("prefix") + (level - 1), F.col("n") - 1)
        rows = above.drop("held", "root", "main", "cross").where(F.col("at") < last).withColumn(
            "at", F.explode(F.sequence(F.col("at") + 1, last))).withColumn(
            "path", F.concat("path", F.array(F.get("words", F.col("at")))))
    return done


def similar_sets(rows: DataFrame, threshold: float = 0.8, capacity: int = 500) -> DataFrame:
    """(id, group_id) of the rows (id, block, words) that are like another one; group_id is the smallest id of a group.

    Rows without id, block or words are like nothing. Ids are unique; ``words`` are sorted and different.
    """
    if not 0 < threshold <= 1:
        raise ValueError(f"a similarity of {threshold} is none")
    able = rows.where("id IS NOT NULL AND block IS NOT NULL AND size(words) > 0").select("id", "block", "words")
    classes = saved(able.groupBy("block", "words").agg(F.min("id").alias("class"), F.count("*").alias("held")),
                    "similar-classes")
    members = able.join(classes, ["block", "words"]).select("id", "class", "held")
    if threshold == 1:
        return members.where("held > 1").select("id", F.col("class").alias("group_id"))
    groups = _groups(_by_rarity(classes, threshold), threshold, capacity)
    one, two = "one", "two"
    hub_edges = groups.where("root <> class").select(F.col("class").alias("u"), F.col("root").alias("v")).distinct()
    left = groups.where("main IS NULL OR root <> main")
    least, most = F.least("one.n", "two.n"), F.greatest("one.n", "two.n")
    rest = (
        left.alias(one).join(groups.where("cross > 0").alias(two), (F.col("one.block") == F.col("two.block"))
                             & (F.col("one.path") == F.col("two.path")) & (F.col("one.root") != F.col("two.root"))
                             & ((F.col("two.root") == F.col("two.main")) | (F.col("one.class") < F.col("two.class")))
                             & (least >= threshold * most) & similar(one, two, threshold))
        .select(F.col("one.class").alias("u"), F.col("two.class").alias("v")).distinct()
    )
    roots = components(hub_edges.union(rest))
    roots = roots.select(F.col("node").alias("class"), "root")
    return members.join(roots, "class", "left").where("held > 1 OR root IS NOT NULL").select(
        "id", F.coalesce("root", "class").alias("group_id"))


def similar_titles(events: DataFrame, threshold: float = 0.8, capacity: int = 500) -> DataFrame:
    """(seq, group_seq) of events with the title of another one, or one like it, on that day at that place.

    Uses ``seq``, ``title_norm``, ``start_datetime``, ``city_norm`` and ``venue_norm``; events without a day are
    compared with each other.
    """
    block = F.concat_ws(
        "|", F.coalesce(F.date_format("start_datetime", "yyyy-MM-dd"), F.lit("no-date")),
        F.coalesce(F.nullif("city_norm", F.lit("")), F.col("venue_norm")))
    sets = events.select(F.col("seq").alias("id"), block.alias("block"), title_words(F.col("title_norm")).alias("words"))
    return similar_sets(sets, threshold, capacity).select(
        F.col("id").alias("seq"), F.col("group_id").alias("group_seq"))


def similar_title_dedup(events: DataFrame, trust: dict[str, float], columns: Iterable[str],
                        threshold: float = 0.8, capacity: int = 500) -> DataFrame:
    """One event per group of similar titles: the most trusted one, with gaps of ``columns`` filled from the others.

    Takes events that are unique by ``dedup_key`` with the folded texts, and keeps the survivor's key;
    ``n_copies`` is summed. Events without ``seq`` stay as they are.
    """
    groups = similar_titles(events, threshold, capacity)
    order = F.struct((-source_trust(F.col("source"), trust)).alias("t"), F.col("seq").alias("s"))
    columns = list(columns)
    merged = merged_columns(order, columns)
    alone = F.col("group_seq").isNull()
    keyed = events.join(groups, "seq", "left").withColumns({
        "_alone": alone, "_group": F.when(alone, F.col("dedup_key")).otherwise(F.col("group_seq").cast("string"))})
    return keyed.groupBy("_alone", "_group").agg(
        F.min_by("dedup_key", order).alias("dedup_key"), F.min_by("seq", order).alias("seq"),
        F.sum("n_copies").alias("n_copies"), *[merged[c].alias(c) for c in columns],
    ).drop("_alone", "_group")
