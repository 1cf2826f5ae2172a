"""Benchmark decontamination with a distributed positional inverted index. DataFrame functions only.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, with A to Z in lower case.

- *Index.* Each task that reads documents writes the postings of its own ones, sorted by word, document and
  position: a shard. No exchange is needed, and a reader skips pages by the word. The posting of the
  empty word is the document itself, with its id and number of words.
- *Rarest words first.* A window is ``window`` consecutive words of an item, or all of an item that has
  fewer. The postings of its rarest word, less that word's offset, are the places where the item's text
  would have to begin; they are intersected with the adjusted postings of the next rarest word, and what
  is left with those of all other words. Each step is an equality join on (word, document, position), so a
  word or a document with many postings is spread over tasks.
- *Phrases.* Neighbouring words that match at one beginning form runs; a run as long as a window is an
  occurrence.
- *Proximity.* The same for words in any order: next words are looked for in cells of positions around
  the rarest one, and a match is the narrowest span that holds each different word of the window.

Null texts have no words; items without words match nothing; items of equal text are searched once. Items are
told apart by their id: rows that share one are one item, rows without id are one item, listed as an empty
string. Documents may repeat ids or have none, and repeated rows are documents of their own. Empty tables
give empty results (without items, nothing is hit); other columns are ignored. Nothing bounds texts, items
or matches; a document's and an item's own rows are the largest group that one task sorts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import only, saved

UPPER = "".join(map(chr, range(65, 91)))
#: ASCII characters that are in no word.
OTHER = "".join(c for c in map(chr, range(128)) if not c.isalnum())
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The word of the posting that stands for a document.
DOCUMENT = ""


def words(text: str | Column) -> Column:
    """The words of a text, in order."""
    col = F.col(text) if isinstance(text, str) else text
    inner = F.btrim(F.translate(F.coalesce(col, F.lit("")), UPPER, UPPER.lower()), F.lit(OTHER))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BREAK))


def build_index(docs: DataFrame) -> DataFrame:
    """Postings of all documents as a written table: word, rid, pos (from 1), doc_id.

    ``rid`` numbers the rows of ``docs``. The posting of DOCUMENT has the number of words as pos; only it has the id.
    """
    rows = only(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", words("text").alias("ws"))
    postings = rows.select("rid", "doc_id", F.size("ws").alias("n"),
                           F.posexplode(F.concat(F.array(F.lit(DOCUMENT)), "ws")).alias("pos", "word"))
    return saved(postings.select(
        "word", "rid", F.when(F.col("pos") == 0, F.col("n")).otherwise(F.col("pos")).alias("pos"),
        F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
    ).sortWithinPartitions("word", "rid", "pos"), "postings")


def documents_of(index: DataFrame) -> DataFrame:
    """(rid, doc_id, n_words) of each document."""
    return index.where(F.col("word") == DOCUMENT).select("rid", "doc_id", F.col("pos").alias("n_words"))


@dataclass
class Sought:
    """The different texts of the items: their members, their words, and their windows."""

    members: DataFrame  # text_no, item_id
    places: DataFrame   # text_no, off, word, n, found (its postings, all documents)
    windows: DataFrame  # text_no, at, long, ranked: (found, off, word) of its words, rarest first


def sought(index: DataFrame, items: DataFrame, window: int) -> Sought:
    """What ``items`` ask for; windows with a word that no document has are left out."""
    rows = only(items, "item_id", "text").select("item_id", words("text").alias("ws")).where(F.size("ws") > 0)
    texts = saved(rows.select("ws").distinct()
                  .withColumn("text_no", F.monotonically_increasing_id()), "sought-texts")
    members = rows.join(texts, "ws").select("text_no", "item_id").distinct()
    placed = texts.select("text_no", F.size("ws").alias("n"), F.posexplode("ws").alias("off", "word"))
    known = saved(index.join(placed.select("word").distinct(), "word", "left_semi")
                  .groupBy("word").agg(F.count("*").alias("found")), "sought-words")
    places = saved(placed.join(known, "word", "left")
                   .withColumn("found", F.coalesce("found", F.lit(0))), "sought-places")
    ahead = Window.partitionBy("text_no").orderBy("off").rowsBetween(0, window - 1)
    windows = saved(
        places.withColumn("ranked", F.array_sort(F.collect_list(F.struct("found", "off", "word")).over(ahead)))
        .withColumn("long", F.least("n", F.lit(window)))
        .where((F.col("off") + F.col("long") <= F.col("n")) & (F.col("ranked")[0]["found"] > 0))
        .select("text_no", F.col("off").alias("at"), "long", "ranked"), "sought-windows")
    return Sought(members, places, windows)


def phrases(index: DataFrame, want: Sought, window: int) -> DataFrame:
    """(rid, text_no, lo, hi): positions of runs of words that windows of a text cover."""
    first, second = F.get("ranked", F.lit(0)), F.coalesce(F.get("ranked", F.lit(1)), F.get("ranked", F.lit(0)))
    asked = want.windows.select(
        "text_no", "at", "long", first["word"].alias("word"), first["off"].alias("off"),
        second["word"].alias("next"), second["off"].alias("next_off"))
    begun = index.join(asked, "word").select(
        "text_no", "at", "long", "rid", F.col("next").alias("word"),
        (F.col("pos") - F.col("off")).alias("begin"), (F.col("pos") - F.col("off") + F.col("next_off")).alias("pos"))
    held = index.join(asked.select(F.col("next").alias("word")).distinct(), "word", "left_semi")
    left = saved(begun.join(held, ["word", "rid", "pos"], "left_semi")
                 .select("text_no", "at", "long", "rid", "begin"), "phrases-begun")
    probes = (
        left.select("text_no", "rid", "begin", F.explode(F.expr("sequence(at, at + long - 1)")).alias("off"))
        .distinct().join(want.places, ["text_no", "off"])
        .withColumn("pos", F.col("begin") + F.col("off"))
    )
    # words first, then documents as a table whose size the planner knows: no exchange of all postings
    begun_in = saved(left.select("rid").distinct(), "phrases-documents")
    held = index.join(want.places.select("word").distinct(), "word", "left_semi").join(begun_in, "rid", "left_semi")
    same = probes.join(held.select("word", "rid", "pos"), ["word", "rid", "pos"], "left_semi")
    line = Window.partitionBy("text_no", "rid", "begin").orderBy("off")
    return (
        same.withColumn("run", F.col("off") - F.row_number().over(line))
        .groupBy("text_no", "rid", "begin", "run")
        .agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.first("n").alias("n"))
        .where(F.col("hi") - F.col("lo") + 1 >= F.least("n", F.lit(window)))
        .select("rid", "text_no", "lo", "hi")
    )


def proximities(index: DataFrame, want: Sought, within: int) -> DataFrame:
    """(rid, text_no, at, lo, hi): narrowest spans of at most ``within`` words with all words of a window.

    Each posting of the window's rarest word that lies in such a span gives its narrowest one.
    """
    asked = want.windows.select("text_no", "at", F.expr(
        "array_sort(array_distinct(transform(ranked, x -> struct(x.found AS found, x.word AS word))))").alias("ranked"))

    def meeting(rows: DataFrame) -> DataFrame:
        """Rows (..., rid, word, anchor) with each posting of the word near the anchor, found by cells."""
        cell = lambda pos: F.floor(F.col(pos) / F.lit(within))
        held = index.join(rows.select("word").distinct(), "word", "left_semi").select(
            "word", "rid", "pos", cell("pos").alias("cell"))
        around = F.explode(F.array(*(cell("anchor") + k for k in (-1, 0, 1))))
        return rows.withColumn("cell", around).join(held, ["word", "rid", "cell"]).where(
            F.abs(F.col("pos") - F.col("anchor")) < within)

    begun = index.join(asked.withColumn("word", F.col("ranked")[0]["word"]), "word").select(
        "text_no", "at", "rid", "ranked", F.col("pos").alias("anchor"))
    following = F.coalesce(F.get("ranked", F.lit(1)), F.get("ranked", F.lit(0)))["word"]
    left = saved(meeting(begun.withColumn("word", following))
                 .select("text_no", "at", "rid", "anchor", "ranked").distinct(), "proximities-begun")
    met = meeting(left.withColumn("word", F.explode("ranked.word"))).groupBy(
        "text_no", "at", "rid", "anchor", "ranked").agg(F.collect_set(F.struct("pos", "word")).alias("met"))
    spans = met.withColumn("lo", F.explode(F.expr("filter(met, x -> x.pos <= anchor).pos"))).where(
        "forall(ranked, r -> exists(met, y -> y.word = r.word AND y.pos >= lo))")
    spans = spans.withColumn("hi", F.greatest("anchor", F.expr(
        "array_max(transform(ranked, r -> array_min(filter(met, y -> y.word = r.word AND y.pos >= lo).pos)))")))
    return (
        spans.where(F.col("hi") - F.col("lo") < within).groupBy("text_no", "at", "rid", "anchor")
        .agg(F.min(F.struct(F.col("hi") - F.col("lo"), "lo", "hi")).alias("span"))
        .select("rid", "text_no", "at", "span.lo", "span.hi").distinct()
    )


def matches(docs: DataFrame, items: DataFrame, window: int = 10, within: int | None = None) -> DataFrame:
    """(doc_id, rid, item_id, lo, hi): occurrences of windows, or with ``within`` their words close together.

    lo and hi are positions of words, from 1; an occurrence is as long as neighbouring windows reach.
    """
    index = build_index(docs)
    want = sought(index, items, window)
    found = proximities(index, want, within) if within else phrases(index, want, window)
    return (
        found.select("rid", "text_no", "lo", "hi").join(want.members, "text_no")
        .join(documents_of(index).select("rid", "doc_id"), "rid")
        .select("doc_id", "rid", "item_id", "lo", "hi").distinct()
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted), contaminated."""
    index = build_index(docs)
    want = sought(index, items, window)
    found = saved(phrases(index, want, window), "phrases")
    earlier = Window.partitionBy("rid").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        found.select("rid", "lo", "hi").distinct()
        .withColumn("reach", F.coalesce(F.max("hi").over(earlier), F.lit(0)))
        .groupBy("rid").agg(F.sum(F.greatest(
            F.lit(0), F.col("hi") - F.greatest(F.col("lo") - 1, "reach"))).alias("n_hit"))
    )
    named = (
        found.select("rid", "text_no").distinct().join(want.members, "text_no")
        .select("rid", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
        .groupBy("rid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    return (
        documents_of(index).join(hit.join(named, "rid"), "rid", "left")
        .select("doc_id", F.col("n_words").cast("bigint"), F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                F.col("n_hit").isNotNull().alias("contaminated"))
    )
