"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share all words; a
target stops at three times its source's words and the excess is shared again by weight.

Schedule: a source's documents are shuffled by a keyed hash and laid end to end; this stream is cut
into blocks of ``block_words`` words, and a source is due as many blocks as its target holds, going
through its stream again when it has been used up. Slot i of the mix is the van der Corput point of
i (its binary digits mirrored behind the point); the cumulative shares of the sources map the point
to a source, the slot's rank among the slots of that source is the block it draws. The few slots
that the discrepancy leaves over are handed from the sources above their due to those below it, so
every slot draws one block and every source ends within half a block of its target. A document's
``first_slot`` is the earliest slot that draws words of it: its place when the mix is read in order.

Defined cases: null and empty texts have size 0 and are taken 0 words; a document that the mix does
not take has no ``first_slot``; a null doc_id is shuffled by the seed alone; a null source is a source
of its own; repeated documents are separate documents of equal place; a document is never taken
more than three times; an empty table gives no rows; other columns pass through ``mixed_documents``.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberfold.llm.common import word_list
from emberfold.session import cut_lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Weights of the sources in order, repeating, and the most often a word is used.
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 64
SEED = "mix"
# Documents per piece of a source in running sums, slots per chunk, strips of the unit interval.
STRETCH, CHUNK, STRIPS = 2000, 4096, 1024


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, n_docs) of ``sized`` (source, size): one row per source."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.array(*[F.lit(w) for w in WEIGHTS])[(place - 1) % len(WEIGHTS)].cast("double")
    # With the sources that fill up first taken out, the others share what is left by weight.
    order = everything.orderBy(F.col("source_size") / F.col("weight"), F.col("place"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(MOST * F.col("source_size")).over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    return (
        sums.withColumn("place", place).withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("turn", F.row_number().over(order))
        .withColumn("open", F.when(MOST * F.col("source_size") >= F.col("level") * F.col("weight"), F.col("turn")))
        .withColumn("first", F.min("open").over(everything))
        .withColumn("level", F.max(F.when(F.col("turn") == F.col("first"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("turn") < F.col("first"), MOST * F.col("source_size")).otherwise(
            F.least(F.col("level") * F.col("weight"), MOST * F.col("source_size"))).cast("double"))
        .select("source", "source_size", "target", "n_docs", "place")
    )


def _dues(targets: DataFrame, block_words: int) -> DataFrame:
    """Blocks of each source's stream, and how many it is due: whole passes and a part of one."""
    size, target = F.col("source_size"), F.col("target")
    blocks = F.ceil(size / F.lit(block_words)).cast("long")
    passes = F.when(size > 0, F.floor(target / size)).otherwise(0).cast("long")
    rest = F.when(size > 0, F.round((target - passes * size) / F.lit(block_words))).otherwise(0).cast("long")
    return (
        targets.withColumn("blocks", blocks)
        .withColumn("due", passes * F.col("blocks") + F.least(rest, F.col("blocks")))
    )


def _mirrored(i: Column) -> Column:
    """Van der Corput point of i in [0, 1): exact, as the digits are moved and not divided."""
    digits = F.bin(i)
    return F.conv(F.reverse(digits), 2, 10).cast("double") / F.pow(F.lit(2.0), F.length(digits))


def schedule(dues: DataFrame) -> DataFrame:
    """(slot, place, rank) for every block due, each slot once; ``dues`` has (place, due), few rows."""
    spark = dues.sparkSession
    total = dues.agg(F.coalesce(F.sum("due"), F.lit(0)).alias("n")).collect()[0]["n"]
    upto = Window.partitionBy(F.lit(0)).orderBy("place")
    shares = (
        dues.filter("due > 0").withColumn("high", F.sum("due").over(upto))
        .select("place", "due", ((F.col("high") - F.col("due")) / F.lit(float(total or 1))).alias("low"),
                (F.col("high") / F.lit(float(total or 1))).alias("high"))
        .withColumn("strip", F.explode(F.sequence(
            F.floor(F.col("low") * STRIPS), F.least(F.floor(F.col("high") * STRIPS), F.lit(STRIPS - 1)))))
    )
    points = spark.range(total).select(F.col("id").alias("slot"), _mirrored(F.col("id")).alias("u"))
    drawn = (
        points.withColumn("strip", F.floor(F.col("u") * STRIPS)).join(shares, "strip")
        .filter("u >= low AND u < high").select("slot", "place", "due")
        .withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    )
    # Rank of a slot among those of its source: slots of earlier runs of chunks, of earlier chunks
    # of the run, and of the chunk, so that no window spans a whole source.
    counts = drawn.groupBy("place", "chunk").agg(F.count("*").alias("n")).withColumn("run", F.expr(f"chunk div {CHUNK}"))
    earlier = Window.partitionBy("place").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("place", "run").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    by_run = counts.groupBy("place", "run").agg(F.sum("n").alias("m"))
    by_run = by_run.withColumn("earlier", F.coalesce(F.sum("m").over(earlier), F.lit(0)))
    base = counts.join(by_run, ["place", "run"]).select(
        "place", "chunk", (F.col("earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("base")
    )
    own = F.row_number().over(Window.partitionBy("place", "chunk").orderBy("slot")) - 1
    ranked = cut_lineage(
        drawn.withColumn("own", own).join(base, ["place", "chunk"])
        .select("slot", "place", "due", (F.col("base") + F.col("own")).alias("rank"))
    )
    got = ranked.groupBy("place").agg(F.count("*").alias("got"))
    short = (
        dues.join(got, "place", "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got < due")
        .select("place", F.explode(F.expr("sequence(got, due - 1)")).alias("rank"))
    )
    # As many as the discrepancy: a multiple of the sources and the digits of the last slot.
    everything = Window.partitionBy(F.lit(0))
    short = short.withColumn("turn", F.row_number().over(everything.orderBy("place", "rank")))
    over = ranked.filter("rank >= due").select("slot", F.row_number().over(everything.orderBy("slot")).alias("turn"))
    handed = short.join(over, "turn").select("slot", "place", "rank")
    return ranked.filter("rank < due").select("slot", "place", "rank").unionByName(handed)


def _sized(docs: DataFrame, extra: list[Column]) -> DataFrame:
    return cut_lineage(
        docs.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "source",
            F.size(word_list(F.col("text"))).cast("long").alias("size"), *extra,
        )
    )


def streams(sized: DataFrame, targets: DataFrame, seed: str = SEED) -> DataFrame:
    """``sized`` with each document's first word's place in its source's shuffled stream."""
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    point = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    stretch = F.floor(point * F.ceil(F.col("n_docs") / STRETCH))
    laid = (
        sized.select("row", "doc_id", "source", "size").join(F.broadcast(targets), sized["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"]).withColumn("key", key).withColumn("stretch", stretch)
    )
    sums = laid.groupBy("place", "stretch").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = (
        Window.partitionBy("place", "stretch").orderBy("key", "doc_id", "size", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return laid.join(sums, ["place", "stretch"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )


def draw(sized: DataFrame, *, block_words: int = BLOCK_WORDS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents with source_size and target, the words drawn of them by pass).

    The second has (row, pass, from_word, words, first_slot): of a document, in one pass over its source.
    """
    targets = cut_lineage(source_targets(sized))
    dues = cut_lineage(_dues(targets, block_words))
    laid = streams(sized, targets, seed)
    ends = F.col("start") + F.col("size")
    first, last = F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}")
    parts = (
        laid.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
        .select(
            "row", "place", "block",
            F.greatest(F.lit(0), F.col("block") * block_words - F.col("start")).alias("from_word"),
            (F.least(ends, (F.col("block") + 1) * block_words)
             - F.greatest(F.col("start"), F.col("block") * block_words)).alias("words"),
        )
    )
    slots = (
        schedule(dues.select("place", "due")).join(F.broadcast(dues.select("place", "blocks")), "place")
        .select("place", "slot", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("pass"))
    )
    drawn = (
        parts.join(slots, ["place", "block"]).groupBy("row", "pass")
        .agg(F.min("from_word").alias("from_word"), F.sum("words").alias("words"), F.min("slot").alias("first_slot"))
    )
    return laid, drawn


def mix_report(docs: DataFrame, *, block_words: int = BLOCK_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target, the words taken and the first slot of every document."""
    laid, drawn = draw(_sized(docs, []), block_words=block_words, seed=seed)
    taken = drawn.groupBy("row").agg(F.sum("words").alias("taken"), F.min("first_slot").alias("first_slot"))
    return laid.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "first_slot",
    )


def _words_between(text: pd.Series, first: pd.Series, words: pd.Series) -> pd.Series:
    """The text from its word number ``first`` on, for so many words, spaces between them kept."""

    def cut(t: str, a: int, n: int) -> str:
        ends = [m.span() for m in itertools.islice(WORD.finditer(t), a, a + n)]
        return t[ends[0][0] : ends[-1][1]] if ends else ""

    return pd.Series([cut(*x) for x in zip(text, first, words)])


def mixed_documents(
    docs: DataFrame, *, block_words: int = BLOCK_WORDS, seed: str = SEED, slot: str | None = None
) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row per document and pass.

    ``slot`` names a further column for the first slot of the row, by which the mix can be sorted.

    A document drawn whole keeps its text; at the end of a source's last pass one document may be
    drawn in part and then holds the drawn words. ``n_chars`` follows the text. Documents that the
    mix does not take are gone.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    sized = _sized(docs, [whole])
    _, drawn = draw(sized, block_words=block_words, seed=seed)
    picked = sized.join(drawn, "row")
    part = picked.filter("words < size").select("doc", "first_slot", F.pandas_udf(_words_between, "string")("doc.text", "from_word", "words").alias("cut"))
    both = picked.filter("words = size").select("doc", "first_slot", F.lit(None).cast("string").alias("cut")).unionByName(part)
    out = {"text": F.coalesce("cut", F.col("doc.text"))}
    if "n_chars" in docs.columns:
        length = F.length("cut").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.col("cut").isNull(), F.col("doc.n_chars")).otherwise(length)
    last = [F.col("first_slot").alias(slot)] if slot else []
    return both.select(*[out.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns], *last)
