"""Operator 9: line deduplication by a suffix array over sequences of line IDs.

Every document is a sequence of line IDs. Prefix doubling ranks all suffixes by their first 1,
2, 4, ... lines: the rank by 2m lines is that of two ranks by m lines, m lines apart. Suffixes of
one rank are an interval of the suffix array whose longest common prefix is at least that
many lines. Suffixes that share their lines with no other have found their place and leave;
doubling ends with the longest repeat. An interval's first place keeps its lines, later places
lose them. A longest run of L lines is the union of the intervals of depth m <= L < 2m
that start in it; where short depths may lack words, those between have intervals too.

All of it is DataFrame code. Only IDs move until the texts meet their list of removed lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from daybook.llm.common import WORD
from daybook.session import settle

#: A run of repeated lines counts if it has this many words in all.
LEAST_WORDS = 5

#: Names that hold more than one in so many of all places meet them by broadcast: fewer rows than
#: this. Of the others, none holds more than that share of a shuffle.
HOT = 1000


#: Columns that the result has besides those of the documents.
ADDED = ("n_lines", "n_removed")


def _keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """Text, key (doc_id), a tag that keeps documents with one doc_id apart, and all else in one column.

    As one column the rest of a row cannot clash. Also tells whether doc_ids repeat.
    """
    count = docs.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")).first()
    repeated = count["d"] < count["n"]
    tag = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    row = F.struct(*[docs[c] for c in docs.columns if c != "text"])
    keyed = docs.select(row.alias("row"), docs["text"], docs["doc_id"].cast("long").alias("key"), tag.alias("tag"))
    return keyed, repeated


def line_table(keyed: DataFrame, repeated: bool) -> DataFrame:
    """Every line that has a word: key, tag, place among such lines, number, words, ID (x, y)."""
    every = F.transform(F.split("text", "\n", -1), lambda line, i: F.struct(i.alias("number"), line.alias("line")))
    lines = keyed.where("text is not null and key is not null").select(
        "key", "tag", F.posexplode(F.filter(every, lambda e: e["line"].rlike(WORD))).alias("at", "e")
    )
    lines = lines.select(
        "key",
        "tag",
        "at",
        "e.number",
        F.regexp_count("e.line", F.lit(WORD)).alias("words"),
        F.xxhash64("e.line").alias("x"),
        F.xxhash64(F.lit(1), "e.line").alias("y"),
    )
    return lines.dropDuplicates(["key", "tag", "at"]) if repeated else lines


def _shared(places: DataFrame, names: list[str], total: int) -> DataFrame:
    """The places whose name another place has too, with its rank and first place; in the order of names.

    Ranks follow the names: they are given out along a range partitioning of the distinct ones.
    """
    groups = places.groupBy(*names).agg(F.min("spot").alias("first"), F.count("*").alias("n")).where("n > 1")
    ranked = groups.repartitionByRange(*names).sortWithinPartitions(*names)
    ranked = settle(ranked.withColumn("rank", F.monotonically_increasing_id()), "line-intervals")
    frequent = F.col("n") * HOT > total
    hot = places.join(F.broadcast(ranked.where(frequent).drop("n")), names, "left")
    cold = hot.where("rank is null").drop("rank", "first")
    cold = cold.join(ranked.where(~frequent).drop("n").hint("merge"), names)
    return hot.where("rank is not null").unionByName(cold).drop(*names)


def _order() -> WindowSpec:
    return Window.partitionBy("key", "tag").orderBy("at")


def _ahead(lines: int) -> Column:
    """Rank of the suffix so many lines on, if it is one of these."""
    return F.max("rank").over(_order().rangeBetween(lines, lines))


def intervals(lines: DataFrame, least_words: int = LEAST_WORDS) -> Iterator[tuple[int, DataFrame]]:
    """Depth and members of the suffix array's intervals: 1, 2, 4, ... and all up to ``least_words``.

    ``lines`` is a line table. Members have key, tag, at (first line of the suffix), rank
    (one per interval, in the order of the suffixes), later (not the interval's first place) and
    need (lines from there on that have ``least_words`` words). The first has number, too.
    """
    # A place in the order of all lines, in one number that a hash aggregate can hold.
    spot = F.col("key").cast("decimal(38,0)") * F.lit(2**31).cast("decimal(12,0)") + F.col("number")
    level = _shared(lines.withColumn("spot", spot.cast("decimal(38,0)")), ["x", "y"], lines.count())
    need = F.lit(least_words)
    for some in range(least_words - 1, 0, -1):
        words = F.sum("words").over(_order().rangeBetween(0, some - 1))
        need = F.when(words >= least_words, some).otherwise(need)
    level = level.withColumn("need", need).drop("words")
    depth = 1
    while True:
        later = (F.col("spot") > F.col("first")).alias("later")
        between = range(depth + 1, min(2 * depth - 1, least_words) + 1)
        ahead = [_ahead(some - depth).alias(f"ahead_{some}") for some in [*between, 2 * depth]]
        level = settle(level.select(*[c for c in level.columns if c != "first"], later, *ahead), "line-ranks")
        yield depth, level
        for some in [*between, 2 * depth]:
            pairs = level.select(
                "key", "tag", "at", "need", "spot", F.col("rank").alias("a"), F.col(f"ahead_{some}").alias("b")
            ).where("b is not null")
            total = pairs.count()
            if total == 0:
                continue
            deeper = _shared(pairs, ["a", "b"], total)
            if some in between:
                yield some, deeper.withColumn("later", F.col("spot") > F.col("first"))
        if total == 0:
            return
        level, depth = deeper, 2 * depth


def removed_lines(keyed: DataFrame, repeated: bool, least_words: int = LEAST_WORDS) -> DataFrame:
    """Lines covered by a run of lines that has ``least_words`` words and an earlier copy.

    Columns: key, tag, removed (line numbers). Earlier means a smaller (doc_id, line number).

    As each line has a word, a longer run than ``least_words`` lines is covered by shorter ones
    that have the words; runs up to that length are looked at in every length.
    """
    reaches = []
    for depth, members in intervals(settle(line_table(keyed, repeated), "lines"), least_words):
        counts = F.col("later") & (F.col("need") <= depth)
        reach = F.when(counts, F.col("at") + depth).otherwise(F.col("at")).alias("reach")
        number = F.col("number") if depth == 1 else F.lit(None).cast("int")
        found = members.select("key", "tag", "at", number.alias("number"), reach)
        reaches.append(found if depth == 1 else found.where("reach > at"))
    # Rows of one document by place; whatever starts up to a line may reach beyond it.
    covered = reduce(DataFrame.unionByName, reaches).withColumn("upto", F.max("reach").over(_order()))
    removed = covered.where("number is not null and upto > at")
    return removed.groupBy("key", "tag").agg(F.collect_list("number").alias("removed"))


def remove_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs``, all columns, with repeated lines taken out of ``text``; adds n_lines and n_removed.

    Columns of these two names that ``docs`` has give way to the new ones.

    A line goes if it lies in a run of consecutive lines of its document that has at least
    ``least_words`` words and occurs before, in this or another document, at a smaller
    (doc_id, line number). Lines without a word are passed over in runs and always stay. The
    lines kept are joined by line breaks. A null text stays null and has no lines; an empty
    one has one. Repeated rows are one document and lose the same lines; rows with one doc_id
    and other texts are compared by their line numbers; a null doc_id takes no part.
    """
    keyed, repeated = _keyed(docs)
    gone = settle(removed_lines(keyed, repeated, least_words), "removed-lines")
    # At any size the join sorts both sides: how many documents lose lines grows with the input.
    joined = keyed.join(gone.hint("merge"), ["key", "tag"], "left")
    lines = F.split("text", "\n", -1)

    def left(all_lines: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(all_lines) - 1)
        kept = F.array_except(numbers, F.col("removed"))
        return F.array_join(F.transform(kept, lambda k: F.get(all_lines, k)), "\n")

    # The one-element array names the lines, so that they are split once.
    text = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.transform(F.array(lines), left)[0])
    return joined.select(
        *[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ADDED],
        F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1, F.lit(0))
        .cast("long")
        .alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
    )
