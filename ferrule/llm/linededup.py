"""Line dedup by a suffix array over line ids, built by distributed prefix doubling.

Lines that occur once can't be part of a repeated run; they are left out before anything else and end what is before
them, like the end of a text. The others get ranks. A round takes the rank of a suffix by its first h lines and that of
the suffix h lines on, orders the suffixes by both, and so ranks them by 2h lines; a suffix that is alone in its rank has
its place in the suffix array and leaves. Doubling goes on until every suffix has a place.

The longest common prefix of neighbours in the array is read off the ranks of all rounds, from the longest down: where
both have the same rank by 2^k lines, the next 2^k lines are equal. The neighbours whose common prefixes have n lines or
more form intervals, each of them the places where one run of n lines stands; all places but the first in the corpus are
later copies. A run of MIN_RUN lines counts, and a shorter one of MIN_WORDS words or more (blanks and one). Later copies
that overlap or touch join to the maximal repeated runs, whose lines are deleted.

A rank is the number of suffixes in front: that of the old group plus those of the group whose second rank is smaller,
counted by strips of second ranks and by batches of strips, so that no window has to hold a large group. Intervals are found by strips of places.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrule.llm.common import forget, saved, text_or_empty

MIN_RUN, MIN_WORDS = 3, 50
STRIP = 8_192
#: Strips that are numbered together.
STRIPS = 4_096
#: Second ranks from here on are those of suffixes with nothing behind them, 56 bits of a hash, in 2 ** 16 strips.
ALONE = 1 << 62
#: Bits of the line hash by which lines are first dealt into strips.
TOP_BITS = 12


def _line_key(line: Column) -> list[Column]:
    """124 bits by which lines are told apart: two hashes of different seeds, the first of 60 bits."""
    return [F.shiftrightunsigned(F.xxhash64(line), 4).alias("a"), F.xxhash64(F.lit("line"), line).alias("b")]


def ranked(groups: DataFrame, first: Column, strip: Column, order: list[str]) -> DataFrame:
    """groups (with n members each) with rank: members of smaller groups within `first`, strip by strip."""
    groups = groups.withColumn("_first", first).withColumn("_strip", strip)
    strips = groups.groupBy("_first", "_strip").agg(F.sum("n").alias("_n")).withColumn("_batch", F.floor(F.col("_strip") / STRIPS))
    ahead = lambda *by: F.coalesce(F.sum("_n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    batches = strips.groupBy("_first", "_batch").agg(F.sum("_n").alias("_n")).select("_first", "_batch", ahead("_first", "_batch").alias("_before"))
    strips = strips.join(batches, ["_first", "_batch"]).select("_first", "_strip", (F.col("_before") + ahead("_first", "_batch", "_strip")).alias("_ahead"))
    inside = Window.partitionBy("_first", "_strip").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = groups.withColumn("_within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(strips, ["_first", "_strip"])
    return out.withColumn("rank", F.col("_first") + F.col("_ahead") + F.col("_within")).drop("_first", "_strip", "_ahead", "_within")


def suffix_array(lines: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(row, i, rank, level) of the suffixes at lines that occur more than once: their places in the array, dense from 0,
    and the last level at which others had their rank; and the ranks (row, i, rank) of each level, by 2^level lines.

    lines: row, i, a, b (line key), words; materialised. The first level has words too.
    """
    groups = lines.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    groups = saved(ranked(groups, F.lit(0).cast("long"), F.shiftright("a", 60 - TOP_BITS), ["a", "b"]).select("a", "b", "rank"), "lines-0")
    now = saved(lines.join(groups, ["a", "b"]).select("row", "i", "rank", "words"), "suffixes-0")
    levels, placed = [now], []
    whole = left = now.count()
    while left:
        level = len(levels) - 1
        step = 1 << level
        every = functools.reduce(DataFrame.unionByName, [now.select("row", "i", "rank"), *(p.select("row", "i", "rank") for p in placed)])
        ahead = every.select("row", (F.col("i") - step).alias("i"), F.col("rank").alias("r2"))
        if left * 8 < whole:  # few are open: what they need is picked before the outer join, so that just the few are sent
            ahead = ahead.join(now.select("row", "i"), ["row", "i"])
        pairs = now.select("row", "i", F.col("rank").alias("r1")).join(ahead, ["row", "i"], "left")
        # where nothing repeated follows, a suffix is alone: behind the others, in an order of its own
        alone = F.col("r2").isNull()
        pairs = pairs.select("row", "i", "r1", F.coalesce("r2", F.lit(ALONE) + F.shiftrightunsigned(F.xxhash64("row", "i"), 8)).alias("r2"), F.when(alone, F.struct("row", "i")).alias("own"))
        pairs = saved(pairs, f"pairs-{step}")
        strip = F.when(F.col("r2") >= ALONE, F.lit(ALONE >> 16) + F.shiftright(F.col("r2") - F.lit(ALONE), 40)).otherwise(F.floor(F.col("r2") / STRIP))
        groups = pairs.groupBy("r1", "r2", "own").agg(F.count("*").alias("n"))
        groups = ranked(groups, F.col("r1"), strip, ["r2", "own"]).select(F.col("r1").alias("g1"), F.col("r2").alias("g2"), F.col("own").alias("g3"), "rank", "n")
        next_ = saved(pairs.join(groups, (F.col("r1") == F.col("g1")) & (F.col("r2") == F.col("g2")) & F.col("own").eqNullSafe(F.col("g3"))).select("row", "i", "rank", "n"), f"suffixes-{2 * step}")
        forget(pairs)
        placed.append(next_.where("n = 1").select("row", "i", "rank", F.lit(level).alias("level")))
        now = next_.where("n > 1").select("row", "i", "rank")
        levels.append(now)
        left = now.count()
    array = functools.reduce(DataFrame.unionByName, placed) if placed else now.select("row", "i", "rank", F.lit(0).alias("level"))
    return array, levels[:-1]


def common_prefixes(array: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(rank, row, i, lcp): how many lines each suffix has in common with the one before it in the array."""
    before = array.select((F.col("rank") + 1).alias("rank"), F.col("row").alias("row_0"), F.col("i").alias("i_0"), F.col("level").alias("level_0"))
    start = F.when(F.col("row_0").isNotNull(), F.least("level", "level_0"))
    pairs = saved(array.join(before, "rank", "left").select("rank", "row", "i", "row_0", "i_0", start.alias("level")), "neighbours")
    now = None
    for level in reversed(range(len(levels))):
        one = levels[level].select(F.col("row").alias("x_row"), F.col("i").alias("x_i"), F.col("rank").alias("x"))
        two = levels[level].select(F.col("row").alias("y_row"), F.col("i").alias("y_i"), F.col("rank").alias("y"))
        active = pairs.where(F.col("level") == level).withColumn("lcp", F.lit(0)).drop("level")
        active = active if now is None else active.unionByName(now)
        both = active.join(one, (F.col("row") == F.col("x_row")) & (F.col("i") + F.col("lcp") == F.col("x_i")), "left").join(two, (F.col("row_0") == F.col("y_row")) & (F.col("i_0") + F.col("lcp") == F.col("y_i")), "left")
        grown = both.select("rank", "row", "i", "row_0", "i_0", (F.col("lcp") + F.when(F.col("x") == F.col("y"), 1 << level).otherwise(0)).alias("lcp"))
        last, now = now, saved(grown, f"prefixes-{level}")
        if last is not None:
            forget(last)
    return now.select("rank", "row", "i", "lcp").unionByName(pairs.where("level is null").select("rank", "row", "i", F.lit(0).alias("lcp")))


def later_copies(lines: DataFrame, docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, i, n): at line i of a row begins a later copy of a run of n lines (up to min_run) that counts.

    docs (row, doc_id) tells which copy is the first: by doc_id, row and line, null ids before others.
    """
    array, levels = suffix_array(lines)
    if not levels:
        return lines.select("row", "i", F.lit(1).alias("n")).limit(0)
    array = common_prefixes(saved(array, "suffix-array"), levels)
    # the interval of n lines that a place is in begins at the last place whose prefix in common is shorter
    strip = F.floor(F.col("rank") / STRIP)
    lengths = range(1, min_run + 1)
    starts = [F.when(F.col("lcp") < n, F.col("rank")) for n in lengths]
    strips = array.groupBy(strip.alias("strip")).agg(*(F.max(x).alias(f"last_{n}") for n, x in zip(lengths, starts, strict=True))).withColumn("batch", F.floor(F.col("strip") / STRIPS))
    ahead = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    batches = strips.groupBy("batch").agg(*(F.max(f"last_{n}").alias(f"batch_{n}") for n in lengths))  # one row for STRIP * STRIPS places
    batches = batches.select("batch", *(F.max(f"batch_{n}").over(ahead(F.lit(0), "batch")).alias(f"batch_{n}") for n in lengths))
    strips = strips.join(batches, "batch").select("strip", *(F.coalesce(F.max(f"last_{n}").over(ahead("batch", "strip")), f"batch_{n}").alias(f"carried_{n}") for n in lengths))
    inside = Window.partitionBy("strip").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    found = array.withColumn("strip", strip).select("strip", "row", "i", *(F.max(x).over(inside).alias(f"own_{n}") for n, x in zip(lengths, starts, strict=True))).join(strips, "strip")
    found = found.select("row", "i", F.explode(F.array(*(F.struct(F.lit(n).alias("n"), F.coalesce(f"own_{n}", f"carried_{n}").alias("head")) for n in lengths))).alias("x")).select("row", "i", "x.*")
    # whether a run counts is the same at all places of an interval; a run that isn't all there has null words
    enough = words = levels[0].select("row", "i", "words")
    for k in range(1, min_run - 1):
        enough = enough.join(words.select("row", (F.col("i") - k).alias("i"), F.col("words").alias(f"words_{k}")), ["row", "i"], "left")
    sums = [functools.reduce(Column.__add__, [F.col("words"), *(F.col(f"words_{k}") for k in range(1, n))]) for n in range(1, min_run)]
    enough = enough.select("row", "i", F.coalesce(*(F.when(x >= min_words, n) for n, x in enumerate(sums, 1)), F.lit(min_run)).alias("least"))
    found = found.join(enough, ["row", "i"]).where("n >= least").join(docs, "row")
    place = F.struct("doc_id", "row", "i")
    heads = found.groupBy("n", "head").agg(F.min(place).alias("first"), F.count("*").alias("size")).where("size > 1").select("n", "head", "first")
    return found.join(heads, ["n", "head"]).where(F.col("first") != place).select("row", "i", "n")


def deduplicated(docs: DataFrame, min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of docs: doc_id, text (without later copies; null stays null), n_lines, n_removed, runs (array
    of first line and line after the last one).

    Lines end at a line feed only. An empty text is one empty line; a null text has none; a text of any length is taken
    whole. Repeated rows are copies of each other in no fixed order. A null doc_id comes first. Other columns are
    ignored; an empty table gives an empty result.
    """
    base = saved(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "line-texts")
    split = F.split(text_or_empty(), "\n", -1)
    lines = base.where(F.col("text").isNotNull()).select("row", F.posexplode(split).alias("i", "line"))
    words = F.length("line") - F.length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1
    lines = saved(lines.select("row", "i", words.alias("words"), *_line_key(F.col("line"))), "lines")
    marks = later_copies(lines, base.select("row", "doc_id"), min_run, min_words)
    marks = marks.groupBy("row", "i").agg((F.col("i") + F.max("n")).alias("end"))
    by_row = Window.partitionBy("row").orderBy("i")
    reach = F.max("end").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    starts = marks.withColumn("new", (F.col("i") > F.coalesce(reach, F.lit(-1))).cast("int"))
    runs = starts.withColumn("run", F.sum("new").over(by_row)).groupBy("row", "run").agg(F.struct(F.min("i").alias("start"), F.max("end").alias("end")).alias("span"))
    runs = runs.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("runs"))
    out = base.join(runs, "row", "left").withColumn("lines", F.when(F.col("text").isNotNull(), split))
    gone = F.flatten(F.transform("runs", lambda x: F.sequence(x["start"], x["end"] - 1)))
    n = F.coalesce(F.size("lines"), F.lit(0))
    left = F.when(F.size(gone) >= n, F.expr("cast(array() as array<int>)")).otherwise(F.array_except(F.sequence(F.lit(0), n - 1), gone))
    text = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda j: F.col("lines")[j]), "\n"))
    removed = F.coalesce(F.aggregate("runs", F.lit(0), lambda s, x: s + x["end"] - x["start"]), F.lit(0))
    return out.select("doc_id", text.alias("text"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), F.coalesce("runs", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("runs"))


def query(spark, sf_dir: str) -> DataFrame:
    found = deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_removed", F.size("runs").cast("long").alias("n_runs"), F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, i, k, count(*) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS n,
        list(line) OVER (PARTITION BY doc_id, k ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS lines FROM l, (VALUES (1), (2), (3)) AS v(k)),
runs AS (SELECT doc_id, i, k, lines[:k] AS run FROM w WHERE n >= k AND (k = 3
        OR list_sum(list_transform(lines[:k], lambda x: length(x) - length(replace(x, ' ', '')) + 1)) >= 50)),
later AS (SELECT doc_id, i, k FROM (SELECT doc_id, i, k, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS place FROM runs) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS i FROM later),
m AS (SELECT l.doc_id, l.i, l.line, g.i IS NOT NULL AS out FROM l LEFT JOIN gone AS g ON l.doc_id = g.doc_id AND l.i = g.i),
r AS (SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM m),
s AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (out) AS n_removed, count(*) FILTER (opens) AS n_runs,
        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT out), '') AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents AS d LEFT JOIN s ON d.doc_id = s.doc_id
"""
