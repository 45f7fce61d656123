"""What each of five filters removes in every order they can be applied in.

Failure conditions of a whole text (null: empty; words: maximal `[^\\x20\\x09-\\x0D]+`, case-sensitive): A under 200
words; B `100 * distinct words < 50 * words`; C `100 * [A-Z] characters > 3 * code points`; D holds any of
`#$%&*|`; E identical to the text of any smaller id in the whole table.

1. One scan gives each row its digest and a mask of A to D. Rows are counted by (digest, id), then by what tells a
   copy from another row, so a group of copies of any size is cut in every task before it moves; E follows from the
   smallest id of a digest.
2. Rows become cells: (part, mask, labels), at most 32 masks a part.
3. Each cell folds across the constant array of all orders: within an order, `aggregate` carries whether the cell is
   still there and appends what happens at each step, weighted by the cell's rows. That gives 600 structs a cell, and
   the cells of a part are merged by elementwise sums.

A null id is neither smaller nor larger than another: such a row passes E, fails no other row, and has no labels.
Rows with one id and equal texts do not fail each other. Of several labels of one id the largest counts; other values
than 1, nulls too, are not labels. Null languages are the part ''. An empty table gives no rows; columns of any other
name are not read.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.binding import constant
from threadloom.llm.work import Workspace, result

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_UPPER_PERCENT = 200, 50, 3
SYMBOLS = "[#$%&*|]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = "[\\x20\\x09-\\x0D]+"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def _bit(name: str, test: Column) -> Column:
    return F.when(test, F.lit(1 << FILTERS.index(name))).otherwise(F.lit(0))


def text_mask(text: Column, words: Column) -> Column:
    """Bits of the failed filters among A to D; `words` is the array of the text's words."""
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    bits = [
        _bit("A", F.size(words) < MIN_WORDS),
        _bit("B", 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words)),
        _bit("C", 100 * upper.cast("bigint") > MAX_UPPER_PERCENT * F.length(text).cast("bigint")),
        _bit("D", text.rlike(SYMBOLS))]
    return reduce(lambda a, b: a + b, bits)


def _rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    whole = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("text"), F.coalesce(lang, F.lit("")).alias("part"))
    worded = whole.select("*", F.filter(F.split("text", _BLANK), lambda w: w != "").alias("words"))
    return worded.select("id", "part", F.sha2("text", 256).alias("digest"), text_mask(F.col("text"), F.col("words")).alias("mask"))


def _labelled(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """The rows with their labels; those without an id do not meet in the join."""
    one = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        *[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c) for c in ("quality", "toxic")])
    found = rows.where("id IS NOT NULL").join(one, "id", "left")
    without = rows.where("id IS NULL").select("*", F.lit(False).alias("quality"), F.lit(False).alias("toxic"))
    return found.fillna(False, ["quality", "toxic"]).unionByName(without)


def _cells(rows: DataFrame) -> DataFrame:
    """part, mask (A to E) and how many rows, good and toxic ones it has."""
    alike = ["digest", "part", "mask", "quality", "toxic"]
    per_id = rows.groupBy("id", *alike).agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "n"))
    # Rows of one digest that are alike: how many, and those of their smallest id.
    groups = per_id.groupBy(*alike).agg(
        F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("n"), F.min(known).alias("first"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("without_id"))
    # By parts and labels a digest has few of them, so what meets here is small.
    first = groups.groupBy("digest").agg(F.min("first.id").alias("first_id"))
    judged = groups.join(first, "digest").select(
        *alike[1:], "n", "without_id", F.when(F.col("first.id") == F.col("first_id"), F.col("first.n")).otherwise(0).alias("passing"))
    later = F.struct((F.col("mask") + F.lit(1 << FILTERS.index("E"))).alias("mask"), (F.col("n") - F.col("passing")).alias("n"))
    sides = F.array(F.struct(F.col("mask"), (F.col("passing") + F.col("without_id")).alias("n")), later)
    split = judged.select("part", "quality", "toxic", F.inline(sides)).where("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("quality"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("bad"))


def _fold(order: Column, mask: Column, n: Column, good: Column, bad: Column) -> Column:
    """What happens to a cell at each step of one order: array of structs of COUNTS."""
    def when(test: Column, value: Column) -> Column:
        return F.when(test, value).otherwise(F.lit(0)).cast("bigint")

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        removed = state["there"] & fails
        counts = [state["there"] & ~fails, removed, fails & ~state["there"], mask == bit, removed, removed]
        weights = [n, n, n, n, good, bad]
        row = F.struct(*[when(c, w).alias(name) for c, w, name in zip(counts, weights, COUNTS)])
        return F.struct((state["there"] & ~fails).alias("there"), F.concat(state["steps"], F.array(row)).alias("steps"))

    none = F.array().cast("array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>")
    return F.aggregate(order, F.struct(F.lit(True).alias("there"), none.alias("steps")), step, lambda s: s["steps"])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """part, filter_order, step, filter, COUNTS and shapley, for every part, all 120 orders and their 5 steps."""
    spark = docs.sparkSession
    with Workspace(spark) as work:
        cells = work.keep(_cells(_labelled(_rows(docs, key, text, lang), labels, key)), "cells")
        orders = constant([[1 << FILTERS.index(f) for f in o] for o in ORDERS], "array<array<int>>")
        folded = cells.select("part", F.flatten(F.transform(orders, lambda o: _fold(
            o, F.col("mask"), F.col("n"), F.col("good"), F.col("bad")))).alias("steps"))

        def plus(a: Column, b: Column) -> Column:
            return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

        # A part has at most 32 cells.
        merged = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", F.aggregate(
            F.slice("cells", 2, 32), F.get("cells", F.lit(0)), lambda a, b: F.zip_with(a, b, plus)).alias("steps"))
        steps = merged.select("part", F.posexplode("steps").alias("at", "c"))
        names = constant(ORDERS, "array<string>")
        step = (F.col("at") % len(FILTERS) + 1).cast("int")
        named = steps.select("part", F.get(names, F.floor(F.col("at") / len(FILTERS)).cast("int")).alias("filter_order"),
                             step.alias("step"), "c.*")
        named = named.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
        shares = named.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
        return result(spark, named.join(shares, ["part", "filter"]).select(
            "part", "filter_order", "step", "filter", *COUNTS, "shapley"))
