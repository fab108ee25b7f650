"""Matching names that differ by legal suffixes, articles and surrounding words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.text import canonical

LEAST_CONTAINED = 6


def same_canonical(x: Column, y: Column) -> Column:
    """Whether two canonical names denote one company: equal, or the shorter a phrase of whole words in the longer."""
    x_shorter = F.length(x) <= F.length(y)
    low, high = F.when(x_shorter, x).otherwise(y), F.when(x_shorter, y).otherwise(x)
    inside = (F.length(low) >= LEAST_CONTAINED) & F.contains(F.concat(F.lit(" "), high, F.lit(" ")), F.concat(F.lit(" "), low, F.lit(" ")))
    return (x != "") & (y != "") & ((x == y) | inside)


def same_entity(a: Column, b: Column) -> Column:
    return same_canonical(canonical(a), canonical(b))


def hits(a: Column, b: Column) -> Column:
    """How many of the canonical names ``a`` match some of ``b``."""
    return F.size(F.filter(a, lambda x: F.exists(b, lambda y: same_canonical(x, y)))).cast("long")


def containment_pct(n_hits: Column, n: Column) -> Column:
    """Percentage with one decimal, ties to even; null of none."""
    return F.when(n > 0, F.bround(F.lit(100.0) * n_hits / n, 1))


def overlap(a: Column, b: Column) -> Column:
    """(shared, only_a, only_b): names matched one to one, greedily in the order of ``a`` and ``b``."""
    pair = lambda n: F.struct(n.alias("name"), canonical(n).alias("c"))
    left = F.filter(F.transform(a, pair), lambda p: p["c"] != "")
    right = F.filter(F.transform(b, pair), lambda p: p["c"] != "")
    none = F.struct(F.array().cast("array<string>").alias("shared"), F.array().cast("array<int>").alias("used"))
    at = F.sequence(F.lit(0), F.size(right) - 1)

    def step(acc: Column, x: Column) -> Column:
        free = F.filter(F.when(F.size(right) > 0, at).otherwise(F.array().cast("array<int>")), lambda i: ~F.array_contains(acc["used"], i) & same_canonical(x["c"], F.get(right, i)["c"]))
        found = F.size(free) > 0
        shared = F.when(found, F.concat(acc["shared"], F.array(x["name"]))).otherwise(acc["shared"])
        used = F.when(found, F.concat(acc["used"], F.slice(free, 1, 1))).otherwise(acc["used"])
        return F.struct(shared.alias("shared"), used.alias("used"))

    met = F.aggregate(left, none, step)
    only_a = F.filter(F.transform(left, lambda p: p["name"]), lambda n: ~F.array_contains(met["shared"], n))
    only_b = F.transform(F.filter(right, lambda p, i: ~F.array_contains(met["used"], i)), lambda p: p["name"])
    return F.struct(met["shared"].alias("shared"), only_a.alias("only_a"), only_b.alias("only_b"))


def _rarest_word(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, word): of each distinct canonical name the word that the fewest names have."""
    words = names.select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("word")).join(counts, "word")
    return words.groupBy("name").agg(F.min(F.struct("n", "word"))["word"].alias("word"))


def entity_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, left_cols: list[str], right_cols: list[str]) -> DataFrame:
    """All pairs of rows whose names match, without a nested-loop join.

    A phrase that another name holds whole has all its words there. So each
    distinct name is listed under its rarest word, and probed with each of its
    words; candidates meet by equality on a word, one that few names share, and
    are verified. Rows follow their names at the end. Output columns must not
    clash.
    """
    a = left.withColumn("__ca", canonical(F.col(left_name))).filter("__ca <> ''")
    b = right.withColumn("__cb", canonical(F.col(right_name))).filter("__cb <> ''")
    names_a, names_b = a.select(F.col("__ca").alias("name")).distinct(), b.select(F.col("__cb").alias("name")).distinct()
    counts = names_a.unionByName(names_b).select(F.explode(F.array_distinct(F.split("name", " "))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    each = lambda names, c: names.select(F.col("name").alias(c), F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    rare = lambda names, c: _rarest_word(names, counts).withColumnRenamed("name", c)
    # the shorter name is on the left, or, strictly, on the right: no pair is found twice
    short_left = rare(names_a, "x").join(each(names_b, "y"), "word").filter(F.length("x") <= F.length("y"))
    short_right = each(names_a, "x").join(rare(names_b, "y"), "word").filter(F.length("x") > F.length("y"))
    pairs = short_left.unionByName(short_right).filter(same_canonical(F.col("x"), F.col("y"))).select("x", "y")
    return pairs.join(a, F.col("x") == F.col("__ca")).join(b, F.col("y") == F.col("__cb")).select(*left_cols, *right_cols)
