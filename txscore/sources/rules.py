"""Indented rule text of decision trees, written and read as DataFrames.

    |--- amt <= 50.0
    |   |--- class: 0
    |--- amt >  50.0
    |   |--- class: 1

Reading: a line's depth is its indent; the last condition seen at each lesser depth is the path
of a leaf. A file is one tree, whose leaves are as few as its depth allows, so its lines are
one window; many files are read side by side. Writing is the reverse: of each leaf only the part
of the path that the leaf before doesn't share gets lines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INDENT = "|   "
#: Depth of the deepest tree that is read.
MAX_DEPTH = 64


def read_rules(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> DataFrame:
    """(file, leaf, path, rule, class): one row for each leaf in order; ``rule`` is SQL. ``names``: the
    features that ``feature_0``, ``feature_1``, ... stand for."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"), "value").where("value like '%|--- %'")
    lines = lines.select("file", "block", "i", (F.expr(f"(position('|---' IN value) - 1) div {len(INDENT)}")).alias("depth"),
                         F.trim(F.regexp_extract("value", r"\|--- (.*)$", 1)).alias("text"))
    lines = lines.withColumn("class", F.regexp_extract("text", r"^class: *(-?\d+)", 1).try_cast("int")) \
        .withColumn("text", F.regexp_replace("text", " +", " "))
    deepest = lines.agg(F.max("depth")).first()[0] or 0
    if deepest > MAX_DEPTH:
        raise ValueError(f"rules of depth {deepest}, over {MAX_DEPTH}")
    seen = Window.partitionBy("file").orderBy("block", "i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    condition = F.col("text") if names is None else _named(F.col("text"), names)
    last = [F.last(F.when((F.col("depth") == d) & F.col("class").isNull(), condition), ignorenulls=True).over(seen)
            for d in range(deepest)]
    steps = F.array(*last) if last else F.array().cast("array<string>")
    number = F.sum(F.when(F.col("class").isNotNull(), 1)).over(seen) - 1
    leaves = lines.select("file", F.slice(steps, F.lit(1), F.col("depth").cast("int")).alias("path"), "class",
                          number.cast("int").alias("leaf")).where("class is not null")
    rule = F.when(F.size("path") > 0, F.array_join("path", " AND ")).otherwise(F.lit("TRUE"))
    return leaves.select("file", "leaf", "path", rule.alias("rule"), "class")


def _named(text: Column, names: Sequence[str]) -> Column:
    number = F.regexp_extract(text, r"^feature_(\d+) ", 1).try_cast("int")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), number + 1)
    return F.when(number.isNotNull(), F.concat(F.lit("`"), name, F.lit("` "), F.regexp_extract(text, r"^\S+ (.*)$", 1))) \
        .otherwise(text)


def rule_lines(leaves: DataFrame) -> DataFrame:
    """(leaf, depth, value) of a rule table (leaf, path, class): the lines of its text in the order of
    (leaf, depth)."""
    before = F.lag("path", 1, None).over(Window.orderBy("leaf"))  # the leaves of one tree
    given = leaves.select("leaf", "path", "class", F.coalesce(before, F.array().cast("array<string>")).alias("before"))
    depths = F.sequence(F.lit(0), F.size("path"))
    shared = F.aggregate(depths, F.lit(0), lambda n, d: F.when(
        (n == d) & (d < F.size("path")) & (d < F.size("before")) & (F.get("path", d) == F.get("before", d)),
        d + 1).otherwise(n))
    return (given.withColumn("shared", shared).withColumn("depth", F.explode(depths)).where("depth >= shared")
            .select("leaf", "depth", F.concat(F.repeat(F.lit(INDENT), F.col("depth")), F.lit("|--- "), F.coalesce(
                F.get("path", F.col("depth")), F.concat(F.lit("class: "), F.col("class").cast("string")))).alias("value")))


def write_rules(leaves: DataFrame, path: str) -> None:
    """One text file of a tree's rules (a few lines: at most two for each node)."""
    (rule_lines(leaves).coalesce(1).sortWithinPartitions("leaf", "depth").select("value")
     .write.mode("overwrite").text(path))
