"""Connected components of a link table, by label passing in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamops.llm.common import settle

SALT = 16


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", salt: int = SALT) -> DataFrame:
    """``big`` joined with ``small`` (few rows for each key): every key of
    ``big`` is spread over ``salt`` parts, so a key with a third of all rows is
    not one task's work.  Spark broadcasts ``small`` where its size allows."""
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salt)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    return spread.join(copies, [*keys, "_salt"], how).drop("_salt")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the label is the
    smallest node of its component.

    A round hooks every node to its smallest neighbour, shortens these trees to
    stars, and keeps only the links between different stars.  The trees of a
    round take as many joins as the logarithm of their depth, and every star has
    two nodes at least, so the rounds are logarithmic too; most links go in the
    first.  Each step is written to the shared folder; only whether something
    is left comes to the driver."""
    edges = settle(spark, links.select("a", "b").where("a != b").distinct(), "links")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        up = settle(spark, both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "up")
        while True:
            far = up.select(F.col("node").alias("label"), F.col("label").alias("far"))
            new = settle(spark, salted_join(up, far, ["label"]).select(
                "node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("changed")), "up")
            up = new.select("node", "label")
            if not new.where("changed").limit(1).count():
                break
        if labels is None:
            labels = up
        else:
            root = up.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = settle(spark, salted_join(labels, root, ["label"], "left").select(
                "node", F.coalesce("root", "label").alias("label")), "labels")
        la = up.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = up.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        between = salted_join(salted_join(edges, la, ["a"]), lb, ["b"]).where("la != lb")
        edges = settle(spark, between.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "links")
        if not edges.limit(1).count():
            return labels
