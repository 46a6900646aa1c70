"""Frequent itemsets and association rules.

Itemsets come from MLlib FP-growth (parallel FP-growth, no candidate
explosion).  Rules allow multi-item consequents, which grow level by level
and only while they are confident; supports are joined by the sorted items'
key.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

SEP = "\u0001"


def frequent_itemsets(baskets: DataFrame, arr: str, min_support: float) -> DataFrame:
    """(items sorted array, freq, support); support over all baskets,
    empty ones included."""
    from pyspark.ml.fpm import FPGrowth

    b = baskets.select(F.array_distinct(F.coalesce(F.col(arr), F.array().cast("array<string>"))).alias("items"))
    n = b.agg(F.count(F.lit(1)).alias("_n"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=1.0).fit(b)
    fi = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    fi = fi.crossJoin(F.broadcast(n)).select("items", "freq", (F.col("freq") / F.col("_n")).alias("support"))
    # rules look the itemsets up three times: mined once, kept as a (small) table
    return stage(fi, "itemsets")


def association_rules(itemsets: DataFrame, min_confidence: float) -> DataFrame:
    """antecedents, consequents (sorted arrays), support, confidence, lift.

    Consequents grow item by item.  Moving an item from a rule's antecedent
    to its consequent never raises the confidence, so a rule that fails has
    no successor, and only items that hold as a consequent of their own are
    added, in sorted order, which makes each consequent once.  A level is one
    join of its rules with the itemsets that are their antecedents."""
    keyed = itemsets.select(F.array_join("items", SEP).alias("_key"), "support")
    a = keyed.select(F.col("_key").alias("_ak"), F.col("support").alias("_as"))
    c = keyed.select(F.col("_key").alias("_ck"), F.col("support").alias("_cs"))

    def judged(rules: DataFrame) -> DataFrame:
        r = rules.withColumn("antecedents", F.array_except("items", "consequents")).where(F.size("antecedents") > 0)
        r = r.withColumn("_ak", F.array_join("antecedents", SEP)).join(a, "_ak")
        r = r.withColumn("confidence", F.col("support") / F.col("_as")).where(F.col("confidence") >= min_confidence)
        return stage(r.select("items", "support", "consequents", "antecedents", "confidence"), "rules")

    multi = itemsets.where(F.size("items") >= 2).select("items", "support")
    level = judged(multi.select("items", "support", F.explode("items").alias("_y")).withColumn("consequents", F.array("_y")).drop("_y"))
    # an itemset's own items, so no longer than the itemset
    single = level.groupBy("items").agg(F.sort_array(F.collect_set(F.col("consequents")[0])).alias("_single"))
    rules = level
    while not (longer := level.where(F.size("items") > F.size("consequents") + 1)).isEmpty():
        last = F.element_at("consequents", -1)
        grown = longer.join(single, "items").select(
            "items", "support", "consequents", F.explode(F.filter("_single", lambda x: x > last)).alias("_y"))
        level = judged(grown.select("items", "support", F.array_append("consequents", F.col("_y")).alias("consequents")))
        rules = rules.unionByName(level)
    return (rules.withColumn("_ck", F.array_join("consequents", SEP)).join(c, "_ck")
            .select("antecedents", "consequents", "support", "confidence", (F.col("confidence") / F.col("_cs")).alias("lift")))


def rules_summary(rules: DataFrame) -> DataFrame:
    """M18."""
    return rules.agg(F.count(F.lit(1)).alias("n_rules"), F.max("lift").alias("max_lift"))
