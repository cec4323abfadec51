"""Queries of reply parsing and instruction checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.functions import choices, instructions
from minewright.plans.catalog import query
from minewright.staging import table


@query("instruction_checks", r"""
WITH c AS (SELECT role, [len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) >= 60, NOT contains(text, ','), length(text) - length(replace(lower(text), 'e', '')) >= 40] AS s FROM conversations)
SELECT role, avg(CASE WHEN s[1] AND s[2] AND s[3] THEN 1.0 ELSE 0.0 END) AS prompt_accuracy, avg((CAST(s[1] AS INTEGER) + CAST(s[2] AS INTEGER) + CAST(s[3] AS INTEGER)) / 3.0) AS instruction_accuracy FROM c GROUP BY role""")
def instruction_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict accuracy by prompt and by instruction."""
    asked = [("number_words_unicode", {"n": 60}), ("no_commas", {}), ("letter_frequency", {"letter": "e", "n": 40})]
    f = instructions.followed(F.col("text"), asked)["strict"]
    rows = table(spark, sf_dir, "conversations").select("role", f.alias("s"))
    right = F.size(F.filter("s", lambda x: x))
    return rows.groupBy("role").agg(F.avg(F.forall("s", lambda x: x).cast("double")).alias("prompt_accuracy"), F.avg(right / 3).alias("instruction_accuracy"))


@query("choice_parse")
def choice_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices read from replies that name a letter, an option's text, or nothing."""
    options = F.array("c_mktsegment", F.lit("nothing of it"), F.lit("all of it"))
    reply = F.when(F.col("c_custkey") % 3 == 0, "I say (B)").when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("it is more or less of the kind "), F.lower("c_mktsegment"))).otherwise("who knows")
    return table(spark, sf_dir, "customer").select("c_custkey", choices.choice(reply, options, F.col("c_custkey")).alias("choice"))
