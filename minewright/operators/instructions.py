"""Instruction following where each row brings its own checks and arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minewright.functions.instructions import ROW_CHECKS, Arguments, bare, readings


def row_instructions(rows: DataFrame, key: list[str], reply: str, names: str, arguments: str, prompt: str | None = None, detected: str | None = None) -> DataFrame:
    """``key, at, instruction, strict, loose``: a row for each instruction of each of ``rows``, whose ``key`` is unique.

    ``names`` is an array of check names, ``arguments`` a JSON object for each.  Arguments that are null, false, zero or
    empty count as not given.  A reply follows loosely if any of its eight readings follows; a blank or null one never
    does.  An unknown name is an error.  ``detected`` is the reply's language, if something has told it.
    """
    null = F.lit(None).cast("string")
    given = rows.select(
        *key, F.coalesce(F.col(reply), F.lit("")).alias("_reply"), (F.col(prompt) if prompt else null).alias("_prompt"), (F.col(detected) if detected else null).alias("_detected"),
        F.posexplode(F.arrays_zip(F.col(names).alias("name"), F.col(arguments).alias("args"))).alias("at", "_asked"))
    read = given.select("*", F.posexplode(F.array(*readings(F.col("_reply")))).alias("_reading", "_text"))
    args = Arguments(F.map_filter(F.from_json("_asked.args", "map<string,string>"), lambda k, v: v.isNotNull() & ~v.isin("", "0", "false", "[]", "{}")), F.col("_prompt"), F.col("_detected"))
    name = F.col("_asked.name")
    ok = None
    for known, check in ROW_CHECKS.items():
        ok = F.when(name == known, check(F.col("_text"), args)) if ok is None else ok.when(name == known, check(F.col("_text"), args))
    ok = F.coalesce((bare(F.col("_text")) != "") & ok.otherwise(F.raise_error(F.concat(F.lit("unknown instruction "), F.coalesce(name, F.lit("null")))).cast("boolean")), F.lit(False))
    # A row's readings come from one task, so all but one row for each instruction goes before the shuffle.
    judged = read.select(*key, "at", name.alias("instruction"), "_reading", ok.alias("_ok"))
    return judged.groupBy(*key, "at", "instruction").agg(F.bool_or(F.col("_ok") & (F.col("_reading") == 0)).alias("strict"), F.bool_or("_ok").alias("loose"))


def instruction_accuracy(judged: DataFrame, key: list[str], by: list[str] | None = None) -> DataFrame:
    """Shares of prompts with all instructions followed, and of instructions followed, read strictly and loosely."""
    by = by or []
    rows = judged.groupBy(*key, *[b for b in by if b not in key]).agg(*[f(F.col(c).cast(t)).alias(f"{c}_{n}") for c in ("strict", "loose") for n, f, t in (("all", F.bool_and, "boolean"), ("sum", F.sum, "long"))], F.count(F.lit(1)).alias("_n"))
    return rows.groupBy(*by).agg(
        *[F.avg(F.col(f"{c}_all").cast("double")).alias(f"prompt_{c}") for c in ("strict", "loose")],
        *[F.try_divide(F.sum(f"{c}_sum"), F.sum("_n")).alias(f"instruction_{c}") for c in ("strict", "loose")])
