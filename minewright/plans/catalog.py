"""Registered queries: each a Spark plan with, where SQL can say it, its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None = None


CATALOG: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` function under ``name``."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        assert name not in CATALOG, name
        CATALOG[name] = Query(run, oracle)
        return run

    return add


from minewright.plans import answers, extras, grading, joins, lookups, pages, replies, sampling, scores, texts, urls  # noqa: E402,F401  register on import

#: Other names of queries: forms that once read a part of their table or text, which now do the whole job.
ALSO = {
    "exact_match_norm": "exact_match_turns",
    "token_f1": "token_f1_turns",
    "jaccard": "jaccard_turns",
    "image_mark_first": "image_mark_whole",
    "filter_regex": "filter_regex_all",
    "filter_chain": "filter_chain_all",
    "majority_vote": "majority_vote_all",
    "consensus_accuracy": "consensus_accuracy_all",
    "fuzzy_name_match": "fuzzy_name_match_all",
    "near_match": "near_names",
}
CATALOG.update({name: CATALOG[of] for name, of in ALSO.items()})
