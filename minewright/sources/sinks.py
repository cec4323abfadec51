"""Writers: sorted lists, statistics, keyed pages, splits, run results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from minewright.operators.sampling import running_buckets


def write_lines(rows: DataFrame, column: str, path: str) -> None:
    """Distinct values, sorted, a line each."""
    rows.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct().orderBy("value").write.mode("overwrite").text(path)


def write_domain_stats(counts: DataFrame, path: str) -> None:
    """``Domain, Count, Percentage`` by count; the percentage is of the counts' sum."""
    total = counts.agg(F.sum("n_urls").alias("total"))
    rows = counts.join(F.broadcast(total)).orderBy(F.desc("n_urls"), "domain")  # one row
    rows.select(F.col("domain").alias("Domain"), F.col("n_urls").alias("Count"), F.format_string("%.2f%%", 100.0 * F.col("n_urls") / F.col("total")).alias("Percentage")).write.mode("overwrite").option("header", True).csv(path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages under the first and the second byte of their URL's digest."""
    key = F.md5("url")
    keyed = pages.withColumn("key", key).withColumn("p1", F.substring(key, 1, 2)).withColumn("p2", F.substring(key, 3, 2))
    keyed.write.mode("overwrite").partitionBy("p1", "p2").json(path)


def write_inline_images(images: DataFrame, page: str, uri: str, path: str) -> None:
    """A record for each page with its distinct inline images, in order."""
    images.where(F.col(uri).isNotNull()).groupBy(page).agg(F.array_sort(F.collect_set(uri)).alias("images")).write.mode("overwrite").json(path)


def write_page_items(items: DataFrame, page: str, valid: str, path: str) -> None:
    """A record for each page with its valid items; a page without any gets none."""
    rest = [c for c in items.columns if c not in (page, valid)]
    items.where(F.col(valid)).groupBy(page).agg(F.collect_list(F.struct(*rest)).alias("qa_items")).write.mode("overwrite").json(path)


def write_submission(answers: DataFrame, key: str, value: str, order: str, path: str) -> None:
    """One answer for each key, the last in order."""
    answers.groupBy(key).agg(F.max_by(value, order).alias(value)).orderBy(key).write.mode("overwrite").json(path)


def write_dataset(rows: DataFrame, split: str, schema: str, path: str) -> None:
    """Rows cast to a dataset's schema, a folder for each split; a column that the schema lacks does not go along."""
    types = StructType.fromDDL(schema)
    typed = rows.select(split, *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in types.fields if f.name != split])
    typed.write.mode("overwrite").partitionBy(split).parquet(path)


def write_split(rows: DataFrame, valid: str, path: str) -> None:
    """Valid and invalid rows side by side, and their counts."""
    rows.where(F.col(valid)).write.mode("overwrite").json(f"{path}/valid")
    rows.where(~F.coalesce(F.col(valid), F.lit(False))).write.mode("overwrite").json(f"{path}/invalid")
    rows.groupBy(valid).count().write.mode("overwrite").json(f"{path}/stats")


def write_alignment(rows: DataFrame, key: str, path: str) -> None:
    """Aligned records without the old answer, in order of their key."""
    rows.drop("answer").orderBy(key).write.mode("overwrite").json(path)


def results_table(results: DataFrame) -> str:
    """A Markdown table of ``task, filter, metric, value, stderr``; for results, which are few."""
    head = ["Task", "Filter", "Metric", "Value", "Stderr"]
    rows = results.select("task", "filter", "metric", "value", "stderr").orderBy("task", "filter", "metric").collect()
    number = lambda x: "N/A" if x is None else f"{x:.4f}"
    lines = [head, ["---"] * 5, *([r.task, r["filter"], r.metric, number(r.value), number(r.stderr)] for r in rows)]
    return "\n".join("| " + " | ".join(map(str, line)) + " |" for line in lines)


def flat_metrics(results: DataFrame) -> DataFrame:
    """``task/metric`` keys without a trailing ``,none``."""
    return results.select(F.concat_ws("/", "task", F.regexp_replace("metric", ",none$", "")).alias("key"), "value")


def split_metrics(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbers to log and texts for the summary, of results whose ``value`` is text; keys as in ``flat_metrics``."""
    flat = flat_metrics(results).withColumn("number", F.col("value").try_cast("double"))
    return flat.where("number IS NOT NULL").select("key", F.col("number").alias("value")), flat.where("number IS NULL AND value IS NOT NULL").select("key", "value")


def write_samples(samples: DataFrame, task: str, order: str, path: str) -> None:
    """A folder of JSON lines for each task, in order within a file; each line has the digest of the row's other columns."""
    rest = [c for c in samples.columns if c != task]
    hashed = samples.withColumn("sample_hash", F.sha2(F.to_json(F.struct(*rest)), 256))
    hashed.repartitionByRange(task, order).sortWithinPartitions(task, order).write.mode("overwrite").partitionBy(task).json(path)


def write_parts(rows: DataFrame, order: str, size: str, limit: int, path: str) -> None:
    """Rows in order in parts, a folder each, that are cut where the running size passes a multiple of ``limit``."""
    running_buckets(rows.withColumn("_all", F.lit(0)), ["_all"], order, size, limit).drop("_all").withColumnRenamed("bucket", "part").write.mode("overwrite").partitionBy("part").json(path)
