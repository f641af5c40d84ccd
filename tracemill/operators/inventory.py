"""What a corpus holds: events with their durations, and how often and as what each property occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .parse import is_json_number


def of_events(raw: DataFrame) -> DataFrame:
    """A row an event: n, mean and largest duration, and the collections that have it, if ``collection`` is a column."""
    duration = F.col("duration").cast("decimal(20,0)")
    # avg of a decimal is rounded to four places, the exact sum over the count is not
    mean = F.sum(duration).cast("double") / F.count(duration)
    sums = [F.count("*").alias("n"), mean.alias("avg_us"), F.max(duration).alias("max_us")]
    if "collection" in raw.columns:
        sums.append(F.array_sort(F.collect_set("collection")).alias("collections"))
    return raw.groupBy("event").agg(*sums)


def of_properties(raw: DataFrame) -> DataFrame:
    """A row an event and property: in how many events it is present, the share in percent, and its type.

    ``type`` is number if all values are written as numbers, else string; a name repeated in an event counts once, with
    its first value.  One pass: a row without a name stands for the event itself.
    """
    names = F.col("props")["name"]
    first = F.filter("props", lambda p, i: F.array_position(names, p["name"]) == i + 1)
    seen = F.transform(first, lambda p: F.struct(p["name"].alias("name"), is_json_number(p).alias("number")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(False).alias("number")))
    rows = raw.select("event", F.inline(F.concat(whole, seen)))
    sums = rows.groupBy("event", "name").agg(F.count("*").alias("present"), F.bool_and("number").alias("numbers"))
    sums = sums.withColumn("n", F.expr("max(if(name IS NULL, present, NULL)) OVER (PARTITION BY event)")).filter("name IS NOT NULL")
    kind = F.when(F.col("numbers"), "number").otherwise("string")
    return sums.select("event", "name", "present", (100 * F.col("present") / F.col("n")).alias("pct"), kind.alias("type"))
