"""The unique contexts of events' texts: cut by the parity of quotes, counted, and written as a numbered report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .parse import once

#: The property's beginning, and the texts of the report.
START = ",Context="
HEADLINE, SEEN = "Список уникальных контекстов с количеством:", "(встречается {} раз)"


def first_contexts(events: DataFrame, body: str = "body") -> DataFrame:
    """Events that have one, with ``context``: the first quoted Context outside quotes, without carriage returns.

    A text cut at its quotes has what is outside them at even places, and an empty piece between doubled ones.  A value
    that isn't closed, or is empty, is none.
    """
    rest = [c for c in events.columns if c not in (body, "context")]
    step = events.filter(F.contains(F.col(body), F.lit(START + "'"))).select(*rest, once(_cut=F.split(F.col(body), "'")))
    piece = lambda k: F.get("_cut", k)
    last = F.size("_cut") - 1
    outside = F.sequence(F.lit(0), last, F.lit(2))
    step = step.select(*rest, "_cut", once(_outside=outside))
    begin = F.get(F.filter("_outside", lambda k: piece(k).endswith(START) & (k < last)), F.lit(0))
    step = step.select(*rest, "_cut", "_outside", once(_begin=begin)).filter("_begin IS NOT NULL")
    end = F.get(F.filter("_outside", lambda k: (k > F.col("_begin")) & ((piece(k) != "") | (k == last))), F.lit(0))
    step = step.select(*rest, "_cut", "_begin", once(_end=end)).filter("_end IS NOT NULL")
    inside = F.transform(F.sequence(F.col("_begin") + 1, F.col("_end") - 1, F.lit(2)), piece)
    text = F.replace(F.array_join(inside, "'"), F.lit("\r"), F.lit(""))
    return step.select(*rest, once(context=text)).filter("context <> ''")


def unique_contexts(events: DataFrame, body: str = "body") -> DataFrame:
    """context and n, the most frequent first, equal ones by text."""
    return first_contexts(events, body).groupBy("context").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "context")


def write_report(contexts: DataFrame, path: str) -> int:
    """``unique_contexts`` as one numbered local text; a partition at a time comes to the driver.  Returns how many."""
    k = 0
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        f.write(f"{HEADLINE}\n{'=' * 80}\n")
        for k, row in enumerate(contexts.toLocalIterator(), 1):
            f.write(f"\n{k}. {SEEN.format(row.n)}\n{row.context}\n{'-' * 80}\n")
    return k
