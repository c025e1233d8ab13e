"""URL filters by dated lists: every capture against the entries active when it was fetched.

Entries say from when a list holds a pattern and from when it does not. They become validity
intervals [valid_from, valid_to), disjoint for each list and pattern. The as-of join meets captures and
intervals by pattern, with the times as a condition of the join: each capture finds, for each pattern of
its URL, the intervals it lies in. No interval is copied. A pattern that a third of all captures have is a
skewed key of a merge join, whose captures Spark deals to several tasks, each with the pattern's intervals.
A pattern is a domain (``example.com``: the host and all below it) or a domain with a path
(``example.com/a``: what lies at or below that path on just that host). Patterns are normalised as URLs
are: scheme, user, port, query, fragment, ``*.`` before and dots and slashes at the end make no difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; null where the URL has none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    clean = F.regexp_replace(host, r"\.+$", "")
    return F.when(clean != "", clean)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^:]+://[^/?#]*(/[^?#]*)", 1)


def _segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda p: p != "")


def pattern_of(written: Column) -> Column:
    """A list's pattern in its one form, host/segment/segment in lower case; null where it has no host."""
    bare = F.regexp_replace(F.lower(F.trim(written)), r"^[a-z][a-z0-9+.\-]*://", "")
    bare = F.regexp_extract(F.regexp_replace(bare, r"^[^/?#@]*@", ""), r"^([^?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^([^/:]*)", 1), r"^(\*?\.)+", ""), r"\.+$", "")
    return F.when((host != "") & (host != "*"), F.array_join(F.concat(F.array(host), _segments(F.regexp_extract(bare, r"^[^/]*(/.*)$", 1))), "/"))


def intervals(entries: DataFrame) -> DataFrame:
    """entries(list, verdict, pattern, since, action) -> (list, verdict, pattern, valid_from, valid_to).

    action is ``add`` or ``remove``. Of entries for one list and pattern at one time, a removal wins;
    repeated entries change nothing. Rows with a null in any of the five columns, or a pattern without a host, are ignored.
    """
    known = entries.select("list", "verdict", pattern_of(F.col("pattern")).alias("pattern"), "since", "action").dropna()
    one = known.groupBy("list", "pattern", "since").agg(F.max(F.struct("action", "verdict")).alias("x"))
    order = Window.partitionBy("list", "pattern").orderBy("since")
    return (
        one.select("list", "pattern", "x.verdict", "x.action", F.col("since").alias("valid_from"), F.lead("since").over(order).alias("valid_to"))
        .where("action = 'add'").drop("action")
    )


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures(page_id, url, fetched_at, ...) -> a row for each row, with
    (page_id, url, fetched_at, host, denied_by, allowed_by, verdict).

    denied_by, allowed_by: the lists, in order and joined by commas, with an entry for the URL that was
    active at fetched_at; empty where none. verdict: ``drop`` where a list denies and none allows, else
    ``keep``; ``invalid`` for URLs that are null or without a host. A capture without a time meets no
    list. Repeated rows stay repeated; other columns are ignored. Empty lists keep everything.
    """
    rows = captures.select("page_id", "url", "fetched_at").withColumn("host", host_of(F.col("url")))
    spans = intervals(entries)
    # no pattern has more parts than the longest of the lists: longer keys of a URL could meet nothing
    deepest = spans.agg(F.max(F.size(F.split("pattern", r"[./]")))).first()[0] or 0
    labels, host = F.split("host", r"\."), F.col("host")
    parts = F.slice(_segments(path_of(F.col("url"))), 1, max(1, deepest))
    domains = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(labels) - max(0, deepest - 1)), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.when(
        F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.lower(F.array_join(F.slice(parts, 1, i), "/"))))
    ).otherwise(F.array().cast("array<string>"))
    distinct = rows.select("url", "fetched_at", "host").where("host is not null and fetched_at is not null").distinct()
    keys = distinct.select("url", "fetched_at", F.explode(F.array_distinct(F.concat(domains, prefixes))).alias("pattern"))
    inside = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    met = keys.join(spans.withColumnRenamed("pattern", "listed").hint("merge"), (F.col("pattern") == F.col("listed")) & inside)
    names = lambda verdict: F.array_join(F.sort_array(F.collect_set(F.when(F.col("verdict") == verdict, F.col("list")))), ",")
    hits = met.groupBy("url", "fetched_at").agg(names("deny").alias("denied_by"), names("allow").alias("allowed_by"))
    out = rows.join(hits, ["url", "fetched_at"], "left")
    denied, allowed = F.coalesce("denied_by", F.lit("")), F.coalesce("allowed_by", F.lit(""))
    verdict = F.when(F.col("host").isNull(), "invalid").when((denied != "") & (allowed == ""), "drop").otherwise("keep")
    return out.select("page_id", "url", "fetched_at", "host", denied.alias("denied_by"), allowed.alias("allowed_by"), verdict.alias("verdict"))
