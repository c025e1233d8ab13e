"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import cut, drop_cut


_SHARES = 256
_FEW = 64


def connected(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """links(u, v) -> (node, root): root is the smallest node of the component.

    Nodes without a link to another node are absent from the result; loops and
    nulls are ignored. Every round is a few joins and group-bys on the links alone:
    the number of links never grows, and each round's table is written to the shared
    folder, so that a lost executor costs one round at most. Only a row count and a
    checksum reach the driver; of the links' tables only the hubs, _SHARES at most, are broadcast.
    """
    edges = cut(
        links.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(),
        "links",
    )
    mark = _mark(edges)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        # the hub of a large component is dealt to several tasks: at most _SHARES nodes have so many of the links
        most = max(_FEW, -(-2 * mark[0] // _SHARES))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.ceil(F.count("*") / most).cast("int").alias("deal"))
        hubs = F.broadcast(least.where("deal > 1").select("u", "deal"))
        ends = both.join(hubs, "u", "left").select("u", "v", F.pmod(F.xxhash64("v"), F.coalesce("deal", F.lit(1))).cast("int").alias("salt"))
        dealt = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.col("deal") - 1)).alias("salt"))
        large = (
            ends.join(dealt.hint("merge"), ["u", "salt"]).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        )
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(low.hint("merge"), "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").union(low).distinct()
        )
        new = cut(small, "links")
        new_mark = _mark(new)
        drop_cut(edges)
        edges, done, mark = new, new_mark == mark, new_mark
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    return row[0], row[1]
