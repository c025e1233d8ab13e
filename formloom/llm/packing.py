"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of words.

Documents are dealt by the hash of their id into shards of about ``shard_docs``, which are packed
apart: a task holds the sizes, sources and clusters of one shard, never texts, and as many tasks work
as there are shards. No bin crosses a shard; on 10,000 documents that takes 1973 bins where one shard
takes 1963 and their words fill 1960. Within a shard, larger pieces go first. Bins are kept by what is left in them; each carries a bitmap of its sources
and one of its duplicate clusters. A piece takes the bin with the least room that holds it and is
compatible: the cluster's bit is clear, and its source is in the bin or the bin has fewer than
``max_sources`` sources. A bin that is not compatible sends the search on to the next, in the order
of what is left, until one is found or a new bin is opened.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm import simhash
from formloom.llm.common import lower_ascii, word_count


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, max_sources: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; pieces are taken in the order given. A cluster of -1 conflicts with nothing."""
    by_left: list[list[int]] = [[] for _ in range(capacity + 1)]  # residual -> bins, oldest first
    occupied = 0  # bit r is set where a bin has r left
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = 1 << source, 0 if cluster < 0 else 1 << cluster
        spot, rest = None, occupied >> size
        left = size - 1
        while rest and spot is None:
            step = (rest & -rest).bit_length()  # successor: the next residual that is occupied
            left += step
            rest >>= step
            for i, b in enumerate(by_left[left]):
                if not cluster_bits[b] & c and (source_bits[b] & s or source_bits[b].bit_count() < max_sources):
                    spot = i
                    break
        if spot is None:
            b, left = len(source_bits), capacity
            source_bits.append(0)
            cluster_bits.append(0)
        else:
            b = by_left[left].pop(spot)
            if not by_left[left]:
                occupied ^= 1 << left
        source_bits[b] |= s
        cluster_bits[b] |= c
        bins.append(b)
        offsets.append(capacity - left)
        by_left[left - size].append(b)
        occupied |= 1 << (left - size)
    return bins, offsets


def _pack_shard(rows: pd.DataFrame, capacity: int, max_sources: int) -> pd.DataFrame:
    rows = rows.sort_values(["n_words", "cluster", "doc_id", "source"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
    size = rows["n_words"].to_numpy(np.int64)
    pieces = np.maximum(1, -(-size // capacity))
    row = np.repeat(np.arange(len(rows)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = piece * capacity
    length = np.minimum(capacity, size[row] - start)
    order = np.lexsort((piece, row, -length))
    row, piece, start, length = row[order], piece[order], start[order], length[order]
    source = pd.factorize(rows["source"], use_na_sentinel=False)[0]
    code, _ = pd.factorize(rows["cluster"], use_na_sentinel=True)
    # a bit is needed only for clusters that could meet: those with two pieces, a long document's own included
    often = np.bincount(code[row][code[row] >= 0], minlength=max(1, code.max(initial=-1) + 1)) > 1
    bit = np.where(often, np.cumsum(often) - 1, -1)
    cluster = np.where(code >= 0, bit[np.maximum(code, 0)], -1)
    bins, offsets = best_fit(length.tolist(), source[row].tolist(), cluster[row].tolist(), capacity, max_sources)
    used = np.bincount(bins, weights=length, minlength=1).astype(np.int64)
    return pd.DataFrame(
        {
            "shard": rows["shard"].to_numpy()[row], "bin": np.array(bins, np.int64), "doc_id": rows["doc_id"].to_numpy()[row], "piece": piece.astype(np.int32),
            "start_word": start, "n_words": length, "bin_offset": np.array(offsets, np.int64), "bin_words": used[bins],
            "source": rows["source"].to_numpy()[row], "cluster": rows["cluster"].to_numpy()[row],
        }
    )


def items(docs: DataFrame, near: bool = False) -> DataFrame:
    """docs(doc_id, text, source, ...) -> what packing needs of each row: (doc_id, n_words, source, cluster).

    The cluster is a hash of the lower-cased text: rows with the same text are one cluster. With near it
    is the component of operator 3, simhash.near_duplicates: near copies are one cluster too. Rows without
    words, null texts among them, have a null cluster.
    """
    text = F.col("text").cast("string")
    sized = docs.select("doc_id", text.alias("text"), word_count(text).alias("n_words"), F.col("source").cast("string").alias("source"), F.xxhash64(lower_ascii(text)).alias("cluster"))
    if near:
        found = simhash.near_duplicates(sized.drop("cluster"), carry=["n_words", "source"])
        # a component without any id is known by its members' fingerprints
        sized = found.withColumn("cluster", F.when(F.col("component_id").isNotNull(), F.xxhash64(F.lit("component"), "component_id")).otherwise(F.xxhash64("fingerprint")))
    return sized.select("doc_id", "n_words", "source", F.when(F.col("n_words") > 0, F.col("cluster")).alias("cluster"))


def pack(rows: DataFrame, n_rows: int, capacity: int = 2048, max_sources: int = 4, shard_docs: int = 2048) -> DataFrame:
    """rows(doc_id, n_words, source, cluster) -> a row for each piece of each row.

    (shard, bin, doc_id, piece, start_word, n_words, bin_offset, bin_words, source, cluster): words
    start_word to start_word + n_words of the document lie at bin_offset of the bin, which bin_words
    words fill. Documents over the capacity are cut into pieces of it and a last one; all words of all
    documents are packed once. Documents without words are a piece of 0. A null cluster conflicts with
    nothing, a null source is a source. No two pieces of a cluster share a bin. n_rows sets the number
    of shards. Repeated rows are packed apart. An empty table gives an empty result.
    """
    shards = max(1, -(-n_rows // shard_docs))
    kind = dict(rows.dtypes)["doc_id"]
    # rows without an id and without words would all be dealt alike
    salt = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", F.lit(11), salt), F.lit(shards)).cast("int"))
    # nullable ids and clusters must not become floats on their way through pandas
    ids = dealt.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("cluster", F.col("cluster").cast("string"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _pack_shard(group, capacity, max_sources)

    out = ids.groupBy("shard").applyInPandas(
        run, "shard int, bin long, doc_id string, piece int, start_word long, n_words long, bin_offset long, bin_words long, source string, cluster string"
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("cluster", F.col("cluster").cast("long"))
