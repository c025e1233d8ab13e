"""Stupid-backoff scores of documents by the n-gram counts of all other documents.

1. The documents are cut into chunks of about ``chunk_chars``. Exploded n-grams are rows (hash, place): the
   64-bit hash of an n-gram, and in bits of one number a chunk that has it, its spot among the chunk's n-grams,
   and how often (a column of its own where the bits don't suffice). Counting within a chunk is the map-side sum; a frequent n-gram is one row for each chunk, however often it occurs.
2. Partitioned by hash, the rows are summed to the count table (hash, total) of the n-grams that more
   than one chunk has, and joined to it: each row gets the count that the other chunks have. Within a
   partition both are one pass over the rows in the order of their hashes, read once. An n-gram of one
   chunk only needs no row: its chunk knows its count.
3. The joined rows of a partition go back to their chunks, as a row of each chunk with lists of spots and counts,
   and meet the documents there, whose scores are summed. Lists get shorter as chunks get more, down to the n-gram rows.

The driver gets a row for each split of the input: its chunks and words, and by how many rows texts may go to Python.

The hash space is worked through in ``hash_rounds`` equal parts, and the chunks in ``chunk_rounds`` groups:
a round's shuffle is on disk only while it lasts, whatever the size of the input. Hashes deal rows evenly, and
there are as many partitions as hold ``join_rows`` each, so a task's memory is fixed.

A document's own occurrences are taken off every count, or every n-gram would be a known one. For a
word w after u, v: c(uvw) / c(uv) if c(uvw) > 0; else alpha c(vw) / c(v) if c(vw) > 0; else alpha^2
c(w) / N; a word that no other document has counts as alpha^3 / (N + 1). At the first words of a
document the n-grams are shorter, and nothing is paid for that. N: words of all other documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import batches_of, cut, drop_cut, is_scan, pin_splits, small_batches

_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_LONG = 64  # bytes; longer words are hashed one by one
_BATCH_MOST = 8 << 20  # bytes of text in a batch of several rows
_PACKED = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary#spots.list.element": "false"}  # spots are in order, so their differences are small


def _spread(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts end to end: where each ends and begins, the size of each word, where it begins, and the bytes in lower case, with eight more."""
    held = pc.fill_null(texts.cast(pa.large_string()), "")
    held = held.combine_chunks() if isinstance(held, pa.ChunkedArray) else held
    held = pa.concat_arrays(held.chunks) if isinstance(held, pa.ChunkedArray) else held
    edges = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int64)
    data = np.zeros(edges[-1] - edges[0] + 8, np.uint8)
    if len(data) > 8:
        data[:-8] = np.frombuffer(held.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    data += ((data - np.uint8(ord("A"))) < 26).view(np.uint8) << np.uint8(5)
    edges = edges - edges[0]
    solid = ((data != 0x20) & ((data - np.uint8(0x09)) > 4))[:-8]
    apart = np.zeros(len(solid) + 1, bool)  # a text begins here, so what is before is no part of a word
    apart[edges] = True
    edge = np.ones(len(solid) + 1, bool)  # at the ends of texts and beside blanks
    edge[1:-1] = apart[1:-1] | (solid[1:] != solid[:-1])
    begin = np.flatnonzero(solid & edge[:-1])
    size = np.flatnonzero(solid & edge[1:]) + 1 - begin
    return edges, size, begin, data


def _word_hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of data, which has eight more bytes at its end: eight bytes of the word at a time, mixed with its length."""
    out = size.astype(_U) * _U(0x9E3779B97F4A7C15)
    eights = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    rest = np.arange(len(size)) if len(size) and size.max() > _LONG else slice(None)
    if not isinstance(rest, slice):
        long = size > _LONG
        out[long] = [xxhash.xxh64_intdigest(data[b : b + n]) for b, n in zip(begin[long].tolist(), size[long].tolist())]
        rest = rest[~long]
    at, left = begin[rest], size[rest]
    hashes = out[rest]
    live = slice(None)  # words that have bytes left
    while len(left):
        some = eights[at] & (_U(0xFFFFFFFFFFFFFFFF) >> (_U(8) * (_U(8) - np.minimum(left, 8).astype(_U))))
        hashes[live] = _mix(hashes[live] * _U(0xD6E8FEB86659FD93) + some)
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    out[rest] = hashes
    return out


class Grams:
    """n-gram hashes at every position of some texts; position i holds the n-gram that ends there."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, order: int):
        edges, size, begin, data = _spread(texts)
        words = _word_hashes(data, begin, size)
        counts = np.diff(np.searchsorted(begin, edges))
        self.counts = counts  # words of each text
        self.doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.at = np.arange(len(words), dtype=np.int32) - np.repeat((np.cumsum(counts) - counts).astype(np.int32), counts)  # place in the text
        self.hashes = [words]
        for n in range(2, order + 1):
            longer = np.zeros_like(words)
            longer[1:] = _mix(self.hashes[-1][:-1] * _U(0x9E3779B97F4A7C15) + words[1:] + _U(n))
            self.hashes.append(longer)

    def part(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes from low to high, order after order and sorted within one, and their counts. The place in this list is an n-gram's spot."""
        found = []
        for n, h in enumerate(self.hashes):
            found.append(np.unique(h[(h >= _U(low)) & (h <= _U(high)) & (self.at >= n)], return_counts=True))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _ranges(hash_rounds: int) -> list[tuple[int, int]]:
    """First and last hash of each part of the hash space."""
    edges = [(k << 64) // hash_rounds for k in range(hash_rounds + 1)]
    return [(low, high - 1) for low, high in zip(edges, edges[1:])]


def _chunked(batches: Iterator[pa.RecordBatch], chunk_chars: int) -> Iterator[tuple[int, int, list[pa.RecordBatch]]]:
    """(block, number of the chunk there, its batches) of (block, doc_id, text): the rows of a block of a file in order, cut where chunk_chars are reached.

    A chunk is the same whenever and wherever its block is read.
    """
    now, number, held, size = None, 0, [], 0

    for b in batches:
        block, begin = b.column(0).to_numpy(), 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(b.column(2)), 0).to_pylist()):
            if block[i] != now or size >= chunk_chars:
                if i > begin:
                    held.append(b.slice(begin, i - begin))
                if held:
                    yield now, number, held
                number = number + 1 if block[i] == now else 0
                now, begin, held, size = block[i], i, [], 0
            size += n
        if begin < b.num_rows:
            held.append(b.slice(begin))
    if held:
        yield now, number, held


def score_texts(grams: Grams, others: Callable[[int, np.ndarray], np.ndarray], total_words: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the log scores of each text, and how many positions each order served (order 0: unseen words).

    others: from an order and its distinct hashes to the counts of their n-grams in the corpus less those in these texts.
    """
    order, size = len(grams.hashes), len(grams.hashes[0])
    rest = total_words - grams.counts[grams.doc]
    above, below, served = np.ones(size), rest + 1.0, np.zeros(size, np.int32)  # a score is above / below, but for alpha
    before = rest.astype(np.float64)  # counts of the contexts without the own document
    for n in range(1, order + 1):
        spots = np.flatnonzero(grams.at >= n - 1)
        own_hashes = grams.hashes[n - 1][spots]
        by_hash = np.argsort(own_hashes)
        spots, own_hashes = spots[by_hash], own_hashes[by_hash]
        del by_hash
        begin = np.flatnonzero(np.append(True, own_hashes[1:] != own_hashes[:-1])) if len(spots) else np.zeros(0, np.int64)
        counts = np.diff(np.append(begin, len(spots)))
        free = np.zeros(size)
        free[spots] = np.repeat(others(n, own_hashes[begin]) + counts - 1, counts)
        number = np.repeat(np.arange(len(begin), dtype=np.int32), counts)
        again = np.flatnonzero(counts[number] > 1)  # an n-gram of several places may occur more than once in a document
        number, spots = number[again], spots[again]
        _, back, repeats = np.unique(number * np.int64(len(grams.counts)) + grams.doc[spots], return_inverse=True, return_counts=True)
        free[spots] -= repeats[back] - 1
        has = np.flatnonzero(free > 0)
        above[has], below[has], served[has] = free[has], before[has], n
        before = np.append(0.0, free[:-1])
    log = np.log(above) - np.log(below) + (np.minimum(grams.at + 1, order) - served) * np.log(alpha)
    texts = len(grams.counts)
    return np.bincount(grams.doc, weights=log, minlength=texts), np.bincount(grams.doc * np.int64(order + 1) + served, minlength=texts * (order + 1)).reshape(texts, -1)


def join_counts(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-gram rows of a partition, a row for each n-gram and chunk, merged with the sums of their counts by hash: the sum less the row's own, and the row's number.

    Only rows of n-grams that several chunks have are joined.
    """
    by_hash = np.argsort(hashes)
    ordered = hashes[by_hash]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(ordered)))
    total = np.add.reduceat(counts[by_hash], first) if len(first) else np.zeros(0, np.int64)
    shared = size > 1
    rows = by_hash[np.repeat(shared, size)]
    return np.repeat(total[shared], size[shared]) - counts[rows], rows


def _bits(chunks: int, most_words: int, order: int, hash_rounds: int) -> tuple[int, int]:
    """Bits of a place for the spot within a chunk and for the count, below those for the chunk; 0 for the count where it doesn't fit."""
    spot, count = ((most_words * order + 1) * hash_rounds).bit_length(), most_words.bit_length()
    return spot, count if chunks.bit_length() + spot + count < 64 else 0


def _widest(sizes: list[int], most: int) -> int:
    """The largest power of two, 8192 at most, so that no such number of rows in a row has more bytes than most; 1 where single rows have more."""
    ends = np.cumsum([0, *sizes])
    rows = 8192
    while rows > 1 and (ends[rows:] - ends[:-rows]).max(initial=ends[-1] if len(ends) <= rows else 0) > most:
        rows //= 2
    return rows


def backoff_scores(
    docs: DataFrame, order: int = 3, alpha: float = 0.4, chunk_chars: int = 6 << 20, hash_rounds: int = 4, chunk_rounds: int = 4, join_rows: int = 1_500_000
) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, n_words, log_score, perplexity, seen, seen_share), a row for each row.

    Words are lower-cased (A-Z) runs of non-space. log_score: the sum over the document's words of the
    natural logs of their scores; perplexity: exp(-log_score / n_words); seen: words that an
    n-gram of the full order served; seen_share: of the words that have such an n-gram, 1 where every one of
    them occurs in another document, null where there is none. Null texts and texts without words: 0 words, log_score 0, null
    perplexity. Rows that repeat an id are documents of their own. Other columns are ignored; an empty
    table gives an empty result. The texts are read several times: docs that are more than a scan of
    files are written to the shared folder first. Two of n different n-grams share a hash with a chance of about n^2 / 2^65.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = dict(docs.dtypes)["doc_id"]
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    plain = plain if is_scan(plain) else cut(plain, "texts")
    pin_splits(spark)  # a chunk must be the same rows in every scan
    blocks = plain.select(F.xxhash64(F.input_file_name(), F.input_file_block_start()).alias("block"), "doc_id", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sizes = ["block", "chunks", "words", "rows"], []
        for block, _, own in _chunked(batches, chunk_chars):
            for b in own:
                sizes += pc.fill_null(pc.binary_length(b.column(2)), 0).to_pylist()
            words = sum(_spread(b.column(2))[1].size for b in own)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([1]), pa.array([words]), pa.array([8192])], names)
        if sizes:
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([0]), pa.array([0]), pa.array([_widest(sizes, _BATCH_MOST)])], names)

    told = blocks.mapInArrow(counted, "block bigint, chunks bigint, words bigint, rows bigint").groupBy("block")
    met = told.agg(F.sum("chunks").alias("chunks"), F.sum("words").alias("words"), F.max("words").alias("most"), F.min("rows").alias("rows")).collect()
    batch_rows = min((r.rows for r in met), default=8192)
    chunks_of = {r.block: r.chunks for r in sorted(met)}
    first = dict(zip(chunks_of, np.cumsum([0, *chunks_of.values()]).tolist()))  # number of the first chunk of each block
    total_words, total_chunks = sum(r.words for r in met), sum(chunks_of.values())
    ranges = _ranges(hash_rounds)
    spot_bits, count_bits = _bits(total_chunks, max((r.most for r in met), default=0), order, hash_rounds)
    tables_of_round = 1 + total_words * order // (hash_rounds * join_rows)  # so a task holds join_rows of n-grams on average, at most

    def exploded(part: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, number, own in _chunked(batches, chunk_chars):
                hashes, counts = Grams(pa.chunked_array([b.column(2) for b in own]), order).part(*ranges[part])
                places = np.arange(len(hashes)) * hash_rounds + part + ((first[block] + number) << spot_bits)
                columns = [hashes.view(np.int64), places << count_bits | counts] if count_bits else [hashes.view(np.int64), places, counts.astype(np.int64)]
                for at in range(0, len(hashes), 65536):
                    yield pa.RecordBatch.from_arrays([pa.array(a[at : at + 65536]) for a in columns], ["hash", "place", "n"][: len(columns)])

        return blocks.mapInArrow(run, "hash bigint NOT NULL, place bigint NOT NULL" + ", n bigint NOT NULL" * (not count_bits)).repartition(tables_of_round, "hash")

    def joined(part: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            if not held:
                return
            hashes, places, *counts = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(held[0].num_columns))
            del held
            counts = places & ((1 << count_bits) - 1) if count_bits else counts[0]
            others, rows = join_counts(hashes, counts)
            places = places[rows] >> count_bits
            by_place = np.argsort(places)  # so that a reader of some chunks skips the pages of others
            places, others = places[by_place], others[by_place]
            for at in range(0, len(places), 65536):
                chunks, spots = places[at : at + 65536] >> spot_bits, places[at : at + 65536] & ((1 << spot_bits) - 1)
                begin = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))
                ends = pa.array(np.append(begin, len(chunks)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(a)) for a in (spots, others[at : at + 65536])]
                yield pa.RecordBatch.from_arrays([pa.array(chunks[begin]), *lists], ["chunk", "spots", "others"])

        return exploded(part).mapInArrow(run, "chunk bigint NOT NULL, spots array<bigint>, others array<bigint>")

    def score(rows: pa.Table, counts: pa.Table) -> pa.Table:
        rows = rows.sort_by("spot")
        grams = Grams(rows.column("text"), order)
        spots, known = (pc.list_flatten(counts.column(c)).to_numpy() for c in ("spots", "others"))
        found = np.zeros((hash_rounds, spots.max(initial=-1) // hash_rounds + 1), np.int64)
        found[spots % hash_rounds, spots // hash_rounds] = known
        done = [0] * hash_rounds  # spots of lower orders

        def others(n: int, hashes: np.ndarray) -> np.ndarray:
            out = np.zeros(len(hashes), np.int64)
            for part, (low, high) in enumerate(ranges):
                begin, end = int(np.searchsorted(hashes, _U(low))), int(np.searchsorted(hashes, _U(high), "right"))
                some = found[part, done[part] : done[part] + end - begin]  # none at spots after the last one that is known
                out[begin : begin + len(some)] = some
                done[part] += end - begin
            return out

        log, served = score_texts(grams, others, total_words, alpha)
        words = grams.counts
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            perplexity = np.exp(-log / words)
        return pa.Table.from_arrays(
            [
                rows.column("doc_id"), pa.array(words, pa.int64()), pa.array(log, pa.float64()), pa.array(perplexity, pa.float64(), mask=words == 0), pa.array(served[:, order], pa.int64()),
                pa.array(served[:, order] / np.maximum(1, words - order + 1), pa.float64(), mask=words < order),
            ],
            ["doc_id", "n_words", "log_score", "perplexity", "seen", "seen_share"],
        )

    def scored(part: int, counts: DataFrame) -> DataFrame:
        low, high = (total_chunks * k // chunk_rounds for k in (part, part + 1))
        those = [b for b, n in first.items() if n < high and n + chunks_of[b] > low]

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, number, own in _chunked(batches, chunk_chars):
                at, chunk = 0, first[block] + number
                for b in own if low <= chunk < high else ():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b.num_rows, chunk), pa.int64()), pa.array(np.arange(at, at + b.num_rows), pa.int64()), b.column(1), b.column(2)],
                        ["chunk", "spot", "doc_id", "text"],
                    )
                    at += b.num_rows

        here = blocks.where(F.col("block").between(min(those, default=0), max(those, default=0))).mapInArrow(place, f"chunk bigint, spot bigint, doc_id {kind}, text string")
        met = counts.where((F.col("chunk") >= low) & (F.col("chunk") < high))
        return here.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(
            score, f"doc_id {kind}, n_words bigint, log_score double, perplexity double, seen bigint, seen_share double"
        )

    with batches_of(spark, batch_rows):
        tables = [cut(joined(part), "counts", _PACKED) for part in range(hash_rounds)]
        counts = tables[0]
        for more in tables[1:]:
            counts = counts.unionByName(more)
        done = [cut(scored(part, counts), "scores") for part in range(chunk_rounds)]
    for t in tables:
        drop_cut(t)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
