"""SimHash near-duplicates: 64-bit fingerprints, bit-sliced comparison, components.

1. Fingerprints. Arrow batches, whole texts: the shingles of a text are byte slices of
   its normalised form, hashed with XXH64, and the bits are counted in numpy.
2. Candidates. Distinct fingerprints only. Two fingerprints within radius r agree on at
   least m - r of m equal bit blocks, so each goes to one bucket for each choice of m - r
   blocks; every pair within the radius meets in a bucket. Buckets of one are dropped by
   a count. A bucket over ``bucket_rows`` is dealt into s parts, and every two parts meet
   in a group of their own: any size is covered, and a task holds two parts at most.
3. Comparison. The fingerprints of a batch of buckets are stored as 64 bit planes. For
   each distance d between positions, the planes are XORed with themselves moved by d,
   and carry-save counters add the differences of 64 pairs at a time; words in which all
   pairs are over the radius are abandoned. Links that join nothing new are not emitted,
   so that a bucket of n gives n - 1 links at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import cut, drop_cut, slices, small_batches
from formloom.llm.components import connected

BITS = 64
_HOT_SHARE = 256
_HASHES_AT_ONCE = 1 << 15
_TO_SPACE = bytes(0x20 if 0x09 <= i <= 0x0D else i for i in range(256))


def _flat(text: str | None) -> bytes:
    """The words of a text as shingles have them, a space between two; equal ones are one text."""
    plain = (text or "").encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE)
    blank = np.frombuffer(plain, np.uint8) == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]  # the first of several spaces
    return np.frombuffer(plain, np.uint8)[keep].tobytes().strip(b" ")


def _spans(flat: bytes, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the shingles of a flat text begin and end; none for one without a word."""
    if not flat:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20), len(flat))
    if len(ends) <= words:
        return np.array([0]), np.array([len(flat)])
    starts = np.append(0, ends[:-1] + 1)
    return starts[: len(ends) - words + 1], ends[words - 1 :]


def _hashes(flat: bytes, words: int) -> Iterator[np.ndarray]:
    """XXH64 of the shingles in order, some at a time."""
    first, last = _spans(flat, words)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), _HASHES_AT_ONCE):
        some = slice(at, at + _HASHES_AT_ONCE)
        yield np.array([digest(flat[a:b], 42) for a, b in zip(first[some].tolist(), last[some].tolist())], np.uint64)


def _majority(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash of one text; 0 for null and for texts without a word."""
    counts, n = np.zeros(BITS, np.int64), 0
    for hashes in _hashes(_flat(text), words):
        counts += _bit_counts(hashes)
        n += len(hashes)
    return _majority(counts, n)


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted (uint64); none for texts without a word."""
    parts = list(_hashes(_flat(text), words))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets of shingles; two empty ones are the same."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def fingerprints(docs: DataFrame, words: int = 3, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, fp, the columns of carry): fp is the fingerprint as a signed long; one row for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *carry])

    small_batches(docs.sparkSession)
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"), *carry)
    kinds = dict(docs.dtypes)
    return picked.mapInArrow(run, ", ".join([f"doc_id {kinds['doc_id']}", "fp bigint", *(f"{c} {kinds[c]}" for c in carry)]))


def hex_of(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def links(distinct: DataFrame, radius: int = 2, blocks: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """distinct(fp) -> (u, v): links within buckets that span all pairs within the radius."""
    if not 0 <= radius < blocks or BITS % blocks:
        raise ValueError("blocks must divide 64 and exceed the radius")
    width = BITS // blocks
    mask = (1 << width) - 1
    parts = [F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit(mask).cast("long")) for i in range(blocks)]
    keys = [
        F.struct(F.lit(t).alias("t"), F.xxhash64(F.concat_ws(",", *(parts[i] for i in pick))).alias("key"))
        for t, pick in enumerate(combinations(range(blocks), blocks - radius))
    ]
    spread = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")
    sizes = spread.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    dealt = _dealt(spread, sizes, F.ceil(F.col("n") / bucket_rows), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, firsts in _buckets(batches, 5):
            yield _out(spanning_links(cols[4], firsts, radius))

    return _sorted(dealt, "fp").mapInArrow(run, "u bigint, v bigint")


_GROUP = ["t", "key", "p", "q"]


def _dealt(spread: DataFrame, sizes: DataFrame, deal: Column, node: str) -> DataFrame:
    """spread(t, key, node) in the buckets of sizes(t, key, ...) -> (t, key, p, q, node): a group for every two of deal parts."""
    own = F.pmod(F.xxhash64(node, F.lit(7)), F.col("deal")).cast("int")
    others = F.sequence(F.lit(0), F.col("deal") - 1)
    pairs = F.transform(others, lambda o: F.struct(F.least(o, F.col("own")).alias("p"), F.greatest(o, F.col("own")).alias("q")))
    # with two parts or more, a part also meets itself within each of its groups
    one = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("q")))
    return (
        spread.join(sizes, ["t", "key"])
        .withColumn("deal", deal.cast("int"))
        .withColumn("own", own)
        .select("t", "key", node, F.explode(F.when(F.col("deal") > 1, F.filter(pairs, lambda x: x.p != x.q)).otherwise(one)).alias("g"))
        .select("t", "key", "g.p", "g.q", node)
    )


def _sorted(dealt: DataFrame, *then: str) -> DataFrame:
    return dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP, *then)


def _buckets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Whole groups of sorted rows: the columns, and where each group begins."""
    left: list[np.ndarray] | None = None
    for b in batches:
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(width)]
        if left is not None:
            cols = [np.concatenate(x) for x in zip(left, cols)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
        last = int(new[-1]) if len(new) else 0
        if last:
            yield [c[:last] for c in cols], np.concatenate(([0], new[:-1]))
        left = [c[last:] for c in cols]
    if left is not None and len(left[0]):
        yield left, np.array([0])


def _out(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["u", "v"])


def spanning_links(values: np.ndarray, firsts: np.ndarray, radius: int) -> np.ndarray:
    """values: fingerprints (int64), bucket after bucket; firsts: where each bucket begins.

    Returns links (n, 2) that connect, within each bucket, what chains of pairs within
    the radius connect.
    """
    return values[_spanning(values, firsts, radius)]


def _spanning(values: np.ndarray, firsts: np.ndarray, radius: int, same: Callable[[int, int], bool] | None = None) -> np.ndarray:
    """Links as positions in values; with ``same``, pairs within the radius count only where it holds."""
    n = len(values)
    sizes = np.diff(np.append(firsts, n))
    order = np.argsort(-sizes, kind="stable")  # larger buckets first: later passes look at the front only
    at = np.concatenate([np.arange(firsts[i], firsts[i] + sizes[i]) for i in order]) if n else np.zeros(0, int)
    values, sizes = values[at], sizes[order]
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.cumsum(sizes)
    words = n // 64 + 2
    bits = np.zeros((BITS, words * 64), np.uint8)
    bits[:, :n] = np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    root = np.arange(n)
    found: list[tuple[int, int]] = []
    open_parts = sizes - 1  # merges that a bucket still lacks

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    for d in range(1, int(sizes.max(initial=1))):
        live = (sizes > d) & (open_parts > 0)
        if not live.any():
            break
        until = int(ends[np.flatnonzero(live)[-1]])
        for i in _within(planes, d, until, radius):
            if i + d < until and bucket[i] == bucket[i + d]:
                a, b = top(int(i)), top(int(i + d))
                if a != b and (same is None or same(int(at[i]), int(at[i + d]))):
                    root[max(a, b)] = min(a, b)
                    open_parts[bucket[i]] -= 1
                    found.append((int(i), int(i + d)))
    return at[np.array(found, np.int64).reshape(-1, 2)]


def _within(planes: np.ndarray, d: int, until: int, radius: int) -> np.ndarray:
    """Positions i < until whose fingerprint is within the radius of the one at i + d."""
    used = -(-until // 64)
    skip, turn = divmod(d, 64)
    have = planes.shape[1]
    moved = np.zeros((BITS, used + 1), np.uint64)
    take = max(0, min(used + 1, have - skip))
    moved[:, :take] = planes[:, skip : skip + take]
    if turn:
        moved = (moved[:, :-1] >> np.uint64(turn)) | (moved[:, 1:] << np.uint64(64 - turn))
    else:
        moved = moved[:, :-1]
    keep = np.arange(used)
    differ = planes[:, :used] ^ moved
    width = int(radius + 1).bit_length()
    digits = [np.zeros(used, np.uint64) for _ in range(width)]
    over = np.zeros(used, np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for p in range(BITS):
        carry = differ[p]
        for k in range(width):  # carry-save: add one bit to 64 counters at once
            digits[k], carry = digits[k] ^ carry, digits[k] & carry
        over |= carry
        if p % 8 == 7:
            over |= _above(digits, radius)
            alive = over != full
            if not alive.all():
                if not alive.any():
                    return np.zeros(0, np.int64)
                differ, keep, over = differ[:, alive], keep[alive], over[alive]
                digits = [x[alive] for x in digits]
    ok = ~over
    bits = np.unpackbits(ok.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(bits)
    hits = keep[w] * 64 + b
    return hits[hits < until]


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Bits that are set where the counter exceeds the radius."""
    more, same = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for k in range(len(digits) - 1, -1, -1):
        if radius >> k & 1:
            same = same & digits[k]
        else:
            more = more | (same & digits[k])
            same = same & ~digits[k]
    return more


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, blocks: int = 4, bucket_rows: int = 4096, carry: Sequence[str] = ()) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, fingerprint, component_id, the columns of carry), a row for each row.

    fingerprint: 16 lowercase hex digits, all zero for null texts and texts without words,
    which are linked like others. component_id: the smallest doc_id that links of at most
    ``radius`` differing bits reach; null where all ids of the component are null. Repeated
    rows stay repeated. An empty table gives an empty result; other columns are ignored.
    """
    prints = cut(fingerprints(docs, words, carry), "fingerprints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "distinct")
    roots = connected(links(distinct.select("fp"), radius, blocks, bucket_rows))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    leaders = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    groups = rooted.join(leaders, "root").select("fp", "component_id")
    # a fingerprint with a share of the rows, as that of empty texts, is dealt to several tasks; there are _HOT_SHARE of them at most
    total = prints.count()
    least = max(1000, -(-total // _HOT_SHARE))
    hot = F.broadcast(distinct.where(F.col("n") >= least).select("fp", F.ceil(F.col("n") / least).cast("int").alias("deal")))
    deal = F.coalesce("deal", F.lit(1))
    dealt = groups.join(hot, "fp", "left").select("fp", "component_id", F.explode(F.sequence(F.lit(0), deal - 1)).alias("salt"))
    salted = prints.join(hot, "fp", "left").select("doc_id", "fp", *carry, F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), deal).cast("int").alias("salt"))
    return salted.join(dealt.hint("merge"), ["fp", "salt"]).select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id", *carry)


_HEAD = 32


def _keyed(docs: DataFrame) -> DataFrame:
    """docs -> (doc_id, text, head, text_hash): the last two stand for the text where rows are compared."""
    text = F.col("text").cast("string")
    small_batches(docs.sparkSession)
    return docs.select("doc_id", text.alias("text"), F.substring(text, 1, _HEAD).alias("head"), F.xxhash64(text).alias("text_hash"))


def survivors(docs: DataFrame, prints: DataFrame, roots: DataFrame) -> DataFrame:
    """prints(doc_id, head, text_hash, node) of docs' rows, roots(node, root) -> the first row of docs of each component.

    Nodes without a root are components of their own. First is the smallest id, nulls last, then the
    text (its first characters, then its hash). Texts stay where they are until all but the survivors
    are gone: rows meet the keys of the survivors, and only rows that repeat an id and text meet again.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "head", "text_hash")
    least = prints.groupBy("node").agg(F.min(order).alias("first")).join(roots.hint("merge"), "node", "left")
    first = least.groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select("first.*")

    def key(df: DataFrame, text_hash: Column) -> list[Column]:
        i = df["doc_id"]
        return [i.isNull().alias("_formloom_no_id"), F.coalesce(i.cast("string"), F.lit("")).alias("_formloom_id"), text_hash.alias("_formloom_hash")]

    kept = first.select(*key(first, first["text_hash"])).distinct()
    rows = docs.select(*key(docs, F.xxhash64(docs["text"].cast("string"))), F.struct(*docs.columns).alias("_formloom_row"))
    found = rows.join(kept.hint("merge"), kept.columns, "left_semi")
    return found.groupBy(*kept.columns).agg(F.min("_formloom_row").alias("_formloom_row")).select("_formloom_row.*")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2, blocks: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """The rows of docs without near copies: of each component of near_duplicates the first, see survivors."""
    keyed = _keyed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(found.view(np.int64))], ["doc_id", "head", "text_hash", "node"])

    prints = cut(keyed.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, head string, text_hash bigint, node bigint"), "fingerprints")
    distinct = cut(prints.select(F.col("node").alias("fp")).distinct(), "distinct")
    return survivors(docs, prints, connected(links(distinct, radius, blocks, bucket_rows)))


def _node(flat: bytes) -> int:
    return xxhash.xxh64_intdigest(flat, 7)


def _longs(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


_FILTER_BITS = 1 << 24


def _filter_of(nodes: DataFrame) -> np.ndarray:
    """A bitmap of _FILTER_BITS with a bit for each node: of one size whatever their number, built by the executors."""
    place = F.col("node").bitwiseAND(F.lit(_FILTER_BITS - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = nodes.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(_FILTER_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def keep_distinct(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 24, bands: int = 20, band_rows: int = 5,
    bucket_rows: int = 4096, bucket_shingles: int = 1 << 22, seed: int = 3,
) -> DataFrame:
    """The rows of docs without near copies: of each component of pairs of Jaccard >= similarity the first, see survivors.

    Sets are those of the distinct shingles of ``words`` words of a text. No choice of equal blocks of 64
    bits gathers pairs that differ in 10 bits and more, so buckets are bands of ``band_rows`` least
    permuted hashes of a set: pairs of similarity s share one with a chance of 1 - (1 - s^band_rows)^bands,
    0.9996 at 0.8. Within a bucket SimHash fingerprints of the sets are compared bit-sliced; at 0.8 they
    differ in 9.7 bits of 64 (standard deviation 2.9), and pairs within ``radius`` are held against the exact
    similarity of their sets. Texts without words are copies of each other. Texts that are equal when
    normalised are one node, named by its XXH64 hash.

    The first scan makes fingerprints and bands. Only texts that share a bucket need their sets: a second
    scan makes those, once in a partition for each node. A bitmap of a fixed 2 MB tells the scan which; it
    lets more pass the more nodes there are, and the join with the buckets drops what it let pass.
    """
    r = np.random.default_rng(seed)
    factors = r.integers(0, 1 << 63, bands * band_rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = r.integers(0, 1 << 63, bands * band_rows, dtype=np.uint64)

    def banded(own: np.ndarray) -> tuple[int, np.ndarray]:
        counts, least = np.zeros(BITS, np.int64), np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(own), 1024):
            part = own[at : at + 1024]
            counts += _bit_counts(part)
            least = np.minimum(least, (part[:, None] * factors + shifts).min(axis=0))
        packed, step = least.astype("<u8").tobytes(), 8 * band_rows
        keys = [xxhash.xxh64_intdigest(packed[i * step : (i + 1) * step], i) for i in range(bands if len(own) else 0)]
        return _majority(counts, len(own)), np.array(keys, np.uint64).view(np.int64)

    def first_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            nodes, fps, sizes, keys = [], [], [], []
            for text in b.column(1).to_pylist():
                own = shingles(text, words)
                fp, bands_of = banded(own)
                nodes.append(_node(_flat(text)))
                fps.append(fp)
                sizes.append(len(own))
                keys.append(bands_of)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), _longs(nodes), _longs(fps), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "head", "text_hash", "node", "fp", "n_shingles", "keys"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    keyed = _keyed(docs)
    prints = cut(keyed.mapInArrow(first_scan, f"doc_id {kind}, head string, text_hash bigint, node bigint, fp bigint, n_shingles bigint, keys array<bigint>"), "prints")
    # rows of a node have the same bands, so a bucket's distinct nodes are found without their arrays in a shuffle
    spread = prints.select("node", "n_shingles", F.posexplode("keys").alias("t", "key")).distinct()
    buckets = (
        spread.groupBy("t", "key").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("held"), F.bit_xor(F.xxhash64("node")).alias("members"))
        .where("n > 1")
    )
    # near copies share most bands: buckets of the same members are compared once
    once = buckets.groupBy("n", "members").agg(F.min(F.struct("t", "key")).alias("b"), F.min("held").alias("held")).select("b.*", "n", "held")
    deal = F.ceil(F.greatest(F.col("n") / bucket_rows, F.col("held") / bucket_shingles))
    dealt = cut(_dealt(spread, once.hint("merge"), deal, "node"), "buckets")
    known = docs.sparkSession.sparkContext.broadcast(_filter_of(dealt))

    def second_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches, 0):
            nodes, fps, sets = [], [], []
            for text in b.column(0).to_pylist():
                node = _node(_flat(text))
                at = node & (_FILTER_BITS - 1)
                if int(known.value[at >> 6]) >> (at & 63) & 1 and node not in seen:
                    seen.add(node)
                    own = shingles(text, words)
                    nodes.append(node)
                    fps.append(_majority(sum((_bit_counts(own[i : i + 4096]) for i in range(0, len(own), 4096)), np.zeros(BITS, np.int64)), len(own)))
                    sets.append(own.astype("<u8").tobytes())
            if nodes:
                yield pa.RecordBatch.from_arrays([_longs(nodes), _longs(fps), pa.array(sets, pa.binary())], ["node", "fp", "shingles"])

    # nodes that no bucket has go before their sets travel further; of each node's sets, one for each partition, one stays
    wanted = dealt.select("node").distinct()
    sets = keyed.select("text").mapInArrow(second_scan, "node bigint, fp bigint, shingles binary").join(wanted.hint("merge"), "node", "left_semi").dropDuplicates(["node"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, firsts in _buckets(batches, 7):
            held = cols[6]
            hashes = [np.frombuffer(x, "<u8") for x in held]
            pairs = _spanning(cols[4], firsts, radius, lambda i, j: jaccard(hashes[i], hashes[j]) >= similarity)
            yield _out(cols[5][pairs])

    met = dealt.join(sets.hint("merge"), "node").select(*_GROUP, "fp", "node", "shingles")
    found = cut(_sorted(met, "fp").mapInArrow(compare, "u bigint, v bigint"), "similar")
    light = cut(prints.select("doc_id", "head", "text_hash", "node"), "nodes")
    known.destroy()
    drop_cut(prints)
    drop_cut(dealt)
    roots = connected(found)
    drop_cut(found)
    return survivors(docs, light, roots)
