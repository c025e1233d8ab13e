"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Targets. The sources, in code-point order with null last, weigh 5, 2, 1 and so on in turn, and
share all words by weight; a target stops at ``cap`` times its source's size, and the excess goes
to the others by weight. Sorted by cap over weight, the sources that stop come first, so one pass
of running sums finds the level.

Line. The documents of a source, shuffled by the hash of their id, form a line of words that is cut
into blocks of ``block_words``. Places on the line are sums in two steps: within 4096 hash ranges
of each source, then over the ranges; a source with a third of all rows is dealt to 4096 keys.

Schedule. Slot i maps its van der Corput point through the sources' cumulative numbers of slots;
slots are ranked per source, again in two steps, and the k-th slot of a source takes the k-th block
of its line, going round again after the last. A source whose points fall short of its number of
slots, by a few at any size, gets the rest after the last point, and the last slot stops at the
target; so each source's words are its target to the nearest word, and no document is taken more
than ``cap`` times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formloom.llm.common import cut, word_count

_RANGE_DIGITS = 3  # hex digits: 4096 ranges
_CELLS = 1024
_BITS = 48
_CHUNK = 1 << 16


def _skey() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns (but maps, which have none): rows of one hash are the same row again."""
    return F.xxhash64(*(f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))


def measured(docs: DataFrame) -> DataFrame:
    """docs -> (doc_id, source, size, skey, row_hash, h, part): the words of each text, once, without the text."""
    skey, row_hash = _skey(), _row_hash(docs)
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null"), row_hash.cast("string"))).cast("binary"))
    sized = docs.select("doc_id", "source", word_count(F.col("text").cast("string")).alias("size"), skey.alias("skey"), row_hash.alias("row_hash"), h.alias("h"))
    return cut(sized.withColumn("part", F.substring("h", 1, _RANGE_DIGITS)), "sizes")


def targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row for each source: skey, source_size, target, need (slots), and the cumulative slots lo.

    The windows without a key run over one row per source, never over documents.
    """
    by = sized.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    whole = Window.partitionBy()
    named = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    level = Window.partitionBy().orderBy("ratio", "rank")
    ready = (
        by.withColumn("rank", F.row_number().over(named))
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") - 1) % len(weights) + 1))
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("ratio", F.col("most").cast("double") / F.col("weight"))
        .withColumn("before", F.coalesce(F.sum("most").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("after", F.sum("weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("share", (F.col("total") - F.col("before")).cast("double") / F.col("after"))
        .withColumn("fits", F.col("share") * F.col("weight") <= F.col("most"))
        .withColumn("first", F.min(F.when(F.col("fits"), F.struct("ratio", "rank", "share"))).over(whole))
    )
    # without rounding, some source always fits; if none does, all stop
    return ready.withColumn("target", F.least(F.coalesce(F.col("weight") * F.col("first.share"), F.col("most").cast("double")), F.col("most").cast("double"))).select(
        "skey", "source", "source_size", "target"
    )


def _planned(goals: DataFrame, block_words: int) -> DataFrame:
    named = Window.partitionBy().orderBy("skey")
    return (
        goals.withColumn("words", F.floor(F.col("target") + 0.5).cast("long"))
        .withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("words") - F.col("rounds") * F.col("source_size"))
        .withColumn("need", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / block_words).cast("long"))
        .withColumn("lo", F.coalesce(F.sum("need").over(named.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )


def schedule(goals: DataFrame, block_words: int = 1024) -> DataFrame:
    """(slot, skey, block, round, take): the blocks in the order of the mix; take is the words of the block that count."""
    spark = goals.sparkSession
    plan = cut(_planned(goals, block_words), "plan")
    n = plan.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), _BITS, "0")), 2, 10).cast("double") / float(1 << _BITS)
    slots = spark.range(n).withColumnRenamed("id", "slot").withColumn("u", point * float(n))
    cell = lambda x: F.floor(x * (_CELLS / max(1, n))).cast("int")
    spans = plan.where("need > 0").select(
        "skey", "lo", (F.col("lo") + F.col("need")).alias("hi"), F.explode(F.sequence(cell(F.col("lo")), cell(F.col("lo") + F.col("need")))).alias("cell")
    )
    mapped = slots.withColumn("cell", cell(F.col("u"))).join(spans, "cell").where("u >= lo and u < hi").select("slot", "skey").withColumn("chunk", F.floor(F.col("slot") / _CHUNK))
    counts = mapped.groupBy("skey", "chunk").agg(F.count("*").alias("n"))
    sums = counts.withColumn("offset", F.sum("n").over(Window.partitionBy("skey").orderBy("chunk")) - F.col("n")).drop("n")
    in_chunk = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("slot"))
    ranked = mapped.withColumn("k", in_chunk - 1).join(sums, ["skey", "chunk"]).select("slot", "skey", (F.col("k") + F.col("offset")).alias("k"))
    had = counts.groupBy("skey").agg(F.sum("n").alias("had"))
    short = (
        plan.select("skey", "need").join(had, "skey", "left").withColumn("had", F.coalesce("had", F.lit(0))).where("had < need")
        .select((F.col("need") + n).alias("slot"), "skey", F.explode(F.sequence(F.col("had"), F.col("need") - 1)).alias("k"))
    )
    all_ = ranked.unionByName(short.select(F.col("slot") + F.col("k"), "skey", "k").toDF("slot", "skey", "k"))
    full = F.col("rounds") * F.col("blocks")
    out = all_.join(plan, "skey").where("k < need")
    out = out.withColumn("round", F.floor(F.col("k") / F.col("blocks"))).withColumn("block", F.col("k") % F.col("blocks"))
    length = F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    left = F.col("rest") - F.col("block") * block_words
    return out.select("slot", "skey", "block", "round", F.when(F.col("k") < full, length).otherwise(F.least(length, left)).cast("long").alias("take"))


def _taken(docs: DataFrame, weights: Sequence[int], cap: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """(a row for each row with the words taken of it, a row for each source): see mix."""
    sized = measured(docs)
    goals = cut(targets(sized, weights, cap), "goals")
    inside = Window.partitionBy("skey", "part").orderBy("h", "doc_id", "size", "row_hash")
    placed = sized.withColumn("inner", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).withColumn("row", F.row_number().over(inside))
    ranges = sized.groupBy("skey", "part").agg(F.sum("size").alias("n"))
    sums = ranges.select("skey", "part", (F.sum("n").over(Window.partitionBy("skey").orderBy("part")) - F.col("n")).alias("offset"))
    begin = F.floor(F.col("begin") / block_words)
    end = F.floor(F.greatest(F.col("begin"), F.col("begin") + F.col("size") - 1) / block_words)
    pieces = (
        placed.join(sums, ["skey", "part"]).withColumn("begin", F.col("offset") + F.col("inner"))
        .select("doc_id", "source", "skey", "part", "row", "row_hash", "size", "begin", F.explode(F.sequence(begin, end)).alias("block"))
    )
    # a block is taken a few times: what counts is how often whole words before each stop
    taken_blocks = schedule(goals, block_words).groupBy("skey", "block").agg(F.collect_list("take").alias("takes"))
    at = F.col("block") * block_words
    low, high = F.greatest("begin", at), F.least(F.col("begin") + F.col("size"), at + block_words)
    part = F.aggregate(
        F.coalesce("takes", F.array().cast("array<bigint>")), F.lit(0).cast("long"),
        lambda acc, take: acc + F.greatest(F.lit(0).cast("long"), F.least(high, at + take) - low),
    )
    rows = pieces.join(taken_blocks, ["skey", "block"], "left").groupBy("skey", "part", "row", "row_hash", "doc_id", "source", "size").agg(F.sum(part).alias("taken"))
    return rows, goals


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, block_words: int = 1024) -> DataFrame:
    """docs(doc_id, source, text, ...) -> (doc_id, size, source_size, target, taken, source), a row for each row.

    size: words of the text (null: 0). taken: the words of the document in the mix, repeats counted,
    at most ``cap`` times its size. A null source is a source of its own, the last. Rows without words
    take nothing; rows that repeat an id are documents of their own, next to each other on the line;
    other columns only order rows of one id and size. An empty table, or one without words, gives targets of 0.
    """
    rows, goals = _taken(docs, weights, cap, block_words)
    return rows.join(goals.select("skey", "source_size", "target"), "skey").select("doc_id", "size", "source_size", "target", "taken", "source")


def apply_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, block_words: int = 1024) -> DataFrame:
    """docs as the mix has them: a row is repeated as often as the mix takes its words, to the nearest whole; all columns stay.

    The mix takes whole documents but for one of each source, in which its line stops; so a source's words
    are its target to within half of that document. Rows of which less than half is taken, and rows
    without words, of which there is nothing to take, are not in the mix. A row is known by a hash of all its columns; rows that are equal
    in all of them share what is taken of them, the first ones one copy more where it does not divide.
    """
    rows, _ = _taken(docs, weights, cap, block_words)
    size, taken = F.col("size"), F.col("taken")
    copies = F.when(size > 0, F.floor((taken + size / 2) / F.greatest(size, F.lit(1)))).otherwise(0).cast("int")
    keys = ["_formloom_source", "_formloom_hash"]
    plan = rows.groupBy(F.col("skey").alias(keys[0]), F.col("row_hash").alias(keys[1])).agg(F.count("*").alias("_formloom_rows"), F.sum(copies).alias("_formloom_copies")).where("_formloom_copies > 0")
    keyed = docs.select(_skey().alias(keys[0]), _row_hash(docs).alias(keys[1]), F.struct(*docs.columns).alias("_formloom_row"))
    met = keyed.join(plan.hint("merge"), keys)
    # equal rows in any order are the same table
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    n, total = F.col("_formloom_rows"), F.col("_formloom_copies")
    times = F.floor(total / n) + F.when(rank <= total % n, 1).otherwise(0)
    return met.withColumn("_formloom_times", times.cast("int")).select("_formloom_row", F.explode(F.array_repeat(F.lit(1), F.col("_formloom_times")))).select("_formloom_row.*")
