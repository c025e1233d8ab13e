"""Language ID by compression: the language whose zstandard dictionary packs a text best.

Training takes a bounded sample: every text of a known language is cut into pieces of
``piece_chars``, and for each language the ``pieces_per_lang`` pieces with the smallest hashes,
from anywhere in any text, become a raw-content dictionary. A text is normalised (lower case,
letters only) and cut into segments; every segment is encoded with every dictionary, and the sizes
are summed over the whole text. The smallest sum wins. zstandard stores what it cannot shorten by a
few bytes, so a filler that all dictionaries pack alike goes before each segment: then the few words
of a short text tell as well. Sizes are whole bytes and can tie: then the sum of the sizes of the
text's words, encoded one by one, decides, and after that the language's name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.llm.common import held_out, slices, small_batches

UNDETERMINED = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")
_FILLER = bytes(256)


def normalise(text: str) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


@dataclass
class Languages:
    """Dictionaries by language; the compressors are made where they are used."""

    content: dict[str, bytes]
    segment: int = 4096
    level: int = 5
    _made: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {"content": self.content, "segment": self.segment, "level": self.level}

    def __setstate__(self, state):
        self.__dict__.update(state, _made=[])

    def _ready(self) -> list:
        if not self._made:
            # short matches, looked for in a tree: segments are short and their words occur in the dictionary
            parameters = zstandard.ZstdCompressionParameters.from_level(
                self.level, source_size=self.segment, dict_size=max([1, *map(len, self.content.values())]),
                min_match=3, search_log=3, strategy=zstandard.STRATEGY_BTLAZY2, write_checksum=0, write_content_size=0, write_dict_id=0,
            )
            for lang, data in sorted(self.content.items()):
                packed = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packed.precompute_compress(compression_params=parameters)
                self._made.append((lang, zstandard.ZstdCompressor(dict_data=packed, compression_params=parameters)))
        return self._made

    def segments(self, clean: bytes) -> list[bytes]:
        """One part, or an even number of parts of about the same length, of at most ``segment``; they end between words if they can."""
        return _parts(clean, 1 if len(clean) <= self.segment else 2 * -(-len(clean) // (2 * self.segment)))

    def sizes(self, parts: list[bytes]) -> list[tuple[str, list[int]]]:
        return [(lang, [len(c.compress(_FILLER + b" " + p + b" ")) for p in parts]) for lang, c in self._ready()]

    def _best(self, sizes: list[tuple[int, str]], clean: bytes) -> tuple[str, float]:
        """The language of the smallest size, and the share of the runner-up's size that it saves; of a tie, the share of a byte by words."""
        ranked = sorted(sizes)
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        if ranked[0][0] == ranked[1][0]:
            by_word = {lang: sum(own) for lang, own in self.sizes(clean.split())}
            tied = sorted((by_word[lang], lang) for size, lang in ranked if size == ranked[0][0])
            return tied[0][1], (tied[1][0] - tied[0][0]) / tied[1][0] / ranked[0][0]
        return ranked[0][1], (ranked[1][0] - ranked[0][0]) / ranked[1][0]

    def _clean(self, text: str | None) -> bytes | None:
        if not self.content or not any(map(str.isalpha, text or "")):
            return None
        return normalise(text).encode("utf-8", "replace")

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score). The score is the share of the runner-up's size that the winner saves, less than a byte's where they tie."""
        clean = self._clean(text)
        if clean is None:
            return UNDETERMINED, 0.0
        return self._best([(sum(own), lang) for lang, own in self.sizes(self.segments(clean))], clean)

    def clear(self, text: str | None, min_score: float, whole: bool = False) -> bool:
        """True where the language is told with a score above min_score; with whole, also where neither half is told as another with such a score."""
        clean = self._clean(text)
        if clean is None:
            return False
        parts = self.segments(clean)
        found = self.sizes(parts)
        lang, score = self._best([(sum(own), lang) for lang, own in found], clean)
        if score <= min_score or not whole:
            return score > min_score
        if len(parts) == 1:
            parts = _parts(clean, 2)
            found = self.sizes(parts)
        mid = len(parts) // 2
        told = [self._best([(sum(own[at]), lang) for lang, own in found], b"".join(parts[at])) for at in (slice(0, mid), slice(mid, None))]
        return all(own == lang or margin <= min_score for own, margin in told)


def _parts(clean: bytes, n: int) -> list[bytes]:
    """n parts of about the same length; a cut within a word moves to the space before it, if the part has one."""
    cuts = [0]
    for i in range(1, n):
        at = i * len(clean) // n
        space = clean.rfind(b" ", cuts[-1], at + 1)
        cuts.append(space if space > cuts[-1] else at)
    return [clean[a:b] for a, b in zip(cuts, [*cuts[1:], len(clean)])]


def fit(docs: DataFrame, pieces_per_lang: int = 112, piece_chars: int = 1000, **options) -> Languages:
    """Dictionaries from the documents that are not held out and have a language and a text.

    All pieces of all such texts stand for election: pieces are counted for each language, and a second
    scan takes those whose hash is below the bound that lets half as many again as are wanted pass. So at
    most some 2 * ``pieces_per_lang`` pieces a language come to the driver, from any input. Equal pieces at
    the same place of rows with the same id count once. An empty input gives no language, and then every text is undetermined.
    """
    text = F.col("text").cast("string")
    known = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & (F.length(text) > 0)).select(
        "doc_id", F.col("lang").cast("string").alias("lang"), text.alias("text"), F.ceil(F.length(text) / piece_chars).cast("int").alias("n")
    )
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not counts:
        return Languages({}, **options)
    span = float(1 << 63)
    share = docs.sparkSession.createDataFrame([(k, min(1.0, (1.5 * pieces_per_lang + 20) / n)) for k, n in counts.items()], "lang string, share double")
    placed = known.join(F.broadcast(share), "lang").withColumn(
        "at", F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.abs(F.xxhash64("doc_id", i).cast("double")) < F.col("share") * span)
    )
    pieces = (
        placed.where(F.size("at") > 0).select("lang", "doc_id", "text", F.explode("at").alias("i"))
        .select("lang", F.xxhash64("doc_id", "i").alias("h"), F.substr("text", F.col("i") * piece_chars + 1, F.lit(piece_chars)).alias("piece")).distinct()
    )
    content: dict[str, bytes] = {}
    rows = sorted(pieces.collect(), key=lambda r: (r.lang, abs(r.h), r.h, r.piece))
    for lang in counts:
        own = [normalise(r.piece) for r in rows if r.lang == lang][:pieces_per_lang]
        data = " ".join(p for p in own if p).encode("utf-8", "replace")
        if data:
            content[lang] = data
    return Languages(content, **options)


def identify(docs: DataFrame, languages: Languages) -> DataFrame:
    """docs(doc_id, text, ...) -> (doc_id, held_out, lang_pred, score), a row for each row.

    Null texts and texts without a letter: ``und``, score 0. Other columns are ignored.
    """
    kind = dict(docs.dtypes)["doc_id"]
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            found = [languages.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    out = picked.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, languages: Languages, min_score: float = 0.0, whole: bool = False) -> DataFrame:
    """The rows of docs whose language is clear: not ``und`` and a score above min_score; with whole, the same in both halves of the words.

    All columns of docs stay as they are.
    """
    fields = [f.name for f in docs.schema.fields]
    at = fields.index("text")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, at):
            yield b.filter(pa.array([languages.clear(t, min_score, whole) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
