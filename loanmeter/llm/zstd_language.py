"""Language identification by compression.

Each language has a raw-content dictionary of sample texts. A text is encoded by zstandard with every
dictionary; the language whose dictionary gives the smallest frame wins. When the two smallest sizes
lie close together the guess is marked as rejected.

The dictionaries come from a bounded sample of the labelled rows: ``sample_docs`` texts a language, of each a piece of at most
``piece_chars`` characters from a place that a hash picks, until ``dictionary_bytes`` are full. The pieces are cut by Spark; at most
``all_bytes`` are gathered for all languages together, and if there are so many languages that this binds, each gets an equal
part. Every text is classified whole.

Edge cases: a text that is null, empty or without a letter (Unicode's letter property; number signs are none) is ``und``
with score 0; equal sizes go to the language that sorts first, with a score of one part in the number of tied languages; rows
without a language label or without a letter teach nothing; without any labelled row every text is ``und``; equal rows give equal
results, one each; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmeter.llm.arrow_text import mapped
from loanmeter.llm.shared_tables import broadcast_if_small, stored

UNKNOWN = "und"
MOST_BROADCAST = 10_000
"""Languages up to which the table of their counts is broadcast; it is counted before."""
_LETTER = regex.compile(r"\p{L}")
_PLAIN = {c: " " for c in range(128) if not chr(c).isalpha()}


@dataclass(frozen=True)
class LanguageRules:
    sample_docs: int = 300
    """Texts looked at per language when filling a dictionary."""
    piece_chars: int = 2000
    dictionary_bytes: int = 128 << 10
    all_bytes: int = 64 << 20
    level: int = 6
    tie_level: int = 19
    """Ties, which short texts have, are looked at again at this level; it finds shorter matches."""
    block_bytes: int = 2048
    """A text is encoded in blocks of this size, all of them."""
    margin: float = 0.02
    """A guess is rejected when the runner-up is less than this share larger."""


def plain(text: str) -> str:
    """Lower case, ASCII signs and digits as single blanks."""
    return " ".join(text.lower().translate(_PLAIN).split())


def language_samples(labelled: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """``lang, nth, piece``: pieces of at most ``sample_docs`` texts a language, picked by a hash of their id.

    Texts are thinned out by the hash before they are ranked, so no language is gathered whole. The bytes of a language's
    pieces before the last one are less than its dictionary has room for.
    """
    c = F.col
    rows = labelled.where(c("lang").isNotNull() & c("text").rlike("\\p{L}"))
    counts = stored(rows.groupBy(c("lang").alias("counted_lang")).count(), "languages")
    room = min(rules.dictionary_bytes, rules.all_bytes // max(1, counts.count()))
    counts = broadcast_if_small(counts, MOST_BROADCAST)
    drawn = F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit(10))
    draw = F.pmod(drawn, F.lit(1 << 30)) / F.lit(float(1 << 30))
    beyond = F.greatest(F.length("text") - rules.piece_chars, F.lit(0))
    start = F.pmod(F.xxhash64("doc_id", F.lit(11)), beyond + 1).cast("int") + 1
    thinned = rows.join(counts, c("lang") == c("counted_lang")).where(draw * c("count") < 2 * rules.sample_docs)
    pieces = thinned.select("lang", draw.alias("draw"), F.substring("text", start, F.lit(rules.piece_chars)).alias("piece"))
    by_draw = Window.partitionBy("lang").orderBy("draw", "piece")
    before = F.coalesce(F.sum(F.octet_length("piece")).over(by_draw.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.withColumn("nth", F.row_number().over(by_draw)).withColumn("before", before)
    return ranked.where((c("nth") <= rules.sample_docs) & (c("before") < room)).select("lang", "nth", "piece")


def learn_dictionaries(labelled: DataFrame, rules: LanguageRules = LanguageRules()) -> dict[str, bytes]:
    """Raw dictionary content by language."""
    found: dict[str, list[str]] = {}
    for row in language_samples(labelled, rules).orderBy("lang", "nth").collect():  # some 64 MB at most, see above
        found.setdefault(row["lang"], []).append(plain(row["piece"]))
    joined = {lang: "".join(f"{x} " for x in dict.fromkeys(pieces)) for lang, pieces in sorted(found.items())}
    return {lang: text.encode()[: rules.dictionary_bytes] for lang, text in joined.items()}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], rules: LanguageRules):
        self.languages = sorted(dictionaries)
        self.rules = rules
        self._content = dictionaries
        self._encoders: dict[int, list] = {}

    def sizes(self, text: str, level: int) -> list[int]:
        if level not in self._encoders:
            self._encoders[level] = [self._encoder(self._content[lang], level) for lang in self.languages]
        data = plain(text).encode()
        # Block by block: in one long frame a text soon serves as its own dictionary.
        blocks = [data[i : i + self.rules.block_bytes] for i in range(0, len(data), self.rules.block_bytes)]
        return [sum(len(e.compress(b)) for b in blocks) for e in self._encoders[level]]

    @staticmethod
    def _encoder(content: bytes, level: int) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False)

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text, self.rules.level)
        best = min(sizes)
        if sizes.count(best) > 1:
            sizes = [a + b for a, b in zip(sizes, self.sizes(text, self.rules.tie_level), strict=True)]
            best = min(sizes)
        score = 1 / sum(2.0 ** (2 * (best - s)) if s - best < 500 else 0.0 for s in sizes)
        rest = sorted(sizes)[1:2] or [2 * best]
        return self.languages[sizes.index(best)], score, rest[0] - best < self.rules.margin * best

    def __getstate__(self):
        return {**self.__dict__, "_encoders": {}}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], rules: LanguageRules = LanguageRules()) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every text."""
    classify = Classifier(dictionaries, rules)

    def kernel(part: pa.RecordBatch) -> pa.RecordBatch:
        found = [classify(t) for t in part.column("text").to_pylist()]
        lang, score, rejected = zip(*found, strict=True)
        return pa.record_batch(
            [part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["doc_id", "lang_pred", "score", "rejected"],
        )

    schema = "doc_id bigint, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(mapped(kernel), schema)
