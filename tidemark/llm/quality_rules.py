"""Quality rules: repetition counts, and bands of how far a text compresses.

Text that compresses far better than prose repeats itself, text that hardly
compresses is noise. Both depend on length, since zstandard finds more to reuse
in a longer text; so each band of lengths has limits of its own. The whole
document is measured, and then fixed chunks of it, so that junk inside a long
clean text shows as well.
"""

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType

from tidemark.llm.arrow import fields, map_texts
from tidemark.llm.words import WORDS

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Ratios of compressed to plain bytes allowed for texts below ``size`` bytes."""

    size: float
    low: float
    high: float


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules.

    ``bands`` are in order of size. Chunks have ``chunk`` bytes each, the last one
    what is left; a chunk counts if it has at least half of that. A text is
    rejected if its whole ratio leaves its band, or if more than ``bad_chunks`` of
    its counted chunks leave the band of their size.

    The upper limits of short texts lie between prose and random letters and digits. Of
    5,326 test documents, those below 512, 1024 and 2048 bytes reached 0.728, 0.698 and
    0.580; such noise had at least 0.808 at 511 bytes, 0.759 at 1,000 and 0.741 at 1,500.
    No chunk of the 488 documents with several left its band.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    chunk: int = 4096
    bad_chunks: float = 0.05
    bands: tuple[Band, ...] = (
        Band(512, 0.25, 0.77),
        Band(1024, 0.20, 0.73),
        Band(2048, 0.20, 0.70),
        Band(16384, 0.15, 0.70),
        Band(float("inf"), 0.05, 0.70),
    )

    def band(self, size: int) -> Band:
        return next(b for b in self.bands if size < b.size)


def repeated_words(tokens: list[str]) -> int:
    """Words that lie in a 3-word window which occurs at least twice in the text."""
    windows = list(zip(tokens, tokens[1:], tokens[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = 0
    end = 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen = set()
    repeats = 0
    for line in text.split("\n"):
        if WORDS.search(line):
            if line in seen:
                repeats += 1
            seen.add(line)
    return repeats


def ratio(data: bytes, compressor: zstandard.ZstdCompressor) -> float:
    """Compressed size over plain size; 1 for no bytes."""
    return len(compressor.compress(data)) / len(data) if data else 1.0


def judge(text: str, rules: QualityRules, compressor: zstandard.ZstdCompressor) -> tuple:
    """All columns of ``quality_rules`` for one text."""
    tokens = WORDS.findall(text)
    n_words = len(tokens)
    n_symbols = sum(map(text.count, SYMBOLS))
    n_repeat = repeated_words(tokens)
    data = text.encode("utf-8", "surrogatepass")
    whole = ratio(data, compressor)
    band = rules.band(len(data))
    chunks = [data[at : at + rules.chunk] for at in range(0, len(data), rules.chunk)]
    chunks = [c for c in chunks if 2 * len(c) >= rules.chunk]
    limits = rules.band(rules.chunk)
    bad = sum(not limits.low <= ratio(c, compressor) <= limits.high for c in chunks)
    bad_share = bad / len(chunks) if chunks else 0.0
    failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words
    kept = not failed and band.low <= whole <= band.high and bad_share <= rules.bad_chunks
    return (
        n_words,
        sum(map(len, tokens)),
        n_symbols,
        duplicate_lines(text),
        n_repeat,
        failed,
        whole,
        bad_share,
        kept,
    )


VERDICT = fields(
    n_words=LongType(),
    word_chars=LongType(),
    n_symbols=LongType(),
    n_dup_lines=LongType(),
    n_repeat_words=LongType(),
    base_failed=BooleanType(),
    zstd_ratio=DoubleType(),
    bad_chunks=DoubleType(),
    kept=BooleanType(),
)


def quality_rules(
    docs: DataFrame, rules: QualityRules | None = None, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep`` of each row, then its counts, ratios and verdict.

    One row comes out for each that goes in, repeated rows included; no shuffle. A
    null or empty text has no words and fails. Columns of ``docs`` that are not in
    ``keep`` do not appear, so they cannot clash; one in ``keep`` that has the name
    of a result is an error.
    """
    rules = rules or QualityRules()

    def make():
        compressor = zstandard.ZstdCompressor(level=rules.level)
        return lambda text: judge(text, rules, compressor)

    return map_texts(docs, keep, VERDICT, make)
