"""Collocations: phrases whose words come together more often than their parts suggest.

The text is read twice. The first time counts words. The second time turns every word that
is frequent enough to be part of a phrase into one row with the words that follow it, as
columns, padded where the piece of text ends or a rare word follows. Only these longest
windows are counted; a ROLLUP over the columns then sums the counts of shorter phrases from
them. Before that, windows that are too rare to count as phrases of their length give up
their last word, while they still lie in the bin that counted them; so the ROLLUP
gets little more than the frequent phrases.

Windows travel packed: those that a part of the text has for one bin are one row, a few
bytes for each word. A task counts one bin at a time, so the memory it needs does not grow
with the text.

The most frequent words go to every task as small numbers, at most ``DICTIONARY`` of them.
Other frequent words, of which a larger corpus has more, are told from rare ones by a Bloom
filter of a fixed size and go by a 62-bit hash; two with one hash are an error, never a
wrong count.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import stored

# What ends a piece of text, and what a piece is cut into words at, as bytes of UTF-8. A
# byte that UTF-8 never has stands for the end of a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"
CUT = bytes.maketrans(
    ENDS + bytes(range(65, 91)) + b"\t", END * len(ENDS) + bytes(range(97, 123)) + b" "
)

# Bytes of text that are cut into words at once, and words a task counts before it hands over.
PART = 1 << 21
COUNTED = 400_000
# A fixed odd multiplier that mixes numbers.
MIX = np.uint64(0x9E3779B97F4A7C15)
# Words of text for each bin of windows, of which a task holds one at a time.
BIN_WORDS = 1_000_000
# Bytes of packed windows up to which languages of a bin are counted together.
TOGETHER = 1 << 17
# Words that every task knows by number, and bits of the filter for the others.
DICTIONARY = 500_000
FILTER_BITS = 1 << 25
# In place of a word: the piece has ended, or the next word is too rare.
PADDING = 0
# A word is common if it makes up more than one in so many.
COMMON = 10_000
LONGEST = 4
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
UNKNOWN_LANG = "und"


@dataclass(frozen=True)
class PhraseOptions:
    """What makes a collocation.

    A phrase of 2 to 4 words counts from ``least`` occurrences on. One that lies in a longer
    one with ``within`` percent of its occurrences is left out. ``most`` are returned for
    each language. ``seed`` is of the hash of words beyond the dictionary of so many words,
    and texts are read in parts of about ``part`` bytes.
    """

    least: int = 30
    within: int = 80
    most: int = 2000
    scale: int = 2_000_000
    seed: int = 42
    dictionary: int = DICTIONARY
    part: int = PART


def _slices(text: bytes, size: int) -> Iterator[bytes]:
    """Lower-cased text with marked ends, in parts of about ``size`` bytes, words whole."""
    text = text.translate(CUT)
    at = 0
    while at < len(text):
        if len(text) - at <= size:
            end = len(text)
        else:
            places = [p for p in (text.find(c, at + size) for c in (b" ", END)) if p >= 0]
            end = min(places, default=len(text))
        yield text[at:end].replace(END, b" \xff ")
        at = end


def _texts(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of a batch, in parts; ``END`` is among the words where a piece ends."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter[str] = Counter()
    langs = batch.column(0).to_pylist()
    for lang, text in zip(langs, batch.column(1).cast(pa.binary())):
        # A text goes on from part to part, but not from the one before it.
        held.setdefault(lang, []).append(END)
        for part in _slices(text.as_py() or b"", size):
            held.setdefault(lang, []).append(part)
            sizes[lang] += len(part)
            if sizes[lang] >= size:
                yield lang, b" ".join(held.pop(lang)).split()
                del sizes[lang]
    for lang, parts in held.items():
        yield lang, b" ".join(parts).split()


def word_counts(texts: DataFrame, part: int = PART) -> DataFrame:
    """(lang, word, n) of (lang, text). Words are counted in the map tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter[bytes]] = {}

        def handed_over() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                found.pop(END, None)
                words = pa.array(found.keys(), pa.binary()).cast(pa.string())
                n = pa.array(found.values(), pa.int64())
                langs = pa.array([lang] * len(words), pa.string())
                yield pa.RecordBatch.from_arrays([langs, words, n], ["lang", "word", "n"])
            counts.clear()

        for batch in batches:
            for lang, words in _texts(batch, part):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) >= COUNTED:
                    yield from handed_over()
        yield from handed_over()

    counted = texts.mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _hash(word: bytes, seed: int) -> int:
    """A number above all of the dictionary's, below 2^62."""
    return (xxhash.xxh64_intdigest(word, seed) >> 2) | (1 << 40)


def _places(number: int) -> tuple[int, int]:
    """The two places of the filter for a number, by different bits of it."""
    return number % FILTER_BITS, number // FILTER_BITS % FILTER_BITS


def _least_of_dictionary(words: DataFrame, size: int) -> float:
    """The count from which on at most ``size`` words have it, by steps of a twelfth."""
    step = F.floor(12 * F.log2("n"))
    steps = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"))
    left, least = size, float("inf")
    for row in sorted(steps.collect(), reverse=True):
        if (left := left - row["words"]) < 0:
            break
        least = row["step"]
    return least


def vocabulary(frequent: DataFrame, options: PhraseOptions) -> DataFrame:
    """(word, id, n): a number for each frequent word, by falling count in the dictionary."""
    words = frequent.groupBy("word").agg(F.max("n").alias("n"))
    least = _least_of_dictionary(words, options.dictionary)
    listed = F.floor(12 * F.log2("n")) >= least
    order = Window.orderBy(F.desc("n"), "word")
    numbered = words.filter(listed).select(
        "word", F.row_number().over(order).cast("long").alias("id"), "n"
    )
    seed = options.seed

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_hash(w, seed) for w in batch.column(0).cast(pa.binary()).to_pylist()]
            columns = [batch.column(0), pa.array(ids, pa.int64()), batch.column(1)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "id", "n"])

    others = words.filter(~listed).mapInArrow(hashed, "word string, id long, n long")
    found = stored(numbered.union(others), "vocabulary")
    twice = found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if twice.head() is not None:
        raise ValueError("two words have one hash, choose another seed")
    return found


def _others_filter(others: DataFrame) -> np.ndarray | None:
    """The Bloom filter of the ids beyond the dictionary, 64 places a number; None if none."""
    halves = F.array(F.col("id") % FILTER_BITS, F.expr(f"id div {FILTER_BITS} % {FILTER_BITS}"))
    place = F.explode(halves).alias("place")
    cells = others.select(place).select(
        F.floor(F.col("place") / 64).alias("cell"),
        F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("bits"),
    )
    rows = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    if not len(rows):
        return None
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy()
    return held.view(np.uint64)


def _mixed(seed: int | np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """A hash of each row."""
    mixed = np.broadcast_to(np.asarray(seed, np.uint64), columns[0].shape)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * MIX
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _group_starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _planes(column: np.ndarray) -> np.ndarray:
    """The bytes of numbers, lowest first, as far as any number has them."""
    used = max(1, (int(column.max()).bit_length() + 7) // 8)
    return column.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :used].T


def _numbers(planes: np.ndarray) -> np.ndarray:
    """The numbers that have these bytes."""
    numbers = np.zeros(planes.shape[1], np.int64)
    for i, plane in enumerate(planes):
        numbers |= plane.astype(np.int64) << 8 * i
    return numbers


def packed_windows(
    columns: list[np.ndarray], lang: str, bins: int, common: int
) -> tuple[np.ndarray, list[bytes]]:
    """The bins that get windows, and the packed windows of each; equal ones are one row.

    Windows are dealt by their first two words; where both are among the ``common`` most
    frequent words, by the third as well, and by the fourth if that one is common too: no
    phrase dealt in one has a great share of the text.
    """
    w1, w2, w3, w4 = columns
    split2 = (w1 <= common) & (w2 <= common)
    split3 = split2 & (w3 <= common)
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    dealt = _mixed(seed, [w1, w2, np.where(split2, w3, PADDING), np.where(split3, w4, PADDING)])
    # Top bits for the bin, others for the window, which bring equal ones together, and the
    # lowest for the row: one sort of numbers.
    place = len(w1).bit_length()
    room = max(0, 64 - place - bins.bit_length())
    dealt = (dealt >> np.uint64(1)) % np.uint64(bins)
    keys = _mixed(seed, columns) >> np.uint64(64 - room) if room else np.zeros(len(w1), np.uint64)
    keys = (dealt << np.uint64(room) | keys) << np.uint64(place) | np.arange(len(w1), dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << place) - 1)).astype(np.int64)
    dealt = dealt[order]
    columns = [c[order] for c in columns]
    starts = _group_starts(dealt, *columns)
    n = np.diff(starts, append=len(order))
    dealt = dealt[starts]
    words = _planes(np.concatenate([c[starts] for c in columns]))
    counts = _planes(n)
    planes = np.concatenate([words.reshape(len(words) * LONGEST, -1), counts])
    head = bytes([len(words), len(counts)])
    first = _group_starts(dealt)
    ends = np.append(first[1:], len(dealt)).tolist()
    return dealt[first], [head + planes[:, i:j].tobytes() for i, j in zip(first.tolist(), ends)]


def unpacked_windows(
    blocks: list[bytes], langs: list[int]
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The windows of packed ones, their counts, and the numbers of their languages."""
    alike: dict[bytes, list[tuple[np.ndarray, int]]] = {}
    for block, lang in zip(blocks, langs):
        size = block[0] * LONGEST + block[1]
        planes = np.frombuffer(block, np.uint8, offset=2).reshape(size, -1)
        alike.setdefault(block[:2], []).append((planes, lang))
    found = []
    for (size, _), parts in alike.items():
        rows = np.repeat([lang for _, lang in parts], [part.shape[1] for part, _ in parts])
        planes = np.concatenate([part for part, _ in parts], axis=1)
        words = planes[: size * LONGEST].reshape(size, LONGEST, -1)
        columns = [_numbers(words[:, i]) for i in range(LONGEST)]
        found.append([*columns, _numbers(planes[size * LONGEST :]), rows])
    *columns, n, rows = (np.concatenate(c) for c in zip(*found))
    return columns, n, rows


def packed(
    texts: DataFrame, words: DataFrame, options: PhraseOptions, bins: int, common: int
) -> DataFrame:
    """(bin, lang, block): the longest windows of two frequent words or more.

    Equal ones of one part of the text are one row of a block.
    """
    known = words.filter(F.col("id") <= options.dictionary).select("word", "id").toArrow()
    numbers = dict(
        zip(known.column("word").cast(pa.binary()).to_pylist(), known.column("id").to_pylist())
    )
    held = _others_filter(words.filter(F.col("id") > options.dictionary))
    held = held if held is None else held.tobytes()
    seed, part = options.seed, options.part

    class Numbers(dict):
        """Numbers of words; a word beyond the dictionary has one if the filter holds it."""

        def __missing__(self, word: bytes) -> int:
            if held is None or word == END:
                return PADDING
            number = _hash(word, seed)
            a, b = _places(number)
            return number if held[a >> 3] >> (a & 7) & held[b >> 3] >> (b & 7) & 1 else PADDING

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Numbers(numbers)
        # The last words of a part: the next one in the same language may go on from them.
        rest: dict[str, np.ndarray] = {}
        none = np.zeros(LONGEST - 1, np.int64)

        def leads(lang: str, found: np.ndarray) -> Iterator[pa.RecordBatch]:
            n = len(found) - LONGEST + 1
            columns = [found[:n]]
            for i in range(1, LONGEST):
                columns.append(np.where(columns[-1] == PADDING, PADDING, found[i : i + n]))
            phrase = columns[1] != PADDING
            if not phrase.any():
                return
            dealt, blocks = packed_windows([c[phrase] for c in columns], lang, bins, common)
            langs = pa.array([lang] * len(blocks), pa.string())
            arrays = [pa.array(dealt.astype(np.int32)), langs, pa.array(blocks, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["bin", "lang", "block"])

        for batch in batches:
            for lang, words in _texts(batch, part):
                found = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                found = np.concatenate([rest.get(lang, none[:0]), found])
                rest[lang] = found[max(0, len(found) - LONGEST + 1) :]
                if len(found) >= LONGEST:
                    yield from leads(lang, found)
        for lang, found in rest.items():
            yield from leads(lang, np.concatenate([found, none]))

    return texts.mapInArrow(windows, "bin int, lang string, block binary")


def folded_windows(
    columns: list[np.ndarray], n: np.ndarray, langs: np.ndarray, least: int, common: int
) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Windows of one bin, of which rare ones have given up their last words.

    A window with fewer than ``least`` occurrences in its language is counted as its first
    three words, and these as its first two if they are too rare as well. Two words that are
    too rare are left out. Words whose windows lie in other bins too are always kept.
    """
    # Hashes get numbers above all of the dictionary's, so that two words are one number.
    whole = np.concatenate(columns)
    large = np.flatnonzero(whole >> 31)
    hashes, at = np.unique(whole[large], return_inverse=True)
    whole[large] = at + (1 << 31)
    w1, w2, w3, w4 = np.split(whole, LONGEST)
    # With several languages, a number for each of them and first word.
    first = w1
    if (langs != langs[0]).any():
        first = np.unique(langs << 32 | w1, return_inverse=True)[1]
    pair = first << 32 | w2

    order = np.argsort(pair)
    starts = _group_starts(pair[order])
    often = np.add.reduceat(n[order], starts) >= least
    often = np.repeat(often, np.diff(starts, append=len(order)))
    rows = order[often | ((w1 <= common) & (w2 <= common))[order]]
    rows = rows[np.lexsort((w3[rows] << 32 | w4[rows], pair[rows]))]
    pair, n, langs, w1, w2, w3, w4 = (c[rows] for c in (pair, n, langs, w1, w2, w3, w4))
    if not len(n):
        return [w1, w2, w3, w4], n, langs

    starts = _group_starts(pair, w3, w4)
    n = np.add.reduceat(n, starts)
    pair, langs, w1, w2, w3, w4 = (c[starts] for c in (pair, langs, w1, w2, w3, w4))
    of3, of2 = _group_starts(pair, w3), _group_starts(pair)
    in3 = np.repeat(np.arange(len(of3)), np.diff(of3, append=len(n)))
    in2 = np.repeat(np.arange(len(of2)), np.diff(of2, append=len(n)))
    whole4 = n >= least
    n3 = np.add.reduceat(n, of3)
    split3 = np.maximum(np.maximum(w1[of3], w2[of3]), w3[of3]) <= common
    whole3 = (n3 >= least) | split3
    # What the longer ones don't take with them.
    rest3 = np.where(whole3, n3 - np.bincount(in3[whole4], n[whole4], len(of3)).astype(np.int64), 0)
    rest2 = np.add.reduceat(n, of2)
    rest2 -= np.bincount(in2[of3][whole3], n3[whole3], len(of2)).astype(np.int64)
    at4, at3, at2 = np.flatnonzero(whole4), of3[rest3 > 0], of2[rest2 > 0]
    rows = np.concatenate([at4, at3, at2])
    ends = len(at4), len(at4) + len(at3)
    found = [c[rows] for c in (w1, w2, w3, w4)]
    found[3][ends[0] :] = PADDING
    found[2][ends[1] :] = PADDING
    for column in found:
        large = np.flatnonzero(column >> 31)
        column[large] = hashes[column[large] - (1 << 31)]
    return found, np.concatenate([n[at4], rest3[rest3 > 0], rest2[rest2 > 0]]), langs[rows]


def counted_windows(blocks: DataFrame, least: int, common: int) -> DataFrame:
    """(lang, w1 .. w4, n) of packed windows, counted in their bins and folded there."""
    spark = blocks.sparkSession

    def batch_of(langs: list[str], blocks: list[bytes]) -> pa.RecordBatch:
        names = sorted({*langs})
        number = {lang: i for i, lang in enumerate(names)}
        windows = unpacked_windows(blocks, [number[lang] for lang in langs])
        columns, n, of = folded_windows(*windows, least, common)
        arrays = [pa.array(names, pa.string()).take(pa.array(of)), *map(pa.array, columns)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(n)], ["lang", *WORDS, "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of one bin: languages with few windows are counted together.
        langs, blocks, held, size = [], [], None, 0
        for batch in batches:
            for number, lang, block in zip(*(c.to_pylist() for c in batch.columns)):
                if blocks and (number != held or lang != langs[-1] and size >= TOGETHER):
                    yield batch_of(langs, blocks)
                    langs, blocks, size = [], [], 0
                held = number
                langs.append(lang)
                blocks.append(block)
                size += len(block)
        if blocks:
            yield batch_of(langs, blocks)

    # Bins are a multiple of the partitions: each gets as many.
    dealt = blocks.repartitionById(_partitions(spark), "bin").sortWithinPartitions("bin", "lang")
    columns = ", ".join(f"{w} long" for w in WORDS)
    return dealt.mapInArrow(count, f"lang string, {columns}, n long")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def phrase_counts(windows: DataFrame, least: int) -> DataFrame:
    """(lang, w1 .. w4, f): phrases of two words or more with ``least`` occurrences.

    Words that a phrase lacks are ``PADDING``. Counted windows are rolled up, which
    completes the counts of phrases dealt in many bins.
    """
    w3, w4 = F.col("w3"), F.col("w4")
    rolled = windows.rollup("lang", *WORDS).agg(
        F.sum("n").alias("f"), F.grouping_id().alias("rolled")
    )
    # The columns rolled up: none, the fourth word, the last two words.
    longest = F.when(F.col("rolled") == 0, w4 != PADDING).when(F.col("rolled") == 1, w3 != PADDING)
    return rolled.filter((F.col("f") >= least) & longest.otherwise(F.col("rolled") == 3)).select(
        "lang", "w1", "w2", *(F.coalesce(w, F.lit(PADDING)).alias(w) for w in WORDS[2:]), "f"
    )


def _phrase(words: list[Column]) -> Column:
    """A phrase of fewer words as a struct, padded."""
    padded = [*words, *[F.lit(PADDING).cast("long")] * (LONGEST - len(words))]
    return F.struct(*(w.alias(name) for w, name in zip(padded, WORDS)))


def _cuts(parts: dict[int, list]) -> Column:
    """One of several arrays by the number of words of a phrase."""
    size = sum((F.col(w) != PADDING).cast("int") for w in WORDS)
    chosen = F.when(size == LONGEST, F.array(*parts[LONGEST]))
    for n in range(LONGEST - 1, min(parts) - 1, -1):
        chosen = chosen.when(size == n, F.array(*parts[n]))
    return F.explode(chosen)


def best_cuts(phrases: DataFrame, singles: DataFrame, scale: int) -> DataFrame:
    """(lang, w1 .. w4, a, l, r, score) of phrases: the cut with the lowest score, then the
    shortest first part. Shares are exact whole numbers."""
    words = [F.col(w) for w in WORDS]
    parts = {
        m: [
            F.struct(
                F.lit(k).alias("k"),
                _phrase(words[:k]).alias("first"),
                _phrase(words[k:m]).alias("rest"),
            )
            for k in range(1, m)
        ]
        for m in range(2, LONGEST + 1)
    }
    counts = phrases.union(singles)
    counts = counts.select(F.col("lang").alias("of"), F.struct(*WORDS).alias("phrase"), "f")
    cut = phrases.withColumnRenamed("f", "a").withColumn("cut", _cuts(parts))
    for part, name in (("first", "l"), ("rest", "r")):
        held = counts.withColumnRenamed("f", name)
        same = (F.col("lang") == F.col("of")) & (F.col(f"cut.{part}") == F.col("phrase"))
        cut = cut.join(held, same).drop("of", "phrase")
    score = F.expr(
        f"CAST(CAST(a AS DECIMAL(19, 0)) * {scale} div CAST(CAST(l AS DECIMAL(19, 0)) + r "
        "AS DECIMAL(20, 0)) AS LONG)"
    )
    lowest = F.min(F.struct(score.alias("score"), F.col("cut.k").alias("k"), "l", "r"))
    scored = cut.groupBy("lang", *WORDS, "a").agg(lowest.alias("best"))
    return scored.select("lang", *WORDS, "a", "best.l", "best.r", "best.score")


def without_parts(scored: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """Phrases but those whose occurrences lie mostly within one longer phrase."""
    words = [F.col(w) for w in WORDS]
    parts = {
        m: [_phrase(words[i : i + n]) for n in range(2, m) for i in range(m - n + 1)]
        for m in range(3, LONGEST + 1)
    }
    inner = phrases.filter(F.col("w3") != PADDING).select("lang", "f", _cuts(parts).alias("part"))
    longest = inner.groupBy("lang", "part").agg(F.max("f").alias("longest"))
    longest = longest.select("lang", "part.*", "longest")
    share = F.col("a").cast("decimal(19,0)") * within
    kept = F.col("longest").isNull() | (F.col("longest").cast("decimal(19,0)") * 100 < share)
    return scored.join(longest, ["lang", *WORDS], "left").filter(kept).drop("longest")


def _spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with a column ``phrase`` in place of the numbers of their words."""
    others = [c for c in phrases.columns if c not in WORDS]
    at = phrases.select("*", F.posexplode(F.array(*WORDS)).alias("at", "id"))
    named = at.filter(F.col("id") != PADDING).join(words.select("id", "word"), "id")
    listed = F.array_sort(F.collect_list(F.struct("at", "word")))
    spelled = named.groupBy(*phrases.columns).agg(listed.alias("listed"))
    return spelled.select(*others, F.array_join("listed.word", " ").alias("phrase"))


def collocations(
    docs: DataFrame,
    options: PhraseOptions = PhraseOptions(),
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best collocations of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and those
    into words at spaces and tabs. Result: ``lang``, ``rank`` from 1, ``phrase``, ``a`` (its
    occurrences), ``l`` and ``r`` (those of its parts at the cut that scores lowest), ``n``
    (words of the language) and ``score``, ``scale`` times a / (l + r) without the fraction;
    ordered by score, then ``a``, both falling, then phrase.

    A null or empty text has no words; a null language is ``und``; repeated rows count each
    time. Other columns are not read. No phrase frequent enough: no rows.
    """
    texts = docs.select(F.coalesce(docs[lang], F.lit(UNKNOWN_LANG)).alias("lang"), docs[text])
    counts = stored(word_counts(texts, options.part), "word-counts")
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counts.filter(F.col("n") >= options.least)
    words = vocabulary(frequent, options)
    everything = counts.agg(F.sum("n")).first()[0] or 0
    share = F.col("n") * COMMON > everything
    common = words.filter((F.col("id") <= options.dictionary) & share).count()

    partitions = _partitions(docs.sparkSession)
    bins = partitions * -(-max(1, everything) // (BIN_WORDS * partitions))
    blocks = packed(texts, words, options, bins, common)
    windows = counted_windows(blocks, options.least, common)
    phrases = stored(phrase_counts(windows, options.least), "phrases")
    padding = [F.lit(PADDING).cast("long").alias(w) for w in WORDS[1:]]
    singles = frequent.join(words.select("word", "id"), "word").select(
        "lang", F.col("id").alias("w1"), *padding, F.col("n").alias("f")
    )
    scored = best_cuts(phrases, singles, options.scale)
    kept = without_parts(scored, phrases, options.within)
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # Words are looked up for those that can be among the first alone.
    first = kept.withColumn("place", F.rank().over(by_score))
    first = first.filter(F.col("place") <= options.most).drop("place")
    rank = F.row_number().over(by_score.orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = _spelled(first, words).withColumn("rank", rank.cast("long"))
    return (
        ranked.filter(F.col("rank") <= options.most)
        .join(sizes, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
