"""Finding benchmark items in documents by latent semantic retrieval.

Texts become TF-IDF vectors over the words of the benchmark. A randomised singular
value decomposition of passages, computed by Spark over all passages of the corpus and
of the benchmark, gives the latent space. Each passage of each document is projected
into it, and items at a small angle are candidates, however their words are ordered. A candidate counts if the longest common subsequence holds
most of the item's weight, and if the item's answer is there as well.

The benchmark is read in blocks of a fixed number of items, so what goes to the
executors is bounded; every document is searched for every block.
"""

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StructType

from tidemark.llm.arrow import as_batch, fields, map_texts
from tidemark.llm.mixing import stored

TERM = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.?!:])\s+")


@dataclass(frozen=True)
class Retrieval:
    """Parameters of the search.

    Passages have ``passage`` words and start every ``stride``. ``cosine`` is the least
    similarity of a candidate, ``lcs`` and ``answer`` the shares of the weight of an item
    and of its answer that the common subsequence must hold.
    """

    passage: int = 64
    stride: int = 32
    rank: int = 128
    oversample: int = 16
    power: int = 2
    block: int = 20_000
    cosine: float = 0.4
    lcs: float = 0.6
    answer: float = 0.5
    seed: int = 42


# Where words are of the first 256 characters, all others become blanks at once.
BLANKED = "".join(c if TERM.match(c) else " " for c in map(chr, range(256))).encode("latin-1")


def terms(text: str) -> list[str]:
    text = text.lower()
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return TERM.findall(text)
    return data.translate(BLANKED).decode("latin-1").split()


def answer_of(text: str) -> str:
    """The last sentence of an item, which stands for its answer if it names none."""
    return SENTENCE.split(text.strip())[-1]


@dataclass
class Items:
    """A block of benchmark items over a vocabulary of their own words."""

    ids: list[int]
    vocabulary: dict[str, int]
    terms: list[np.ndarray]
    answers: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int, str, str]]) -> "Items":
        rows = [(i, terms(t), terms(a)) for i, t, a in rows]
        rows = [row for row in rows if row[1]]
        words = sorted({w for _, t, a in rows for w in t + a})
        vocabulary = {w: n for n, w in enumerate(words)}

        def numbers(tokens: list[str]) -> np.ndarray:
            return np.array([vocabulary[w] for w in tokens], np.int32)

        return cls(
            [i for i, _, _ in rows],
            vocabulary,
            [numbers(t) for _, t, _ in rows],
            [numbers(a) for _, _, a in rows],
        )


def passage_numbers(sizes: np.ndarray, options: Retrieval) -> np.ndarray:
    """How many passages texts of these sizes have, so that the last one reaches the end."""
    return -(-np.maximum(1, sizes - options.passage + options.stride) // options.stride)


UNKNOWN = np.int32(-1).tobytes()


def numbered(text: str, numbers: dict[str, bytes]) -> bytes:
    """The text's words as numbers of a vocabulary, -1 for others, end to end."""
    return b"".join(map(numbers.get, terms(text), repeat(UNKNOWN)))


def numbers_of(data: bytes | str | None) -> np.ndarray:
    """The numbers of a text as they were stored."""
    return np.frombuffer(data or b"", np.int32)


NUMBERS = fields(numbers=BinaryType())


def numbered_texts(rows: DataFrame, items: Items, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of each row and the numbers of its words, written to be read often.

    Words are cut and looked up once; counts, latent space and search all go by the numbers.
    """
    vocabulary = rows.sparkSession.sparkContext.broadcast(items.vocabulary)

    def make():
        numbers = {w: np.int32(n).tobytes() for w, n in vocabulary.value.items()}
        return lambda text: (numbered(text, numbers),)

    return stored(map_texts(rows, keep, NUMBERS, make), "numbers")


def vector(known: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a passage and their TF-IDF weights, with length one."""
    words, counts = np.unique(known[known >= 0], return_counts=True)
    weights = (1 + np.log(counts)) * idf[words]
    length = np.sqrt((weights**2).sum())
    return words, weights / length if length else weights


def laid_out(known: np.ndarray, sizes: np.ndarray, options: Retrieval) -> np.ndarray:
    """The passages of texts that lie end to end as rows, the last of each filled up with -1."""
    counts = passage_numbers(sizes, options)
    text = np.repeat(np.arange(len(sizes)), counts)
    start = (np.arange(len(text)) - (np.cumsum(counts) - counts)[text]) * options.stride
    padded = np.concatenate([known, np.full(options.passage, -1, np.int32)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, options.passage)
    rows = windows[(np.cumsum(sizes) - sizes)[text] + start]
    left = sizes[text] - start
    short = np.flatnonzero(left < options.passage)
    rows[short] = np.where(np.arange(options.passage) < left[short, None], rows[short], -1)
    return rows


# Passages that are laid out at a time; a longer text is laid out by itself.
LAID_OUT = 4096


def text_blocks(numbers: pa.Array, options: Retrieval) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The stored numbers of some texts at a time, end to end, and how many each has."""
    texts = [numbers_of(data) for data in numbers.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    block = np.cumsum(passage_numbers(sizes, options)) // LAID_OUT
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)]
    for start, end in zip(cuts, cuts[1:]):
        if start < end:
            yield np.concatenate(texts[start:end]), sizes[start:end]


def distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and count of the distinct words of passages given as rows; sorts the rows."""
    width = rows.shape[1]
    rows.sort(axis=1)
    new = rows >= 0
    new[:, 1:] &= rows[:, 1:] != rows[:, :-1]
    at = np.flatnonzero(new)
    owner = at // width
    counts = np.minimum(np.append(at[1:], rows.size), (owner + 1) * width) - at
    return owner, rows.ravel()[at], counts


# Passages that are multiplied at a time: neighbours share many of their words.
TOGETHER = 16


class Weighted:
    """TF-IDF vectors, of length one, of passages given as rows; sorts the rows."""

    def __init__(self, rows: np.ndarray, idf: np.ndarray):
        self.n = len(rows)
        self.owner, self.words, counts = distinct(rows)
        weights = (1 + np.log(counts)) * idf[self.words]
        lengths = np.sqrt(np.bincount(self.owner, weights**2, self.n))
        self.weights = (weights / lengths[self.owner]).astype(np.float32)
        self.bounds = np.searchsorted(self.owner, np.arange(self.n + 1)).tolist()

    def parts(self, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Some passages at a time: first, end, their words, and their vectors over these."""
        here = np.zeros(size, bool)
        place = np.zeros(size, np.int64)
        for first in range(0, self.n, TOGETHER):
            end = min(first + TOGETHER, self.n)
            part = slice(self.bounds[first], self.bounds[end])
            found = self.words[part]
            here[found] = True
            words = np.flatnonzero(here)
            here[words] = False
            place[words] = np.arange(len(words))
            vectors = np.zeros((end - first, len(words)), np.float32)
            vectors[self.owner[part] - first, place[found]] = self.weights[part]
            yield first, end, words, vectors


def passage_counts(
    texts: DataFrame, items: Items, options: Retrieval
) -> tuple[int, int, np.ndarray]:
    """The passages of the corpus, those with a known word, and how many have each word."""
    size = len(items.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 2, np.int64)
        for batch in batches:
            for known, sizes in text_blocks(batch.column(0), options):
                passages = laid_out(known, sizes, options)
                owner, words, _ = distinct(passages)
                total[:size] += np.bincount(words, minlength=size)
                total[size] += len(passages)
                total[size + 1] += np.count_nonzero(np.diff(owner, prepend=-1))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = texts.select("numbers").mapInArrow(count, "at long, n long")
    table = np.zeros(size + 2)
    for at, n in found.groupBy("at").agg(F.sum("n")).collect():
        table[at] = n
    return int(table[size]), int(table[size + 1]), table[:size]


def gram_times(
    texts: DataFrame, idf: np.ndarray, basis: np.ndarray, options: Retrieval
) -> np.ndarray:
    """A'A times a matrix, A being the vectors of all passages: each task adds up its own rows.

    What a task adds up is as large as the matrix, so there are two for each core, however
    long the texts are, and the sums meet word by word.
    """
    context = texts.sparkSession.sparkContext
    shared = context.broadcast((idf, basis.astype(np.float32)))
    size, width = basis.shape

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = shared.value
        total = np.zeros((size, width))
        for batch in batches:
            for known, sizes in text_blocks(batch.column(0), options):
                passages = Weighted(laid_out(known, sizes, options), idf)
                some = np.zeros((size, width), np.float32)
                for _, _, words, vectors in passages.parts(size):
                    some[words] += vectors.T @ (vectors @ basis[words])
                total += some
        rows = np.flatnonzero(total.any(axis=1))
        arrays = [pa.array(rows), pa.array([total[r].tobytes() for r in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["at", "row"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[at] = sums.get(at, 0.0) + np.frombuffer(row)
        arrays = [
            pa.array(list(sums), pa.int64()),
            pa.array([row.tobytes() for row in sums.values()], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["at", "row"])

    schema = "at long, row binary"
    few = texts.select("numbers").coalesce(2 * context.defaultParallelism)
    sums = few.mapInArrow(multiply, schema).repartition("at").mapInArrow(add, schema)
    out = np.zeros((size, width))
    for at, row in sums.collect():
        out[at] = np.frombuffer(row)
    shared.unpersist()
    return out


def latent_space(
    texts: DataFrame, filled: int, items: Items, idf: np.ndarray, options: Retrieval
) -> np.ndarray:
    """The leading right singular vectors of the passages, by randomised subspace iteration.

    Benchmark passages are weighed up to as much as the ``filled`` passages of the corpus,
    or a few hundred items would drown in it.
    """
    size = len(items.vocabulary)
    width = min(size, options.rank + options.oversample)
    draw = np.random.default_rng(options.seed)
    basis = np.linalg.qr(draw.standard_normal((size, width)))[0]
    units = [vector(t, idf) for t in items.terms]
    scale = max(1.0, filled) / len(units)

    def gram(basis: np.ndarray) -> np.ndarray:
        out = gram_times(texts, idf, basis, options)
        for words, weights in units:
            out[words] += scale * np.outer(weights, weights @ basis[words])
        return out

    for _ in range(options.power):
        basis = np.linalg.qr(gram(basis))[0]
    values, turn = np.linalg.eigh(basis.T @ gram(basis))
    return (basis @ turn[:, ::-1])[:, : options.rank].astype(np.float32)


def common_weight(item: np.ndarray, region: np.ndarray, weights: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of an item and a region."""
    best = np.zeros(len(region) + 1)
    for word in item:
        longer = best[:-1] + np.where(region == word, weights[word], -np.inf)
        best[1:] = np.maximum(best[1:], longer)
        np.maximum.accumulate(best, out=best)
    return float(best[-1])


# Angles between passages and items that are looked at at a time.
PRODUCTS = 1 << 22


class Matcher:
    """Searches texts for the items of a block."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray, options: Retrieval):
        self.items, self.idf, self.space, self.options = items, idf, space, options
        self.mass = np.array([idf[t].sum() for t in items.terms])
        self.answer_mass = np.array([idf[a].sum() for a in items.answers])
        # An item longer than a passage is looked for by each of its passages.
        sizes = np.array([len(t) for t in items.terms])
        self.owner = np.repeat(np.arange(len(sizes)), passage_numbers(sizes, options))
        units = laid_out(np.concatenate(items.terms), sizes, options)
        known = np.where(units >= 0, idf[units], 0.0)
        self.units = self.project(units)
        self.all_terms = np.concatenate(items.terms)
        self.first_terms = np.cumsum([0, *map(len, items.terms[:-1])])
        self.least = options.lcs * known.sum(axis=1).min() / 2

    def project(self, passages: np.ndarray) -> np.ndarray:
        """Latent vectors, of length one, of passages given as rows; sorts the rows."""
        out = np.zeros((len(passages), self.space.shape[1]), np.float32)
        for first, end, words, vectors in Weighted(passages, self.idf).parts(len(self.idf)):
            out[first:end] = vectors @ self.space[words]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def candidates(self, known: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Text, start in it and unit of the passages near to an item, of texts end to end."""
        options = self.options
        counts = passage_numbers(sizes, options)
        text = np.repeat(np.arange(len(sizes)), counts)
        starts = (np.arange(len(text)) - (np.cumsum(counts) - counts)[text]) * options.stride
        ends = np.minimum(starts + options.passage, sizes[text])
        weight = np.concatenate([[0.0], np.cumsum(np.where(known >= 0, self.idf[known], 0.0))])
        before = (np.cumsum(sizes) - sizes)[text]
        # Passages with less weight than any item needs can't pass the check below.
        held = weight[before + ends] - weight[before + starts]
        heavy = np.flatnonzero(held >= self.least)
        vectors = self.project(laid_out(known, sizes, options)[heavy])
        rows = max(1, PRODUCTS // len(self.units))
        near = [
            np.argwhere(vectors[n : n + rows] @ self.units.T >= options.cosine) + (n, 0)
            for n in range(0, len(vectors), rows)
        ]
        passage, unit = np.concatenate([np.empty((0, 2), np.int64), *near]).T
        return text[heavy[passage]], starts[heavy[passage]], unit

    def search(self, known: np.ndarray, sizes: np.ndarray) -> list[dict[int, float]]:
        """Items that texts hold, by their numbers end to end, with the share of their weight."""
        found: list[dict[int, float]] = [{} for _ in sizes]
        texts, starts, units = self.candidates(known, sizes)
        first = np.cumsum(sizes) - sizes
        cuts = np.flatnonzero(np.diff(texts, prepend=-1, append=-1)).tolist()
        for begin, end in zip(cuts, cuts[1:]):
            text = texts[begin]
            words = known[first[text] : first[text] + sizes[text]]
            near = zip(starts[begin:end].tolist(), units[begin:end])
            found[text] = self.confirmed(words, near)
        return found

    def confirmed(
        self, known: np.ndarray, near: Iterable[tuple[int, int]]
    ) -> dict[int, float]:
        """The items of a text among its candidates, given as start and unit."""
        options = self.options
        # Items with too little weight in the whole text can't pass either.
        here = np.zeros(len(self.idf))
        there = known[known >= 0]
        here[there] = self.idf[there]
        held = np.add.reduceat(here[self.all_terms], self.first_terms)
        enough = held >= options.lcs * self.mass * (1 - 1e-9)
        found: dict[int, float] = {}
        for start, unit in near:
            number = self.owner[unit]
            if not enough[number]:
                continue
            size = len(self.items.terms[number])
            region = known[max(0, start - size) : start + options.passage + size]
            share = self.check(number, region)
            if share:
                found[number] = max(share, found.get(number, 0.0))
        return {self.items.ids[number]: share for number, share in found.items()}

    def check(self, number: int, region: np.ndarray) -> float:
        """The share of an item's weight in the common subsequence; 0 if it fails a check."""
        item, answer = self.items.terms[number], self.items.answers[number]
        region = region[region >= 0]
        here = np.zeros(len(self.idf), bool)
        here[region] = True
        there = here[item]
        if self.idf[item[there]].sum() < self.options.lcs * self.mass[number]:
            return 0.0
        share = common_weight(item, region, self.idf) / self.mass[number]
        if share < self.options.lcs:
            return 0.0
        if len(answer):
            held = common_weight(answer, region, self.idf)
            if held < self.options.answer * self.answer_mass[number]:
                return 0.0
        return share


def fit_matcher(texts: DataFrame, items: Items, options: Retrieval) -> Matcher:
    total, filled, counts = passage_counts(texts, items, options)
    idf = np.log((total + 1.0) / (counts + 1.0)) + 0.1
    space = latent_space(texts, filled, items, idf, options)
    return Matcher(items, idf, space, options)


def benchmark_blocks(benchmark: DataFrame, size: int) -> Iterator[Items]:
    """The items, at most about ``size`` at a time."""
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = benchmark.select("item_id", "text", answer.alias("answer")).filter("text IS NOT NULL")
    blocks = -(-items.count() // size)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted((i if i is not None else -1, t, a or answer_of(t)) for i, t, a in part.collect())
        found = Items.of(rows)
        if found.ids:
            yield found


MATCH = fields(item_ids=ArrayType(LongType()), best_lcs=DoubleType())


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    options: Retrieval | None = None,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The columns ``keep`` of each row, the benchmark items in its text, and a verdict.

    ``item_ids`` are sorted, ``best_lcs`` is the largest share of an item's weight found
    (0 for none), ``contaminated`` is true if there is an item. Null and empty texts have
    none; neither does any text if the benchmark is empty. An item without an id counts
    as -1, one without words is left out. Repeated rows stay. The latent space is fitted
    anew for each block of items, on all rows of ``docs``.
    """
    options = options or Retrieval()
    context = docs.sparkSession.sparkContext
    kept = [F.col(c).alias(f"_{i}") for i, c in enumerate(keep)]
    names = [f"_{i}" for i in range(len(keep))]
    none = F.array().cast("array<bigint>")
    found = docs.select(*kept, "text", none.alias("found"), F.lit(0.0).alias("best"))
    blocks = list(benchmark_blocks(benchmark, options.block))
    for turn, items in enumerate(blocks, 1):
        # The texts themselves are needed again for the words of the next block alone.
        again = ["text"] if turn < len(blocks) else []
        keep_on = [*names, *again, "found", "best"]
        texts = numbered_texts(found, items, keep_on)
        shared = context.broadcast(fit_matcher(texts, items, options))

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                blocks = text_blocks(batch.column(len(keep_on)), options)
                hits = [h for known, sizes in blocks for h in shared.value.search(known, sizes)]
                values = [sorted(set(h)) for h in hits], [max(h.values(), default=0.0) for h in hits]
                kept = [batch.column(i) for i in range(len(keep_on))]
                columns = kept + as_batch(values, MATCH)
                yield pa.RecordBatch.from_arrays(columns, [*keep_on, "item_ids", "best_lcs"])

        schema = StructType([texts.schema[c] for c in keep_on] + MATCH)
        found = texts.select(*keep_on, "numbers").mapInArrow(match, schema).select(
            *names,
            *again,
            F.sort_array(F.array_union("found", "item_ids")).alias("found"),
            F.greatest("best", "best_lcs").alias("best"),
        )
    return found.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)),
        F.col("found").alias("item_ids"),
        F.col("best").alias("best_lcs"),
        (F.size("found") > 0).alias("contaminated"),
    )
