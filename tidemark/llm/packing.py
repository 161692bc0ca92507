"""Packing documents into sequences of a fixed number of tokens.

Each task packs what it reads, block by block, by best-fit decreasing: a document of more
than a window is first cut into full windows; what is left of it goes, longest first, to
the open window with the least room that still holds it, which a segment tree over the
remaining capacities finds. Windows that are still short of their capacity by more than
``slack`` are emptied and their pieces laid end to end, cut where a window ends. So a task
is left with less than one window, its tail. The tails of all tasks, a few kilobytes each,
are packed once more in the same way. The last tail of all is cut at powers of two, which
need no padding.

Nothing but the tails is shuffled, so neither a hot document nor a hot length matters, and
a task holds one block of tokens at a time. Tokens are written below
``spark.checkpoint.dir`` before the tails are packed.
"""

import importlib.util
import os
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cache
from pathlib import Path
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructType
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm.arrow import fields
from tidemark.llm.mixing import stored

# Bytes of text that are cut into words at once, and of remembered words and their ids.
SLICE = 1 << 22
SLICE_ROWS = 10_000
REMEMBERED = 80 << 20
ENTRY = 180
SPACE = re.compile(r"[\x09-\x0D\x20]")
ID_BYTES = 4
LETTERS, MARKS = "abcdefghijklmnopqrstuvwxyzäéñßłжω", ".,;:!?"
# Letters below this are such in every version of Unicode.
OLD_LETTERS = "\u0500"
# Tokens that leave a task in one Arrow batch, about.
BATCH_TOKENS = 1 << 20
# Tails that are packed in one task.
TAILS = 256
# Sequence numbers of a task are kept apart by this many bits.
TASK_BITS = 32

ADDED = fields(
    start=LongType(),
    length=LongType(),
    ids=BinaryType(),
    doc_tokens=LongType(),
    task=LongType(),
    window=LongType(),
    offset=LongType(),
    tail=BooleanType(),
)


@dataclass(frozen=True)
class PackOptions:
    """Sizes of a packing.

    ``window`` tokens make a sequence, ``end`` closes every document, and a window that
    lacks up to ``slack`` tokens counts as full. ``block`` tokens are packed at once.
    ``vocabulary`` is a file that the tokenizers library reads; the default is the public
    word vocabulary that is installed as a package.
    """

    window: int = 2048
    end: int = 1
    slack: int = 8
    block: int = 1 << 21
    vocabulary: str = ""


def default_vocabulary() -> str:
    """The public word vocabulary that is installed as a package."""
    spec = importlib.util.find_spec("public_tokenizers")
    root = Path(spec.origin).parent if spec else Path("/opt/tokenizers")
    return str(root / "word_bpe_49k.json")


def is_plain(word: str) -> bool:
    """Whether a word is lower-case letters as they are."""
    if not word.isalpha() or word != word.lower():
        return False
    return word.isascii() or (max(word) < OLD_LETTERS and is_normalized("NFC", word))


class Letters(dict):
    """Letters as a byte-level vocabulary spells them: a character for each byte."""

    def __missing__(self, letter: str) -> str:
        spelled = BYTES.pre_tokenize_str(letter)[0][0]
        self[letter] = spelled
        return spelled


BYTES = ByteLevel(add_prefix_space=False, use_regex=False)


class Subwords:
    """Token ids of texts, as little-endian unsigned 32-bit numbers.

    The vocabulary drops white space and no token spans it, so a text has the ids of its
    words one after the other, and a word is cut only once as long as it is remembered. It
    knows no capitals either: A-Z are lower-cased first, so that both forms are one word.
    Names of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0
        self.letters = Letters()
        self.plain = self._leaves_plain_words()

    def _leaves_plain_words(self) -> bool:
        """Whether this vocabulary cuts words between letters and marks, and nowhere else."""
        steps = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if None in steps:
            return False
        text = steps[0].normalize_str(f"{LETTERS}{MARKS}")
        parts = [part for part, _ in steps[1].pre_tokenize_str(text)]
        return parts == ["".join(map(self.letters.__getitem__, LETTERS)), MARKS]

    def _plain(self, word: str) -> bytes:
        """The ids of lower-case letters, which nothing cuts or changes before the model."""
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(word)]).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember these words. Most are letters, which need the model alone."""
        odd: list[str] = []
        for word in words:
            if ids := self.older.get(word):
                self.known[word] = ids
            elif self.plain and is_plain(word):
                self.known[word] = self._plain(word)
            else:
                odd.append(word)
        found = self.tokenizer.encode_batch_fast(odd, add_special_tokens=False)
        self.known.update((w, array("I", e.ids).tobytes()) for w, e in zip(odd, found))
        self.size += sum(map(len, words)) + ENTRY * len(words)

    def _of_texts(self, texts: pa.Array) -> Iterator[bytes]:
        if self.size > REMEMBERED:  # words not met for long are forgotten
            self.known, self.older, self.size = {}, self.known, 0
        texts = pc.ascii_lower(texts)
        if self.plain:
            # Letters and the marks behind them are words of their own, of which there are fewer.
            texts = pc.replace_substring_regex(texts, "([a-z])([.,;:!?])", r"\1 \2")
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        if unknown := [w for w in names if w not in self.known]:
            self._learn(unknown)
        ids = pa.array([self.known[w] for w in names], pa.large_binary()).take(coded.indices)
        places = np.frombuffer(ids.buffers()[1], np.int64)[words.offsets.to_numpy()]
        data = ids.buffers()[2]
        for start, end in zip(places, places[1:]):
            yield data[start:end].to_pybytes()

    def ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; words are cut for about a slice of text at once."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        texts = texts.fill_null("")
        at = 0
        while at < len(texts):
            held = np.cumsum(sizes[at : at + SLICE_ROWS])
            if held[0] > SLICE:
                parts = pa.array(list(slices(texts[at].as_py())), pa.string())
                yield b"".join(b"".join(self._of_texts(parts[i : i + 1])) for i in range(len(parts)))
                at += 1
            else:
                n = max(1, int(np.searchsorted(held, SLICE)))
                yield from self._of_texts(texts[at : at + n])
                at += n


def slices(text: str) -> Iterator[str]:
    """A text in parts of about ``SLICE`` characters, cut at white space."""
    at = 0
    while at < len(text):
        cut = SPACE.search(text, at + SLICE)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


# Python workers are reused, and what they remember with them.
subwords = cache(Subwords)


@dataclass(frozen=True)
class Piece:
    """Consecutive tokens of one document; ``row`` has the columns it is kept with."""

    row: tuple
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, at: int) -> "tuple[Piece, Piece]":
        head, rest = self.ids[: at * ID_BYTES], self.ids[at * ID_BYTES :]
        return replace(self, ids=head), replace(self, start=self.start + at, ids=rest)


class OpenWindows:
    """Windows by remaining capacity, with a segment tree over the capacities.

    A node counts the windows below it, so the tightest one that holds a length is found
    by climbing to the first subtree to the right that is not empty, and going down it.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(self.leaves)]

    def _add(self, remaining: int, n: int) -> None:
        node = self.leaves + remaining
        while node:
            self.count[node] += n
            node >>= 1

    def put(self, window: int, remaining: int) -> None:
        self.windows[remaining].append(window)
        self._add(remaining, 1)

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of ``length`` or more that a window has."""
        node = self.leaves + length
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.count[node]
        return node - self.leaves

    def take(self, remaining: int) -> int:
        self._add(remaining, -1)
        return self.windows[remaining].pop()


def best_fit(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the places of the lengths that share a window, for each one."""
    windows: list[list[int]] = []
    tree = OpenWindows(capacity)
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[place]
        remaining = tree.tightest(length)
        if remaining is None:
            window, remaining = len(windows), capacity
            windows.append([])
        else:
            window = tree.take(remaining)
        windows[window].append(place)
        if remaining > length:
            tree.put(window, remaining - length)
    return windows


def end_to_end(pieces: Sequence[Piece], sizes: Iterator[int]) -> Iterator[list[Piece]]:
    """The pieces one after the other, in windows of the given sizes; the last may be short."""
    window: list[Piece] = []
    left = next(sizes)
    for piece in pieces:
        while piece.length > left:
            head, piece = piece.cut(left)
            yield [*window, head]
            window, left = [], next(sizes)
        window.append(piece)
        left -= piece.length
        if not left:
            yield window
            window, left = [], next(sizes, 0)
    if window:
        yield window


def same(size: int) -> Iterator[int]:
    while True:
        yield size


def powers(total: int) -> Iterator[int]:
    """The powers of two that a total is the sum of, largest first."""
    return (1 << bit for bit in reversed(range(total.bit_length())) if total >> bit & 1)


def pack(
    pieces: Iterator[Piece], options: PackOptions, last: bool
) -> Iterator[tuple[list[Piece], bool]]:
    """Windows of pieces, and whether one is the tail, which stays below a full window.

    The ``last`` tail of all is cut into windows of powers of two.
    """
    pool: list[Piece] = []
    held = 0

    def packed() -> Iterator[list[Piece]]:
        nonlocal pool, held
        loose: list[Piece] = []
        for places in best_fit([p.length for p in pool], options.window):
            found = [pool[i] for i in places]
            if sum(p.length for p in found) >= options.window - options.slack:
                yield found
            else:
                loose += found
        pool, held = [], 0
        for found in end_to_end(loose, same(options.window)):
            if (total := sum(p.length for p in found)) == options.window:
                yield found
            else:
                pool, held = found, total

    for piece in pieces:
        while piece.length > options.window:
            head, piece = piece.cut(options.window)
            yield [head], False
        pool.append(piece)
        held += piece.length
        if held >= options.block:
            yield from ((w, False) for w in packed())
    yield from ((w, False) for w in packed())
    if pool and last:
        yield from ((w, False) for w in end_to_end(pool, powers(held)))
    elif pool:
        yield pool, True


def _pieces_of_texts(
    batches: Iterator[pa.RecordBatch], n_keep: int, options: PackOptions
) -> Iterator[Piece]:
    words = subwords(options.vocabulary or default_vocabulary())
    end = options.end.to_bytes(ID_BYTES, "little")
    for batch in batches:
        kept = [batch.column(i).to_pylist() for i in range(n_keep)]
        for place, ids in enumerate(words.ids(batch.column(n_keep).cast(pa.string()))):
            ids += end
            yield Piece(tuple(k[place] for k in kept), 0, ids, len(ids) // ID_BYTES)


def _pieces_of_tails(
    batches: Iterator[pa.RecordBatch], n_keep: int, options: PackOptions
) -> Iterator[Piece]:
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *row, start, ids, doc_tokens in zip(*columns):
            yield Piece(tuple(row), start, ids, doc_tokens)


def _windows(
    rows: DataFrame,
    keep: list[str],
    pieces: Callable[..., Iterator[Piece]],
    options: PackOptions,
    last: bool,
) -> DataFrame:
    """Pieces with the window and the place in it that the task of their rows gives them."""
    schema = StructType([rows.schema[c] for c in keep] + ADDED)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        types: list[pa.DataType] = []

        def typed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types[:] = [batch.schema.field(i).type for i in range(len(keep))]
                yield batch

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            kinds = [*types, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4, pa.bool_()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
            return pa.RecordBatch.from_arrays(columns, names)

        found: list[tuple] = []
        held = 0
        for number, (window, tail) in enumerate(
            pack(pieces(typed(), len(keep), options), options, last)
        ):
            offset = 0
            for p in window:
                found.append(
                    (*p.row, p.start, p.length, p.ids, p.doc_tokens, task, number, offset, tail)
                )
                offset += p.length
            held += offset
            if held >= BATCH_TOKENS:
                yield batch_of(found)
                found, held = [], 0
        if found:
            yield batch_of(found)

    return rows.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    options: PackOptions = PackOptions(),
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents, and the sequence and place each one goes to.

    Result: the columns ``keep``, then ``start`` (tokens of its document before the piece),
    ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens`` (of the whole
    document, with its end), ``sequence_id`` and ``offset`` (tokens before it in its
    sequence). Every token of every row is in exactly one piece. A sequence has ``window``
    tokens, or up to ``slack`` less, or a power of two.

    A null or empty text has its end alone. Rows that repeat an id, or lack one, are
    documents of their own. Columns other than ``keep`` and ``text`` are not read; one in
    ``keep`` with the name of a result is an error. No rows: no pieces. Sequence numbers
    depend on how Spark cuts the table into tasks; they are the same if a task is run again.
    """
    keep = list(dict.fromkeys(keep))
    results = {f.name for f in ADDED} | {"sequence_id"}
    if clash := results & set(keep):
        raise ValueError(f"columns {sorted(clash)} have the names of results")
    texts = docs.select(*keep, docs[text].alias("_text"))
    packed = stored(_windows(texts, keep, _pieces_of_texts, options, last=False), "packed")

    tasks = packed.agg(F.max("task")).first()[0]
    tasks = 0 if tasks is None else tasks + 1
    tails = (
        packed.filter("tail")
        .repartition(1 + tasks // TAILS, "task")
        .sortWithinPartitions("task", "offset")
        .select(*keep, "start", "ids", "doc_tokens")
    )
    again = _windows(tails, keep, _pieces_of_tails, options, last=True)
    again = again.withColumn("task", F.col("task") + tasks)
    number = F.shiftleft(F.col("task"), TASK_BITS) + F.col("window")
    return (
        packed.filter("NOT tail")
        .union(again)
        .select(
            *keep,
            "start",
            "length",
            "ids",
            "doc_tokens",
            number.alias("sequence_id"),
            "offset",
        )
    )
