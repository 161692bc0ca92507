"""Removing passages that an earlier document has, by super-k-mers.

A window is a number of consecutive words. Its minimiser is the smallest hash among
the short word sequences in it, and consecutive windows that share one travel as a
single packed string, about three words for each window in place of thirteen. Equal
windows have equal minimisers, so they meet in one bucket, where sorting brings them
together and the smallest id of each is found exactly.

The rows that a slice of an Arrow batch has for one bin of buckets travel as a single
compressed block. A passage that very many documents share is folded before it travels:
of the rows of one slice with the same packed string, only the smallest id goes to the
bucket. The others are known to be covered already, and travel by their id. So a bucket gets
at most one row per slice and string.

Where neighbouring words differ, so do the packed strings of a shared passage. Buckets
that a sample shows to be large are therefore not used: their windows travel one by one
to buckets of their own hash, folded in the same way. That is exact, whatever the sample
says, since all windows of one minimiser take the same way.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from tidemark.llm.arrow import ARROW
from tidemark.llm.words import WORDS

SEED = 42
# Fixed odd multipliers that mix the hashes of neighbouring words.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
# Characters of documents for each bin, of which a task holds one at a time, and the
# level at which its blocks are compressed.
BIN_CHARS = 4_500_000
LEVEL = 6
SLICE_BYTES = 6_000_000
# Rows from which on a bucket counts as large, and of how many documents one is in the
# sample that tells.
HOT = 50_000
SAMPLE = 32
# Bits of the filter that holds the large buckets, and windows of these that a task remembers.
FILTER_BITS = 1 << 26
REMEMBERED = 100_000
# Bytes of a text whose words are hashed at a time.
HASHED_BYTES = 1 << 20
# Upper half of a place: which text of the id, should rows with one id differ in it.
TEXT_SHIFT = 32

Mark = tuple[int, int, int]


def text_number(text: str) -> int:
    """31 bits that tell apart the texts of rows with the same id."""
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), SEED) >> 33


def single_spaced(text: str) -> bytes:
    """The words of a text in UTF-8, joined by one space."""
    return b" ".join(text.encode("utf-8", "surrogatepass").split())


@lru_cache(maxsize=2)
def powers(base: int, count: int) -> np.ndarray:
    """1, base, base squared and so on, modulo 2**64."""
    factors = np.full(count, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word: their polynomial in a fixed odd base.

    It is read off sums over all bytes before an end and before a start, so no word is
    handled by itself. Equal hashes of different words only make a bucket larger.
    """
    found = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = starts[at]
        end = max(at + 1, int(np.searchsorted(ends, begin + HASHED_BYTES)))
        size = int(ends[end - 1] - begin)
        room = max(HASHED_BYTES, 1 << size.bit_length())
        sums = np.zeros(size + 1, np.uint64)
        up = powers(MIX[0], room)[:size]
        np.cumsum((data[begin : begin + size] + np.uint64(1)) * up, out=sums[1:])
        first = starts[at:end] - begin
        down = powers(pow(MIX[0], -1, 2**64), room)[first]
        found[at:end] = (sums[ends[at:end] - begin] - sums[first]) * down
        at = end
    found ^= found >> np.uint64(32)
    return found * np.uint64(MIX[1])


def minimisers(single: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The minimiser of each window, as a signed long."""
    count = len(single) - gram + 1
    mixed = np.zeros(count, np.uint64)
    for i in range(gram):
        mixed = (mixed ^ single[i : i + count]) * np.uint64(MIX[i % len(MIX)])
        mixed ^= mixed >> np.uint64(29)
    spans = np.lib.stride_tricks.sliding_window_view(mixed, window - gram + 1)
    return spans.min(axis=1).view(np.int64)


def super_kmers(spaced: bytes, window: int, gram: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(bucket, first window, windows, words) for each run of windows with one minimiser."""
    data = np.frombuffer(spaced, np.uint8)
    gaps = np.flatnonzero(data == ord(" "))
    if len(gaps) + 1 < window:
        return
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(data)]])
    smallest = minimisers(word_hashes(data, starts, ends), window, gram)
    firsts = np.flatnonzero(np.diff(smallest, prepend=~smallest[0]))
    counts = np.diff(firsts, append=len(smallest))
    begin, end = starts[firsts], ends[firsts + counts + window - 2]
    columns = (smallest[firsts], firsts, counts, begin, end)
    for bucket, first, count, a, b in zip(*(c.tolist() for c in columns)):
        yield bucket, first, count, spaced[a:b]


ROWS = pa.schema(
    [
        ("bucket", pa.uint32()),
        ("packed", pa.binary()),
        ("doc", pa.int64()),
        ("place", pa.int64()),
        ("windows", pa.int32()),
    ]
)


def as_block(columns: list[pa.Array]) -> bytes:
    """Rows without their schema, which all blocks share."""
    return zstandard.compress(pa.RecordBatch.from_arrays(columns, schema=ROWS).serialize(), LEVEL)


def from_blocks(blocks: list[bytes]) -> pa.Table:
    """The rows of a bin in order of their buckets."""
    parts = [pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(b)), ROWS) for b in blocks]
    return pa.Table.from_batches(parts).sort_by("bucket").combine_chunks()


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``SLICE_BYTES`` of text, which bounds a task's memory."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def folded(
    batch: pa.RecordBatch, window: int, gram: int
) -> Iterator[tuple[int, bytes | None, int, int, int, dict[bytes, int]]]:
    """(bucket, words, doc, place, windows) of a slice's super-k-mers by doc, and the smallest
    doc of each string so far; no words if a smaller one has them."""
    first: dict[bytes, int] = {}
    pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    for doc, text in sorted((d, t) for d, t in pairs if d is not None and t):
        number = text_number(text) << TEXT_SHIFT
        for bucket, start, count, packed in super_kmers(single_spaced(text), window, gram):
            known = first.setdefault(packed, doc) < doc
            yield bucket, None if known else packed, doc, number | start, count, first


class Buckets:
    """A set of buckets as a filter of a fixed size: it has all of them, and may have others."""

    def __init__(self, bits: bytes):
        self.bits = bits

    def __contains__(self, bucket: int) -> bool:
        place = bucket % FILTER_BITS
        return self.bits[place >> 3] >> (place & 7) & 1 == 1


def hot_buckets(docs: DataFrame, window: int, gram: int) -> Buckets:
    """Minimisers that get about ``HOT`` rows or more, judged by a sample of the documents.

    However many there are, the driver gets the set words of one filter.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = folded(batch, window, gram)
            found = Counter(bucket for bucket, packed, *_ in rows if packed is not None)
            columns = [pa.array(list(c), pa.int64()) for c in (found.keys(), found.values())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "n"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("doc_id", "text")
    sums = sample.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    place = F.pmod("bucket", F.lit(FILTER_BITS))
    cells = sums.filter(F.col("n") * SAMPLE >= HOT).select(
        F.floor(place / 64).alias("cell"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bits"),
    )
    held = np.zeros(FILTER_BITS // 64, np.int64)
    for cell, bits in cells.groupBy("cell").agg(F.bit_or("bits")).collect():
        held[cell] = bits
    return Buckets(held.tobytes())


def pack_rows(
    docs: DataFrame, window: int, gram: int, bins: int, hot: Buckets | None = None
) -> DataFrame:
    """(bin, block): super-k-mers as rows of ``ROWS``, one block for each slice and bin.

    A row without a packed string is a mark: windows that are known to be in a document
    with a smaller id. Windows of ``hot`` buckets are rows of their own, in the bucket of
    their hash; one that a task has met often is folded over all its slices, so a window
    that is in every text leaves a task as a few rows. Buckets that share 32 bits and a bin are taken together, which
    is harmless, since windows are compared in full.
    """

    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        # Windows met twice in a slice, and the smallest id so far; more are not remembered.
        often: dict[bytes, int] = {}
        for batch in in_slices(batches):
            rows = []
            for bucket, packed, doc, place, count, first in folded(batch, window, gram):
                if packed is None:
                    rows.append((doc, None, doc, place, count))
                elif hot is None or bucket not in hot:
                    rows.append((bucket, packed, doc, place, count))
                else:
                    words = packed.split(b" ")
                    for at in range(count):
                        part = b" ".join(words[at : at + window])
                        if often.get(part, doc) < doc or first.setdefault(part, doc) < doc:
                            rows.append((doc, None, doc, place + at, 1))
                            if part in often or len(often) < REMEMBERED:
                                often[part] = min(often.get(part, doc), first.get(part, doc))
                        else:
                            own = xxhash.xxh64_intdigest(part, SEED) - 2**63
                            rows.append((own, part, doc, place + at, 1))
            if not rows:
                continue
            buckets, *others = zip(*rows)
            mixed = np.array(buckets, np.int64).view(np.uint64) * np.uint64(MIX[0])
            low = (mixed & np.uint64(2**32 - 1)).astype(np.uint32)
            places = (mixed >> np.uint64(32)) % np.uint64(bins)
            table = [pa.array(low), *(pa.array(c, f.type) for c, f in zip(others, list(ROWS)[1:]))]
            order = np.argsort(places, kind="stable")
            ends = np.flatnonzero(np.diff(places[order], append=bins))
            begin = 0
            for end in ends + 1:
                at = pa.array(order[begin:end])
                block = as_block([c.take(at) for c in table])
                bin_no = int(places[order[begin]])
                arrays = [pa.array([bin_no]), pa.array([block], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["bin", "block"])
                begin = end

    return docs.select("doc_id", "text").mapInArrow(pack, "bin long, block binary")


def runs(flags: list[bool]) -> Iterator[tuple[int, int]]:
    """(start, length) of each run of true values."""
    at = 0
    for value, group in groupby(flags):
        size = sum(1 for _ in group)
        if value:
            yield at, size
        at += size


def marks_of_bucket(rows: list[tuple[bytes, int, int]], window: int) -> Iterator[Mark]:
    """Windows of (packed, doc, place) rows that are also in a row with a smaller doc."""
    found = []
    for row, (packed, doc, _) in enumerate(rows):
        tokens = packed.split(b" ")
        found += [
            (b" ".join(tokens[i : i + window]), doc, row, i) for i in range(len(tokens) - window + 1)
        ]
    found.sort()
    covered: dict[int, set[int]] = {}
    for _, same in groupby(found, key=lambda x: x[0]):
        (_, smallest, *_), *others = same
        for _, doc, row, i in others:
            if doc > smallest:
                covered.setdefault(row, set()).add(i)
    for row, places in covered.items():
        _, doc, place = rows[row]
        for start, size in runs([i in places for i in range(max(places) + 1)]):
            yield doc, place + start, size


def find_marks(rows: DataFrame, window: int) -> DataFrame:
    """Marks (doc, place, windows) of all windows that a smaller id has as well."""
    names = ["doc", "place", "windows"]

    def batch_of(marks: list[Mark]) -> pa.RecordBatch:
        columns = zip(*marks) if marks else [()] * 3
        types = [pa.int64(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def marks_in(table: pa.Table) -> list[Mark]:
        """Marks of whole buckets, in order."""
        found = []
        mark = table.column("packed").is_null().to_numpy()
        known = table.filter(pa.array(mark)).select(names)
        found += zip(*(c.to_pylist() for c in known.columns))
        table = table.filter(pa.array(~mark))
        if not table.num_rows:
            return found
        buckets, docs = (table.column(c).to_numpy() for c in ("bucket", "doc"))
        starts = np.flatnonzero(np.diff(buckets, prepend=~buckets[:1]))
        sizes = np.diff(starts, append=len(buckets))
        several = np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
        for start, size in zip(starts[several].tolist(), sizes[several].tolist()):
            part = (table.column(c).slice(start, size) for c in ("packed", "doc", "place"))
            found += marks_of_bucket(list(zip(*(c.to_pylist() for c in part))), window)
        return found

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = None, []
        for batch in batches:
            for number, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if blocks and number != held:
                    yield batch_of(marks_in(from_blocks(blocks)))
                    blocks = []
                held = number
                blocks.append(block)
        if blocks:
            yield batch_of(marks_in(from_blocks(blocks)))

    dealt = rows.repartition("bin").sortWithinPartitions("bin")
    return dealt.mapInArrow(meet, "doc long, place long, windows int")


def remove_marked(text: str, places: list[int], counts: list[int], window: int) -> tuple:
    """Words, words removed, and the words that are kept, joined by one space."""
    tokens = WORDS.findall(text)
    if not places:
        return len(tokens), 0, " ".join(tokens)
    number = text_number(text)
    drop = np.zeros(len(tokens) + 1, np.int64)
    for place, count in zip(places, counts):
        if place >> TEXT_SHIFT == number:
            start = place & (2**TEXT_SHIFT - 1)
            drop[start] += 1
            drop[start + count + window - 1] -= 1
    gone = drop.cumsum()[:-1] > 0
    kept = [w for w, g in zip(tokens, gone) if not g]
    return len(tokens), len(tokens) - len(kept), " ".join(kept)


def dedup_substrings(
    docs: DataFrame, window: int = 13, gram: int = 3, digest: bool = False
) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept_text`` of each document.

    Every word is removed that lies in a window whose words also start a window in a
    document with a smaller id; windows are judged on the input. The kept words are
    joined by one space. With ``digest`` the last column is ``kept_sha256`` instead, the
    digest of that text in UTF-8. A null text has no words. A row without an id neither
    loses words nor takes any. Rows that repeat an id are each judged by their own text,
    and never against one another.
    """
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    hot = hot_buckets(docs, window, gram) if size > HOT else None
    marks = find_marks(pack_rows(docs, window, gram, 1 + size // BIN_CHARS, hot), window)
    lists = marks.groupBy(F.col("doc").alias("_doc")).agg(
        F.collect_list(F.struct("place", "windows")).alias("marks")
    )
    joined = docs.select("doc_id", "text").join(lists, F.col("doc_id") == F.col("_doc"), "left")
    joined = joined.select(
        "doc_id",
        "text",
        F.col("marks.place").alias("places"),
        F.col("marks.windows").cast(ArrayType(LongType())).alias("windows"),
    )
    last = "kept_sha256" if digest else "kept_text"
    names = ["doc_id", "n_words", "n_removed", last]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, places, counts in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                n, removed, kept = remove_marked(text or "", places or [], counts or [], window)
                if digest:
                    kept = hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()
                found.append((n, removed, kept))
            columns = zip(*found) if found else [()] * 3
            types = [ARROW[LongType()], ARROW[LongType()], ARROW[StringType()]]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {kind}, n_words long, n_removed long, {last} string")
