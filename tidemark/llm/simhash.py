"""Near copies by SimHash, found by the general pigeonhole principle.

Two fingerprints within t differing bits agree closely in at least one of m parts of
their bits, however t - m + 1 is shared out as thresholds of the parts. Correlated
bits go to the same part; the shares come from a dynamic programme over estimated
candidate counts, so that a part whose values are crowded gets a small threshold, or
none at all. A fingerprint is stored under its value in each part, and probes the
values within that part's threshold; what meets is verified on all 64 bits.

Equal fingerprints are one from the start. Buckets that are too large for a task are
cut into blocks, and pairs of blocks meet in tasks of their own. Only the edges of a
spanning forest leave a task, never all pairs.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.arrow import fields, map_texts
from tidemark.llm.components import components
from tidemark.llm.mixing import stored
from tidemark.llm.words import WORDS, lower_ascii

BITS = 64
SEED = 42
PIECE = 8
# What shuffling one row costs, in pairs verified.
ROW_COST = 30
# Rows of a bucket that meet in one task; two blocks at most.
BLOCK = 512
PART_SHIFT = 40

# Roles of a row in a bucket: stored and probing at once, probe only, and in a bucket
# cut into blocks the two sides of a pair of blocks.
BOTH, PROBE, LEFT, RIGHT = range(4)
MEET = np.zeros((4, 4), bool)
for _a, _b in ((BOTH, BOTH), (BOTH, PROBE), (PROBE, RIGHT), (LEFT, RIGHT)):
    MEET[_a, _b] = MEET[_b, _a] = True


def fingerprint(text: str, shingle: int = 4) -> int:
    """The SimHash of a text's word shingles as a signed long; zero for no words."""
    tokens = [w.encode("utf-8", "surrogatepass") for w in WORDS.findall(lower_ascii(text))]
    if not tokens:
        return 0
    starts = range(max(1, len(tokens) - shingle + 1))
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + shingle]), SEED) for i in starts]
    rows = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(rows), 4096):
        counts += np.unpackbits(rows[at : at + 4096], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(rows), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and its ``fp``."""
    return map_texts(docs, keep, fields(fp=LongType()), lambda: lambda t: (fingerprint(t, shingle),))


@dataclass(frozen=True)
class Partition:
    """Bits that are compared together, and how many of them may differ."""

    bits: tuple[int, ...]
    threshold: int


def bit_pairs(distinct: DataFrame) -> np.ndarray:
    """How many fingerprints have both of two bits; the diagonal counts single bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(rows, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).round()
        at = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    sums = distinct.select("fp").mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n"))
    table = np.zeros(BITS * BITS)
    for at, n in sums.collect():
        table[at] = n
    return table.reshape(BITS, BITS)


def group_bits(pairs: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """Bits in groups of nearly equal size, each grown by the bit most correlated with it."""
    share = np.diag(pairs) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(pairs / n - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left = set(range(BITS))
    groups = []
    for part in range(parts):
        size = BITS // parts + (part < BITS % parts)
        first = max(sorted(left), key=lambda b: related[b, sorted(left)].sum())
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(sorted(left), key=lambda b: related[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(tuple(group))
    return groups


def pieces_of(bits: tuple[int, ...]) -> list[tuple[int, ...]]:
    return [bits[i : i + PIECE] for i in range(0, len(bits), PIECE)]


def values_of(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    """The given bits of each fingerprint, packed into a number."""
    out = np.zeros(len(fps), np.int64)
    for place, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def piece_counts(distinct: DataFrame, pieces: list[tuple[int, ...]]) -> np.ndarray:
    """For each piece of at most 8 bits, how many fingerprints have each value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(pieces), 2**PIECE), np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for row, bits in zip(total, pieces):
                row += np.bincount(values_of(fps, bits), minlength=2**PIECE)
        at = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "n"])

    sums = distinct.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n"))
    table = np.zeros(len(pieces) * 2**PIECE)
    for at, n in sums.collect():
        table[at] = n
    return table.reshape(len(pieces), -1)


def distance_shares(counts: np.ndarray) -> np.ndarray:
    """The share of pairs that differ in 0, 1, .. 8 bits of a piece."""
    share = counts / max(1.0, counts.sum())
    values = np.arange(len(share))
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    return np.bincount(distance.ravel(), np.outer(share, share).ravel(), PIECE + 1)


def part_costs(n: int, width: int, shares: list[np.ndarray], most: int) -> list[float]:
    """Cost of thresholds -1, 0, .. most: candidate pairs expected, and rows to shuffle."""
    total = np.array([1.0])
    for share in shares:
        total = np.convolve(total, share)
    costs = [0.0]
    rows = 0.0
    for t in range(most + 1):
        rows += comb(width, t) / (2 if t else 1)
        costs.append(n * n / 2 * total[: t + 1].sum() + ROW_COST * n * rows)
    return costs


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least summed cost that add up to ``total``; index 0 of a part is -1."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for i, more in enumerate(part):
                now = (cost + more, chosen + [i - 1])
                key = used + i - 1
                if key not in step or now < step[key]:
                    step[key] = now
        best = step
    return best[total]


def plan_partitions(distinct: DataFrame, distance: int, parts: range = range(2, 7)) -> list[Partition]:
    """Parts and thresholds of least expected cost for these fingerprints."""
    n = distinct.count()
    pairs = bit_pairs(distinct)
    groups = {m: group_bits(pairs, max(n, 1), m) for m in parts}
    pieces = [p for m in parts for bits in groups[m] for p in pieces_of(bits)]
    shares = iter([distance_shares(row) for row in piece_counts(distinct, pieces)])
    found = []
    for m in parts:
        costs = [
            part_costs(n, len(bits), [next(shares) for _ in pieces_of(bits)], distance)
            for bits in groups[m]
        ]
        found.append((*allocate(costs, distance - m + 1), m))
    _, thresholds, m = min(found)
    return [Partition(b, t) for b, t in zip(groups[m], thresholds) if t >= 0]


def flips(width: int, threshold: int) -> list[tuple[int, int]]:
    """Masks of 1 to ``threshold`` bits, each with its highest bit."""
    return [
        (sum(1 << b for b in chosen), 1 << max(chosen))
        for size in range(1, threshold + 1)
        for chosen in combinations(range(width), size)
    ]


def signatures(distinct: DataFrame, partitions: list[Partition]) -> DataFrame:
    """Rows (key, fp, role): where each fingerprint is stored, and the values that it probes.

    Of two values that differ, only the larger probes the other.
    """
    masks = [flips(len(p.bits), p.threshold) for p in partitions]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(keys, fps, role):
            roles = np.full(len(fps), role, np.int8)
            arrays = [pa.array(x) for x in (keys, fps, roles)]
            return pa.RecordBatch.from_arrays(arrays, ["key", "fp", "role"])

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for number, part in enumerate(partitions):
                base = np.int64(number) << PART_SHIFT
                values = values_of(fps.view(np.uint64), part.bits)
                yield batch_of(base + values, fps, BOTH)
                for mask, high in masks[number]:
                    larger = (values & high) != 0
                    yield batch_of(base + (values[larger] ^ mask), fps[larger], PROBE)

    return distinct.select("fp").mapInArrow(emit, "key long, fp long, role tinyint")


def in_blocks(rows: DataFrame) -> DataFrame:
    """The rows with the cell (x, y) of their bucket; 0, 0 where it has one block only.

    A bucket of n rows sends n * n / ``BLOCK`` rows through the shuffle, each pair of which
    meets in one cell. The plan weighs that: parts are chosen by the sum of n * n over their
    buckets, so a table for which it outgrows the cost of further parts gets more of them.
    """
    crowded = rows.groupBy("key").count().filter(F.col("count") > BLOCK)
    crowded = stored(
        crowded.select(
            F.col("key").alias("_key"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")
        ),
        "crowded",
    )
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)

    def cell(x, y, role):
        return F.struct(x.alias("x"), y.alias("y"), F.lit(role).cast("tinyint").alias("role"))

    probes = F.transform(every, lambda i: cell(block, i, PROBE))
    kept = F.concat(
        F.transform(F.sequence(block, F.col("blocks") - 1), lambda i: cell(block, i, LEFT)),
        F.transform(every, lambda i: cell(i, block, RIGHT)),
    )
    alone = F.array(
        F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.col("role").alias("role"))
    )
    cells = F.when(F.col("blocks").isNull(), alone).when(F.col("role") == PROBE, probes).otherwise(kept)
    joined = rows.join(crowded, F.col("key") == F.col("_key"), "left")
    return joined.select("key", "fp", F.explode(cells).alias("c")).select("key", "c.x", "c.y", "fp", "c.role")


def roots(labels: np.ndarray) -> np.ndarray:
    while not np.array_equal(labels, up := labels[labels]):
        labels = up
    return labels


def links(cells: np.ndarray, fps: np.ndarray, roles: np.ndarray, distance: int) -> np.ndarray:
    """For each row the first row linked to it, directly or through others of the same cell."""
    labels = np.arange(len(fps))
    at, step = np.arange(len(fps)), 0
    while True:
        step += 1
        at = at[at + step < len(fps)]
        at = at[cells[at] == cells[at + step]]
        if not len(at):
            return labels
        other = at + step
        near = np.bitwise_count(fps[at] ^ fps[other]) <= distance
        near &= MEET[roles[at], roles[other]]
        a, b = labels[at[near]], labels[other[near]]
        for i, j in zip(a[a != b].tolist(), b[a != b].tolist()):
            while labels[i] != i:
                i = labels[i]
            while labels[j] != j:
                j = labels[j]
            labels[max(i, j)] = min(i, j)
        labels = roots(labels)


def near_edges(rows: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) of a spanning forest in each cell."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if not len(part[0]):
                continue
            if held is not None:
                part = [np.concatenate(pair) for pair in zip(held, part)]
            # The last cell may go on in the next batch.
            same = (part[0] == part[0][-1]) & (part[1] == part[1][-1]) & (part[2] == part[2][-1])
            held = [x[same] for x in part]
            yield from edges_of([x[~same] for x in part])
        if held is not None:
            yield from edges_of(held)

    def edges_of(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, xs, ys, fps, roles = part
        if len(fps) < 2:
            return
        change = (np.diff(keys) != 0) | (np.diff(xs) != 0) | (np.diff(ys) != 0)
        cells = np.concatenate([[0], np.cumsum(change)])
        labels = links(cells, fps.view(np.uint64), roles, distance)
        linked = fps != fps[labels]
        arrays = [pa.array(fps[linked]), pa.array(fps[labels][linked])]
        yield pa.RecordBatch.from_arrays(arrays, ["u", "v"])

    dealt = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return dealt.mapInArrow(verify, "u long, v long").distinct()


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint and component_id of each document.

    Fingerprints link at ``distance`` or fewer differing bits; a component has all that
    are linked through others, and its id is the smallest doc_id in it. A null or empty
    text has fingerprint zero. One row per row of ``docs``, repeated ones included; a
    component whose ids are all null has a null id.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    partitions = plan_partitions(distinct, distance)
    tree = components(near_edges(in_blocks(signatures(distinct, partitions)), distance))
    rooted = distinct.join(tree, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("root", "fp").alias("root"), "first_id"
    )
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first_id").alias("component_id"))
    smallest = stored(smallest, "smallest")
    named = rooted.join(smallest, F.col("root") == F.col("_root")).select("_fp", "component_id")
    return marked.join(stored(named, "named"), F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
