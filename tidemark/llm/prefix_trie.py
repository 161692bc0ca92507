"""A trie of conversations: which of them start alike, and what sharing those starts saves.

Every distinct start of a conversation is a node. A node's id is a digest of its turns,
found band by band: within a band of ``BAND`` turns from the turns themselves, above that
from the digests of whole bands, which are a shorter sequence treated the same way. So no
group ever holds more than a band of one conversation, however long that is.

Sums over subtrees follow the same bands. Each node explodes to its ancestors within its
own band only; the roots of bands, with what is below them in their band, are a smaller
trie, which is rolled up in the same way; its totals then reach the ancestors of each root
within the band above. A depth of d takes log(d) rounds, and no node becomes more than
``BAND`` + 1 rows in any of them.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import stored

BAND = 16
ROOT = b"root"
# Conversation ids that travel to a node's digest as one row.
CHUNK = 1000


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, digest, n_bytes) of every turn, ``place`` counting from 0 by turn.

    Null turns come first, ties are ordered by content, and a null role or text is an empty
    one. Rows without a conversation id belong to none and are left out. The rows are
    sorted by range and counted within each range, so a conversation of any length is
    dealt over many tasks; what its earlier ranges hold is added to the count of a later one.
    """
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    rows = (
        conversations.filter("conv_id IS NOT NULL")
        .select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        )
        # Repeated rows are apart too, or a great number of them would be one range.
        .withColumn("row", F.monotonically_increasing_id())
    )
    order = [F.asc_nulls_first("turn"), F.asc("digest"), F.asc("row")]
    ranged = stored(
        rows.repartitionByRange(F.asc("conv_id"), *order).withColumn("part", F.spark_partition_id()),
        "turns",
    )
    held = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("held"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row for each range: the conversation that it starts in the midst of.
    before = held.select("conv_id", "part", F.sum("held").over(earlier).alias("before")).filter(
        "before > 0"
    )
    counted = ranged.withColumn(
        "place",
        F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("long") - 1,
    )
    return counted.join(before, ["conv_id", "part"], "left").select(
        "conv_id",
        (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"),
        "digest",
        "n_bytes",
    )


def heads(conv_id: Column, most: int) -> Column:
    """How many turns a conversation takes from the first of its family, below ``most``."""
    return F.crc32(conv_id.cast("string")) % most


def with_shared_heads(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the first turns of the first one of their family.

    Result: the turns, and (conv_id, n_turns) of all conversations, those without turns too.
    A family is ``family`` ids in a row; its first one may be missing and gives no turns then.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    lengths = lengths.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % family).alias("first"),
        heads(F.col("conv_id"), most).alias("head"),
    )
    firsts = lengths.filter("conv_id = first").select("first", F.col("n").alias("n_first"))
    convs = lengths.join(firsts, "first", "left").select(
        "conv_id",
        "first",
        "head",
        F.least("head", F.coalesce("n_first", F.lit(0))).alias("taken"),
        F.greatest(F.col("n") - F.col("head"), F.lit(0)).alias("own"),
    )
    convs = stored(convs, "conversations")
    place = F.col("place")
    own = turns.join(convs.select("conv_id", "head", "taken"), "conv_id").filter("place >= head")
    shared = turns.filter(place < most - 1).withColumnRenamed("conv_id", "first")
    shared = shared.join(convs, "first").filter("place < taken")
    rebuilt = own.withColumn("place", place - F.col("head") + F.col("taken")).select(
        "conv_id", "place", "digest", "n_bytes"
    )
    rebuilt = rebuilt.union(shared.select("conv_id", "place", "digest", "n_bytes"))
    return rebuilt, convs.select("conv_id", (F.col("taken") + F.col("own")).alias("n_turns"))


def _named(top: Column) -> Column:
    """The id of the start that goes on from ``top`` with the turns of column ``start``."""
    return F.unhex(F.md5(F.concat(top, F.unhex("start"))))


def _starts(rows: DataFrame, deepest: int, band: int) -> list[DataFrame]:
    """Each place of each sequence with the id of the start that ends there, and ``above``.

    ``rows`` are (conv_id, place, digest); columns besides these are kept. ``above`` are the
    ids of the shorter starts in the same band, the root of the band first. The first frame
    is for ``rows``, the next for the sequences of their whole bands, and so on.
    """
    no = F.floor(F.col("place") / band)
    so_far = Window.partitionBy("conv_id", "no").orderBy("place")
    local = rows.withColumn("no", no).withColumn(
        "start", F.md5(F.array_join(F.collect_list("digest").over(so_far), ""))
    )
    last = F.col("place") % band == band - 1
    levels: list[DataFrame] = []
    if deepest >= band:
        whole = local.filter(last).select(
            "conv_id", F.col("no").alias("place"), F.col("start").alias("digest")
        )
        levels = _starts(whole, deepest // band, band)
        ends = levels[0].select("conv_id", F.col("place").alias("no"), F.col("id").alias("end"))
        tops = ends.select("conv_id", (F.col("no") + 1).alias("no"), F.col("end").alias("top"))
        local = local.join(tops, ["conv_id", "no"], "left").join(ends, ["conv_id", "no"], "left")
        top = F.coalesce("top", F.lit(ROOT))
        named = F.when(last, F.col("end")).otherwise(_named(top))
    else:
        top = F.lit(ROOT)
        named = _named(top)
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    found = (
        local.withColumn("id", named)
        .withColumn("above", F.concat(F.array(top), F.collect_list("id").over(before)))
        .drop("no", "start", "top", "end", "digest")
    )
    return [stored(found, "starts"), *levels]


def _rolled_up(levels: list[DataFrame], own: DataFrame) -> DataFrame:
    """(id, leaves, saved): sums of ``own`` over the subtree of each node of the first level.

    ``levels`` are the nodes (id, above) of a trie, then those of the trie of its band
    roots, and so on; the root is in all of them, with nothing above it.
    """
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    nodes = levels[0].join(own, "id", "left").fillna(0, ["leaves", "saved"])
    if len(levels) > 1:
        in_band = nodes.filter(F.size("above") > 0).groupBy(F.element_at("above", 1).alias("id"))
        below = _rolled_up(levels[1:], in_band.agg(*sums))
        below = below.select(
            "id", F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")
        )
        nodes = nodes.join(below, "id", "left").select(
            "id",
            F.expr("slice(above, 2, size(above))").alias("above"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
    reached = F.explode(F.concat(F.array("id"), "above")).alias("id")
    return stored(nodes.select(reached, "leaves", "saved").groupBy("id").agg(*sums), "rolled-up")


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256): the SHA-256 of the conversation ids of each node, in order.

    The ids are sorted by range, so those of one node may lie in many tasks, and joined to
    strings of ``CHUNK`` ids. Only the digest itself reads a node's strings one after the
    other, as SHA-256 must, and holds one Arrow batch of them at a time.
    """
    ranged = ends.repartitionByRange("id", "conv_id").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ends")
    here = Window.partitionBy("id", "part").orderBy("conv_id")
    chunk = F.floor((F.row_number().over(here) - 1) / CHUNK).alias("chunk")
    listed = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = (
        ranged.select("id", "part", "conv_id", chunk)
        .groupBy("id", "part", "chunk")
        .agg(F.array_join(listed, ",").alias("ids"))
        .repartition("id")
        .sortWithinPartitions("id", "part", "chunk")
        .select("id", "ids")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def rows(names: list[bytes], found: list[str]) -> pa.RecordBatch:
            arrays = [pa.array(names, pa.binary()), pa.array(found, pa.string())]
            return pa.RecordBatch.from_arrays(arrays, ["id", "ends_sha256"])

        for batch in batches:
            names: list[bytes] = []
            found: list[str] = []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = ids.as_py().encode()
                if name == node:
                    state.update(b",")
                else:
                    if node is not None:
                        names.append(node)
                        found.append(state.hexdigest())
                    node, state = name, hashlib.sha256()
                state.update(text)
            yield rows(names, found)
        if node is not None:
            yield rows([node], [state.hexdigest()])

    return chunks.mapInArrow(digest, "id binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of the trie of conversations.

    ``turns`` are (conv_id, place, digest, n_bytes), places counting from 0 without a gap;
    ``convs`` are (conv_id, n_turns), one row for each conversation. Result, one row per
    distinct start: ``conv_id`` (smallest of the conversations that start so), ``depth``,
    ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` and
    ``saved_tokens`` of the subtree, ``ends_sha256`` of the ids that end there. The root has
    depth 0. No conversations: no rows.
    """
    longest = convs.agg(F.max("n_turns")).first()[0]
    levels = _starts(turns, (longest or 0) - 1, band)
    parent = F.element_at("above", -1)
    nodes = levels[0].groupBy("id").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("place").alias("place"),
        F.first("above").alias("above"),
        F.first("n_bytes").alias("n_bytes"),
    )
    nothing = F.array().cast("array<binary>")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).select(
        F.lit(ROOT).alias("id"),
        "conv_id",
        "n_convs",
        F.lit(-1).cast("long").alias("place"),
        nothing.alias("above"),
        F.lit(0).cast("long").alias("n_bytes"),
    )
    nodes = stored(nodes.union(root.filter("n_convs > 0")), "nodes")

    children = nodes.filter(F.size("above") > 0).groupBy(parent.alias("id")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = stored(nodes.join(children, "id", "left").fillna(0, ["n_children"]), "nodes")
    tries = [nodes.select("id", "above")]
    for level in levels[1:]:
        tries.append(
            level.groupBy("id").agg(F.first("above").alias("above")).union(
                nodes.filter(F.col("id") == ROOT).select("id", "above")
            )
        )
    own = nodes.select(
        "id",
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    sums = _rolled_up(tries, own)

    last = levels[0].join(convs, "conv_id").filter(F.col("place") == F.col("n_turns") - 1)
    ends = last.select("id", "conv_id").union(
        convs.filter("n_turns = 0").select(F.lit(ROOT).alias("id"), "conv_id")
    )
    parents = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.withColumn("parent", F.when(F.size("above") > 0, parent))
        .join(sums, "id")
        .join(_digests_of_ends(ends), "id", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            (F.col("place") + 1).alias("depth"),
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """The trie of conversations that share the first turns of their family (see above)."""
    turns, convs = with_shared_heads(stored(ordered_turns(conversations), "places"), family, most)
    return prefix_trie(turns, convs)
