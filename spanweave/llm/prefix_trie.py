"""The trie of conversation prefixes, built by the recursion of van Emde Boas trees.

A trie of height 2h is cut at half depth into an upper trie of height h and the forest of lower tries that
hang from its lowest nodes. The sequences are cut alike: their first halves make the upper trie, and
their second halves, grouped by the cut prefix before them, the lower ones. Both are built by the same
recursion. All tries of one height are independent of each other, so a level of the recursion is one
set-oriented job over all of them, and a trie of depth D takes log2 D levels each way:

* ``block_names``  upwards: names of the aligned blocks of 1, 2, 4, ... turns of a sequence.
* ``name_prefixes`` downwards: a cut prefix is a pair (prefix at the cut above, block between); its name is
  the smallest conversation that has it. Every prefix is named once, at the level that cuts there.
* ``graft`` upwards: the total of a lower trie goes to the cut node it hangs from, and from there to
  the nodes above in its upper trie, no further; the next level carries it on.

No step handles a conversation or a group as a whole: rows are single turns or blocks, groups are
pre-aggregated, and joins on a name are salted. Both sides of every join grow with the conversations, and their
files say little of it (a few bytes hold a row of numbers), so all joins are sort-merge joins by hint: a side
that looks small would be built at the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.operators.lineage import materialize
from spanweave.operators.salting import salted_join

#: Conversation ids that are joined into one piece before a node's pieces are hashed in order.
PIECE_IDS = 1 << 14


def number_turns(df: DataFrame) -> DataFrame:
    """``conv_id, i, symbol, words`` of ``conv_id, turn, role, text``: turns counted from 0.

    Rows of one turn number are ordered by role and text. Turns are range-partitioned, so a
    conversation spreads over many tasks; they are written because the counts must see the same ranges.
    """
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    placed = materialize(
        df.repartitionByRange("conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", digest.alias("symbol"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
        .withColumn("_at", F.monotonically_increasing_id()),
        "trie-turns",
    )
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy("conv_id", part.alias("_part")).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("conv_id", "_part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return (
        placed.withColumn("_part", part)
        .join(shifts.hint("merge"), ["conv_id", "_part"])
        .select("conv_id", (F.col("_at") + F.col("shift")).alias("i"), "symbol", "words")
    )


def rebuild(turns: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Give every conversation the first turns of the head of its family in place of its own.

    The head of c is c - c % family, the number of turns crc32(c) % most. Returns the rebuilt turns
    (``conv_id, i, symbol, words``) and ``conv_id, length``, also of conversations without turns.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    head = F.col("conv_id") - F.col("conv_id") % family
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = lengths.select(F.col("conv_id").alias("head"), F.col("own").alias("there"))
    convs = (
        lengths.withColumns({"head": head, "h": taken})
        .join(heads.hint("merge"), "head", "left")
        .withColumn("k", F.least(F.col("h"), F.coalesce("there", F.lit(0))))
        .withColumn("length", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    )
    convs = materialize(convs.select("conv_id", "head", "h", "k", "length"), "trie-conversations")
    # At most most - 1 turns of a head, for at most ``family`` conversations.
    opening = turns.where(F.col("i") < most - 1).withColumnRenamed("conv_id", "head")
    given = convs.join(opening.hint("merge"), "head").where("i < k").select("conv_id", "i", "symbol", "words")
    own = salted_join(turns, convs.select("conv_id", "h", "k"), ["conv_id"], ["i"]).where("i >= h")
    own = own.select("conv_id", (F.col("i") - F.col("h") + F.col("k")).alias("i"), "symbol", "words")
    return given.unionByName(own), convs.select("conv_id", "length")


def block_names(symbols: DataFrame, height: int) -> list[DataFrame]:
    """``conv_id, j, symbol`` of the whole aligned blocks of 1, 2, 4, ... up to height / 2 turns."""
    levels, size = [symbols.select("conv_id", F.col("i").alias("j"), "symbol")], 2
    while size < height:
        half = F.when(F.col("j") % 2 == F.lit(0), F.col("symbol"))
        other = F.when(F.col("j") % 2 == F.lit(1), F.col("symbol"))
        pairs = levels[-1].groupBy("conv_id", F.shiftright("j", 1).alias("j")).agg(F.max(half).alias("a"), F.max(other).alias("b"))
        named = pairs.where("b IS NOT NULL").select("conv_id", "j", F.unhex(F.md5(F.concat("a", "b"))).alias("symbol"))
        levels.append(materialize(named, "trie-blocks"))
        size *= 2
    return levels


def name_prefixes(levels: Sequence[DataFrame], convs: DataFrame) -> DataFrame:
    """``conv_id, depth, name``: the smallest conversation that shares the first ``depth`` turns.

    At the level of height h the depths h, 3h, 5h, ... are cut. The prefix before such a block was named
    at a level above; depth 0 has one name, the smallest of all.
    """
    first = convs.agg(F.min("conv_id")).first()[0]  # one number
    known = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(first).cast("long").alias("name"))
    for level, blocks in reversed(list(enumerate(levels))):
        h = 1 << level
        cut = blocks.where(F.col("j") % 2 == 0).select("conv_id", (F.col("j") * h).alias("depth"), "symbol")
        below = cut.join(known.hint("merge"), ["conv_id", "depth"]).select("conv_id", (F.col("depth") + h).alias("depth"), F.col("name").alias("above"), "symbol")
        below = materialize(below, "trie-cut")
        smallest = below.groupBy("depth", "above", "symbol").agg(F.min("conv_id").alias("name"))
        named = salted_join(below, smallest, ["depth", "above", "symbol"], ["conv_id"]).select("conv_id", "depth", "name")
        known = known.unionByName(materialize(named, "trie-names"))
    return known


def graft(paths: DataFrame, nodes: DataFrame, sums: Sequence[str], height: int) -> DataFrame:
    """Sums over every node's subtree, itself included.

    ``nodes``: ``name, depth, parent`` and the columns ``sums`` of each node alone. ``paths``: ``conv_id,
    depth, name`` of every prefix. Before the level of height h a node's sums cover its descendants in
    its own trie of height h, depths (s, s + h] under the root at depth s, a multiple of h.
    """
    totals, h = nodes, 1
    while h < height:
        # What hangs from the cut nodes: roots of lower tries are children of nodes at odd multiples of h.
        hanging = (
            totals.where((F.col("depth") - 1) % (2 * h) == h)
            .groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("cut"))
            .agg(*[F.sum(c).alias(c) for c in sums])
        )
        # The path above a cut node within its upper trie: h depths of the conversation it is called after.
        block = F.shiftright(F.col("depth") - 1, h.bit_length() - 1)
        above = paths.where("depth > 0").withColumn("block", block).where("block % 2 = 0")
        roots = hanging.withColumn("block", F.shiftright(F.col("cut") - 1, h.bit_length() - 1))
        given = (
            salted_join(above, roots.drop("cut"), ["conv_id", "block"], ["depth"])
            .select("name", "depth", *sums)
            .unionByName(totals.select("name", "depth", *sums))
            .groupBy("name", "depth")
            .agg(*[F.sum(c).alias(c) for c in sums])
        )
        parents = nodes.select("name", "depth", "parent")
        totals = materialize(parents.join(given.hint("merge"), ["name", "depth"]), "trie-totals")
        h *= 2
    # Depth 0 hangs above the topmost trie.
    top = totals.where("depth <= 1").agg(F.min(F.when(F.col("depth") == 0, F.col("name"))).alias("name"), *[F.sum(c).alias(c) for c in sums])
    root = top.where("name IS NOT NULL").select("name", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), *sums)
    return totals.where("depth > 0").unionByName(root.select(*totals.columns))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def ends_digest(ends: DataFrame) -> DataFrame:
    """``name, depth, n_ends, ends``: SHA-256 of the ids that end at a node, ascending and comma-joined.

    Ids are sorted by ranges and joined into pieces in parallel. Hashing a node's pieces is serial by
    definition; it streams them in order.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, key, ids = [], None, []
        for batch in batches:
            for name, depth, conv_id in zip(*(batch.column(c).to_pylist() for c in order)):
                if ids and (key != (name, depth) or len(ids) == PIECE_IDS):
                    made.append((*key, ids[0], len(ids), ",".join(map(str, ids))))
                    ids = []
                key = (name, depth)
                ids.append(conv_id)
            # Pieces of a few ids are many to a batch, long ones few.
            if made:
                yield _batch(made, PIECE)
                made = []
        if ids:
            yield _batch([(*key, ids[0], len(ids), ",".join(map(str, ids)))], PIECE)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, key, state, n = [], None, None, 0
        for batch in batches:
            for name, depth, count, text in zip(*(batch.column(c).to_pylist() for c in ("name", "depth", "n", "piece"))):
                if key != (name, depth):
                    if key is not None:
                        made.append((*key, n, state.hexdigest()))
                    key, state, n = (name, depth), hashlib.sha256(), 0
                elif n:
                    state.update(b",")
                state.update(text.encode())
                n += count
            if made:
                yield _batch(made, DIGEST)
                made = []
        if key is not None:
            yield _batch([(*key, n, state.hexdigest())], DIGEST)

    order = ["name", "depth", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "name long, depth long, first long, n long, piece string")
    pieces = pieces.repartition("name", "depth").sortWithinPartitions("name", "depth", "first")
    return pieces.mapInArrow(digest, "name long, depth long, n_ends long, ends string")


PIECE = pa.schema([("name", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("piece", pa.string())])
DIGEST = pa.schema([("name", pa.int64()), ("depth", pa.int64()), ("n_ends", pa.int64()), ("ends", pa.string())])


def trie(symbols: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of sequences: ``symbols`` (``conv_id, i, symbol, words``), ``convs`` (``conv_id, length``).

    One row a node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_words``, ``n_ends``, ``ends_sha256``.
    """
    symbols = materialize(symbols, "trie-symbols")
    longest = convs.agg(F.max("length")).first()[0]
    if longest is None:
        longest = -1  # no conversations, so not even a root
    height = 1
    while height < longest:
        height *= 2
    levels = block_names(symbols, 2 * height) if longest > 0 else []
    spark = symbols.sparkSession
    if longest < 0:
        paths = spark.createDataFrame([], "conv_id long, depth long, name long")
    else:
        paths = materialize(name_prefixes(levels, convs), "trie-paths")
    members = paths.groupBy("name", "depth").agg(F.count(F.lit(1)).alias("n_convs"))
    # The prefix one turn shorter and the last turn, both read off the conversation a node is called after.
    own = paths.where("conv_id = name")
    shorter = paths.select(F.col("conv_id").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = symbols.select(F.col("conv_id").alias("name"), (F.col("i") + 1).alias("depth"), "words")
    nodes = (
        own.select("name", "depth")
        .join(members.hint("merge"), ["name", "depth"])
        .join(shorter.hint("merge"), ["name", "depth"], "left")
        .join(last.hint("merge"), ["name", "depth"], "left")
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children.hint("merge"), ["name", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    alone = nodes.withColumns(
        {
            "n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"),
            "saved_words": (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0).cast("long")),
        }
    )
    alone = materialize(alone, "trie-alone")
    sums = ["n_leaves", "saved_words"]
    totals = graft(paths, alone.select("name", "depth", "parent", *sums), sums, height)
    ends = paths.join(convs.select("conv_id", F.col("length").alias("depth")).hint("merge"), ["conv_id", "depth"])
    empty = hashlib.sha256(b"").hexdigest()
    return (
        alone.drop(*sums, "parent", "words")
        .join(totals.hint("merge"), ["name", "depth"])
        .join(ends_digest(ends).hint("merge"), ["name", "depth"], "left")
        .select(
            F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", *sums,
            F.coalesce("n_ends", F.lit(0).cast("long")).alias("n_ends"), F.coalesce("ends", F.lit(empty)).alias("ends_sha256"),
        )
    )


def conversation_trie(
    df: DataFrame,
    family: int = 20,
    most: int = 4,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The prefix trie of the conversations, each rebuilt on the first turns of the head of its family.

    Turns are ordered by number, nulls first, then role and text; a null role or text is empty, repeated
    rows are turns of their own. Rows without a conversation id are left out, and other columns too.
    Texts are compared whole by a 128-bit digest, however long. Without conversations there are no rows.
    ``family=1`` leaves the conversations as they are.
    """

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = df.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("text")
    ).where("conv_id IS NOT NULL")
    turns = materialize(number_turns(rows), "trie-numbered")
    return trie(*rebuild(turns, family, most))
