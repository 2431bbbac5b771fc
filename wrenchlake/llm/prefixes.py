"""Prefix trie of conversations by ROLLUP over positional turn columns.

A turn's id is the digest of its role and text, followed by the text's length.
Conversations with the same turns are one row with a number of copies. Their
first turns stand side by side in a block of columns, and ROLLUP over these
columns aggregates all prefixes of the block together: grouping_id tells the
depth, the row at depth d is the node of the first d turns. Conversations that
share the last node of a block go on in a further block of columns, keyed by
that node; one that is alone from there on is a chain, whose nodes are its
turns. Blocks get wider, so that long shared beginnings need few of them.

Sums over subtrees need no walk through the trie. Each node is owned by its
smallest conversation, so a conversation owns the nodes from some depth on.
What a subtree holds is then a sum over its conversations of the length of
their turns, of the nodes they own and of whether they own a leaf, less the
owner's part above the subtree; ROLLUP adds these up. A node's children are
its owner's next turn and the conversations whose own nodes begin below it.

Defined cases: rows without conv_id belong to no conversation. Turns are
ordered by turn (null first), then role, then text; equal rows are turns each.
Null roles and texts are empty. A conversation of a rebuilt table without any
turn is a member of the root alone. Without conversations there is no node.
Other columns are ignored, and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wrenchlake.operators.skew import bounded
from wrenchlake.session import materialise

# Columns of the first block, and of the widest one; each block is twice as wide as the one before.
FIRST_COLUMNS = 8
MOST_COLUMNS = 32
# Turn numbers that are counted through together; a longer conversation is cut into slices of so many.
SLICE_TURNS = 1_024

_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_id(role, text):
    """20 bytes: digest of role and text, and the text's code points."""
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.md5(whole.cast("binary"))), F.unhex(F.lpad(F.hex(F.length(text)), 8, "0")))


def _length(turn):
    """The code points that a turn id carries."""
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def numbered_turns(conversations: DataFrame, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """conv_id, pos (from 1), turn_id of every turn.

    A slice of turn numbers is counted through in one task, so a conversation
    of any length is spread over many.
    """
    own = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    own = own.withColumn("part", F.floor(F.col("turn") / F.lit(slice_turns)))
    sizes = own.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy(F.col("part").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    later = sizes.withColumn("skipped", F.sum("n").over(before)).filter("skipped > 0")
    later = bounded(later.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "skipped"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    placed = own.withColumn("place", place).join(later, (F.col("conv_id") == F.col("_conv")) & F.col("part").eqNullSafe(F.col("_part")), "left")
    return placed.select(
        "conv_id", (F.col("place") + F.coalesce("skipped", F.lit(0))).cast("long").alias("pos"), turn_id(F.col("role"), F.col("text")).alias("turn_id")
    )


def rebuilt(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their group: all conv_ids, and conv_id, pos, turn_id.

    Conversation c takes its first h = crc32(c) % ``most`` turns from
    conversation c - c % ``group``, then its own turns after its first h.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = turns.select("conv_id").distinct().withColumn("head", head.cast("long")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    firsts = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < most)).groupBy("conv_id").agg(F.collect_list(F.struct("pos", "turn_id")).alias("first"))
    firsts = firsts.select(F.col("conv_id").alias("base"), F.array_sort("first").alias("first"))
    convs = convs.join(firsts, "base", "left").withColumn("first", F.slice(F.coalesce("first", F.array().cast("array<struct<pos:bigint,turn_id:binary>>")), F.lit(1), F.col("head").cast("int")))
    convs = materialise(convs.withColumn("taken", F.size("first").cast("long")).select("conv_id", "head", "taken", "first"), "convs")
    borrowed = convs.select("conv_id", F.explode("first").alias("f")).select("conv_id", "f.pos", "f.turn_id")
    own = turns.join(convs.select("conv_id", "head", "taken"), "conv_id").filter(F.col("pos") > F.col("head"))
    kept = own.select("conv_id", (F.col("taken") + F.col("pos") - F.col("head")).alias("pos"), "turn_id")
    return convs.select("conv_id"), borrowed.unionByName(kept)


def _classes(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, conv_id) of every conversation and one row per class: class, copies, n_turns, chars.

    A class is its smallest conv_id; it stands for all conversations with the same turns.
    """
    signs = [F.bit_xor(F.xxhash64(F.lit(k), "pos", "turn_id")).alias(f"s{k}") for k in (1, 2)]
    whole = turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"), F.sum(_length(F.col("turn_id"))).alias("chars"), *signs)
    # What a conversation without turns has.
    whole = convs.join(whole, "conv_id", "left").fillna(0, ["n_turns", "chars", "s1", "s2"])
    same = ["n_turns", "chars", "s1", "s2"]
    whole = materialise(whole, "signs")
    classes = materialise(whole.groupBy(*same).agg(F.min("conv_id").alias("class"), F.count(F.lit(1)).alias("copies")), "classes")
    members = whole.join(classes.select("class", *same), same).select("class", "conv_id")
    return members, classes.select("class", "copies", "n_turns", "chars")


def _digests(members: DataFrame) -> DataFrame:
    """class, ends_sha256: the members' ids in ascending order, hashed as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None

        def out(pairs: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.string())], ["class", "ends_sha256"])

        for batch in batches:
            done = []
            for own, conv in zip(batch.column("class").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if own != held:
                    if state is not None:
                        done.append((held, state.hexdigest()))
                    held, state = own, hashlib.sha256(str(conv).encode())
                else:
                    state.update(f",{conv}".encode())
            yield out(done)
        if state is not None:
            yield out([(held, state.hexdigest())])

    ordered = members.repartition("class").sortWithinPartitions("class", "conv_id")
    return ordered.mapInArrow(run, "class long, ends_sha256 string")


def _key(low: int, columns: list[str], depth):
    """Digest of the node at a depth on the way of a row of a block; the node that the block is keyed by is its depth ``low``."""
    way = F.concat(F.lit(b""), *[F.coalesce(F.when(depth >= low + k + 1, F.col(c)), F.lit(b"")) for k, c in enumerate(columns)])
    return F.when(depth == low, F.col("_node")).otherwise(F.unhex(F.sha2(F.concat("_node", way), 256)))


def _rolled(wide: DataFrame, columns: list[str], low: int, sums: list) -> DataFrame:
    """One row per prefix of a block: key, depth, above (the length of its turns but the last) and the sums."""
    together = wide.rollup("_node", *columns).agg(F.grouping_id().alias("_gid"), F.min("_chars").alias("_before"), *sums)
    nodes = together.withColumn("depth", (low + len(columns) - F.bit_count("_gid")).cast("long"))
    own = F.col("depth") - low
    last = F.element_at(F.array(*columns), F.greatest(own, F.lit(1)).cast("int"))
    # A null in a prefix means that the conversation has ended before it; later blocks begin below the node they are keyed by.
    nodes = nodes.filter((own > 0) & last.isNotNull() | (own == 0) & F.lit(low == 0))
    above = F.col("_before")
    for k, c in enumerate(columns):
        above = above + F.when(own >= k + 2, _length(F.col(c))).otherwise(0)
    return nodes.withColumns({"key": _key(low, columns, F.col("depth")), "above": above}).drop("_gid", "_before", "_node", *columns)


def _wide(rows: DataFrame, turns: DataFrame, low: int, columns: list[str]) -> DataFrame:
    """``rows`` (by class) with their turns low + 1, low + 2, ... in ``columns``."""
    place = F.col("pos") - low
    block = turns.filter(place.between(1, len(columns)))
    side = block.groupBy("class").agg(*[F.max(F.when(place == k + 1, F.col("turn_id"))).alias(c) for k, c in enumerate(columns)])
    return rows.join(side, "class", "left")


def _blocks(classes: DataFrame, turns: DataFrame, first_columns: int, most_columns: int) -> list[tuple]:
    """(low, columns, rows, nodes) of every block; nodes hold key, depth, above, owner and classes."""
    low, width, out = 0, first_columns, []
    rows = classes.withColumns({"_node": F.lit(b""), "_chars": F.lit(0).cast("long")})
    while True:
        columns = [f"_t{k}" for k in range(width)]
        wide = materialise(_wide(rows, turns, low, columns), "block")
        found = materialise(_rolled(wide, columns, low, [F.min("class").alias("owner"), F.count(F.lit(1)).alias("classes")]), "nodes")
        out.append((low, columns, wide, found))
        shared = found.filter((F.col("depth") == low + width) & (F.col("classes") > 1)).select(F.col("key").alias("_next"))
        here = F.col("_chars")
        for c in columns:
            here = here + _length(F.col(c))
        further = wide.filter(F.col(columns[-1]).isNotNull() & (F.col("n_turns") > low + width))
        further = further.withColumns({"_next": _key(low, columns, F.lit(low + width)), "_chars": here}).join(shared, "_next", "left_semi")
        rows = materialise(further.drop("_node").withColumnRenamed("_next", "_node").select(*rows.columns), "further")
        if rows.isEmpty():
            return out
        low, width = low + width, min(2 * width, most_columns)


def _places(blocks: list[tuple], classes: DataFrame, depth: str, up: int) -> DataFrame:
    """class and key of its node ``up`` above the depth that the column of ``classes`` names (null: none)."""
    out = None
    for low, columns, wide, _ in blocks:
        within = (F.col(depth) > low) & (F.col(depth) <= low + len(columns))
        if not up and not low:
            within = within | (F.col(depth) == 0)
        own = wide.drop(*[c for c in (depth,) if c in wide.columns]).join(classes.select("class", depth).filter(within), "class")
        own = own.select("class", _key(low, columns, F.col(depth) - up).alias("key"))
        out = own if out is None else out.unionByName(own)
    return out


def _lengths_before(turns: DataFrame, slice_turns: int = SLICE_TURNS) -> DataFrame:
    """class, pos, before: the length of the class's earlier turns, added up in slices."""
    own = turns.select("class", "pos", _length(F.col("turn_id")).alias("n"), F.floor(F.col("pos") / slice_turns).alias("part"))
    sums = own.groupBy("class", "part").agg(F.sum("n").alias("n"))
    skipped = F.sum("n").over(Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    later = bounded(sums.withColumn("skipped", skipped).filter("skipped > 0").select("class", "part", "skipped"))
    inside = F.sum("n").over(Window.partitionBy("class", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    placed = own.withColumn("inside", inside).join(later, ["class", "part"], "left")
    return placed.select("class", "pos", (F.coalesce("inside", F.lit(0)) + F.coalesce("skipped", F.lit(0))).alias("before"))


def nodes(
    conversations: DataFrame, group: int = 100, most: int = 6, first_columns: int = FIRST_COLUMNS, most_columns: int = MOST_COLUMNS
) -> DataFrame:
    """The trie over the rebuilt conversations, one row per node.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    convs, made = rebuilt(materialise(numbered_turns(conversations), "turns"), group, most)
    made = materialise(made, "rebuilt")
    members, classes = _classes(convs, made)
    classes = materialise(classes, "class_sizes")
    digests = materialise(_digests(members), "digests")
    turns = made.join(classes.select("class"), F.col("conv_id") == F.col("class"), "left_semi").withColumnRenamed("conv_id", "class")
    turns = materialise(turns, "class_turns")
    blocks = _blocks(classes, turns, first_columns, most_columns)

    # What each class owns: nodes from a depth on, alone on them from another depth on.
    every = None
    for _, _, _, found in blocks:
        every = found if every is None else every.unionByName(found)
    alone = F.min(F.when(F.col("classes") == 1, F.col("depth")))
    starts = every.groupBy(F.col("owner").alias("class")).agg(F.min("depth").alias("start"), alone.alias("alone"))
    owned = turns.join(starts, "class").filter(F.col("pos") >= F.col("start")).groupBy("class").agg(F.sum(_length(F.col("turn_id"))).alias("owned"))
    known = classes.join(starts, "class", "left").join(owned, "class", "left").join(digests, "class")
    known = materialise(known.withColumns({"owned": F.coalesce("owned", F.lit(0)).cast("long"), "leaf": F.col("alone").isNotNull().cast("long")}), "known")

    # Sums over the classes of every node that several share, and of the root.
    sums = [
        F.min("class").alias("owner"), F.count(F.lit(1)).alias("classes"), F.sum("copies").alias("n_convs"),
        F.sum(F.col("copies") * F.col("chars")).alias("all_chars"), F.sum("owned").alias("all_owned"), F.sum("leaf").alias("n_leaves"),
    ]
    shared = None
    for low, columns, wide, _ in blocks:
        own = _rolled(wide.join(known.select("class", "owned", "leaf"), "class"), columns, low, sums)
        own = own.filter((F.col("classes") > 1) | (F.col("depth") == 0))
        shared = own if shared is None else shared.unionByName(own)
    shared = materialise(shared, "shared")

    # Where a class's own nodes begin, and where a class ends that is not alone there.
    attached = materialise(_places(blocks, known, "start", 1), "attached")
    children = attached.groupBy("key").agg(F.count(F.lit(1)).alias("attached"))
    parents = attached.join(shared.select("key", F.col("owner").alias("above_start")), "key").select("class", "above_start")
    known = materialise(known.join(parents, "class", "left"), "placed")
    ending = _places(blocks, known.filter(F.col("alone").isNull() | (F.col("n_turns") == 0)), "n_turns", 0)
    ending = ending.join(digests, "class").select("key", "ends_sha256")

    owner = known.select(F.col("class").alias("owner"), "n_turns", "start", "above_start", "owned", "chars")
    met = shared.join(owner, "owner").join(children, "key", "left").join(ending, "key", "left")
    beneath = F.col("all_owned") - F.col("owned") + F.col("chars") - F.col("above")  # length of the last texts in the subtree
    parent = F.when(F.col("depth") > F.col("start"), F.col("class")).otherwise(F.col("above_start"))
    together = met.withColumn("class", F.col("owner")).select(
        F.col("class").alias("conv_id"), "depth", F.when(F.col("depth") > 0, parent).alias("parent_conv_id"), "n_convs",
        (F.coalesce("attached", F.lit(0)) + (F.col("n_turns") > F.col("depth")).cast("long")).alias("n_children"), "n_leaves",
        (F.col("all_chars") - F.col("n_convs") * F.col("above") - beneath).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"),
    )
    single = known.filter(F.col("alone").isNotNull()).select("class", "n_turns", "start", "alone", "above_start", "copies", "chars", "ends_sha256")
    chains = turns.join(single, "class").filter(F.col("pos") >= F.col("alone")).withColumn("depth", F.col("pos"))
    several = turns.join(single.filter("copies > 1").select("class"), "class", "left_semi")
    chains = chains.join(_lengths_before(several), ["class", "pos"], "left")
    last = F.col("depth") == F.col("n_turns")
    apart = chains.select(
        F.col("class").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.col("copies").alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.when(F.col("copies") > 1, (F.col("copies") - 1) * (F.col("chars") - F.col("before"))).otherwise(0).cast("long").alias("saved_tokens"),
        F.when(last, F.col("ends_sha256")).otherwise(_EMPTY_SHA).alias("ends_sha256"),
    )
    return together.unionByName(apart)
