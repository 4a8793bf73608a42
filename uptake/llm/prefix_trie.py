"""The trie of conversation prefixes, built by halving depths.

Conversations are cut at half the depth. The cut prefixes are named, each by the smallest
conversation that has it; what lies above the cut becomes one trie, what lies below a forest with a
tree for every name. Upper trie and forests are of half the depth and are cut in the same way, all of
them in the same jobs, so the number of rounds is the logarithm of the longest conversation. Totals
are grafted upward along the same cuts: first within ever larger blocks of depths, then from the
nodes at coarser depths to those at finer ones.

Only rows of fixed size travel: a turn is a digest of its role and text, and a run of turns that a
cut needs as a key is the digest of its two halves. A conversation, a first turn or a group of
copies of any size is never gathered anywhere. Copies end as one row as soon as a cut finds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import stored

BLOCK_TURNS = 1 << 12  # turn numbers of a conversation that are ordered in one task
IDS_PER_PIECE = 1 << 16  # conversations whose ids become one piece of text
WORD = r"[^\x20\x09-\x0D]+"
DIGEST_BYTES = 16  # of SHA-256


def _digest(data: Column) -> Column:
    return F.substring(F.unhex(F.sha2(data, 256)), 1, DIGEST_BYTES)


def ordered_turns(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, ``pos`` (from 1), ``label`` (a digest of role and text) and ``words`` of every
    turn.

    Turns are ordered by turn, null first, then role and digest. A null role or text is empty.
    Rows without a conversation are left out. A conversation is ordered in blocks of turn
    numbers, one task each; only the sizes of its blocks are added up.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"),
        F.floor(F.col(turn_col) / BLOCK_TURNS).alias("block"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        _digest(F.concat(F.octet_length(role), F.lit(":"), role, text).cast("binary")).alias("label"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    sizes = rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv").orderBy(F.asc_nulls_first("block"))
    starts = sizes.select(
        F.col("conv").alias("c"),
        F.col("block").alias("b"),
        (F.sum("size").over(before) - F.col("size")).alias("start"),
    )
    within = Window.partitionBy("conv", "block").orderBy(
        F.asc_nulls_first("turn"), "role", "label"
    )
    placed = rows.withColumn("nth", F.row_number().over(within))
    here = (F.col("conv") == F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
    pos = (F.col("start") + F.col("nth")).cast("long").alias("pos")
    return stored(placed.join(starts, here).select("conv", pos, "label", "words"), "turns")


def rebuilt(turns: DataFrame, shared: Column, base: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another one.

    Conversation ``conv`` gets the first ``shared`` turns, ``most`` at most, of conversation
    ``base`` (fewer if that is shorter, none if it is absent) and then its own turns after its
    first ``shared``. ``turns`` is as from ``ordered_turns``, and so is the first table returned;
    the second has every ``conv`` and its number of turns, ``length``, which may be 0.
    """
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    named = sizes.select("conv", "own", shared.alias("shared"), base.alias("base"))
    heads = sizes.select(F.col("conv").alias("base"), F.least("own", F.lit(most)).alias("head"))
    taken = F.least(F.col("shared"), F.coalesce("head", F.lit(0)))
    left = F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    lengths = named.join(heads, "base", "left").select(
        "conv", "base", "shared", taken.alias("taken"), (taken + left).cast("long").alias("length")
    )
    lengths = stored(lengths, "lengths")
    first = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "base")
    begun = lengths.drop("length").join(first, "base").where("pos <= taken")
    own = turns.join(lengths, "conv").where(F.col("pos") > F.col("shared"))
    own = own.withColumn("pos", F.col("pos") - F.col("shared") + F.col("taken"))
    columns = ["conv", "pos", "label", "words"]
    whole = begun.select(columns).unionByName(own.select(columns))
    return stored(whole, "rebuilt"), lengths.select("conv", "length")


class Trie:
    """Tables of a trie. A node is (``conv``, ``depth``): its smallest member and its depth."""

    def __init__(self, root: int, nodes: DataFrame, ups: list[DataFrame], ends: DataFrame):
        #: the smallest of all conversations
        self.root = root
        #: conv, depth, up (the parent's conv), n (members) of every node but the root
        self.nodes = nodes
        #: conv, depth, up: at place j the nodes at multiples of 2 ** j, and which conversation
        #: names the node 2 ** j above
        self.ups = ups
        #: conv, end_conv, depth: the node at which each conversation ends
        self.ends = ends


def _halves(labels: DataFrame, levels: int) -> list[DataFrame]:
    """conv, i, label: at place j the digests of the whole runs of turns i * 2 ** j and on."""
    runs = [labels]
    for _ in range(levels - 1):
        left, right = (F.max(F.when(F.col("i") % 2 == k, F.col("label"))) for k in (0, 1))
        pairs = runs[-1].groupBy("conv", F.floor(F.col("i") / 2).alias("i")).agg(
            left.alias("left"), right.alias("right")
        )
        whole = pairs.where("left IS NOT NULL AND right IS NOT NULL")
        runs.append(
            stored(whole.select("conv", "i", _digest(F.concat("left", "right")).alias("label")), "runs")
        )
    return runs


def build_trie(turns: DataFrame, lengths: DataFrame) -> Trie | None:
    """The trie of all conversations, or None without any. The tables are as from ``rebuilt``.

    A block is a run of depths, ``2 ** j`` of them, of one conversation: ``conv``, ``i`` (its place),
    ``last`` (the depth at which the conversation ends in it), ``up`` (the name of the node above)
    and ``n`` (conversations that it stands for). Cutting all blocks halves their length; blocks of
    one turn are the nodes.
    """
    first, longest = lengths.agg(F.min("conv"), F.max("length")).first()
    if first is None:
        return None
    levels = max(1, longest.bit_length())
    labels = turns.select("conv", (F.col("pos") - 1).alias("i"), "label")
    runs = _halves(labels, levels)
    root = F.lit(first).cast("long")
    blocks = lengths.where("length > 0").select(
        "conv",
        F.lit(0).cast("long").alias("i"),
        F.col("length").alias("last"),
        root.alias("up"),
        F.lit(1).cast("long").alias("n"),
    )
    ends = [
        lengths.where("length = 0").select(
            "conv", root.alias("end_conv"), F.col("length").alias("depth")
        )
    ]
    ups: list[DataFrame] = []
    for j in reversed(range(levels)):
        half = 1 << j
        left = runs[j].where("i % 2 = 0").select("conv", F.floor(F.col("i") / 2).alias("i"), "label")
        upper = blocks.withColumn("cut", (F.col("i") * 2 + 1) * half).join(left, ["conv", "i"], "left")
        key = ["cut", "up", "label"]
        names = stored(
            upper.where("last >= cut")
            .groupBy(key)
            .agg(F.min("conv").alias("name"), F.sum("n").alias("members")),
            "names",
        )
        halved = stored(upper.join(names, key, "left"), "cut")
        ends.append(
            halved.where("last = cut").select(
                "conv", F.col("name").alias("end_conv"), F.col("cut").alias("depth")
            )
        )
        i = F.col("i") * 2
        shorter = halved.where("last < cut").select("conv", i.alias("i"), "last", "up", "n")
        prefixes = halved.where("conv = name").select(
            "conv", i.alias("i"), F.col("cut").alias("last"), "up", F.col("members").alias("n")
        )
        below = halved.where("last > cut").select(
            "conv", (i + 1).alias("i"), "last", F.col("name").alias("up"), "n"
        )
        blocks = shorter.unionByName(prefixes).unionByName(below)
        full = blocks.where((F.col("i") + 1) * half == F.col("last"))
        ups.append(full.select("conv", F.col("last").alias("depth"), "up"))
    nodes = blocks.select("conv", F.col("last").alias("depth"), "up", "n")
    ended = ends[0]
    for some in ends[1:]:
        ended = ended.unionByName(some)
    return Trie(first, stored(nodes, "nodes"), ups[::-1], ended)


def subtree_sums(trie: Trie, weights: DataFrame) -> DataFrame:
    """``conv``, ``depth`` and, for each further column of ``weights``, its sum over the subtree.

    ``weights`` has a row for every node, the root included. Upward: within blocks of 2 ** j
    depths, from the nodes at the odd places to those above them. Then from the coarser
    depths to the finer: a node has the sum of its block and those of the next nodes below it.
    """
    names = [c for c in weights.columns if c not in ("conv", "depth")]

    def grafted(own: DataFrame, lower: DataFrame, up: DataFrame, step: int, name: str) -> DataFrame:
        moved = lower.join(up, ["conv", "depth"]).select(
            F.col("up").alias("conv"), (F.col("depth") - step).alias("depth"), *names
        )
        both = own.unionByName(moved).groupBy("conv", "depth")
        return stored(both.agg(*[F.sum(c).alias(c) for c in names]), name)

    within = [weights]
    for j, up in enumerate(trie.ups):
        odd = F.col("depth") % (2 << j) != 0
        all_of = within[-1]
        within.append(grafted(all_of.where(~odd), all_of.where(odd), up.where(odd), 1 << j, "within"))
    sums = within[-1]
    for j, up in reversed(list(enumerate(trie.ups))):
        odd = F.col("depth") % (2 << j) != 0
        finer = grafted(within[j].where(odd), sums, up.where(~odd), 1 << j, "sums")
        sums = sums.unionByName(finer)
    return sums


def _sha256(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The hash of the pieces of each node, comma-joined; they come sorted."""
    node, running = None, None
    for batch in chain(batches, [None]):
        rows = []
        columns = batch.to_pydict().values() if batch is not None else [[None]] * 3
        for conv, depth, piece in zip(*columns, strict=True):
            if (conv, depth) != node:
                if running:
                    rows.append((*node, running.hexdigest()))
                node, running = (conv, depth), hashlib.sha256() if batch is not None else None
            elif running:
                running.update(b",")
            if running:
                running.update(piece.encode())
        columns = list(zip(*rows, strict=True)) or [()] * 3
        types = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
        )


def ends_sha256(ends: DataFrame, ids_per_piece: int = IDS_PER_PIECE) -> DataFrame:
    """``conv``, ``depth`` and ``ends_sha256`` of every node at which conversations end: the
    SHA-256 of their ids, ascending, comma-joined.

    Ids are joined in pieces of at most ``ids_per_piece`` first; the pieces of a node pass through
    one task one after the other, as a hash has to be made in order.
    """
    pieces = ends.groupBy(
        F.col("end_conv"), "depth", F.floor(F.col("conv") / ids_per_piece).alias("piece")
    ).agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition("end_conv", "depth").sortWithinPartitions(
        "end_conv", "depth", "piece"
    )
    names = ["conv", "depth", "ends_sha256"]
    return ordered.select("end_conv", "depth", "ids").mapInArrow(
        lambda batches: _sha256(batches, names), "conv bigint, depth bigint, ends_sha256 string"
    )


def trie_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations, the root included; no conversations, no rows.

    ``conv_id``, the smallest member, and ``depth`` identify a node. ``parent_conv_id`` is its
    parent's conv_id, null for the root; ``n_convs`` the number of members, the conversations that
    begin with its turns; ``n_children`` its children; ``n_leaves`` the nodes without children in its
    subtree, itself included; ``saved_tokens`` the words of last turns, over its subtree, that
    members beyond the first of each node repeat; ``ends_sha256`` stands for the members that end
    here. The tables are as from ``rebuilt``; equal conversations share all their nodes.
    """
    trie = build_trie(turns, lengths)
    if trie is None:
        return turns.sparkSession.createDataFrame(
            [],
            "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
            "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
        )
    key = ["conv", "depth"]
    root = lengths.agg(
        F.lit(trie.root).cast("long").alias("conv"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("up"),
        F.count(F.lit(1)).alias("n"),
        F.lit(0).cast("long").alias("words"),
    )
    words = turns.select("conv", F.col("pos").alias("depth"), "words")
    nodes = trie.nodes.join(words, key).unionByName(root)
    children = trie.nodes.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("children")
    )
    nodes = stored(nodes.join(children, key, "left").fillna(0, ["children"]), "all-nodes")
    weights = nodes.select(
        *key,
        (F.col("children") == 0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("words")).alias("saved"),
    )
    empty = hashlib.sha256().hexdigest()
    return (
        nodes.join(subtree_sums(trie, weights), key)
        .join(ends_sha256(trie.ends), key, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("up").alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            F.col("children").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
        )
    )
