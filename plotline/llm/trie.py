"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A conversation is its turns (role and text; null counts as empty) in turn order,
null turns first, equal turns by the digest of their content. Conversation ``c``
is rebuilt from the first ``h`` turns of conversation ``c - c % 100`` and its own
turns after its first ``h`` (``h``: unsigned crc32 of its decimal id, modulo 6).
A node is a distinct prefix of rebuilt conversations; its members start with it.

1. Turns are numbered by ``order.ranked``, so that one conversation may hold any
   share of all turns. Prefixes get digests by a scan in blocks of ``BLOCK``
   turns: chained in the row inside a block, and by the same scan over the
   blocks' digests above it.
2. ``contract``: rounds of one exchange each. Rake: every leaf gives its total to
   its parent and goes. Compress: a node with one child left goes from its
   unary chain, if its depth has the round's bit and its child's has not: no two
   neighbours go at once. The child is linked to the node's parent and carries
   what the node had gathered; chains halve with every bit.
3. ``expand``: the rounds backwards; a spliced node's total is its child's, plus
   what it had gathered itself and what the child carried by then.

Parents with very many children (at most ``HEAVY`` of them, by their share) are
looked up by broadcast, all others by shuffle. Digests of members are fed to the
hash in order, in chunks of ``CHUNK`` ids.

Defined results: rows without conv_id belong to no conversation and are left out;
repeated rows are turns of their own; an empty table has no nodes, not even a
root; texts of any length count whole, as a digest and a length. Further columns
are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotline.llm.common import shared_table
from plotline.llm.order import ranked

#: Turns (or block digests) that one row of the scan chains.
BLOCK_BITS = 6
BLOCK = 1 << BLOCK_BITS
#: A parent is heavy if it has more than this share of all nodes as children.
HEAVY = 4096
#: Members' ids that one row holds.
CHUNK_BITS = 12
#: Ids whose first turns are shared, and the most turns that are.
FAMILY = 100
HEAD = 6


def root_node() -> Column:
    return F.lit(bytearray())


def digest(*parts: Column) -> Column:
    """16 bytes that name the concatenated parts."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, content, length``: the content as a digest."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = digest(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", content.alias("content"), F.length(text).cast("long").alias("length")
    )


def rebuilt(numbered: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv_id, size, at, content, length``: turn ``at`` (from 0) of each rebuilt
    conversation of ``size`` turns. ``numbered``: turns with ``place, head, shared,
    size``; ``convs``: one row for each conversation."""
    own = numbered.where("place >= head").select("conv_id", "size", (F.col("place") - F.col("head") + F.col("shared")).alias("at"), "content", "length")
    heads = numbered.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEAD - 1))
    heads = heads.select(F.col("conv_id").alias("host"), F.col("place").alias("at"), "content", "length")
    first = convs.join(heads, "host").where("at < shared").select("conv_id", "size", "at", "content", "length")
    return own.unionByName(first)


def chained(items: Column) -> Column:
    """Running digests of an array of digests."""
    return F.aggregate(
        F.slice(items, 2, BLOCK),
        F.slice(items, 1, 1),
        lambda acc, x: F.concat(acc, F.array(digest(F.element_at(acc, -1), x))),
    )


def scanned(rows: DataFrame, most: int, name: str, keep: list[str]) -> DataFrame:
    """Blocks of ``rows`` (``conv_id, at, content`` and ``keep``): ``conv_id,
    block, xs`` (the rows in order) and ``ids``, the digest of everything up to
    each of them. ``most``: the largest ``at``."""
    blocks = rows.groupBy("conv_id", F.shiftright("at", BLOCK_BITS).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "content", *keep))).alias("xs")
    )
    blocks = blocks.withColumn("ids", chained(F.transform("xs", lambda x: x["content"])))
    if most < BLOCK:
        return blocks
    blocks = shared_table(blocks, f"trie_{name}")
    sums = blocks.select("conv_id", F.col("block").alias("at"), F.element_at("ids", -1).alias("content"))
    above = scanned(sums, most >> BLOCK_BITS, name + "_blocks", [])
    before = above.select("conv_id", F.inline(F.arrays_zip(F.col("xs.at").alias("at"), F.col("ids").alias("before"))))
    before = before.select("conv_id", (F.col("at") + 1).alias("block"), "before")
    joined = blocks.join(before, ["conv_id", "block"], "left")
    ids = F.when(F.col("before").isNull(), F.col("ids")).otherwise(F.transform("ids", lambda x: digest(F.col("before"), x)))
    return joined.select("conv_id", "block", "xs", ids.alias("ids"))


def prefixes(rows: DataFrame, most: int) -> DataFrame:
    """``conv_id, depth, node, up, length, size`` of every member of every node
    but the root: ``node`` names the prefix, ``up`` the prefix one turn shorter."""
    blocks = scanned(rows, most, "turns", ["length", "size"])
    first = root_node()
    if most >= BLOCK:
        blocks = shared_table(blocks, "trie_blocks")
        last = blocks.select("conv_id", (F.col("block") + 1).alias("block"), F.element_at("ids", -1).alias("last"))
        blocks = blocks.join(last, ["conv_id", "block"], "left")
        first = F.coalesce("last", root_node())
    members = F.transform(
        "xs",
        lambda x, i: F.struct(
            (x["at"] + 1).alias("depth"),
            F.get("ids", i).alias("node"),
            F.when(i == 0, first).otherwise(F.get("ids", i - 1)).alias("up"),
            x["length"].alias("length"),
            x["size"].alias("size"),
        ),
    )
    return blocks.select("conv_id", F.inline(members))


def looked_up(children: DataFrame, parents: DataFrame, n: int) -> DataFrame:
    """``children`` with ``parent`` and ``parent_conv_id`` of their ``up``.
    Parents with more than n / HEAVY children, fewer than HEAVY, are broadcast."""
    kids = children.groupBy("up").agg(F.count(F.lit(1)).alias("kids"))
    heavy = F.broadcast(kids.where(F.col("kids") * HEAVY > n).select("up"))
    known = parents.select(F.col("node").alias("up"), F.col("num").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    many = F.broadcast(known.join(heavy, "up"))
    return children.join(many, "up").unionByName(children.join(heavy, "up", "left_anti").join(known, "up"))


def contract(tree: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """``tree``: ``num, parent`` (root: null), ``depth, kids, leaves, saved``.
    Returns the raked nodes of all rounds (``num, leaves, saved``: their subtree
    totals) and the spliced ones (``num, child, leaves, saved``: what to add to
    their child's total), one table a round."""
    live = tree.withColumns({"extra_leaves": F.lit(0).cast("long"), "extra_saved": F.lit(0).cast("long")})
    bits = max(1, int(tree.agg(F.max("depth")).first()[0] or 0).bit_length())
    state = ["parent", "depth", "kids", "leaves", "saved", "extra_leaves", "extra_saved"]
    link = ["child", "child_depth", "child_leaves", "child_saved"]  # the child that is no leaf
    raked, spliced, turn = [], [], 0
    while True:
        leaf = (F.col("kids") == 0) & F.col("parent").isNotNull()
        none = F.lit(None).cast("long")
        own = live.select("num", *state, *[none.alias(c) for c in ("n", "l", "s", *link)])
        told = live.where(F.col("parent").isNotNull()).select(
            F.col("parent").alias("num"),
            *[none.alias(c) for c in state],
            leaf.cast("long").alias("n"),
            F.when(leaf, F.col("leaves") + F.col("extra_leaves")).alias("l"),
            F.when(leaf, F.col("saved") + F.col("extra_saved")).alias("s"),
            F.when(~leaf, F.col("num")).alias("child"),
            F.when(~leaf, F.col("depth")).alias("child_depth"),
            F.when(~leaf, F.col("extra_leaves")).alias("child_leaves"),
            F.when(~leaf, F.col("extra_saved")).alias("child_saved"),
        )
        met = own.unionByName(told).groupBy("num").agg(
            *[F.max(c).alias(c) for c in (*state, *link)],
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "l", "s")],
        )
        left = F.col("kids") - F.col("n")
        bit, want = turn % bits, 1 - turn // bits % 2
        has = lambda c: F.shiftright(c, bit).bitwiseAND(F.lit(1))  # noqa: E731,B023
        unary = F.col("parent").isNotNull() & (left == 1) & (has("depth") == want) & (has("child_depth") != want)
        fate = F.when(leaf, "raked").when(unary, "spliced").otherwise("live")
        done = shared_table(
            met.select(
                "num", "parent", "depth", left.alias("kids"), (F.col("leaves") + F.col("l")).alias("leaves"),
                (F.col("saved") + F.col("s")).alias("saved"), "extra_leaves", "extra_saved", *link, fate.alias("fate"),
            ),
            f"trie_round_{turn}",
        )
        counts = {r["fate"]: r["n"] for r in done.groupBy("fate").agg(F.count(F.lit(1)).alias("n")).collect()}
        raked.append(done.where("fate = 'raked'").select("num", "leaves", "saved"))
        live = done.where("fate = 'live'").select("num", *state)
        if counts.get("spliced"):
            gone = done.where("fate = 'spliced'")
            # its total: its child's, what went between the two before, and its own
            spliced.append(
                gone.select("num", "child", (F.col("leaves") + F.col("child_leaves")).alias("leaves"), (F.col("saved") + F.col("child_saved")).alias("saved"))
            )
            given = gone.select(
                F.col("child").alias("num"),
                F.col("parent").alias("above"),
                (F.col("leaves") + F.col("extra_leaves")).alias("l"),
                (F.col("saved") + F.col("extra_saved")).alias("s"),
            )
            live = live.join(given, "num", "left").select(
                "num",
                F.coalesce("above", "parent").alias("parent"),
                "depth", "kids", "leaves", "saved",
                (F.col("extra_leaves") + F.coalesce("l", F.lit(0))).alias("extra_leaves"),
                (F.col("extra_saved") + F.coalesce("s", F.lit(0))).alias("extra_saved"),
            )
        if counts.get("live", 0) <= 1 and not counts.get("raked") and not counts.get("spliced"):
            raked.append(done.where("fate = 'live'").select("num", "leaves", "saved"))
            return raked, spliced
        turn += 1


def expand(raked: list[DataFrame], spliced: list[DataFrame]) -> DataFrame:
    """``num, leaves, saved``: the subtree totals of every node."""
    known = raked[0]
    for rows in raked[1:]:
        known = known.unionByName(rows)
    for k, rows in reversed(list(enumerate(spliced))):
        below = known.select(F.col("num").alias("child"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
        back = rows.join(below, "child").select("num", (F.col("leaves") + F.col("l")).alias("leaves"), (F.col("saved") + F.col("s")).alias("saved"))
        known = known.unionByName(shared_table(back, f"trie_back_{k}"))
    return known


def _hashed(batches):
    """Digest of the chunks of each node, which come one after the other."""
    node, state, out = None, None, []
    for pdf in batches:
        for n, text in zip(pdf["node"], pdf["text"]):
            if state is None or n != node:
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        if out:
            yield pd.DataFrame(out, columns=["node", "ends_sha256"])
        out = []
    if state is not None:
        yield pd.DataFrame([(node, state.hexdigest())], columns=["node", "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` of a written table ``node, conv_id``."""
    placed = ranked(ends, ["node"], ["conv_id"], "trie_ends")
    chunks = placed.groupBy("node", F.shiftright("_pos", CHUNK_BITS).alias("chunk")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("text")
    )
    return chunks.repartition("node").sortWithinPartitions("node", "chunk").mapInPandas(_hashed, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` of every node. Rounds are written as tables."""
    base = shared_table(turns(conversations), "trie_turns")
    convs = base.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"host": F.col("conv_id") - F.col("conv_id") % FAMILY, "head": F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD}
    )
    hosts = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("host"), F.col("n").alias("given"))
    shared = F.least("head", F.coalesce("given", F.lit(0)))
    convs = convs.join(hosts, "host", "left").select(
        "conv_id", "host", "head", shared.alias("shared"), (F.greatest(F.col("n") - F.col("head"), F.lit(0)) + shared).alias("size")
    )
    convs = shared_table(convs, "trie_conversations")
    numbered = ranked(base, ["conv_id"], ["turn", "content"], "trie_sorted", "place", convs.drop("host"))
    numbered = shared_table(numbered, "trie_numbered")
    total, most, lowest = convs.agg(F.count(F.lit(1)), F.max("size"), F.min("conv_id")).first()
    members = shared_table(prefixes(rebuilt(numbered, convs), (most or 1) - 1), "trie_members")

    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        root_node().alias("node"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "n_convs", F.lit(0).cast("long").alias("length"),
    )
    nodes = members.groupBy("node").agg(
        F.min("up").alias("up"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("length").alias("length"),
    )
    nodes = shared_table(nodes.unionByName(root).withColumn("num", F.monotonically_increasing_id()), "trie_nodes")
    linked = looked_up(nodes.where("depth > 0"), nodes, nodes.count())
    top = nodes.where("depth = 0").withColumns({"parent": F.lit(None).cast("long"), "parent_conv_id": F.lit(None).cast("long")})
    linked = linked.unionByName(top)
    kids = linked.groupBy(F.col("parent").alias("num")).agg(F.count(F.lit(1)).alias("kids"))
    n_kids = F.coalesce("kids", F.lit(0))
    tree = linked.join(kids, "num", "left").select(
        "num", "node", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", n_kids.alias("kids"),
        (n_kids == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("length")).alias("saved"),
    )
    tree = shared_table(tree, "trie_tree")
    totals = expand(*contract(tree.select("num", "parent", "depth", "kids", "leaves", "saved")))

    ends = members.where("depth = size").select("node", "conv_id").unionByName(convs.where("size = 0").select(root_node().alias("node"), "conv_id"))
    digests = ends_digests(shared_table(ends, "trie_end_nodes"))
    named = tree.select("num", "node", "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"))
    totals = totals.select("num", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = named.join(totals, "num").join(digests, "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
