"""Prefix trie of conversations by ROLLUP over positional turn columns (operator 11).

A turn is a fixed-width id: a digest of its role and text, and the text's
length.  Conversations lie in blocks of ``width`` turn columns; every block
carries the key of the node that the blocks before it lead to.  One

    GROUP BY block, key, ROLLUP (t0, ..., t7)

then aggregates all prefixes of all blocks together, grouping_id() telling the
depth inside the block.  The key is a 128-bit exclusive-or over hashes of
(position, turn), so it is known without walking the blocks one after another,
and a conversation of any length takes two passes, not one per block.

Sums over a node's subtree come from its members.  A node is owned by its
smallest member; the nodes that a conversation owns are the end of its path,
from the depth where it leaves smaller ones.  The first ROLLUP finds that
depth.  With what each conversation owns, the second gives every node the
distinct text and the childless nodes below it as plain sums over members.

Conversations that end at one node are listed to its digest in chunks of ids;
a node with several chunks is hashed as a stream, so no list is ever whole.

Cases: rows without conv_id take no part; turns without a number come first,
equal ones by their content; null role or text is empty; a conversation that
has no turns left ends at the root; an empty table has no nodes, not even the
root; other columns are never read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.common import stage
from reviewflow.llm.order import numbered, runs_and_rows

WIDTH = 8           # turn columns of a block
SPAN = 256          # blocks of a conversation whose keys one window makes
CHUNK_BITS = 12     # ids of 4,096 numbers make one chunk of a node's list
ID_DIGITS = 24      # hexadecimal digits of the digest in a turn's id; the length takes the next 8


def turn_id(role: Column, text: Column) -> Column:
    """96 bits of a digest of role and text, and 32 bits of the text's length in code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.md5(whole), 1, ID_DIGITS), F.lpad(F.hex(F.char_length(text)), 8, "0")))


def text_length(turn: str) -> str:
    """SQL for the length in a turn's id."""
    return f"coalesce(cast(conv(hex(substring({turn}, {ID_DIGITS // 2 + 1}, 4)), 16, 10) AS long), 0L)"


def node_hash(seed: int, at: str, turn: str) -> str:
    return f"CASE WHEN {turn} IS NULL THEN 0L ELSE xxhash64({seed}, cast({at} AS long), {turn}) END"


def rebuilt(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, pos, turn, total): conversation c begins with the first h turns of c - c % group, h a hash of c below
    ``heads``, and goes on with its own turns behind its first h; one row without a turn where nothing is left."""
    rows = stage(conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", turn_id(F.col("role"), F.col("text")).alias("id")), "trie-turns")
    runs, placed = runs_and_rows(rows, ["conv_id"], ["turn", "id"], "trie")
    runs = stage(runs.withColumn("base", F.expr(f"conv_id - conv_id % {group}")).withColumn(
        "h", F.expr(f"crc32(cast(cast(conv_id AS string) AS binary)) % {heads}")), "trie-runs")
    convs = runs.groupBy("conv_id", "base", "h").agg(F.max("size").alias("own"))
    bases = convs.where("conv_id = base").select("base", F.col("own").alias("given"))
    convs = stage(convs.join(bases, "base", "left").selectExpr(
        "conv_id", "base", "h", "least(h, coalesce(given, 0L)) AS taken", "least(h, coalesce(given, 0L)) + greatest(own - h, 0L) AS total"), "trie-convs")
    of_run = runs.select("conv_id", "run", "first", "before").join(convs, "conv_id")
    turns = placed.join(of_run, ["conv_id", "run"]).withColumn("pos", F.expr("before + at - first"))
    own = turns.where("pos >= h").selectExpr("conv_id", "pos - h + taken AS pos", "id AS turn", "total")
    first = turns.where(f"conv_id = base AND pos < {heads - 1}").select("base", "pos", F.col("id").alias("turn"))
    shared = first.join(convs, "base").where("pos < taken").select("conv_id", "pos", "turn", "total")
    none = convs.where("total = 0").selectExpr("conv_id", "0L AS pos", "cast(null AS binary) AS turn", "total")
    return own.union(shared).union(none)


def in_blocks(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per ``width`` turns of a conversation: b, the key (k1, k2) of the node before it, the text before it, the
    columns t0.. and, of the whole conversation, total (turns), chars and the key (e1, e2) of its last node."""
    span = f"pos div {width * SPAN}"
    by_span = turns.selectExpr("conv_id", "total", f"{span} AS span", f"pos div {width} AS b", f"pos % {width} AS place", "turn",
                               f"{node_hash(1, 'pos', 'turn')} AS h1", f"{node_hash(2, 'pos', 'turn')} AS h2", f"{text_length('turn')} AS chars")
    # dealt by (conversation, span): blocks, their keys inside the span and the span's own sums need no other shuffle
    blocks = by_span.repartition("conv_id", "span").groupBy("conv_id", "span", "b").agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("place") == k, F.col("turn"))).alias(f"t{k}") for k in range(width)],
        F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"), F.sum("chars").alias("chars"))
    inside = Window.partitionBy("conv_id", "span").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(blocks.select("conv_id", "span", "b", "total", *[f"t{k}" for k in range(width)], "h1", "h2", "chars",
                                 F.bit_xor("h1").over(inside).alias("k1"), F.bit_xor("h2").over(inside).alias("k2"),
                                 F.sum("chars").over(inside).alias("before")), "trie-blocks")
    spans = blocks.groupBy("conv_id", "span").agg(*[F.bit_xor(h).alias(h) for h in ("h1", "h2")], F.sum("chars").alias("chars"))
    conv = Window.partitionBy("conv_id")
    earlier = conv.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv_id", "span", F.bit_xor("h1").over(earlier).alias("s1"), F.bit_xor("h2").over(earlier).alias("s2"),
                         F.sum("chars").over(earlier).alias("s_chars"), F.bit_xor("h1").over(conv).alias("e1"),
                         F.bit_xor("h2").over(conv).alias("e2"), F.sum("chars").over(conv).alias("all_chars"))
    return stage(blocks.join(spans, ["conv_id", "span"]).selectExpr(
        "conv_id", "b", "coalesce(k1, 0L) ^ coalesce(s1, 0L) AS k1", "coalesce(k2, 0L) ^ coalesce(s2, 0L) AS k2",
        "coalesce(before, 0L) + coalesce(s_chars, 0L) AS before", *[f"t{k}" for k in range(width)], "total", "all_chars AS chars", "e1", "e2"),
        "trie-keyed")


def rolled_up(blocks: DataFrame, sums: str, width: int = WIDTH) -> DataFrame:
    """Every prefix of every block: b, k1, k2, t0.., level (turns of the block in the prefix) and the aggregates ``sums``."""
    columns = ", ".join(f"t{k}" for k in range(width))
    present = " + ".join(f"int(t{k} IS NOT NULL)" for k in range(width))
    made = blocks.sparkSession.sql(
        f"""SELECT b, k1, k2, {columns}, {width} - bit_count(grouping_id()) AS level, min(before) AS before, {sums}
            FROM {{blocks}} GROUP BY b, k1, k2, ROLLUP ({columns})""", blocks=blocks)
    # shorter conversations have nulls where longer ones go on; a block's level 0 is the node that the block before it ends with
    made = made.where(f"level = {present} AND (level > 0 OR b = 0)")
    lengths = " + ".join(text_length(f"t{k}") for k in range(width))
    last = f"array({columns})[level - 1]"
    return made.selectExpr("*", f"b * {width} + level AS depth", f"before + {lengths} AS chars",
                           f"CASE WHEN level > 0 THEN {text_length(last)} ELSE 0L END AS last_chars")


def ended(blocks: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes at which conversations end: digest of their ids, ascending, comma-joined."""
    key = ["k1", "k2", "depth"]
    chunks = (blocks.where("b = 0").selectExpr("e1 AS k1", "e2 AS k2", "total AS depth", "conv_id", f"shiftright(conv_id, {CHUNK_BITS}) AS chunk")
              .groupBy(*key, "chunk").agg(F.expr("array_join(cast(array_sort(collect_list(conv_id)) AS array<string>), ',')").alias("ids")))
    chunks = stage(chunks, "trie-ends")
    counts = stage(chunks.groupBy(*key).agg(F.count(F.lit(1)).alias("chunks")), "trie-end-counts")
    one = chunks.join(counts.where("chunks = 1"), key).select(*key, F.sha2("ids", 256).alias("ends_sha256"))

    def digests(batches):
        at, state = None, None
        for batch in batches:
            out = []
            for k1, k2, depth, ids in zip(*(batch[c].to_pylist() for c in (*key, "ids"))):
                if (k1, k2, depth) != at:
                    if at:
                        out.append((*at, state.hexdigest()))
                    at, state = (k1, k2, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield table(out)
        if at:
            yield table([(*at, state.hexdigest())])

    def table(rows):
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], [*key, "ends_sha256"])
    several = (chunks.join(counts.where("chunks > 1"), key).select(*key, "chunk", "ids").repartition(*key).sortWithinPartitions(*key, "chunk")
               .select(*key, "ids").mapInArrow(digests, "k1 long, k2 long, depth long, ends_sha256 string"))
    return one.union(several)


def trie(turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of ``turns`` (conv_id, pos, turn, total; a row without turn for a conversation without turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    turn_chars, the length of the node's own text.  The node's text is turn depth - 1 of conversation conv_id.
    """
    blocks = in_blocks(turns, width)
    nodes = rolled_up(blocks, "min(conv_id) AS owner, max(total) AS longest", width)
    # the nodes a conversation owns start at depth ``from``, behind ``parent_chars`` of text; at most one of them is childless
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("from"), F.expr("min_by(chars - last_chars, depth)").alias("parent_chars"),
        F.max(F.expr("int(longest = depth)")).alias("leaf"))
    with_own = blocks.join(owned, "conv_id", "left").selectExpr(
        "*", "CASE WHEN from IS NULL THEN 0L ELSE chars - parent_chars END AS own_chars")
    full = rolled_up(with_own.withColumnsRenamed({"chars": "conv_chars"}), """min(conv_id) AS conv_id, count(*) AS n_convs, sum(conv_chars) AS all_chars,
        sum(own_chars) AS own_chars, sum(coalesce(leaf, 0)) AS n_leaves, min_by(parent_chars, conv_id) AS owner_before,
        min_by(from, conv_id) AS from, min_by(total, conv_id) AS owner_total""", width)

    def key(n, upto):
        return " ^ ".join([f"k{n}", *[f"CASE WHEN {k} < {upto} THEN {node_hash(n, f'b * {width} + {k}', f't{k}')} ELSE 0L END" for k in range(width)]])
    above = "(chars - last_chars)"
    full = stage(full.selectExpr(
        "conv_id", "depth", "n_convs", "n_leaves", "last_chars AS turn_chars", "owner_total", "depth = from AND depth > 0 AS branch",
        f"{key(1, 'level')} AS k1", f"{key(2, 'level')} AS k2", f"{key(1, 'level - 1')} AS p1", f"{key(2, 'level - 1')} AS p2",
        f"(all_chars - n_convs * {above}) - (own_chars + owner_before - {above}) AS saved_tokens"), "trie-nodes")
    node = ["k1", "k2", "depth"]
    # where a conversation leaves smaller ones, its node's parent has another owner; elsewhere the owner goes on
    branches = full.where("branch").selectExpr("p1 AS k1", "p2 AS k2", "depth - 1 AS depth", "conv_id AS child")
    parents = branches.join(full.select(*node, F.col("conv_id").alias("parent_conv_id")), node).selectExpr(
        "child AS conv_id", "depth + 1 AS depth", "parent_conv_id")
    kept = full.join(branches.groupBy(*node).agg(F.count(F.lit(1)).alias("branches")), node, "left").join(ended(blocks), node, "left")
    return kept.join(parents, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.expr("CASE WHEN branch THEN parent_conv_id WHEN depth > 0 THEN conv_id END").alias("parent_conv_id"), "n_convs",
        F.expr("int(owner_total > depth) + coalesce(branches, 0L)").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "turn_chars")


def as_they_are(conversations: DataFrame) -> DataFrame:
    """Turns of the conversations for ``trie``, nothing rebuilt."""
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", turn_id(F.col("role"), F.col("text")).alias("id"))
    return numbered(stage(rows, "trie-turns"), ["conv_id"], ["turn", "id"], "pos", "trie").selectExpr("conv_id", "pos", "id AS turn", "size AS total")


def with_text(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` of conversations taken as they are, with the role and text of each node's turn; the root has none."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", turn_id(F.col("role"), F.col("text")).alias("id"), "role", "text")
    turns = numbered(rows, ["conv_id"], ["turn", "id"], "pos", "trie-texts").selectExpr("conv_id", "pos + 1 AS depth", "role", "text")
    return nodes.join(turns, ["conv_id", "depth"], "left")
