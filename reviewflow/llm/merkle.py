"""Merkle dataset manifest with checkpoint-and-recompute proofs (operator 13).

Every document is a leaf; the leaves of a language, by id, are the bottom of
its tree, and the trees' roots, by language, the bottom of the tree above
them.  Two neighbours at a time are hashed to their parent; the last of an odd
number is hashed alone.  Only every ``every``-th level is kept: building it
hashes each aligned subtree of 2 ** every nodes to its top and forgets what
lies between.  Proofs are extracted from above: for each kept node that a
proof passes, its aligned subtree's lost levels are made again from the kept
nodes below, the siblings are emitted, and the levels are dropped again.  A
subtree is at most 2 ** every digests in one row, however large the language.

Cases: null fields hash as ``-`` and differ from empty ones; null ids come
first and prove like any other; rows that repeat an id are ordered by their
leaves; a null language is a language of its own, before the empty one; one
language or one document makes a tree without siblings; an empty table has
neither leaves nor a root; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.common import stage
from reviewflow.llm.order import numbered

EVERY = 8                                   # levels from one kept level to the next
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 64                                 # characters of a digest


def field(value: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**instead: Column) -> Column:
    """Digest of a document; ``instead`` replaces fields by name."""
    return F.sha2(F.concat(*[field(instead.get(f, F.col(f))) for f in FIELDS]), 256)


def subtree_levels(groups: DataFrame, every: int) -> DataFrame:
    """All levels of each aligned subtree, made from its array ``n0``: n1, n2, ... ; null above the tree's root.

    ``size`` is the number of nodes at the kept level in the whole tree: as
    long as more than one is left there, the level above exists.
    """
    for k in range(every):
        groups = groups.selectExpr("*", f"""CASE WHEN size > {2 ** k} THEN
            transform(sequence(0, (size(n{k}) - 1) div 2), p -> sha2(concat(n{k}[2 * p], coalesce(get(n{k}, 2 * p + 1), '')), 256)) END AS n{k + 1}""")
    return groups


def gathered(nodes: DataFrame, every: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """(tree, at, size, n0): aligned subtrees with their kept nodes in order; ``kept`` has (idx, digest, *extra)."""
    rows = F.array_sort(F.collect_list(F.struct("idx", "digest", *extra)))
    return (nodes.groupBy("tree", F.shiftright("idx", every).alias("at")).agg(F.max("size").alias("size"), rows.alias("kept"))
            .withColumn("n0", F.col("kept.digest")))


@dataclass
class Forest:
    """Kept levels of many trees, from the bottom: tables (tree, idx, digest, size); and (tree, root)."""

    levels: list[DataFrame]
    roots: DataFrame
    every: int


def build(bottom: DataFrame, name: str, every: int = EVERY) -> Forest:
    """Kept levels above ``bottom`` (tree, idx, digest, size), each staged; trees end at different levels."""
    levels, roots = [bottom], None
    while True:
        low = levels[-1]
        done = low.where("size = 1").select("tree", F.col("digest").alias("root"))
        roots = done if roots is None else roots.union(done)
        tops = subtree_levels(gathered(low.where("size > 1"), every), every)
        top = F.coalesce(*[F.col(f"n{k}") for k in range(every, 0, -1)])
        size = F.ceil(F.col("size") / 2 ** every).cast("long")
        high = stage(tops.select("tree", F.col("at").alias("idx"), F.get(top, F.lit(0)).alias("digest"), size.alias("size")),
                     f"{name}-level{len(levels)}")
        if high.isEmpty():
            return Forest(levels, stage(roots, f"{name}-roots"), every)
        levels.append(high)


def siblings(place: str, every: int) -> str:
    """SQL for the siblings of the node at ``place`` of its subtree, from its level to the subtree's top.

    (digest, left): the neighbour and whether it stands left; an empty digest where a node is hashed alone."""
    levels = [f"""CASE WHEN n{k + 1} IS NOT NULL THEN struct(coalesce(get(n{k}, shiftright({place}, {k}) ^ 1), '') AS digest,
        shiftright({place}, {k}) & 1 = 1 AS left) END""" for k in range(every)]
    return f"filter(array({', '.join(levels)}), s -> s IS NOT NULL)"


def prove(forest: Forest, name: str, above: DataFrame | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Every bottom node (tree, idx, digest, *extra) with ``path``, the siblings from it to the root.

    ``above`` (tree, path, ...) is what follows a tree's root in the tree over
    the trees; its other columns are carried along.  Each kept level takes its
    nodes' remaining path from the level above it, one row per subtree; only
    the bottom has a row per leaf.
    """
    empty = F.array().cast("array<struct<digest:string,left:boolean>>")
    carried = [c for c in above.columns if c not in ("tree", "path")] if above is not None else []
    path = None                             # of the kept level above: tree, idx, path
    for k in range(len(forest.levels) - 1, -1, -1):
        level, own = forest.levels[k], extra if k == 0 else ()
        # a tree that ends here goes on with what lies above it, any other with the kept level above
        rest = level.where("size = 1").select("tree", F.lit(0).cast("long").alias("at"), F.lit(True).alias("ends"), empty.alias("rest"))
        if path is not None:
            rest = rest.union(path.select("tree", "idx", F.lit(False), "path"))
        if above is not None:
            rest = rest.join(above, "tree").withColumn("rest", F.when(F.col("ends"), F.col("path")).otherwise(F.col("rest")))
        groups = subtree_levels(gathered(level, forest.every, own), forest.every)
        fields = ", ".join(f"node.{c} AS {c}" for c in ("idx", "digest", *own))
        found = (groups.join(rest.select("tree", "at", "rest", *carried), ["tree", "at"])
                 .selectExpr("tree", *carried, f"inline(transform(kept, (node, i) -> struct({fields}, concat({siblings('i', forest.every)}, rest) AS path)))"))
        path = found if k == 0 else stage(found.select("tree", "idx", "path"), f"{name}-proofs{k}")
    return path


def fold(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.expr(f"aggregate({path}, {leaf}, (node, s) -> sha2(CASE WHEN s.left THEN concat(s.digest, node) ELSE concat(node, s.digest) END, 256))")


@dataclass
class Manifest:
    """A forest of one tree per language, the tree over their roots, and the document columns beside the leaves."""

    languages: Forest
    top: Forest
    extra: tuple[str, ...]

    @property
    def root(self) -> DataFrame:
        return self.top.roots.select("root")


def manifest(docs: DataFrame, every: int = EVERY, **extra: Column) -> Manifest:
    """Build the manifest; the columns ``extra`` (by name) are carried beside each leaf.

    Texts are read once, here; from then on a document is its digests."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))           # null first, then by UTF-8 bytes
    leaves = stage(docs.select(tree.alias("tree"), "doc_id", leaf_digest().alias("digest"),
                               *[c.alias(n) for n, c in extra.items()]), "merkle-leaves")
    bottom = stage(numbered(leaves, ["tree"], ["doc_id", "digest"], "idx", "merkle"), "merkle-bottom")
    languages = build(bottom, "merkle-languages", every)
    subroots = languages.roots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("root").alias("digest"))
    top = build(stage(numbered(subroots, ["tree"], ["lang"], "idx", "merkle-top"), "merkle-top-bottom"), "merkle-top", every)
    return Manifest(languages, top, ("doc_id", *extra))


def proofs(of: Manifest) -> DataFrame:
    """Every document with its leaf, subroot, root and the siblings (digest, left) between them."""
    over = prove(of.top, "merkle-top", extra=("lang",)).join(of.top.roots, "tree")
    over = stage(over.select(F.col("lang").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "merkle-subroots")
    return prove(of.languages, "merkle-languages", over, of.extra).withColumnRenamed("digest", "leaf").drop("tree", "idx")


def verify(proved: DataFrame, leaf: str = "leaf") -> DataFrame:
    """``proved`` with the root that ``leaf`` (an SQL expression) and the siblings lead to, and whether it is the manifest's."""
    return proved.select("*", fold(leaf).alias("folded_root")).selectExpr("*", "folded_root = root AS verified")
