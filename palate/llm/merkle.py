"""Merkle manifest of a dataset: a tree per source, a tree over the sources, a proof for every row.

A leaf is the digest of a row's fields. The leaves of a source in the order of their ids are cut
into runs of ``ARITY`` that become one node each, level by level, down to a single subroot; the
subroots in the order of the sources become the root in the same way.

Trees are worked off in superblocks of ``BLOCK`` neighbouring nodes of one source, so a source with
most rows is many groups of bounded size:

1. Each superblock is reduced to its top node, which is a narrow grouped step. Tops are nodes of a
   tree of the same shape, ``BLOCK`` times smaller, and go through the same steps until every source
   is a single superblock; then the subroots do.
2. On the way back, the nodes of a superblock are cogrouped with the nodes outside it that their
   proofs need, which are the same for the whole superblock: the siblings of its top, of the top's
   parent and so on. One function finishes the local reduction, joins local and outer siblings to
   proofs, and folds them: a leaf, or what a row has become since, with its siblings up to a root.

Defined cases: null fields are written ``-``, so null and empty differ; a null source is a source of
its own, the first; rows with a null id come first within their source; rows with equal ids are
ordered by their leaves, equal rows are leaves of their own with the same leaf but proofs of their
places; an empty table gives no rows; other columns are ignored. What the tree holds is independent
of partitioning and of ``BLOCK``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.llm.ordered import running
from palate.sources.staging import stage

ARITY = 3
#: Nodes of a superblock; a power of ARITY, so that superblocks are subtrees.
BLOCK = 3**7
#: What a row is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

PATH = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(columns: Sequence[Column]) -> Column:
    """Digest of fields, each as its length in bytes and its value, or ``-``."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def leaves(documents: DataFrame, seen: Column | None = None) -> DataFrame:
    """doc_id, tree (source as text, null first), leaf and a row number of every document.

    ``seen`` is the text as it is found now; ``seen_leaf`` is then the leaf of that."""
    now = F.col("text") if seen is None else seen
    fields = [F.col(c) for c in FIELDS]
    same = now.eqNullSafe(F.col("text"))
    changed = leaf_of([now if c == "text" else F.col(c) for c in FIELDS])
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = documents.select("doc_id", tree.alias("tree"), leaf_of(fields).alias("leaf"), F.when(~same, changed).alias("seen_leaf"))
    return rows.withColumn("row", F.monotonically_increasing_id())


def in_blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / size).cast("long"))


def placed(rows: DataFrame, order: Sequence[Column], size: int = BLOCK) -> DataFrame:
    """``rows`` with at, their place within the tree, n, its number of nodes, and their superblock."""
    return in_blocks(running(rows, order, "at", group="tree", total="n"), size)


def levels_of(digests: list[str], n: int, size: int) -> list[list[str]]:
    """The levels of one superblock of a tree of ``n`` nodes, its nodes first and its top last."""
    levels, width = [digests], size
    while len(levels[-1]) > 1 or (n > size and width > 1):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
        width //= ARITY
    return levels


def tops(nodes: DataFrame, size: int) -> DataFrame:
    """The top of every superblock as a node (tree, at, n, leaf) of the next smaller tree."""

    def top(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        n = int(nodes["n"].iloc[0])
        found = levels_of(nodes["leaf"].tolist(), n, size)[-1][0]
        return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "at": [nodes["block"].iloc[0]], "n": [-(-n // size)], "leaf": [found]})

    cut = nodes.select("tree", "at", "n", "leaf", "block")
    return stage(cut.groupBy("tree", "block").applyInPandas(top, "tree string, at long, n long, leaf string"), "tops")


def local_paths(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Siblings left and right of every node of a superblock, up to its top."""
    found = []
    for i in range(len(levels[0])):
        path, at = [], i
        for level in levels[:-1]:
            low = at - at % ARITY
            path.append(("".join(level[low:at]), "".join(level[at + 1 : low + ARITY])))
            at //= ARITY
        found.append(path)
    return found


def fold(leaf: str, path: Sequence) -> str:
    """The root that a leaf and its siblings make."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def paths_of(nodes: pd.DataFrame, outer: pd.DataFrame, size: int) -> list[list[tuple[str, str]]]:
    """Local reduction of a superblock (in the order of ``at``), its local siblings joined with those outside."""
    beyond = [(p["left"], p["right"]) for p in outer["path"].iloc[0]]
    levels = levels_of(nodes["leaf"].tolist(), int(nodes["n"].iloc[0]), size)
    return [[*own, *beyond] for own in local_paths(levels)]


def _structs(paths: list[list[tuple[str, str]]]) -> list[list[dict]]:
    return [[{"left": a, "right": b} for a, b in path] for path in paths]


def exchanged(nodes: DataFrame, outer: DataFrame, keep: Sequence[str], size: int) -> DataFrame:
    """``keep`` of every node with its whole path and what ``outer`` says of its superblock."""
    extra = [c for c in outer.columns if c not in ("tree", "block", "path")]

    def join(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        same = {c: outer[c].iloc[0] for c in extra}
        return pd.DataFrame({**{c: nodes[c].astype("Int64") if c == "doc_id" else nodes[c] for c in keep}, "path": _structs(paths_of(nodes, outer, size)), **same})

    types = dict(nodes.dtypes) | dict(outer.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in keep], f"path {PATH}", *[f"{c} {types[c]}" for c in extra]])
    cut = nodes.select(*dict.fromkeys(["tree", "block", "at", "n", "leaf", *keep]))
    return cut.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join, schema)


def above(nodes: DataFrame, size: int = BLOCK) -> DataFrame:
    """tree, block, path and root: of every superblock of ``nodes`` the siblings outside it."""
    small = tops(nodes, size)
    if (small.agg(F.max("n").alias("m")).first()["m"] or 0) <= 1:
        return small.select("tree", F.col("at").alias("block"), F.array().cast(PATH).alias("path"), F.col("leaf").alias("root"))
    small = in_blocks(small, size)
    return stage(exchanged(small, above(small, size), ["tree", "at"], size).withColumnRenamed("at", "block"), "outer")


def trees(rows: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The placed leaves, and of every superblock (tree, block) the siblings outside it up to the
    root, its subroot and the root."""
    nodes = placed(stage(rows, "leaves"), [F.col("doc_id"), F.col("leaf"), F.col("row")], size)
    within = above(nodes, size)
    subroots = stage(within.select(F.col("tree").alias("of"), F.col("root").alias("leaf")).distinct(), "subroots")
    sources = stage(placed(subroots.withColumn("tree", F.lit("")), [F.col("of")], size), "sources")
    over = exchanged(sources, above(sources, size), ["of", "leaf"], size)
    over = over.select("of", F.col("leaf").alias("subroot"), F.col("path").alias("over"), "root")
    outer = within.select("tree", "block", "path").join(over, F.col("tree") == F.col("of"))
    return nodes, outer.select("tree", "block", F.concat("path", "over").alias("path"), "subroot", "root")


def proofs(documents: DataFrame, size: int = BLOCK) -> DataFrame:
    """doc_id, leaf, path (siblings left and right, level by level), subroot and root of every row."""
    nodes, outer = trees(leaves(documents), size)
    return exchanged(nodes, outer, ["doc_id", "leaf"], size)


def manifest(documents: DataFrame, seen: Column | None = None, size: int = BLOCK) -> DataFrame:
    """Leaf, subroot, root, digest of the proof and verdict of every row.

    ``seen`` is the text as it is found now: a row is verified if the leaf of what is found, with the
    siblings of the manifest, folds to the root.
    """
    nodes, outer = trees(leaves(documents, seen), size)

    def finish(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("at")
        root, proofs, folded = outer["root"].iloc[0], [], []
        for leaf, found, path in zip(nodes["leaf"], nodes["seen_leaf"], paths_of(nodes, outer, size)):
            proofs.append(digest("".join(a + b for a, b in path)))
            folded.append(fold(found if isinstance(found, str) else leaf, path))
        same = {"subroot": outer["subroot"].iloc[0], "root": root}
        return pd.DataFrame({"doc_id": nodes["doc_id"].astype("Int64"), "leaf": nodes["leaf"], **same, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})

    cut = nodes.select("tree", "block", "at", "n", "doc_id", "leaf", "seen_leaf").groupBy("tree", "block")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return cut.cogroup(outer.groupBy("tree", "block")).applyInPandas(finish, schema)
