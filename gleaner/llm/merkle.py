"""A manifest of a table: hash trees over its rows, with a proof for every row.

Rows are leaves, in the order of a key within their source. Runs of three nodes
become the hash of their digests until one is left, the subroot of the source;
the subroots in the order of the sources become the root in the same way.

The tree is cut into superblocks of 3**HEIGHT consecutive nodes. Every
superblock is reduced to its top by one task; the tops are the leaves of the
next tier, which is cut likewise, so a hot source is many small groups and no
task sees more than one superblock. On the way down the nodes of a superblock
are cogrouped with what they need from outside, the siblings on the way from
the superblock's top to the root: one ``applyInPandas`` repeats the local
reduction, joins the local part of each proof to the outer one, and folds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import ordinals
from gleaner.llm.native import stratum, stored

FAN = 3
# Levels inside a superblock: 729 nodes.
HEIGHT = 6

PROOF = "before array<string>, after array<string>"


def field(value: Column) -> Column:
    """A value as the hash takes it: its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduced(nodes: list[str], levels: int | None) -> list[list[str]]:
    """The levels above a run of nodes, itself first; up to a single node if ``levels`` is None."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return out


def siblings(levels: list[list[str]], place: int) -> tuple[list[str], list[str]]:
    """What stands before and after a node in its run, on each level up to the last."""
    before, after = [], []
    for level in levels[:-1]:
        start = place // FAN * FAN
        before.append("".join(level[start:place]))
        after.append("".join(level[place + 1 : start + FAN]))
        place //= FAN
    return before, after


def _superblock(height: int) -> Column:
    return F.expr(f"pos div {FAN**height}").cast("long")


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """tree, block and the digest of each superblock: as one of several, and as its tree's only one."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        digests = rows.sort_values("pos")["digest"].tolist()
        only = reduced(digests, None)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "block": [key[1]], "many": reduced(digests, height)[-1], "only": [only]})

    # the same keys as in the exchange on the way down
    grouped = nodes.select("tree", "pos", "digest", _superblock(height).alias("block")).groupBy("tree", "block")
    return grouped.applyInPandas(run, "tree string, block long, many string, only string")


def _exchanged(nodes: DataFrame, outer: DataFrame, carried: str, height: int, fold: bool) -> DataFrame:
    """Every node with its whole proof: the subtree exchange.

    ``outer`` has per superblock the siblings above its top (before, after),
    ``many`` (whether its tree has other superblocks), subroot and root.
    """
    names = [c.split()[0] for c in carried.split(", ") if c]
    parted = nodes.withColumn("block", _superblock(height))
    shape = f"tree string, pos long, digest string, subroot string, root string, {PROOF}"
    shape += ", folded string" * fold + (f", {carried}" if carried else "")

    def run(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        over = above.iloc[0]
        digests = rows["digest"].tolist()
        levels = reduced(digests, height if over["many"] else None)
        proofs = [siblings(levels, i) for i in range(len(digests))]
        outer_before, outer_after = list(over["before"]), list(over["after"])
        out = rows[["tree", "pos", "digest", *names]].assign(subroot=over["subroot"], root=over["root"])
        out["before"] = [before + outer_before for before, _ in proofs]
        out["after"] = [after + outer_after for _, after in proofs]
        if fold:
            folded = []
            for node, before, after in zip(rows["claimed"], out["before"], out["after"]):
                for left, right in zip(before, after):
                    node = digest(left, node, right)
                folded.append(node)
            out["folded"] = folded
        return out

    return parted.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(run, shape)


def _prove(
    nodes: DataFrame, above: Callable[[DataFrame], DataFrame], carried: str = "", height: int = HEIGHT, fold: bool = False
) -> DataFrame:
    """Proofs of all nodes (tree, pos, digest), tier by tier.

    ``above`` gives the siblings beyond the trees' own roots: it takes tree
    and subroot, and returns tree, subroot, root, before and after. The tiers
    shrink by 3**height, so there are few: three for 10**8 nodes of one tree.
    """
    tops = stored(_tops(nodes, height), "tops")
    several = tops.groupBy("tree").agg((F.count(F.lit(1)) > 1).alias("several"))
    placed = tops.join(several, "tree")
    if placed.filter("several").isEmpty():
        roots = above(tops.select("tree", F.col("only").alias("subroot")))
        outer = roots.select("tree", F.lit(0).cast("long").alias("block"), F.lit(False).alias("many"), "subroot", "root", "before", "after")
        return _exchanged(nodes, outer, carried, height, fold)
    next_tier = placed.select("tree", F.col("block").alias("pos"), F.when(F.col("several"), F.col("many")).otherwise(F.col("only")).alias("digest"), "several")
    outer = _prove(next_tier, above, "several boolean", height).select(
        "tree", F.col("pos").alias("block"), F.col("several").alias("many"), "subroot", "root", "before", "after"
    )
    return _exchanged(nodes, stored(outer, "outer"), carried, height, fold)


def _over_sources(subroots: DataFrame, height: int) -> DataFrame:
    """The tree over the subroots, in the order of the sources."""
    numbered = ordinals(stored(subroots, "subroots").withColumn("all", F.lit("")), ["all"], [F.col("tree")], "n")
    nodes = numbered.select(F.col("all").alias("tree"), (F.col("n") - 1).alias("pos"), F.col("subroot").alias("digest"), F.col("tree").alias("source"))

    def end(roots: DataFrame) -> DataFrame:
        none = F.array().cast("array<string>")
        return roots.select("tree", "subroot", F.col("subroot").alias("root"), none.alias("before"), none.alias("after"))

    proved = _prove(stored(nodes, "sources"), end, "source string", height)
    return stored(proved.select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root", "before", "after"), "roots")


def manifest(leaves: DataFrame, key: str = "doc_id", source: str = "source", height: int = HEIGHT) -> DataFrame:
    """Every leaf with its proof, and the root that its claimed digest folds to.

    ``leaves`` has the key, the source, ``leaf`` (the digest of the row as it
    was sealed) and ``claimed`` (that of the row to be checked; null: the
    same). Returned are key, leaf, subroot, root, before and after (the
    siblings of each level up to the root, digests side by side), folded.

    Sources that are null are a source of their own, before all others. Keys
    that are null come first in their source; rows with the same key are
    ordered by leaf, so repeated rows have proofs of their own and the same
    root in every run. An empty table has no leaves and no root. Other columns
    of ``leaves`` are ignored.
    """
    rows = leaves.select(
        stratum(F.col(source)).alias("tree"), F.col(key).alias("key"), F.col("leaf").alias("digest"),
        F.coalesce("claimed", "leaf").alias("claimed"),
    )
    kind = rows.schema["key"].dataType.simpleString()
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("claimed")]
    numbered = ordinals(stored(rows, "leaves"), ["tree"], order, "n").withColumn("pos", F.col("n") - 1).drop("n")
    nodes = stored(numbered, "numbered")
    proved = _prove(nodes, lambda roots: _over_sources(roots, height), f"key {kind}, claimed string", height, fold=True)
    return proved.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", "root", "before", "after", "folded")


def proof_digest() -> Column:
    """The hash of all siblings of a proof, level by level, left to right."""
    levels = F.zip_with("before", "after", lambda left, right: F.concat(left, right))
    return F.sha2(F.array_join(levels, ""), 256)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """The proofs of documents, checked against copies of which some have lost their line breaks.

    Copies are tampered with where the CRC-32 of doc_id in decimal digits is
    even; a null doc_id or text is left alone. Columns beyond the five hashed
    are ignored.
    """
    fields = [F.col(c) for c in FIELDS]
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, leaf(*fields[:-1], F.translate("text", "\n", "")))
    sealed = docs.select("doc_id", "source", leaf(*fields).alias("leaf"), altered.alias("claimed"))
    return manifest(sealed).select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), F.col("folded").alias("folded_root"),
        F.col("folded").eqNullSafe(F.col("root")).alias("verified"),
    )


def _run_sql(name: str, tree: str, nodes: str) -> str:
    """Recursive views of a hash tree: all its nodes, and the siblings of each in its run."""
    return f"""
{name}_sizes AS (SELECT {tree}, count(*) AS n FROM {nodes} GROUP BY ALL),
{name}_nodes AS (
  SELECT {tree}, 0 AS level, pos, digest, n FROM {nodes} JOIN {name}_sizes USING ({tree})
  UNION ALL
  SELECT {tree}, any_value(level) + 1, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)), any_value((n + {FAN - 1}) // {FAN})
  FROM {name}_nodes WHERE n > 1 GROUP BY {tree}, pos // {FAN}),
{name}_runs AS MATERIALIZED (
  SELECT {tree}, level, pos, digest, n,
         coalesce(string_agg(digest, '') OVER (PARTITION BY {tree}, level, pos // {FAN} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (PARTITION BY {tree}, level, pos // {FAN} ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_nodes)"""


def manifest_sql(crc_table: str, crc32: str) -> str:
    """SQL of ``tampered_manifest``; ``crc32`` is the checksum of doc_id's digits."""
    part = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c} END"
    most = " || ".join(part(c) for c in FIELDS[:-1])
    return f"""
WITH RECURSIVE {crc_table},
leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({most} || {part("text")}) AS digest,
         CASE WHEN {crc32} % 2 = 0 THEN sha256({most} || {part("replace(text, chr(10), '')")}) END AS altered
  FROM documents, crc_table),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaves),
{_run_sql("s", "tree", "placed")},
subroots AS MATERIALIZED (
  SELECT '' AS whole, tree AS source, digest, row_number() OVER (ORDER BY tree) - 1 AS pos FROM s_runs WHERE n = 1),
{_run_sql("t", "whole", "subroots")},
inner_fold AS (
  SELECT doc_id, tree, 0 AS level, pos, coalesce(altered, digest) AS folded, '' AS proof, 1 AS going FROM placed
  UNION ALL
  SELECT f.doc_id, f.tree, f.level + 1, f.pos // {FAN}, CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END,
         CASE WHEN n > 1 THEN proof || l || r ELSE proof END, (n > 1)::INTEGER
  FROM inner_fold f JOIN s_runs u ON u.tree = f.tree AND u.level = f.level AND u.pos = f.pos WHERE going = 1),
outer_fold AS (
  SELECT doc_id, f.tree, 0 AS level, s.pos, folded, proof, 1 AS going FROM inner_fold f JOIN subroots s ON s.source = f.tree WHERE going = 0
  UNION ALL
  SELECT f.doc_id, f.tree, f.level + 1, f.pos // {FAN}, CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END,
         CASE WHEN n > 1 THEN proof || l || r ELSE proof END, (n > 1)::INTEGER
  FROM outer_fold f JOIN t_runs u ON u.level = f.level AND u.pos = f.pos WHERE going = 1)
SELECT doc_id, p.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256,
       folded AS folded_root, folded = r.digest AS verified
FROM placed p JOIN outer_fold f USING (doc_id, tree) JOIN subroots s ON s.source = p.tree JOIN t_runs r ON r.n = 1
WHERE going = 0
"""
