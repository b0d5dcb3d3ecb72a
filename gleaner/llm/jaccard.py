"""Documents whose 5-word shingle sets are alike, by a size-aware heavy-light join.

Sets are ordered by a global order of shingles, rare ones first. Two sets with
Jaccard similarity of at least 0.8 share at least k shingles among the first
``n - ceil(0.8 n) + k`` of each. Small sets are found by all 2-subsets of their
first shingles (k = 2), large sets by scanning the inverted lists of their
first shingles and counting how many a pair shares (k = 4). The boundary is
where the estimated cost is least: subsets made on the one side, lists scanned
on the other. Pairs found are compared in full, so the result is exact.

Links are wanted as components, so pairs known to be connected are not
compared. Where the subsets and lists still open would give many pairs, sets
that share one are first compared with the most typical of them and with a few
neighbours in a random order. In the end all pairs across the components so
found are compared, so no link is lost: one by one, or in blocks of sets where
a key has very many.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked
from gleaner.llm.components import components
from gleaner.llm.native import stored
from gleaner.llm.words import WordHasher, fingerprint, mixed, shingles

# Similarity of at least 80 percent.
PERCENT = 80
# A shingle in so many first places is frequent; so many of them, of 9 bytes, are known to all tasks.
FREQUENT, MOST_FREQUENT = 4, 1 << 18
# Shingles shared by pairs that are found in the lists.
SHARED = 4
# Shingles counted beyond twice the first places, for short texts.
MORE = 8
# Keys of shingles in 2**6 first places or more are hot.
HOT_LEVEL = 6
# The boundary between small and large sets is looked for up to this size.
LARGEST_SMALL = 64
# A hot key's members are dealt to so many groups.
SALTS = 64
# While open keys would give more pairs than this times their rows, only some are compared:
# those with the most typical set (0) or with so many neighbours.
PAIRS_PER_ROW, WIDTHS = 4, (0,)
# Sets of a block, and the numbers a matrix of two blocks' sets may have.
BLOCK_SETS, MATRIX = 64, 1 << 25
# Sets whose fullest key has 2**4 members or more are compared in blocks.
BLOCK_LEVEL = 4
_U = np.uint64
_PAIR = (_U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB))


def first_places(n: int, k: int) -> int:
    """How many first shingles of a set of ``n`` hold k of those shared with any similar set."""
    return min(n, n + k - -(-PERCENT * n // 100))


def _sets(batch: pa.RecordBatch, hasher: WordHasher) -> Iterator[np.ndarray]:
    for words in hasher.texts(batch.column("text").to_pylist()):
        yield shingles(words)


def _binary(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and node, the 64-bit name of the shingle set (null if it is empty)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            sizes, nodes = [], []
            for found in _sets(batch, hasher):
                sizes.append(len(found))
                nodes.append(fingerprint(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())], ["doc_id", "n_shingles", "node"]
            )

    return _binary(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, n_shingles long, node long")


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Each set of a task once; sets of three shingles or fewer are like no other set."""
    hasher, seen = WordHasher(), set()
    for batch in batches:
        for found in _sets(batch, hasher):
            if len(found) > 3:
                node = fingerprint(found)
                if node not in seen:
                    seen.add(node)
                    yield node, found


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """The frequent shingles in ascending order, their rank classes, and the mean length of other lists.

    Counted in all documents among the first shingles by hash, twice as many as
    have to be compared: frequent ones will go last, so others move up. Any order of shingles gives right results, a better one fewer comparisons;
    so the list known to all tasks is bounded: if more are frequent, the bar
    is raised by powers of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for _, found in _distinct_sets(batches):
            parts.append(found[: 2 * first_places(len(found), SHARED) + MORE])
            size += len(parts[-1])
            if size > 200_000:
                yield _column(parts)
                parts, size = [], 0
        if parts:
            yield _column(parts)

    def _column(parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64))], ["shingle"])

    counts = stored(
        _binary(docs).mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shingles"
    )
    level = F.floor(F.log2("n")).cast("int")
    classes = {r["c"]: r for r in counts.groupBy(level.alias("c")).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q")).collect()}
    bar = int(np.log2(FREQUENT))
    while sum(r["k"] for c, r in classes.items() if c >= bar) > MOST_FREQUENT:
        bar += 1
    rest = [r for c, r in classes.items() if c < bar]
    listed = sum(r["q"] for r in rest) / max(1, sum(r["s"] for r in rest))
    top = counts.filter(level >= bar).select("shingle", level.alias("c")).toPandas()
    found = top["shingle"].to_numpy(np.int64).view(_U)
    order = np.argsort(found)
    return found[order], top["c"].to_numpy(np.int8)[order], max(1.0, listed)


def boundary(sizes: dict[int, int], listed: float) -> int:
    """The largest size of small sets: where subsets made and lists scanned cost least together.

    ``sizes`` counts the sets by size, those above ``LARGEST_SMALL`` under the
    next size. A list is scanned once per set and shingle; pairs of a large
    and a small set are found in the lists too, so lists begin at 80 % of the
    boundary.
    """

    def cost(most: int) -> float:
        small = sum(c * comb(first_places(n, 2), 2) for n, c in sizes.items() if n <= most)
        large = sum(c * first_places(n, SHARED) * listed for n, c in sizes.items() if 100 * n >= PERCENT * (most + 1))
        return small + large

    return min([0, *range(4, LARGEST_SMALL + 1)], key=lambda most: (cost(most), most))


def keys(docs: DataFrame, small: int, frequent: np.ndarray, levels: np.ndarray) -> DataFrame:
    """key, node, n, weight, core and hot for every 2-subset of a small set and every list entry of a large one.

    A list entry weighs 1, a subset as much as the entries that a pair must share;
    ``core`` is the share of the set's shingles, in 100ths, that are frequent.
    """
    known = docs.sparkSession.sparkContext.broadcast((frequent, levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, level = known.value
        out: list[tuple] = []
        size = 0
        for node, found in _distinct_sets(batches):
            n = len(found)
            levels = np.zeros(n, np.int8)
            if len(often):
                at = np.minimum(np.searchsorted(often, found), len(often) - 1)
                levels = np.where(often[at] == found, level[at], levels)
                order = np.lexsort((found, levels))
                found, levels = found[order], levels[order]
            hot = levels >= HOT_LEVEL
            core = 100 * np.count_nonzero(levels) // n
            if n <= small:
                p = first_places(n, 2)
                i, j = np.triu_indices(p, 1)
                out.append((node, n, core, mixed(found[i] * _PAIR[0] + found[j] * _PAIR[1]), hot[i] & hot[j], SHARED))
                size += len(i)
            if 100 * n >= PERCENT * (small + 1):
                p = first_places(n, SHARED)
                out.append((node, n, core, found[:p], hot[:p], 1))
                size += p
            if size > 100_000:
                yield _rows(out)
                out, size = [], 0
        if out:
            yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        times = [len(o[3]) for o in out]
        each = lambda at, kind: pa.array(np.repeat(np.array([o[at] for o in out], kind), times))
        found, hot = np.concatenate([o[3] for o in out]), np.concatenate([o[4] for o in out])
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), each(0, np.int64), each(1, np.int32), each(5, np.int8), each(2, np.int8), pa.array(hot)],
            ["key", "node", "n", "weight", "core", "hot"],
        )

    return _binary(docs).mapInArrow(run, "key long, node long, n int, weight byte, core byte, hot boolean")


def _close(a: str, b: str):
    """Sizes that a similar pair can have."""
    return PERCENT * F.greatest(a, b) <= 100 * F.least(a, b)


def _pairs(rows: DataFrame) -> DataFrame:
    """Pairs a < b that share enough, from rows of node, n, other, other_n and weight."""
    return (
        rows.filter((F.col("node") != F.col("other")) & _close("n", "other_n"))
        .groupBy(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .agg(F.sum("weight").alias("_w"))
        .filter(F.col("_w") >= SHARED)
        .select("a", "b")
    )


def _salt(of: Column) -> Column:
    return F.when(F.col("hot"), F.pmod(of, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")


def _typical(rows: DataFrame) -> DataFrame:
    """Members of a key with the one whose shingles are the most frequent, in groups if the key is hot."""
    salted = rows.withColumn("salt", _salt(F.col("node")))
    pick = F.max(F.struct("core", "node", "n")).alias("_p")
    chosen = salted.groupBy("key", "salt").agg(pick)
    among = F.max("_p").over(Window.partitionBy("key"))
    other = [F.col("_p.node").alias("other"), F.col("_p.n").alias("other_n")]
    inside = salted.join(chosen, ["key", "salt"]).select("key", "node", "n", "weight", *other)
    groups = chosen.withColumn("_q", among).select(
        "key", F.col("_p.node").alias("node"), F.col("_p.n").alias("n"), F.lit(SHARED).cast("byte").alias("weight"),
        F.col("_q.node").alias("other"), F.col("_q.n").alias("other_n"),
    )
    return inside.unionByName(groups)


def _neighbours(rows: DataFrame, turn: int, width: int) -> DataFrame:
    """Members of a key with those next to them in a random order, of another component."""
    order = F.xxhash64(F.col("node"), F.lit(turn))
    near = Window.partitionBy("key", "salt").orderBy("_order", "node").rowsBetween(1, width)
    return (
        rows.withColumn("_order", order)
        .withColumn("salt", _salt(F.col("_order")))
        .withColumn("_near", F.collect_list(F.struct("node", "n", "component")).over(near))
        .withColumn("_o", F.explode(F.filter("_near", lambda o: o["component"] != F.col("component"))))
        .select("key", "node", "n", "weight", F.col("_o.node").alias("other"), F.col("_o.n").alias("other_n"))
    )


def _across(rows: DataFrame) -> DataFrame:
    """All pairs of a key's members of different components."""
    one = rows.select("key", "node", "n", "weight", F.col("component").alias("_c"))
    two = rows.select("key", F.col("node").alias("other"), F.col("n").alias("other_n"), F.col("component").alias("_d"))
    return one.join(two, "key").filter((F.col("_c") != F.col("_d")) & (F.col("node") < F.col("other")) & _close("n", "other_n"))


def _relabelled(label: DataFrame | None, links: DataFrame) -> DataFrame:
    """node and component with more links; components that they join become one."""
    if label is None:
        return stored(components(links), "label")
    of = lambda name: label.select(F.col("node").alias(name), F.col("component").alias("_" + name))
    joined = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    upper = stored(components(joined.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))), "upper")
    higher = upper.select(F.col("node").alias("component"), F.col("component").alias("_high"))
    old = label.join(higher, "component", "left").select("node", F.coalesce("_high", "component").alias("component"))
    return stored(old.unionByName(upper.join(label, "node", "left_anti")), "label")


def _sets_of(wanted: DataFrame, docs: DataFrame, described: DataFrame) -> DataFrame:
    """node and set of the wanted nodes.

    Their texts are found by the doc_id of one of their documents: by
    broadcast if the counted ids allow it, else by shuffle.
    """
    ids = described.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("_id"))
    ids, _ = broadcast_checked(ids.select("_id").distinct())
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, sets = [], []
        for node, found in _distinct_sets(batches):
            nodes.append(node)
            sets.append(found.tobytes())
            if len(sets) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])
                nodes, sets = [], []
        if sets:
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])

    return _binary(texts).mapInArrow(run, "node long, set binary").join(wanted, "node", "left_semi")


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))


def _similar(shared, x, y):
    return 100 * shared >= PERCENT * (x + y - shared)


def verified(pairs: DataFrame, docs: DataFrame, described: DataFrame) -> DataFrame:
    """Those pairs whose sets are similar, compared in full."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    sets = _sets_of(wanted, docs, described)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = np.frombuffer(one.as_buffer(), dtype=_U), np.frombuffer(other.as_buffer(), dtype=_U)
                keep.append(_similar(_shared(x, y), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (
        pairs.join(sets.withColumnsRenamed({"node": "a", "set": "set_a"}), "a")
        .join(sets.withColumnsRenamed({"node": "b", "set": "set_b"}), "b")
        .select("a", "b", "set_a", "set_b")
    )
    return stored(both.mapInArrow(compare, "a long, b long").distinct(), "linked")


def _spanning(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links that connect as much as all, one less than the sets of each component."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.get(x, x) != x:
            x = top[x]
        return x

    kept = []
    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def block_links(rows: DataFrame, blocks: DataFrame, docs: DataFrame, described: DataFrame) -> DataFrame:
    """Links across components between sets of hot keys, and between them and others.

    ``blocks`` has node, n, component, block and hot. Two blocks that share
    enough keys are compared by one task, all sets of the one with all of the
    other, and give no more links than connect them. What is moved and what is
    joined grows with the pairs of blocks, not of sets.
    """
    in_key = (
        rows.select("key", "node", "weight").join(blocks, "node")
        .groupBy("key", "block", "hot")
        .agg(F.max("weight").alias("w"), F.min("n").alias("least"), F.max("n").alias("most"),
             F.min("component").alias("c"), F.max("component").alias("d"))
    )
    renamed = {c: "_" + c for c in ("block", "hot", "w", "least", "most", "c", "d")}
    close = PERCENT * F.greatest("least", "_least") <= 100 * F.least("most", "_most")
    several = (F.least("c", "_c") != F.greatest("d", "_d"))
    pairs = (
        in_key.join(in_key.withColumnsRenamed(renamed), "key")
        .filter((F.col("hot") | F.col("_hot")) & (F.col("block") <= F.col("_block")) & close & several)
        .groupBy(F.col("block").alias("a"), F.col("_block").alias("b"))
        .agg(F.sum("w").alias("_sum"))
        .filter(F.col("_sum") >= SHARED)
        .select("a", "b")
    )
    pairs = stored(pairs, "blocks")
    both = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    placed = both.join(blocks.select("node", "component", "block"), "block").select("a", "b", "node", "component")
    wanted = stored(placed.select("node").distinct(), "wanted")
    given = placed.join(_sets_of(wanted, docs, described), "node")

    def compare(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        apart = table.column("component").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), dtype=_U) for s in table.column("set").combine_chunks()]
        sizes = np.array([len(s) for s in sets])
        words, where = np.unique(np.concatenate(sets), return_inverse=True)
        i, j = np.nonzero(np.triu(apart[:, None] != apart[None, :], 1))
        close = PERCENT * np.maximum(sizes[i], sizes[j]) <= 100 * np.minimum(sizes[i], sizes[j])
        i, j = i[close], j[close]
        if len(sets) * len(words) <= MATRIX:
            matrix = np.zeros((len(sets), len(words)), dtype=np.float32)
            matrix[np.repeat(np.arange(len(sets)), sizes), where] = 1
            shared = (matrix @ matrix.T)[i, j].astype(np.int64)
        else:
            shared = np.array([_shared(sets[x], sets[y]) for x, y in zip(i, j)], dtype=np.int64)
        like = _similar(shared, sizes[i], sizes[j])
        kept = _spanning([(int(nodes[x]), int(nodes[y])) for x, y in zip(i[like], j[like])])
        a, b = (pa.array([min(k) for k in kept], pa.int64()), pa.array([max(k) for k in kept], pa.int64()))
        return pa.table([a, b], names=["a", "b"])

    return stored(given.groupBy("a", "b").applyInArrow(compare, "a long, b long").distinct(), "linked")


def _blocks(rows: DataFrame) -> DataFrame:
    """node, n, component, block, hot: sets whose fullest key is hot share blocks, others are their own.

    A component that fills a block of its own has blocks of its own, which need
    not be compared with each other; smaller ones are kept together in the rest.
    """
    top = F.max(F.struct("_n", "key")).alias("_t")
    each = rows.groupBy("node", "n", "component").agg(top).select(
        "node", "n", "component", F.col("_t.key").alias("_top"), (F.col("_t._n") >= 1 << BLOCK_LEVEL).alias("hot")
    )
    chosen = each.filter("hot").groupBy("_top", "component").agg(F.count(F.lit(1)).alias("_m"))
    fills = F.col("_m") >= BLOCK_SETS
    chosen = chosen.withColumn("_home", F.when(fills, F.xxhash64("_top", "component")).otherwise(F.xxhash64("_top")))
    homes = chosen.groupBy("_home").agg(F.sum("_m").alias("_all"))
    placed = each.join(chosen, ["_top", "component"], "left").join(homes, "_home", "left")
    dealt_by = F.xxhash64(F.when(fills, F.col("node")).otherwise(F.col("component")), F.lit("block"))
    part = F.pmod(dealt_by, F.ceil(F.col("_all") / BLOCK_SETS))
    block = F.when(F.col("hot"), F.xxhash64("_home", part)).otherwise(F.col("node"))
    return placed.select("node", "n", "component", block.alias("block"), "hot")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: key, n_shingles, component_id.

    Documents are linked if their sets of 5-word shingles have a Jaccard
    similarity of at least 0.8; the component is the smallest key reachable by
    links. Equal sets are one set from the start. Null and empty texts have no
    shingles and are their own component, as are rows with a null key unless
    linked to others (a component of null keys alone is null). Repeated rows
    are linked. Other columns are not read; an empty table gives none.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    described = stored(describe(docs), "described")
    frequent, levels, listed = frequent_shingles(docs)
    size = F.least(F.col("n_shingles"), F.lit(LARGEST_SMALL + 1))
    sizes = described.filter("n_shingles > 3").groupBy("node").agg(F.first(size).alias("n")).groupBy("n").count()
    small = boundary({r["n"]: r["count"] for r in sizes.collect()}, listed)

    group = Window.partitionBy("key", "salt")
    members = stored(
        keys(docs, small, frequent, levels)
        .withColumn("salt", _salt(F.col("node")))
        .withColumn("_first", F.min("node").over(group))
        .withColumn("_last", F.max("node").over(group))
        .filter(F.col("hot") | (F.col("_last") != F.col("_first")))
        .select("key", "salt", "node", "n", "weight", "core", "hot")
        .distinct()  # in place, as rows are dealt by key and salt already
        .drop("salt"),
        "members",
    )
    rows = members.withColumn("component", F.col("node"))
    label, compared = None, None
    for turn, width in enumerate([*WIDTHS, None]):
        counts = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_c"))
        held = counts.groupBy("key").agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_c")).alias("_s")).filter("_n * _n > _s")
        held = stored(held, "held")
        open_pairs, open_rows = held.agg(F.coalesce(F.sum(F.expr("(_n * _n - _s) / 2")), F.lit(0)), F.coalesce(F.sum("_n"), F.lit(0))).first()
        if not open_rows:
            break
        last = width is None or open_pairs <= PAIRS_PER_ROW * members.count()
        still_open = stored(rows.join(held.select("key", "_n"), "key"), "open")
        if last:
            blocks = stored(_blocks(still_open), "blocks")
            cold = still_open.join(blocks.filter("hot").select("node"), "node", "left_anti")
            pairs = _pairs(_across(cold))
        else:
            pairs = _pairs(_typical(still_open) if width == 0 else _neighbours(still_open, turn, width))
        pairs = stored(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "pairs")
        links = verified(pairs, docs, described)
        if last:
            links = links.unionByName(block_links(still_open, blocks, docs, described))
        label = _relabelled(label, links)
        if last:
            break
        compared = pairs if compared is None else compared.unionByName(pairs)
        kept = still_open.drop("component", "_n")
        alone = kept.join(label, "node", "left_anti").withColumn("component", F.col("node"))
        rows = stored(kept.join(label, "node").unionByName(alone), "rows")
    if label is None:
        label = docs.sparkSession.createDataFrame([], "node long, component long")
    final = described.join(label, "node", "left").select("doc_id", "n_shingles", F.coalesce("component", "node").alias("_class"))
    final = stored(final, "classes")
    least = final.filter("_class IS NOT NULL").groupBy("_class").agg(F.min("doc_id").alias("_least"))
    return final.join(least, "_class", "left").select(
        F.col("doc_id").alias(key),
        "n_shingles",
        F.when(F.col("_class").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def link_sql(table: str = "documents") -> str:
    """SQL of the same components: the CTEs up to ``linked`` (row_id, columns of ``table``, n_shingles, component_id)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
jw AS (
  SELECT row_number() OVER () AS row_id, *,
         regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM {table}),
js AS (
  SELECT row_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END) AS s
  FROM jw),
jn AS (SELECT row_id, count(*) AS n FROM js GROUP BY row_id),
jf AS (SELECT row_id, string_agg(s, chr(10) ORDER BY s) AS f FROM js GROUP BY row_id),
jr AS (SELECT f, min(row_id) AS rep FROM jf GROUP BY f),
jo AS (SELECT js.row_id, js.s, n FROM js JOIN jr ON js.row_id = jr.rep JOIN jn ON jn.row_id = js.row_id),
jd AS (SELECT s, count(*) AS df FROM jo GROUP BY s),
jp AS (SELECT * FROM (SELECT jo.*, row_number() OVER (PARTITION BY row_id ORDER BY df, s) AS place FROM jo JOIN jd USING (s)) WHERE place <= n - (4 * n + 4) // 5 + 1),
jc AS (
  SELECT DISTINCT x.row_id AS a, y.row_id AS b, x.n AS na, y.n AS nb FROM jp x JOIN jp y ON x.s = y.s AND x.row_id < y.row_id
  AND 80 * greatest(x.n, y.n) <= 100 * least(x.n, y.n)),
je AS (
  SELECT a, b FROM (SELECT a, b, na, nb, count(*) AS o FROM jc JOIN jo x ON x.row_id = a JOIN jo y ON y.row_id = b AND x.s = y.s GROUP BY a, b, na, nb)
  WHERE 100 * o >= 80 * (na + nb - o)),
jl AS (SELECT a, b FROM je UNION SELECT rep, row_id FROM jf JOIN jr USING (f)),
jm AS (SELECT a, b FROM jl UNION SELECT b, a FROM jl),
jt(a, b) AS (SELECT row_id, row_id FROM jw UNION SELECT jt.a, jm.b FROM jt JOIN jm ON jt.b = jm.a),
jk AS (SELECT jt.a AS row_id, min(doc_id) AS component_id FROM jt JOIN jw ON jw.row_id = jt.b GROUP BY jt.a),
linked AS (SELECT jw.* EXCLUDE (w), coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM jw LEFT JOIN jn USING (row_id) JOIN jk USING (row_id))"""
