"""Near copies by SimHash: fingerprints embedded as bit counts of their segments.

A fingerprint of 64 bits is cut into segments; the bit counts of the segments
are a point on a grid. A bit that differs moves one count by at most one, so
the Manhattan distance of two points never exceeds the number of differing
bits. Fingerprints that differ in at most 3 bits therefore lie within distance
1 on one half of the segments: the halves' points are the cells of two grids,
and every fingerprint visits its own cell and the cells one step above it, so
each pair that may be close meets in exactly one direction. Who meets is
compared by the whole Manhattan distance, then bit by bit.

Equal fingerprints are one point. What meets in a cell gives no more links than
connect it, and a cell with many visitors is cut into blocks that are compared
two by two, so links and rows grow with the fingerprints and not with the square
of a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked
from gleaner.llm.components import components
from gleaner.llm.native import stored

SHINGLE = 3
BITS = 3
SEED = 42
# Shingles whose bits are counted at a time.
SLICE = 1 << 16
# Bits of a segment, and the number of fingerprints from which single bits are taken: with two bits some
# 7 in a million random pairs meet, with one bit 15 in a thousand million, for a third more rows.
SEGMENT_BITS = 2
MANY = 1 << 26
# Rows of a cell that are compared by one task at once.
BLOCK = 4096
# Pairs held at a time.
PAIRS = 1 << 20
SALTS = 64

_U = np.uint64


def fingerprint(text: str | None) -> int:
    """The bits set in over half of the hashes of a text's word shingles; 0 without words.

    Words are runs of bytes other than the six ASCII blanks, A-Z folded.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - SHINGLE + 1
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, SLICE):
        stop = min(n, start + SLICE)
        parts = zip(*[words[start + i : stop + i] for i in range(SHINGLE)])
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(p), SEED) for p in parts), dtype=">u8", count=stop - start)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ``fp`` (a signed long) of every row, in the scan."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=_U)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found.view(np.int64))], ["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp long")


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def embedding(fps: np.ndarray, bits: int) -> np.ndarray:
    """The bit counts of all segments, one row per fingerprint."""
    shifts = np.arange(0, 64, bits, dtype=_U)
    return popcount((fps[:, None] >> shifts) & _U((1 << bits) - 1)).astype(np.int8)


def cells(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, position of the fingerprint, whether it lives there) of both grids.

    A fingerprint lives in one cell of each grid and visits the cells one step
    above: one count more, as far as the segment has bits for it.
    """
    counts = embedding(fps, bits)
    half = counts.shape[1] // 2
    found, who, home = [], [], []
    for grid in range(2):
        mine = counts[:, grid * half : (grid + 1) * half]
        steps = _U(bits + 1) ** np.arange(half, dtype=_U)
        own = (mine.astype(_U) * steps).sum(axis=1, dtype=_U) * _U(2) + _U(grid)
        found.append(own)
        who.append(np.arange(len(fps)))
        home.append(np.ones(len(fps), dtype=bool))
        i, segment = np.nonzero(mine < bits)
        found.append(own[i] + steps[segment] * _U(2))
        who.append(i)
        home.append(np.zeros(len(i), dtype=bool))
    return np.concatenate(found), np.concatenate(who), np.concatenate(home)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all that ``a``-``b`` connect: each to the least of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    out = label != np.arange(len(nodes))
    return nodes[out], nodes[label[out]]


def close_pairs(fps: np.ndarray, home: np.ndarray, group: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between those that live in a cell and all in it; rows are sorted by cell, those that live there first."""
    ends = np.searchsorted(group, group, side="right")
    later = np.where(home, ends - np.arange(len(group)) - 1, 0)
    total = np.cumsum(later)
    found_a, found_b = [fps[:0]], [fps[:0]]
    kept = start = 0
    while start < len(group):
        done = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
        i = np.repeat(np.arange(start, stop), later[start:stop])
        first = np.repeat(total[start:stop] - later[start:stop] - done, later[start:stop])
        j = i + 1 + np.arange(len(i)) - first
        one, other = fps[i], fps[j]
        near = np.abs(embedding(one, bits) - embedding(other, bits)).sum(axis=1) <= BITS
        near &= one != other
        near[near] = popcount(one[near] ^ other[near]) <= BITS
        found_a.append(one[near])
        found_b.append(other[near])
        kept += int(near.sum())
        if kept > 4 * PAIRS:
            a, b = spanning(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, kept = [a], [b], len(a)
        start = stop
    return spanning(np.concatenate(found_a), np.concatenate(found_b))


def _visits(points: DataFrame, bits: int) -> DataFrame:
    """cell, fp, home of all fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy(zero_copy_only=False).view(_U)
            for at in range(0, len(whole), 4096):
                fps = whole[at : at + 4096]
                cell, who, home = cells(fps, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.view(np.int64)), pa.array(fps[who].view(np.int64)), pa.array(home)], ["cell", "fp", "home"]
                )

    return points.select("fp").mapInArrow(run, "cell long, fp long, home boolean")


def _blocked(visits: DataFrame, block: int = BLOCK) -> DataFrame:
    """cell, part, fp, home: full cells are cut into parts, so that all who live there meet all others in some part.

    Those who live in a cell form ``_homes`` groups, all of its rows ``_all``
    groups; a part is one of the first with one of the second.
    """
    full = (
        visits.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"), F.count_if("home").alias("_h"))
        .filter((F.col("_n") > block) & (F.col("_h") > 0))
        .select("cell", F.ceil(F.col("_h") / block).cast("int").alias("_homes"), F.ceil(F.col("_n") / block).cast("int").alias("_all"))
    )
    full, _ = broadcast_checked(full)
    parted = visits.join(full, "cell", "left")
    hashed = F.xxhash64("fp")
    mine, seat = F.pmod(hashed, F.col("_homes")), F.pmod(hashed, F.col("_all"))
    meets = lambda part, home: F.struct(part.cast("long").alias("part"), F.lit(home).alias("home"))
    met = F.transform(F.sequence(F.lit(0), F.col("_homes") - 1), lambda h: meets(h * F.col("_all") + seat, False))
    meeting = F.transform(F.sequence(F.lit(0), F.col("_all") - 1), lambda a: meets(mine * F.col("_all") + a, True))
    parts = (
        F.when(F.col("_all").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("part"), F.col("home").alias("home"))))
        .when(F.col("home"), F.concat(met, meeting))
        .otherwise(met)
    )
    dealt = parted.select("cell", "fp", F.explode(parts).alias("_p"))
    return dealt.select("cell", F.col("_p.part").alias("part"), "fp", F.col("_p.home").alias("home"))


def near_links(points: DataFrame, bits: int = SEGMENT_BITS, block: int = BLOCK) -> DataFrame:
    """Links a, b that connect all distinct fingerprints ``fp`` within 3 bits of each other.

    Rows come sorted by cell, so a task holds the rows of one part of a cell,
    some 2 * ``block`` at most, or a batch of small cells at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(rows: list[np.ndarray]) -> pa.RecordBatch:
            cell, part, fp, home = rows
            new = np.ones(len(cell), dtype=bool)
            new[1:] = (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])
            a, b = close_pairs(fp.view(_U), home, np.cumsum(new), bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if rest is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(rest, rows)]
            if not len(rows[0]):
                continue
            last = np.searchsorted(rows[0], rows[0][-1]) + np.searchsorted(rows[1][rows[0] == rows[0][-1]], rows[1][-1])
            rest = [x[last:] for x in rows]
            if last:
                yield links([x[:last] for x in rows])
        if rest is not None and len(rest[0]):
            yield links(rest)

    dealt = _blocked(stored(_visits(points, bits), "visits"), block)
    sorted_rows = dealt.repartition("cell", "part").sortWithinPartitions("cell", "part", F.desc("home"))
    return sorted_rows.mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_bits: int | None = None) -> DataFrame:
    """key, fp and component of every row: the smallest key reachable over links of 3 bits or fewer.

    Null and empty texts and texts of blanks have fingerprint 0 and are linked
    like others. Rows with a null key are compared like others; a component's
    name is the smallest key that is not null, or null if it has no other.
    Repeated rows are returned as often as they occur. Other columns are
    ignored. ``segment_bits`` changes the work, not the result.
    """
    rows = stored(fingerprints(docs, key, text), "fingerprints")
    points = stored(rows.groupBy("fp").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("rows")), "points")
    size = points.count()
    bits = segment_bits or (SEGMENT_BITS if size < MANY else 1)
    labels = components(near_links(points, bits))
    joined = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("group", F.coalesce("component", "fp"))
    named = joined.groupBy("group").agg(F.min("least").alias("component_key"))
    # A fingerprint with many rows or many relatives is one row here; those with many rows are joined by parts.
    named = stored(joined.join(named, "group").select("fp", "component_key", "rows"), "named")
    copies = F.when(F.col("rows") >= SALTS, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    parts = named.select("fp", "component_key", F.explode(copies).alias("salt"))
    often = named.filter(F.col("rows") >= SALTS).select("fp", F.lit(True).alias("often"))
    marked = rows.join(often, "fp", "left")
    salt = F.when(F.col("often"), F.pmod(F.xxhash64("key"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    return marked.withColumn("salt", salt).join(parts, ["fp", "salt"]).select(
        F.col("key").alias(key), "fp", F.col("component_key").alias("component")
    )


def linked_documents(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_copies(docs).select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))
