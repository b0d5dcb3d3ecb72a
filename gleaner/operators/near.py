"""Near copies among ranked hits: a hit goes if its text is nearly that of a better one that stays.

Texts are cut into words once and become sets of hashed word 3-shingles inside
tasks. Similar sets share several of their first shingles in an order that puts
frequent ones last. Texts that do, and whose signatures of a bit or two for each
shingle do not rule it out, are linked; the links' components hold every two
similar texts together. Only texts of a component are compared, in
the order of the hits; no list of all similar pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.components import components
from gleaner.functions.skew import BROADCAST_ROWS, ordinals
from gleaner.functions.text import tokens
from gleaner.session import stored

# A shingle in so many first places is frequent; so many of them, of 8 bytes, are known to all tasks.
FREQUENT, MOST_FREQUENT = 4, 1 << 18
# Members of a key whose pairs are listed; those of fuller keys are compared by signatures in a task.
FULL = 64
# Members of a full key in one block; blocks of larger keys meet two by two.
BLOCK = 4096
# Hits of a component that are gone through in one task and round, and hits compared with the kept ones at a time.
HEADS, REST = 256, 256
# Texts whose sets are held at once where texts are scanned.
PIECE = 512
_U = np.uint64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=_U)
_GROUP = ["query_id", "_component"]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xFF51AFD7ED558CCD)
    return h ^ (h >> _U(32))


def _sets(lists: pa.Array) -> Iterator[np.ndarray]:
    """The distinct shingles of each list of word hashes, ascending; a shorter text is one shingle."""
    values, ends = lists.values.to_numpy(zero_copy_only=False).view(_U), lists.offsets.to_numpy()
    for start, end in zip(ends[:-1], ends[1:]):
        words = values[start:end]
        if len(words) < 3:
            yield _mixed((words * _FACTORS[: len(words)]).sum(keepdims=True) + _U(len(words)))
        else:
            yield np.unique(_mixed(_mixed(_mixed(words[:-2] * _FACTORS[0]) + words[1:-1]) * _FACTORS[1] + words[2:]))


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """Some rows at a time, so that few sets are held at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


def _shared(n: int, similarity: float) -> int:
    """First shingles that a set of ``n`` shares at least with any similar set."""
    return max(1, min(2 + n // 24, ceil(n * similarity - 1e-9)))


def _first(n: int, similarity: float) -> int:
    """So many first shingles hold ``_shared`` ones: all similar sets have the part ``similarity`` of them in common."""
    return min(n, n - ceil(n * similarity - 1e-9) + _shared(n, similarity))


def _similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def _signature(found: np.ndarray) -> bytes:
    """The parity of the shingles in each of 64 bits, or of the next power of two above the set's size.

    Two signatures of one length differ in no more bits than the sets in shingles.
    """
    bits = max(64, 1 << len(found).bit_length())
    odd = np.bincount((found >> _U(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def words(texts: DataFrame, text: str) -> DataFrame:
    """``_copy``, ``_number`` and ``_words`` of every text, written once; other columns stay with them.

    Equal sequences of words have one ``_copy`` and one ``_number``.
    """
    others = [c for c in texts.columns if c != text]
    cut = texts.select(*others, tokens(F.col(text)).alias("_tokens")).withColumn("_copy", F.md5(F.array_join("_tokens", " ")))
    hashes = F.coalesce(F.transform("_tokens", lambda t: F.xxhash64(t)), F.array().cast("array<bigint>"))
    return stored(cut.select(*others, "_copy", number(F.col("_copy")).alias("_number"), hashes.alias("_words")), "words")


def number(fingerprint: Column) -> Column:
    """A text's fingerprint as a long; null is a text of its own."""
    return F.coalesce(F.conv(F.substring(fingerprint, 1, 15), 16, 10).cast("long"), F.lit(-1).cast("long"))


def _frequent(words: DataFrame, similarity: float) -> np.ndarray:
    """Shingles that are among the first ones of many texts, in the order of their hashes."""

    def first(batches):
        for batch in _pieces(batches):
            parts = [s[: _first(len(s), similarity) * 3 // 2 + 8] for s in _sets(batch.column(0))]
            yield pa.record_batch({"shingle": np.concatenate(parts).view(np.int64)})

    counts = words.select("_words").mapInArrow(first, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    most = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT)
    found = np.array(most.select("shingle").toArrow().column(0).to_pylist(), dtype=np.int64).view(_U)
    return np.append(np.sort(found), ~_U(0))  # the largest number closes it, so that every place can be read


def _keys(words: DataFrame, similarity: float) -> DataFrame:
    """key, number, size: the first shingles of every text, frequent ones last."""
    known = words.sparkSession.sparkContext.broadcast(_frequent(words, similarity))

    def first(batches):
        for batch in _pieces(batches):
            keys, of, sizes = [], [], []
            for one, found in zip(batch.column(0).to_numpy(), _sets(batch.column(1))):
                late = known.value[np.searchsorted(known.value, found)] == found
                mine = np.concatenate([found[~late], found[late]])[: _first(len(found), similarity)]
                keys.append(mine)
                of.append(np.full(len(mine), one))
                sizes.append(np.full(len(mine), len(found), dtype=np.int32))
            yield pa.record_batch({"key": np.concatenate(keys).view(np.int64), "number": np.concatenate(of), "size": np.concatenate(sizes)})

    return words.select("_number", "_words").mapInArrow(first, "key long, number long, size int")


def _met(keys: DataFrame, similarity: float) -> DataFrame:
    """a, b, need, shared of the texts that share a key of few, and a, key (b null) of those that share one of many."""
    schema = "a long, b long, need int, shared int, key long"

    def meet(batches):
        held = None
        for batch in batches:
            rows = [batch.column(i).to_numpy() for i in range(3)]
            if held is not None:
                rows = [np.concatenate([x, y]) for x, y in zip(held, rows)]
            last = np.searchsorted(rows[0], rows[0][-1]) if len(rows[0]) else 0
            held = [x[last:] for x in rows]
            if last:
                yield from met(*[x[:last] for x in rows])
        if held is not None and len(held[0]):
            yield from met(*held)

    def met(key, number, size):
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
        key, number, size = key[fresh], number[fresh], size[fresh]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        members = np.diff(np.append(starts, len(key)))
        for m in np.unique(members[(members > 1) & (members <= FULL)]):
            each = starts[members == m]
            i, j = np.triu_indices(int(m), 1)
            for some in np.array_split(each, max(1, len(each) * len(i) >> 18)):
                a, b = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                fits = np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b]) - 1e-9
                a, b = a[fits], b[fits]
                least = np.minimum(size[a], size[b])
                need = np.maximum(1, np.minimum(2 + least // 24, np.ceil(least * similarity - 1e-9))).astype(np.int32)
                yield from rows(number[a], number[b], need, np.ones(len(a), dtype=np.int32), None)
        full = np.repeat(members > FULL, members)
        if full.any():
            yield from rows(number[full], None, None, None, key[full])

    def rows(a, b, need, shared, key):
        blank = lambda x, kind: pa.nulls(len(a), kind) if x is None else pa.array(x)
        yield pa.record_batch(
            [pa.array(a), blank(b, pa.int64()), blank(need, pa.int32()), blank(shared, pa.int32()), blank(key, pa.int64())],
            names=["a", "b", "need", "shared", "key"],
        )

    dealt = keys.repartition("key").sortWithinPartitions("key", "number")
    return stored(dealt.mapInArrow(meet, schema), "met")


def _signatures(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """a, size, signature of the texts with the numbers ``wanted``."""

    def signed(batches):
        for batch in _pieces(batches):
            found = list(_sets(batch.column(1)))
            yield pa.record_batch({"a": batch.column(0), "size": pa.array([len(s) for s in found], pa.int32()), "signature": pa.array([_signature(s) for s in found], pa.binary())})

    return stored(_of(words, wanted).mapInArrow(signed, "a long, size int, signature binary").dropDuplicates(["a"]), "signatures")


def _apart(similarity: float, total):
    """Sets with at least this part of their union in common differ in no more shingles; ``total`` is the sum of their sizes."""
    return total * ((1 - similarity) / (1 + similarity)) + 1e-6


def _may_be_similar(pairs: DataFrame, signatures: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b that their signatures do not rule out."""

    def compare(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(4).to_pylist()
            total = batch.column(3).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
            width = lambda x, n: np.bitwise_xor.reduce(np.frombuffer(x, dtype=np.uint64).reshape(-1, n // 8), axis=0)
            bits = [int(np.bitwise_count(width(x, n) ^ width(y, n)).sum()) for x, y, n in ((x, y, min(len(x), len(y))) for x, y in zip(a, b))]
            yield batch.select([0, 1]).filter(pa.array(np.array(bits, dtype=np.int64) <= _apart(similarity, total)))

    other = signatures.toDF("b", "_size", "_signature")
    both = pairs.join(signatures, "a").join(other, "b").select("a", "b", "signature", "size", "_signature", "_size")
    return both.mapInArrow(compare, "a long, b long")


def _links_of_full(signatures: DataFrame, full: DataFrame, similarity: float) -> DataFrame:
    """a, b: links that connect all similar texts that share a full key.

    Inside a block a text takes all that may be similar to it and are not yet
    taken, so a group of near copies costs few compares and a link per text.
    """

    blocks = stored(full.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("a", "key"), F.col("blocks")).cast("int")
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    rows = (
        full.join(blocks, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(other))
        .select("key", "a", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))
        .join(signatures, "a")
    )
    # A level is a power of two of the size. A set stands in its own and in those of smaller sets that may be similar.
    level = lambda size: F.length(F.bin(size.cast("long"))) - 1
    lowest = F.greatest(F.lit(1), F.floor(F.col("size") * F.lit(similarity) - 1e-6))
    rows = rows.withColumn("level", F.explode(F.sequence(level(lowest), level(F.col("size")))))

    def connected(table: pa.Table) -> pa.Table:
        a, size = table.column("a").to_numpy(), table.column("size").to_numpy().astype(np.int64)
        width = max(64, 2 << table.column("level")[0].as_py()) // 8
        parity = (np.frombuffer(x, dtype=np.uint8).reshape(-1, width) for x in table.column("signature").to_pylist())
        bits = np.stack([np.bitwise_xor.reduce(x, axis=0) for x in parity]).view(np.uint64)
        links, left = [], np.arange(len(a))
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = np.zeros(len(left), dtype=bool)
                for k in range(0, len(left), 1024):
                    some = left[k : k + 1024]
                    apart = np.bitwise_count(bits[some] ^ bits[at]).sum(axis=1, dtype=np.int64)
                    total = size[some] + size[at]
                    near[k : k + 1024] = (apart <= _apart(similarity, total)) & (
                        np.minimum(size[some], size[at]) >= similarity * np.maximum(size[some], size[at]) - 1e-9
                    )
                links += [(a[at], a[i]) for i in left[near]]
                queue += list(left[near])
                left = left[~near]
        one, two = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})

    return rows.groupBy("key", "one", "two", "level").applyInArrow(connected, "a long, b long")


def _of(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the numbers in ``wanted``, which go to the texts if they are few."""
    return words.join(_sent(wanted), "_number", "left_semi")


def _sent(rows: DataFrame) -> DataFrame:
    """The rows, which are read once more, with a broadcast hint if they are few."""
    rows = stored(rows, "sent")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _linked(words: DataFrame, similarity: float) -> DataFrame | None:
    """_number, _component of all texts that may be similar to another one; null if none is."""
    met = _met(_keys(words, similarity), similarity)
    few = (
        met.filter("b IS NOT NULL")
        .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .agg(F.max("need").alias("need"), F.sum("shared").alias("shared"))
        .filter("shared >= need")
        .select("a", "b")
    )
    few = stored(few, "few")
    full = stored(met.filter("b IS NULL").select("a", "key").distinct(), "full")
    wanted = few.select("a").unionByName(few.select(F.col("b").alias("a"))).unionByName(full.select("a")).distinct()
    signatures = _signatures(words, wanted.withColumnRenamed("a", "_number"))
    links = _may_be_similar(few, signatures, similarity)
    if not full.isEmpty():
        links = links.unionByName(_links_of_full(signatures, full, similarity))
    links = stored(links, "near")
    return None if links.isEmpty() else stored(components(links).toDF("_number", "_component"), "alike")


_ROW = "query_id string, _component long, _place long"


def _as_rows(query_ids, parts, places) -> pa.Table:
    return pa.table({"query_id": pa.array(query_ids, pa.string()), "_component": pa.array(parts, pa.int64()), "_place": pa.array(places, pa.int64())})


def _kept_heads(heads: DataFrame, similarity: float) -> DataFrame:
    """query_id, _component, _place of the hits that stay among the best of every component."""

    def passed(batches):
        group, kept = None, []
        for batch in batches:
            queries, parts, places = (batch.column(i).to_pylist() for i in range(3))
            stay = []
            for i, found in enumerate(_sets(batch.column(3))):
                if (queries[i], parts[i]) != group:
                    group, kept = (queries[i], parts[i]), []
                if not any(_similar(found, other, similarity) for other in kept):
                    kept.append(found)
                    stay.append(i)
            if stay:
                yield from _as_rows(*([x[i] for i in stay] for x in (queries, parts, places))).to_batches()

    dealt = heads.select(*_GROUP, "_place", "_words").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "_place")
    return dealt.mapInArrow(passed, _ROW)


def _unlike(rest: DataFrame, heads: DataFrame, kept: DataFrame, similarity: float) -> DataFrame:
    """Of ``rest`` the rows similar to none of the ``heads`` that are ``kept`` in their component, without their words."""
    blocks = rest.groupBy(*_GROUP).agg(F.ceil(F.count(F.lit(1)) / REST).cast("int").alias("_blocks"))
    dealt = rest.join(blocks, _GROUP).withColumn("_block", F.pmod(F.xxhash64("_place"), F.col("_blocks")).cast("int"))
    # Stored, or the two sides of the comparison would have columns in common.
    asked = stored(heads.join(_sent(kept.join(blocks, _GROUP)), [*_GROUP, "_place"]), "asked").withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        others = list(_sets(right.column("_words").combine_chunks())) if len(right) else []
        stay = [i for i, found in enumerate(_sets(left.column("_words").combine_chunks())) if not any(_similar(found, x, similarity) for x in others)] if len(left) else []
        return _as_rows(*(left.column(c).take(pa.array(stay, pa.int64())).to_pylist() for c in (*_GROUP, "_place")))

    by = [*_GROUP, "_block"]
    columns = [*by, "_place", "_words"]
    return dealt.select(*columns).groupBy(*by).cogroup(asked.select(*columns).groupBy(*by)).applyInArrow(compare, _ROW)


def near_copies(placed: DataFrame, words: DataFrame, similarity: float) -> DataFrame | None:
    """query_id and _place of the hits that go; null if none goes.

    ``placed`` holds query_id, _place (1, 2, ... by rank) and _number of every
    hit, ``words`` what the function of this name gives; further texts do no harm.
    """
    words = words.select("_number", "_words")
    wanted = placed.select("_number").distinct()
    if wanted.count() <= BROADCAST_ROWS:
        words = _of(words, wanted)
    linked = _linked(words, similarity)
    if linked is None:
        return None
    mine = placed.select(F.col("query_id").cast("string").alias("query_id"), "_place", "_number").join(linked, "_number")
    held = _of(words, linked.select("_number")).dropDuplicates(["_number"])
    # Hits are numbered by ids alone; their words come afterwards.
    by_place = lambda rows: ordinals(rows, _GROUP, [F.col("_place").asc()], "_turn")
    members = stored(by_place(mine).join(held, "_number").select(*_GROUP, "_place", "_turn", "_words"), "members")
    of = [*_GROUP, "_place"]
    now, stays = members, None
    while True:
        heads = now.filter(F.col("_turn") <= HEADS)
        kept = stored(_kept_heads(heads, similarity), "kept")
        stays = kept if stays is None else stays.unionByName(kept)
        rest = now.filter(F.col("_turn") > HEADS)
        if rest.isEmpty():
            break
        left = stored(_unlike(rest, heads, kept, similarity), "left")
        if left.isEmpty():
            break
        now = members.drop("_turn").join(_sent(by_place(left)), of)
    return members.select("query_id", "_place").join(stays.select("query_id", "_place"), ["query_id", "_place"], "left_anti")
