"""Exact matching of many queries: blocks of documents meet blocks of queries, and no pair is moved or written.

A block holds the postings of some thousand documents, two bytes for each
token of a document, and is written once. Each block meets each block of
queries, where documents are bits and a token is a row of them: some hundred
queries at a time go through their tokens from the left and keep the documents
that hold them all. The first meeting counts the documents of each level of a
query, from which its last admitted level follows; the second makes the hits of
admitted levels and nothing else. A task takes several blocks of documents, each
of them once, and keeps its queries: it gives levels that are still open after
all its blocks, and of the best hits those that no earlier block has beaten.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.text import tokens
from gleaner.operators.match import Match
from gleaner.session import stored

# Documents and tokens of a block, and documents added to it at a time; tokens of a block of queries.
BLOCK_DOCS = 8192
BLOCK_TOKENS = 1 << 21
ADDED = 512
QUERY_TOKENS = 1 << 21
# Tokens of the queries of a task at least, if there are fewer tasks than the cores can share; tasks of each core else.
TASK_TOKENS = 1 << 16
TASKS = 4
# Hits given on at a time, postings turned into bits at a time, bytes of the bits of all tokens, and of those of some queries.
GIVEN = 1 << 17
ENTRIES = 1 << 18
BITS_BYTES = 96 << 20
STATE_BYTES = 1 << 21
# Best hits of a query whose sums are remembered from block to block.
REMEMBERED = 32
ONE = np.uint64(1)
# Position of a token that does not occur.
NOWHERE = 999


def hashed(words: Column) -> Column:
    return F.transform(words, lambda t: F.xxhash64(t))


def _listed(batch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and the lengths of its lists."""
    column = batch.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)


def _postings(values: np.ndarray, lengths: np.ndarray, places: bool) -> list[np.ndarray]:
    """Sorted tokens, how many documents hold each, these documents, and where it stands first in them."""
    doc = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
    order = np.argsort(values, kind="stable")
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    first = new.copy()
    first[1:] |= doc[1:] != doc[:-1]
    starts = np.flatnonzero(new[first])
    at = (order - np.repeat(np.cumsum(lengths) - lengths, lengths)[order])[first].astype(np.int32) if places else np.zeros(0, np.int32)
    held = doc[first]
    return [values[new], np.diff(np.append(starts, len(held))).astype(np.int32), held, at]


def blocks(docs: DataFrame, fields: tuple[str, ...], places: bool = False) -> DataFrame:
    """A row per block: its name, the ids in order, and per field the postings, and length and hash of each text.

    Written once, since it is read for every block of queries.
    """
    none = F.array().cast("array<string>")
    lists = [F.coalesce(tokens(F.col(f)), none).alias(f"t{i}") for i, f in enumerate(fields)]
    columns = [c for i in range(len(fields)) for c in (hashed(F.col(f"t{i}")).alias(f"f{i}"), F.xxhash64(f"t{i}").alias(f"h{i}"))]
    texts = docs.select(F.col("id").cast("string").alias("id"), *lists).select("id", *columns)
    parts = ("v", "c", "d", "p", "n", "h")
    shape = "block string, ids array<string>, " + ", ".join(f"{p}{i} binary" for i in range(len(fields)) for p in parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, kept, size = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            held = pa.Table.from_batches(kept)
            ids = held.column("id").to_pylist()
            order = sorted(range(len(ids)), key=lambda i: b"" if ids[i] is None else b"\1" + ids[i].encode())
            held = held.take(pa.array(order, pa.int64()))
            columns = {"block": pa.array([f"{part}:{made}"]), "ids": pa.array([[ids[i] for i in order]], pa.list_(pa.string()))}
            for i in range(len(fields)):
                values, lengths = _listed(held, f"f{i}")
                arrays = [*_postings(values.view(np.int64), lengths, places), lengths.astype(np.int32), held.column(f"h{i}").to_numpy()]
                columns |= {f"{p}{i}": pa.array([a.tobytes()], pa.binary()) for p, a in zip(parts, arrays)}
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        for batch in batches:
            for start in range(0, batch.num_rows, ADDED):
                kept.append(piece := batch.slice(start, ADDED))
                size += sum(len(_listed(piece, f"f{i}")[0]) for i in range(len(fields)))
                if size >= BLOCK_TOKENS or sum(x.num_rows for x in kept) + ADDED > BLOCK_DOCS:
                    yield block()
                    made, kept, size = made + 1, [], 0
                    pa.default_memory_pool().release_unused()
        if kept:
            yield block()

    return stored(texts.mapInArrow(run, shape), "blocks")


def query_blocks(asked: DataFrame, size: int, parts: int = 1) -> DataFrame:
    """A row per block of queries (query_id, hashes, query_hash, last): ids, distinct tokens, and the tokens as numbers.

    ``parts`` is the number of parts of the blocks they meet, for enough tasks.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    shares = min(-(-TASKS * cores // parts), -(-size // TASK_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            piece = pa.Table.from_batches(kept)
            values, n = _listed(piece, "hashes")
            distinct, codes = np.unique(values, return_inverse=True)
            whole, last = piece.column("query_hash").to_numpy(), piece.column("last").to_numpy()
            arrays = [distinct, codes.astype(np.int32), n.astype(np.int32), whole, last.astype(np.int32)]
            columns = [piece.column("query_id").to_pylist()], *[[a.tobytes()] for a in arrays]
            kinds = [pa.list_(pa.string())] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["queries", "distinct", "codes", "n", "whole", "last"])

        held = 0
        for batch in batches:
            _, lengths = _listed(batch, "hashes")
            ends, start = np.cumsum(lengths), 0
            while start < batch.num_rows:
                past = int(ends[start - 1]) if start else 0
                stop = max(start + (not kept), int(np.searchsorted(ends, past + QUERY_TOKENS - held, "right")))
                if stop > start:
                    kept.append(batch.slice(start, stop - start))
                    held += int(ends[stop - 1]) - past
                if stop < batch.num_rows:
                    yield block()
                    kept, held = [], 0
                start = stop
        if kept:
            yield block()

    few = asked.select("query_id", "hashes", "query_hash", "last").repartition(max(1, shares, -(-size // QUERY_TOKENS)))
    return stored(few.mapInArrow(run, "queries array<string>, distinct binary, codes binary, n binary, whole binary, last binary"), "queries")


class _Field:
    """Postings of one field of a block."""

    def __init__(self, row: dict, i: int):
        self.values, self.whole = np.frombuffer(row[f"v{i}"], np.int64), np.frombuffer(row[f"h{i}"], np.int64)
        self.counts, self.docs = np.frombuffer(row[f"c{i}"], np.int32), np.frombuffer(row[f"d{i}"], np.uint16)
        self.places, self.n = np.frombuffer(row[f"p{i}"], np.int32), np.frombuffer(row[f"n{i}"], np.int32)
        self.ends = np.cumsum(self.counts, dtype=np.int64)
        self.keys = None

    def find(self, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where sorted tokens stand in the vocabulary, and whether they do."""
        if not len(self.values):
            return np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        at = np.minimum(np.searchsorted(self.values, distinct), len(self.values) - 1)
        return at, self.values[at] == distinct

    def bits(self, at: np.ndarray, rows: np.ndarray, made: np.ndarray) -> None:
        """Sets the documents of the tokens at some places in their rows."""
        words, flat = made.shape[1], made.reshape(-1)
        ends, lengths = self.ends[at], self.counts[at].astype(np.int64)
        sums = np.cumsum(lengths)
        start = 0
        while start < len(at):
            past = int(sums[start] - lengths[start])
            stop = max(start + 1, int(np.searchsorted(sums, past + ENTRIES, "right")))
            few, piece = lengths[start:stop], slice(start, stop)
            docs = self.docs[np.arange(past, int(sums[stop - 1])) + np.repeat(ends[piece] - sums[piece], few)]
            word = np.repeat(rows[piece] * words, few) + (docs >> 6)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            flat[word[first]] = np.bitwise_or.reduceat(ONE << (docs & 63).astype(np.uint64), first)
            start = stop

    def place(self, at: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Where tokens, by their place in the vocabulary, stand first in documents that hold them."""
        if self.keys is None:
            self.keys = np.repeat(np.arange(len(self.values)) << 16, self.counts) | self.docs
        return self.places[np.searchsorted(self.keys, at << 16 | docs)]


class _Queries:
    """A block of queries; ``top`` are the largest sums given so far for each, where only the best are wanted."""

    def __init__(self, row: dict):
        number = lambda c, kind: np.frombuffer(row[c].as_buffer(), kind).copy()
        self.ids = row["queries"].values.take(pa.array(np.arange(len(row["queries"].values))))
        self.distinct, self.codes, self.whole = number("distinct", np.int64), number("codes", np.int32), number("whole", np.int64)
        self.n, self.last = number("n", np.int32).astype(np.int64), number("last", np.int32).astype(np.int64)
        self.starts = np.cumsum(self.n) - self.n
        self.top: np.ndarray | None = None
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []


class _Meeting:
    """Some queries of a block and the documents of a block, a bit each; ``held`` has a row of bits for each token, row 0 has none."""

    def __init__(self, block: list[_Field], asked: _Queries, found: list[tuple[np.ndarray, np.ndarray]], known: np.ndarray, queries: np.ndarray):
        self.block, self.asked, self.found, self.queries = block, asked, found, queries
        self.words = -(-len(block[0].n) // 64)
        self.row = np.zeros(len(known), np.int64)
        self.row[known] = np.arange(1, np.count_nonzero(known) + 1)
        self.fields = []
        for field, (at, there) in zip(block, found):
            wanted = there & known
            self.fields.append(made := np.zeros((np.count_nonzero(known) + 1, self.words), np.uint64))
            field.bits(at[wanted], self.row[wanted], made)
        self.held = self.fields[0] if len(block) == 1 else np.bitwise_or.reduce(self.fields)

    def _slots(self, queries: np.ndarray, slot: int | np.ndarray) -> np.ndarray:
        return self.asked.codes[self.asked.starts[queries] + slot]

    def _pieces(self, queries: np.ndarray) -> Iterator[np.ndarray]:
        step = max(1, STATE_BYTES // (8 * self.words))
        return (queries[k : k + step] for k in range(0, len(queries), step))

    def _longer(self, queries: np.ndarray, held: np.ndarray | None, slot: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the queries some document holds one more token for, and these documents."""
        rows = self.row[self._slots(queries, slot)]
        some = np.flatnonzero(rows)
        made = self.held[rows[some]]
        if held is not None:
            made &= held[some]
        left = np.bitwise_or.reduce(made, axis=1) != 0
        return (some, made) if left.all() else (some[left], made[left])

    def levels(self, threshold: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(queries, lead, how many documents hold so many leading tokens); up to a threshold of 1 the longest lead alone."""
        n = self.asked.n
        for left in self._pieces(self.queries):
            held, slot = None, 0
            while len(left):
                some, made = self._longer(left, held, slot)
                if slot and threshold <= 1:
                    ended = np.ones(len(left), bool)
                    ended[some] = False
                    if ended.any():
                        yield left[ended], slot, _counted(held[ended])
                left, held, slot = left[some], made, slot + 1
                open_, over = n[left] > slot, n[left] == slot
                if threshold > 1 and len(left):
                    yield left, slot, _counted(held)
                elif over.any():
                    yield left[over], slot, _counted(held[over])
                if over.any():
                    left, held = left[open_], held[open_]

    def holding(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, documents that hold all tokens up to their last level), some at a time."""
        last = self.asked.last
        for left in self._pieces(self.queries[(last[self.queries] > 0) & (last[self.queries] <= self.asked.n[self.queries])]):
            held, slot, which, sets = None, 0, [], []
            while len(left):
                some, held = self._longer(left, held, slot)
                left, slot = left[some], slot + 1
                done = last[left] == slot
                if done.any():
                    which.append(left[done])
                    sets.append(held[done])
                    left, held = left[~done], held[~done]
            if which:
                yield np.concatenate(which), np.concatenate(sets)

    def hits(self, queries: np.ndarray, held: np.ndarray, how: Match) -> Iterator[list[np.ndarray]]:
        """query, document, lead, and per field the tokens, whether there are any, equal texts and the first place."""
        early, single = how.ranking_tokens, len(self.block) == 1 and not how.prioritize_token_position
        # What is held in every document of a single field needs no counting.
        first = self.asked.last[queries] if single else np.zeros(len(queries), np.int64)
        order = np.argsort(first - self.asked.n[queries], kind="stable")
        queries, held, first = queries[order], held[order], first[order]
        ends, start = np.cumsum(_counted(held)), 0
        while start < len(queries):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + GIVEN, "right")))
            yield self._scored(queries[start:stop], held[start:stop], first[start:stop], early, how.prioritize_token_position)
            start = stop

    def _scored(self, queries: np.ndarray, held: np.ndarray, first: np.ndarray, early: int | None, places: bool) -> list[np.ndarray]:
        """The hits of queries in the order of how many tokens are left from the first on, most first."""
        at, word = np.nonzero(held)
        bit, doc = np.nonzero(np.unpackbits(held[at, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        at, doc = at[bit], word[bit] * 64 + doc
        each = np.bincount(at, minlength=len(queries))
        ends, n = np.cumsum(each), self.asked.n[queries]
        lead, going = first[at].astype(np.int32), np.ones(len(at), bool)
        sure = first if early is None else np.minimum(first, early)
        sums = [sure[at].astype(np.int32) for _ in self.fields]
        inside = [np.full(len(at), len(self.fields) == 1) for _ in self.fields]
        place = [np.full(len(at), NOWHERE, np.int32) for _ in self.fields]
        byte, mask = doc >> 3, np.left_shift(1, doc & 7).astype(np.uint8)
        flat = [made.reshape(-1).view(np.uint8) for made in self.fields]
        for slot in range(int((n - first).max())):
            left = int(np.searchsorted(first - n, -slot, "left"))
            codes, end = self._slots(queries[:left], first[:left] + slot), int(ends[left - 1])
            look = np.repeat(self.row[codes] * (8 * self.words), each[:left]) + byte[:end]
            there = [np.not_equal(made[look] & mask[:end], 0) for made in flat]
            if going is not None:
                going = going[:end] & (there[0] if len(there) == 1 else np.logical_or.reduce(there))
                lead[:end] += going
                going = going if going.any() else None
            counted = None if early is None else np.repeat(first[:left] + slot < early, each[:left])
            for i, found in enumerate(there):
                inside[i][:end] |= found
                found = found if counted is None else found & counted
                sums[i][:end] += found
                if places and found.any():
                    some = np.flatnonzero(found)
                    where = self.block[i].place(self.found[i][0][codes][at[some]], doc[some])
                    place[i][some] = np.minimum(place[i][some], where)
        out = [queries[at], doc, lead]
        for i, field in enumerate(self.block):
            same = (field.whole[doc] == self.asked.whole[queries][at]) & (field.n[doc] == n[at])
            out += [sums[i], inside[i].astype(np.int32), same] + [place[i]] * places
        return out


def _counted(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def _meetings(block: list[_Field], asked: _Queries) -> Iterator[_Meeting]:
    """All queries of a block, as many at a time as the bits of their tokens allow."""
    found = [field.find(asked.distinct) for field in block]
    known = np.logical_or.reduce([there for _, there in found])
    size = 8 * -(-len(block[0].n) // 64) * (len(block) + (len(block) > 1))
    open_ = [(0, len(asked.n))]
    while open_:
        start, stop = open_.pop()
        used = known
        if stop - start < len(asked.n):
            used = np.zeros(len(known), bool)
            used[asked.codes[asked.starts[start] : asked.starts[stop - 1] + asked.n[stop - 1]]] = True
            used &= known
        if np.count_nonzero(used) * size > BITS_BYTES and stop - start > 1:
            middle = (start + stop) // 2
            open_ += [(middle, stop), (start, middle)]
        else:
            yield _Meeting(block, asked, found, used, np.arange(start, stop))


def _best(asked: _Queries, hits: list[np.ndarray], best: int, exact: bool) -> list[np.ndarray]:
    """Of the hits, which stand by query and document, the first ones of each query; none that are behind those given before."""
    key = 2 * hits[3].astype(np.int64) + (hits[5] if exact else 0)
    query = hits[0]
    if 0 < best <= REMEMBERED:
        if asked.top is None:
            asked.top = np.full((len(asked.n), best), -1, np.int64)
        some = np.flatnonzero(key >= asked.top[query, 0])
        hits, key, query = [c[some] for c in hits], key[some], query[some]
    order = np.lexsort((hits[1], -key, query))
    query = query[order]
    new = np.flatnonzero(np.diff(query, prepend=-1))
    place = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
    kept = place < best
    order, place, query = order[kept], place[kept], query[kept]
    if 0 < best <= REMEMBERED:
        which = query[place == 0]
        now = np.full((len(which), best), -1, np.int64)
        now[np.cumsum(place == 0) - 1, place] = key[order]
        asked.top[which] = np.sort(np.hstack([asked.top[which], now]), axis=1)[:, best:]
    return [c[order] for c in hits]


def _met(made: DataFrame, asked: DataFrame, fields: int, visit, done, shape: str) -> DataFrame:
    """What ``visit`` gives for each block of documents and each block of queries, and ``done`` for each block of queries at the end.

    A task takes some blocks one after the other and keeps its queries. Pairs of
    blocks come in order, all queries after each documents; each is passed on once.
    """
    parts = made.rdd.getNumPartitions()
    few = made.coalesce(max(1, min(parts, TASKS * made.sparkSession.sparkContext.defaultParallelism)))
    nth = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    pairs = few.withColumn("_block", nth).hint("shuffle_replicate_nl").crossJoin(asked.withColumn("_queries", nth))
    once = lambda df, other: [F.when(F.col(other) == 0, F.col(c)).alias(c) for c in df.columns]
    passed = pairs.select("_block", "_queries", *once(made, "_queries"), *once(asked, "_block"))
    written, said = made.columns, asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[_Queries] = []
        block, ids = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                if row["_queries"].as_py() == 0:
                    block = [_Field({c: row[c].as_buffer() for c in written if c[-1].isdigit()}, i) for i in range(fields)]
                    ids = row["ids"].values
                if row["_block"].as_py() == 0:
                    queries.append(_Queries({c: row[c] for c in said}))
                yield from visit(block, ids, queries[row["_queries"].as_py()])
        row = batch = block = ids = None
        pa.default_memory_pool().release_unused()
        for each in queries:
            yield from done(each)

    return passed.mapInArrow(run, shape)


def _levels(made: DataFrame, asked: DataFrame, how: Match) -> DataFrame:
    """(query_id, lead, hits): the documents of each level that a task's stricter hits leave open."""
    threshold = how.drop_tokens_threshold

    def summed(parts: list[tuple[np.ndarray, np.ndarray]], sizes: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hits by query and lead, or sizes to be made hits, as far as they are open; longer leads come first."""
        keys, index = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        hits = np.bincount(index, np.concatenate([h for _, h in parts])).astype(np.int64)
        query = keys >> 32
        new = np.diff(query, prepend=-1) != 0
        if sizes:
            before = np.where(new, 0, np.append(0, hits[:-1]))
            hits = hits - before
        else:
            sums = np.cumsum(hits) - hits
            before = sums - sums[np.flatnonzero(new)][np.cumsum(new) - 1]
        open_ = (before < max(threshold, 1)) & (hits > 0)
        return keys[open_], hits[open_]

    def visit(block, ids, queries):
        found = []
        for meeting in _meetings(block, queries):
            for which, lead, size in meeting.levels(threshold):
                if not threshold:
                    which, size = which[whole := queries.n[which] == lead], size[whole]
                found.append((which << 32 | (1 << 31) - lead, size))
        if found:
            queries.levels.append(summed(found, True))
        if sum(len(k) for k, _ in queries.levels) > 4 * len(queries.n):
            queries.levels = [summed(queries.levels, False)]
        return ()

    def done(queries):
        if queries.levels:
            keys, hits = summed(queries.levels, False)
            lead = (1 << 31) - (keys & 0xFFFFFFFF)
            arrays = [queries.ids.take(pa.array(keys >> 32)), pa.array(lead.astype(np.int32)), pa.array(hits)]
            yield pa.RecordBatch.from_arrays(arrays, ["query_id", "lead", "hits"])

    rows = _met(made, asked, len(how.fields), visit, done, "query_id string, lead int, hits long")
    return rows.groupBy("query_id", "lead").agg(F.sum("hits").alias("hits"))


def _admitted(levels: DataFrame, threshold: int) -> DataFrame:
    """(query_id, last, found): the last level of each query that its stricter hits leave open, and its hits as far as there."""
    stricter = Window.partitionBy("query_id").orderBy(F.desc("lead")).rowsBetween(Window.unboundedPreceding, -1)
    before = levels.withColumn("before", F.coalesce(F.sum("hits").over(stricter), F.lit(0)))
    opened = before.filter(F.col("before") < max(threshold, 1))
    return opened.groupBy("query_id").agg(F.min("lead").alias("last"), F.sum("hits").alias("found"))


def in_page_order(how: Match) -> bool:
    """Whether the default order of hits follows from the number of tokens held and equal texts alone."""
    return len(how.fields) == 1 and not how.prioritize_token_position and int(how.weights.get(how.fields[0], 1)) > 0


def _hits(made: DataFrame, asked: DataFrame, how: Match, best: int | None) -> DataFrame:
    """The documents of each query from its last level on, or the best of them, with what their score needs."""
    fields = len(how.fields)
    names = ["tokens", "in", "same"] + ["pos"] * how.prioritize_token_position
    columns = [f"{name}_{i}" for i in range(fields) for name in names]
    kinds = [pa.bool_() if c.startswith("same") else pa.int32() for c in columns]
    shape = "query_id string, id string, n_tokens int, lead int, " + ", ".join(
        f"{c} {'boolean' if k == pa.bool_() else 'int'}" for c, k in zip(columns, kinds)
    )

    def visit(block, ids, queries):
        kept, rows = [], 0

        def given() -> pa.RecordBatch:
            which, docs, lead, *rest = (np.concatenate(c) for c in zip(*kept))
            arrays = [queries.ids.take(pa.array(which)), ids.take(pa.array(docs)), pa.array(queries.n[which].astype(np.int32))]
            arrays += [pa.array(c, k) for c, k in zip([lead, *rest], [pa.int32(), *kinds])]
            return pa.RecordBatch.from_arrays(arrays, ["query_id", "id", "n_tokens", "lead", *columns])

        for meeting in _meetings(block, queries):
            for which, held in meeting.holding():
                for hits in meeting.hits(which, held, how):
                    kept.append(hits if best is None else _best(queries, hits, best, how.prioritize_exact_match))
                    rows += len(kept[-1][0])
                    if rows >= GIVEN:
                        yield given()
                        kept, rows = [], 0
        if rows:
            yield given()

    return _met(made, asked, fields, visit, lambda queries: (), shape)


def match_blocks(docs: DataFrame, asked: DataFrame, size: int, how: Match, best: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Hits of all queries (query_id, hashes, query_hash; ``size`` tokens in all), and (query_id, found), their numbers.

    With ``best`` the hits hold at least that many first ones of each query in
    the default order, if that order can be told in a block; the numbers are
    those of all hits. The blocks and the levels are made while the plan is built.
    """
    made = blocks(docs, how.fields, how.prioritize_token_position)
    parts = made.rdd.getNumPartitions()
    levels = _levels(made, query_blocks(asked.withColumn("last", F.lit(0)), size, parts), how)
    last = stored(_admitted(levels, how.drop_tokens_threshold), "last")
    opened = query_blocks(asked.join(last.select("query_id", "last"), "query_id"), size, parts)
    return _hits(made, opened, how, best if in_page_order(how) else None), last.select("query_id", "found")
