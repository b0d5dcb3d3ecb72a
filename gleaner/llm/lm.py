"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of adjacent pairs are quantised to the levels
``1 + floor(log2 count)``. An n-gram of level q is put into the filter q times,
once with each level; its level is read by probing 1, 2, ... until a probe
fails. A failing filter only ever reads a level too high. The filter grows with
what is put into it. Up to a bound it is broadcast; beyond, its segments are a
table, and the n-grams of the texts are dealt to them. Scores mix the quantised
pair and word counts.
A baseline on exact word counts is kept beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.native import stored
from gleaner.llm.words import WordHasher, mixed

_U = np.uint64
# Folds of the documents by the checksum of their key; this one is not learnt from.
FOLDS, HELD_OUT = 10, 0
ADDED = 0.1
PAIR_WEIGHT = 0.4
# The filter has 8 bits per level put into it, rounded to a power of two. Up to 2**29 bits (64 MB) are broadcast.
BITS_PER_GRAM, MOST_BITS = 8, 1 << 29
# There are 2**10 segments, and more where they would be larger than 2**19 bits (64 KB).
SEGMENT_BITS, LARGEST_SEGMENT = 10, 19
# Words whose exact counts every task knows (12 bytes each); others are joined.
KNOWN_WORDS = 1 << 18
# Tokens counted together in a task before they are handed on.
TOGETHER = 2_000_000
_MOST_LEVELS = 48
# Tokens whose n-grams are probed together.
PROBED = 200_000
# Bytes of text whose n-grams are sent to the segments together, when the filter is a table.
BLOCK_BYTES = 1 << 20
BEGIN, END = _U(0x5BD1E995A1B2C3D5), _U(0x1B873593CC9E2D51)
_LEFT, _RIGHT, _LEVEL = _U(0x9FB21C651E98DF25), _U(0xD8B4D6A3F1C9E7AB), _U(0xA24BAED4963EE407)


def held_out(key: Column) -> Column:
    """A null key counts as an empty text, which is held out."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD_OUT


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Hashes of each token together with the one before it."""
    before = np.concatenate([np.array([BEGIN], dtype=_U), tokens[:-1]])
    return mixed(before * _LEFT + tokens * _RIGHT)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts)).astype(np.int64) + 1


def count_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that have a level; 0 for level 0."""
    return np.where(levels > 0, 1.5 * 2.0 ** (levels - 1) - 0.5, 0.0)


@dataclass(frozen=True)
class Filter:
    """Segments of equal size; an n-gram lies in the segment its first bits name."""

    segment_bytes: int
    hashes: int
    segment_bits: int = SEGMENT_BITS

    def segments(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> _U(64 - self.segment_bits)).astype(np.int64)

    def places(self, grams: np.ndarray, level: int, probe: int) -> np.ndarray:
        bits = self.segment_bytes * 8
        step = _U((level * 64 + probe) * int(_LEVEL) % (1 << 64))
        return (mixed(grams + step) & _U(bits - 1)).astype(np.int64)

    def put(self, segment: np.ndarray, grams: np.ndarray, levels: np.ndarray) -> None:
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = grams[levels >= level]
            for probe in range(self.hashes):
                at = self.places(some, level, probe)
                np.bitwise_or.at(segment, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def levels(self, data: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The levels read from the whole filter's bytes."""
        return self._read(data, grams, self.segments(grams) * self.segment_bytes)

    def levels_in(self, segment: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The levels of n-grams of one segment, read from its bytes."""
        return self._read(segment, grams, np.zeros(len(grams), dtype=np.int64))

    def _read(self, data: np.ndarray, grams: np.ndarray, start: np.ndarray) -> np.ndarray:
        found = np.zeros(len(grams), dtype=np.int64)
        left = np.arange(len(grams))
        for level in range(1, _MOST_LEVELS):
            for probe in range(self.hashes):
                at = self.places(grams[left], level, probe)
                left = left[(data[start[left] + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
            found[left] = level
        return found


def _texts(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


def _grams(docs: DataFrame, pairs: bool) -> DataFrame:
    """gram and n: tokens (or also pairs) of the texts, counted within parts of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, parts, size = WordHasher(), [], 0

        def counted():
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])

        for batch in batches:
            for words in hasher.texts(batch.column("text").to_pylist()):
                tokens = np.append(words, END)
                parts.append(tokens)
                if pairs:
                    parts += [pairs_of(tokens), np.array([BEGIN], dtype=_U)]
                size += len(tokens)
                if size > TOGETHER:
                    yield counted()
                    parts, size = [], 0
        if parts:
            yield counted()

    return _texts(docs).mapInArrow(run, "gram long, n long")


@dataclass(frozen=True)
class Model:
    """What scoring needs: the filter, exact counts of the most common words, and totals.

    The filter is either ``data``, all its bytes broadcast, or ``table`` with a row per segment.
    """

    shape: Filter
    data: object
    table: DataFrame | None
    words: DataFrame
    known: object
    tokens: int
    distinct: int


def shape_for(inserted: int) -> Filter:
    """The filter for so many n-grams and levels: of the powers of two the nearest to 8 bits for each."""
    bits = max(SEGMENT_BITS + 6, round(float(np.log2(max(1, BITS_PER_GRAM * inserted)))))
    segment_bits = max(SEGMENT_BITS, bits - LARGEST_SEGMENT)
    hashes = int(min(6, max(1, round(0.69 * (1 << bits) / max(1, inserted)))))
    return Filter(1 << (bits - segment_bits - 3), hashes, segment_bits)


def _by_segment(shape: Filter, grams: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The segments of n-grams, and where their n-grams are."""
    own = shape.segments(grams)
    order = np.argsort(own, kind="stable")
    cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
    for start, end in zip(cuts, [*cuts[1:], len(order)]):
        yield int(own[order[start]]), order[start:end]


def _segment_row(number: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data.tobytes()], pa.binary())], ["segment", "data"])


def _segment(shape: Filter) -> Column:
    return F.shiftrightunsigned("gram", 64 - shape.segment_bits)


def _whole(counted: DataFrame, shape: Filter) -> np.ndarray:
    """All bytes of the filter. Tasks write their shares of segments; here they are read one by one and put together."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            grams = batch.column("gram").to_numpy(zero_copy_only=False).view(_U)
            levels = batch.column("level").to_numpy(zero_copy_only=False)
            for number, rows in _by_segment(shape, grams):
                data = made.setdefault(number, np.zeros(shape.segment_bytes, dtype=np.uint8))
                shape.put(data, grams[rows], levels[rows])
        for number, data in made.items():
            yield _segment_row(number, data)

    whole = np.zeros(shape.segment_bytes << shape.segment_bits, dtype=np.uint8)
    for row in stored(counted.mapInArrow(build, "segment long, data binary"), "filter").toLocalIterator():
        start = row["segment"] * shape.segment_bytes
        whole[start : start + shape.segment_bytes] |= np.frombuffer(row["data"], dtype=np.uint8)
    return whole


def _segments(counted: DataFrame, shape: Filter) -> DataFrame:
    """segment, data: a row for each segment that has any n-gram. A task holds one segment at a time."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, data = -1, None
        for batch in batches:
            grams = batch.column("gram").to_numpy(zero_copy_only=False).view(_U)
            levels = batch.column("level").to_numpy(zero_copy_only=False)
            for number, rows in _by_segment(shape, grams):
                if number != current:
                    if data is not None:
                        yield _segment_row(current, data)
                    current, data = number, np.zeros(shape.segment_bytes, dtype=np.uint8)
                shape.put(data, grams[rows], levels[rows])
        if data is not None:
            yield _segment_row(current, data)

    dealt = counted.withColumn("segment", _segment(shape)).repartition("segment").sortWithinPartitions("segment")
    return dealt.select("gram", "level").mapInArrow(build, "segment long, data binary")


def train(docs: DataFrame, most_bits: int = MOST_BITS) -> Model:
    """Learn from all texts of ``docs`` (column ``text``).

    Word counts are exact and are written to the shared folder, and so are the
    levels of all n-grams, whose sum gives the size of the filter. It holds
    words and pairs of all counts at every size. A filter of up to
    ``most_bits`` passes the driver on its way to the tasks; a larger one is
    written segment by segment, each made by one task. Both read alike.
    """
    spark = docs.sparkSession
    words = stored(_grams(docs, False).groupBy(F.col("gram").alias("word")).agg(F.sum("n").alias("n")), "words")
    facts = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = int(facts[0]), int(facts[1])

    # No finer than segments, so that the tasks below make few segments each; more parts only for more n-grams.
    dealt = max(SEGMENT_BITS, (BITS_PER_GRAM * (tokens + distinct)).bit_length() - LARGEST_SEGMENT - 2)
    counted = stored(
        _grams(docs, True)
        .withColumn("part", F.shiftrightunsigned("gram", 64 - dealt))
        .repartition("part")
        .groupBy("part", "gram")
        .agg(F.sum("n").alias("n"))
        .select("gram", (F.floor(F.log2("n")).cast("int") + 1).alias("level")),
        "levels",
    )
    shape = shape_for(int(counted.agg(F.coalesce(F.sum("level"), F.lit(0))).first()[0]))
    if shape.segment_bytes << shape.segment_bits + 3 <= most_bits:
        data, segments = spark.sparkContext.broadcast(_whole(counted, shape)), None
    else:
        data, segments = None, stored(_segments(counted, shape), "filter")

    octave = F.floor(2 * F.log2("n")).cast("int")
    sizes = {r["o"]: r["count"] for r in words.groupBy(octave.alias("o")).count().collect()}
    bar = 0
    while sum(c for o, c in sizes.items() if o >= bar) > KNOWN_WORDS:
        bar += 1
    common = words.filter(octave >= bar).toPandas()
    names, counts = common["word"].to_numpy(np.int64).view(_U), common["n"].to_numpy(np.int64)
    order = np.argsort(names)
    sc = spark.sparkContext
    return Model(
        shape, data, segments, words.filter(octave < bar), sc.broadcast((names[order], counts[order])), tokens, distinct
    )


_SUMS = ["n_tokens", "score", "base", "known"]


class _Scorer:
    """Sums over texts, with the common words of a model at hand; columns _SUMS."""

    def __init__(self, model_floor: float, known):
        self.floor = model_floor
        self.names, counts = known.value
        self.logs = np.log10((counts + ADDED) / model_floor)
        self.columns: tuple[list, ...] = ([], [], [], [])

    def add(self, group: list[np.ndarray], levels) -> None:
        """The texts' tokens; ``levels`` reads the levels of n-grams."""
        if not group:
            return
        lengths = np.array([len(t) for t in group])
        cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        begin = count_of(levels(np.array([BEGIN], dtype=_U)))[0]
        unique, where = np.unique(np.concatenate(group), return_inverse=True)
        single = count_of(levels(unique))[where]
        before = np.concatenate([[begin], single[:-1]])
        before[cuts] = begin
        pair = count_of(levels(np.concatenate([pairs_of(t) for t in group])))
        alone = (single + ADDED) / self.floor
        ratio = np.minimum(1.0, pair / np.maximum(before, 1.0))
        mix = np.where(before > 0, PAIR_WEIGHT * ratio + (1 - PAIR_WEIGHT) * alone, alone)
        hit, at = _looked_up(self.names, unique)
        log = np.zeros(len(unique))
        log[hit] = self.logs[at[hit]]
        sums = (
            lengths, np.add.reduceat(np.log10(mix), cuts), np.add.reduceat(log[where], cuts),
            np.add.reduceat(hit[where].astype(np.int64), cuts),
        )
        for column, values in zip(self.columns, sums):
            column.extend(values.tolist())

    def taken(self) -> list[pa.Array]:
        kinds = (pa.int64(), pa.float64(), pa.float64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(self.columns, kinds)]
        self.columns = ([], [], [], [])
        return arrays


def _groups(hasher: WordHasher, texts: list[bytes | None]) -> Iterator[list[np.ndarray]]:
    """The tokens of the texts, as many texts at a time as are probed together."""
    group, gathered = [], 0
    for words in hasher.texts(texts):
        group.append(np.append(words, END))
        gathered += len(words) + 1
        if gathered >= PROBED:
            yield group
            group, gathered = [], 0
    yield group


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, digest, n_tokens, score, and base and known as far as the common words go."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, digest long, n_tokens long, score double, base double, known long"
    if model.table is not None:
        return _scored_by_segment(docs, model, schema)
    shape, data, known = model.shape, model.data, model.known
    floor = model.tokens + ADDED * (model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = data.value
        hasher, scorer = WordHasher(), _Scorer(floor, known)
        for batch in batches:
            for group in _groups(hasher, batch.column("text").to_pylist()):
                scorer.add(group, lambda grams: shape.levels(bits, grams))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), *scorer.taken()], ["doc_id", "digest", *_SUMS])

    return _texts(docs, "doc_id", "digest").mapInArrow(run, schema)


def _blocks(docs: DataFrame) -> DataFrame:
    """The texts with the number of their block: about BLOCK_BYTES of texts that follow each other, or one longer text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for text in batch.column("text"):
                # A row without text takes some room too.
                room = 64 + (text.as_buffer().size if text.is_valid else 0)
                if size and size + room > BLOCK_BYTES:
                    block, size = block + 1, 0
                size += room
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "block"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(_texts(docs, "doc_id", "digest").mapInArrow(run, f"doc_id {kind}, digest long, text binary, block long"), "blocks")


def _asked(blocks: DataFrame) -> DataFrame:
    """block, gram: what a block needs to know the levels of, each n-gram once for all texts read together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for number, rows in _runs(batch.column("block").to_numpy(zero_copy_only=False)):
                for group in _groups(hasher, batch.column("text").slice(rows.start, len(rows)).to_pylist()):
                    parts = [np.array([BEGIN], dtype=_U), *group, *[pairs_of(t) for t in group]]
                    grams = np.unique(np.concatenate(parts)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), number)), pa.array(grams)], ["block", "gram"])

    return blocks.select("block", "text").mapInArrow(run, "block long, gram long")


def _runs(values: np.ndarray) -> Iterator[tuple[int, range]]:
    """Equal values that follow each other, and where they are."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1), len(values)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        if end > start:
            yield int(values[start]), range(start, end)


def _scored_by_segment(docs: DataFrame, model: Model, schema: str) -> DataFrame:
    """The same scores from a filter that is a table.

    The n-grams of a block of texts go to the segments, which pass a task one
    at a time, and their levels come back to the block. A block asks for an
    n-gram once, so a frequent one costs a row per block, and no key's rows
    are held together but those of a block.
    """
    shape, known = model.shape, model.known
    floor = model.tokens + ADDED * (model.distinct + 1)
    blocks = _blocks(docs)
    asked = _asked(blocks).select(_segment(shape).alias("segment"), "block", "gram", F.lit(None).cast("binary").alias("data"))
    none = F.lit(None).cast("long")
    rows = model.table.select("segment", none.alias("block"), none.alias("gram"), "data").unionByName(asked)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bits = -1, None
        for batch in batches:
            block, gram, data = batch.column("block"), batch.column("gram"), batch.column("data")
            for number, own in _runs(batch.column("segment").to_numpy(zero_copy_only=False)):
                start, size = own.start, len(own)
                if number != current:
                    # A segment without any n-gram has no row.
                    current, bits = number, np.zeros(shape.segment_bytes, dtype=np.uint8)
                if data[start].is_valid:
                    bits = np.frombuffer(data[start].as_py(), dtype=np.uint8)
                    start, size = start + 1, size - 1
                if size:
                    grams = gram.slice(start, size)
                    levels = shape.levels_in(bits, grams.to_numpy(zero_copy_only=False).astype(np.int64).view(_U))
                    yield pa.RecordBatch.from_arrays([block.slice(start, size), grams, pa.array(levels.astype(np.int32))], ["block", "gram", "level"])

    sorted_rows = rows.repartition("segment").sortWithinPartitions("segment", F.col("block").asc_nulls_first())
    levels = sorted_rows.mapInArrow(probe, "block long, gram long, level int")

    def run(texts: pa.Table, read: pa.Table) -> pa.Table:
        grams = read.column("gram").to_numpy().view(_U)
        order = np.argsort(grams)
        grams, found = grams[order], read.column("level").to_numpy()[order].astype(np.int64)
        scorer = _Scorer(floor, known)
        for group in _groups(WordHasher(), texts.column("text").to_pylist()):
            scorer.add(group, lambda wanted: found[np.searchsorted(grams, wanted)])
        return pa.Table.from_arrays([texts.column("doc_id"), texts.column("digest"), *scorer.taken()], ["doc_id", "digest", *_SUMS])

    return blocks.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(run, schema)


def _looked_up(names: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words are among the sorted names, and where."""
    if not len(names):
        return np.zeros(len(words), dtype=bool), np.zeros(len(words), dtype=np.int64)
    at = np.minimum(np.searchsorted(names, words), len(names) - 1)
    return names[at] == words, at


def _rare_words(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, digest, word, times for the words that are not common, and a row without a word per document."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = model.known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        names, _ = known.value
        for batch in batches:
            rows, words, times = [], [], []
            for row, found in enumerate(hasher.texts(batch.column("text").to_pylist())):
                unique, n = np.unique(np.append(found, END), return_counts=True)
                rare = ~_looked_up(names, unique)[0]
                rows.append(np.full(int(rare.sum()), row))
                words.append(unique[rare])
                times.append(n[rare])
            at = pa.array(np.concatenate([np.arange(batch.num_rows), *rows]).astype(np.int64))
            named = np.concatenate(words).view(np.int64)
            word = pa.concat_arrays([pa.nulls(batch.num_rows, pa.int64()), pa.array(named)])
            count = pa.array(np.concatenate([np.ones(batch.num_rows), *times]).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(at), batch.column("digest").take(at), word, count], ["doc_id", "digest", "word", "times"]
            )

    return _texts(docs, "doc_id", "digest").mapInArrow(run, f"doc_id {kind}, digest long, word long, times long")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words with A-Z folded and one end. ``base_score`` sums
    log10((c + 0.1) / (N + 0.1 (V + 1))) with exact counts of the training
    texts, ``score`` is the model's log10 probability. Null and empty texts
    have one token, their end. Repeated rows score alike: what a repeated key
    and text collect in the join is divided by its number of rows. A model
    learnt from nothing scores every token alike.
    """
    docs = docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("digest"), F.col(text).alias("text"))
    floor = F.lit(model.tokens + ADDED * (model.distinct + 1))
    rare = _rare_words(docs, model).join(model.words, "word", "left")
    named, c = F.col("word").isNotNull(), F.coalesce("n", F.lit(0))
    sums = rare.groupBy(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest")).agg(
        F.sum(F.when(named, F.col("times") * F.log10((c + ADDED) / floor)).otherwise(0.0)).alias("_base"),
        F.sum(F.when(named & (c > 0), F.col("times")).otherwise(0)).alias("_known"),
        F.count(F.when(~named, 1)).alias("_rows"),
    )
    joined = _scored(docs, model).join(sums, (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc")))
    return joined.select(
        F.col("doc_id").alias(key),
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.col("_known") / F.col("_rows")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("_base") / F.col("_rows")).alias("base_score"),
        "score",
    )


def train_and_score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from all documents but the held-out fold, and score every one."""
    training = docs.filter(~held_out(F.col(key))).select(F.col(text).alias("text"))
    return score(docs, train(training), key, text)
