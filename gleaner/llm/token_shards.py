"""Token sequences in training order, as fixed-stride binary shards.

Texts become token identifiers of two bytes, one stream per task, cut into
sequences of equal length. A keyed Feistel permutation over all sequences
gives each its slot in the training order; shards hold consecutive slots, so a
reader that stopped at slot s goes on in shard s div rows at byte
(s mod rows) * stride. A record is a sequence closed by the end token, which
the writer puts there as its line separator.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked
from gleaner.llm.bpe import SPACE
from gleaner.llm.words import mixed

# Tokens of a record, its end token included; records of a shard; the order's key.
LENGTH, SHARD_ROWS, KEY = 2048, 4096, 0x5EED
# The free identifier of the vocabulary, two bytes, low one first.
END = 50256
END_BYTES = END.to_bytes(2, "little")
ROUNDS = 6
# Pieces of text whose tokens a task remembers, and the longest worth it.
REMEMBERED, LONGEST = 300_000, 40


class Encoder:
    """Identifiers of texts as bytes, by a rank file and its split pattern.

    Texts are first cut where the split pattern always cuts: between white
    space and what follows, but for one blank in front of a word. The pieces
    repeat, so their tokens are remembered.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        # White space that stands before a word is the word's or alone, so words can be tried first.
        self.pieces = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
        self.known = _Known(encode)

    def text(self, text: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.pieces.findall(text)))


class _Known(dict):
    """Tokens of pieces; what is missing is encoded, and remembered if that is worth it."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        found = np.array(self.encode(piece), dtype="<u2").tobytes()
        if len(piece) <= LONGEST and len(self) < REMEMBERED:
            self[piece] = found
        return found


def sequences(docs: DataFrame, path: str, pattern: str, length: int = LENGTH, text: str = "text") -> DataFrame:
    """part, at, n_tokens, data: the stream of each task in pieces of ``length - 1`` tokens.

    Every text with tokens is followed by an end token; null and empty texts
    give nothing. The last sequence of a task is filled up with end tokens,
    which ``n_tokens`` does not count. Texts of any length are encoded whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = Encoder(path, pattern), 2 * (length - 1)
        part, at, rest = TaskContext.get().partitionId(), 0, bytearray()

        def rows(pieces: list[bytes], counts: list[int]) -> pa.RecordBatch:
            numbers = pa.array(range(at, at + len(pieces)), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(pieces), pa.int32()), numbers, pa.array(counts, pa.int32()), pa.array(pieces, pa.binary())],
                ["part", "at", "n_tokens", "data"],
            )

        for batch in batches:
            for value in batch.column("text"):
                if said := value.as_py():
                    rest += encoder.text(said) + END_BYTES
                whole = len(rest) // size
                if whole >= 256:
                    cut = bytes(rest[: whole * size])
                    yield rows([cut[i * size : (i + 1) * size] for i in range(whole)], [length - 1] * whole)
                    at, rest = at + whole, rest[whole * size :]
        left = bytes(rest)
        pieces = [left[i : i + size] for i in range(0, len(left), size)]
        if pieces:
            counts = [len(p) // 2 for p in pieces]
            yield rows([p + END_BYTES * ((size - len(p)) // 2) for p in pieces], counts)

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "part int, at long, n_tokens int, data binary")


def permuted(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of 0 .. count - 1, applied to an array of numbers.

    A Feistel network permutes the smallest square of two powers of two that
    holds the numbers; what falls outside is permuted again until it is inside.
    """
    half = max(1, -(-max(1, count - 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for turn in range(ROUNDS):
            salt = np.uint64((key * ROUNDS + turn + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
            left, right = right, left ^ (mixed(right + salt) & mask)
        return (left << np.uint64(half)) | right

    out = once(numbers.astype(np.uint64))
    outside = np.flatnonzero(out >= count)
    while len(outside):
        out[outside] = once(out[outside])
        outside = outside[out[outside] >= count]
    return out.astype(np.int64)


def _slots(numbers: pd.Series, count: int, key: int) -> pd.Series:
    return pd.Series(permuted(numbers.to_numpy(np.int64), count, key))


def write_shards(
    docs: DataFrame, folder: str, path: str, pattern: str, length: int = LENGTH, shard_rows: int = SHARD_ROWS, key: int = KEY,
    text: str = "text",
) -> int:
    """Write the shards ``folder/shard=N`` and return the number of sequences.

    Sequences are numbered by task and place, from counts per task, and moved
    once, to the range of slots that writes them. They are kept, in memory as
    far as it goes, between counting and writing, and made again if lost.
    Repeated rows are tokens like others; an empty table writes no shard.
    """
    made = sequences(docs, path, pattern, length, text).persist(StorageLevel.MEMORY_AND_DISK)
    counts = made.groupBy("part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    total = int(starts.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0])
    slot_of = partial(_slots, count=total, key=key)

    def slots(numbers: pd.Series) -> pd.Series:
        return slot_of(numbers)

    slots.__annotations__ = {"numbers": pd.Series, "return": pd.Series}
    shards = max(1, -(-total // shard_rows))
    starts, _ = broadcast_checked(starts.select("part", "_start"))  # a row per task
    placed = (
        made.join(starts, "part")
        .withColumn("slot", F.pandas_udf(slots, "long")(F.col("_start") + F.col("at")))
        .withColumn("shard", F.expr(f"slot div {shard_rows}"))
        .select("shard", "slot", "data")
    )
    (
        placed.repartitionByRange(shards, "shard")
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("data").cast("string").alias("value"))
        .write.partitionBy("shard")
        .option("encoding", "ISO-8859-1")
        .text(folder, lineSep=END_BYTES.decode("latin-1"))
    )
    made.unpersist()
    starts.unpersist()
    return total


RECORDS = "slot long, shard long, byte_offset long, n_tokens long, n_ends long, record_sha256 string"


def read_shards(spark: SparkSession, folder: str, first_slot: int = 0, length: int = LENGTH, shard_rows: int = SHARD_ROWS,
                with_tokens: bool = False) -> DataFrame:
    """The records of all shards from a slot on, a row each: ``RECORDS``, and the tokens if wanted.

    Only shards that hold wanted slots are opened. ``n_tokens`` counts the
    tokens other than ends, ``n_ends`` the ends. A shard whose size is not a
    whole number of records is an error, as is one in several files.
    """
    stride = 2 * length
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
        .withColumn("shard", F.regexp_extract("path", r"shard=(\d+)", 1).cast("long"))
        .filter(F.col("shard") >= first_slot // shard_rows)
        .select("shard", "content")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                if len(data) % stride:
                    raise ValueError(f"shard {shard} ends inside a record")
                rows = []
                for row in range(max(0, first_slot - shard * shard_rows), len(data) // stride):
                    record = data.slice(row * stride, stride).to_pybytes()
                    ends = int(np.count_nonzero(np.frombuffer(record, dtype="<u2") == END))
                    rows.append((shard * shard_rows + row, shard, row * stride, length - ends, ends, hashlib.sha256(record).hexdigest(), record))
                columns = list(zip(*rows))[: 7 if with_tokens else 6] if rows else []
                if columns:
                    kinds = [pa.int64()] * 5 + [pa.string(), pa.binary()]
                    names = ["slot", "shard", "byte_offset", "n_tokens", "n_ends", "record_sha256", "tokens"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names[: len(columns)])

    return files.mapInArrow(run, RECORDS + (", tokens binary" if with_tokens else ""))
