"""Vectors computed from text fields; models are plug-ins by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import tokens

Embedder = Callable[[DataFrame, str, str], DataFrame]


def hashed_words(dimensions: int = 256) -> Embedder:
    """Built-in model: word counts hashed to a fixed number of dimensions, unit length."""

    def embed(rows: DataFrame, text: str, out: str) -> DataFrame:
        worded = rows.withColumn("_words", tokens(F.col(text)))
        counted = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions).transform(worded)
        scaled = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0).transform(counted)
        return scaled.withColumn(out, vector_to_array("_unit", "float32")).drop("_words", "_counts", "_unit")

    return embed


def from_column(make: Callable[[Column], Column]) -> Embedder:
    """A model given as a column function, for example a pandas UDF returning array<float>."""
    return lambda rows, text, out: rows.withColumn(out, make(F.col(text)))


EMBEDDERS: dict[str, Embedder] = {"hashed-words": hashed_words()}


def auto_embed(rows: DataFrame, sources: list[str], model: str = "hashed-words", out: str = "embedding") -> DataFrame:
    """Vector of the joined source fields, by the same model for documents and queries."""
    joined = rows.withColumn("_text", F.concat_ws(" ", *sources))
    return EMBEDDERS[model](joined, "_text", out).drop("_text")
