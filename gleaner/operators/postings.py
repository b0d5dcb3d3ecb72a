"""Token occurrences of a collection, and the stored index made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.functions.text import tokens
from gleaner.operators.schema import Collection, Field


def field_tokens(field: Field | str):
    if isinstance(field, str):
        return tokens(F.col(field))
    return tokens(F.col(field.name), field.token_separators, field.symbols_to_index)


def _tokenized(docs: DataFrame, fields: list[Field | str], id_column: str) -> DataFrame:
    """(id, field, tokens, field_length, field_hash): one row per indexed text, all fields from one scan.

    Length and hash are taken here, once per text and not once per token.
    """
    per_field = [
        F.struct(
            F.lit(f if isinstance(f, str) else f.name).alias("field"),
            field_tokens(f).alias("tokens"),
        )
        for f in fields
        if isinstance(f, str) or f.index
    ]
    listed = docs.select(F.col(id_column).cast("string").alias("id"), F.inline(F.array(*per_field)))
    return listed.withColumns({"field_length": F.size("tokens"), "field_hash": F.xxhash64("tokens")})


def occurrences(docs: DataFrame, fields: list[Field | str], id_column: str = "id") -> DataFrame:
    """(id, field, token, pos, field_length, field_hash), one row per token occurrence.

    Exploded where the text lies: no shuffle.
    """
    texts = _tokenized(docs, fields, id_column)
    return texts.select("id", "field", "field_length", "field_hash", F.posexplode("tokens").alias("pos", "token"))


def postings(docs: DataFrame, fields: list[Field | str], id_column: str = "id") -> DataFrame:
    """Like ``occurrences`` with the first position per token of a text only.

    Repeated words go before anything is joined, inside the row of their
    text: sorted by word, a word is kept where the one before it differs.
    """
    texts = _tokenized(docs, fields, id_column)
    placed = F.transform("tokens", lambda t, i: F.struct(t.alias("token"), i.alias("pos")))
    ordered = texts.withColumn("placed", F.sort_array(placed))
    shifted = F.concat(F.array(F.struct(F.lit("").alias("token"), F.lit(-1).alias("pos"))), F.col("placed"))
    first = F.zip_with("placed", shifted, lambda x, before: F.when(x["token"] != before["token"], x))
    kept = ordered.withColumn("first", F.array_compact(first))
    # The outer form: for the inner one Spark derives a filter on the size of the
    # list and would sort every text a second time to evaluate it.
    return kept.select("id", "field", "field_length", "field_hash", F.inline_outer("first")).filter(
        F.col("token").isNotNull()
    )


def index(docs: DataFrame, collection: Collection, id_column: str = "id") -> DataFrame:
    """The postings of a collection, laid out to be stored.

    Spread by range over (token, id): a token that occurs in a third of all
    documents fills several ranges, and the row groups of a written index can
    be skipped by token.
    """
    texts = [f for f in collection.fields if f.type in ("string", "string[]")]
    return postings(docs, texts, id_column).repartitionByRange("token", "id").sortWithinPartitions("token", "id")


def vocabulary(postings: DataFrame) -> DataFrame:
    """Distinct (field, token): all inexact matching works on this, never on documents."""
    return postings.select("field", "token").distinct()
