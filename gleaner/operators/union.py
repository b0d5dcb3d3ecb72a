"""Several searches at once: presets, shared parameters, merged and deduplicated lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import best_per_key, ordinals, top_n
from gleaner.functions.text import tokens
from gleaner.operators import near


def with_presets(requests: DataFrame, presets: DataFrame, params: list[str], common: dict | None = None,
                 defaults: dict | None = None) -> DataFrame:
    """Parameters per request: its own value, else the preset's, else the common one, else the default.

    ``presets`` holds (name, *params), one row per preset.
    """
    common, defaults = common or {}, defaults or {}
    renamed = presets.withColumnsRenamed({p: f"_preset_{p}" for p in presets.columns if p != "name"})
    joined = requests.join(renamed, requests["preset"] == renamed["name"], "left")
    values = []
    for p in params:
        options = [F.col(c) for c in (p, f"_preset_{p}") if c in joined.columns]
        options += [F.lit(d[p]) for d in (common, defaults) if d.get(p) is not None]
        values.append(F.coalesce(*options).alias(p))
    return joined.select("query_id", *values)


def merge(parts: dict[str, DataFrame]) -> DataFrame:
    """Hits of several collections in one list; each carries its ``_collection``."""
    marked = [hits.withColumn("_collection", F.lit(name)) for name, hits in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def normal_text(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


def fingerprint(text: Column) -> Column:
    """Equal for texts with the same words in the same order; taken where the text is read."""
    return F.md5(normal_text(text))


def drop_copies(hits: DataFrame, order: list[Column], by: str = "fingerprint") -> DataFrame:
    """Of hits with the same fingerprint keep the best ranked."""
    return best_per_key(hits, ["query_id", by], order)


def drop_near_copies(
    hits: DataFrame, text: str, order: list[Column], wanted: int | None = None, similarity: float = 0.8, window: int | None = None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """All hits per query, or the best ``wanted``, of which none is nearly the same as a better one.

    A hit goes when it shares enough word 3-shingles (Jaccard, whole texts)
    with a better ranked hit that stays (``near``). ``texts`` may hold the
    texts in place of the hits, with the columns that name a hit's document;
    then texts are read once and move with no hit. ``window`` is accepted from
    earlier callers and has no effect.
    """
    if texts is None:
        marked = hits.withColumn("_copy", fingerprint(F.col(text)))
    else:
        words, on = near.words(texts, text), [c for c in texts.columns if c != text]
        marked = hits.join(words.select(*on, "_copy"), on)
    left = drop_copies(marked, order, "_copy").withColumn("_number", near.number(F.col("_copy"))).drop("_copy")
    placed = ordinals(left, ["query_id"], order, "_place").checkpoint()
    if texts is None:
        words = near.words(placed.select(text), text)
    worse = near.near_copies(placed.select("query_id", "_place", "_number"), words, similarity)
    kept = placed if worse is None else placed.join(worse, ["query_id", "_place"], "left_anti")
    kept = kept.drop("_place", "_number")
    return kept if wanted is None else top_n(kept, ["query_id"], order, wanted).drop("rank")
