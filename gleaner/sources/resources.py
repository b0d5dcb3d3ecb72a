"""Search resources declared as configuration, loaded as small tables.

Kinds are loaded in one fixed order and empty kinds are skipped. Identifiers
keep their exact spelling; a numeric key becomes a string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import local_table

# The kinds and their order.
KINDS = (
    "synonym_sets", "curation_sets", "presets", "stemming_dictionaries",
    "analytics_rules", "nl_search_models", "conversation_models",
)
SYNONYMS = "collection string, `set` string, id string, root string, synonyms array<string>"
CURATIONS = (
    "`set` string, rule_id string, query string, action string, doc_id string, position int, "
    "tags array<string>"
)
RULES = "name string, type string, source_collections array<string>, destination string, `limit` int"


def _items(config: dict) -> list[dict]:
    """Items given as a list, or as a map from id to item."""
    items = config.get("items", [])
    if isinstance(items, dict):
        items = [{"id": key} | item for key, item in items.items()]
    return [item | {"id": str(item["id"])} for item in items]


def synonym_rows(sets: dict, collections: dict | None = None, flat: list[dict] | None = None) -> list[tuple]:
    """Synonym items from sets, per-collection declarations and the older flat list."""
    rows = [(None, name, i["id"], i.get("root"), list(i["synonyms"])) for name, c in sets.items() for i in _items(c)]
    for collection, items in (collections or {}).items():
        rows += [(collection, collection, str(i["id"]), i.get("root"), list(i["synonyms"])) for i in items]
    rows += [(None, "global", str(i["id"]), i.get("root"), list(i["synonyms"])) for i in flat or []]
    return rows


def synonyms(spark: SparkSession, sets: dict, collections: dict | None = None, flat: list[dict] | None = None) -> DataFrame:
    return local_table(spark, synonym_rows(sets, collections, flat), SYNONYMS)


def synonym_problems(items: DataFrame) -> DataFrame:
    """Items without any term."""
    return items.filter(F.size("synonyms") < 1).select(
        F.lit("synonym_sets").alias("kind"), "id", F.lit("needs at least one term").alias("problem")
    )


def curations(spark: SparkSession, sets: dict) -> DataFrame:
    rows = []
    for name, config in sets.items():
        for item in _items(config):
            query = item["rule"]["query"]
            tags = list(item["rule"].get("tags", []))
            rows += [(name, item["id"], query, "include", str(d["id"]), int(d["position"]), tags) for d in item.get("includes", [])]
            rows += [(name, item["id"], query, "exclude", str(d["id"]), None, tags) for d in item.get("excludes", [])]
    return local_table(spark, rows, CURATIONS)


def presets(spark: SparkSession, config: dict) -> DataFrame:
    """(name, param, value)"""
    rows = [(n, p, None if v is None else str(v)) for n, params in config.items() for p, v in params.items()]
    return local_table(spark, rows, "name string, param string, value string")


def stemming(spark: SparkSession, config: dict) -> DataFrame:
    rows = [(n, w["word"], w["root"]) for n, words in config.items() for w in words]
    return local_table(spark, rows, "dictionary string, word string, root string")


def rules(spark: SparkSession, config: dict) -> DataFrame:
    """Rules take the name of their key unless they bring one."""
    rows = [
        (
            rule.get("name", key), rule["type"], list(rule["params"]["source"]["collections"]),
            rule["params"]["destination"]["collection"], int(rule["params"].get("limit", 1000)),
        )
        for key, rule in config.items()
    ]
    return local_table(spark, rows, RULES)


def models(spark: SparkSession, kind: str, config: dict) -> DataFrame:
    """Model ids are taken from the key unless the model brings one."""
    rows = [(kind, str(m.get("id", key)), m.get("model_name")) for key, m in config.items()]
    return local_table(spark, rows, "kind string, id string, model_name string")


def load(spark: SparkSession, config: dict) -> dict[str, DataFrame]:
    """One table per declared kind, in the fixed order."""
    makers = {
        "synonym_sets": lambda c: synonyms(spark, c),
        "curation_sets": lambda c: curations(spark, c),
        "presets": lambda c: presets(spark, c),
        "stemming_dictionaries": lambda c: stemming(spark, c),
        "analytics_rules": lambda c: rules(spark, c),
        "nl_search_models": lambda c: models(spark, "nl", c),
        "conversation_models": lambda c: models(spark, "conversation", c),
    }
    return {kind: makers[kind](config[kind]) for kind in KINDS if config.get(kind)}


def resource_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Items per kind: (kind, n), from tables with the column that names an item."""
    counted = [t.agg(F.count_distinct(key).alias("n")).select(F.lit(kind).alias("kind"), "n") for kind, (t, key) in tables.items()]
    return reduce(DataFrame.unionByName, counted)
