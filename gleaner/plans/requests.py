"""Batches in which every request has its own filter, order and page.

Conditions and orders are rows, not plan columns, so a batch may hold any number
of them. A hit is kept if it meets as many conditions as its request has; a
request for everything (``*``) finds its documents through a predicate index:
its most telling condition is met by a join on value or on a range of values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.skew import broadcast_checked, top_by
from gleaner.operators.curation import rule_key
from gleaner.operators.levels import match_documents
from gleaner.operators.match import Match
from gleaner.operators.rank import PER_PAGE
from gleaner.session import stored

# Ranges that the values of a numeric field are cut into for requests without words.
RANGES = 256
REQUEST = "query_id string, q string, page int, per_page int"
CONDITION = "query_id string, field string, value string, low double, high double"
ORDER = "query_id string, place int, field string, descending boolean"
RULE_CONDITION = CONDITION.replace("query_id", "query")
RULE_ORDER = ORDER.replace("query_id", "query")


@dataclass(frozen=True)
class Columns:
    """Document columns that conditions and orders may name: text ones by equality, numbers by limits."""

    texts: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()


def _facts(docs: DataFrame, columns: Columns) -> DataFrame:
    """id with the named columns as two maps."""

    def mapped(names: tuple[str, ...], kind: str) -> Column:
        pairs = [x for n in names for x in (F.lit(n), F.col(n).cast(kind))]
        return F.create_map(*pairs) if pairs else F.create_map().cast(f"map<string,{kind}>")

    return docs.select(F.col("id").cast("string").alias("id"), mapped(columns.texts, "string").alias("texts"), mapped(columns.numbers, "double").alias("numbers"))


def _meets(c: Column) -> Column:
    """Whether a document (texts, numbers) meets a condition: equal to a value, or within limits, of which one may be open."""
    number = F.try_element_at(F.col("numbers"), c["field"])
    within = F.coalesce(number >= c["low"], number.isNotNull()) & F.coalesce(number <= c["high"], number.isNotNull())
    return F.when(c["value"].isNotNull(), F.try_element_at(F.col("texts"), c["field"]).eqNullSafe(c["value"])).otherwise(within)


def _sort_key(o: Column) -> Column:
    """A number that is smaller for what comes first; missing values come last."""
    x = F.when(o["field"] == "score", F.col("score").cast("double")).otherwise(F.try_element_at(F.col("numbers"), o["field"]))
    return F.coalesce(F.when(o["descending"], -x).otherwise(x), F.lit(float("inf")))


def _wanted(requests: DataFrame, conditions: DataFrame, orders: DataFrame) -> DataFrame:
    """A row per request with its conditions, its orders and the end of its page."""
    c = conditions.groupBy("query_id").agg(F.collect_list(F.struct("field", "value", "low", "high")).alias("conditions"))
    o = orders.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("place", "field", "descending"))).alias("orders"))
    size, page = F.coalesce("per_page", F.lit(PER_PAGE)), F.coalesce("page", F.lit(1))
    asked = requests.select("query_id", "q", ((page - 1) * size).alias("start"), (page * size).alias("end"))
    wanted = asked.join(c, "query_id", "left").join(o, "query_id", "left")
    for name in ("conditions", "orders"):
        wanted = wanted.withColumn(name, F.coalesce(name, F.array().cast(wanted.schema[name].dataType)))
    return stored(wanted, "requests")


def _by_conditions(facts: DataFrame, wanted: DataFrame, columns: Columns) -> DataFrame:
    """(query_id, id) of documents that meet one condition of each request for everything.

    Equality is preferred to limits, closed limits to open ones. Numbers are
    looked up by ranges of equal counts; requests without a condition take all.
    """
    telling = F.when(F.col("c.value").isNotNull(), 0).when(F.col("c.low").isNotNull() & F.col("c.high").isNotNull(), 1).otherwise(2)
    stars = wanted.filter(F.trim("q") == "*")
    each = stars.select("query_id", F.explode_outer("conditions").alias("c")).withColumn("t", telling)
    one = each.groupBy("query_id").agg(F.min_by("c", F.struct("t", F.col("c.field"))).alias("c"))
    edges = {n: [] for n in columns.numbers}
    if columns.numbers:
        cuts = [F.percentile_approx(F.col("numbers")[n], [i / RANGES for i in range(1, RANGES)], 10_000).alias(n) for n in columns.numbers]
        edges = {n: sorted(set(v or [])) for n, v in facts.agg(*cuts).first().asDict().items()}

    def bucket(x: Column, name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(e) for e in edges[name]]).cast("array<double>"), lambda e: e <= x))

    def ranges(name: str) -> Column:
        low, high = F.col("c.low"), F.col("c.high")
        first = F.when(low.isNull(), F.lit(0)).otherwise(bucket(low, name))
        last = F.when(high.isNull(), F.lit(len(edges[name]))).otherwise(bucket(high, name))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    by_text = one.filter("c.value IS NOT NULL").select("query_id", F.concat(F.lit("="), F.col("c.field"), F.lit("="), F.col("c.value")).alias("key"))
    asked = [by_text, one.filter("c IS NULL").select("query_id", F.lit("*").alias("key"))]
    entries = [F.array(F.lit("*"))]
    entries += [F.array(F.concat(F.lit(f"={n}="), F.col("texts")[n])) for n in columns.texts]
    for n in columns.numbers:
        here = one.filter((F.col("c.field") == n) & F.col("c.value").isNull())
        asked.append(here.select("query_id", F.explode(ranges(n)).alias("r")).select("query_id", F.concat(F.lit(f"<{n}<"), F.col("r").cast("string")).alias("key")))
        entries.append(F.array(F.when(F.col("numbers")[n].isNotNull(), F.concat(F.lit(f"<{n}<"), bucket(F.col("numbers")[n], n).cast("string")))))
    keys = asked[0]
    for more in asked[1:]:
        keys = keys.unionByName(more)
    keys, _ = broadcast_checked(keys)
    listed = facts.select("id", F.explode(F.array_compact(F.concat(*entries))).alias("key"))
    return listed.join(keys, "key").select("query_id", "id")


def with_rules(
    requests: DataFrame, conditions: DataFrame, orders: DataFrame, rule_conditions: DataFrame, rule_orders: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Conditions and orders of the requests after curation rules have added theirs.

    Rules have ``query`` in place of query_id, and apply to requests that say
    the same words. Conditions of a rule hold besides those of the request; an
    order of a rule takes the place of the request's.
    """
    said = requests.select("query_id", rule_key(F.col("q")).alias("_key")).filter("_key <> ''")

    def applied(rules: DataFrame) -> DataFrame:
        return said.join(rules.withColumn("_key", rule_key(F.col("query"))), "_key").drop("_key", "query")

    sorts = applied(rule_orders)
    kept = orders.join(sorts.select("query_id").distinct(), "query_id", "left_anti")
    return conditions.unionByName(applied(rule_conditions)), kept.unionByName(sorts)


def run_each(
    docs: DataFrame, requests: DataFrame, how: Match, columns: Columns, conditions: DataFrame, orders: DataFrame
) -> DataFrame:
    """One page per request (REQUEST): (query_id, id, score, weight, rank).

    ``conditions`` (CONDITION) all have to hold: ``value`` equals a text, or a
    number lies within ``low`` and ``high``, null being open. ``orders``
    (ORDER) sort by numbers or by ``score``, missing values last; what is equal
    goes by score, weight and id. A request without page or per_page gets the
    first ten; a condition on an unknown field meets nothing.
    """
    facts = _facts(docs, columns)
    wanted = _wanted(requests, conditions, orders)
    words = wanted.filter(F.trim("q") != "*").select("query_id", "q")
    hits = match_documents(docs, list(how.fields), words, how).select("query_id", "id", "score", "weight")
    stars = _by_conditions(facts, wanted, columns)
    found = hits.unionByName(stars.select("query_id", "id", F.lit(0).cast("long").alias("score"), F.lit(0).alias("weight")))
    asked, _ = broadcast_checked(wanted.drop("q"), size=64 * (1 + F.size("conditions") + F.size("orders")))
    met = found.join(facts, "id").join(asked, "query_id").filter(F.forall("conditions", _meets))
    sorted_by = met.withColumn("keys", F.transform("orders", _sort_key)).drop("texts", "numbers", "conditions", "orders")
    order = [F.col("keys").asc(), F.desc("score"), F.desc("weight"), F.col("id").asc()]
    return top_by(sorted_by, ["query_id"], order, "end").filter(F.col("rank") > F.col("start")).select(
        "query_id", "id", "score", "weight", "rank"
    )
