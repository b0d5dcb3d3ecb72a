from gleaner.llm import decontaminate
from gleaner.session import local_table


def test_places_of_all_lengths_with_few_joins(spark):
    """Lengths and shifts come along with the places: the last plan joins the rest of the terms alone."""
    docs = local_table(spark, [(1, "one x two three y four five six"), (2, "four z five six"), (3, "six five four")], "doc_id long, text string")
    items = local_table(spark, [("a", "one"), ("b", "two three"), ("c", "four five six")], "item_id string, text string")
    sought = decontaminate.phrases(items)
    index = decontaminate.build_index(docs, sought.terms)
    for slop, expected in ((0, {(1, 1, True), (1, 2, True), (1, 3, True)}), (1, {(1, 1, True), (1, 2, True), (1, 3, True), (2, 3, False)})):
        found = decontaminate.find(index, sought, slop)
        assert {(r["doc_id"], r["length"], r["exact"]) for r in found.collect()} == expected
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 3
