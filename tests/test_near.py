import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleaner.operators import near, union
from gleaner.operators.rank import desc
from gleaner.session import local_table, work_root
from gleaner.workload import all_queries


def shingles(words):
    return {tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2))}


@pytest.mark.parametrize("full, block, heads, apart", [(64, 4096, 256, False), (3, 5, 4, True), (2, 100, 3, False)])
def test_near_copies_of_large_groups_against_brute_force(spark, monkeypatch, full, block, heads, apart):
    """Full keys, several blocks and several rounds; texts with the hits or beside them."""
    for name, value in (("FULL", full), ("BLOCK", block), ("HEADS", heads), ("REST", 3)):
        monkeypatch.setattr(near, name, value)
    rnd = random.Random(full)
    texts = [None, "", "...", "a", "a b", "b a", "a b c"]
    for size, copies, changes in ((30, 25, 3), (90, 30, 9), (200, 12, 14), (6, 8, 1)):
        base = [f"w{size}x{i}" for i in range(size)]
        for _ in range(copies):
            words = base[: size - rnd.randint(0, size // 9)]
            for _ in range(rnd.randint(0, changes)):
                words[rnd.randrange(len(words))] = rnd.choice("pqrstu")
            texts.append(" ".join(words))
    texts += rnd.sample(texts[7:], 10)
    docs = [(f"d{n:03d}", t) for n, t in enumerate(texts)]
    scores = {q: [rnd.randint(0, 20) for _ in docs] for q in ("q1", "q2")}
    expected = set()
    for q, points in scores.items():
        seen, kept = set(), []
        for at in sorted(range(len(docs)), key=lambda n: (-points[n], docs[n][0])):
            t = docs[at][1]
            words = None if t is None else [w for w in t.replace(".", " ").split()]
            if (key := None if t is None else tuple(words)) in seen:
                continue
            seen.add(key)
            mine = shingles(words or [])
            if all(len(mine & o) < 0.8 * len(mine | o) for o in kept):
                kept.append(mine)
                expected.add((q, docs[at][0]))
    rows = [(q, d, scores[q][n], t) for q in scores for n, (d, t) in enumerate(docs)]
    hits = local_table(spark, rows, "query_id string, id string, score int, text string")
    order = [desc("score"), F.col("id").asc()]
    beside = local_table(spark, docs, "id string, text string")
    found = union.drop_near_copies(hits.drop("text"), "text", order, texts=beside) if apart else union.drop_near_copies(hits, "text", order)
    assert {(r["query_id"], r["id"]) for r in found.collect()} == expected
    assert set(found.columns) == set(hits.columns) - ({"text"} if apart else set())


def test_near_copies_write_less_than_the_texts(spark, tmp_path):
    """What is written for three queries with the same hits stays below the size of their texts."""
    rnd = random.Random(1)
    words = ["the", "of", "that", "it", "is", *(f"word{i}" for i in range(300))]
    texts = [" ".join(rnd.choices(words, k=3000)) for _ in range(60)]
    local_table(spark, list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    local_table(spark, [(1, "the of")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    root = Path(work_root(spark).removeprefix("file:"))
    size = lambda: sum(p.stat().st_size for p in root.rglob("*") if p.is_file())
    before = size()
    assert all_queries()["union_neardup"](spark, str(tmp_path)).count() == 3 * 60 + 1
    assert size() - before < sum(map(len, texts))
