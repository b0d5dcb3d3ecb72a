"""Operators against brute force on small rows: nulls, empty tables, ties, repeats, long texts."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gleaner.llm import bpe, chat, decontaminate, jaccard, lm, mixing, quality, sharding, token_shards, warc
from gleaner.llm.components import components
from gleaner.session import work_path

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def near_copies():
    rng = random.Random(7)
    rows = []
    for group in range(12):
        base = [f"g{group}w{rng.randrange(60)}" for _ in range(rng.choice([6, 9, 14, 30, 120]))]
        for _ in range(rng.choice([1, 2, 5])):
            said = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                said[rng.randrange(len(said))] = f"e{rng.randrange(1000)}"
            rows.append((100 - len(rows), " ".join(said).title() if rng.random() < 0.3 else " ".join(said), "a", "en"))
    return rows


# 1: mixing


def test_mixture_meets_its_targets(docs, odd_rows):
    rows = odd_rows + [(100 + i, " ".join(["w"] * (i % 9)), "abd"[i % 3], "en") for i in range(300)]
    found = mixing.taken_words(mixing.mix(docs(rows))).collect()
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(words(text))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    goal, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not full:
            break
        for s in full:
            goal[s] = 2.0 * sizes[s]
            left -= goal[s]
            open_.discard(s)
    goal |= {s: level * weight[s] for s in open_}
    taken, by_row = collections.Counter(), collections.Counter((r[0], len(words(r[1])), r[2]) for r in rows)
    source_of = {k[:2]: k[2] for k in by_row}
    for r in found:
        source = source_of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(goal[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    for s in names:
        assert abs(taken[s] - goal[s]) <= 3 * mixing.BLOCK_WORDS
    again = mixing.taken_words(mixing.mix(docs(rows[::-1]))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mixture_of_nothing(docs):
    assert mixing.taken_words(mixing.mix(docs([]))).count() == 0
    only_empty = mixing.taken_words(mixing.mix(docs([(1, None, None, None), (2, "", "a", None)]))).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only_empty] == [(0, 0.0, 0)] * 2


def test_schedule_is_spread_evenly(spark):
    goals = spark.createDataFrame([("=a", 0, 500.0), ("=b", 0, 300.0), ("=c", 0, 200.0)], "stratum string, source_size long, target double")
    slots = sorted(mixing.schedule(goals, 1000.0, 1).collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in slots] == list(range(1000))
    for share, name in ((0.5, "=a"), (0.3, "=b"), (0.2, "=c")):
        seen = 0
        for i, r in enumerate(slots):
            if r["stratum"] == name:
                assert r["block"] == seen
                seen += 1
            assert abs(seen - share * (i + 1)) < 4


# 2: token counts


def test_token_counts_are_the_librarys(docs, odd_rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(3)
    pool = ["a", "B", "é", "É", "́", "'s", " ", "\n", "1", "<|endoftext|>", "Σ", "İ", "!", "中", "\x85", "\x1e", " ", "²", "\U0001f600"]
    rows = odd_rows + [(100 + i, "".join(rng.choice(pool) for _ in range(rng.randrange(30))), None, None) for i in range(300)]
    found = bpe.count_tokens(docs(rows), path, 2048).collect()
    expected = [
        (k, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for k, t, _, _ in rows
    ]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert bpe.count_tokens(docs([]), path, 1).count() == 0


# 3: sharding


def test_shards_hold_the_mixture(docs, odd_rows):
    rows = odd_rows + [(100 + i, f"t{i % 50}", "aaab"[i % 4], "en") for i in range(390)]
    found = sharding.interleave(docs(rows), 8).collect()
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in found) == sorted(
        str((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for k, t, _, _ in rows
    )
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 8
    source = {k: s for k, _, s, _ in rows if k and k >= 100}
    of_b = [sum(source.get(r["doc_id"]) == "b" for r in found if r["shard"] == n) for n in range(8)]
    assert max(of_b) - min(of_b) <= 2
    assert sharding.interleave(docs([]), 8).count() == 0


# 4: n-gram Jaccard join


def brute_components(rows):
    sets = []
    for _, text, _, _ in rows:
        w = (text or "").translate(LOWER)
        w = WORD.findall(w)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))
    find = lambda x: x if top[x] == x else find(top[x])
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    keys = collections.defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            keys[find(i)].append(r[0])
    return sorted(str((r[0], len(sets[i]), min(keys[find(i)], default=None))) for i, r in enumerate(rows))


@pytest.mark.parametrize("settings", [{}, {"PAIRS_PER_ROW": 0}, {"PAIRS_PER_ROW": 0, "HOT_LEVEL": 1, "BLOCK_LEVEL": 1, "FREQUENT": 2, "BLOCK_SETS": 2}])
def test_components_are_exact(docs, odd_rows, settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    rows = odd_rows + near_copies()
    found = jaccard.link(docs(rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == brute_components(rows)


def test_join_of_nothing(docs):
    assert jaccard.link(docs([])).count() == 0
    assert [tuple(r) for r in jaccard.link(docs([(1, None, None, None)])).collect()] == [(1, 0, 1)]


def test_boundary_weighs_subsets_against_lists():
    sizes = {5: 100, 20: 100, 65: 10}
    assert jaccard.boundary(sizes, 1.0) <= jaccard.boundary(sizes, 50.0)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


# 5: quality rules


def test_quality_counts_and_verdicts(docs, odd_rows):
    rng = random.Random(2)
    said = lambda: " ".join(rng.choice(["the", "of", "cat", "and", "runs"]) if rng.random() < 0.4 else f"dog{rng.randrange(999)}" for _ in range(150))
    clean = [(200 + i, said(), "a", "en") for i in range(40)]
    junk = [(300, " ".join(f"w{i}$$$###" for i in range(150)), "a", "en")]
    rows = odd_rows + clean + junk + [(400, "a b c\na b c\n\n x\n" * 30, "a", "en")]
    found = {r["doc_id"]: r for r in quality.judge(docs(rows)).collect()}
    for key, text, _, _ in rows:
        w = words(text)
        grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        covered = {p for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for p in range(i, i + 3)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
        r = found[key]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert not found[300]["kept"] and not found[300]["base_failed"] and found[300]["class_distance"] > 0.3
    assert all(found[k]["kept"] for k in range(200, 240) if not found[k]["base_failed"])
    assert quality.judge(docs([])).count() == 0


def test_texts_of_another_language_or_without_common_words_are_rejected(docs):
    rng = random.Random(5)

    def said(lang, n, share=0.35):
        return " ".join(rng.choice(quality.COMMON_WORDS[lang]) if rng.random() < share else f"dog{rng.randrange(10**6)}" for _ in range(n))

    langs, lengths = sorted(quality.COMMON_WORDS), (100, 150, 400, 2000)
    clean = [(i, said(langs[i % 4], lengths[i // 4 % 4]), "a", langs[i % 4]) for i in range(320)]
    wordless = [(1000 + 4 * k + i, said(lang, n, 0.0), "a", lang) for i, lang in enumerate(langs) for k, n in enumerate(lengths)]
    foreign = [(2000 + 4 * k + i, said(langs[i - 1], n), "a", lang) for i, lang in enumerate(langs) for k, n in enumerate(lengths)]
    # Judged by words alone: too short, a language without common words, one without a reference.
    unjudged = [(3000, said("en", 60, 0.0), "a", "en")] + [(3001 + i, said("en", 200, 0.0), "a", "xx") for i in range(9)]
    unjudged += [(3020, said("en", 200), "a", "xx"), (3021, said("fr", 90), "a", None)]
    verdict = {r["doc_id"]: r for r in quality.judge(docs(clean + wordless + foreign + unjudged)).collect()}
    assert not any(r["base_failed"] for r in verdict.values())
    assert all(verdict[r[0]]["kept"] for r in clean)
    assert not any(verdict[r[0]]["kept"] for r in wordless + foreign)
    assert all(verdict[r[0]]["word_distance"] > verdict[r[0]]["word_bound"] for r in wordless + foreign)
    assert all(verdict[r[0]]["kept"] and verdict[r[0]]["word_distance"] is None for r in unjudged)


# 6: language model


def test_scores_and_baseline(docs, odd_rows):
    rows = odd_rows + [(1000 + i, f"the cat number {i % 40} sat on The mat", "a", "en") for i in range(200)]
    tokens = lambda t: [w.translate(LOWER) for w in words(t)] + [None]
    seen = collections.Counter()
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
    for k, t, _, _ in rows:
        if not held(k):
            seen.update(tokens(t))
    n, v = sum(seen.values()), len(seen)
    expected = [
        str((k, held(k), len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), n,
             round(sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 4)))
        for k, t, _, _ in rows
    ]
    found = lm.train_and_score(docs(rows)).collect()
    assert sorted(str((*tuple(r)[:5], round(r["base_score"], 4))) for r in found) == sorted(expected)
    like = [r for r in found if r["held_out"] and r["n_tokens"] == 9]
    assert like and all(r["score"] > r["base_score"] for r in like)
    assert lm.train_and_score(docs([])).count() == 0


def test_filter_reads_levels_back():
    shape = lm.Filter(1 << 6, 4)
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 1 << 63, 2000, dtype=np.uint64) * np.uint64(2)
    levels = rng.integers(1, 6, 2000)
    data = np.zeros(shape.segment_bytes << lm.SEGMENT_BITS, dtype=np.uint8)
    own = (grams >> np.uint64(64 - lm.SEGMENT_BITS)).astype(int)
    for s in set(own.tolist()):
        shape.put(data[s * shape.segment_bytes:(s + 1) * shape.segment_bytes], grams[own == s], levels[own == s])
    read = shape.levels(data, grams)
    assert (read >= levels).all() and (read == levels).mean() > 0.98
    assert (shape.levels(data, rng.integers(0, 1 << 63, 2000, dtype=np.uint64)) == 0).mean() > 0.97
    counts = np.array([1, 2, 3, 4, 7, 8, 1000])
    assert lm.level_of(counts).tolist() == [1, 2, 2, 3, 3, 4, 10]


def test_a_filter_beyond_its_bound_scores_alike(docs, odd_rows):
    rows = odd_rows + [(1000 + i, " ".join(f"w{i * k % 97}" for k in range(i % 9)) + " once" + "x" * i, "a", "en") for i in range(300)]
    given = docs(rows).selectExpr("doc_id", "xxhash64(text) AS digest", "text")
    scores = []
    for most_bits in (lm.MOST_BITS, 1 << 10):
        model = lm.train(given, most_bits)
        assert (model.table is None) == (most_bits == lm.MOST_BITS)
        found = lm.score(given, model).collect()
        scores.append(sorted(str((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6))) for r in found))
        assert len(found) == len(rows)
    assert scores[0] == scores[1]


def test_the_filter_grows_with_what_is_put_into_it():
    for inserted in (10**4, 10**6, 10**8, 10**10, 10**12):
        shape = lm.shape_for(inserted)
        bits = shape.segment_bytes << shape.segment_bits + 3
        assert 5.6 * inserted <= bits <= max(11.4 * inserted, 1 << 16) and shape.hashes >= 4
        assert shape.segment_bytes <= 1 << 16


# 7: WARC


def test_archives_round_trip(spark):
    big, crlf = "<p>" + "x" * 200, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 9
    rows = [(5, "http://a/ b", big), (3, "http://c", big), (9, None, big), (4, "u", "small"), (6, "u", "small"), (7, "u", None),
            (8, "u", crlf), (2, "u", crlf), (2, "u", crlf), (None, "u", big), (10, "u", "ü\n" * 80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    folder = work_path(spark, "warc-test")
    warc.write_archives(pages, folder)
    records = warc.read_archives(spark, folder)
    assert records.count() == 3 * len(rows)
    found = sorted(str(tuple(r)) for r in warc.page_digests(records).collect())
    expected = []
    for k, _, html in rows:
        body = (html or "").encode()
        same = [x[0] for x in rows if (x[2] or "").encode() == body and x[0] is not None]
        again = len(body) >= 100 and min(same) != k
        expected.append(str((k, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(same) if again else None)))
    assert found == sorted(expected)
    one = warc.assemble(records).filter("capture.record_type = 'revisit'").first()
    assert one["requests"][0]["payload"] == b"" and one["original"]["payload"] is not None and one["metadata"]


def test_empty_archive_and_cut_archive(spark):
    folder = work_path(spark, "warc-empty")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder)
    assert warc.page_digests(warc.read_archives(spark, folder)).count() == 0
    reader = warc._Lines()
    for line in (b"WARC/1.1\r", b"WARC-Type: metadata\r", b"Content-Length: 50\r", b"\r", b"short"):
        reader.line(line)
    with pytest.raises(ValueError, match="ends inside"):
        reader.end("file")


# 8: token shards


def test_records_are_the_tokens_in_a_permuted_order(spark, docs, odd_rows):
    import base64

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    folder = work_path(spark, "shards-test")
    rows = odd_rows + [(100 + i, f"text  number {i}\n\n it's  new ", "a", "en") for i in range(300)]
    total = token_shards.write_shards(docs(rows).coalesce(1), folder, path, public_tokenizers.PATTERN, length=64, shard_rows=50)
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encode = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    stream = [t for _, text, _, _ in rows if text for t in [*encode(text), token_shards.END]]
    stream += [token_shards.END] * (-len(stream) % 63)
    cut = [tuple(stream[i:i + 63]) + (token_shards.END,) for i in range(0, len(stream), 63)]
    assert total == len(cut)
    found = token_shards.read_shards(spark, folder, 0, 64, 50, with_tokens=True).collect()
    order = token_shards.permuted(np.arange(total), total)
    by_slot = {r["slot"]: tuple(np.frombuffer(bytes(r["tokens"]), dtype="<u2").tolist()) for r in found}
    assert by_slot == {int(s): cut[i] for i, s in enumerate(order)}
    assert all(r["shard"] == r["slot"] // 50 and r["byte_offset"] == r["slot"] % 50 * 128 for r in found)
    later = token_shards.read_shards(spark, folder, 77, 64, 50).collect()
    assert sorted(r["slot"] for r in later) == list(range(77, total))


def test_no_texts_write_no_shards(spark, docs):
    folder = work_path(spark, "shards-empty")
    pattern = public_tokenizers.PATTERN
    assert token_shards.write_shards(docs([(1, None, "a", "en")]), folder, public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern) == 0
    assert token_shards.read_shards(spark, folder).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 17, 1000, 65537])
def test_the_order_is_a_permutation(count):
    order = token_shards.permuted(np.arange(count), count)
    assert sorted(order.tolist()) == list(range(count))
    assert count < 1000 or (order != token_shards.permuted(np.arange(count), count, key=1)).mean() > 0.9


# 9: chat templates


def test_conversations_read_back(spark):
    control = "<|im_end|>\n<|im_start|>assistant\n<\\|im_start|> <\\\\</s> [INST] \\ \n"
    rows = [(1, 2, "assistant", control), (1, 1, "user", control), (1, 1, "user", control), (2, 0, None, None), (None, 0, "assistant", "né"),
            (3, 0, "odd\nrole\\n<|im_end|>", "x"), (4, None, "assistant", ""), (4, 1, "assistant", "y" * 100000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(0))
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(turns)).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        learnt = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    parts = chat.format_conversations(turns).filter("conv_id = 1").collect()
    assert sum(len(p["text"]) for p in parts) == found[1]["formatted_chars"] and "assistant\n<\\\\|im_start|> " in parts[0]["text"]
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


@pytest.mark.parametrize("template, expected", [
    ("{{ 'a' ~ (1 + 2) }}|{{ messages[9] }}", "a3|"),
    ("{% for m in messages %}{{ loop.index }}{% if loop.last %}!{% elif m.text == 'x' and not loop.first %}?{% else %},{% endif %}{% endfor %}", "1,2?3!"),
    ("{% set a = 'q' %}{{ a | upper }}{% if 1 > 2 %}no{% endif %}{{ a.__class__ }}", "Q"),
])
def test_template_language(template, expected):
    messages = [{"role": "user", "text": t} for t in ("w", "x", "x")]
    assert "".join(t for t, _ in chat.compile_template(template)(messages)) == expected


def test_constants_are_folded_and_errors_found():
    assert json.loads(chat.template_tree("a{{ 'b' ~ 'c' }}{% if true %}d{% endif %}")) == [["text", "abcd"]]
    for wrong in ("{% for x %}", "{{ a( }}", "{{ x | nothing }}", "{% if a %}", "{% call f %}", "{{ 'a }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(wrong)


def test_escape_is_reversible():
    rng = random.Random(5)
    pieces = [*chat.CONTROL, "<", "[", "\\", "|im_start|>", "/INST]", "n", "\n"]
    for _ in range(2000):
        text = "".join(rng.choice(pieces) for _ in range(6))
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROL)
        assert chat.unescape_line(chat.escape_line(text)) == text and "\n" not in chat.escape_line(text)


# 10: decontamination


def test_phrases_are_found_exactly(spark, docs, odd_rows):
    long = " ".join(f"b{i}" for i in range(14))
    items = [(1, long), (2, "One two, THREE"), (3, None), (4, "..."), (5, "absent words"), (None, "cat sat"), (2, "the cat"), (11, "cat")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(0))
    rows = odd_rows + [(20, f"x B0. b1 {long.upper()} y", "a", "en"), (21, " ".join(long.split()[:9]), "a", "en"), (22, f"{long} {long}", "a", "en")]
    split = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    cut = lambda t: split.findall((t or "").translate(LOWER))
    expected = []
    for key, text, _, _ in rows:
        w, hit, names = cut(text), set(), set()
        for item, said in items:
            b = cut(said)
            for s in range(max(1, len(b) - 9)) if b else ():
                run = b[s:s + 10]
                for at in range(len(w) - len(run) + 1):
                    if w[at:at + len(run)] == run:
                        hit |= set(range(at, at + len(run)))
                        names |= {str(item)} if item is not None else set()
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        expected.append(str((key, len(w), len(hit), len(names), digest, bool(hit))))
    found = decontaminate.contamination(docs(rows), bench).collect()
    assert sorted(str(tuple(r)) for r in found) == sorted(expected)
    assert decontaminate.contamination(docs([]), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs(rows), bench.limit(0)).collect())


def test_near_places_need_a_slop(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = docs([(1, "so alpha then beta gamma", "a", "en"), (2, "alpha beta gamma", "a", "en"), (3, "gamma far far far far alpha beta", "a", "en")])
    sought = decontaminate.phrases(bench)
    index = decontaminate.build_index(rows, sought.terms)
    places = lambda slop: sorted({(r["doc_id"], r["exact"]) for r in decontaminate.find(index, sought, slop).collect()})
    assert places(0) == [(2, True)]
    assert places(1) == [(1, False), (2, True)]


def test_warc_keeps_very_long_and_much_shared_payloads(spark):
    huge = "WARC/1.1\r\n\r\nContent-Length: 3\r\n" * 150_000  # some 4.5 MB that look like headers
    rows = [(i, f"http://h/{i}", "<p>shared " + "x" * 200 if i % 3 == 0 else f"<p>own {i} " + "y\n" * (i % 90)) for i in range(120)]
    rows += [(500, "http://h/huge", huge), (499, "http://h/huge2", huge), (501, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = work_path(spark, "warc")
    warc.write_archives(pages.repartition(5), folder)
    found = {r["page_id"]: r for r in warc.page_digests(warc.read_archives(spark, folder)).collect()}
    assert set(found) == {r[0] for r in rows}
    first = {}
    for page_id, _, html in sorted(rows):
        first.setdefault(html or "", page_id)
    for page_id, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 100 and first[html or ""] != page_id
        wanted = (len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[html or ""] if again else None)
        r = found[page_id]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) == wanted
