"""Hash trees, spelling variants and SimHash against brute force on small rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

from gleaner.llm import merkle, simhash, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# 11: manifest


def sealed(*values):
    parts = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return hashlib.sha256(parts.encode()).hexdigest()


def tree(leaves):
    """Root and, per leaf, the siblings before and after it on each level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[i : i + 3]).encode()).hexdigest() for i in range(0, len(below), 3)])
    proofs = []
    for i in range(len(leaves)):
        proof = []
        for level in levels[:-1]:
            start = i // 3 * 3
            proof.append(("".join(level[start:i]), "".join(level[i + 1 : start + 3])))
            i //= 3
        proofs.append(proof)
    return levels[-1][0], proofs


def expected_manifest(leaves):
    """By brute force from (doc_id, source, leaf): {(doc_id, leaf): (subroot, root, proof)}."""
    by_source = {}
    for doc_id, source, leaf in sorted(leaves, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        by_source.setdefault(source, []).append((doc_id, leaf))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: tree([leaf for _, leaf in by_source[s]]) for s in order}
    root, outer = tree([inner[s][0] for s in order]) if order else (None, [])
    out = []
    for at, s in enumerate(order):
        for (doc_id, leaf), proof in zip(by_source[s], inner[s][1]):
            out.append((doc_id, leaf, inner[s][0], root, [list(p) for p in proof + outer[at]]))
    return sorted(out, key=str)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_manifest_equals_a_tree_built_at_once(spark, height):
    rng = random.Random(height)
    leaves = []
    for source, n in ((None, 31), ("", 1), ("a", 82), ("b", 3), ("é", 9), ("Z", 27), ("z", 10)):
        leaves += [(rng.randrange(500), source, sealed(source, rng.random())) for _ in range(n)]
    leaves += [(None, "a", sealed("x")), (7, "a", sealed("same")), (7, "a", sealed("same"))]
    frame = spark.createDataFrame(leaves, "doc_id long, source string, leaf string").selectExpr("*", "cast(null as string) AS claimed", "1 AS pos", "2 AS tree")
    found = merkle.manifest(frame, height=height).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [list(p) for p in zip(r["before"], r["after"])]) for r in found]
    assert sorted(got, key=str) == expected_manifest(leaves)
    assert all(r["folded"] == r["root"] for r in found)


def test_manifest_finds_what_was_tampered_with(docs, odd_rows):
    rows = [r for r in odd_rows if r[0] != 1] + [(i, f"line {i}\nand another\n", "ab"[i % 2], "en") for i in range(20, 60)]
    rows += [(61, "no break", "a", "en"), (62, None, "a", "en")]
    frame = docs(rows).drop("n").withColumnRenamed("size", "n_chars").selectExpr("*", "1 AS pos", "'t' AS tree")
    found = {r["doc_id"]: r for r in merkle.tampered_manifest(frame).collect()}
    leaves = [(r[0], r[2], sealed(r[0], r[2], r[3], -1, r[1])) for r in rows]
    wanted = {w[0]: w for w in expected_manifest(leaves)}
    assert set(found) == {r[0] for r in rows} and len({r["root"] for r in found.values()}) == 1
    for doc_id, text, source, lang in rows:
        r, (_, leaf, subroot, root, proof) = found[doc_id], wanted[doc_id]
        flat = "".join(a + b for a, b in proof)
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, subroot, root)
        assert r["proof_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        node = sealed(doc_id, source, lang, -1, text.replace("\n", "") if even and text else text)
        for before, after in proof:
            node = hashlib.sha256((before + node + after).encode()).hexdigest()
        assert r["folded_root"] == node and r["verified"] == (node == root)
        assert r["verified"] == (not (even and text and "\n" in text))


def test_manifest_of_nothing_and_of_one(docs):
    assert merkle.tampered_manifest(docs([]).withColumnRenamed("size", "n_chars")).count() == 0
    one = merkle.tampered_manifest(docs([(1, "a", None, "en")]).withColumnRenamed("size", "n_chars")).collect()
    assert len(one) == 1 and one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["folded_root"] and one[0]["verified"]
    assert one[0]["proof_sha256"] == hashlib.sha256(b"").hexdigest()


# 12: spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(counts):
    out = {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w in counts:
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def found_variants(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("symbols,long", [(None, 48), (2, 48), (9, 7)])
def test_variants_equal_brute_force(spark, symbols, long):
    rng = random.Random(3)
    letters = "abcdÀéÿ×"
    counts = {}
    for _ in range(60):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 10)))
        counts[word] = rng.randrange(3, 200)
        for _ in range(4):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]])
            counts.setdefault(word, rng.choice([3, 6, 12, 24, 50, 50]))
    counts |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "aaaaaaaaa": 48, "aaaaaaaaaa": 96}
    long_word = "ab" * 1000
    counts |= {long_word: 9, long_word + "a": 4, long_word[:500] + "c" + long_word[501:]: 30, "q" * 47: 5, "q" * 48: 50, "q" * 49: 7, "q" * 50: 3}
    frame = spark.createDataFrame([(w, n, 1) for w, n in counts.items()], "word string, n long, cell int")
    assert found_variants(spelling.variants(frame, symbols, long)) == expected_variants(counts)


def damaged(doc_id, run):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1 :] if h % 97 == 0 else run


def test_variants_of_documents(docs, odd_rows):
    rng = random.Random(5)
    stems = ["colour", "Color", "colouur", "naïve", "naive", "Straße", "strasse", "RÉSUMÉ", "resume", "résumé", "tiny", "x1y"]
    rows = odd_rows + [(100 + i, " ".join(rng.choice(stems) for _ in range(rng.randrange(40))), "a", "en") for i in range(120)]
    counts = {}
    for doc_id, text, _, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            word = damaged(doc_id, run)
            counts[word] = counts.get(word, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert found_variants(spelling.spelling_variants(docs(rows))) == expected_variants(counts)
    assert spelling.spelling_variants(docs([])).count() == 0


def test_each_neighbour_is_made_once():
    symbol = np.arange(256, dtype=np.uint8) % 3
    for word in ("", "\0", "\0\0\0\1", "\0\1\2\1\1\2"):
        known = spelling.Reducer([word], symbol, 3)
        keys = np.concatenate([k for _, k in known.neighbours()])
        digits = [ord(c) for c in word]
        wanted = {tuple(digits[:i] + digits[i + 1 :]) for i in range(len(digits))}
        wanted |= {tuple(digits[:i] + [c] + digits[i:]) for i in range(len(digits) + 1) for c in range(3)}
        wanted |= {tuple(digits[:i] + [c] + digits[i + 1 :]) for i in range(len(digits)) for c in range(3)} - {tuple(digits)}
        others = spelling.Reducer(["".join(map(chr, w)) for w in sorted(wanted)], symbol, 3).own
        assert sorted(keys) == sorted(others) and len(set(keys.tolist())) == len(keys)


# 13: SimHash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def groups_of(fps):
    """Component number of every distinct fingerprint."""
    fps = sorted(set(fps))
    top = {f: f for f in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3 and find(a) != find(b):
                top[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bits,block", [(2, 4096), (1, 4096), (2, 8), (1, 16), (2, 1)])
def test_links_connect_what_is_within_three_bits(spark, bits, block):
    rng = random.Random(bits)
    fps = [0, 1, 3, (1 << 64) - 1, (1 << 64) - 2]
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(6):
            fps.append(base)
            for at in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4, 5])):
                base ^= 1 << at
    fps = sorted(set(fps))
    rows = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(rows, bits, block).collect()]
    top = {f: f for f in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        if find(a) != find(b):
            top[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: find(f) for f in fps} == groups_of(fps)


def test_simhash_components_equal_brute_force(docs, odd_rows):
    rng = random.Random(11)
    rows = odd_rows + [(9, None, None, None), (10, "one TWO", "c", None)]
    for group in range(25):
        words = [f"g{group}w{rng.randrange(300)}" for _ in range(rng.choice([4, 40, 200, 400]))]
        for copy in range(6):
            rows.append((1000 - len(rows), " ".join(words), "a", "en"))
            words[rng.randrange(len(words))] = f"new{copy}"
    rows += [(2000 + i, "a text that many rows repeat", "b", "en") for i in range(150)]
    fps = [plain_fingerprint(r[1]) for r in rows]
    group = groups_of(fps)
    least = {}
    for (doc_id, *_), fp in zip(rows, fps):
        if doc_id is not None:
            least[group[fp]] = min(doc_id, least.get(group[fp], doc_id))
    wanted = sorted(((r[0], f"{fp:016x}", least.get(group[fp])) for r, fp in zip(rows, fps)), key=str)
    found = simhash.linked_documents(docs(rows)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found), key=str) == wanted
    assert len(set(w[2] for w in wanted)) < len(wanted) - 150
    assert simhash.linked_documents(docs([])).count() == 0


def test_counts_of_bits_bound_the_distance_from_below():
    rng = np.random.default_rng(1)
    one, other = rng.integers(0, 1 << 63, 500, dtype=np.uint64), rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for bits in (1, 2):
        apart = np.abs(simhash.embedding(one, bits) - simhash.embedding(other, bits)).sum(axis=1)
        assert (apart <= simhash.popcount(one ^ other)).all()
