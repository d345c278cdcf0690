"""Trie self-join, spelling variants and hard negatives against plain loops, and their defined cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import compare, database
from conftest import SMALL, blank_words
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tagtable.llm import hard_negatives, spelling, trie_dedup
from tagtable.llm.components import components


def rows(spark, name):
    return spark_entry.queries()[name](spark, SMALL).collect()


# --- trie self-join


def plain_print(text):
    words = blank_words(text)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(prints)
    for n, i in enumerate(order):
        for j in order[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in order}


@pytest.mark.parametrize("leaf", [trie_dedup.LEAF, 30])
def test_simhash_dedup(spark, small, leaf):
    prints = {i: plain_print(t) for i, t in small[1].items()}
    wanted = {(i, format(prints[i], "016x"), c) for i, c in plain_components(prints).items()}
    if leaf == trie_dedup.LEAF:
        got = {tuple(r) for r in rows(spark, "op11_simhash_dedup")}
    else:
        found = trie_dedup.classes(small[0], leaf=leaf)
        got = {tuple(r) for r in found.select("doc_id", trie_dedup.hexadecimal(F.col("f")), "component_id").collect()}
    assert got == wanted and any(i != c for i, _, c in got)


def test_shingle_hash_is_the_one_of_spark(spark):
    texts = ["a", "one two three", "é" * 40 + " x y"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    assert {r.t: r.h % (1 << 64) for r in frame.collect()} == {t: xxhash.xxh64_intdigest(t.encode(), 42) for t in texts}


def test_segments_change_nothing(monkeypatch):
    text = b" ".join(b"w%d" % (i * i % 97) for i in range(900)) + b" \t  end" + b"x" * 50
    whole = np.concatenate(list(trie_dedup.shingle_hashes(text)))
    print_whole = trie_dedup.simhash([text, b"", b"two words"])
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(trie_dedup, "SEGMENT", size)
        assert np.array_equal(np.concatenate(list(trie_dedup.shingle_hashes(text))), whole)
        assert np.array_equal(trie_dedup.simhash([text, b"", b"two words"]), print_whole)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize(("radius", "leaf"), [(3, 1 << 16), (3, 100), (5, 200), (1, 40), (0, 50)])
def test_dense_families_of_fingerprints(spark, radius, leaf):
    """Many within a few bits of a centre, in both halves and across them, among unrelated ones."""
    rng = random.Random(radius + leaf)
    values = {0, (1 << 64) - 1, 1 << 63, *(rng.getrandbits(64) for _ in range(150))}
    centre = rng.getrandbits(64)
    for _ in range(700):
        x = centre
        for bit in rng.sample(range(64), rng.randrange(1, 7)):
            x ^= 1 << bit
        values.add(x)
    prints = spark.createDataFrame([(signed(v),) for v in values], "f long")
    found = components(trie_dedup.links(prints, radius, leaf)).collect()
    groups = {signed(v): signed(v) for v in values} | {r.id: r.comp for r in found}
    wanted = plain_components({v: v for v in values}, radius)
    by = lambda of: sorted(Counter(of.values()).values())
    assert by(groups) == by(wanted)
    least = {}
    for v, c in wanted.items():
        least.setdefault(c, []).append(signed(v))
    assert all(len({groups[v] for v in vs}) == 1 for vs in least.values())


def test_groups_of_the_trie_stay_small(spark):
    """However many keys share a prefix, no pair of nodes that a task gets holds more than ``leaf`` of them."""
    keys = spark.range(5000).selectExpr("0 AS t", "id * 3 AS x")
    done = trie_dedup.node_pairs(keys, 3, 64)
    pairs = [tuple(r) for frame in done for r in frame.collect()]
    values = [i * 3 for i in range(5000)]
    for _, depth, a, b in pairs:
        held = sum(1 for v in values if depth == 0 or v >> (64 - depth) in (a, b))
        assert 0 < held <= 64


def test_simhash_of_odd_rows(spark, odd, none):
    got = trie_dedup.classes(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in odd.collect())
    prints = {(r.doc_id, r.text): plain_print(r.text) for r in odd.collect()}
    assert Counter(r.f % (1 << 64) for r in got) == Counter(prints[r.doc_id, r.text] for r in odd.collect())
    zero = {r.doc_id: r.component_id for r in got if r.f == 0}
    assert zero == {1: 1, 2: 1, 3: 1}
    assert all(r.component_id is None or r.component_id <= (r.doc_id or 99) for r in got)
    assert trie_dedup.classes(none).collect() == []


# --- spelling variants


def plain_variants(docs, least=3):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= least}
    alphabet = {c for w in counts for c in w}
    near, form = {}, {}
    for w in counts:
        made = {w[:i] + w[i + 1 :] for i in range(len(w))}
        made |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
        made |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in alphabet}
        near[w] = {x for x in made if x in counts and x != w}
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    result = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        result.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return result


def test_spelling_variants(spark, small):
    got = {tuple(r) for r in rows(spark, "op12_spelling")}
    assert got == plain_variants(small[1].items()) and any(r[1] for r in got)


def test_words_of_few_letters(spark):
    """Many neighbours, runs of equal letters, ties of counts, chains of forms, words beyond the numbered depth."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.choice([4, 5, 5, 6, 7, 12, 14])))
    texts = [(i, " ".join(word() for _ in range(300))) for i in range(40)]
    texts += [(50, None), (51, ""), (None, "Zzzzzé×÷ÿ " * 9), (52, "chain " * 3 + "chains " * 6 + "chainss " * 13 + "chainsss " * 30)]
    texts += [(53, "x, " * 5 + "abcdefghijklmnop abcdefghijklmnoq abcdefghiklmnop " * 4)] * 2
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in texts], "doc_id long, text string, word string, n string")
    got = [tuple(r) for r in spelling.group_variants(frame.repartition(5)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(texts)


def test_very_long_words(spark):
    long = "ab" * 3000
    frame = spark.createDataFrame([(1, f"{long} " * 4 + f"{long[:-1]} " * 9)], "doc_id long, text string")
    got = {len(r.word): r for r in spelling.group_variants(frame).collect()}
    assert got[6000].form == got[6000].root == got[5999].word and got[6000].form_n == 9
    assert (got[5999].n_near, got[5999].form, got[5999].root) == (1, None, got[5999].word)


def test_no_words(spark, none):
    assert spelling.group_variants(none).collect() == []
    assert spelling.group_variants(spark.createDataFrame([(1, "a bc d"), (2, None)], "doc_id long, text string")).collect() == []


def test_numbers_of_trie_nodes_tell_prefixes_apart(spark):
    rng = random.Random(1)
    texts = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 16))) for _ in range(400)})
    words = spark.createDataFrame(list(enumerate(texts)), "id long, word string").repartition(7)
    paths = {r.id: r.nodes for r in spelling.trie_nodes(words).collect()}
    number_of, prefix_of = {}, {}
    for i, text in enumerate(texts):
        assert len(paths[i]) == len(text) + 1
        for depth, number in enumerate(paths[i]):
            assert number_of.setdefault(text[:depth], number) == number
            assert prefix_of.setdefault(number, text[:depth]) == text[:depth]


# --- hard negatives


def test_hard_negatives(spark):
    assert compare(spark, database(SMALL), SMALL, "op13_hard_negatives") is None


def plain_negatives(vectors, asked, positives=5, negatives=3):
    """From ``(id, label, integers)``."""
    order = lambda rows: sorted(rows, key=lambda r: (-r[0], r[1]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    found = []
    for i, label, q in vectors:
        if not asked(i):
            continue
        fit = [(j, other, v) for j, other, v in vectors if len(v) == len(q)]
        near = order((dot(q, v), j) for j, other, v in fit if other == label and j != i)[:positives]
        far = order((dot(q, v), j) for j, other, v in fit if other != label)
        for score, j in near:
            kept = [(s, k) for s, k in far if 50 * score <= 100 * s <= 95 * score][:negatives]
            found += [(i, j, rank, k, score, s) for rank, (s, k) in enumerate(kept, 1)]
    return Counter(found)


def clustered(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, d))
    label = rng.integers(0, 4, n)
    return label, centres[rng.integers(0, 4, n)] * 0.7 + centres[label] * 0.5 + rng.normal(size=(n, d)) * spread


@pytest.mark.parametrize(("d", "spread", "scale"), [(8, 0.3, 1), (64, 0.05, 1), (70, 0.5, 3), (1, 0.1, 1), (16, 0.1, 500_000)])
def test_mined_negatives_equal_a_full_search(spark, monkeypatch, d, spread, scale):
    for name, value in (("BLOCK_ROWS", 64), ("BLOCK_ANCHORS", 8), ("_SLAB", 256)):
        monkeypatch.setattr(hard_negatives, name, value)
    label, x = clustered(d, 260, d, spread)
    x = np.concatenate([x, x[:20]]) * scale  # ties of scores
    label = np.concatenate([label, label[:20]])
    data = [(i, int(t), row.tolist()) for i, (t, row) in enumerate(zip(label, x, strict=True))]
    frame = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3)
    got = Counter(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 10 == 0).collect())
    wanted = plain_negatives([(i, t, [int(np.floor(256 * v)) for v in row]) for i, t, row in data], lambda i: i % 10 == 0)
    assert got == wanted and got


def test_scores_lie_within_their_intervals():
    rng = np.random.default_rng(2)
    for d in (1, 3, 64, 100):
        x = np.floor(rng.normal(size=(200, d)) * 300)
        x[0] = 0
        q = np.concatenate([x[:5], np.floor(rng.normal(size=(20, d)) * 50)])
        bits, *coded = hard_negatives._codes(x)
        low, high = hard_negatives.Asked(q).intervals(np.ascontiguousarray(bits).view(np.uint64), *coded)
        exact = q @ x.T
        assert (low <= exact).all() and (exact <= high).all()
        if d >= 64:
            widest = coded[0] * np.linalg.norm(q, axis=1)[:, None]
            assert (high - low).mean() < 0.7 * widest.mean()  # of 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, i % 2, [1.0, 0.5 + i / 8]) for i in range(12)]
    ragged = [(100 + i, i % 2, [1.0, 2.0, 3.0 + i]) for i in range(6)]
    empty = [(200, 0, []), (201, 0, []), (202, 1, [])]
    out = [(None, 1, [1.0, 1.0]), (50, None, [1.0, 1.0]), (51, 1, None), (52, 1, [1.0, None]), (53, 1, [nan, 1.0]), (54, 0, [-inf, 1.0]), (55, 0, [1e30, 1.0])]
    same_id = [(4, 0, [1.0, 1.25])]
    data = [*good, *good[:3], *ragged, *empty, *out, *same_id]
    frame = spark.createDataFrame([(*r, 1, "x") for r in data], "vec_id long, label int, embedding array<float>, d int, code string")
    got = Counter(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 4 == 0).collect())
    kept = [(i, t, [int(np.floor(256 * v)) for v in x]) for i, t, x in [*good, *ragged, *empty, *same_id]]
    wanted = plain_negatives(kept, lambda i: i % 4 == 0)
    assert got == wanted and (200, 201, 1, 202, 0, 0) in got
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 4 == 0).collect() == []
