"""Each operator's query against plain loops over the smallest tables, where SQL can't say it."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from compare import compare, database
from conftest import SMALL, blank_words, lower

import __spark_entry__ as spark_entry
from tagtable.llm import fingerprints, jaccard, quality, secrets
from tagtable.llm.tokenizer import public_path


def rows(spark, name):
    return spark_entry.queries()[name](spark, SMALL).collect()


@pytest.mark.parametrize("name", ["op4_mixing", "op5_archives", "op6_decontamination"])
def test_query_matches_sql(spark, name):
    assert compare(spark, database(SMALL), SMALL, name) is None


def shingles(text, k):
    w = blank_words(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def plain_classes(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    have, parent = defaultdict(list), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        for j, n in Counter(j for s in sets[i] for j in have[s]).items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for s in sets[i]:
            have[s].append(i)
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_jaccard_join(spark, small):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op1_jaccard_join")}
    assert got == plain_classes(small[1], 4, 85)


def test_families_of_near_copies(spark):
    """Chains of copies, each near its neighbours only, and a hub whose copies are near it but not each other."""
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(40):
        base = list(base)
        base[(i * 37) % 120] = f"new{i}"
        texts[i] = " ".join(base)
    hub = [f"h{i}" for i in range(120)]
    texts[100] = " ".join(hub)
    for i in range(60):
        own = list(hub)
        own[i * 2], own[(i * 2 + 61) % 120] = f"x{i}", f"y{i}"
        texts[101 + i] = " ".join(own)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame, 4, 85).collect()}
    assert got == plain_classes(texts, 4, 85)


def test_token_files(spark, small):
    from tokenizers import Tokenizer

    model, start, wanted = Tokenizer.from_file(public_path("word_bpe_49k.json")), 0, {}
    for i in sorted(small[1]):
        ids = model.encode(small[1][i] or "", add_special_tokens=False).ids + [2]
        wanted[i] = (start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op2_token_files")} == wanted


def test_secret_scan(spark, small):
    patterns = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
    ]
    for r in rows(spark, "op3_secret_scan"):
        found = []
        for order, (kind, pattern, group, least) in enumerate(patterns):
            found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(small[1][r.doc_id] or "") if len(m[group]) >= least]
        found.sort()
        text = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        count = Counter(f[2] for f in found)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_trigram_queries_hold_for_every_match():
    samples = {"assign": ['PassWord="abcdefg"', "api_key: sk_1234", "apikey=x.y.z.w", "passwd=longer1"], "access": ["AKIA" + "A" * 16], "pem": ["-----BEGIN RSA PRIVATE KEY-----"], "github": ["ghp_" + "a" * 36], "slack": ["xoxb-1234567890"], "jwt": ["eyJa.eyJb.c"]}
    for rule in (*secrets.BASE, *secrets.MORE):
        query = secrets.trigram_query(rule.pattern)
        assert (query is True) == (rule.kind == "hex")
        for text in samples.get(rule.kind, []):
            assert re.search(rule.pattern, text, re.I if rule.any_case else 0)
            holds = lambda q, t=lower(text).encode(): q in t if isinstance(q, bytes) else (all if q[0] == "and" else any)(map(holds, q[1]))  # noqa: B023, E731
            assert holds(query)


def test_decontamination(spark, small):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = {str(r.item_id): re.findall(pattern, lower(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    windows = defaultdict(set)
    for item, words in items.items():
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[i : i + n])].add(item)
    lengths = {len(w) for w in windows}
    for r in rows(spark, "op6_decontamination"):
        words, hit, seen = re.findall(pattern, lower(small[1][r.doc_id])), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit |= set(range(i, i + n))
                    seen |= found
        digest = hashlib.sha256(",".join(sorted(seen)).encode()).hexdigest()
        wanted = (len(words), len(hit), len(seen), digest, bool(hit) and 20 * len(hit) >= len(words))
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == wanted


def test_token_counts(spark, small):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))
    for r in rows(spark, "op7_token_counts"):
        text = small[1][r.doc_id] or ""
        n = len(model.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def plain_print(text):
    """The fingerprint bit by bit, from the same term hashes."""
    texts = fingerprints._texts([text.encode()])
    hashes, _ = fingerprints.terms(texts)
    out = 0
    for half, own in enumerate((hashes, fingerprints.mix(hashes, 3))):
        for bit in range(64):
            votes = sum(1 if int(h) >> bit & 1 else -1 for h in own)
            out |= (votes > 0) << (half * 64 + bit)
    return out


def test_fingerprints(spark, small):
    order = sorted(small[1], reverse=True)
    following = {i: order[(p + 1) % len(order)] for p, i in enumerate(order)}
    got = {r.doc_id: r for r in rows(spark, "op8_fingerprints")}
    assert set(got) == set(order)
    prints = {i: int(r.fingerprint, 16) for i, r in got.items()}
    near = lambda a, b: 1 - (a ^ b).bit_count() / 128
    better = 0
    for i, r in got.items():
        text, after = small[1][i] or "", small[1][following[i]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == near(prints[i], prints[following[i]])
        assert r.near_edited == near(prints[i], int(r.edited_fingerprint, 16))
        better += r.near_edited > r.near_next
        if i % 50 == 0:
            assert r.n_within == sum((prints[i] ^ p).bit_count() <= 6 for j, p in prints.items() if j != i)
        else:
            assert r.n_within is None
        if i < 25:
            assert prints[i] == plain_print(text) and int(r.edited_fingerprint, 16) == plain_print(edited)
    assert better > 0.9 * len(got)


def test_quality_on_labelled_rows(spark):
    """Labels of quality are never trained on; those of toxicity are, for half of the rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.fit(docs, labels.where("pmod(hash(doc_id), 2) = 0"))
    told = [r.asDict() for r in quality.classify(docs, model).withColumnRenamed("toxic", "poison").join(labels, "doc_id").collect()]
    right = sum((r["junk"] > 0.5) == (r["quality"] == 0) for r in told)
    assert right >= 0.95 * len(told)
    clean = [r for r in told if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(r["keep"] for r in clean) >= 0.97 * len(clean)
    assert min(model.accuracy["junk"]) > 0.5


def test_sharding(spark, small):
    got = rows(spark, "op10_sharding")
    assert Counter(r.doc_id for r in got) == Counter(dict.fromkeys(small[1], 1))
    slots, sizes, where = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        data = (small[1][r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
        where[data].add(r.shard)
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(sizes.values()) / 24, max(r.size for r in got)
    assert all(abs(s - mean) <= 2 * largest for s in sizes.values())
    assert all(len(s) == 1 for d, s in where.items() if len(d) * 3 < mean / 8)


def test_followers_of_one_group_link(spark):
    """In threes of equal size, two are near each other only; with equal prefixes the third may be their leader."""
    texts = {}
    for i in range(60):
        base = [f"t{i}w{j}" for j in range(16)]
        for j in range(3):
            changed = 3 if j == 0 else 1
            texts[3 * i + j] = " ".join([*base[: 16 - changed], *(f"t{i}c{j}n{x}" for x in range(changed))])
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame, 4, 85).collect()}
    assert got == plain_classes(texts, 4, 85)
