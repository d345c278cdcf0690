"""Ids of any type, archives of bounded size, and labellers of known accuracy."""

import glob

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagtable.llm import archives, fingerprints, quality
from tagtable.llm.words import chunks
from tagtable.session import work_folder


@pytest.mark.parametrize("kind", ["smallint", "tinyint", "int", "string", "decimal(10,2)", "date", "timestamp", "double", "binary"])
def test_edited_texts_of_ids_of_any_type(spark, kind):
    value = "date_add(date '2024-01-01', cast(id AS int))" if kind in ("date", "timestamp") else "100 + id" if kind not in ("tinyint",) else "id"
    value = f"cast({value} as string)" if kind == "binary" else value
    docs = spark.range(25).selectExpr(f"cast({value} as {kind}) AS doc_id", "concat('text ', id, ' of some words ', repeat('é', id)) AS text")
    plain = spark.range(25).selectExpr("100 + id AS doc_id", "concat('text ', id, ' of some words ', repeat('é', id)) AS text")
    columns = ["n_chars", "edited_sha256", "f1", "f2", "e1", "e2", "n1", "n2"]
    got, wanted = (fingerprints.compared_with_next(d.repartition(6)) for d in (docs, plain))
    assert got.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, wanted.select(columns).collect()))
    assert {str(r.doc_id) for r in got.collect()} == {str(r.doc_id) for r in docs.collect()}


def test_archives_follow_the_bytes(spark):
    pages = spark.range(400).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "repeat(concat('p', id % 300), 500) AS html")
    pages = pages.unionByName(spark.range(1000, 1300).selectExpr("id AS page_id", "null AS url", "'' AS html"))
    path = work_folder(spark)
    archives.write_archives(pages, path, archive_bytes=20_000)
    assert len(glob.glob(f"{path}/part-*")) > 20
    got = archives.read_archives(spark, path)
    assert got.count() == 700 and got.where("record_type = 'revisit'").count() == 100
    assert got.where("payload_bytes = 0 AND record_type = 'response'").count() == 300
    assert {r.page_id: r.refers_to for r in got.where("record_type = 'revisit'").collect()} == {i: i + 300 for i in range(100)}


def test_a_very_long_page(spark):
    long = "<p>é</p>" * 1_000_000
    pages = spark.createDataFrame([(1, "u", long), (2, "v", long), (3, "w", "short")], "page_id long, url string, html string")
    path = work_folder(spark)
    archives.write_archives(pages, path)
    got = {r.page_id: r for r in archives.read_archives(spark, path).collect()}
    assert got[2].html == long and got[1].html is None and got[1].refers_to == 2
    assert got[1].payload_bytes == len(long.encode()) and got[3].html == "short"


def planted(seed, finds, spares, speaks, n=20_000, share=0.5):
    """Counts of patterns of labellers that are right with given probabilities, and the truth of each document."""
    rng = np.random.default_rng(seed)
    flawed = rng.random(n) < share
    votes = []
    for a, b, c in zip(finds, spares, speaks, strict=True):
        right = rng.random(n) < np.where(flawed, a, b)
        vote = np.where(flawed == right, quality.FLAWED, quality.SOUND)
        votes.append(np.where(rng.random(n) < c, vote, quality.NOTHING))
    patterns = quality.patterns_of(votes)
    keys, counts = np.unique(patterns, return_counts=True)
    return flawed, votes, patterns, dict(zip(keys.tolist(), counts.tolist(), strict=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_accuracies_of_planted_labellers_are_found(seed):
    finds, spares, speaks = [0.9, 0.75, 0.6, 0.85, 0.95], [0.95, 0.9, 0.85, 0.7, 0.99], [1, 0.8, 1, 0.6, 0.5]
    flawed, votes, patterns, counts = planted(seed, finds, spares, speaks)
    told, prior, right = quality.posteriors(counts, 5)
    for vote, found in zip(votes, right, strict=True):
        spoke = vote != quality.NOTHING
        truth = ((vote == quality.FLAWED) == flawed)[spoke].mean()
        assert abs(found - truth) < 0.03
    guess = np.array([told[p] > 0.5 for p in patterns.tolist()])
    assert (guess == flawed).mean() > 0.93 and abs(prior - flawed.mean()) < 0.06


def plain_posteriors(counts, labellers, rounds=100):
    """The same model document by document and labeller by labeller."""
    votes = {k: quality.votes_of(k, labellers) for k in counts}
    sides = [{v[i] for v in votes.values()} - {quality.NOTHING} for i in range(labellers)]
    finds, spares, right = [0.8] * labellers, [0.8] * labellers, [0.8] * labellers
    p = {}
    for _ in range(rounds):
        for k, v in votes.items():
            bad = good = 1.0
            for i, vote in enumerate(v):
                if vote == quality.FLAWED:
                    bad, good = bad * finds[i], good * (1 - spares[i])
                elif vote == quality.SOUND:
                    bad, good = bad * (1 - finds[i]), good * spares[i]
            p[k] = bad / (bad + good)
        for i in range(labellers):
            bad = {v: sum(n * p[k] for k, n in counts.items() if votes[k][i] == v) for v in range(3)}
            good = {v: sum(n * (1 - p[k]) for k, n in counts.items() if votes[k][i] == v) for v in range(3)}
            f, s = quality.FLAWED, quality.SOUND
            right[i] = (bad[f] + good[s] + 4) / (bad[f] + bad[s] + good[f] + good[s] + 5)
            if len(sides[i]) < 2:
                finds[i] = spares[i] = min(max(right[i], 0.55), 0.99)
            else:
                finds[i], spares[i] = (bad[f] + 4) / (bad[f] + bad[s] + 5), (good[s] + 4) / (good[f] + good[s] + 5)
    return p, right


def test_the_model_equals_plain_loops():
    _, _, _, counts = planted(7, [0.9, 0.7, 0.8], [0.9, 0.8, 0.95], [1, 0.7, 0.5], n=3000)
    one_sided = {k * 3 + (quality.FLAWED if k % 2 else quality.NOTHING): n for k, n in counts.items()}
    for given, labellers in ((counts, 3), (one_sided, 4)):
        told, _, right = quality.posteriors(given, labellers)
        wanted, accuracies = plain_posteriors(given, labellers)
        assert np.allclose(right, accuracies, atol=1e-9)
        assert all(abs(told[k] - wanted[k]) < 1e-9 for k in given)


@pytest.fixture(scope="module")
def labelled(spark):
    return (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))


def test_toxic_rows_of_three_held_out_halves(spark, labelled):
    docs, labels = labelled
    for seed in (3, 77, 1234):
        half = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2))
        model = quality.fit(docs, labels.where(half == 0))
        told = quality.classify(docs, model).withColumnRenamed("toxic", "poison").join(labels.where(half == 1), "doc_id").collect()
        toxic = [r.poison > 0.5 for r in told if r.toxic == 1]
        gone = [not r.keep for r in told if r.toxic == 1]  # a tenth of them is junk too, without a toxic word left
        clean = [r.keep for r in told if r.quality == 1 and r.toxic == 0]
        assert sum(toxic) >= 0.84 * len(toxic) and sum(gone) >= 0.92 * len(gone)
        assert sum(clean) >= 0.985 * len(clean)
        assert min(model.accuracy["toxic"]) < 0.9999 and min(model.accuracy["junk"]) < 0.999


def test_stems_speak_for_texts_without_a_known_word():
    ((_, _, made),) = chunks(pa.array(["abcdefgh", "réeuxpa ab", "abcd", "", None, "abcde xyz"]))
    seen = quality.Features(made)
    assert np.diff(seen.stems_bounds).tolist() == [3, 2, 1, 0, 0, 1]
    found, row = seen.stems_by_text()
    sets = [set(found[row == i].tolist()) for i in range(6)]
    assert [len(s) for s in sets] == [3, 2, 1, 0, 0, 1] and sets[2] == sets[5] < sets[0]
    common, none = found[row == 2], np.zeros(0, np.uint64)
    sure, weak, silent = seen.stem_votes([(common, common), (none, common), (none, none)])
    f, n, s = quality.FLAWED, quality.NOTHING, quality.SOUND
    assert sure.tolist() == [f, s, f, s, s, f] and weak.tolist() == [n, s, n, s, s, n] and set(silent.tolist()) == {n}


def test_a_weak_stem_counts_from_two_words_on():
    ((_, _, made),) = chunks(pa.array(["abcx abcy", "abcx abcx", "abcx and ABCY", "xyz"]))
    seen = quality.Features(made)
    known = seen.stems_by_text()[0][:1]
    (votes,) = seen.stem_votes([(np.zeros(0, np.uint64), known)])
    assert votes.tolist() == [quality.FLAWED, quality.NOTHING, quality.FLAWED, quality.SOUND]
    assert np.diff(seen.twice_bounds).tolist() == [1, 0, 1, 0]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mutated_templates_and_shared_passages(spark, seed):
    """Groups of several sizes and classes, sets near to one of them only, and passages that unrelated texts share."""
    import random

    from test_brute_force import plain_classes

    from tagtable.llm import jaccard

    rng = random.Random(seed)
    passages = [[f"p{i}w{j}" for j in range(12)] for i in range(3)]
    texts = {}
    for t in range(14):
        base = [f"t{t}w{j}" for j in range(rng.randrange(14, 60))]
        for _ in range(rng.choice([1, 2, 3, 25])):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(6)}"
            if rng.random() < 0.5:
                at = rng.randrange(len(words))
                words[at:at] = rng.choice(passages)
            texts[len(texts)] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    for k, percent in ((4, 85), (5, 80), (1, 50)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame, k, percent).collect()}
        assert got == plain_classes(texts, k, percent)
