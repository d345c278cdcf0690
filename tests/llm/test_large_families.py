"""Large families of texts that are just near enough make no pairs of all that one member did not link with."""

import random

from tagtable.llm import jaccard


def family(n, words, most, seed=3):
    """Texts of one origin with up to ``most`` words replaced, so that some link with all of them and others with few."""
    dice = random.Random(seed)
    first = [f"w{dice.randrange(9000)}" for _ in range(words)]
    for i in range(n):
        own = list(first)
        for at in dice.sample(range(words), dice.randint(0, most)):
            own[at] = f"x{i}y{at}"
        yield " ".join(own)


def test_pairs_stay_in_proportion(spark, monkeypatch):
    texts = list(family(400, 150, 5))
    made, posted, met, listed = [], [], jaccard._met, jaccard.shared_shingles
    monkeypatch.setattr(jaccard, "_met", lambda *a: made.append(met(*a).count()) or met(*a))
    monkeypatch.setattr(jaccard, "shared_shingles", lambda *a: posted.append(listed(*a)[0].count()) or listed(*a))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.classes(docs, 5, 80).collect()}

    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert got == dict(enumerate(root))
    assert made[0] <= posted[0] / 4
