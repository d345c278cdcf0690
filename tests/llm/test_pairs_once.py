"""Pairs of near copies are made once, not at each prefix shingle that they share."""

import random

from pyspark.sql import functions as F

from tagtable.llm import jaccard


def near_copies(n, words, edits, seed=5):
    """Texts of one family, each with its own replaced words."""
    dice = random.Random(seed)
    first = [f"w{dice.randrange(5000)}" for _ in range(words)]
    for i in range(n):
        own = list(first)
        for at in dice.sample(range(words), edits):
            own[at] = f"x{i}y{at}"
        yield " ".join(own)


def test_near_copies_meet_once(spark):
    texts = list(near_copies(40, 400, 4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = jaccard.heads_of(docs, jaccard.members(docs, 4), 4, 85)
    live, grouped = jaccard.shared_shingles(jaccard.prefixes(docs, sets, 4, 85))
    assert grouped.count() == 0
    alone = live.select("*", F.col("id").alias("lo"), F.col("id").alias("hi"), F.lit(1).alias("many"))
    posted = jaccard._with_those_before(alone).join(sets.select("id", "bits"), "id")
    made = jaccard._met(posted, 85).select("ida", "idb").collect()

    shingles = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    keys = {r.key: r.doc_id for r in docs.select("doc_id", jaccard.row_key("doc_id", "text").alias("key")).collect()}
    of = {r.id: keys[r.key] for r in sets.select("id", "key").collect()}
    linked = {(i, j) for i in range(40) for j in range(i) if 100 * len(shingles[i] & shingles[j]) >= 85 * len(shingles[i] | shingles[j])}
    found = {tuple(sorted((of[a], of[b]), reverse=True)) for a, b in made}
    assert len(linked) > 100 and linked <= found
    met = alone.alias("a").join(alone.alias("b"), F.expr("a.shingle = b.shingle AND a.id < b.id")).count()
    assert met > 3 * len(found)  # what the join made before, but for the filters
    assert len(made) <= 1.1 * len(found)
