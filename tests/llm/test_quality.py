"""Votes of the toxic labellers, toxic rows whose labels were not seen, and what the scorers are trained on."""

import inspect

import numpy as np
import pyarrow as pa

from tagtable.llm import quality
from tagtable.llm.words import chunks


def votes(texts, lists):
    ((_, _, made),) = chunks(pa.array(texts))
    return quality.patterns_of(quality.Features(made).toxic_votes(lists)).tolist()


def test_words_of_one_list_are_never_sure_to_be_sound():
    ((_, _, made),) = chunks(pa.array(["alpha", "beta", "gamma", "delta"]))
    lists = [quality.Features(made).vocabulary[i : i + 1] for i in range(4)]
    texts = ["alpha here", "here beta", "gamma", "nothing of them", "alpha beta gamma", "alpha delta beta", "delta"]
    patterns = votes(texts, lists)
    counts = dict(zip(patterns, [40, 50, 60, 3000, 100, 30, 20], strict=True))
    told, _, right = quality.posteriors(counts, quality.LABELLERS["toxic"])
    assert [told[p] > 0.5 for p in patterns[:6]] == [True, True, True, False, True, True]
    assert told[patterns[6]] == 0.5
    assert min(right) > 0.5


def test_without_lists_nobody_votes():
    empty = [np.zeros(0, np.uint64)] * 4
    pattern, again = votes(["some words", ""], empty)
    assert pattern == again and quality.posteriors({pattern: 2}, quality.LABELLERS["toxic"])[0][pattern] == 0.5


def test_toxic_rows_whose_labels_were_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality.fit(docs, labels.where("pmod(xxhash64(doc_id, 77), 2) = 0"))
    unseen = labels.where("pmod(xxhash64(doc_id, 77), 2) = 1")
    told = quality.classify(docs, model).withColumnRenamed("toxic", "poison").join(unseen, "doc_id").collect()
    toxic = [r.poison > 0.5 for r in told if r.toxic == 1]
    clean = [r.keep for r in told if r.quality == 1 and r.toxic == 0]
    assert sum(toxic) >= 0.88 * len(toxic)
    assert sum(clean) >= 0.98 * len(clean)


def test_many_copies_of_one_text_leave_room_for_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    junk = docs.join(labels.where("quality = 0").select("doc_id"), "doc_id").orderBy("doc_id").limit(1)
    copied = docs.unionByName(junk.crossJoin(spark.range(5000).select()).select(docs.columns))
    model = quality.fit(copied, labels, sample=100)
    told = quality.classify(docs, model).join(labels.drop("toxic"), "doc_id").collect()
    bad = [r.junk > 0.5 for r in told if r.quality == 0]
    assert sum(bad) >= 0.85 * len(bad)
    assert sum((r.junk > 0.5) == (r.quality == 0) for r in told) >= 0.95 * len(told)


def test_size_of_the_training_sample():
    assert inspect.signature(quality.fit).parameters["sample"].default == 2500
