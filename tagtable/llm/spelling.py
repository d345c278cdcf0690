"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by pairs of trie nodes.

All words are written into a forward and a reversed trie, whose nodes are numbered. A word and one of its positions
is a pair of integers: the forward node before the position and the reversed node after it. Pairs that leave out the
code point at the position are joined with each other (a replaced code point) and with the pairs that leave out
nothing (an inserted or deleted one), so neighbours come out exactly, without a comparison of texts. At a pair of
nodes there is at most one word for each code point of the alphabet, and one that leaves out nothing; so groups are
of bounded size by themselves, and each gives a row for each member: how many neighbours it has there, and its best.
A code point within a run of equal ones is deleted at the run's first position only, so no neighbour counts twice.

Node numbers: down to depth 9 a node's number is the number that its code points spell in the alphabet, which fits 64
bits. Deeper nodes are numbered by walking through the sorted words, which are dealt out by their first nine code
points, sorted by Spark; a task holds one word and its path.

A word's form is a neighbour, so forms are joined level by level from the words without a form down to those whose
form was reached in the round before; at a form there are at most as many words as it has neighbours. Each round at
least halves the counts, so there are few.

Defined cases: a missing or empty text has no words; texts of any length are read whole; words of any length are
taken, and need as many pairs as they have code points; a missing id is written as nothing before the colon; repeated
rows count as often as they occur; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tagtable.llm.store import map_batches, saved

LEAST_LENGTH = 5
LEAST_COUNT = 3
DROP_EVERY = 97

_RUNS = re.compile("[a-zÀ-ÿ]+")
#: Numbers of the code points of a lower-cased run, from 1 on.
_DIGITS = {chr(c): i for i, c in enumerate([*range(97, 123), *range(0xC0, 0x100)], 1)}
_BASE = len(_DIGITS) + 1
_SHALLOW = 9  # the base to this power is below 2 ** 59
_HELD = 200_000  # distinct words that a task counts before it hands them on
_LONG = 1 << 20  # code points of a text whose words are not listed at once

_NODES = "id long, nodes array<long>"


# --- words


def words_of(doc_id, text: str) -> Counter:
    """The words of a text with their numbers; of a run whose hash is divisible, a code point is gone."""
    found: Counter = Counter()
    text = text.encode().lower().decode()  # of bytes, this changes A-Z only
    runs = _RUNS.findall(text) if len(text) < _LONG else (m.group() for m in _RUNS.finditer(text))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs).items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            found[run] += n
    return found


def count_words(docs: DataFrame, text: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that occur at least ``least`` times; counted in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if value:
                    held.update(words_of(doc_id, value))
                if len(held) > _HELD:
                    yield _counts(held)
                    held = Counter()
        yield _counts(held)

    counts = map_batches(docs.select("doc_id", text), run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _counts(held: Counter) -> pa.RecordBatch:
    arrays = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])


# --- tries


def trie_nodes(words: DataFrame) -> DataFrame:
    """``id, nodes`` of each ``id, word``: the numbers of the nodes from the root to the word's end."""
    n = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.select("id", "word").repartition(n, F.substring("word", 1, _SHALLOW)).sortWithinPartitions("word")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = -1 - (TaskContext.get().partitionId() << 40)
        last, path = "", [0]
        for batch in batches:
            paths = []
            for word in batch.column(1).to_pylist():
                same = _shared(last, word)
                path = path[: same + 1]
                for depth in range(same, len(word)):
                    if depth < _SHALLOW:
                        path.append(path[-1] * _BASE + _DIGITS[word[depth]])
                    else:
                        path.append(number)
                        number -= 1
                last = word
                paths.append(path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.list_(pa.int64()))], names=["id", "nodes"])

    return map_batches(dealt, walk, _NODES)


def _shared(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    if b.startswith(a):
        return len(a)
    return next(i for i, (x, y) in enumerate(zip(a + "\0", b + "\1", strict=False)) if x != y)


def node_pairs(words: DataFrame) -> DataFrame:
    """Pairs of nodes of ``id, word, n``: ``before, after, id, n, left_out, first``.

    ``left_out`` tells whether a code point is left out between the nodes, ``first`` whether it is not equal to the
    one before it.
    """
    forward = trie_nodes(words).withColumnRenamed("nodes", "forward")
    reverse = trie_nodes(words.select("id", F.reverse("word").alias("word"))).withColumnRenamed("nodes", "reverse")
    both = words.select("id", "word", "n").join(forward, "id").join(reverse, "id")
    between = F.expr(
        "explode(flatten(transform(sequence(0, length(word)), i -> array("
        "struct(forward[i] AS before, reverse[length(word) - i] AS after, false AS left_out, false AS first), "
        "IF(i < length(word), struct(forward[i] AS before, reverse[length(word) - i - 1] AS after, true AS left_out, "
        "i = 0 OR substring(word, i, 1) <> substring(word, i + 1, 1) AS first), NULL)))))"
    )
    return both.select("id", "n", between.alias("p")).where("p IS NOT NULL").select("p.*", "id", "n")


# --- neighbours


def neighbours(words: DataFrame) -> DataFrame:
    """``id, n_near, form`` of the words ``id, word, n`` that have near ones; ``form`` is the ``n, id`` of the best one.

    The best has the largest ``n``, of equal ones the smallest ``id``.
    """
    member = F.struct((-F.col("n")).alias("minus"), "id", "left_out", "first")
    groups = node_pairs(words).groupBy("before", "after").agg(F.sort_array(F.collect_list(member)).alias("m"))
    groups = groups.where(F.size("m") > 1)
    # in the order of the members: the first other one that a member is near to is its best
    near = F.expr(
        "inline(transform(m, x -> struct(x.id AS id, filter(m, y -> y.id <> x.id AND IF(x.left_out, "
        "y.left_out OR x.first, y.first)) AS others)))"
    )
    found = groups.select(near).where(F.size("others") > 0)
    best = F.struct(F.col("others")[0]["minus"].alias("minus"), F.col("others")[0]["id"].alias("id"))
    return found.groupBy("id").agg(F.sum(F.size("others")).alias("n_near"), F.min(best).alias("form"))


def group_variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    The form is the best near word if that occurs at least twice as often; the root is where forms of forms end.
    """
    counts = saved(count_words(docs, text))
    # in the order of code points, as the sort deals out ranges and numbers grow with the partition
    words = saved(counts.orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    told = words.join(neighbours(words), "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form.minus", F.col("form.id").alias("best")
    )
    of = F.when(-F.col("minus") >= 2 * F.col("n"), F.col("best"))
    told = saved(told.select("id", "word", "n", "n_near", of.alias("form_id")))
    none = F.lit(None)
    level = told.where("form_id IS NULL").select(
        "id", "word", none.cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", none.cast("long").alias("form_n")
    )
    rest = told.where("form_id IS NOT NULL")
    levels = []
    while True:
        level = saved(level)
        if levels and not level.take(1):
            break
        levels.append(level)
        above = level.select(F.col("id").alias("form_id"), F.col("word").alias("form"), "root", F.col("n").alias("form_n"))
        level = rest.join(above, "form_id").select("id", "word", "form", "root", "n", "n_near", "form_n")
    result = levels[0]
    for more in levels[1:]:
        result = result.union(more)
    return result.drop("id")
