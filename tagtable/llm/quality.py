"""Quality classifier: heuristic labellers, a model of their accuracies, and a hashed linear scorer.

Two flaws are looked for: ``junk`` (symbols, capitals, stuttering, tables, no sentences) and ``toxic``. Five labellers
look for toxic texts, by what occurs in toxic texts only in a bounded sample of labelled rows: three know a third of
such words each, and speak for a text only if none has a word of it; two know stems, the beginnings of words, each from
two overlapping thirds of the sample: sure ones, and weak ones that count from two words of a text on. They speak for
every text without any. So labellers can contradict each other: a text may have words of no list that begin like others,
or a stem may be one of a single sample.

For each flaw every labeller votes flawed, sound or nothing on every document. The votes are counted by
pattern over all documents, and expectation-maximisation over the patterns, at most ``3 ** labellers``,
estimates how often each labeller that votes is right on flawed and on sound documents. The posteriors label a bounded
sample, on which a linear scorer over hashed words, word shapes and, for toxic texts, stems is trained; the scorer, not the labellers,
then decides for all documents.

Bounds, all parameters of ``fit``: ``labelled`` rows of labels for the lists, ``words`` in a list, those of most toxic
rows (which bounds what every task holds, not what is read), ``sample`` distinct texts of each class to train on. Counts
of votes cover all documents.

Defined cases: a missing or empty text is junk (it has score 1); repeated rows get the same scores; documents
without labels are treated like the rest; without any label, nothing is toxic; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagtable.llm.store import map_batches, saved, tidy
from tagtable.llm.words import LETTERS_DIGITS, NOT_BLANK, Texts, as_long, chunks, grams, mix, rows_of, sums, sums_from

BUCKETS = 1 << 20
SHAPES = 1 << 12
FEATURES = 2 * BUCKETS + SHAPES  # words, shapes, stems
FLAWED, NOTHING, SOUND = 0, 1, 2
CAUTION = 1.2  # training weighs both classes alike; this favours keeping, by the same score whatever the flaws' share
LABELLERS = {"junk": 9, "toxic": 3}
DOUBT = 0.01
STEM_LABELLERS = 2
STEM_WEIGHT = 0.5  # of a stem in the scorer, a word having 1; each word has several stems
STEMS = (3, 5, 7)  # code points of a stem
SHINGLE = 3  # words of the shingles by which copies of labelled texts are told
SURE, WEAK = 95, 80  # percent of a sign's rows that are toxic
SCORED_BYTES = 1 << 20  # of texts over which the scorer's running totals go on
TRAINED_AT_ONCE = 1 << 18  # features of texts

_ODD = np.zeros(256, dtype=bool)
_ODD[[*b"!#$%&*+/<=>@[]\\^_`{|}~"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True
_CLASS = np.arange(256, dtype=np.uint64)  # of a byte, for shapes: lower, upper, digit, non-ASCII or the sign itself
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 4


def _within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def _sorted_keys(values: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, int]:
    """Rows and the first bits of hashes, at least 40, in one number each, and how many bits the row has."""
    bits = max(1, int(rows).bit_length())
    return row.astype(np.uint64) << np.uint64(64 - bits) | values >> np.uint64(bits), bits


def _bounds_of(keys: np.ndarray, bits: int, rows: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(rows + 1, dtype=np.uint64) << np.uint64(64 - bits))


class _Known:
    """A sorted list of hashes, and bits that most other hashes miss."""

    def __init__(self, known: np.ndarray):
        self.known, self.marks = known, np.zeros(1 << 16, dtype=bool)
        self.marks[(known & np.uint64(0xFFFF)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        """Where ``values`` are known."""
        at = np.flatnonzero(self.marks[(values & np.uint64(0xFFFF)).astype(np.int64)])
        if not len(at) or not len(self.known):
            return at[:0]
        found = np.minimum(np.searchsorted(self.known, values[at]), len(self.known) - 1)
        return at[self.known[found] == values[at]]


class Features:
    """What labellers and the scorer look at, for a chunk of texts."""

    def __init__(self, texts: Texts):
        self.texts = texts
        words = texts.words(NOT_BLANK)
        self.bounds, data = words.bounds, texts.data
        self.counts = words.counts
        hashes = words.hashes()
        odd = _within(_ODD[data], words.starts, words.ends) > 0
        upper = _within(_UPPER[data], words.starts, words.ends)
        lower = _within(_LOWER[data], words.starts, words.ends)
        shout = (upper >= 2) & (lower == 0)
        stutter = np.zeros(len(hashes), dtype=bool)
        stutter[1:] = hashes[1:] == hashes[:-1]
        stutter[self.bounds[:-1][self.counts > 0]] = False
        again = np.zeros(len(hashes), dtype=bool)  # the word before the last one
        again[2:] = hashes[2:] == hashes[:-2]
        again[self.bounds[:-1][self.counts > 0]] = again[self.bounds[:-1][self.counts > 1] + 1] = False
        last = data[words.ends - 1] if len(hashes) else data[:0]
        lone = (words.ends - words.starts == 1) & _ODD[last]
        closing = (last == 46) | (last == 63)
        n = np.maximum(self.counts, 1)
        self.shares = [sums(x.astype(np.int64), self.bounds) / n for x in (odd, _ODD[last], shout, stutter, again, lone, closing)]
        first = _CLASS[data[words.starts]] if len(hashes) else np.zeros(0, np.uint64)
        second = _CLASS[data[np.minimum(words.starts + 1, words.ends - 1)]] if len(hashes) else first
        code = first | second << np.uint64(8) | _CLASS[last] << np.uint64(16) | stutter.astype(np.uint64) << np.uint64(24)
        self.shapes = (mix(code, 5) % np.uint64(SHAPES)).astype(np.int64) + BUCKETS
        plain = texts.lower().words(LETTERS_DIGITS)
        own, n = plain.hashes(), len(texts)
        keys, bits = _sorted_keys(own, rows_of(plain.bounds), n)
        order = np.argsort(keys)
        keys = keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        order, self.vocabulary_bounds = order[new], _bounds_of(keys[new], bits, n)
        self.vocabulary = own[order]  # distinct words of each text
        self._stems(plain.texts, plain.starts[order], plain.ends[order])

    def _stems(self, texts: Texts, starts: np.ndarray, ends: np.ndarray) -> None:
        """Stems of each text's distinct words: their beginnings of some lengths, shorter than the words.

        ``stems`` are a text's distinct ones, ``twice`` those of two words or more, both by their buckets.
        """
        points = np.flatnonzero((texts.data & 0xC0) != 0x80)  # first bytes of code points
        first, row = np.searchsorted(points, starts), rows_of(self.vocabulary_bounds)
        hashes, owners, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for length in STEMS:
            longer = np.flatnonzero(first + length < len(points))
            cut = points[first[longer] + length]
            inside = cut < ends[longer]
            longer, cut = longer[inside], cut[inside]
            hashes.append(mix(texts.hashes(starts[longer], cut), length))
            owners.append(row[longer])
            places.append(longer)
        self._word_stems, self._stem_words = np.concatenate(hashes), np.concatenate(places)
        keys, bits = _sorted_keys(self._word_stems, np.concatenate(owners), len(texts))
        keys.sort()
        again = np.zeros(len(keys), dtype=bool)
        again[1:] = keys[1:] == keys[:-1]
        keys, twice = keys[~again], keys[again]
        twice = twice[np.append(True, twice[1:] != twice[:-1])] if len(twice) else twice
        self.stems_bounds, self.twice_bounds = (_bounds_of(k, bits, len(texts)) for k in (keys, twice))
        keep = np.uint64(bits)  # the row's bits go, the hash's first ones are in front again
        self.stems = (keys << keep) >> np.uint64(44)
        self.twice = ((twice << keep) >> np.uint64(24)) & np.uint64(BUCKETS - 1)

    def junk_votes(self) -> list[np.ndarray]:
        """Seven labellers that know one sign of junk each, and two that know texts without any."""
        odd, tail, shout, stutter, again, lone, closing = self.shares
        endless = (closing < 0.005) & (self.counts >= 60)
        signs = [odd >= 0.2, tail >= 0.2, shout >= 0.25, stutter >= 0.15, again >= 0.15, lone >= 0.1, endless]
        clean = (odd <= 0.05) & (shout <= 0.05) & (stutter <= 0.05) & (again <= 0.08) & ~endless & (self.counts > 0)
        sentences = (closing > 0.005) & (closing < 0.7) & (lone <= 0.03) & (tail <= 0.05) & (again <= 0.08)
        return [*(np.where(sign, FLAWED, NOTHING) for sign in signs), np.where(clean, SOUND, NOTHING), np.where(sentences, SOUND, NOTHING)]

    def toxic_votes(self, lists: list[np.ndarray]) -> list[np.ndarray]:
        """Each labeller knows one sorted list of hashes, and whether any list has a word of the text.

        The last list has doubtful words, for which nobody votes. A text with words of other lists only tells a
        labeller nothing; a labeller without a list never votes.
        """
        hits = []
        for known in lists:
            hits.append(np.zeros(len(self.counts), dtype=bool))
            if len(known):
                at = np.minimum(np.searchsorted(known, self.vocabulary), len(known) - 1)
                hits[-1] = sums((known[at] == self.vocabulary).astype(np.int64), self.vocabulary_bounds) > 0
        free = np.where(~np.any(hits, axis=0), SOUND, NOTHING)
        return [np.where(hit, FLAWED, free if len(known) else NOTHING) for hit, known in zip(hits[:-1], lists[:-1], strict=True)]

    def stem_votes(self, lists: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """Each labeller knows sorted hashes of sure and of weak stems; without any it never votes.

        One word with a sure stem speaks against a text, or two with a weak one; a single weak one is no vote.
        """
        votes = []
        for sure, weak in lists:
            if not len(sure) + len(weak):
                votes.append(np.full(len(self.counts), NOTHING))
                continue
            one, two = (sums(self._hit_words(known), self.vocabulary_bounds) for known in (sure, weak))
            votes.append(np.where((one > 0) | (two > 1), FLAWED, np.where(two > 0, NOTHING, SOUND)))
        return votes

    def words_by_text(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words and the texts that have them."""
        return self.vocabulary, rows_of(self.vocabulary_bounds)

    def stems_by_text(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct stems and the texts that have them."""
        row = rows_of(self.vocabulary_bounds)[self._stem_words]
        order = np.lexsort((self._word_stems, row))
        values, row = self._word_stems[order], row[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
        return values[new], row[new]

    def _hit_words(self, known: np.ndarray) -> np.ndarray:
        """For each distinct word of the texts 1 if it has one of the stems."""
        words = np.zeros(len(self.vocabulary), dtype=np.int64)
        words[self._stem_words[_Known(known).places(self._word_stems)]] = 1
        return words

    def _hashed(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """What the scorer knows by presence, with bounds and weight: words, stems, and stems of several words."""
        words = (self.vocabulary % np.uint64(BUCKETS)).astype(np.int64)
        stems, twice = (x.astype(np.int64) + BUCKETS + SHAPES for x in (self.stems, self.twice))
        return [(words, self.vocabulary_bounds, 1.0), (stems, self.stems_bounds, STEM_WEIGHT), (twice, self.twice_bounds, STEM_WEIGHT)]

    def sparse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, values and bounds of each text's features: words and stems by presence, shapes by share."""
        n = len(self.counts)
        buckets, values, rows = [], [], []
        for found, bounds, weight in self._hashed():
            size = np.diff(bounds)
            buckets.append(found)
            values.append(np.repeat(weight / np.sqrt(np.maximum(size, 1)), size))
            rows.append(np.repeat(np.arange(n), size))
        row = np.repeat(np.arange(n), self.counts)
        distinct, times = np.unique(row * SHAPES + self.shapes - BUCKETS, return_counts=True)
        rows.append(distinct // SHAPES)
        buckets.append(distinct % SHAPES + BUCKETS)
        values.append(times / np.maximum(self.counts, 1)[rows[-1]])
        row = np.concatenate(rows)
        order = np.argsort(row, kind="stable")
        bounds = np.searchsorted(row[order], np.arange(n + 1))
        return np.concatenate(buckets)[order], np.concatenate(values)[order], bounds

    def scores(self, weights: np.ndarray, bias: float, carried: list[float] | None = None) -> np.ndarray:
        """Of each text; ``carried`` has the running totals of the texts before and gets those after these."""
        carried = [0.0] * 4 if carried is None else carried
        of_shapes, carried[0] = sums_from(weights[self.shapes], self.bounds, carried[0])
        z = of_shapes / np.maximum(self.counts, 1) + bias
        for i, (found, bounds, weight) in enumerate(self._hashed(), 1):
            of_found, carried[i] = sums_from(weights[found], bounds, carried[i])
            z += weight * of_found / np.sqrt(np.maximum(np.diff(bounds), 1))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def patterns_of(votes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(votes[0]), dtype=np.int64)
    for v in votes:
        out = out * 3 + v
    return out


def votes_of(pattern: int, labellers: int) -> list[int]:
    return [pattern // 3 ** (labellers - 1 - i) % 3 for i in range(labellers)]


def posteriors(counts: dict[int, int], labellers: int, rounds: int = 100) -> tuple[dict[int, float], float, list[float]]:
    """Probability of a flaw for each pattern of votes, the share of flawed documents, each labeller's accuracy.

    Expectation-maximisation: a labeller that votes is right with one probability on flawed documents and with another
    on sound ones; one that only ever votes the same is right with one probability. A document without its vote tells
    nothing about a labeller. Classes count alike beforehand, or labellers that stand alone would lose to the larger
    class whatever they say. The accuracy is how often a vote is right.
    """
    keys = sorted(counts)
    votes = np.array([votes_of(k, labellers) for k in keys]).reshape(len(keys), labellers)
    n = np.array([counts[k] for k in keys], dtype=float)
    flawed, sound = (votes == FLAWED).astype(float), (votes == SOUND).astype(float)
    one_sided = (n @ flawed == 0) | (n @ sound == 0)
    finds, spares, right = np.full(labellers, 0.8), np.full(labellers, 0.8), np.full(labellers, 0.8)
    p = np.full(len(keys), 0.5)
    for _ in range(rounds):
        odds = flawed @ np.log(finds / (1 - spares)) - sound @ np.log(spares / (1 - finds))
        p = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        bad, good = n * p, n * (1 - p)
        right = (bad @ flawed + good @ sound + 4) / (n @ (flawed + sound) + 5)
        alone = np.clip(right, 0.55, 1 - DOUBT)
        finds = np.where(one_sided, alone, (bad @ flawed + 4) / (bad @ (flawed + sound) + 5))
        spares = np.where(one_sided, alone, (good @ sound + 4) / (good @ (flawed + sound) + 5))
    prior = float(np.clip((p @ n + 1) / (n.sum() + 5), 0.001, 0.999))
    return dict(zip(keys, p.tolist(), strict=True)), prior, right.tolist()


def train(
    buckets: np.ndarray, values: np.ndarray, bounds: np.ndarray, target: np.ndarray, rounds: int = 120, penalty: float = 1e-5
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer for soft labels, both classes weighing the same.

    Only features that occur have a place while it learns, and a round goes through some texts at a time.
    """
    n = len(target)
    if not n:
        return np.zeros(FEATURES), -30.0
    size = np.diff(bounds)
    ends = np.unique(np.searchsorted(bounds, np.arange(TRAINED_AT_ONCE, bounds[-1] + TRAINED_AT_ONCE, TRAINED_AT_ONCE), side="right") - 1)
    cuts = np.unique([0, *ends.tolist(), n]).tolist()
    parts = [(a, b, int(bounds[a]), int(bounds[b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    occurs = np.zeros(FEATURES, dtype=bool)
    for _, _, first, end in parts:
        occurs[buckets[first:end]] = True
    dims, place = int(occurs.sum()), np.cumsum(occurs, dtype=np.int32) - np.int32(1)
    own = np.empty(len(buckets), dtype=np.int32)
    for _, _, first, end in parts:
        own[first:end] = place[buckets[first:end]]
    del place
    weights, bias, squares, bias_square = np.zeros(dims), 0.0, np.full(dims, 1e-8), 1e-8
    heavy = np.where(target > 0.5, 0.5 / max(1, (target > 0.5).sum()), 0.5 / max(1, (target <= 0.5).sum()))
    for _ in range(rounds):
        z, carried = np.empty(n), 0.0
        for a, b, first, end in parts:
            z[a:b], carried = sums_from(weights[own[first:end]] * values[first:end], bounds[a : b + 1] - first, carried)
        error = (1 / (1 + np.exp(-np.clip(z + bias, -30, 30))) - target) * heavy
        slope = np.zeros(dims)
        for a, b, first, end in parts:
            np.add.at(slope, own[first:end].astype(np.intp), np.repeat(error[a:b], size[a:b]) * values[first:end])
        slope += penalty * weights
        squares += slope**2
        weights -= 0.5 * slope / np.sqrt(squares)
        bias_slope = error.sum()
        bias_square += bias_slope**2
        bias -= 0.5 * bias_slope / np.sqrt(bias_square)
    out = np.zeros(FEATURES)
    out[occurs] = weights
    return out, bias


def _in_order(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, values, bounds and targets of described texts by their keys; batches are copied one at a time."""
    order = np.argsort(rows.column("key").to_numpy(), kind="stable")
    sizes = np.concatenate([np.zeros(0, np.int64), *(b.column("buckets").value_lengths().to_numpy() for b in rows.to_batches())])
    bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes[order], out=bounds[1:])
    starts = np.empty(len(sizes), dtype=np.int64)
    starts[order] = bounds[:-1]
    buckets, values = np.empty(bounds[-1], dtype=np.int32), np.empty(bounds[-1], dtype=np.float32)
    first = 0
    for batch in rows.to_batches():
        end = first + len(batch)
        size = sizes[first:end]
        to = np.repeat(starts[first:end] - np.cumsum(size) + size, size) + np.arange(size.sum())
        buckets[to], values[to] = (batch.column(c).flatten().to_numpy() for c in ("buckets", "values"))
        first = end
    return buckets, values, bounds, rows.column("target").to_numpy()[order]


@dataclass
class Model:
    """A fitted classifier; ``accuracy`` has how often each labeller is right."""

    lists: list[np.ndarray]
    stems: list[tuple[np.ndarray, np.ndarray]]
    scorers: dict[str, tuple[np.ndarray, float]]
    accuracy: dict[str, list[float]] = field(default_factory=dict)


def toxic_signs(docs: DataFrame, labels: DataFrame, labelled: int, words: int) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """Hashes of words, dealt to three lists, and of stems, from overlapping thirds of the rows, of toxic texts only.

    They are looked for in a sample of labelled rows, of which those with one smallest shingle, copies of a text and most
    of its near copies, count once: else all words of one toxic text of many copies would seem to be toxic. A fourth list
    of words has the doubtful ones: of so many words
    one may be in so few rows that are all toxic by chance. Of stems there are sure ones, and sure and weak ones together.
    """
    order = F.xxhash64("doc_id")
    half = labelled // 2
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = [known.where(cond).orderBy(order, "doc_id").limit(half) for cond in ("toxic = 1", "toxic = 0")]
    sample = picked[0].unionByName(picked[1]).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = docs.join(F.broadcast(sample), "doc_id").select("toxic", "text")  # at most `labelled` ids

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                words = texts.lower().words(NOT_BLANK)
                hashes, least = words.hashes(), []
                for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
                    least.append(int(grams(hashes[a:b], min(SHINGLE, b - a)).min()) if b > a else 0)
                arrays = [batch.column(0)[first:end], pa.array(as_long(np.array(least, dtype=np.uint64))), batch.column(1)[first:end]]
                yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "key", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, part = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            for first, _, texts in chunks(batch.column(2)):
                seen = Features(texts)
                for is_stem, (found, row) in enumerate((seen.words_by_text(), seen.stems_by_text())):
                    row = row + first
                    arrays = [pa.array(np.full(len(found), bool(is_stem))), pa.array(as_long(found)), pa.array(part[row]), pa.array(toxic[row])]
                    yield pa.RecordBatch.from_arrays(arrays, names=["stem", "sign", "third", "toxic"])

    told = map_batches(chosen, tell, "toxic int, key long, text string")
    once = told.groupBy("key").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    once = saved(once.select("toxic", F.pmod("key", F.lit(3)).alias("third"), "text"))
    parts = map_batches(once, run, "stem boolean, sign long, third long, toxic long")
    counted = saved(parts.groupBy("stem", "sign", "third").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")))
    share = min(max(once.agg(F.avg("toxic")).first()[0] or 0.0, 1e-6), 1 - 1e-6)

    def best(rows: DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The signs that most toxic rows have, and whether that is almost always so and more than chance."""
        summed = rows.groupBy("sign").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
        good = summed.where((F.col("t") >= 3) & (F.col("t") * 100 >= F.col("n") * percent))
        found = good.orderBy(F.col("t").desc(), "sign").limit(words).collect()
        least = np.log(max(1, summed.count())) / -np.log(share)
        hashes = np.array([r["sign"] for r in found], dtype=np.int64).view(np.uint64)
        return hashes, np.array([r["t"] > least and r["t"] * 100 >= r["n"] * SURE for r in found], dtype=bool)

    hashes, sure = best(counted.where("NOT stem"), SURE)
    lists = [*(np.sort(hashes[sure][i::3]) for i in range(3)), np.sort(hashes[~sure])]
    stems = []
    for left_out in range(STEM_LABELLERS):
        hashes, sure = best(counted.where(F.col("stem") & (F.col("third") != left_out)), WEAK)
        stems.append((np.sort(hashes[sure]), np.sort(hashes)))
    return lists, stems


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 8000, words: int = 600, sample: int = 2500) -> Model:
    lists, stems = toxic_signs(docs, labels, labelled, words)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                seen = Features(texts)
                arrays = [batch.column(0)[first:end], pa.array(patterns_of(seen.junk_votes())), pa.array(patterns_of(seen.toxic_votes(lists) + seen.stem_votes(stems)))]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "junk", "toxic"])

    votes = saved(map_batches(_keyed(docs), vote, "key long, junk long, toxic long"))
    counted = votes.groupBy("junk", "toxic").count().collect()  # at most 3 ** 14 patterns, of which few occur
    model = Model(lists, stems, {})
    sure = []
    for flaw, labellers in (LABELLERS | {"toxic": LABELLERS["toxic"] + STEM_LABELLERS}).items():
        counts: dict[int, int] = {}
        for row in counted:
            counts[row[flaw]] = counts.get(row[flaw], 0) + row["count"]
        by_pattern, _, model.accuracy[flaw] = posteriors(counts, labellers)
        if max(by_pattern.values(), default=0.0) >= 0.9:
            sure += [(flaw, k, p) for k, p in by_pattern.items() if p >= 0.9 or p <= 0.1]
    trained = _trained(docs, _drawn(votes, sure, sample)) if sure else {}
    for flaw in LABELLERS:
        weights, bias = trained.get(flaw, (np.zeros(FEATURES, np.float32), -30.0))
        model.scorers[flaw] = weights, bias - CAUTION
    return model


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("text").alias("key"), "text")


def _drawn(votes: DataFrame, sure: list[tuple[str, int, float]], sample: int) -> DataFrame:
    """``flaw, key, target`` of the ``sample`` distinct texts of smallest hash in each class of each flaw.

    Copies of a text count once, so that one text of many copies neither fills a class nor takes the others' places.
    """
    known = votes.sparkSession.createDataFrame(sure, "flaw string, pattern long, target double")
    picked = []
    for flaw in LABELLERS:
        for bad in (False, True):
            mine = known.where((F.col("flaw") == flaw) & ((F.col("target") > 0.5) == F.lit(bad)))
            own = votes.select("key", F.col(flaw).alias("pattern")).join(F.broadcast(mine), "pattern")  # at most 3 ** 9 patterns
            picked.append(own.select("flaw", "key", "target").distinct().orderBy("key").limit(sample))
    return saved(reduce(DataFrame.unionByName, picked))


def _trained(docs: DataFrame, drawn: DataFrame) -> dict[str, tuple[np.ndarray, float]]:
    """A scorer for each flaw. Texts are read once for all; a task trains each scorer, the driver gets its weights."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Copies leave a task once."""
        told: set[int] = set()  # drawn keys only
        for batch in batches:
            new = []
            for key in batch.column(0).to_pylist():
                new.append(key not in told)
                told.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(3)):
                buckets, values, bounds = Features(texts).sparse()
                # stems tell toxic words, not how a text is made
                junk = np.array([f == "junk" for f in batch.column(0)[first:end].to_pylist()], dtype=bool)
                values[junk[rows_of(bounds)] & (buckets >= BUCKETS + SHAPES)] = 0
                cut = pa.array(bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (buckets.astype(np.int32), values.astype(np.float32))]
                arrays = [*(batch.column(i)[first:end] for i in range(3)), *lists]
                yield pa.RecordBatch.from_arrays(arrays, names=["flaw", "key", "target", "buckets", "values"])

    def learn(rows: pa.Table) -> pa.Table:
        weights, bias = train(*_in_order(rows))
        columns = {"flaw": rows.column("flaw")[:1], "weights": pa.array([weights.astype("<f4").tobytes()], pa.binary()), "bias": pa.array([float(bias)])}
        return pa.table(columns)

    keys = drawn.select("key").distinct()
    read = map_batches(_keyed(docs).join(F.broadcast(keys), "key", "left_semi"), once, "key long, text string")
    texts = read.groupBy("key").agg(F.min("text").alias("text"))
    schema = "flaw string, key long, target double, buckets array<int>, values array<float>"
    described = map_batches(drawn.join(texts, "key").select("flaw", "key", "target", "text"), describe, schema)
    with tidy(docs.sparkSession):
        found = described.groupBy("flaw").applyInArrow(learn, "flaw string, weights binary, bias double").collect()
    return {r["flaw"]: (np.frombuffer(r["weights"], dtype="<f4"), r["bias"]) for r in found}


def _scored(
    column: pa.Array, scorers: Sequence[tuple[np.ndarray, float]]
) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """First row, end row, words of each text and its scores, for consecutive parts of a column of texts."""
    for begin, over, _ in chunks(column, SCORED_BYTES):
        carried = [[0.0] * 4 for _ in scorers]
        for first, end, texts in chunks(column[begin:over]):
            seen = Features(texts)
            scores = [seen.scores(w, b, c) for (w, b), c in zip(scorers, carried, strict=True)]
            yield begin + first, begin + end, seen.counts, scores


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` with ``junk`` and ``toxic``, scores from 0 to 1, and ``keep``: neither is above a half."""
    shared = docs.sparkSession.sparkContext.broadcast((model.scorers["junk"], model.scorers["toxic"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, counts, (junk, toxic) in _scored(batch.column(1), shared.value):
                junk = np.where(counts == 0, 1.0, junk)
                arrays = [batch.column(0)[first:end], pa.array(junk), pa.array(toxic), pa.array((junk <= 0.5) & (toxic <= 0.5))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "junk", "toxic", "keep"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, junk double, toxic double, keep boolean")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns and in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast((model.scorers["junk"], model.scorers["toxic"]))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [np.zeros(0, dtype=bool)]
            for _, _, counts, (junk, toxic) in _scored(batch.column(at), shared.value):
                keep.append((counts > 0) & (junk <= 0.5) & (toxic <= 0.5))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return map_batches(docs, run, docs.schema)

