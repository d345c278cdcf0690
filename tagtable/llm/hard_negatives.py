"""Hard negatives of anchor vectors, found by rotated one-bit codes with deterministic score intervals.

Vectors become integers, ``floor(256 * x)``. Around a centre (the mean of its label in a bounded sample) a vector is
rotated ``ROTATIONS`` times, each by two rounds of sign flips and a Hadamard transform, and stored as the signs of all
rotated components, one bit each. Turned back and added up, the signs are its code vector; stored with them are the
vector's length, the code vector's, and the alignment, the cosine between the two. An anchor is rotated likewise and
cut to a few bits a component, so its product with a code vector is some popcounts of its bit planes. A vector is its
alignment times its code's direction plus a residual at right angles to it, so by the Cauchy-Schwarz inequality the
score lies within an interval around the estimate, for certain. The candidates of best estimate are scored in integers
first, which gives the score that any other has to reach; a candidate whose interval does not reach it, or lies outside
the wanted scores, is left out, and none is lost. What survives is scored in integers.

Anchors meet all rows in blocks: a grid of row blocks and anchor blocks, each cell a group of bounded size. A row is
copied to as many cells as there are anchor blocks, an anchor to as many as there are row blocks. A cell hands on the
few best rows of each anchor only. The first grid gives each anchor's positives, the second the negatives for them.

Defined cases: rows without label, vector or id, or with a missing or non-finite component, take no part, nor do
vectors whose integers have a squared length of 2 ** 62 or more, whose scores might not fit a long; vectors score with
those of their own length only; rows equal in id, label and vector are one row, others of one id are rows of their
own, and no row is a positive of an anchor of its id; an empty table gives an empty result; other columns are not
looked at. All results are exact; sample, rotations, planes and block sizes change only the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagtable.llm.store import map_batches, saved
from tagtable.session import shuffle_width

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 3
SAMPLE = 1024  # rows that centres are made of
ROTATIONS = 8  # signs of a vector's component
PLANES = 6  # bits of an anchor's component
FIRST = 16  # candidates that are scored before the others, for each anchor and block
BLOCK_ROWS = 1 << 15
BLOCK_ANCHORS = 1 << 12
LEAST_ROWS = 1 << 10  # of a row block, where there are fewer blocks than tasks
_SLAB = 1 << 20  # products of anchors and rows in one go
_MOST = float(1 << 62)
_SLACK = 1e-9  # for the rounding of floating point numbers, relative to the vectors' lengths

_CODED = "vec_id long, label long, d int, v array<long>, code binary, length double, code_length double, alignment double"


# --- codes


def _width(d: int) -> int:
    """The components of a rotated vector: a power of two, and whole words of bits."""
    return max(64, 1 << max(d - 1, 1).bit_length())


def _flips(width: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    dice = np.random.default_rng([width, turn])
    return tuple(dice.integers(0, 2, width) * 2.0 - 1 for _ in range(2))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, -1, 2, step)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def _rotate(x: np.ndarray, turn: int) -> np.ndarray:
    """Rows of ``x``, filled up with zeros, rotated; lengths and products stay."""
    n, d = x.shape
    out = np.zeros((n, _width(d)))
    out[:, :d] = x
    for flips in _flips(out.shape[1], turn):
        out = _hadamard(out * flips)
    return out


def _turn_back(x: np.ndarray, turn: int) -> np.ndarray:
    for flips in reversed(_flips(x.shape[1], turn)):
        x = _hadamard(x) * flips
    return x


def _codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signs of rotated rows as bits, lengths of rows and of code vectors, and the cosines between them."""
    bits, code = [], np.zeros(x.shape)
    for turn in range(ROTATIONS):
        signs = _rotate(x, turn) >= 0
        bits.append(np.packbits(signs, axis=1, bitorder="little"))
        code += _turn_back(signs * 2.0 - 1, turn)[:, : x.shape[1]]
    length, code_length = (np.sqrt((v * v).sum(axis=1)) for v in (x, code))
    both = length * code_length
    alignment = np.divide((x * code).sum(axis=1), both, out=np.ones(len(x)), where=both > 0)
    return np.concatenate(bits, axis=1), length, code_length, np.clip(alignment, -1.0, 1.0)


class Asked:
    """Anchors, ready to be compared with codes: bit planes of their rotated components."""

    def __init__(self, anchors: np.ndarray):
        turned = np.concatenate([_rotate(anchors, turn) for turn in range(ROTATIONS)], axis=1)
        low = turned.min(axis=1)
        step = (turned.max(axis=1) - low) / ((1 << PLANES) - 1)
        step[step == 0] = 1.0
        level = np.rint((turned - low[:, None]) / step[:, None])
        self.lengths = np.sqrt((anchors * anchors).sum(axis=1))
        self.low, self.step = low, step
        rounded = low[:, None] + step[:, None] * level
        self.total = rounded.sum(axis=1)
        # of a product with signs, of which there are as many as rotated components
        self.error = np.sqrt(((turned - rounded) ** 2).sum(axis=1)) * np.sqrt(turned.shape[1])
        level = level.astype(np.uint8)
        planes = [np.packbits(level >> b & 1, axis=1, bitorder="little").view(np.uint64) for b in range(PLANES)]
        self.planes = np.stack(planes)

    def intervals(self, codes: np.ndarray, lengths: np.ndarray, code_lengths: np.ndarray, alignments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the products of all anchors and the vectors of ``codes``."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        counts = np.zeros((len(self.total), len(codes)), dtype=np.int64)
        for bit in range(PLANES):
            held = np.zeros(counts.shape, dtype=np.int32)
            for word in range(codes.shape[1]):
                held += np.bitwise_count(self.planes[bit, :, word][:, None] & codes[:, word])
            counts += held.astype(np.int64) << bit
        scale = np.divide(1.0, code_lengths, out=np.zeros(len(codes)), where=code_lengths > 0)
        along = (2 * (self.low[:, None] * ones + self.step[:, None] * counts) - self.total[:, None]) * scale
        error = self.error[:, None] * scale
        rest = self.lengths[:, None] ** 2 - np.maximum(np.abs(along) - error, 0.0) ** 2
        # a vector without a code vector is all residual
        apart = np.where(code_lengths > 0, np.sqrt(np.maximum(1 - alignments**2, 0.0)), 1.0)
        rest = np.sqrt(np.maximum(rest, 0.0)) * apart
        width = lengths * (np.abs(alignments) * error + rest) + _SLACK * (1 + lengths * self.lengths[:, None])
        middle = lengths * alignments * along
        return middle - width, middle + width


def centres(vectors: DataFrame, sample: int = SAMPLE) -> dict[tuple[int, int], np.ndarray]:
    """The mean integer vector of each label and length among ``sample`` rows of smallest hash."""
    held: dict[tuple[int, int], list] = {}
    taken = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "v").limit(sample).select("label", "v").toArrow()
    for label, v in zip(taken.column(0).to_pylist(), taken.column(1), strict=True):
        held.setdefault((label, len(v)), []).append(v.values.to_numpy())
    return {key: np.array(rows, dtype=float).mean(axis=0) for key, rows in held.items()}


def integer_vectors(frame: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, v`` of the rows that take part."""
    x = F.col(vector)
    floor = lambda e: F.floor(e.cast("double") * F.lit(SCALE))
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    square = F.aggregate(x, F.lit(0.0), lambda s, e: s + F.pow(floor(e).cast("double"), F.lit(2.0)))
    kept = frame.where(F.col("vec_id").isNotNull() & F.col(label).isNotNull() & finite & (square < _MOST))
    return kept.select(F.col("vec_id").cast("long"), F.col(label).cast("long").alias("label"), F.transform(x, floor).alias("v")).distinct()


def code_vectors(vectors: DataFrame, middles: dict[tuple[int, int], np.ndarray]) -> DataFrame:
    """``vectors`` with their length ``d``, code, and the length and alignment of what is left around the centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2)
            sizes = np.diff(rows.offsets.to_numpy())
            flat, starts = rows.flatten().to_numpy().astype(float), np.cumsum(sizes) - sizes
            labels = batch.column(1).to_numpy()
            codes, lengths, code_lengths, alignments = [b""] * len(sizes), *(np.zeros(len(sizes)) for _ in range(3))
            for d in np.unique(sizes).tolist():
                of = np.flatnonzero(sizes == d)
                x = flat[starts[of][:, None] + np.arange(d)]
                x = x - np.stack([middles.get((label, d), np.zeros(d)) for label in labels[of].tolist()])
                bits, lengths[of], code_lengths[of], alignments[of] = _codes(x)
                for i, code in zip(of.tolist(), bits, strict=True):
                    codes[i] = code.tobytes()
            arrays = [*batch.columns[:2], pa.array(sizes.astype(np.int32)), rows, pa.array(codes, pa.binary()), pa.array(lengths), pa.array(code_lengths), pa.array(alignments)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "label", "d", "v", "code", "length", "code_length", "alignment"])

    return map_batches(vectors, run, _CODED)


# --- cells


class Cell:
    """The rows and anchors of a cell, of one vector length."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, middles: dict[tuple[int, int], np.ndarray]):
        d = anchors.column("d")[0].as_py()
        self.ids, self.labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        self.anchor_ids, self.anchor_labels = (anchors.column(c).to_numpy() for c in ("vec_id", "label"))
        self.vectors, self.anchors = _matrix(rows, d), _matrix(anchors, d)
        self.codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
        self.coded = [rows.column(c).to_numpy() for c in ("length", "code_length", "alignment")]
        names, self.centre_of = np.unique(self.labels, return_inverse=True)
        self.centres = np.stack([middles.get((label, d), np.zeros(d)) for label in names.tolist()])
        # products are below 2 ** 62 in any case; below 2 ** 53 sums of doubles are exact, and faster
        most = float(np.abs(self.vectors).max(initial=0)) * float(np.abs(self.anchors).max(initial=0)) * d
        if most < 1 << 53:
            self.vectors, self.anchors = self.vectors.astype(float), self.anchors.astype(float)

    def slabs(self, same_label: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Anchors, rows, which of them may pair, and bounds of their scores, a part at a time."""
        for label in np.unique(self.anchor_labels).tolist():
            rows = np.flatnonzero((self.labels == label) == same_label)
            anchors = np.flatnonzero(self.anchor_labels == label)
            if not len(rows):
                continue
            step = max(1, _SLAB // len(rows))
            for first in range(0, len(anchors), step):
                part = anchors[first : first + step]
                q = self.anchors[part].astype(float)
                low, high = Asked(q).intervals(self.codes[rows], *(c[rows] for c in self.coded))
                shift = (q @ self.centres.T)[:, self.centre_of[rows]]
                slack = _SLACK * (1 + np.abs(shift))
                allowed = self.ids[rows] != self.anchor_ids[part][:, None] if same_label else np.ones(low.shape, bool)
                yield part, rows, allowed, low + shift - slack, high + shift + slack

    def reached(self, anchors: np.ndarray, rows: np.ndarray, order: np.ndarray, n: int, least=-np.inf, most=np.inf) -> np.ndarray:
        """For each anchor a score that its ``n``-th best wanted row reaches, from the rows of largest ``order``."""
        k = min(FIRST, order.shape[1])
        if k < n:
            return np.full((len(anchors), 1), -np.inf)
        best = np.argpartition(-order, k - 1, axis=1)[:, :k]
        scores = np.einsum("ad,akd->ak", self.anchors[anchors], self.vectors[rows[best]]).astype(float)
        wanted = (scores >= least) & (scores <= most) & (np.take_along_axis(order, best, axis=1) > -np.inf)
        return np.sort(np.where(wanted, scores, -np.inf), axis=1)[:, -n, None]

    def scores(self, anchors: np.ndarray, rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``anchors`` and ``rows`` of the ``wanted`` pairs, and their scores in integers."""
        columns = np.flatnonzero(wanted.any(axis=0))
        products = self.anchors[anchors] @ self.vectors[rows[columns]].T
        i, j = np.nonzero(wanted[:, columns])
        return i, columns[j], np.rint(products[i, j]).astype(np.int64) if products.dtype.kind == "f" else products[i, j]


def _matrix(table: pa.Table, d: int) -> np.ndarray:
    column = table.column("v").combine_chunks()
    return column.flatten().to_numpy().astype(np.int64).reshape(table.num_rows, d)


def _first(group: np.ndarray, scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the ``n`` best of every group, by falling score, then by id."""
    order = np.lexsort((ids, -scores, group))
    place = np.arange(len(order)) - np.searchsorted(group[order], group[order], side="left")
    return order[place < n]


# --- the grid


def _block(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), key), F.lit(n)).cast("int")


def _meet(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], run, schema: str) -> DataFrame:
    """``run`` on every cell of the grid of row blocks and anchor blocks."""
    row_blocks, anchor_blocks = (max(1, -(-n // size)) for n, size in zip(counts, (BLOCK_ROWS, BLOCK_ANCHORS), strict=True))
    row_blocks = max(row_blocks, min(shuffle_width(rows.sparkSession), counts[0] // LEAST_ROWS))  # few rows, many cores
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # the whole row is hashed, so that rows of one id spread
    left = rows.withColumn("r", _block(F.struct("vec_id", "label", "v"), row_blocks)).withColumn("a", every(anchor_blocks))
    right = anchors.toDF(*anchors.columns).withColumn("a", _block(F.struct("vec_id", "label", "v"), anchor_blocks)).withColumn("r", every(row_blocks))
    return left.groupBy("d", "r", "a").cogroup(right.groupBy("d", "r", "a")).applyInArrow(run, schema)


def mine(
    frame: DataFrame,
    asked: Column,
    lowest: int = 50,
    highest: int = 95,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    sample: int = SAMPLE,
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows where ``asked`` (of ``vec_id``) holds. An anchor's positives are the first rows of its label
    by score, then by id. For each of them, the negatives are the first rows of other labels whose score is at least
    ``lowest`` and at most ``highest`` hundredths of the positive's.
    """
    vectors = saved(integer_vectors(frame, vector, label))
    middles = centres(vectors, sample)
    rows = saved(code_vectors(vectors, middles))
    anchors = rows.where(asked).withColumn("anchor", F.xxhash64("vec_id", "label", "v"))
    counts = tuple(rows.agg(F.count("*"), F.count(F.when(asked, 1))).first())

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            cell, keys = Cell(left, right, middles), right.column("anchor").to_numpy()
            for part, rows, allowed, low, high in cell.slabs(same_label=True):
                reached = cell.reached(part, rows, np.where(allowed, low + high, -np.inf), positives)
                wanted = allowed & (high >= reached)
                i, j, scores = cell.scores(part, rows, wanted)
                best = _first(i, scores, cell.ids[rows[j]], positives)
                i, j = part[i[best]], rows[j[best]]
                found.append((keys[i], cell.anchor_ids[i], cell.ids[j], scores[best]))
        return _table(found, ["anchor", "anchor_id", "positive_id", "positive_score"])

    near = _meet(rows, anchors, counts, find_positives, "anchor long, anchor_id long, positive_id long, positive_score long")
    by = Window.partitionBy("anchor_id", "anchor").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(by)).where(F.col("place") <= positives)
    near = saved(near)

    wanted = near.groupBy("anchor", F.col("anchor_id").alias("vec_id")).agg(F.collect_set("positive_score").alias("windows"))
    with_windows = anchors.join(wanted, ["anchor", "vec_id"])

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            cell, keys, windows = Cell(left, right, middles), right.column("anchor").to_numpy(), right.column("windows").to_pylist()
            for part, rows, _, low, high in cell.slabs(same_label=False):
                for place in range(max(len(windows[i]) for i in part)):
                    own = [windows[i][place] if place < len(windows[i]) else None for i in part]
                    part_with = [k for k, s in enumerate(own) if s is not None]
                    scores_of = np.array([own[k] for k in part_with], dtype=np.int64)
                    # the least and the largest integer score allowed
                    least = np.array([-(-lowest * s // 100) for s in scores_of.tolist()], dtype=np.int64)[:, None]
                    most = np.array([highest * s // 100 for s in scores_of.tolist()], dtype=np.int64)[:, None]
                    lo, hi, some = low[part_with], high[part_with], part[part_with]
                    order = np.where((lo + hi) / 2 <= most, lo + hi, -np.inf)
                    reached = cell.reached(some, rows, order, negatives, least, most)
                    candidates = (hi >= np.maximum(least, reached)) & (lo <= most)
                    i, j, scores = cell.scores(some, rows, candidates)
                    right_ones = (scores >= least[i, 0]) & (scores <= most[i, 0])
                    i, j, scores = i[right_ones], j[right_ones], scores[right_ones]
                    best = _first(i, scores, cell.ids[rows[j]], negatives)
                    at = some[i[best]]
                    found.append((keys[at], cell.anchor_ids[at], scores_of[i[best]], cell.ids[rows[j[best]]], scores[best]))
        return _table(found, ["anchor", "anchor_id", "positive_score", "negative_id", "negative_score"])

    far = _meet(rows, with_windows, counts, find_negatives, "anchor long, anchor_id long, positive_score long, negative_id long, negative_score long")
    by = Window.partitionBy("anchor_id", "anchor", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= negatives)
    found = near.join(far, ["anchor_id", "anchor", "positive_score"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _table(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.table({name: pa.array(c.astype(np.int64)) for name, c in zip(names, columns, strict=True)})
