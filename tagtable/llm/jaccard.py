"""N-gram Jaccard self-join of documents by grouped prefixes, and the classes that its links make.

Each text is the set of its distinct ``k``-word shingles; two texts link when their sets' Jaccard similarity is
at least ``percent`` / 100. Equal sets are one node. All sets are ordered alike, rare shingles first: by hash those
that at most ``COMMON`` sets have in their heads (their first shingles by hash, half as many again as a prefix has),
behind them the others by that number. Two sets that link share a shingle among their first few, the prefix.

1. Heads are posted by shingle and counted, exactly and over all sets; the counts of common shingles are joined back
   to the sets that have them. Where a head has enough rare shingles, they are the prefix: all other rare ones come
   later. Only sets with too few are read again and joined with the counts of all their shingles.
2. Sets with the same prefix and size form a group, and one leader speaks for it.
3. Groups that share a prefix shingle make a group pair, if sizes and places of the shingle leave room for a link,
   and, for groups of one, the bitmaps of the sets. A bitmap has the parity of the shingles by hash; bits in which
   two of them differ are shingles that only one set has. Few sets share a rare shingle, whatever the table's size,
   so pairs grow with the sets. Near copies share dozens of prefix shingles; their pair is made at the first of these,
   and left out at one that has another of them among the ``BEFORE`` shingles in front of it in both prefixes.
4. Pairs are expanded to members, filtered by bitmaps and verified by the sets themselves, which are read from the
   texts again for the nodes of pairs only.

Only classes are asked for, so what is linked already is not compared again. First, one random group at each
shingle is compared with the others there, as well as leaders with their members. What that links is united.
In a large family of texts that are just near enough, that one group links with a part only, and the rest would make
pairs with all of it. So as long as what a round linked, times the classes it is in, is more than the posted rows, each
shingle's groups meet another one of them, by one of ``ORDERS`` random orders, if their classes differ, and are united again.
Then all remaining pairs between different classes, within groups too, are made, expanded and verified. A family of near copies thus
takes a few comparisons for each member, and no link between different classes is lost.

Broadcast is a Bloom filter of fixed size of the rows whose sets are wanted, which only saves work. Ids and lists of
documents never come to the driver.

Defined cases: a text without words, or a missing one, is an empty set, links with nothing and is its own
class; rows of equal sets are one class, repeated rows and rows of one ``doc_id`` alike; texts of any length
are read whole; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagtable.llm.components import components
from tagtable.llm.store import map_batches, same, saved, scratch, tidy
from tagtable.llm.words import Texts, as_long, chunks, list_of_longs, mix, rows_of, shingle_sets, sums

COMMON = 8  # a shingle in more heads than this is ordered by their number, behind all rarer ones
BITMAP = 2048  # bits of a set's bitmap, of which a short one with an eighth of them is folded
FOLDS = 8
ORDERS = 16  # by which groups that others are compared with are chosen, after the first round
BEFORE = 8  # shingles in front of a prefix shingle by which a pair is known to have met before
FILTER_BITS = 24
PAIRS_AT_ONCE = 128
SETS_AT_ONCE = 256


def least_overlap(n, percent: int):
    """The fewest shingles that a set of ``n`` shares with any set that it links to."""
    return -(-n * percent // 100)


def _names(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """128 bits for each set of sorted hashes."""
    halves = np.stack([sums(mix(flat, 1), bounds), sums(mix(flat, 2), bounds) + np.diff(bounds).astype(np.uint64)], axis=1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(halves), [None, pa.py_buffer(np.ascontiguousarray(halves).tobytes())]).cast(pa.binary())


def _first_of_each(flat: np.ndarray, bounds: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first ``sizes[i]`` values of each row."""
    place = np.arange(len(flat)) - bounds[rows_of(bounds)]
    keep = place < sizes[rows_of(bounds)]
    out = np.zeros(len(bounds), dtype=np.int64)
    np.cumsum(np.minimum(sizes, np.diff(bounds)), out=out[1:])
    return flat[keep], out


def _prefix_sizes(bounds: np.ndarray, percent: int) -> np.ndarray:
    n = np.diff(bounds)
    return np.where(n > 0, n - least_overlap(n, percent) + 1, 0)


def _parities(flat: np.ndarray, bounds: np.ndarray) -> tuple[pa.ListArray, pa.ListArray]:
    """A short and a wide bitmap of each set."""
    wide = np.zeros((len(bounds) - 1, BITMAP // 64), dtype=np.int64)
    for first in range(0, len(wide), SETS_AT_ONCE):
        own = bounds[first : first + SETS_AT_ONCE + 1]
        at = rows_of(own) * BITMAP + (flat[own[0] : own[-1]] & np.uint64(BITMAP - 1)).astype(np.int64)
        parity = np.bincount(at, minlength=(len(own) - 1) * BITMAP).reshape(-1, BITMAP) & 1
        wide[first : first + len(own) - 1] = np.packbits(parity.astype(np.uint8), axis=1, bitorder="little").view("<i8")
    short = np.bitwise_xor.reduce(wide.reshape(len(wide), FOLDS, -1), axis=1)
    lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
    return lists(short), lists(wide)


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(doc_id, text)


def _per_chunk(docs: DataFrame, made: Callable[[Texts], list[pa.Array]], names: list[str], schema: str, text: str) -> DataFrame:
    """``doc_id``, ``key`` (a hash of id and text) and what ``made`` makes of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                arrays = [batch.column(0)[first:end], batch.column(2)[first:end], *made(texts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", text, row_key("doc_id", text).alias("key"))
    return map_batches(read, run, f"doc_id {kind}, key long, {schema}")


def members(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """``doc_id, key, node, n`` of each row."""

    def made(texts: Texts) -> list[pa.Array]:
        flat, bounds = shingle_sets(texts, k)
        return [_names(flat, bounds), pa.array(np.diff(bounds))]

    return saved(_per_chunk(docs, made, ["node", "n"], "node binary, n long", text))


def heads_of(docs: DataFrame, rows: DataFrame, k: int, percent: int, text: str = "text") -> DataFrame:
    """One row for each node with shingles: ``id, node, key, n, bits, wide, heads``; ``key`` is one row's that has the set."""

    def made(texts: Texts) -> list[pa.Array]:
        flat, bounds = shingle_sets(texts, k)
        sizes = _prefix_sizes(bounds, percent)
        heads = list_of_longs(*_first_of_each(flat, bounds, sizes + sizes // 2))
        return [_names(flat, bounds), pa.array(np.diff(bounds)), *_parities(flat, bounds), heads]

    columns = ["node", "n", "bits", "wide", "heads"]
    schema = "node binary, n long, bits array<long>, wide array<long>, heads array<long>"
    found = _per_chunk(docs, made, columns, schema, text)
    chosen = rows.where("n > 0").groupBy(F.col("node").alias("_node")).agg(F.min("key").alias("_key"))
    own = (F.col("node") == F.col("_node")) & (F.col("key") == F.col("_key"))
    one = found.where("n > 0").drop("doc_id").join(chosen, own, "left_semi").dropDuplicates(["node"])
    return saved(one.withColumn("id", F.monotonically_increasing_id()))


def prefixes(docs: DataFrame, sets: DataFrame, k: int, percent: int, text: str = "text") -> DataFrame:
    """``id, n, prefix, grouped`` of each set; ``grouped`` names size and prefix."""
    posted = sets.select("id", F.explode("heads").alias("shingle"))
    common = posted.groupBy("shingle").agg(F.count("*").alias("df")).where(F.col("df") > COMMON)
    common = saved(common)

    def choose(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """From ``id, n``, shingles in the order of hashes, and the common ones among them with their counts."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.column(1).to_numpy()
                sizes = n - least_overlap(n, percent) + 1
                (flat, bounds), (known, known_bounds), (df, _) = (_ragged(batch.column(c)) for c in (2, 3, 4))
                parts, told = [], np.zeros(len(n), dtype=bool)
                for i, size in enumerate(sizes.tolist()):
                    own = flat[bounds[i] : bounds[i + 1]].view(np.uint64)
                    late = known[known_bounds[i] : known_bounds[i + 1]].view(np.uint64)
                    order = np.argsort(late)
                    at = np.searchsorted(late, own, sorter=order)
                    at = order[np.minimum(at, len(late) - 1)] if len(late) else np.zeros(len(own), dtype=np.int64)
                    hit = late[at] == own if len(late) else np.zeros(len(own), dtype=bool)
                    if whole:
                        rank = np.where(hit, df[known_bounds[i] : known_bounds[i + 1]][at], 0) if len(late) else np.zeros(len(own))
                        own = own[np.argsort(rank, kind="stable")]
                    else:
                        own = own[~hit]
                    told[i] = len(own) >= size
                    parts.append(own[:size])
                first, cut = np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
                name = np.stack([sums(mix(first, 3), cut), sums(mix(first, 4), cut) * np.uint64(3) + mix(n.astype(np.uint64))], axis=1)
                grouped = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(name), [None, pa.py_buffer(np.ascontiguousarray(name).tobytes())])
                arrays = [batch.column(0), batch.column(1), list_of_longs(first, cut), grouped.cast(pa.binary()), pa.array(told)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "prefix", "grouped", "told"])

        return run

    def chosen(lists: DataFrame, posted: DataFrame, whole: bool) -> DataFrame:
        met = posted.join(common, "shingle").groupBy(F.col("id").alias("_id"))
        met = met.agg(F.collect_list(F.struct("shingle", "df")).alias("c"))
        read = lists.join(met, F.col("id") == F.col("_id"), "left")
        parts = (F.coalesce(f"c.{x}", F.array().cast("array<long>")).alias(x) for x in ("shingle", "df"))
        return saved(map_batches(read.select("id", "n", "heads", *parts), choose(whole), "id long, n long, prefix array<long>, grouped binary, told boolean"))

    most = chosen(sets.select("id", "n", "heads"), posted, False)

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, texts in chunks(batch.column(1)):
                flat, bounds = shingle_sets(texts, k)
                arrays = [batch.column(0)[first:end], pa.array(np.diff(bounds)), list_of_longs(flat, bounds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "heads"])

    few = most.where("NOT told").select(F.col("id").alias("_id"))
    with scratch(_texts_of(docs, sets, few, text)) as texts:
        full = saved(map_batches(texts, all_of, "id long, n long, heads array<long>"))
    rest = chosen(full, full.select("id", F.explode("heads").alias("shingle")), True)
    return most.where("told").unionByName(rest).drop("told")


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of an Arrow column of lists without missing ones."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(), (offsets - offsets[0]).astype(np.int64)


def shared_shingles(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaders of groups by prefix shingle, where two groups or more have it; and ``leader, id`` of all groups of several.

    The first has ``shingle, id, n, place``.
    """
    leaders = sets.groupBy(F.col("grouped").alias("g")).agg(F.min("id").alias("leader"), F.count("*").alias("many"))
    grouped = saved(
        sets.select("id", "grouped").join(leaders.where("many > 1"), F.col("grouped") == F.col("g")).select("leader", "id")
    )
    followers = grouped.where("leader <> id").select(F.col("id").alias("_id"))
    speaking = sets.select("id", "n", "prefix").join(followers, F.col("id") == F.col("_id"), "left_anti")
    posted = speaking.select("id", "n", F.posexplode("prefix").alias("place", "shingle"))
    several = posted.groupBy(F.col("shingle").alias("_shingle")).agg(F.count("*").alias("c")).where("c > 1").select("_shingle")
    live = posted.join(several, F.col("shingle") == F.col("_shingle"), "left_semi")
    return saved(live.select("shingle", "id", F.col("n").cast("int").alias("n"), "place")), grouped


def _sizes_and_places(percent: int) -> Column:
    """Whether sizes of two sets and places of a shared shingle allow a link; columns end in ``a`` and ``b``."""
    n1, n2, p1, p2 = F.col("na").cast("long"), F.col("nb").cast("long"), F.col("placea"), F.col("placeb")
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (most * (100 + percent) >= (n1 + n2) * percent)


def _bitmaps(percent: int, name: str = "bits", words: int = BITMAP // FOLDS // 64) -> Column:
    """Whether the bitmaps of two sets allow a link."""
    both = F.col("na").cast("long") + F.col("nb").cast("long")
    pairs = ((F.element_at(f"{name}a", i), F.element_at(f"{name}b", i)) for i in range(1, words + 1))
    differ = sum(F.bit_count(a.bitwiseXOR(b)) for a, b in pairs)
    return (both - differ) * (100 + percent) >= both * percent * 2


def _suffixed(frame: DataFrame, side: str, *keep: str) -> DataFrame:
    return frame.select(*keep, *(F.col(c).alias(f"{c}{side}") for c in frame.columns if c not in keep))


def _texts_of(docs: DataFrame, sets: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """``id, text`` of the sets whose ``_id`` is wanted, once each."""
    spark = docs.sparkSession
    known = saved(sets.select("id", "key").join(wanted, F.col("id") == F.col("_id"), "left_semi"))
    bit = F.pmod("key", F.lit(1 << FILTER_BITS)).cast("int")
    marks = known.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(key, {1 << FILTER_BITS}) & 63 as int)))").alias("v"))
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    with tidy(spark):
        held = marks.toArrow()  # at most 2 ** 18 numbers
    bits[held.column("w").to_numpy()] = held.column("v").to_numpy()
    shared = spark.sparkContext.broadcast(bits)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drops rows that the filter knows are not wanted, before their texts leave the task."""
        for batch in batches:
            at = batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)
            yield batch.filter(pa.array((shared.value[at >> 6] >> (at & 63) & 1).astype(bool)))

    read = docs.select(row_key("doc_id", text).alias("key"), F.col(text).alias("text"))
    kept = map_batches(read, pick, "key long, text string")
    names = known.select("id", F.col("key").alias("_key"))
    return kept.join(names, F.col("key") == F.col("_key")).select("id", "text").dropDuplicates(["id"])


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, k: int, percent: int, text: str = "text") -> DataFrame:
    """Those of ``a, b`` whose sets link. Texts go with the pairs, as they are smaller than their shingles."""
    pairs = saved(pairs.select("a", "b").distinct())
    wanted = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), PAIRS_AT_ONCE):
                part = batch.slice(first, PAIRS_AT_ONCE)
                one, two = ([x for _, _, texts in chunks(part.column(c)) for x in _split(*shingle_sets(texts, k))] for c in (2, 3))
                keep = []
                for x, y in zip(one, two, strict=True):
                    overlap = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(overlap * 100 >= percent * (len(x) + len(y) - overlap))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with scratch(_texts_of(docs, sets, wanted, text)) as full:
        left = full.select(F.col("id").alias("_a"), F.col("text").alias("t1"))
        right = full.select(F.col("id").alias("_b"), F.col("text").alias("t2"))
        both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
        return saved(map_batches(both.select("a", "b", "t1", "t2"), link, "a long, b long"))


def _split(flat: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [flat[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def classes(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row: the smallest id that links lead to.

    ``key`` and ``stays`` follow: one id and text of each class stays, that of the smallest id.
    """
    rows = members(docs, k, text)
    sets = heads_of(docs, rows, k, percent, text)
    live, grouped = shared_shingles(prefixes(docs, sets, k, percent, text))
    short, wide = (sets.select(F.col("id").alias("_i"), F.col(c).alias("b")) for c in ("bits", "wide"))

    # one group at each shingle with the others there, and leaders with their members
    in_group = grouped.where("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    first = _with_room(_spokes(live.withColumn("own", F.col("id")), percent), wide, percent)
    links = verified(first.union(in_group), docs, sets, k, percent, text)
    comps = saved(components(links))
    everyone, open_ = _open(live, sets, grouped, comps)

    # others there, while large families may have many members that the last one did not link with
    turn = 0
    while _still_apart(links, comps) > live.count():
        turn += 1
        links = verified(_with_room(_spokes(open_, percent, ORDERS, turn), wide, percent), docs, sets, k, percent, text)
        comps = saved(components(_stars(comps).union(links)))
        everyone, open_ = _open(live, sets, grouped, comps)

    # all other pairs between what is not linked yet: of groups first, which have the classes of all their members
    full = saved(_with_those_before(open_.drop("own")).join(short, F.col("id") == F.col("_i")).drop("_i").withColumnRenamed("b", "bits"))
    found = _met(full, percent)
    smaller, larger = (lambda c, s=s: F.when((F.col("manya") <= F.col("manyb")) == F.lit(s), F.col(f"{c}a")).otherwise(F.col(f"{c}b")) for s in (True, False))
    found = found.select(smaller("id").alias("one"), larger("id").alias("two"), larger("lo").alias("lo"), larger("hi").alias("hi")).distinct()
    near = _expanded(saved(found), everyone, percent)
    near = near.union(_within_groups(everyone, percent)).distinct()
    more = verified(_with_room(near, wide, percent), docs, sets, k, percent, text)
    comps = saved(components(_stars(comps).union(more)))
    return _labelled(rows, sets, comps)


def _spokes(posted: DataFrame, percent: int, orders: int = 1, turn: int = 0) -> DataFrame:
    """Pairs ``ida, na, idb, nb`` of one group at each shingle with those there of another class, ``own``, where sizes
    and places allow a link. Each of ``orders`` random orders, new ones at each ``turn``, has its part of the shingles."""
    dice = F.struct(F.xxhash64("id", F.pmod("shingle", F.lit(orders)), F.lit(turn)), "id", "n", "place", "own")
    middle = posted.groupBy(F.col("shingle").alias("s")).agg(F.min(dice).alias("m"))
    spokes = posted.join(middle, F.col("shingle") == F.col("s")).where(F.col("m.own") != F.col("own"))
    spokes = spokes.select(F.col("m.id").alias("ida"), F.col("m.n").alias("na"), F.col("m.place").alias("placea"), F.col("id").alias("idb"), F.col("n").alias("nb"), F.col("place").alias("placeb"))
    return spokes.where(_sizes_and_places(percent)).select("ida", "na", "idb", "nb").distinct()


def _open(live: DataFrame, sets: DataFrame, grouped: DataFrame, comps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All sets with their classes, and the posted groups at shingles of several classes: ``lo`` and ``hi`` are the
    least and the largest class of a group's ``many`` members, ``own`` is its leader's."""
    everyone = _members_of(sets, grouped, comps)
    own = F.max(F.when(F.col("id") == F.col("leader"), F.col("comp"))).alias("own")
    groups = everyone.groupBy(F.col("leader").alias("_leader")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("many"), own)
    owned = live.join(groups, F.col("id") == F.col("_leader")).drop("_leader")
    mixed = owned.groupBy(F.col("shingle").alias("s")).agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least <> most").select("s")
    return everyone, owned.join(mixed, F.col("shingle") == F.col("s"), "left_semi")


def _stars(comps: DataFrame) -> DataFrame:
    """What the links so far make."""
    return comps.select(F.col("id").alias("a"), F.col("comp").alias("b"))


def _still_apart(links: DataFrame, comps: DataFrame) -> int:
    """How many pairs members of families would make that as many members don't belong to yet as were linked last."""
    last = links.join(comps, F.col("a") == F.col("id")).groupBy("comp").agg(F.count("*").alias("found"))
    sizes = comps.groupBy(F.col("comp").alias("_comp")).agg(F.count("*").alias("size"))
    pairs = last.join(sizes, F.col("comp") == F.col("_comp")).agg(F.sum(F.col("found") * F.col("size")).alias("pairs"))
    with tidy(links.sparkSession):
        return pairs.first()["pairs"] or 0


def _with_those_before(posted: DataFrame) -> DataFrame:
    """``before``: up to ``BEFORE`` shingles that are posted for the same set next in front of each."""
    ahead = Window.partitionBy("id").orderBy("place").rowsBetween(-BEFORE, -1)
    return posted.withColumn("before", F.collect_list("shingle").over(ahead))


def _met(posted: DataFrame, percent: int) -> DataFrame:
    """Pairs of groups in different classes that meet at a shingle, where sizes, places and bitmaps allow a link.

    A pair that links passes at each shingle that it shares, so it is enough that none is left out at the first of them.
    """
    a, b = _suffixed(posted, "a"), _suffixed(posted, "b")
    apart = (F.col("loa") != F.col("hib")) | (F.col("lob") != F.col("hia"))
    met = (F.col("shinglea") == F.col("shingleb")) & (F.col("ida") < F.col("idb")) & apart & _sizes_and_places(percent)
    room = (F.col("manya") > 1) | (F.col("manyb") > 1) | _bitmaps(percent)
    return a.join(b, met & room & ~F.arrays_overlap("beforea", "beforeb"))


def _members_of(sets: DataFrame, grouped: DataFrame, comps: DataFrame) -> DataFrame:
    """``leader, id, n, comp, bits`` of all sets, those alone being their own leaders."""
    led = sets.select("id", "n", "bits").join(grouped.withColumnRenamed("id", "_member"), F.col("id") == F.col("_member"), "left")
    owned = led.join(comps.withColumnsRenamed({"id": "_c", "comp": "_comp"}), F.col("id") == F.col("_c"), "left")
    return saved(owned.select(F.coalesce("leader", "id").alias("leader"), "id", "n", F.coalesce("_comp", "id").alias("comp"), "bits"))


def _expanded(pairs: DataFrame, everyone: DataFrame, percent: int) -> DataFrame:
    """Pairs ``ida, na, idb, nb`` of members of groups ``one, two`` that are in different classes and whose bitmaps allow
    a link. The group of fewer members goes first, without those in the one class (``lo`` is ``hi``) of the other; members
    of the other are compared as they are joined."""
    a, b = _suffixed(everyone, "a"), _suffixed(everyone, "b")
    open_ = (F.col("lo") != F.col("hi")) | (F.col("compa") != F.col("lo"))
    pairs = pairs.join(a, (F.col("one") == F.col("leadera")) & open_)
    met = (F.col("two") == F.col("leaderb")) & (F.col("compa") != F.col("compb")) & _bitmaps(percent)
    return pairs.join(b, met).select("ida", "na", "idb", "nb")


def _within_groups(everyone: DataFrame, percent: int) -> DataFrame:
    """Pairs ``ida, na, idb, nb`` of members of one group that are not linked yet; no other group need have their shingles."""
    mixed = everyone.groupBy(F.col("leader").alias("g")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("g")
    open_ = saved(everyone.join(mixed, F.col("leader") == F.col("g"), "left_semi"))
    a, b = _suffixed(open_, "a"), _suffixed(open_, "b")
    met = (F.col("leadera") == F.col("leaderb")) & (F.col("ida") < F.col("idb")) & (F.col("compa") != F.col("compb"))
    return a.join(b, met & _bitmaps(percent)).select("ida", "na", "idb", "nb")


def _with_room(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Those of ``ida, na, idb, nb`` whose wide bitmaps allow a link, as ``a, b``."""
    one = pairs.join(wide.withColumnsRenamed({"_i": "_ia", "b": "widea"}), F.col("ida") == F.col("_ia"))
    two = one.join(wide.withColumnsRenamed({"_i": "_ib", "b": "wideb"}), F.col("idb") == F.col("_ib"))
    return two.where(_bitmaps(percent, "wide", BITMAP // 64)).select(F.col("ida").alias("a"), F.col("idb").alias("b"))


def _labelled(rows: DataFrame, sets: DataFrame, comps: DataFrame) -> DataFrame:
    smallest = rows.where("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "key")).alias("least"))
    linked = comps.join(sets.select(F.col("id").alias("_i"), "node"), F.col("id") == F.col("_i")).select("node", "comp")
    known = smallest.join(linked, "node", "left")
    of_class = known.where("comp is not null").groupBy(F.col("comp").alias("_comp")).agg(F.min("least").alias("of_class"))
    label = known.join(of_class, F.col("comp") == F.col("_comp"), "left")
    label = label.select(F.col("node").alias("_node"), F.coalesce("of_class", "least").alias("first"))
    told = rows.where("n > 0").join(label, F.col("node") == F.col("_node"))
    alone = rows.where("n = 0").withColumn("first", F.struct("doc_id", "key"))
    stays = (same(F.col("doc_id"), F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))).alias("stays")
    columns = ["doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"), "key", stays]
    return told.select(*columns).unionByName(alone.select(*columns))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which one stays in each class; repeated rows stay once."""
    columns = docs.columns
    stay = classes(docs, k, percent).where("stays").select(F.col("key").alias("_key")).distinct()
    wrapped = docs.select(F.struct(*columns).alias("_row")).withColumn("_own", row_key("_row.doc_id", "_row.text"))
    return wrapped.join(stay, F.col("_own") == F.col("_key"), "left_semi").dropDuplicates(["_own"]).select("_row.*")
