"""Hot keys: find them cheaply, and split their rows in joins.

A key that holds a large share of a table, or meets many rows on both sides of a join, would put that share into one
task. ``hot_keys`` looks for keys with many rows, ``measure_grid`` for keys whose rows on all sides of a join make
many. Both give tables of such keys, which are joined to the rows that they concern: a list of a checked size is
broadcast, a longer one is written and joined by shuffle. Without hot keys, every join here is an ordinary one. The
splits decide only which task handles a row, never which rows are in the result.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, FloatType, MapType, StringType, StructType, VariantType

from tagtable.session import work_folder

ROWS_PER_TASK = 2_000_000
LISTED = 10_000  # hot keys that are broadcast; more are written and joined
LISTED_CHARS = 1_000
SPREAD = 64
BUCKETS = 1 << 16  # of keys by hash, in which rows are counted to tell which keys are worth spreading


# --- tables of hot keys


class Grid:
    """Hot keys and into how many parts their rows on each side of a join are cut.

    ``frame`` has ``key``, as text, and ``g``, the numbers of parts, of the left side first; it is None without hot
    keys. ``nulls`` is the number of parts of left rows without a key. ``listed`` tells that the frame is small.
    ``heavy`` are the buckets of keys of over ``ROWS_PER_TASK`` rows, None if they are not known.
    """

    def __init__(self, frame: DataFrame | None, listed: bool = True, nulls: int = 1, heavy: Sequence[int] | None = None):
        self.frame, self.listed, self.nulls, self.heavy = frame, listed, max(nulls, 1), heavy

    def __bool__(self) -> bool:
        return self.frame is not None or self.nulls > 1

    def marked(self, frame: DataFrame, key: str, name: str) -> DataFrame:
        """``frame`` with the key's ``g`` as a column ``name``, NULL where the key is not hot."""
        if self.frame is None:
            return frame.withColumn(name, F.lit(None).cast("array<int>"))
        text, other = (free_name(n, frame) for n in ("_text", "_hot"))
        table = self.frame.select(F.col("key").alias(other), F.col("g").alias(name))
        frame = frame.withColumn(text, key_text(frame, key))
        if self.listed:
            joined = frame.join(F.broadcast(table), F.col(text) == F.col(other), "left")
        else:
            joined = spread_join(frame, table.hint("merge"), text, other, heavy=self.heavy)
        return joined.drop(text, other)


class HotKeys(Mapping):
    """Hot keys of one table and the number of tasks that each is worth; ``None`` is the missing key.

    Joins use ``grid``, the table of them; looking into the mapping fetches it.
    """

    def __init__(self, grid: Grid):
        self.grid = grid

    def __bool__(self) -> bool:
        return bool(self.grid)

    def _fetched(self) -> dict[str | None, int]:
        found = {r["key"]: r["g"][0] for r in self.grid.frame.collect()} if self.grid.frame is not None else {}
        return found | ({None: self.grid.nulls} if self.grid.nulls > 1 else {})

    def __getitem__(self, key: str | None) -> int:
        return self._fetched()[key]

    def __iter__(self) -> Iterator[str | None]:
        return iter(self._fetched())

    def __len__(self) -> int:
        return len(self._fetched())


Splits = Mapping[str | None, int]


def key_text(frame: DataFrame, key: str) -> Column:
    """The key as text, equal for keys that join: both zeros of floating point numbers, and decimals of any scale, are
    written alike."""
    column, kind = F.col(f"`{key}`"), frame.schema[key].dataType
    if isinstance(kind, (FloatType, DoubleType)):
        return (column + F.lit(0.0)).cast("string")
    text = column.cast("string")
    return F.regexp_replace(text, r"\.?0+$", "") if isinstance(kind, DecimalType) and kind.scale else text


def hot_keys(
    keyed: Mapping[str, tuple[DataFrame, str]], rows_per_task: int = ROWS_PER_TASK, nulls: bool = False
) -> dict[str, HotKeys]:
    """For each named ``(frame, key column)``, the keys over ``rows_per_task`` rows and their split counts.

    Tables without that many rows are told by a row count; for plain parquet scans it reads file footers only.
    Keys of the rest are counted, combined within tasks before the shuffle, and the counts are exact: every key
    over the threshold is found. There can't be more of them than the table's rows by ``rows_per_task``. With
    ``nulls``, a missing key counts as a key, ``None``.
    """
    found = {name: HotKeys(Grid(None)) for name in keyed}
    if not keyed:
        return found
    sizes = _union([f.select(F.lit(n).alias("t")) for n, (f, _) in keyed.items()]).groupBy("t").count()
    large = [r["t"] for r in sizes.where(F.col("count") > rows_per_task).collect()]
    if not large:
        return found
    tagged = [keyed[n][0].select(F.lit(n).alias("t"), key_text(*keyed[n]).alias("key")) for n in large]
    counts = _union(tagged).groupBy("t", "key").count().where(F.col("count") > rows_per_task)
    if not nulls:
        counts = counts.where(F.col("key").isNotNull())
    parts = F.ceil(F.col("count") / rows_per_task).cast("int")
    hot, listed, heavy = _kept(counts.select("t", "key", F.array(parts).alias("g"), F.col("count").alias("rows")))
    for name in large if hot is not None else []:
        found[name] = HotKeys(_grid(hot.where(F.col("t") == name).drop("t"), listed, nulls, heavy))
    return found


def measure_grid(
    left: DataFrame | None,
    rights: Sequence[DataFrame | None],
    key: str,
    rows_per_task: int = ROWS_PER_TASK,
    nulls: bool = False,
) -> Grid:
    """Keys whose rows on all sides make over ``rows_per_task`` joined rows, cut so that a cell makes no more.

    The rows of all sides are counted by key in one pass, combined within tasks before the shuffle; so keys that
    are moderate on either side, but not in their product, are found as well. ``None`` stands for a side that has
    one row of a key at most; a key that is missing on a side counts as one row there. With ``nulls``, left rows
    without a key are spread.
    """
    sides = [left, *rights]
    tagged = []
    for i, frame in enumerate(sides):
        if frame is not None:
            if i or not nulls:
                frame = frame.where(F.col(key).isNotNull())
            counts = [F.lit(int(i == j)).cast("long").alias(f"n{j}") for j in range(len(sides))]
            tagged.append(frame.select(key_text(frame, key).alias("key"), *counts))
    counts = _union(tagged).groupBy("key").agg(*[F.sum(f"n{j}").alias(f"n{j}") for j in range(len(sides))])
    return grid_of_counts(counts, len(sides), rows_per_task, nulls)


def grid_of_counts(counts: DataFrame, sides: int, rows_per_task: int = ROWS_PER_TASK, nulls: bool = False) -> Grid:
    """The grid of counted keys: ``key``, as text, and ``n0``, ``n1`` ... rows on each side."""
    made = reduce(lambda a, b: a * b, [F.greatest(F.col(f"n{j}"), F.lit(1)).cast("double") for j in range(sides)])
    # from the smallest side on, each takes its share of the rows that a cell may make; a small side leaves the rest more
    ordered = ", ".join(f"named_struct('n', cast(greatest(n{j}, 1) AS double), 'side', {j})" for j in range(sides))
    share = "pow(a.room, 1 / a.sides)"
    cut = (
        f"aggregate(array_sort(array({ordered})), named_struct('room', {float(rows_per_task)}D, 'sides', {float(sides)}D, "
        "'g', cast(array() AS array<struct<side: int, parts: int>>)), (a, x) -> named_struct("
        f"'room', a.room / least(x.n, {share}), 'sides', a.sides - 1, "
        f"'g', concat(a.g, array(named_struct('side', x.side, 'parts', cast(greatest(1, ceil(x.n / {share})) AS int))))), "
        "a -> transform(array_sort(a.g), s -> s.parts))"
    )
    most = F.greatest(*[F.col(f"n{j}") for j in range(sides)], F.lit(1))
    hot, listed, heavy = _kept(counts.where(made > rows_per_task).select("key", F.expr(cut).alias("g"), most.alias("rows")))
    return Grid(None) if hot is None else _grid(hot, listed, nulls, heavy)


def _grid(hot: DataFrame, listed: bool, nulls: bool, heavy: Sequence[int] | None) -> Grid:
    """The grid of a kept table, whose row without a key, if any, is told apart."""
    missing = hot.where(F.col("key").isNull()).first() if nulls else None
    named = hot.where(F.col("key").isNotNull()) if nulls else hot
    return Grid(named if not missing or named.take(1) else None, listed, missing["g"][0] if missing else 1, heavy)


def _kept(counted: DataFrame) -> tuple[DataFrame | None, bool, list[int] | None]:
    """A table of hot keys without their ``rows``, computed once: None if empty, local and ``True`` if of a checked size,
    else written; and the buckets of keys of over ``ROWS_PER_TASK`` rows."""
    hot = counted.drop("rows")
    cut = [F.substring(c, 1, LISTED_CHARS + 1).alias(c) if c == "key" else F.col(c) for c in hot.columns]
    rows = counted.select(*cut, "rows").limit(LISTED + 1).toArrow()
    if not rows.num_rows:
        return None, True, None
    longest = max(len(k or "") for k in rows.column("key").to_pylist())
    spark = hot.sparkSession
    listed = rows.num_rows <= LISTED and longest <= LISTED_CHARS
    if listed:
        kept = spark.createDataFrame(rows, counted.schema)
    else:
        path = work_folder(spark)
        counted.write.parquet(path)
        kept = spark.read.schema(counted.schema).parquet(path)
    heavy = []
    if not listed or max(rows.column("rows").to_pylist()) > ROWS_PER_TASK:
        many = kept.where(F.col("key").isNotNull() & (F.col("rows") > ROWS_PER_TASK)).select(_bucket(F.col("key")).alias("b"))
        heavy = [r["b"] for r in many.distinct().collect()]
    return kept.drop("rows"), listed, heavy


def _bucket(text: Column) -> Column:
    return F.when(text.isNotNull(), F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int"))


def heavy_buckets(frame: DataFrame, text: Column) -> list[int]:
    """The buckets of keys, as text, with over ``ROWS_PER_TASK`` rows; each key of that many rows is in one of them.

    A bucket is counted within tasks first, so that the shuffle is small however many keys there are.
    """
    counts = frame.select(_bucket(text).alias("b")).where("b IS NOT NULL").groupBy("b").count()
    return [r["b"] for r in counts.where(F.col("count") > ROWS_PER_TASK).collect()]


def _given(spark: SparkSession, splits: Splits | None) -> Grid:
    """The grid of splits on one side: measured ones, or a mapping of a few."""
    if isinstance(splits, HotKeys):
        return splits.grid
    splits = splits or {}
    named = {k: n for k, n in splits.items() if k is not None}
    if not named:
        return Grid(None, nulls=splits.get(None, 1))
    parts = pa.array([[n] for n in named.values()], pa.list_(pa.int32()))
    table = pa.table({"key": pa.array(named, pa.string()), "g": parts})
    return Grid(spark.createDataFrame(table), is_listed(splits), splits.get(None, 1))


def is_listed(splits: Splits) -> bool:
    """Whether the hot keys are few enough to be broadcast."""
    return splits.grid.listed if isinstance(splits, HotKeys) else len(splits) <= LISTED


def _combined(spark: SparkSession, splits: Sequence[Splits | None]) -> Grid:
    """One grid of the splits of all sides, the left one first."""
    grids = [_given(spark, s) for s in splits]
    named = [(side, g) for side, g in enumerate(grids) if g.frame is not None]
    if not named:
        return Grid(None, nulls=grids[0].nulls)
    tables = [g.frame.select("key", F.lit(side).alias("side"), F.col("g")[0].alias("parts")) for side, g in named]
    parts = [F.coalesce(F.max(F.when(F.col("side") == i, F.col("parts"))), F.lit(1)) for i in range(len(splits))]
    frame = _union(tables).groupBy("key").agg(F.array(*parts).alias("g"))
    listed = all(g.listed for _, g in named)
    known = [g.heavy for _, g in named]
    heavy = None if None in known else sorted({b for some in known for b in some})
    return Grid(frame, listed, grids[0].nulls, heavy)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


# --- places


def split_count(key: Column, splits: Splits) -> Column:
    """The number of tasks of a few given keys."""
    result = F.lit(1)
    for name, n in splits.items():
        result = F.when(key.isNull() if name is None else key.cast("string") == F.lit(name), n).otherwise(result)
    return result


def free_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, or a longer name if a frame has such a column, whatever its case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def place_of(frame: DataFrame) -> Column:
    """A number to deal rows out by, the same when a lost task runs again, which a random number is not.

    The hash spreads different rows, the partition number spreads copies of one row. Columns of types that
    Spark does not hash, maps at any depth, are left out of it.
    """
    named = [F.col(f"`{f.name}`") for f in frame.schema.fields if _hashable(f.dataType)]
    return F.xxhash64(F.lit(0), *named) + F.spark_partition_id()


def _own_split(frame: DataFrame, key: str, splits: Splits) -> Column:
    return F.pmod(place_of(frame), split_count(F.col(key), splits)).cast("int")


def hot_marked(frame: DataFrame, key: str, splits: Splits, name: str) -> DataFrame:
    """``frame`` with the number of tasks of its key as a column, NULL where the key is not hot."""
    grid = _given(frame.sparkSession, splits)
    marked = grid.marked(frame, key, name).withColumn(name, F.col(name)[0])
    if grid.nulls > 1:
        marked = marked.withColumn(name, F.when(F.col(key).isNull(), grid.nulls).otherwise(F.col(name)))
    return marked


def _celled(frame: DataFrame, key: str, grid: Grid, side: int, sides: int, parts: str, cell: str) -> DataFrame:
    """Every row once for each cell of its key that it belongs to.

    The cells of a key are numbered like digits: a row has one digit of its own, that of its side, and goes to all
    cells that have it.
    """
    place = free_name("_place", frame)
    marked = grid.marked(frame.withColumn(place, place_of(frame)), key, parts)
    g = [f"get(`{parts}`, {i})" for i in range(sides)]
    below, above = (" * ".join(["1", *some]) for some in (g[:side], g[side + 1 :]))
    own = f"pmod(`{place}`, {g[side]})"
    cells = (
        f"flatten(transform(sequence(0, {above} - 1), h -> transform(sequence(0, {below} - 1), "
        f"l -> cast(l + {below} * ({own} + {g[side]} * h) AS int))))"
    )
    alone = "array(0)"
    if side == 0 and grid.nulls > 1:
        alone = f"IF(`{key}` IS NULL, array(cast(pmod(`{place}`, {grid.nulls}) AS int)), array(0))"
    return marked.withColumn(cell, F.expr(f"explode(IF(`{parts}` IS NULL, {alone}, {cells}))")).drop(place)


# --- joins


def join_chain(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    how: str = "left",
    left_splits: Splits | None = None,
    right_splits: Sequence[Splits | None] | None = None,
    grid: Grid | None = None,
) -> DataFrame:
    """Join ``left`` to each of ``rights`` on one shared key, ``how`` being ``left`` or ``inner``.

    ``grid`` (``measure_grid``) cuts the rows of its keys on each side; the parts of all sides meet in cells, and
    every combination of rows meets in one cell. All joins of the chain use the same key and cell. In place of a
    grid, splits of single sides can be given. With ``how="left"``, a key that a right frame's rows are cut by must
    occur in that frame: a left row of such a key is dropped from the cells where no right row of it landed, because
    it is matched in another one. Left rows without a key find no partner, but are spread if the grid says so.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    sides = len(rights) + 1
    if grid is None:
        given = list(right_splits or [None] * len(rights))
        if len(given) != len(rights):
            raise ValueError("right_splits must have an entry for each right frame")
        # rows without a key never join, so only the left side's are kept, and spread
        named = [s if isinstance(s, HotKeys) else {k: n for k, n in (s or {}).items() if k is not None} for s in given]
        grid = _combined(left.sparkSession, [left_splits, *named])
    rights = [right.where(F.col(key).isNotNull()) for right in rights]
    if not grid:
        return reduce(lambda a, b: a.join(b, key, how), rights, left)
    cell, parts, met = (free_name(n, left, *rights) for n in ("_cell", "_parts", "_matched"))
    left = _celled(left, key, grid, 0, sides, parts, cell)
    for side, right in enumerate(rights, 1):
        # Spark's estimate of a size does not count the copies, so it must not choose to broadcast them
        right = _celled(right, key, grid, side, sides, parts, cell).drop(parts).hint("merge")
        if how == "left":
            right = right.withColumn(met, F.lit(True))
        left = left.join(right, [key, cell], how)
        if how == "left":
            whole = F.coalesce(F.get(parts, F.lit(side)), F.lit(1)) == 1
            left = left.where(whole | F.col(met).isNotNull()).drop(met)
    return left.drop(cell, parts)


def split_lookup(left: DataFrame, right: DataFrame, key: str, second: str, tasks: str) -> DataFrame:
    """Add the columns of ``right``, unique by two columns, to matching left rows; the first key is split.

    NULLs match each other. ``tasks`` is a column of both with the number of tasks of the key; it is dropped.
    """
    names = ("_left_split", "_right_split", "_key", "_second")
    own, other, key2, second2 = (free_name(n, left, right) for n in names)
    left = left.withColumn(own, F.pmod(place_of(left), F.col(tasks)).cast("int")).drop(tasks)
    right = right.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(tasks) - 1))).drop(tasks)
    right = right.withColumnsRenamed({key: key2, second: second2})
    on = (
        F.col(key).eqNullSafe(F.col(key2))
        & F.col(second).eqNullSafe(F.col(second2))
        & (F.col(own) == F.col(other))
    )
    return left.join(right.hint("merge"), on).drop(key2, second2, own, other)  # copies that no estimate counts


def spread_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread: int = SPREAD,
    heavy: Sequence[int] | None = None,
) -> DataFrame:
    """Left join to unique keys; keys with many left rows are spread over ``spread`` tasks, as left rows without a key are.

    Only right rows of such keys are copied: those in the buckets ``heavy``, which are counted here if they are not
    given. Other keys go to one task each. Keys that are not both plain strings are all spread.
    """
    own, other, mark = (free_name(n, left, right) for n in ("_left_split", "_right_split", "_heavy"))
    plain = all(f.select(key).schema[0].dataType == StringType() for f, key in ((left, left_key), (right, right_key)))
    many = F.lit(True)
    if plain:
        heavy = heavy_buckets(left, F.col(left_key)) if heavy is None else heavy
        many = F.lit(False)
        if heavy:
            spark, number = left.sparkSession, free_name("_bucket", left, right)
            marks = spark.createDataFrame(pa.table({number: pa.array(heavy, pa.int32()), mark: pa.array([True] * len(heavy))}))
            marked = lambda f, key: f.join(F.broadcast(marks), _bucket(F.col(key)) == F.col(number), "left").drop(number)
            left, right, many = marked(left, left_key), marked(right, right_key), F.coalesce(mark, F.lit(False))
    dealt = many | F.col(left_key).isNull()
    left = left.withColumn(own, F.when(dealt, F.pmod(place_of(left), F.lit(spread)).cast("int")).otherwise(0))
    copies = F.when(many, F.lit(spread)).otherwise(1)
    right = right.withColumn(other, F.explode(F.sequence(F.lit(0), copies - 1)))
    if heavy or not plain:
        right = right.hint("merge")  # no estimate counts the copies
    left, right = left.drop(mark), right.drop(mark)
    on = (F.col(left_key) == F.col(right_key)) & (F.col(own) == F.col(other))
    return left.join(right, on, "left").drop(own, other)
