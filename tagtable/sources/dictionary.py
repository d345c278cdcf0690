"""Code dictionaries: ``code,name`` text lines, and a size-checked handle on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# A dictionary is broadcast only if it has at most this many entries and no longer name.
BROADCAST_CODES = 10_000
BROADCAST_NAME_CHARS = 1_000


def read_dictionary(spark: SparkSession, path: str, trim: bool = False) -> DataFrame:
    """Read ``code,name`` lines; the last line of a code wins, a line without a name fails the read.

    Fields after the second are ignored and names keep their blanks unless ``trim``.
    """
    lines = spark.read.text(path).select(
        F.split(F.regexp_replace("value", ",+$", ""), ",").alias("fields"),
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )
    name = F.when(F.size("fields") >= 2, F.get("fields", F.lit(1))).otherwise(
        F.raise_error(F.concat(F.lit("dictionary line without a name: "), "value"))
    )
    return (
        lines.select(F.get("fields", F.lit(0)).alias("code"), name.alias("name"), "place")
        .groupBy("code")
        .agg(F.max_by("name", "place").alias("name"))
        .select("code", (F.trim("name") if trim else F.col("name")).alias("name"))
    )


class CodeBook:
    """A dictionary frame ``(code, name)`` with a check of its size made once.

    Codes are unique here whatever the frame: of several names of a code the greatest holds, as ``read_dictionary``
    already leaves one. A code with a NULL name counts as unknown.
    """

    def __init__(self, frame: DataFrame):
        known = frame.select("code", "name").where("code IS NOT NULL AND name IS NOT NULL")
        self.frame = known.groupBy("code").agg(F.max("name").alias("name"))
        self._small: dict[str, str] | None = None
        self._checked = False

    def _check(self) -> None:
        if self._checked:
            return
        # Bounded look: one entry and one character over the bounds is enough to tell "too large".
        cut = [F.substring(c, 1, BROADCAST_NAME_CHARS + 1).alias(c) for c in ("code", "name")]
        rows = self.frame.select(*cut).limit(BROADCAST_CODES + 1).collect()
        longest = max((len(r[c]) for r in rows for c in ("code", "name")), default=0)
        if len(rows) <= BROADCAST_CODES and longest <= BROADCAST_NAME_CHARS:
            self._small = {r["code"]: r["name"] for r in rows}
        self._checked = True

    def fits(self, codes: int = BROADCAST_CODES) -> bool:
        self._check()
        return self._small is not None and len(self._small) <= codes

    def entries(self, codes: int = BROADCAST_CODES) -> dict[str, str]:
        if not self.fits(codes):
            raise ValueError(f"dictionary has over {codes} entries or over-long names; join it instead")
        return dict(self._small)
