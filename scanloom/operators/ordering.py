"""Order inside series and studies: slice boundaries, chosen frames, folder limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.natural import natural_key
from ..session import cut

# Limits that change results, so they are kept.
MAX_FOLDER_FILES = 2500
MAX_FOLDERS = 10
POSITIONS = ("first", "middle", "last")


def frame_index(df: DataFrame, keys: list[str], order: list[Column], name: str = "frame_idx") -> DataFrame:
    """0-based place of each frame in its series."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def slice_boundaries(df: DataFrame, keys: list[str], location: Column, order: list[Column]) -> DataFrame:
    """Per series: n_frames and slice_frames, the indexes of the last frame of every slice but the last.

    NULL locations are a slice of their own; a series of one slice has an empty list.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.select(*keys, (F.row_number().over(w) - 1).alias("i"), location.alias("loc"), F.lead(location).over(w).alias("nxt"), F.lead(F.lit(1)).over(w).alias("more"))
    boundary = F.when((F.col("more") == 1) & ~F.col("loc").eqNullSafe(F.col("nxt")), F.col("i"))
    return marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_frames"), F.array_sort(F.collect_list(boundary)).alias("slice_frames"))


def check_positions(positions: tuple[str, ...]) -> tuple[str, ...]:
    if not positions or any(p not in POSITIONS for p in positions):
        raise ValueError(f"positions must be a non-empty subset of {POSITIONS}")
    return tuple(dict.fromkeys(positions))


def frame_positions(df: DataFrame, keys: list[str], order: list[Column], positions: tuple[str, ...] = POSITIONS) -> DataFrame:
    """The rows at the wanted positions of each series; where two positions fall on one frame the first wanted stays."""
    wanted = check_positions(positions)
    w = Window.partitionBy(*keys)
    n, i = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order)) - 1
    at = {"first": F.lit(0), "middle": F.floor(F.col("__n") / 2), "last": F.col("__n") - 1}
    named = df.withColumn("frame_idx", i).withColumn("__n", n)
    label = F.coalesce(*[F.when(F.col("frame_idx") == at[p], p) for p in wanted])
    return named.withColumn("frame_pos", label).where("frame_pos is not null").withColumnRenamed("__n", "n_frames")


def sized_folders(df: DataFrame, folder_keys: list[str], most: int = MAX_FOLDER_FILES) -> DataFrame:
    """Folders with 0 < files < most, and their file counts ``n``."""
    return df.groupBy(*folder_keys).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 0) & (F.col("n") < most))


def folder_cap(folders: DataFrame, keys: list[str], order: list[Column], n: str = "n", folders_max: int = MAX_FOLDERS, frames_max: int = MAX_FOLDER_FILES) -> DataFrame:
    """Per study the first ``folders_max`` folders in order, as long as they total ``frames_max`` files; at least one."""
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = folders.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= folders_max)
    total = F.sum(n).over(Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumn("running", total.cast("bigint")).where((F.col("running") <= frames_max) | (F.col("rank") == 1))


def by_location(folders: DataFrame, keys: list[str], location: str, name: str) -> DataFrame:
    """Adds the order of folders: ``o_loc`` to sort descending, then ``o_name``, the natural key.

    Where a location of the group is missing, o_loc is NULL for all of it and names alone decide.
    """
    missing = F.max(F.col(location).isNull().cast("int")).over(Window.partitionBy(*keys))
    return folders.withColumn("__missing", missing).withColumn("o_loc", F.when(F.col("__missing") == 0, F.col(location))).withColumn("o_name", natural_key(F.col(name))).drop("__missing")


def strided(df: DataFrame, index: Column, step: int) -> DataFrame:
    """Every step-th frame."""
    return df.where(index % step == 0)


def boundary_frames(series: DataFrame, step: int = 1) -> DataFrame:
    """(series columns, frame_idx): every step-th slice boundary of each series, for one picture per slice."""
    picked = F.filter("slice_frames", lambda x, i: i % step == 0)
    return series.withColumn("frame_idx", F.explode(picked))


def places(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """Adds the 1-based place of every row in an order over the whole table, without a single-task sort.

    Rows are range-partitioned and sorted; only the row counts of the partitions meet, one row each.
    """
    placed = cut(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cut(sizes.select("__p", before.alias("__start")))
    return placed.withColumn("__p", part).join(starts, "__p").withColumn(name, (F.col("__start") + within + 1).cast("bigint")).select(*df.columns, name)
