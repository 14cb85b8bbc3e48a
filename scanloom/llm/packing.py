"""Filling fixed-capacity containers: shortest-pack-first over the histogram of lengths.

Only the histogram matters for the packing, and it has at most as many entries as the capacity. Lengths
are placed longest first, each into the pack that is shortest so far, a whole group of equal packs at
once; when not even the shortest has room, new packs open. Each placement says: so many items of this
length, from this rank on, go into packs numbered from here on. Documents get their rank among those of
equal length and are joined to the placements; how full each pack got is known from the placements too.

Items are whole documents; only a document longer than the capacity is cut, into full packs and a rest.
Full pieces need no place among others: they are packs of their own, numbered after the others by the
running total of their documents.

Defined results: documents with NULL or empty text have no tokens, need no room and are reported in pack
-1 with fill 0; ties in length go by hash of the id, so results repeat; repeated documents are items of
their own; an empty table gives no packs.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

#: Rows that are ranked together: frequent lengths are ranked in as many parts as that takes.
RANKED_ROWS = 100_000
#: Ranks per join key between items and placements: so many at least, and at most so many keys per length.
RANK_BLOCK, RANK_BLOCKS = 4096, 256


Placement = tuple[int, int, int, int]


def place_all(histogram: dict[int, int], capacity: int) -> tuple[list[Placement], list[tuple[int, int, int]]]:
    """(placements, rooms): (length, first rank, number, first pack) for lengths 1..capacity, and the room left as (first pack, number, room).

    Packs count from 0; those without room are not listed.
    """
    out: list[Placement] = []
    spaces: dict[int, list[tuple[int, int]]] = {}  # room left: ranges (first pack, number)
    heap: list[int] = []
    packs = 0

    def give(room: int, first: int, n: int) -> None:
        if room > 0:
            if room not in spaces:
                spaces[room] = []
                heapq.heappush(heap, -room)
            spaces[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if heap and -heap[0] >= length:
                room = -heap[0]
                first, n = spaces[room].pop()
                if not spaces[room]:
                    del spaces[room]
                    heapq.heappop(heap)
                take = min(n, left)
                if take < n:
                    give(room, first + take, n - take)
            else:
                room, first, take = capacity, packs, max(1, min(left, -(-left // max(1, capacity // length))))
                packs += take
            out.append((length, rank, take, first))
            give(room - length, first, take)
            left, rank = left - take, rank + take
    return out, [(first, n, room) for room, ranges in spaces.items() for first, n in ranges]


def place(histogram: dict[int, int], capacity: int) -> list[Placement]:
    return place_all(histogram, capacity)[0]


def _ranked(df: DataFrame, counts: DataFrame, group: str, weight: Column, id_col: str, name: str) -> DataFrame:
    """Adds the total weight of the rows of the group before each, in the order of the id's hash.

    ``counts`` is a written table of the groups' rows ``n``; a group is summed up in parts of about
    ``RANKED_ROWS``, so a frequent one is no hot group.
    """
    hashed = F.xxhash64(id_col)
    cut = df.join(counts, group).withColumn("__part", F.pmod(hashed, F.ceil(F.col("n") / RANKED_ROWS))).drop("n")
    sums = cut.groupBy(group, "__part").agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(group, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(group, "__part").orderBy(hashed, id_col).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("__within", F.coalesce(F.sum(weight).over(within), F.lit(0))).join(starts, [group, "__part"])
    return summed.withColumn(name, F.col("__start") + F.col("__within")).drop("__part", "__within", "__start")


def _blocked(ranges: DataFrame, first: str, n: str, width: Column, name: str) -> DataFrame:
    """``ranges`` once per block of ``width`` numbers that it reaches into; written, so that its size is known."""
    blocks = F.sequence(F.floor(F.col(first) / width), F.floor((F.col(first) + F.col(n) - 1) / width))
    return stored(ranges.withColumn(name, F.explode(blocks)), "ranges")


def packed(sizes: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """(pack_id, doc_id, part, start_token, n_tokens, fill) for every piece of every document.

    ``sizes`` has the id and ``tokens``. fill is the share of the pack's capacity that is used.
    """
    spark = sizes.sparkSession
    docs = sizes.select(id_col, F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens"))
    docs = docs.select(id_col, "tokens", F.floor(F.col("tokens") / capacity).alias("full"), (F.col("tokens") % capacity).cast("int").alias("length"))
    counts = stored(docs.where("tokens > 0").groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("full") > 0).alias("bulky")), "lengths")
    rows = counts.collect()  # at most as many as the capacity
    histogram = {r["length"]: r["n"] for r in rows if r["length"]}
    placements, rooms = place_all(histogram, capacity)
    packs = max((first + n for _, _, n, first in placements), default=0)

    # rests: by rank among equal lengths to the placements
    plan = spark.createDataFrame([(*p, max(RANK_BLOCK, -(-histogram[p[0]] // RANK_BLOCKS))) for p in placements], "length int, first_rank bigint, number bigint, first_pack bigint, width bigint")
    widths = stored(plan.select("length", "width").distinct(), "widths")
    plan = _blocked(plan, "first_rank", "number", F.col("width"), "block").drop("width")
    ranked = _ranked(docs.where("length > 0"), counts.select("length", "n"), "length", F.lit(1), id_col, "rank")
    ranked = ranked.join(widths, "length").withColumn("block", F.floor(F.col("rank") / F.col("width")))
    placed = ranked.join(plan, ["length", "block"]).where("rank >= first_rank and rank < first_rank + number").select(
        (F.col("first_pack") + F.col("rank") - F.col("first_rank")).alias("pack_id"), id_col, F.col("full").cast("int").alias("part"),
        (F.col("full") * capacity).alias("start_token"), F.col("length").cast("bigint").alias("n_tokens"),
    )
    # the room each pack was left with
    wide = max(RANK_BLOCK, -(-packs // RANK_BLOCK))
    room = _blocked(spark.createDataFrame(rooms, "first bigint, number bigint, room int"), "first", "number", F.lit(wide), "near")
    inside = (F.floor(F.col("pack_id") / wide) == F.col("near")) & (F.col("pack_id") >= F.col("first")) & (F.col("pack_id") < F.col("first") + F.col("number"))
    fill = (F.lit(float(capacity)) - F.coalesce("room", F.lit(0))) / float(capacity)
    placed = placed.join(room, inside, "left").select("pack_id", id_col, "part", "start_token", "n_tokens", fill.alias("fill"))

    # full pieces: packs of their own after the others
    bulky = docs.where("full > 0").withColumn("all", F.lit(0))
    total = stored(counts.groupBy(F.lit(0).alias("all")).agg(F.sum("bulky").alias("n")), "bulky")
    whole = _ranked(bulky, total, "all", F.col("full"), id_col, "before").withColumn("part", F.explode(F.sequence(F.lit(0), (F.col("full") - 1).cast("int"))))
    whole = whole.select(
        (F.lit(packs) + F.col("before") + F.col("part")).alias("pack_id"), id_col, "part", (F.col("part").cast("bigint") * capacity).alias("start_token"),
        F.lit(capacity).cast("bigint").alias("n_tokens"), F.lit(1.0).alias("fill"),
    )
    bare = docs.where("tokens = 0").select(F.lit(-1).cast("bigint").alias("pack_id"), id_col, F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("start_token"), F.lit(0).cast("bigint").alias("n_tokens"), F.lit(0.0).alias("fill"))
    return placed.union(whole).union(bare)


def packed_kinds(sizes: DataFrame, kinds: list[tuple[str, int]], id_col: str = "doc_id") -> DataFrame:
    """``packed`` for several (kind, capacity), with ``pack_kind``; no kinds give no packs."""
    out = None
    for kind, capacity in kinds:
        packs = packed(sizes, capacity, id_col).select(F.lit(kind).alias("pack_kind"), "*")
        out = packs if out is None else out.union(packs)
    if out is None:
        out = packed(sizes.limit(0), 1, id_col).select(F.lit("").alias("pack_kind"), "*")
    return out
