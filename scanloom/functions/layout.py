"""What the axes of a stored series mean, from its shape and its declared number of frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_layout(shape: Column, n_attr: Column) -> Column:
    """``single``, ``channels_first``, ``cine0`` (frames on axis 0), ``cine1`` or NULL for other ranks.

    Rank 3: a first axis of 1 or 3 is a channel axis, unless it is the declared frame count. Rank 4: the
    declared count decides when it fits exactly one of the first two axes; else the axis of 1 or 3 is
    the channel; when both could be, the singleton is the frame axis; else frames come first.
    """
    rank = F.size(shape)
    a0, a1 = F.get(shape, F.lit(0)), F.get(shape, F.lit(1))
    small = [x.isin(1, 3) for x in (a0, a1)]
    fits = [F.coalesce(n_attr == x, F.lit(False)) for x in (a0, a1)]
    four = (
        F.when(fits[0] & ~fits[1], "cine0").when(fits[1] & ~fits[0], "cine1")
        .when(small[0] & ~small[1], "cine1").when(small[1] & ~small[0], "cine0")
        .when(small[0] & small[1] & (a1 == 1) & (a0 != 1), "cine1").otherwise("cine0")
    )
    return F.when(rank == 2, "single").when(rank == 3, F.when(small[0] & ~fits[0], "channels_first").otherwise("cine0")).when(rank == 4, four)


def frame_count(shape: Column, layout: Column) -> Column:
    return F.when(layout == "cine0", F.get(shape, F.lit(0))).when(layout == "cine1", F.get(shape, F.lit(1))).when(layout.isNotNull(), F.lit(1))
