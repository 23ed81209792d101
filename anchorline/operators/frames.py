"""Frames and windows over them: sliding means by panes, overlapped predictions added up, token intervals.

A sliding window is a run of panes, the pane being the longest span that divides both
window and hop. Rows are summed up by pane first, so what is shuffled does not grow with
the number of windows that a row falls in; a window is then a running sum over panes.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorline.functions.numeric import half_even


def sliding_means(rows: DataFrame, keys: list[str], frame: str, value: str, length: DataFrame, size: int, hop: int, least: int) -> DataFrame:
    """(keys, start, n, mean) of every window of ``size`` frames at each multiple of ``hop``.

    ``length``: (keys, frames), the frames of each timeline. Windows go on while ``least`` frames are left; the last ones
    are shorter. A window without rows has n 0 and mean 0. Rows beyond the length, and those without a value, don't count.
    """
    pane = gcd(size, hop)
    sums = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.floor(F.col(frame) / pane).alias("pane")).agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
    # Where windows begin, also between rows: a start has no weight of its own.
    starts = length.where(F.col("frames") >= least).select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("frames") - least).cast("bigint"), F.lit(hop).cast("bigint"))).alias("start"))
    marks = starts.select(*keys, (F.col("start") / pane).cast("bigint").alias("pane"), F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n"), F.col("start"))
    both = sums.select(*keys, F.col("pane").cast("bigint").alias("pane"), F.col("s").cast("double").alias("s"), "n", F.lit(None).cast("bigint").alias("start")).unionByName(marks)
    ahead = Window.partitionBy(*keys).orderBy("pane").rangeBetween(0, size // pane - 1)
    summed = both.select(*keys, "start", F.sum("s").over(ahead).alias("s"), F.sum("n").over(ahead).alias("n"))
    return summed.where("start IS NOT NULL").select(*keys, "start", "n", F.coalesce(F.try_divide("s", "n"), F.lit(0.0)).alias("mean"))


def overlap_add(predictions: DataFrame, key: str, clips: DataFrame, hop: float, least_tail: float) -> DataFrame:
    """(key, frame, class, p): means of overlapped windows' predictions on one grid of frames, 0 where there are none.

    ``predictions``: (key, start, i, class, p), ``i`` being the frame inside the window that begins at ``start``; ``clips``:
    (key, duration). A window with less than ``least_tail`` left does not count; every class of a clip has every frame.
    """
    c = clips.select(F.col(key).alias("__key"), "duration", F.greatest(F.lit(1), F.ceil(F.col("duration") / hop)).cast("bigint").alias("frames"))
    near = predictions.join(c, predictions[key] == F.col("__key"))
    frame = half_even(F.col("start") / hop + F.col("i"))
    used = near.where(F.col("duration") - F.col("start") >= least_tail).withColumn("frame", frame).where("frame >= 0 AND frame < frames")
    means = used.groupBy(key, "frame", "class").agg(F.avg("p").alias("p"))
    grid = near.select(key, "class", "frames").distinct().select(key, "class", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("frames") - 1)).alias("frame"))
    return grid.join(means, [key, "frame", "class"], "left").select(key, "frame", "class", F.coalesce("p", F.lit(0.0)).alias("p"))


#: Seconds of a token window, frames sampled in it, and frames of one token.
WINDOW_S, SAMPLES, TUBELET = 4, 16, 2


def token_intervals(duration_ms: Column, fps: Column) -> Column:
    """What each token of a clip covers: array<struct<token_index,window_ms,start_ms,end_ms>>.

    A window's frames are sampled evenly up to one frame before its end; a token's interval meets its neighbours' half
    way between their samples, and the window's ends at its own.
    """
    seconds = duration_ms / 1000.0
    tokens = SAMPLES // TUBELET

    def window(start_ms: Column) -> Column:
        a = start_ms / 1000.0
        b = F.least(seconds, a + WINDOW_S)
        step = (F.greatest(a, b - 1.0 / F.greatest(fps, F.lit(1.0))) - a) / (SAMPLES - 1)
        border = lambda i: ((a + (i * TUBELET - 1) * step) + (a + i * TUBELET * step)) / 2
        index = (start_ms / (1000 * WINDOW_S)).cast("bigint") * tokens

        def token(i: Column) -> Column:
            left, right = F.when(i == 0, a).otherwise(border(i)), F.when(i == tokens - 1, b).otherwise(border(i + 1))
            return F.struct((index + i).alias("token_index"), start_ms.alias("window_ms"), F.greatest(F.lit(0).cast("bigint"), half_even(left * 1000)).alias("start_ms"), F.least(duration_ms.cast("bigint"), half_even(right * 1000)).alias("end_ms"))

        return F.transform(F.sequence(F.lit(0), F.lit(tokens - 1)), token)

    starts = F.when(duration_ms > 0, F.sequence(F.lit(0).cast("bigint"), duration_ms.cast("bigint") - 1, F.lit(1000 * WINDOW_S).cast("bigint")))
    return F.flatten(F.transform(F.coalesce(starts, F.array().cast("array<bigint>")), window))
