"""Seams for what runs outside Spark: media access, recognisers, language models.

Each seam is a protocol; results come into the engine as tables. Nothing here invents
results: what is not configured raises.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Detector(Protocol):
    """Frames of class probabilities for one clip: columns frame, label, prob."""

    def __call__(self, clip: str) -> pd.DataFrame: ...


class Asker(Protocol):
    """A language model: prompt in, text out."""

    def __call__(self, prompt: str) -> str: ...


def unconfigured(what: str) -> Callable[..., None]:
    def fail(*_: object, **__: object) -> None:
        raise NotImplementedError(f"no {what} is configured")

    return fail


def ask_each(df: DataFrame, ask: Asker, prompt_col: str, out_col: str = "answer") -> DataFrame:
    """``df`` plus the answers; calls run where the rows are, a batch at a time."""
    schema = df.drop(out_col).selectExpr("*", f"'' AS {out_col}").schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(**{out_col: [ask(p) for p in b[prompt_col]]})

    return df.drop(out_col).mapInPandas(run, schema)


def table_detector(frames: DataFrame, clips: DataFrame, clip_col: str = "clip") -> DataFrame:
    """Detector frames that were computed before, for the given clips."""
    return frames.join(clips.select(clip_col).distinct(), clip_col, "left_semi")
