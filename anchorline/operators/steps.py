"""Steps of a session out of its log: begin and end events paired, in the order in which steps begin.

Log rows: (session, seq, kind, step_id, title, elapsed_s). A step begins with its first
``step_begin``; later rows with its id belong to it, ``step_end`` ends it. Rows without an
id, or before their step begins, are loose; ``session_start`` rows are neither.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, BEGIN, END = "session_start", "step_begin", "step_end"


def rollup_steps(log: DataFrame) -> DataFrame:
    """(session, step_no, step_id, title, begin_seq, n_events, ended, elapsed_s, loose) for each step, open ones too.

    ``step_no`` counts from 0; ``elapsed_s`` is the last one that an end gives; ``loose``: rows with the step's id before it began.
    """
    rows = log.where((F.coalesce("step_id", F.lit("")) != "") & (F.col("kind") != START))
    begins = F.min(F.when(F.col("kind") == BEGIN, F.col("seq"))).over(Window.partitionBy("session", "step_id"))
    own = rows.withColumn("begin_seq", begins).where("begin_seq IS NOT NULL")
    inside, end = F.col("seq") >= F.col("begin_seq"), F.col("kind") == END
    told = inside & end & F.col("elapsed_s").isNotNull()
    steps = own.groupBy("session", "step_id", "begin_seq").agg(
        F.max(F.when(F.col("seq") == F.col("begin_seq"), F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise(F.col("step_id")))).alias("title"),
        F.count_if(inside).alias("n_events"), F.coalesce(F.max(inside & end), F.lit(False)).alias("ended"), F.max_by(F.when(told, F.col("elapsed_s")), F.when(told, F.col("seq"))).alias("elapsed_s"), F.count_if(~inside).alias("loose"),
    )
    n = F.row_number().over(Window.partitionBy("session").orderBy("begin_seq", "step_id")) - 1
    return steps.select("session", n.alias("step_no"), "step_id", "title", "begin_seq", "n_events", "ended", "elapsed_s", "loose")


def loose_events(log: DataFrame) -> DataFrame:
    """Rows that belong to no step."""
    begins = F.min(F.when((F.col("kind") == BEGIN) & (F.coalesce("step_id", F.lit("")) != ""), F.col("seq"))).over(Window.partitionBy("session", "step_id"))
    marked = log.where(F.col("kind") != START).withColumn("__begin", begins)
    return marked.where((F.coalesce("step_id", F.lit("")) == "") | F.col("__begin").isNull() | (F.col("seq") < F.col("__begin"))).drop("__begin")


STATE = "begin_seq long, title string, n_events long, ended boolean, elapsed_s double, loose long"
STREAMED = f"session string, step_id string, {STATE}"


def stream_steps(log: DataFrame) -> DataFrame:
    """The steps of a stream of log rows, in update mode: a row for each step that a batch changes, open ones too.

    State is one small row for each step. Batches come in the order of ``seq``; within a batch rows are sorted.
    Needs the RocksDB state store.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class Steps(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.step = handle.getValueState("step", STATE)

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            begin, title, n, ended, elapsed, loose = self.step.get() if self.step.exists() else (None, None, 0, False, None, 0)
            every = pd.concat(list(rows)).sort_values("seq")
            for r in every.itertuples():
                if begin is None and r.kind == BEGIN:
                    begin, title = int(r.seq), r.title or key[1]
                if begin is None:
                    loose += 1
                    continue
                n += 1
                if r.kind == END:
                    ended = True
                    elapsed = elapsed if pd.isna(r.elapsed_s) else float(r.elapsed_s)
            self.step.update((begin, title, n, ended, elapsed, loose))
            if begin is not None:
                yield pd.DataFrame([(*key, begin, title, n, ended, elapsed, loose)], columns=[c.split()[0] for c in STREAMED.split(", ")])

        def close(self) -> None:
            pass

    rows = log.where((F.coalesce("step_id", F.lit("")) != "") & (F.col("kind") != START))
    return rows.groupBy("session", "step_id").transformWithStateInPandas(Steps(), STREAMED, "update", "none")
