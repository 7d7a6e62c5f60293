"""Pile streams as Structured Streaming: a pile leaves when its ``+`` line arrives."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandmill.operators.consensus import MAX_READ
from strandmill.session import object_frame, ship_package

OUTPUT = "stream string, pile long, ord long, read_id string, sequence string"
STATE = "pile long, ended boolean, ords array<long>, ids array<string>, sequences array<string>"


def _advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pile, ended, ords, ids, sequences = state.get if state.exists else (0, False, [], [], [])
    ords, ids, sequences = list(ords), list(ids), list(sequences)
    out = []
    rows = pd.concat(list(frames)).sort_values("ord", kind="stable")
    for at, line in zip(rows["ord"], rows["line"], strict=True):
        words = (line or "").split()
        if ended or len(words) != 2:
            continue
        read, sequence = words
        if read == "-":
            ended = True
        elif read in "+*":
            if read == "+":
                out += [(key[0], pile, *r) for r in zip(ords, ids, sequences, strict=True)]
            pile, ords, ids, sequences = pile + 1, [], [], []
        else:
            ords.append(int(at))
            ids.append(read)
            sequences.append(sequence[: MAX_READ - 1] if len(sequence) > MAX_READ else sequence)
    state.update((pile, ended, ords, ids, sequences))
    yield object_frame(out, ["stream", "pile", "ord", "read_id", "sequence"])


def closed_piles(lines: DataFrame) -> DataFrame:
    """Streaming ``stream, ord, line`` -> rows of closed piles, like the batch ``pile_rows``.

    The open pile of each stream is its state. ``*`` discards it; after ``-`` a stream's further lines are ignored and what is open is dropped.
    Lines of a stream must arrive in order of micro-batches; within one they are put in order of ``ord``.
    """
    ship_package(lines.sparkSession)
    return lines.groupBy("stream").applyInPandasWithState(_advance, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
