"""Exact dedup with a heavy-hitter split.

Every partition keeps a Misra-Gries summary of its digests; merged, the summaries name at most ``counters``
digests that can hold more than 2 / (counters + 1) of all rows. An exact pass counts these candidates and finds
their winners; that table, bounded by ``counters`` rows, is broadcast and settles its rows map-side. All
other digests are in small groups by the summaries' guarantee and go through an ordinary shuffle.

Defined results: a null text counts as empty; very long texts are digested whole; a null doc_id sorts after all others; of rows that repeat the
smallest doc_id one stays; other columns, whatever their names, are ignored or passed through; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.llm.rowkeys import with_row_key
from strandmill.session import settle, ship_package, spill

COUNTERS = 512


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def misra_gries(counters: int):
    """A partition function: batches of ``digest`` -> at most ``counters`` rows (digest, estimate)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: Counter = Counter()
        for batch in batches:
            kept.update(batch.column(0).to_pylist())
            if len(kept) > counters:
                # Taking the (counters + 1)-th largest count from all is as many single decrements at once.
                cut = sorted(kept.values(), reverse=True)[counters]
                kept = Counter({d: n - cut for d, n in kept.items() if n > cut})
        yield pa.RecordBatch.from_pydict({"digest": pa.array(list(kept), pa.binary()), "estimate": pa.array(list(kept.values()), pa.int64())})

    return run


def frequent_digests(rows: DataFrame, n_rows: int, counters: int = COUNTERS) -> DataFrame:
    """Exact ``digest, group_size, keep`` of the digests whose merged estimate passes n_rows / (counters + 1).

    Summaries underestimate by n_rows / (counters + 1) in all at most, so each digest with more than twice that is among them.
    """
    ship_package(rows.sparkSession)
    summaries = rows.select("digest").mapInArrow(misra_gries(counters), "digest binary, estimate long")
    names = summaries.groupBy("digest").agg(F.sum("estimate").alias("estimate")).filter(F.col("estimate") > F.lit(n_rows / (counters + 1)))
    names = settle(names.select("digest"))  # at most counters + 1 rows: the estimates sum to n_rows or less
    hits = rows.join(F.broadcast(names), "digest")
    return settle(hits.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min("me").alias("keep")).filter("group_size > 1"))


def _rows(docs: DataFrame, row: Column) -> DataFrame:
    """``digest, me``: who a document is, the smallest first, told apart by ``row``."""
    digest = F.unhex(F.sha2(normalised(docs["text"].cast("string")), 256))
    me = F.struct(docs["doc_id"].isNull().alias("no_id"), docs["doc_id"].alias("doc_id"), row.alias("row"))
    return settle(docs.select(digest.alias("digest"), me.alias("me")))


def _groups(rows: DataFrame, counters: int) -> DataFrame:
    """Adds ``group_size`` and ``keep`` to ``digest, me``."""
    winners = frequent_digests(rows, rows.count(), counters)
    split = rows.join(F.broadcast(winners), "digest", "left")
    heavy = split.filter(F.col("keep").isNotNull())
    rest = split.filter(F.col("keep").isNull()).select("digest", "me")
    # Counted with a map-side combine and settled: the join then has plain exchanges, and a digest just below the candidates' share can be split.
    small = settle(rest.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min("me").alias("keep")).filter("group_size > 1"))
    rest = rest.join(small, "digest", "left").select("digest", "me", F.coalesce("group_size", F.lit(1)).alias("group_size"), F.coalesce("keep", "me").alias("keep"))
    return heavy.select("digest", "me", "group_size", "keep").unionByName(rest)


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per document ``doc_id, keep_id, group_size, kept, text_sha256``."""
    return _groups(_rows(docs, F.monotonically_increasing_id()), counters).select(
        F.col("me.doc_id").alias("doc_id"),
        F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("me.row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, one of each group of equal texts, with the columns of ``docs``.

    Rows go by their own key, so null and repeated ids are no matter; texts are only moved if the table of those that go is too large to broadcast.
    """
    keyed, key = with_row_key(docs)
    groups = _groups(_rows(keyed, keyed[key]), counters)
    gone = spill(groups.filter("me.row <> keep.row").select(F.col("me.row").alias(key)))
    return keyed.join(gone, key, "left_anti").select(*docs.columns)
