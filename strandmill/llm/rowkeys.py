"""A key for each row of a table whose ids may be null or repeat, under a name that no column has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.session import spill


def fresh_name(docs: DataFrame, stem: str) -> str:
    """``stem``, with as many underscores as tell it from every column of ``docs``; names count alike in either case."""
    taken = {c.lower() for c in docs.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def has_plain_ids(docs: DataFrame) -> bool:
    """Is ``doc_id`` a key: never null, never repeated?"""
    ids = docs.select(docs["doc_id"].alias("doc_id"))
    return ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty()


def with_row_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart, and that column's name.

    Where ``doc_id`` is a key it is its copy; else the table is written with row numbers, so that every reading gives the same ones.
    """
    key = fresh_name(docs, "row_key")
    if has_plain_ids(docs):
        return docs.withColumn(key, docs["doc_id"].cast("long")), key
    return spill(docs.withColumn(key, F.monotonically_increasing_id())), key
