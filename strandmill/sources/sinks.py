"""Writers of sequence, graph and report files, through Spark's own committers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.sequences import wrap
from strandmill.operators.assembly import base_contigs, named_tiling
from strandmill.operators.gfa import EDGE_COLUMNS, NODE_COLUMNS, PATH_COLUMNS, GfaGraph, gfa1_lines, gfa2_lines

# Fixed value: the line that ends an overlap file.
OVERLAP_END = "---"


def fasta_text(records: DataFrame, width: int | None = 60) -> DataFrame:
    """``value``: a record's header and its sequence in lines of ``width`` letters (None: one line)."""
    body = F.col("sequence") if width is None else wrap(F.col("sequence"), width)
    return records.select(F.concat(F.lit(">"), "name", F.lit("\n"), body).alias("value"))


def write_fasta(records: DataFrame, path: str, width: int | None = 60, gzip: bool = False) -> None:
    fasta_text(records, width).write.option("compression", "gzip" if gzip else "none").text(path)


def write_fasta_by(records: DataFrame, column: str, path: str, width: int | None = 8000, gzip: bool = False) -> None:
    """One folder per value of ``column``, such as a movie or a contig. A large group is written by several tasks."""
    body = F.col("sequence") if width is None else wrap(F.col("sequence"), width)
    rows = records.select(column, F.concat(F.lit(">"), "name", F.lit("\n"), body).alias("value"))
    rows.write.partitionBy(column).option("compression", "gzip" if gzip else "none").text(path)


def overlap_text(overlaps: DataFrame) -> DataFrame:
    columns = ["q_id", "t_id", "score", "identity", "q_strand", "q_s", "q_e", "q_l", "t_strand", "t_s", "t_e", "t_l", "tag"]
    return overlaps.select(F.concat_ws(" ", *[F.format_string("%.2f", c) if c == "identity" else F.col(c).cast("string") for c in columns]).alias("value"))


def write_overlaps(overlaps: DataFrame, path: str, marker: bool = False) -> None:
    """Rows as text; Spark's ``_SUCCESS`` file says that the write is complete. With ``marker`` each file that has rows ends with the line ``---``."""
    rows = overlap_text(overlaps)
    if marker:

        def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])
            yield pa.RecordBatch.from_arrays([pa.array([OVERLAP_END])], names=["value"])

        rows = rows.mapInArrow(closed, "value string")
    rows.write.option("maxRecordsPerFile", 0).text(path)


def edge_text(edges: DataFrame) -> DataFrame:
    return edges.select(F.format_string("%s %s %s %5d %5d %5d %5.2f %s", "v", "w", "rid", "sp", "tp", "score", "identity", "type").alias("value"))


def write_edges(edges: DataFrame, path: str) -> None:
    edge_text(edges).write.text(path)


def unitig_text(unitigs: DataFrame) -> DataFrame:
    path = F.when(F.col("type") == "compound", F.array_join("path", "|")).otherwise(F.array_join("path", "~"))
    return unitigs.select(F.concat_ws(" ", "s", "v", "t", "type", F.col("length").cast("string"), F.col("score").cast("string"), path).alias("value"))


def bubble_text(bubbles: DataFrame) -> DataFrame:
    numbers = [F.col(c).cast("string") for c in ("width", "length", "score")]
    return bubbles.select(F.concat_ws(" ", "s", "v", "t", *numbers, F.array_join("edges", "|")).alias("value"))


def contig_text(contigs: DataFrame) -> DataFrame:
    return contigs.select(F.concat_ws(" ", "ctg_id", "type", "start_edge", "end_node", F.col("length").cast("string"), F.col("score").cast("string"), "utgs").alias("value"))


def tiling_text(tiling: DataFrame) -> DataFrame:
    return tiling.select(F.format_string("%s %s %s %s %d %d %d %.2f", "ctg_id", "v", "w", "wrid", "b", "e", "score", "identity").alias("value"))


def write_text(rows: DataFrame, path: str) -> None:
    rows.select("value").write.text(path)


def track_text(tracks: DataFrame) -> DataFrame:
    return tracks.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in ("bread", "ctg", "count", "rank", "score", "in_ctg")]).alias("value"))


def write_tiling(tiling: DataFrame, path: str) -> None:
    """Tiling rows as text, each contig in one file and in order of its path, so that they can be read back. tiling: with ``ord``."""
    placed = tiling.repartition("ctg_id").sortWithinPartitions("ctg_id", "ord")
    tiling_text(placed).write.option("maxRecordsPerFile", 0).text(path)


def primary_records(sequences: DataFrame, contigs: DataFrame) -> DataFrame:
    """``name, sequence`` of primary contigs; names end with the contig's ends, type, length and score."""
    known = contigs.select(F.col("ctg_id").alias("k_id"), F.concat_ws("~", "start_edge", "end_node").alias("label"), "type", F.col("length").alias("k_length"), F.col("score").alias("k_score"))
    met = sequences.filter("bubble = 0").join(known, F.col("ctg_id") == F.col("k_id"))
    return met.select(F.concat_ws(" ", "ctg_id", "label", "type", F.col("k_length").cast("string"), F.col("k_score").cast("string")).alias("name"), "sequence")


def alternative_records(alternatives: DataFrame) -> DataFrame:
    """``name, sequence``; names end with first and last node, length, score, number of edges, difference in length, identity and coverage."""
    counts = [F.col(c).cast("string") for c in ("length", "score", "n_edges", "delta_len")]
    shares = [F.format_string("%.2f", c) for c in ("identity", "coverage")]
    return alternatives.select(F.concat_ws(" ", "name", "first_node", "last_node", *counts, *shares).alias("name"), "sequence")


def write_contigs(sequences: DataFrame, contigs: DataFrame, tiling: DataFrame, all_alternatives: DataFrame, path: str) -> None:
    """Sequences and tiling paths of primary contigs, of alternatives and of what these lie beside: six folders below ``path``."""
    records = {
        "primary": primary_records(sequences, contigs),
        "alternative": alternative_records(all_alternatives),
        "base": alternative_records(base_contigs(sequences)),
    }
    for kind, rows in records.items():
        write_fasta(rows, f"{path}/{kind}", width=None)
        write_tiling(named_tiling(tiling, kind), f"{path}/{kind}_tiling")


def write_gfa1(graph: GfaGraph, path: str) -> None:
    gfa1_lines(graph).orderBy("section", "line").select(F.col("line").alias("value")).write.text(path)


def write_gfa2(graph: GfaGraph, path: str) -> None:
    gfa2_lines(graph).orderBy("section", "line").select(F.col("line").alias("value")).write.text(path)


def gfa_json_rows(graph: GfaGraph) -> DataFrame:
    """``kind, key, value``: each element as JSON; edges are keyed by ``('source', 'sink')``."""
    def rows(df: DataFrame, kind: str, key, columns: list[str]) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), key.alias("key"), F.to_json(F.struct(*columns)).alias("value"))

    pair = F.concat(F.lit("('"), "v", F.lit("', '"), "w", F.lit("')"))
    return (
        rows(graph.nodes, "nodes", F.col("name"), NODE_COLUMNS)
        .unionByName(rows(graph.edges, "edges", pair, EDGE_COLUMNS))
        .unionByName(rows(graph.paths, "paths", F.col("name"), PATH_COLUMNS))
    )


def write_gfa_json(graph: GfaGraph, path: str) -> None:
    """One JSON object per element and line."""
    gfa_json_rows(graph).write.json(path)


def read_gfa_json(spark, path: str) -> GfaGraph:
    rows = spark.read.schema("kind string, key string, value string").json(path)

    def part(kind: str, ddl: str) -> DataFrame:
        return rows.filter(F.col("kind") == kind).select(F.from_json("value", ddl).alias("x")).select("x.*")

    return GfaGraph(
        part("nodes", "name string, len long, seq string"),
        part("edges", "name string, v string, v_orient string, w string, w_orient string, v_start long, v_end long, w_start long, w_end long, cigar string"),
        part("paths", "name string, nodes array<string>, cigars array<string>"),
    )


def write_json_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.json(path)


def to_json_text(value: object) -> str:
    return json.dumps(value, sort_keys=True, indent=4, separators=(",", ": "))
