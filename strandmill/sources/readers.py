"""Readers of sequence and assembly text files. Paths go to Spark's readers, so any file system that Spark knows will do."""

from __future__ import annotations

import configparser
import json
import math
import posixpath
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandmill import schema
from strandmill.functions.sequences import decode_edges, header_id, header_metadata, int_with_commas, parent_contig
from strandmill.session import object_frame, ship_package

FASTA_ENDINGS = (".fasta", ".fa", ".fasta.gz", ".fa.gz", ".fasta.bz2", ".fa.bz2")
FASTQ_ENDINGS = (".fastq", ".fq", ".fastq.gz", ".fq.gz", ".fastq.bz2", ".fq.bz2")


def sequence_records(name: Column, sequence: Column) -> list[Column]:
    return [
        name.alias("name"), header_id(name).alias("id"), header_metadata(name).alias("metadata"), sequence.alias("sequence"),
        F.length(sequence).alias("length"), F.md5(sequence).alias("md5"),
    ]


def read_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``schema.SEQUENCES`` and ``file``. Files are split at ``>``; text before the first one is an error. gz and bz2 by name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        if p.endswith(".dexta"):
            raise ValueError(f"{p}: this compression needs an external tool and isn't read")
        first = spark.read.option("lineSep", ">").text(p).first()
        if first is not None and first[0].strip():
            raise ValueError(f"Invalid FASTA file {p!r}: it begins with {first[0].strip()[:40]!r}")
    rows = spark.read.option("lineSep", ">").text(paths).select(F.col("_metadata.file_path").alias("file"), "value")
    parts = F.split("value", "\n", 2)
    name = F.regexp_replace(parts[0], r"\s+$", "")
    body = F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), r"\s+", "")
    bad = (F.try_element_at(parts, F.lit(2)).isNull()) | (name == "")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("Invalid FASTA file "), F.col("file"))).cast("string")).otherwise(name)
    records = rows.filter(F.length(F.trim("value")) > 0).select("file", checked.alias("h"), body.alias("s"))
    return records.select(*sequence_records(F.col("h"), F.col("s")), "file")


def read_fastq(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``schema.SEQUENCES`` and ``file`` from records of four lines; qualities are dropped. Files are read whole, one a task, as records carry no marker."""
    ship_package(spark)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                raw = bytes(content)
                if path.endswith(".gz"):
                    import gzip

                    raw = gzip.decompress(raw)
                elif path.endswith(".bz2"):
                    import bz2

                    raw = bz2.decompress(raw)
                lines = raw.decode().split("\n")
                rows = []
                for i in range(0, len(lines) - 1, 4):
                    if not lines[i].strip():
                        break
                    if lines[i][0] != "@":
                        raise ValueError(f"{path!r} is not a fastq file.")
                    rows.append((path, lines[i][1:].strip(), lines[i + 1].strip()))
                yield object_frame(rows, ["file", "h", "s"])

    paths = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "file string, h string, s string")
    return found.select(*sequence_records(F.col("h"), F.col("s")), "file")


def read_sequences(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """FASTA or FASTQ by file name; others by their first letter."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    fasta = [p for p in paths if p.endswith(FASTA_ENDINGS)]
    fastq = [p for p in paths if p.endswith(FASTQ_ENDINGS)]
    for p in (x for x in paths if not x.endswith(FASTA_ENDINGS + FASTQ_ENDINGS)):
        first = spark.read.text(p).first()
        (fastq if first is not None and first[0].startswith("@") else fasta).append(p)
    frames = [f(spark, p) for f, p in ((read_fasta, fasta), (read_fastq, fastq)) if p]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def parsed_headers(records: DataFrame, counter_from: int | None = None) -> DataFrame:
    """Adds ``movie, zmw, extra`` of headers ``movie/zmw/extra`` or ``movie zmw``; with a counter, zmw numbers the records in order of ``ord``."""
    slash = F.col("name").contains("/")
    parts = F.when(slash, F.split("name", "/")).otherwise(F.split("name", r"\s+", 2))
    zmw = parts[1].cast("long") if counter_from is None else F.row_number().over(W.orderBy("ord")) + (counter_from - 1)
    extra = F.when(F.size(parts) > 1, F.element_at(parts, -1)).otherwise("")
    return records.withColumn("movie", parts[0]).withColumn("zmw", zmw).withColumn("extra", extra)


def reheadered(records: DataFrame) -> DataFrame:
    """``movie, name, sequence`` with names ``movie/zmw/begin_end extra``; a range that disagrees with the sequence keeps its begin."""
    pattern = r"^(\d+)_(\d+)\s*(.*)$"
    ranged = F.col("extra").rlike(pattern)
    begin = F.when(ranged, F.regexp_extract("extra", pattern, 1).cast("long")).otherwise(F.lit(0))
    end = F.when(ranged, begin + F.length("sequence")).otherwise(F.length("sequence"))
    rest = F.when(ranged, F.regexp_extract("extra", pattern, 3)).otherwise(F.col("extra"))
    tail = F.when(rest != "", F.concat(F.lit(" "), rest)).otherwise("")
    name = F.concat("movie", F.lit("/"), F.col("zmw").cast("string"), F.lit("/"), begin.cast("string"), F.lit("_"), end.cast("string"), tail)
    return records.select("movie", name.alias("name"), "sequence")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, ord, line``: lines with their place, in file order within each file.

    Rows of one file keep their order within a split, and splits are ordered by their first byte.
    """
    rows = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line")
    )
    return rows.withColumn("ord", F.row_number().over(W.partitionBy("file").orderBy("block", "seq")) - 1).select("file", "ord", "line")


def split_columns(rows: DataFrame, ddl: str, extra: Sequence[str] = (), line: str = "line") -> DataFrame:
    """Whitespace-separated fields, cast by position; further fields are ignored, rows with fewer fields dropped."""
    fields = F.split(F.trim(F.col(line)), r"\s+")
    names, types = schema.names(ddl), schema.types(ddl)
    cut = rows.withColumn("s_fields", fields).filter(F.size("s_fields") >= len(names))
    return cut.select(*[F.col("s_fields")[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(names, types, strict=True))], *extra)


def read_overlaps(spark: SparkSession, paths: str | Sequence[str], marker: bool = False) -> DataFrame:
    """``schema.OVERLAPS`` with ``file, ord``. With ``marker`` each file must end its rows with a line that begins with ``-``; later lines are ignored."""
    lines = read_lines(spark, paths)
    if marker:
        whole = W.partitionBy("file")
        end = F.min(F.when(F.col("line").startswith("-"), F.col("ord"))).over(whole)
        lacking = F.raise_error(F.concat(F.lit("The overlap file lacks its last line "), F.col("file"))).cast("long")
        lines = lines.withColumn("end", end).withColumn("end", F.when(F.col("end").isNull(), lacking).otherwise(F.col("end"))).filter("ord < end")
    return split_columns(lines, schema.OVERLAPS, ["file", "ord"])


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return split_columns(read_lines(spark, path), schema.EDGES)


def read_unitigs(spark: SparkSession, path: str) -> DataFrame:
    """``path`` as an array: nodes, or ``s~v~t`` parts of compound unitigs."""
    rows = split_columns(read_lines(spark, path), schema.UNITIGS)
    return rows.withColumn("path", F.when(F.col("type") == "compound", F.split("path", r"\|")).otherwise(F.split("path", "~")))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    return split_columns(read_lines(spark, path), schema.CONTIGS)


def unitig_contigs(contigs: DataFrame, unitigs: DataFrame) -> DataFrame:
    """``s, v, t, ctg_id``: which contig a unitig is in; compound ones stand for their parts."""
    parts = contigs.select("ctg_id", F.explode(decode_edges(F.col("utgs"))).alias("u")).select("ctg_id", "u.s", "u.v", "u.t")
    known = unitigs.select(F.col("s").alias("k_s"), F.col("v").alias("k_v"), F.col("t").alias("k_t"), "type", "path")
    met = parts.join(known, (F.col("s") == F.col("k_s")) & (F.col("v") == F.col("k_v")) & (F.col("t") == F.col("k_t")))
    own = met.filter("type <> 'compound'").select("s", "v", "t", "ctg_id")
    inner = met.filter("type = 'compound'").select("ctg_id", F.explode(decode_edges(F.array_join("path", "|"))).alias("u"))
    return own.unionByName(inner.select("u.s", "u.v", "u.t", "ctg_id"))


def read_tiling_paths(spark: SparkSession, path: str, whitelist: DataFrame | None = None) -> DataFrame:
    """``schema.TILING`` and ``ord``, the place within the contig. whitelist: ``ctg_id`` to keep; unknown names are ignored."""
    rows = split_columns(read_lines(spark, path), schema.TILING, ["ord"])
    if whitelist is not None:
        rows = rows.join(whitelist.select(F.col("ctg_id").alias("k_id")).distinct(), F.col("ctg_id") == F.col("k_id"), "left_semi")
    return rows.withColumn("ord", F.row_number().over(W.partitionBy("ctg_id").orderBy("ord")))


def whitelisted(contigs: DataFrame, whitelist: DataFrame, by_parent: bool = False) -> DataFrame:
    """Contigs (``ctg_id``) that are listed, or whose parent is."""
    key = parent_contig(F.col("ctg_id")) if by_parent else F.col("ctg_id")
    return contigs.join(whitelist.select(F.col("ctg_id").alias("k_id")).distinct(), key == F.col("k_id"), "left_semi")


def sequence_dictionary(records: DataFrame, lengths_only: bool) -> DataFrame:
    """``name, len, seq``: ``*`` for the sequence if only lengths are wanted."""
    return records.select(F.col("id").alias("name"), F.col("length").alias("len"), (F.lit("*") if lengths_only else F.upper("sequence")).alias("seq"))


def dump_lengths(lines: DataFrame) -> DataFrame:
    """``ord, line`` rows ``L well begin end`` -> ``ord, length``."""
    cut = lines.select("ord", F.regexp_extract("line", r"^L\s+\S+\s+(\d+)\s+(\d+)", 1).alias("b"), F.regexp_extract("line", r"^L\s+\S+\s+(\d+)\s+(\d+)", 2).alias("e"))
    return cut.filter("b <> ''").select("ord", (F.col("e").cast("long") - F.col("b").cast("long")).alias("length"))


def keyed_dump_lengths(lines: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """``id, length``: each ``L`` row takes the id of the last ``R`` row before it."""
    read = F.when(F.col("line").startswith("R "), F.regexp_extract("line", r"^R\s+(\d+)", 1).cast("long"))
    carried = lines.withColumn("id", F.last(read, ignorenulls=True).over(W.partitionBy(*group).orderBy("ord").rowsBetween(W.unboundedPreceding, W.currentRow)))
    return carried.select("id", "ord").join(dump_lengths(lines).withColumnRenamed("ord", "l_ord"), F.col("ord") == F.col("l_ord")).select("id", "length")


def stats_histogram(lines: DataFrame) -> DataFrame:
    """``rl, count`` from rows ``bin: count % % average``; numbers may have thousands commas; empty bins go."""
    pattern = r"^\s*([\d,]+):\s+([\d,]+)\s+[\d.]+\s+[\d.]+\s+[\d,]+\s*$"
    cut = lines.select(F.regexp_extract("line", pattern, 1).alias("a"), F.regexp_extract("line", pattern, 2).alias("b")).filter("a <> ''")
    return cut.select(int_with_commas(F.col("a")).alias("rl"), int_with_commas(F.col("b")).alias("count"))


def two_integer_columns(lines: DataFrame) -> DataFrame:
    """``a, b`` of lines with two integers; blank lines go."""
    fields = F.split(F.trim("line"), r"\s+")
    return lines.filter("trim(line) <> ''").select(fields[0].cast("long").alias("a"), fields[1].cast("long").alias("b"))


def read_fofn(spark: SparkSession, path: str) -> list[str]:
    """Paths listed in a text or JSON file, absolute by the list's folder; each must be there and not empty."""
    if path.endswith(".json"):
        listed = json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    else:
        listed = [r[0].strip() for r in spark.read.text(path).collect() if r[0].strip()]
    folder = posixpath.dirname(path)
    found = [p if posixpath.isabs(p) or "://" in p else posixpath.normpath(posixpath.join(folder, p)) for p in listed]
    sizes = {}
    if found:
        for r in spark.read.format("binaryFile").load(found).select("path", "length").collect():
            sizes[r["path"].split(":", 1)[-1].lstrip("/")] = r["length"]
    for p in found:
        if not sizes.get(p.split(":", 1)[-1].lstrip("/") if "://" in p else p.lstrip("/")):
            raise ValueError(f"Empty or missing file: {p!r}")
    return found


def absolute_paths(spark: SparkSession, path: str) -> list[str]:
    """Paths listed in a text file, absolute by the list's folder; whether they are there isn't looked at."""
    folder = posixpath.dirname(path)
    listed = [r[0].strip() for r in spark.read.text(path).collect() if r[0].strip()]
    return [p if posixpath.isabs(p) or "://" in p else posixpath.normpath(posixpath.join(folder, p)) for p in listed]


def block_count(lines: DataFrame) -> int:
    """The number in a database's first line ``blocks = N``; 1 without one. lines: ``ord, line``."""
    found = lines.select("ord", F.regexp_extract("line", r"^\s*blocks\s+=\s+(\d+)", 1).alias("n")).filter("n <> ''")
    first = found.agg(F.min_by(F.col("n").cast("int"), "ord")).first()[0]
    return 1 if first is None else first


def mask_tracks(spark: SparkSession, root: str, name: str) -> list[str]:
    """Names of a database's mask tracks, sorted: its files ``.<name>.<track>.anno`` in ``root``.

    The folder is listed through Hadoop's file system, as Spark's own readers pass over hidden files.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = re.compile(rf"\.{re.escape(name)}\.([^.]+)\.anno")
    met = (pattern.fullmatch(s.getPath().getName()) for s in system.listStatus(folder))
    return sorted(m.group(1) for m in met if m)


def check_block_pairs(files: Sequence[str]) -> list[str]:
    """The files of an all-against-all comparison by name; raises unless there is one for each pair of blocks, a square number."""
    if math.isqrt(len(files)) ** 2 != len(files):
        raise ValueError(f"{len(files)} files aren't a square number: some of the comparison's files are missing")
    return sorted(files, key=posixpath.basename)


def check_block_sequence(blocks: Sequence[int]) -> None:
    """Raises unless the blocks are numbered from 1 without a gap. A block may be named more than once."""
    named = sorted(set(blocks))
    if named != list(range(1, len(named) + 1)):
        raise ValueError(f"blocks aren't numbered from 1 to {len(named)}: {named}")


def find_files(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Paths below ``root`` whose names match, sorted."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path")
    return sorted(r[0] for r in rows.collect())


def read_json_value(spark: SparkSession, path: str) -> object:
    """A JSON document of any shape; msgpack isn't supported."""
    if path.endswith(".msgpack"):
        raise ValueError("msgpack files aren't read; use JSON")
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def read_id_lines(spark: SparkSession, path: str) -> DataFrame:
    """``ord, name``: line numbers from 0 as ids."""
    return read_lines(spark, path).select("ord", F.col("line").alias("name"))


def read_contig_map(spark: SparkSession, path: str) -> DataFrame:
    return split_columns(read_lines(spark, path), schema.READ_MAP)


def read_config_text(text: str) -> dict:
    """INI or JSON; keys keep their case."""
    if text.lstrip().startswith("{"):
        return json.loads(text)
    parser = configparser.ConfigParser(strict=False)
    parser.optionxform = str
    parser.read_string(text)
    return {s: dict(parser.items(s)) for s in parser.sections()}


def las_blocks(files: DataFrame, pattern: str = r"\.(\d+)\.") -> DataFrame:
    """``block, files``: file names by the block number in them."""
    block = F.regexp_extract("file", pattern, 1).cast("long")
    return files.select(block.alias("block"), "file").groupBy("block").agg(F.array_sort(F.collect_list("file")).alias("files"))
