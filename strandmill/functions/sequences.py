"""Scalar expressions over sequences, nodes, paths and headers. All are plain Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The complement alphabet; any other letter is an error.
COMPLEMENT_FROM = "ACGTacgtNn-"
COMPLEMENT_TO = "TGCAtgcaNn-"


def reverse_complement(seq: Column) -> Column:
    """Reverse complement of a sequence; a letter outside ``ACGTacgtNn-`` raises."""
    odd = seq.rlike("[^ACGTacgtNn-]")
    return F.when(odd, F.raise_error(F.concat(F.lit("no complement for a letter of: "), F.substring(seq, 1, 60)))).otherwise(
        F.reverse(F.translate(seq, COMPLEMENT_FROM, COMPLEMENT_TO))
    )


def complement(seq: Column) -> Column:
    """Upper-case bases only; any other letter raises."""
    return F.when(seq.rlike("[^ACGT]"), F.raise_error(F.lit("complement takes A, C, G and T"))).otherwise(F.translate(seq, "ACGT", "TGCA"))


def reverse_end(node: Column) -> Column:
    """``read:B`` <-> ``read:E``; ``NA`` stays; anything else raises."""
    good = node.rlike(r"^[^:]+:[BE]$")
    flipped = F.concat(F.regexp_replace(node, "[BE]$", ""), F.when(node.endswith("B"), F.lit("E")).otherwise(F.lit("B")))
    bad = F.raise_error(F.concat(F.lit("not a node: "), F.coalesce(node, F.lit("null")))).cast("string")
    return F.when(node == "NA", node).when(good, flipped).otherwise(bad)


def flip_end(node: Column) -> Column:
    """Like :func:`reverse_end` without the check, for names known to be nodes."""
    return F.when(node == "NA", node).when(node.endswith(":B"), F.regexp_replace(node, "B$", "E")).otherwise(F.regexp_replace(node, "E$", "B"))


def reverse_edge(v: Column, w: Column) -> Column:
    """The dual edge as ``struct<v, w>``."""
    return F.struct(flip_end(w).alias("v"), flip_end(v).alias("w"))


def reverse_path(path: Column) -> Column:
    return F.transform(F.reverse(path), flip_end)


def node_read(node: Column) -> Column:
    return F.split_part(node, F.lit(":"), F.lit(1))


def node_end(node: Column) -> Column:
    return F.split_part(node, F.lit(":"), F.lit(2))


def node_orient(node: Column) -> Column:
    """``E`` is forward (+), anything else reverse (-)."""
    return F.when(node_end(node) == "E", "+").otherwise("-")


def slice_sequence(seq: Column, begin: Column, end: Column) -> Column:
    """Half-open 0-based slice; begin > end reads the other strand of ``[end, begin)``."""
    forward = F.substr(seq, begin.cast("int") + 1, F.greatest(end - begin, F.lit(0)).cast("int"))
    back = F.substr(seq, end.cast("int") + 1, F.greatest(begin - end, F.lit(0)).cast("int"))
    return F.when(begin <= end, forward).otherwise(reverse_complement(back))


def flip_interval(begin: Column, end: Column, length: Column, reverse: Column) -> Column:
    """Coordinates seen from the other strand where ``reverse`` is 1, as ``struct<begin, end>``."""
    return F.struct(
        F.when(reverse == 1, length - end).otherwise(begin).alias("begin"), F.when(reverse == 1, length - begin).otherwise(end).alias("end")
    )


def kmers(seq: Column, k: int, step: int = 1) -> Column:
    """array<struct<pos, kmer>> at positions 0, step, ... below length - k (the last k-mer is left out, by design of the index).

    K-mers with a letter other than upper-case A, C, G and T are dropped.
    """
    last = F.length(seq) - F.lit(k) - 1
    at = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    cut = F.transform(at, lambda p: F.struct(p.alias("pos"), F.substr(seq, p + 1, F.lit(k)).alias("kmer")))
    return F.filter(cut, lambda x: ~x["kmer"].rlike("[^ACGT]"))


def kmer_code(kmer: Column) -> Column:
    """Two bits per base, the first base highest."""
    return F.conv(F.translate(kmer, "ACGT", "0123"), 4, 10).cast("long")


def clean_regions(seq: Column) -> Column:
    """All maximal runs of upper-case bases."""
    return F.regexp_extract_all(seq, F.lit("([ACGT]+)"), F.lit(1))


def wrap(seq: Column, width: int = 60) -> Column:
    """Lines of ``width`` letters, without a trailing newline."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n")


def header_id(header: Column) -> Column:
    return F.regexp_extract(header, r"^(\S*)", 1)


def header_metadata(header: Column) -> Column:
    """What follows the first whitespace, or null."""
    return F.when(header.rlike(r"\s"), F.regexp_replace(header, r"(?s)^\S*\s", ""))


def parent_contig(contig: Column) -> Column:
    """``000000F-001-01`` or ``000000F_1`` -> ``000000F``."""
    return F.split_part(F.split_part(contig, F.lit("-"), F.lit(1)), F.lit("_"), F.lit(1))


def int_with_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).cast("long")


def floor_div(a: Column, b: Column) -> Column:
    return F.floor(a / b).cast("long")


def encode_path(path: Column) -> Column:
    return F.array_join(path, "~")


def decode_path(text: Column) -> Column:
    return F.split(text, "~")


def encode_edges(edges: Column) -> Column:
    """array<struct<s, v, t>> -> ``s~v~t|s~v~t``."""
    return F.array_join(F.transform(edges, lambda e: F.concat_ws("~", e["s"], e["v"], e["t"])), "|")


def decode_edges(text: Column) -> Column:
    def parse(part: Column) -> Column:
        p = F.split(part, "~")
        return F.struct(p[0].alias("s"), p[1].alias("v"), p[2].alias("t"))

    return F.transform(F.split(text, r"\|"), parse)


def _numbered(form: str, *parts: Column) -> Column:
    """A formatted name, or null where a part is null. Numbers wider than their field stay whole."""
    known = F.lit(True)
    for part in parts:
        known = known & part.isNotNull()
    return F.when(known, F.format_string(form, *parts))


def read_name(number: Column) -> Column:
    """Zero-padded nine-digit read id; padding is part of the id."""
    return _numbered("%09d", number.cast("long"))


def contig_name(number: Column, strand: str = "F") -> Column:
    return _numbered(f"%06d{strand}", number.cast("long"))


def alternative_name(contig: Column, bubble: Column, path: Column) -> Column:
    return _numbered("%s-%03d-%02d", contig, bubble.cast("long"), path.cast("long"))
