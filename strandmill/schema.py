"""Column names and types of the tables that operators exchange."""

from __future__ import annotations

SEQUENCES = "name string, id string, metadata string, sequence string, length int, md5 string"
OVERLAPS = (
    "q_id string, t_id string, score int, identity double, q_strand int, q_s int, q_e int, q_l int, "
    "t_strand int, t_s int, t_e int, t_l int, tag string"
)
EDGES = "v string, w string, rid string, sp int, tp int, score int, identity double, type string"
UNITIGS = "s string, v string, t string, type string, length long, score long, path string"
CONTIGS = "ctg_id string, type string, start_edge string, end_node string, length long, score long, utgs string"
TILING = "ctg_id string, v string, w string, wrid string, b int, e int, score int, identity double"
READ_MAP = "pid string, rid string, oid string, ctg string"


def names(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(",")]


def types(ddl: str) -> list[str]:
    return [c.strip().split(" ")[1] for c in ddl.split(",")]
