"""How the driver's tables stand in for reads, overlaps, paths and graphs. Each role has the same definition here and in the SQL.

Expressions are shared by Spark SQL and DuckDB, so that both sides compute the same stand-in rows from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OVERLAP_EXPRESSIONS = {
    "q_id": "lpad(cast(l_orderkey as string), 9, '0')",
    "t_id": "lpad(cast(l_partkey as string), 9, '0')",
    "score": "cast(-floor(l_extendedprice) as int)",
    "identity": "100 - 200 * l_discount",
    "q_strand": "0",
    "q_s": "case when l_returnflag = 'A' then 0 else l_linenumber end",
    "q_e": "cast(1000 + (l_orderkey % 50) * 100 - case when l_linestatus = 'F' then 0 else 1 end as int)",
    "q_l": "cast(1000 + (l_orderkey % 50) * 100 as int)",
    "t_strand": "cast(l_suppkey % 2 as int)",
    "t_s": "0",
    "t_e": "cast(3000 + (l_partkey % 50) * 100 - cast(l_quantity as int) * 40 as int)",
    "t_l": "cast(3000 + (l_partkey % 50) * 100 as int)",
    "tag": "case when l_returnflag = 'R' and l_quantity <= 1 then 'contained' when l_returnflag = 'N' and l_linestatus = 'F' and l_quantity <= 1 then 'contains' else 'overlap' end",
}
OVERLAPS_SQL = "ovl AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in OVERLAP_EXPRESSIONS.items()) + " FROM lineitem)"

EDGES_SQL = (
    "edge AS (SELECT lpad(cast(l_suppkey as string), 9, '0') || ':B' AS v, lpad(cast(l_partkey as string), 9, '0') || ':B' AS w, "
    "cast(sum(cast(l_quantity as bigint)) as bigint) AS length, cast(sum(cast(floor(l_extendedprice) as bigint)) as bigint) AS score "
    "FROM lineitem WHERE l_suppkey <> l_partkey GROUP BY 1, 2)"
)

TILING_SQL = (
    "tiling AS (SELECT lpad(cast(user_id as string), 6, '0') || 'F' AS ctg_id, "
    "lpad(cast(row_number() over (partition by user_id order by event_id) - 1 as string), 9, '0') || ':B' AS v, "
    "lpad(cast(row_number() over (partition by user_id order by event_id) as string), 9, '0') || ':B' AS w, "
    "cast(floor(value * 100) as int) AS b, 0 AS e, cast(row_number() over (partition by user_id order by event_id) as int) AS ord FROM events)"
)

MAP_SQL = "ctg_map AS (SELECT lpad(cast(o_orderkey as string), 9, '0') AS rid, lpad(cast(o_custkey % 40 as string), 6, '0') || 'F' AS ctg FROM orders)"

BASES_SQL = "seq AS (SELECT doc_id AS id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS sequence FROM documents)"
ITEMS_SQL = "item AS (SELECT item_id AS id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') AS sequence FROM benchmark)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in OVERLAP_EXPRESSIONS.items()])


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c: F.concat(F.lpad(F.col(c).cast("string"), 9, "0"), F.lit(":B"))
    rows = table(spark, sf_dir, "lineitem").filter("l_suppkey <> l_partkey")
    return rows.groupBy(name("l_suppkey").alias("v"), name("l_partkey").alias("w")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("length"), F.sum(F.floor("l_extendedprice").cast("long")).alias("score")
    )


def tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    nth = "row_number() over (partition by user_id order by event_id)"
    return table(spark, sf_dir, "events").selectExpr(
        "lpad(cast(user_id as string), 6, '0') || 'F' AS ctg_id",
        f"lpad(cast({nth} - 1 as string), 9, '0') || ':B' AS v",
        f"lpad(cast({nth} as string), 9, '0') || ':B' AS w",
        "cast(floor(value * 100) as int) AS b",
        "0 AS e",
        f"{nth} AS ord",
    )


def read_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("lpad(cast(o_orderkey as string), 9, '0') AS rid", "lpad(cast(o_custkey % 40 as string), 6, '0') || 'F' AS ctg")


def bases(spark: SparkSession, sf_dir: str, name: str = "documents", key: str = "doc_id") -> DataFrame:
    """Texts with all but the letters A, C, G and T taken out."""
    text = F.regexp_replace(F.upper(F.coalesce("text", F.lit(""))), "[^ACGT]", "")
    return table(spark, sf_dir, name).select(F.col(key).alias("id"), text.alias("sequence"))
