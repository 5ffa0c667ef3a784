"""Audited tables derived from the test tables: a small uneven one and a large one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parityscope.roles import AuditRoles

DOCS_ROLES = AuditRoles("label", "prediction", ("lang", "source"), id="doc_id")
LINES_ROLES = AuditRoles("label", "prediction", ("c_mktsegment", "o_orderpriority"), score="score")
ORDERS_ROLES = AuditRoles(
    "label", "prediction", ("c_mktsegment", "o_orderpriority"), score="score", id="o_orderkey"
)
ORDERS_NUMERIC = ("o_totalprice", "c_acctbal", "c_nationkey")
ORDERS_CATEGORICAL = ("c_mktsegment", "o_orderpriority")

# Columns of the test tables used here. Naming them spares Spark a job
# per table that only reads file footers.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def audit_docs(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, label, prediction, lang, source`` of the labelled documents."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", (F.col("n_chars") >= 1000).cast("int").alias("prediction")
    )
    return labels.join(documents, "doc_id").select("doc_id", "label", "prediction", "lang", "source")


def audit_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``label, score, prediction, c_mktsegment, o_orderpriority`` of all order lines."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        ((F.col("l_quantity") - 1) / 49).alias("score"),
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority"
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return lines.join(orders.join(customers, "c_custkey"), "o_orderkey").select(
        "label", "score", (F.col("score") > 0.5).cast("int").alias("prediction"),
        "c_mktsegment", "o_orderpriority",
    )


def audit_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with customer columns and ``label``, 1 for finished orders: input for training."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderpriority",
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment"
    )
    return orders.join(customers, "c_custkey").drop("c_custkey")
