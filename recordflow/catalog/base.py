"""Registration of queries, and the JSON records that several of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None):
    """Register a query under its function name; ``covers`` lists the inventory items it proves."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        COVERS[fn.__name__] = covers
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


class Tables:
    """The driver tables of one scale, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def wide(self, name: str) -> DataFrame:
        """A table over all cores. Only inputs too small to arrive in that many splits are redistributed."""
        df = self(name)
        cores = self.spark.sparkContext.defaultParallelism
        return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

    def orders_json(self) -> DataFrame:
        """Orders as camelCase records with a nested object and a list; ``ordinal`` is the order key."""
        return self.wide("orders").select(
            F.col("o_orderkey").alias("ordinal"),
            F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("key"),
            F.to_json(
                F.struct(
                    F.col("o_orderkey").alias("orderId"),
                    F.col("o_custkey").cast("string").alias("custId"),
                    F.col("o_orderstatus").alias("orderStatus"),
                    F.col("o_totalprice").cast("string").alias("totalPrice"),
                    F.struct(
                        F.col("o_orderpriority").alias("level"),
                        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("placedOn")).alias("dates"),
                    ).alias("detail"),
                    F.array(
                        F.struct((F.col("o_orderkey") % 7).alias("code")),
                        F.struct((F.col("o_orderkey") % 11).alias("code")),
                    ).alias("items"),
                )
            ).alias("value"),
        )

    def flat_json(self) -> DataFrame:
        """Customers as flat camelCase records; every third has no segment, every fifth an explicit null."""
        return self.wide("customer").select(
            F.col("c_custkey").alias("ordinal"),
            F.col("c_custkey").cast("string").alias("key"),
            F.concat(
                F.lit('{"custId":'),
                F.col("c_custkey").cast("string"),
                F.lit(',"custName":"'),
                F.col("c_name"),
                F.lit('","acctBal":'),
                F.col("c_acctbal").cast("string"),
                F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(
                    F.concat(F.lit(',"mktSegment":"'), F.col("c_mktsegment"), F.lit('"'))
                ),
                F.when(F.col("c_custkey") % 5 == 0, F.lit(',"note":null')).otherwise(F.lit("")),
                F.lit("}"),
            ).alias("value"),
        )


def got(column: str, path: str, type_name: str = "string") -> Column:
    """A scalar of a JSON text column."""
    return F.try_variant_get(F.try_parse_json(F.col(column)), path, type_name)


def day(column: str | Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, pattern)
