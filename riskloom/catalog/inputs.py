"""Views of the driver's tables that play the part of unit tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.roles import Roles

# The group domain of these tables.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ROLES = Roles(groups=SEGMENTS)
REPETITIONS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with lines. Lines are aggregated before anything is joined, so a
    frequent order key shrinks to one row per task ahead of the shuffle."""
    per_order = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("age"),
            (F.sum("l_quantity") * 1000).cast("bigint").alias("usage_km"),
            F.count_if(F.col("l_returnflag") == "A").alias("events"),
            F.max(F.col("l_returnflag") == "R").alias("label"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .select(
            F.col("o_orderkey").alias("unit_id"),
            F.col("c_mktsegment").alias("grp"),
            "age",
            "usage_km",
            "events",
            "label",
        )
    )


def units_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with the label as text, as a source would deliver it."""
    text = F.when(F.col("label"), ROLES.positive_text).otherwise(ROLES.negative_text)
    return units(spark, sf_dir).withColumn("label", text)


def units_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All units, with one kind of fault planted by a fixed rule on the id."""
    kind = F.col("unit_id") % 97
    planted = units_text(spark, sf_dir).select(
        "unit_id",
        F.when(kind == 0, F.lit("UNKNOWN")).otherwise(F.col("grp")).alias("grp"),
        F.when(kind == 2, F.lit(31)).otherwise(F.col("age")).cast("bigint").alias("age"),
        F.when(kind == 1, -F.col("usage_km")).when(kind == 5, F.lit(0))
        .otherwise(F.col("usage_km")).cast("bigint").alias("usage_km"),
        F.when(kind == 4, F.lit(None)).otherwise(F.col("events")).cast("bigint").alias("events"),
        F.when(kind == 3, F.lit("Nao")).otherwise(F.col("label")).alias("label"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.when(kind == 6, F.lit(2)).otherwise(F.lit(1))))
    return planted.select("*", copies.alias("copy")).drop("copy")


def units_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-labelled units in which some rows occur twice and nothing else is wrong."""
    twice = F.when(F.col("unit_id") % 97 == 6, F.lit(2)).otherwise(F.lit(1))
    return units_text(spark, sf_dir).select(
        "*", F.explode(F.sequence(F.lit(1), twice)).alias("copy")
    ).drop("copy")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores for every unit in every repetition from two integer rules.

    'pseudo' has many ties and no planted signal; 'signal' rises with age.
    """
    noise = F.col("unit_id") * (F.col("repetition") + 13)
    pseudo = (F.col("age") * 7 + F.col("events") * 3 + noise % 41) % 100
    signal = F.least(F.col("age"), F.lit(12)) * 7 + noise % 13

    def score(points):
        return (points + F.lit(0.5)) / F.lit(100.0)

    per_model = F.inline(
        F.array(
            F.struct(F.lit("pseudo").alias("model"), score(pseudo).alias("p")),
            F.struct(F.lit("signal").alias("model"), score(signal).alias("p")),
        )
    )
    return (
        units(spark, sf_dir)
        .withColumn("repetition", F.explode(F.sequence(F.lit(0), F.lit(REPETITIONS - 1))))
        .select(
            F.lit("original").alias("feature_set"),
            "repetition",
            (F.col("unit_id") % 5).cast("int").alias("fold"),
            "unit_id",
            F.col("label").cast("int").alias("y"),
            per_model,
        )
    )


UNITS_SQL = """
select o.o_orderkey as unit_id, c.c_mktsegment as grp, count(*) as age,
       cast(sum(l.l_quantity) * 1000 as bigint) as usage_km,
       count(*) filter (where l.l_returnflag = 'A') as events,
       bool_or(l.l_returnflag = 'R') as label
from lineitem l
join orders o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
group by o.o_orderkey, c.c_mktsegment
"""

DIRTY_SQL = """
select unit_id,
       case when unit_id % 97 = 0 then 'UNKNOWN' else grp end as grp,
       case when unit_id % 97 = 2 then 31 else age end as age,
       case when unit_id % 97 = 1 then -usage_km when unit_id % 97 = 5 then 0 else usage_km end as usage_km,
       case when unit_id % 97 = 4 then null else events end as events,
       case when unit_id % 97 = 3 then 'Nao' when label then 'Sim' else 'Não' end as label
from units, (values (1), (2)) as copies(copy)
where copy = 1 or unit_id % 97 = 6
"""

PREDICTIONS_SQL = """
select 'original' as feature_set, cast(repetition as integer) as repetition,
       cast(unit_id % 5 as integer) as fold, unit_id, cast(label as integer) as y, model,
       case when model = 'pseudo'
            then ((age * 7 + events * 3 + (unit_id * (repetition + 13)) % 41) % 100 + 0.5e0) / 100e0
            else (least(age, 12) * 7 + (unit_id * (repetition + 13)) % 13 + 0.5e0) / 100e0 end as p
from units, (select unnest(range(5)) as repetition), (values ('pseudo'), ('signal')) as m(model)
"""
