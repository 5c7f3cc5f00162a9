"""Query registration: a Spark function and, where SQL can say it, its check."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycart.plans.matrix import init_matrix
from tallycart.session import stage
from tallycart.sources import tables

DIGITS = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
# The same queries without the rounding that only the comparison needs.
UNROUNDED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


_INGESTED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def ingested(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The log and the pairs as stored tables, written once per application.

    The log is a three-way join over the test tables; the features scan it many
    times, each time another few columns.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INGESTED:
        log = stage(tables.log_view(spark, sf_dir), "log")
        _INGESTED[key] = (log, stage(tables.pairs_view(log), "pairs"))
    return _INGESTED[key]


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Have the next query ingest the tables again."""
    _INGESTED.pop((spark.sparkContext.applicationId, sf_dir), None)


class Data:
    """The test tables as log, users, pairs and matrix."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    @property
    def log(self) -> DataFrame:
        return ingested(self.spark, self.sf_dir)[0]

    @property
    def pairs(self) -> DataFrame:
        return ingested(self.spark, self.sf_dir)[1]

    @cached_property
    def users(self) -> DataFrame:
        return tables.users_view(self.spark, self.sf_dir)

    @cached_property
    def matrix(self) -> DataFrame:
        return init_matrix(self.pairs, self.users)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits: engines may add in a different order."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in doubles}) if doubles else df


def query(
    name: str, sql: str | None = None, doubles: list[str] | None = None, settled: bool = False
):
    """Register ``fn(data)``; ``doubles`` lists the result columns to round in SQL.

    ``settled`` results are already cut to a number of digits and stay as they are.
    """

    def register(fn: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        finish = (lambda df: df) if settled else rounded
        UNROUNDED[name] = lambda spark, sf_dir: fn(Data(spark, sf_dir))
        QUERIES[name] = lambda spark, sf_dir: finish(fn(Data(spark, sf_dir)))
        if sql is not None:
            CHECKS[name] = check_sql(sql, doubles or [])
        return fn

    return register


BASE = """log as (
  select o_custkey as user_id, l_suppkey as merchant_id, l_partkey as item_id,
         cast(p_size as bigint) as cat_id,
         coalesce(case when p_brand = 'Brand#1' then null
                       else cast(substr(p_brand, 7) as bigint) end, 0) as brand_id,
         cast(l_shipdate as date) as dt,
         case when l_returnflag = 'N' then 'click'
              when l_returnflag = 'R' then 'purchase'
              when l_linestatus = 'F' then 'add-to-cart'
              else 'add-to-favorite' end as action_type,
         l_orderkey as seq1, cast(l_linenumber as bigint) as seq2
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
), users as (
  select c_custkey as user_id, cast(c_nationkey % 10 as integer) as age_range,
         case c_mktsegment when 'AUTOMOBILE' then 0 when 'BUILDING' then 1
                           when 'FURNITURE' then 2 end as gender
  from customer
), pairs as (
  select user_id, merchant_id,
         case when user_id % 2 = 0 then 'train' else 'test' end as origin,
         case when user_id % 2 = 0 then cast(case when
              sum(case when dt >= date '1999-01-01' then 1 else 0 end) > 0
              then 1 else 0 end as double) end as label
  from log where action_type = 'purchase'
  group by user_id, merchant_id
  having sum(case when dt < date '1999-01-01' then 1 else 0 end) > 0
), matrix as (
  select p.user_id, p.merchant_id, origin, label,
         case u.age_range when 1 then 'first group' when 2 then 'second group'
              when 3 then 'third group' when 4 then 'fourth group' when 5 then 'fifth group'
              when 6 then 'sixth group' when 7 then 'seventh group' when 8 then 'eighth group'
              else 'unknown' end as age_range,
         case u.gender when 0 then 'female' when 1 then 'male' else 'unknown' end as gender
  from pairs p left join users u on p.user_id = u.user_id
)"""


def check_sql(sql: str, doubles: list[str]) -> str:
    """``sql`` is either a select or ``ctes :: select`` (spaces around the colons); the base views go in front."""
    *ctes, body = re.split(r"\s::\s", sql)
    with_part = ",\n".join([BASE, *[c.strip() for c in ctes]])
    if doubles:
        cut = ", ".join(f'round("{c}", {DIGITS}) as "{c}"' for c in doubles)
        body = f"select * replace ({cut}) from (\n{body.strip()}\n)"
    return f"with {with_part}\n{body.strip()}"
