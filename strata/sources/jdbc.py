"""JDBC sources.

The reference reads each table in one task (no partitioning options).  Here
a numeric or date column with bounds splits the read into ``num_partitions``
range queries run by parallel tasks, or explicit ``predicates`` do; filters
and column pruning are still pushed into each query.  The partitions are
separate queries, so they do not share one database snapshot.

Reading needs a reachable database.  No database is started by this
library or its tests.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SQLSERVER_PORT = 1433


def sqlserver_url(host: str, database: str, port: int = SQLSERVER_PORT) -> str:
    """``jdbc:sqlserver://host:port;database=db``."""
    return f"jdbc:sqlserver://{host}:{port};database={database}"


@dataclass(frozen=True)
class JdbcSource:
    url: str
    table: str
    properties: Mapping[str, str]            # user, password, driver, ...
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int | None = None
    predicates: Sequence[str] = ()
    fetch_size: int | None = 10_000

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table, **dict(self.properties)}
        if self.fetch_size:
            opts["fetchsize"] = str(self.fetch_size)
        if self.partition_column:
            if self.lower_bound is None or self.upper_bound is None or not self.num_partitions:
                raise ValueError("a partition column needs lower_bound, upper_bound and num_partitions")
            opts.update(partitionColumn=self.partition_column, lowerBound=str(self.lower_bound),
                        upperBound=str(self.upper_bound), numPartitions=str(self.num_partitions))
        return opts


def read_jdbc(spark: SparkSession, source: JdbcSource) -> DataFrame:
    if source.predicates:
        props = {k: v for k, v in source.options().items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(source.url, source.table, predicates=list(source.predicates),
                               properties=props)
    return spark.read.format("jdbc").options(**source.options()).load()


def jdbc_reader(source: JdbcSource) -> Callable[[SparkSession], DataFrame]:
    """A ``LoadSpec.reader`` for ``source``."""
    return lambda spark: read_jdbc(spark, source)


def with_bounds(spark: SparkSession, source: JdbcSource, column: str,
                num_partitions: int) -> JdbcSource:
    """``source`` split into ``num_partitions`` range reads on ``column``, with
    the bounds asked from the database (``min``/``max``, one small query)."""
    bounds_query = f"select min({column}) as lo, max({column}) as hi from {source.table}"
    props = {k: v for k, v in source.options().items() if k not in ("dbtable", "url")}
    row = (spark.read.format("jdbc").option("url", source.url).option("query", bounds_query)
           .options(**props).load().first())
    if row is None or row["lo"] is None:
        return source
    return JdbcSource(url=source.url, table=source.table, properties=source.properties,
                      partition_column=column, lower_bound=row["lo"], upper_bound=row["hi"],
                      num_partitions=num_partitions, fetch_size=source.fetch_size)
