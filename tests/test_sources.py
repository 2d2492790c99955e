"""Source definitions that need no database to check."""

import pytest

from strata.sources.jdbc import JdbcSource, sqlserver_url


def test_sqlserver_url():
    assert sqlserver_url("h", "db") == "jdbc:sqlserver://h:1433;database=db"


def test_partitioned_options():
    src = JdbcSource(url="jdbc:x", table="T", properties={"user": "u"}, partition_column="id",
                     lower_bound=1, upper_bound=1000, num_partitions=8)
    opts = src.options()
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000"
    assert opts["dbtable"] == "T" and opts["user"] == "u" and opts["fetchsize"] == "10000"


def test_partition_column_needs_bounds():
    with pytest.raises(ValueError):
        JdbcSource(url="jdbc:x", table="T", properties={}, partition_column="id").options()


def test_single_task_read_has_no_partition_options():
    opts = JdbcSource(url="jdbc:x", table="T", properties={}).options()
    assert "partitionColumn" not in opts


class _Recorder:
    """Stands in for ``spark.read``: records format, options and calls."""

    def __init__(self, rows=None):
        self.calls, self.opts, self.rows = [], {}, rows

    def format(self, fmt):
        self.calls.append(("format", fmt))
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def load(self):
        self.calls.append(("load", dict(self.opts)))
        return self

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append(("jdbc", url, table, list(predicates or []), dict(properties or {})))
        return self

    def first(self):
        return self.rows


class _FakeSpark:
    def __init__(self, rows=None):
        self.read = _Recorder(rows)


def test_read_jdbc_partitioned_options_reach_the_reader():
    from strata.sources.jdbc import read_jdbc

    spark = _FakeSpark()
    src = JdbcSource(url="jdbc:x", table="T", properties={"user": "u"}, partition_column="id",
                     lower_bound=1, upper_bound=99, num_partitions=4)
    read_jdbc(spark, src)
    (fmt, (kind, opts)) = spark.read.calls
    assert fmt == ("format", "jdbc") and kind == "load"
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "4" and opts["dbtable"] == "T"


def test_read_jdbc_predicates():
    from strata.sources.jdbc import read_jdbc

    spark = _FakeSpark()
    src = JdbcSource(url="jdbc:x", table="T", properties={"user": "u"},
                     predicates=("id < 10", "id >= 10"))
    read_jdbc(spark, src)
    (call,) = spark.read.calls
    assert call[0] == "jdbc" and call[3] == ["id < 10", "id >= 10"]
    assert call[4]["user"] == "u" and "url" not in call[4] and "dbtable" not in call[4]


def test_with_bounds_asks_the_database_for_min_and_max():
    from strata.sources.jdbc import with_bounds

    spark = _FakeSpark(rows={"lo": 5, "hi": 500})
    src = JdbcSource(url="jdbc:x", table="T", properties={"user": "u"})
    out = with_bounds(spark, src, "id", 8)
    load = [c for c in spark.read.calls if c[0] == "load"][0][1]
    assert load["query"] == "select min(id) as lo, max(id) as hi from T"
    assert (out.partition_column, out.lower_bound, out.upper_bound, out.num_partitions) == ("id", 5, 500, 8)
