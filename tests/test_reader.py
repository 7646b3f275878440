import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tagweave.sources.cells import to_cells
from tagweave.sources.reader import load_source


def test_reader_by_in_type(spark, tmp_path):
    users = spark.createDataFrame([(1, "3", "x"), (2, "5", "y")], "id INT, job STRING, other STRING")
    path = str(tmp_path / "users")
    users.write.parquet(path)
    spec = {"inType": "parquet", "hbaseTable": path, "selectFields": "id,job"}
    out = load_source(spark, spec)
    assert out.columns == ["id", "job"] and rows(out) == [("1", "3"), ("2", "5")]
    users.createOrReplaceTempView("users_view")
    out = load_source(spark, {"inType": "table", "hbaseTable": "users_view", "selectFields": "job"})
    assert rows(out) == [("3",), ("5",)]
    cells = to_cells(users, "id", "base", ts=F.lit(dt.datetime(2020, 1, 1)))
    out = load_source(spark, {"inType": "HBase", "hbaseTable": "t", "family": "base",
                              "selectFields": "id,job", "rowKey": "id"}, {"t": cells})
    assert rows(out) == [("1", "3"), ("2", "5")]


def test_unknown_in_type(spark):
    import pytest
    with pytest.raises(ValueError):
        load_source(spark, {"inType": "ftp", "hbaseTable": "x", "selectFields": "id"})


def test_rule_options_reach_the_reader(spark):
    """All keys of the rule arrive; those that are not source keys become reader options."""
    from tagweave.operators.lookup import source_spec_of
    from tagweave.schemas import TAG_CATALOG
    from tagweave.sources.reader import load_source
    rule = "inType=jdbc##hbaseTable=people##selectFields=id,job##url=jdbc:h2:mem##user=reader##driver=org.h2.Driver"
    cat = spark.createDataFrame([(1, 0, 4, "t", rule, None, None)], TAG_CATALOG)
    spec = source_spec_of(cat, 1)
    calls = []

    class Reader:
        def format(self, name):
            calls.append(name)
            return self

        def options(self, **options):
            calls.append(options)
            return self

        def option(self, key, value):
            calls.append((key, value))
            return self

        def load(self):
            return spark.createDataFrame([("1", 3)], "id STRING, job INT")

    class Session:
        read = Reader()

    assert load_source(Session(), spec).collect() == [("1", "3")]
    assert calls == ["jdbc", {"url": "jdbc:h2:mem", "user": "reader", "driver": "org.h2.Driver"}, ("dbtable", "people")]


def test_jdbc_without_url_is_an_error(spark):
    import pytest

    from tagweave.sources.reader import load_source
    with pytest.raises(ValueError, match="no url"):
        load_source(spark, {"inType": "jdbc", "hbaseTable": "t", "selectFields": "id"})


def test_checkpoint_dir_is_needed_on_a_cluster():
    import pytest

    from tagweave.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
