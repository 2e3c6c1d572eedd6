"""The shared folder, and intermediates that go again."""

from pathlib import Path

import pytest

from planledger import session
from planledger.operators.joins import key_filter, only_keys


class Master:
    """A session that says it runs on a cluster, with the settings of another."""

    def __init__(self, spark, **conf):
        self._jvm, self._jsc, self.sparkContext = spark._jvm, spark._jsc, self
        self.master, self.conf, self._conf = "yarn", self, conf

    def get(self, key, default=None):
        return self._conf.get(key, default)


def test_a_folder_of_the_drivers_machine_is_refused_on_a_cluster(spark, tmp_path):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Master(spark, **{"spark.sql.warehouse.dir": str(tmp_path)}))
    named = Master(spark, **{"spark.sql.warehouse.dir": str(tmp_path), "spark.checkpoint.dir": "hdfs://x/shared/"})
    assert session.shared_folder(named) == "hdfs://x/shared"


def test_scratch_deletes_what_was_stored_inside(spark):
    before = session.stored(spark.range(3), "kept")
    with session.scratch(spark):
        outer = session.stored(spark.range(4), "gone")
        with session.scratch(spark):
            inner = session.stored(outer, "gone")
            assert inner.count() == 4
            path = Path(inner.inputFiles()[0].removeprefix("file:"))
        assert not path.exists() and outer.count() == 4
        path = Path(outer.inputFiles()[0].removeprefix("file:"))
    assert not path.exists() and before.count() == 3


def test_scratch_deletes_after_a_failure(spark):
    with pytest.raises(RuntimeError), session.scratch(spark):
        path = Path(session.stored(spark.range(4), "gone").inputFiles()[0].removeprefix("file:"))
        raise RuntimeError
    assert not path.exists()


def test_key_filter_keeps_all_keys_and_few_others(spark):
    keys = spark.range(1000).selectExpr("concat('k', id) AS k").union(spark.createDataFrame([(None,)], "k string"))
    rows = spark.range(20_000).selectExpr("if(id % 50 = 7, null, concat('k', id)) AS k", "id")
    kept = only_keys(rows, key_filter(keys, "k"), "k")
    assert kept.columns == ["k", "id"]
    found = {r["k"] for r in kept.collect()}
    assert {f"k{i}" for i in range(1000) if i % 50 != 7} <= found and None not in found and len(found) < 1050
    # However few bits it has, it only keeps more; it never has more rows than words.
    small = key_filter(keys, "k", bits=64)
    assert small.count() == 1
    assert only_keys(rows, small, "k", bits=64).count() == rows.filter("k is not null").count()
    assert only_keys(rows, key_filter(keys.limit(0), "k"), "k").count() == 0
