"""Versions, parts and clean-up of the table store."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.sources import TableStore


@pytest.fixture(params=["folder", "catalog"])
def place(request, spark, tmp_path):
    if request.param == "folder":
        yield {"root": str(tmp_path / "store")}
        return
    spark.sql("CREATE DATABASE IF NOT EXISTS daybook_parts")
    yield {"database": "daybook_parts"}
    spark.sql("DROP DATABASE daybook_parts CASCADE")


def ids(frame):
    return sorted(r.id for r in frame.collect())


def stored(store):
    return {(v, n) for v, names in store._place.stored().items() for n in names}


def test_a_table_may_be_replaced_by_part_of_itself(spark, place):
    store = TableStore(spark, **place)
    store.write(spark.range(6).coalesce(1), "t")
    store.write(store.read("t").where("id > 2"), "t")
    assert ids(store.read("t")) == [3, 4, 5]


def test_nothing_of_a_version_shows_before_it_is_published(spark, place):
    store = TableStore(spark, **place)
    store.write(spark.range(1).coalesce(1), "a")
    version = store.begin()
    version.write(spark.range(2).coalesce(1), "a")
    version.write(spark.range(3).coalesce(1), "b")
    assert ids(store.read("a")) == [0] and not store.exists("b") and ids(version.read("a")) == [0, 1]
    version.publish()
    assert ids(store.read("a")) == [0, 1] and ids(store.read("b")) == [0, 1, 2]
    assert store.together("a", "b") and not store.together("a", "c")


def test_parts_stay_as_long_as_a_table_goes_on_from_them(spark, place):
    store = TableStore(spark, **place, keep=1)
    store.write(spark.range(2).coalesce(1), "t")
    for k in (2, 3):
        with store.begin() as version:
            new = version.append(spark.range(k, k + 1).withColumn(f"c{k}", F.lit("x")).coalesce(1), "t")
            assert ids(new) == [k]
    assert ids(store.read("t")) == [0, 1, 2, 3] and set(store.read("t").columns) == {"id", "c2", "c3"}
    if "database" in place:
        assert ids(spark.table("daybook_parts.t")) == [0, 1, 2, 3]
    seen = store.snapshot()
    store.write(spark.range(9, 10).coalesce(1), "u")
    assert ids(store.read("t")) == ids(seen.read("t")) == [0, 1, 2, 3]
    store.write(spark.range(7, 8).coalesce(1), "t")
    assert ids(store.read("t")) == [7]
    assert len([n for _, n in stored(store) if n.startswith("t")]) == 1  # all parts are gone
    with store.begin() as version:
        version.append(spark.range(8, 9).coalesce(1), "t")
    store.drop("t")
    assert not store.exists("t") and not [n for _, n in stored(store) if n.startswith("t")]


def test_an_abandoned_version_leaves_nothing(spark, place):
    store = TableStore(spark, **place)
    store.write(spark.range(1).coalesce(1), "t")
    before = stored(store)
    with pytest.raises(RuntimeError), store.begin() as version:
        version.append(spark.range(5).coalesce(1), "t")
        raise RuntimeError
    assert stored(store) == before and ids(store.read("t")) == [0]
