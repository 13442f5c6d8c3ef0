from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook import DataQualityError
from daybook.contracts import POSITION, REASON
from daybook.operators import (
    DQReport,
    accepted,
    dq_report,
    enforce_threshold,
    flag_missing,
    flag_orders,
    flag_repeats,
    quality_summary,
    rejected,
    rejection_counts,
    repeated_keys,
)
from tests.conftest import order_rows, plan_of


def reasons(df) -> list:
    return [r[REASON] for r in df.orderBy(*POSITION).select(REASON).collect()]


def deduplicated(df):
    flagged = flag_orders(df)
    return flag_repeats(flagged, repeated_keys(flagged))


def test_each_row_has_the_first_reason_that_applies(spark):
    nothing = dict.fromkeys(
        (
            "order_id",
            "created_at",
            "financial_status",
            "gross_amount",
            "discount_amount",
            "net_amount",
            "taxes",
            "shipping_fees",
            "currency",
        )
    )
    white = {**nothing, "order_id": " "}
    rows = order_rows(spark, {}, nothing, white, {"taxes": "\t\xa0"}, {"currency": None})
    assert reasons(flag_orders(rows)) == [
        None,
        "empty_row",
        "missing_required_value",
        "missing_required_value",
        "missing_required_value",
    ]


def test_first_occurrence_stays(spark):
    rows = order_rows(
        spark,
        {"order_id": "1"},
        {"order_id": "2"},
        {"order_id": "1", "gross_amount": "7"},
        {"order_id": "1 "},  # compared as it is
        {"order_id": "1"},
    )
    assert reasons(deduplicated(rows)) == [
        None,
        None,
        "duplicate_order_id",
        None,
        "duplicate_order_id",
    ]


def test_rejected_rows_do_not_shadow_later_ones(spark):
    rows = order_rows(
        spark,
        {"order_id": "1", "taxes": None},
        {"order_id": "1"},
        {"order_id": "1"},
        {"order_id": None},
        {"order_id": None},
    )
    assert reasons(deduplicated(rows)) == [
        "missing_required_value",
        None,
        "duplicate_order_id",
        "missing_required_value",
        "missing_required_value",
    ]


def test_file_and_block_come_before_the_row_rank(spark):
    rows = spark.createDataFrame(
        [("k", "b.csv", 0, 1), ("k", "a.csv", 128, 7), ("k", "a.csv", 0, 9)],
        f"order_id string, {POSITION[0]} string, {POSITION[1]} bigint, {POSITION[2]} bigint",
    )
    flagged = flag_missing(rows, ["order_id"])
    kept = accepted(flag_repeats(flagged, repeated_keys(flagged))).collect()
    assert [(r[POSITION[0]], r[POSITION[1]]) for r in kept] == [("a.csv", 0)]


@pytest.mark.parametrize("broadcast_limit", ["10m", "-1"])
def test_a_hot_key_gives_the_same_as_brute_force(spark, broadcast_limit):
    """A third of the rows share one key, another third has no key at all."""
    rng = random.Random(7)
    keys = ["hot"] * 2000 + [None] * 2000 + [f"k{rng.randrange(1500)}" for _ in range(2000)]
    rng.shuffle(keys)
    rows = spark.createDataFrame(
        [(k, "f", 0, i) for i, k in enumerate(keys)],
        f"order_id string, {POSITION[0]} string, {POSITION[1]} bigint, {POSITION[2]} bigint",
    ).repartition(8)
    seen, expected = set(), []
    for i, key in enumerate(keys):
        if key is not None and key not in seen:
            seen.add(key)
            expected.append((i, None))
        else:
            why = "missing_required_value" if key is None else "duplicate_order_id"
            expected.append((i, why))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        # helper columns count as data here, so no row is empty
        flagged = rows.withColumn(
            REASON, F.when(F.col("order_id").isNull(), F.lit("missing_required_value"))
        )
        marked = flag_repeats(flagged, repeated_keys(flagged))
        got = sorted((r[POSITION[2]], r[REASON]) for r in marked.collect())
        report = dq_report(marked, "orders")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == expected
    assert report.rows_received == 6000 and report.rows_accepted == len(seen)


def test_repeats_hold_one_row_per_repeated_key(spark):
    rows = order_rows(spark, *({"order_id": k} for k in "abacaab"))
    found = repeated_keys(flag_orders(rows))
    assert sorted((r.order_id, r["__copies"], r["__first"][2]) for r in found.collect()) == [
        ("a", 4, 0),
        ("b", 2, 1),
    ]


def test_keys_that_share_a_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(1))
    rows = order_rows(spark, *({"order_id": k} for k in "abcad"))
    assert [r.order_id for r in repeated_keys(flag_orders(rows)).collect()] == ["a"]


def test_counting_agrees_everywhere(spark):
    rows = order_rows(
        spark, {}, {"order_id": "2"}, {"order_id": "2"}, {"order_id": "3", "currency": " "}
    )
    marked = deduplicated(rows)
    report = dq_report(marked, "orders")
    assert report == DQReport(
        "orders", 4, {"duplicate_order_id": 1, "missing_required_value": 1}
    )
    assert (report.rows_accepted, report.rows_rejected, report.rejection_rate) == (2, 2, 0.5)
    assert accepted(marked).count() == 2 and rejected(marked).count() == 2
    counts = {r[REASON]: r["n"] for r in rejection_counts(marked, "orders").collect()}
    assert counts == report.reasons
    line = quality_summary(marked, "orders", 0.5).head()
    assert (line.rows_received, line.rows_accepted, line.rows_rejected) == (4, 2, 2)
    assert (line.rejection_rate, line.exceeds) == (0.5, False)


def test_threshold_is_strict(spark):
    enforce_threshold(DQReport("orders", 20, {"x": 1}), 0.05)
    enforce_threshold(DQReport("orders", 0, {}), 0.0)
    with pytest.raises(DataQualityError, match=r"rows were rejected"):
        enforce_threshold(DQReport("orders", 20, {"x": 2}), 0.05)
    empty = quality_summary(flag_orders(order_rows(spark, {}).limit(0)), "orders", 0.0).head()
    assert (empty.rejection_rate, empty.exceeds) == (0.0, False)


def test_first_of_many_blocks_and_rows(spark):
    rows = [(f"k{n % 5}", f"f{n % 3}", n % 4, n * 7919 % 1000 + 2**62) for n in range(120)]
    rows += [("lone", "f0", 0, 5), ("hot", "f2", 9, 2**63 - 1), ("hot", "f10", 0, 7)]
    frame = spark.createDataFrame(rows, "order_id string, __file string, __block long, __row long")
    got = repeated_keys(frame.withColumn(REASON, F.lit(None).cast("string"))).collect()
    want = {}
    for key, *at in rows:
        want.setdefault(key, []).append(tuple(at))
    assert {r.order_id: (tuple(r["__first"]), r["__copies"]) for r in got} == {
        k: (min(v), len(v)) for k, v in want.items() if len(v) > 1
    }


def test_counting_repeats_uses_hash_aggregation_and_no_window(spark, tmp_path):
    flag_orders(order_rows(spark, {})).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    plan = plan_of(repeated_keys(staged).select("order_id"))
    assert "Window" not in plan and "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
    assert "SortAggregate" not in plan
    plan = plan_of(flag_repeats(staged, repeated_keys(staged)))
    assert "BroadcastNestedLoop" not in plan and "Cartesian" not in plan
