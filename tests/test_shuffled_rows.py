"""What large loads move between tasks and leave on disk."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from faultline.config import SLA
from faultline.operators.quality import latest_versions
from faultline.operators.sla import audit_sla
from faultline.plans import incremental
from faultline.plans.silver import silver_records
from faultline.plans.store import STORE_TIEBREAK, Store
from faultline.queries import frames
from faultline.session import compact_profile, settings
from faultline.sinks import tables
from tests.test_silver import raw_rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def staged_versions(spark, path):
    rows = [
        (f"INC{n % 7:07d}", f"{n % 5 + 1} - P", f"2026-0{n % 3 + 1}-05 10:00:00", f"2026-0{n % 4 + 1}-1{n % 9} 0{n % 8}:00:00", str(n), "T")
        for n in range(40)
    ]
    lineage = {"_batch_id": F.lit("b"), "_source_file": F.lit("f"), "_source_hash": F.lit("h"), "_ingested_at": F.current_timestamp()}
    rows = silver_records(incremental.with_digest(raw_rows(spark, rows).withColumns(lineage)))
    rows.repartition(3).write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def test_whole_rows_cross_one_shuffle(spark, tmp_path, monkeypatch):
    """The newest versions are chosen by narrow rows; whole ones only go to their months, with bitmaps sent or joined."""
    store = Store.create(spark, str(tmp_path / "store"))
    older, newer = staged_versions(spark, str(tmp_path / "older")), staged_versions(spark, str(tmp_path / "newer"))
    both = latest_versions(audit_sla(older.unionByName(newer), SLA), STORE_TIEBREAK)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merged = incremental.merge_versions(store, [older, newer], SLA, STORE_TIEBREAK)
        plan = plan_of(merged)
        assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1 and "REBALANCE" in plan
        names = [name for name in both.columns if name != "_ingested_at"]
        wanted = sorted(map(str, both.select(names).collect()))
        assert sorted(map(str, merged.select(names).collect())) == wanted and merged.columns == both.columns
        monkeypatch.setattr(incremental, "BITMAPS_SENT", 0)
        joined = incremental.merge_versions(store, [older, newer], SLA, STORE_TIEBREAK)
        assert "BroadcastHashJoin" not in plan_of(joined) and sorted(map(str, joined.select(names).collect())) == wanted


def test_rows_without_files_are_staged_for_an_upsert(spark, tmp_path):
    """Equal rows stay one incident whether the incoming rows are computed or read."""
    store = Store.create(spark, str(tmp_path / "store"))
    rows = staged_versions(spark, str(tmp_path / "rows"))
    twice = rows.crossJoin(spark.range(2)).drop("id")
    assert incremental.upsert(store, twice)["merged"] == 7
    assert incremental.upsert(store, rows, filed=True)["merged"] == 7 and store.records().count() == 7


def test_the_newest_version_is_chosen_before_parts_are_joined(spark, tmp_path):
    """The join by part scatters versions of an incident; parts that repeat do not make it two."""
    day = datetime.datetime(1995, 3, 1)
    lines = [(o, n % 3, 1, n, 10.0 * n, 0.05, "R", "O", day + datetime.timedelta(n)) for o in range(5) for n in range(1, 5)]
    shapes = {
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, "
                            "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "orders": ([(o, "1-URGENT", day, "O") for o in range(5)],
                   "o_orderkey long, o_orderpriority string, o_orderdate timestamp, o_orderstatus string"),
        "part": ([(p, f"part {p}", "Brand#1", "PROMO", p) for p in (0, 1, 1, 2)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(1, "Supplier", 3), (1, "Supplier", 3)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(3, "NATION")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in shapes.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = frames.current(spark, str(tmp_path))
    plan = plan_of(found)
    assert plan.index("p_partkey") < plan.index("WindowGroupLimit")
    rows = found.collect()
    assert sorted(r.incident_id for r in rows) == [f"INC{o:07d}" for o in range(5)]
    assert {(r.closed_at, r.short_description, r.assigned_group) for r in rows} == {(day + datetime.timedelta(4), "part 1", "NATION")}


def test_rows_are_dealt_by_value_without_a_shuffle(spark, tmp_path):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 != 9, F.concat(F.lit("1995_0"), F.col("id") % 3 + 1)).alias("_month"))
    for rows_per_task, fewest in ((150, 5), (1000, 4)):
        with settings(spark, tables.SCAN_CONF):
            dealt = tables.stored_by(spark, rows.repartition(4), str(tmp_path / str(fewest)), "_month", rows_per_task)
            tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct(F.coalesce("_month", F.lit(""))).alias("n"))
            found = tasks.collect()
            assert "Exchange" not in plan_of(dealt) and {task.n for task in found} == {1} and len(found) >= fewest
            assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))


def test_shuffle_files_go_with_their_query(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with compact_profile(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
