"""Hash trees, ranks, JSON numbers and the publication of a store."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from faultline.functions.ranking import range_ranked
from faultline.operators import aggregates
from faultline.plans import incremental, publication, publish
from faultline.plans.store import Store
from faultline.sinks import payloads
from faultline.sources.lines import file_hashes
from tests.test_silver import RAW_ROWS
from tests.test_store import land


def plain_tree(text, chunk):
    level = [hashlib.sha256(line.encode()).hexdigest() for line in text.splitlines()]
    for _ in range(3):
        level = [hashlib.sha256("".join(level[i : i + chunk]).encode()).hexdigest() for i in range(0, len(level), chunk)]
    assert len(level) == 1
    return level[0]


@pytest.mark.parametrize("size", ["128m", "3k", "200"])
def test_file_hash_is_a_tree_over_its_lines(spark, tmp_path, size):
    rng = random.Random(3)
    texts = {f"f{n}.json": "\n".join("{" + "x" * rng.randint(0, 60) + f"{i}é" for i in range(rng.choice([1, 8, 9, 511]))) + "\n" for n in range(9)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    (tmp_path / "dos.json").write_text(texts["f3.json"].replace("\n", "\r\n"), encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = file_hashes(spark, str(tmp_path), chunk=8).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    found = {r.path.rsplit("/", 1)[-1]: (r.sha256, r.size_bytes) for r in rows}
    assert found.pop("dos.json") == found["f3.json"]
    assert found == {name: (plain_tree(text, 8), len(text.encode())) for name, text in texts.items()}


def test_payload_of_several_files_has_one_repeatable_hash(spark, tmp_path):
    hashes = []
    for turn, parts in enumerate((1, 1, 3)):
        rows = spark.range(0, 100, 1, parts).select("id", F.concat(F.lit("n"), "id").alias("name"))
        payloads.write_json(rows, str(tmp_path / str(turn)), lines_per_file=17)
        files = file_hashes(spark, str(tmp_path / str(turn)))
        assert files.count() >= 6
        hashes.append(files.agg(publish.combined_hash().alias("h")).first().h)
    assert hashes[0] == hashes[1] != hashes[2]


def test_ranks_across_tasks(spark):
    rng = random.Random(1)
    rows = [(rng.choice("aaab"), rng.randint(0, 9), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "kind string, score int, id int").repartition(7)
    got = range_ranked(frame, "kind", [F.desc("score"), F.asc("id")], "rank")
    expected = {}
    for kind in "ab":
        own = sorted((r for r in rows if r[0] == kind), key=lambda r: (-r[1], r[2]))
        expected |= {r: n for n, r in enumerate(own, 1)}
    assert {(r.kind, r.score, r.id): r["rank"] for r in got.collect()} == expected
    assert range_ranked(frame.limit(0), "kind", [F.asc("id")], "rank").count() == 0


def test_percentile_is_the_nearest_rank(spark):
    rng = random.Random(2)
    rows = [(g, rng.choice([None, *range(1, 50)]), f"p{rng.randint(1, 2)}") for g in "abc" for _ in range(rng.choice([1, 20, 40, 333]))]
    rows += [("none", None, "p1")]
    frame = spark.createDataFrame(rows, "team string, duration_seconds long, priority_name string")
    blank = ["opened_by string", "entered_kpi boolean", "kpi_violated boolean", "kpi_eligible_by_rule boolean", "kpi_violated_by_rule boolean",
             "entered_kpi_rule_matches_source boolean", "kpi_violated_rule_matches_source boolean"]
    for name, kind in (c.split() for c in blank):
        frame = frame.withColumn(name, F.lit(None).cast(kind))
    cells = aggregates.duration_cells(frame, ["team"])
    table = cells.groupBy("team").agg(*aggregates.counts(cells, "total_incidents"), aggregates.mean_duration(cells), aggregates.p95_duration())
    for row in table.collect():
        known = sorted(d for t, d, _ in rows if t == row.team and d is not None)
        assert row.total_incidents == sum(t == row.team for t, _, _ in rows)
        assert row.p95_duration_seconds == (known[-(-95 * len(known) // 100) - 1] if known else None)
        assert row.avg_duration_seconds == (round(sum(known) / len(known) + 1e-12, 2) if known else None)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_numbers_that_json_does_not_know_become_null(spark, tmp_path):
    rows = [(1.5, [float("nan"), 2.0], (float("inf"), "x")), (float("-inf"), None, None)]
    frame = spark.createDataFrame(rows, "a double, b array<double>, c struct<d:double,e:string>")
    payloads.write_json(frame, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "j").glob("*.json")))
    assert "NaN" not in text and "Infinity" not in text
    back = spark.read.schema(frame.schema).option("mode", "FAILFAST").json(str(tmp_path / "j")).collect()
    assert sorted(map(tuple, back), key=str) == sorted([(1.5, [None, 2.0], (None, "x")), (None, None, None)], key=str)


def test_refused_publication_leaves_the_earlier_one(spark, tmp_path):
    store = Store.create(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        publication.published_folder(store)
    land(tmp_path / "landing", "a.csv", RAW_ROWS)
    incremental.run_incremental(store, str(tmp_path / "landing"))
    run = publication.publish_gold(store, "2026-02-01")
    assert publication.published_folder(store).endswith(run)
    manifest = publication.published(store, "manifest", publish.MANIFEST_SCHEMA)
    names = [r.name for r in manifest.orderBy("position").collect()]
    assert names == ["filter_options", "daily_trends", "risk_summary", "forecast_history", "forecast", "recommendations"]
    assert {r.contract_status for r in manifest.collect()} == {"VALID"} and manifest.filter("length(sha256) = 64").count() == 6
    head = spark.read.json(f"{publication.published_folder(store)}/manifest_head").first()
    assert (head.schema_version, head.generated_at, head.status, head.files_total) == ("1.0", "2026-02-01", "HEALTHY", 6)
    schema = publication.stored_trend_schema(store.gold("daily_trends"))
    assert publication.partition_problems(store, publication.published_folder(store), schema).count() == 0

    flawed = publication.payload_tables(publication.gold_of(store))
    flawed["risk_summary"] = flawed["risk_summary"].withColumn("risk_score", F.lit(101.0))
    with pytest.raises(publication.PublicationRefused, match="risk_summary"):
        publication.publish_gold(store, "2026-02-02", tables=flawed)
    assert publication.published_folder(store).endswith(run) and store.control("publications").count() == 1
    assert not publish.publication_gate(manifest.withColumn("mock", F.lit(True))).first().publishable
