"""Order and top-level drift between two manifests."""

from faultline.plans import publish

SCHEMA = (
    "name string, path string, contract_status string, schema_version string, data_generated_at string, mock boolean, "
    "item_count long, size_bytes long, sha256 string, position int"
)


def test_order_and_summary_drift(spark):
    rows = [(n, n, "VALID", "1", "d", False, 1, 1, "h", i) for i, n in enumerate("ab")]
    made = spark.createDataFrame(rows, SCHEMA)
    swapped = spark.createDataFrame([(*r[:-1], 1 - r[-1]) for r in rows], SCHEMA)
    assert publish.manifest_drift(made, made).count() == 0
    got = {tuple(r) for r in publish.manifest_drift(made, swapped).collect()}
    assert got == {("a", "position", "0", "1"), ("b", "position", "1", "0")}
    got = {tuple(r) for r in publish.manifest_drift(made, made.filter("name = 'a'")).collect()}
    assert got == {
        ("b", "entry", "present", None), (None, "files_total", "2", "1"), (None, "files_valid", "2", "1")
    }
