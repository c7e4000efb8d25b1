import docs
import pytest

from ratebook.operators import diff, discover
from ratebook.sources import indexes


@pytest.fixture
def catalogue(tmp_path):
    made = docs.Catalogue(tmp_path)
    made.offer("Compute", "r1", "v1", None)
    made.offer("Compute", "r2", "v1", None)
    made.offer("Storage", "r1", "v2", None)
    made.offer_plan(indexes.PLAN_CODES[0], "r1", "v3", {})
    return made


def found(spark, landing, **options):
    targets = discover.discover_targets(
        spark, landing.master_index, landing.region_indexes, base_url=docs.BASE, **options
    )
    return sorted((t.service_code, t.region_code, t.offer_type, t.version) for t in targets.collect())


PLAN = (indexes.PLAN_CODES[0], "r1", "savings_plan", "v3")
SERVICES = [
    ("Compute", "r1", "service", "v1"),
    ("Compute", "r2", "service", "v1"),
    ("Storage", "r1", "service", "v2"),
]


def test_all_targets(spark, catalogue):
    """Two plan codes have no region index: they are left out, nothing else is."""
    assert found(spark, catalogue.landing()) == sorted([*SERVICES, PLAN])


def test_filter_does_not_touch_plans(spark, catalogue):
    landing = catalogue.landing()
    assert found(spark, landing, service_filter=" Storage ,") == sorted([SERVICES[2], PLAN])
    assert found(spark, landing, include_plans=False) == SERVICES


def test_unreadable_index_takes_only_its_service_out(spark, catalogue):
    landing = catalogue.landing(corrupt=("Compute",))
    assert found(spark, landing) == sorted([SERVICES[2], PLAN])
    (rejected,) = indexes.rejected(
        indexes.read_region_indexes(spark, landing.region_indexes)
    ).collect()
    assert "Compute" in rejected.index_path


def entries(spark, regions):
    frame = spark.createDataFrame([("/p", regions)], "index_path string, regions string")
    return sorted(
        (r.region_code, r.version_url) for r in indexes.region_entries(frame).collect()
    )


def test_region_entries_both_shapes(spark):
    named = """{"r1": {"regionCode": "x", "currentVersionUrl": "/a"}, "r2": null,
      "r3": {"currentVersionUrl": "", "versionUrl": "/b"}}"""
    assert entries(spark, named) == [("r1", "/a"), ("r2", None), ("r3", "/b")]
    listed = """ [{"regionCode": "r1", "versionUrl": "/a"}, {"versionUrl": "/lost"},
      {"regionCode": "", "versionUrl": "/lost"}, null, {"regionCode": "r2"}]"""
    assert entries(spark, listed) == [("r1", "/a"), ("r2", None)]
    assert entries(spark, "[]") == []
    assert entries(spark, "{}") == []


def test_diff(spark):
    key = "service_code string, region_code string, offer_type string, version string"
    targets = spark.createDataFrame(
        [("A", "r", "service", "v1"), ("A", "r", "service", "v2"), ("B", "r", "service", "v9")],
        key,
    )
    known = spark.createDataFrame([("A", "r", "service", "v1")], key)
    assert {(t.service_code, t.version) for t in diff.changed(targets, known).collect()} == {
        ("A", "v2"),
        ("B", "v9"),
    }
    assert diff.skipped(targets, known).count() == 1
    assert tuple(diff.diff_counts(targets, known).first()) == (2, 1)
    assert diff.changed(targets, diff.no_known_versions(known)).count() == 3
    assert diff.changed_pairs(targets).count() == 2
