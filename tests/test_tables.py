import gzip
from datetime import date, datetime, timezone
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.operators import audit, compose, upsert
from ratebook.operators.keys import written_keys
from ratebook.scratch import new_folder, shared_root
from ratebook.sources import ndjson
from ratebook.sources.book import PriceBook

D1, D2, D3 = date(2025, 5, 1), date(2025, 5, 2), date(2025, 5, 3)
NOW = datetime(2025, 5, 1, 2, tzinfo=timezone.utc)


@pytest.fixture
def book(spark, tmp_path):
    made = PriceBook(spark, f"t_{uuid4().hex}", str(tmp_path / "book"))
    made.provision()
    return made


def history(spark, day, rows):
    """History rows from (service, region, sku, price) tuples."""
    values = {
        "ingestion_date": F.lit(day),
        "version": F.lit("v1"),
        "offer_type": F.lit("service"),
        "rate_code": F.concat("sku", F.lit(".1")),
        "ingested_at": F.lit(NOW),
        "attributes": F.parse_json(F.lit('{"k": "v"}')),
    }
    named = ("service_code", "region_code", "sku", "price_per_unit")
    frame = spark.createDataFrame(
        rows, "service_code string, region_code string, sku string, price_per_unit double"
    )
    return frame.select(
        *[
            values.get(f.name, F.col(f.name) if f.name in named else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schemas.HISTORY
        ]
    )


def pairs(spark, rows):
    frame = spark.createDataFrame(rows, "service_code string, region_code string")
    return written_keys(frame, new_folder(spark, "pairs")).frame


def content(rows):
    return sorted(
        (r.service_code, r.region_code, r.sku, float(r.price_per_unit)) for r in rows.collect()
    )


OLD = [("A", "r1", "x", 1.0), ("A", "r2", "x", 2.0), ("B", "r1", "y", 3.0)]


def test_history_needs_a_partition_filter(spark, book):
    with pytest.raises(ValueError):
        book.read_history()
    with pytest.raises(ValueError):
        book.read_history(on=D1, between=(D1, D2))
    book.publish({d: book.write_rows(history(spark, d, OLD), d) for d in (D1, D2, D3)})
    assert book.read_history(on=D2).count() == 3
    assert book.read_history(between=(D1, D2)).count() == 6


def test_provisioning_twice_keeps_content(spark, book):
    book.publish({D1: book.write_rows(history(spark, D1, OLD), D1)})
    book.provision()
    assert book.read_history(on=D1).count() == 3
    assert not spark.catalog.tableExists(f"{book.database}.live")


def test_publishing_nothing_changes_nothing(spark, book):
    book.publish({})
    assert book.partition_dates() == [] and book.files.names(f"{book.location}/pointers") == []


def test_latest_previous_partition_skips_empty_days(spark, book):
    assert book.latest_previous_partition(D3) is None
    book.publish(
        {
            D1: book.write_rows(history(spark, D1, OLD), D1),
            D2: book.write_rows(history(spark, D2, OLD).limit(0), D2),
        }
    )
    assert book.latest_previous_partition(D3) == D1
    assert book.latest_previous_partition(D1) is None
    assert book.partition_has_data(D1) and not book.partition_has_data(D2)
    assert not book.partition_has_data(D3)


def test_compose(spark):
    changed = pairs(spark, [("A", "r1")])
    fresh = history(spark, D2, [("A", "r1", "z", 9.0)])
    base = history(spark, D1, OLD)
    composed = compose.compose(base, fresh, changed, D2)
    assert content(composed) == [
        ("A", "r1", "z", 9.0),
        ("A", "r2", "x", 2.0),
        ("B", "r1", "y", 3.0),
    ]
    assert {r[0] for r in composed.select("ingestion_date").collect()} == {D2}
    assert content(compose.compose(None, fresh, changed, D2)) == [("A", "r1", "z", 9.0)]
    assert content(compose.compose(base, fresh.limit(0), pairs(spark, []), D2)) == OLD


def test_live_readers_never_see_a_half_written_table(spark, book):
    book.publish({D1: book.write_rows(history(spark, D1, OLD), D1)})
    book.swap_live(D1)
    reader = book.read_live()
    book.publish({D1: book.write_rows(history(spark, D1, OLD[:1]), D1)})
    assert book.read_live().count() == 3  # published, not yet swapped
    book.swap_live(D1)
    assert book.read_live().count() == 1
    assert reader.count() == 3  # planned before the swap


@pytest.mark.parametrize("column", schemas.REQUIRED_HISTORY)
def test_required_columns(spark, book, column):
    kind = schemas.HISTORY[column].dataType
    rows = history(spark, D1, OLD).withColumn(
        column, F.when(F.col("sku") != "y", F.col(column)).cast(kind)
    )
    with pytest.raises(Exception, match=f"required column {column} is NULL"):
        book.write_rows(rows, D1)
    assert book.partition_dates() == []


def test_lookups_skip_row_groups(spark, book):
    """Files keep bloom filters of the columns that single rows are looked up by."""
    rows = history(spark, D1, [("A", "r1", f"K{n:04}", 1.0) for n in range(0, 2000, 2)])
    book.publish({D1: book.write_rows(rows, D1)})
    read = []
    for sku in ("K0500", "K0501"):  # the second lies between others, and isn't there
        found = book.read_history(on=D1).where(F.col("sku") == sku).select("sku", "region_code")
        count = len(found.collect())
        scan = found._jdf.queryExecution().executedPlan()
        while not scan.children().isEmpty():
            scan = scan.children().head()
        read.append((count, scan.metrics().apply("numOutputRows").value()))
    assert read[0][0] == 1 and read[0][1] > 0
    assert read[1] == (0, 0)


def test_rows_of_another_day_are_refused(spark, book):
    with pytest.raises(Exception, match="a row is not dated 2025-05-02"):
        book.write_rows(history(spark, D1, OLD), D2)


def test_large_key_set_is_joined_not_broadcast(spark):
    """Beyond the size limit the same rows come out of a shuffled join, also when
    one pair holds most of them."""
    rows = history(spark, D1, OLD + [("A", "r1", f"hot{i}", 1.0) for i in range(500)])
    frame = spark.createDataFrame([("A", "r1")], "service_code string, region_code string")
    small = written_keys(frame, new_folder(spark, "k"))
    large = written_keys(frame, new_folder(spark, "k"), limit=0)
    assert (small.rows, large.rows) == (1, 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for keys, join in ((small, "BroadcastHashJoin"), (large, "SortMergeJoin")):
            kept = compose.pairs_not_in_changed(rows, keys.frame)
            assert join in plan(kept)
            assert content(kept) == [("A", "r2", "x", 2.0), ("B", "r1", "y", 3.0)]
            assert compose.pairs_in_changed(rows, keys.frame).count() == 501
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_empty_key_set(spark):
    none = pairs(spark, [])
    rows = history(spark, D1, OLD)
    assert compose.pairs_in_changed(rows, none).count() == 0
    assert content(compose.pairs_not_in_changed(rows, none)) == OLD


# --- versions ---------------------------------------------------------------


def versions(spark, rows):
    frame = spark.createDataFrame(rows, "service_code string, region_code string, version string")
    values = {
        "offer_type": F.lit("service"),
        "publication_date": F.lit(NOW),
        "loaded_at": F.lit(NOW),
        "source_url": F.concat(F.lit("u-"), "version"),
    }
    return frame.withColumns(values).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.VERSIONS]
    )


def as_dict(frame):
    return {
        (r.service_code, r.region_code): (r.version, r.source_url, r.publication_date is None)
        for r in frame.collect()
    }


def test_merge_and_upsert_versions(spark, book):
    book.replace_versions(versions(spark, [("A", "r1", "v1"), ("B", "r1", "v1")]))
    merged = upsert.merge_versions(
        book.read_versions(), versions(spark, [("A", "r1", "v2"), ("C", "r1", "v1")])
    )
    book.replace_versions(merged)
    assert as_dict(book.read_versions()) == {
        ("A", "r1"): ("v2", "u-v2", False),
        ("B", "r1"): ("v1", "u-v1", False),
        ("C", "r1"): ("v1", "u-v1", False),
    }
    shells = spark.createDataFrame(
        [("A", "r1", "service", "v3", "u3"), ("D", "r1", "service", "v1", "u4")],
        ", ".join(f"{c} string" for c in schemas.TARGET),
    )
    done = upsert.upsert_empty_targets(book.read_versions(), shells, F.lit(NOW).cast("timestamp"))
    assert as_dict(done) == {
        ("A", "r1"): ("v3", "u3", False),
        ("B", "r1"): ("v1", "u-v1", False),
        ("C", "r1"): ("v1", "u-v1", False),
        ("D", "r1"): ("v1", "u4", True),
    }


def test_versions_from_history_come_from_one_row(spark):
    rows = history(spark, D1, OLD)
    later = rows.withColumns(
        {
            "version": F.lit("v2"),
            "source_url": F.lit("later"),
            "ingested_at": F.lit(datetime(2025, 5, 1, 3, tzinfo=timezone.utc)),
        }
    )
    found = upsert.versions_from_history(rows.unionByName(later.where("region_code = 'r2'")))
    assert {(r.service_code, r.region_code): (r.version, r.source_url) for r in found.collect()} == {
        ("A", "r1"): ("v1", None),
        ("A", "r2"): ("v2", "later"),
        ("B", "r1"): ("v1", None),
    }


# --- audit ------------------------------------------------------------------


def test_run_audit(spark, book):
    for i in range(3):
        at = datetime(2025, 5, 1, i, tzinfo=timezone.utc)
        book.record(audit.start_run(spark, f"run{i}", at, "A,B", D1))
    book.record(audit.finish_run(spark, "run0", 10, 2, 1))
    book.record(audit.fail_run(spark, "run1", "x" * 10_000))
    book.record(audit.finish_run(spark, "never started", 1, 1, 1))
    runs = book.read_runs()
    assert [r.run_id for r in audit.list_runs(runs, 2).collect()] == ["run2", "run1"]
    done = audit.get_run(runs, "run0").first()
    assert (done.status, done.rows_loaded, done.services_skipped) == ("succeeded", 10, 1)
    assert done.finished_at is not None and done.service_filter == "A,B"
    assert len(audit.get_run(runs, "run1").first().error) == 8_000
    assert audit.get_run(runs, "nope").first() is None
    assert audit.get_run(runs, "never started").first() is None
    assert audit.shown_counts(audit.get_run(runs, "run2")).first().rows_loaded == 0


# --- sinks and folders ------------------------------------------------------


def test_ndjson_works_rows_out_once(spark, tmp_path):
    rows = history(spark, D1, OLD)
    for given in (rows, rows.where(F.lit(False))):
        seen = spark.sparkContext.accumulator(0)
        counted = given.rdd.map(lambda r: (seen.add(1), r.sku)[1]).map(lambda s: (s,)).toDF("sku string")
        assert ndjson.write_ndjson(counted, str(tmp_path / uuid4().hex)) == seen.value


def test_ndjson(spark, tmp_path):
    rows = history(spark, D1, OLD)
    assert ndjson.write_ndjson(rows.limit(0), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    assert ndjson.write_ndjson(rows, str(tmp_path / "some")) == 3
    files = list(Path(tmp_path / "some").glob("*.json.gz"))
    lines = [line for f in files for line in gzip.open(f, "rt")]
    assert len(lines) == 3
    assert all('"currency":null' in line and '"attributes":{"k":"v"}' in line for line in lines)
    assert content(spark.read.schema(schemas.HISTORY).json(str(tmp_path / "some"))) == OLD


def test_delimited_lines(spark):
    text = spark.createDataFrame([("a|b|c\n\n|x\n",)], "t string")
    rows = upsert.delimited_lines_to_rows(text, "t", ["p", "q", "r"]).collect()
    assert [tuple(r) for r in rows] == [("a", "b", "c"), ("", "x", None)]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")
