"""What the physical plans must look like to hold at scale."""

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import docs
import pytest
from pyspark.sql import functions as F

import check
from ratebook.catalogue import adapters as A
from ratebook.catalogue import discovery, documents, snapshots
from ratebook.operators import compose
from ratebook.plans import load
from ratebook.session import sized_shuffles
from ratebook.sources import offers
from ratebook.sources.book import PriceBook

SF = f"{check.TESTDATA}/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_carrying_a_day_forward_shuffles_nothing(spark):
    book, newest, _ = snapshots.last_days(spark, SF)
    pairs = A.changed_pairs(spark, SF)
    carried = compose.carry_forward(
        book.read_history(on=newest), pairs, newest + timedelta(days=1)
    )
    text = plan(carried)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "hashpartitioning" not in text and "SortMergeJoin" not in text


def test_history_scan_is_pruned(spark):
    text = plan(snapshots.price_over_time(spark, SF))
    assert "PartitionFilters: [isnotnull(ingestion_date" in text
    scan = text[text.index("FileScan") :]
    assert "(service_code#" in scan[scan.index("PartitionFilters") : scan.index("PushedFilters")]
    # Only the path in question is read of the variant column.
    assert "attributes:struct<0:" in scan and "term_attributes" not in scan


def test_documents_are_pruned_to_changed_targets(spark):
    landing = A.landing(spark, SF)
    targets = A.written_keys(
        discovery.targets(spark, SF).where("region_code = 'NATION_3'"),
        A.new_folder(spark, "targets"),
    ).frame
    fresh = load.fresh_rows(
        spark,
        landing,
        targets,
        run_date=A.RUN_DATE,
        ingested_at=A.NOW,
        include_plans=False,
        include_reserved=True,
    )
    assert "dynamicpruning" in plan(fresh)


def above_documents(plan):
    """The operators between the scan of documents and the rows, by their tree's branches."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan json" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    path = []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            path.append(line.strip(" :+-"))
            depth = own
    return path


@pytest.mark.parametrize("make", [documents.flat_services, documents.flat_plans])
def test_documents_are_read_once_and_not_shuffled(spark, make):
    """The targets, a small set, are exchanged; the documents are not."""
    text = plan(make(spark, SF))
    assert text.count("FileScan json") == 1 and text.count("Generate") >= 2
    path = above_documents(text)
    assert any(line.startswith("BroadcastHashJoin") for line in path)
    assert sum(line.startswith("Generate") for line in path) >= 2
    assert not any("Exchange" in line or "Window" in line or "Sort" in line for line in path)


def test_landing_groups_within_one_shuffle(spark):
    text = plan(A.service_bodies(spark, SF))
    assert text.count("Exchange hashpartitioning(c_mktsegment") == 1


ORDERS = 300


@pytest.fixture
def sold(spark, tmp_path):
    """Tables of 300 orders in 75 spans, all of two customers in one nation."""
    tables = {
        "orders": (
            [
                (k << 18, k % 2, "OP"[k % 3 == 0], Decimal(k), f"{k % 5}-MEDIUM")
                for k in range(ORDERS)
            ],
            "o_orderkey long, o_custkey long, o_orderstatus string, "
            "o_totalprice decimal(18,2), o_orderpriority string",
        ),
        "customer": (
            [(0, "zero", 3, "BUILDING"), (1, "one", 3, "BUILDING")],
            "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
        ),
        "nation": ([(3, "NATION_3")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        frame = spark.createDataFrame(rows, schema)
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("bodies", [A.service_bodies, A.plan_bodies])
def test_landing_tasks_follow_the_orders(spark, sold, monkeypatch, bodies):
    """More orders are more tasks, of narrow rows; every order stays in one slice."""
    monkeypatch.setattr(A, "TASK_ORDERS", 10)
    landed = bodies(spark, sold)
    text = plan(landed)
    assert f", {ORDERS // 10}), REPARTITION_BY_NUM" in text
    assert "struct(" not in text[text.index("REPARTITION_BY_NUM") :]
    rows = [r for r in landed.collect() if "SHELL" not in r.offer_url]
    assert len({(r.offer_url, r.slice) for r in rows}) == len(rows)
    assert {r.slice for r in rows} == {k << 2 for k in range(ORDERS)}
    orders = [f'"order {k << 18}"' for k in range(ORDERS)]
    if bodies is A.plan_bodies:
        orders = [f'"RC{k << 18}"' for k in range(ORDERS)]
    found = "".join(r.body for r in rows)
    assert all(found.count(order) == 1 for order in orders)


def test_slices_of_a_span_share_a_task(spark, sold):
    placed = A.dealt(spark, sold, A.sales(spark, sold), "c_mktsegment", "n_name")
    placed = placed.withColumn("task", F.spark_partition_id())
    tasks = placed.groupBy("c_mktsegment", "n_name", "span").agg(
        F.count_distinct("task").alias("tasks"), F.count_distinct("slice").alias("slices")
    )
    assert {(r.tasks, r.slices) for r in tasks.collect()} == {(1, 4)}


def test_history_tasks_follow_the_events(spark, tmp_path, monkeypatch):
    """One day and one type of events is spread, too."""
    monkeypatch.setattr(A, "TASK_EVENTS", 10)
    noon = datetime(2024, 1, 5, 12)
    rows = [(k, noon, 7, "view", Decimal(k), f'{{"k": {k}}}') for k in range(400)]
    schema = (
        "event_id long, ts timestamp, user_id long, event_type string, "
        "value decimal(18,2), props string"
    )
    events = spark.createDataFrame(rows, schema)
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    history = A.history_book(spark, str(tmp_path)).read_history(on=date(2024, 1, 5))
    assert len(history.inputFiles()) == 40
    by_file = history.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in by_file) <= 20
    assert sorted(r.rate_code for r in history.collect()) == sorted(f"E{k}" for k in range(400))


def test_shuffles_widen_with_the_input(spark):
    with sized_shuffles(spark, 1 << 30):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 32
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "32m"


def test_load_lands_compressed_documents(spark, sold):
    """The same documents in a small part of their bytes."""
    for land, make in (
        (A.landed_load_services, A.service_bodies),
        (A.landed_load_plans, A.plan_bodies),
    ):
        root = Path(land(spark, sold))
        files = list(root.rglob("part-*"))
        assert files and all(f.name.endswith(".txt.gz") for f in files)
        bodies = [r.body for r in make(spark, sold).collect() if "SHELL" not in r.offer_url]
        assert sorted(r.value for r in spark.read.text(str(root)).collect()) == sorted(bodies)
        assert sum(f.stat().st_size for f in files) < sum(map(len, bodies)) / 3


def test_versions_on_offer_take_one_pass(spark, sold, monkeypatch):
    """All sales are joined once for the versions, and once for each kind of document."""
    passes, sales = [], A.sales
    monkeypatch.setattr(A, "sales", lambda *args: passes.append(args) or sales(*args))
    landing = A.landing(spark, sold)
    assert len(passes) == 3
    newest = (ORDERS - 1) << 18
    found = {r.offer_url for r in spark.read.text(landing.service_offers).collect()}
    assert found == {f"{A.BASE_URL}/offers/v1.0/BUILDING/v{newest}/NATION_3/index.json"}
    # Two customers have a plan each.
    found = {r.offer_url.split("/")[-3] for r in spark.read.text(landing.plan_offers).collect()}
    assert found == {f"p{newest}", f"p{newest - (1 << 18)}"}


def test_compressed_documents_count_as_unfolded(spark, tmp_path):
    """So a shuffle is as wide for a compressed landing."""
    text = "".join(f'{{"a": {k}}}\n' for k in range(1000)).encode()
    docs.land_document(tmp_path, "plain", text)
    docs.land_document(tmp_path, "zipped", text, zipped=True)
    found = {r.offer_url: r.bytes for r in offers.landed_documents(spark, str(tmp_path)).collect()}
    zipped = (tmp_path / "offer_url=zipped/doc.json.gz").stat().st_size
    assert found == {"plain": len(text), "zipped": zipped * offers.GZIP_RATIO}


def test_history_is_dealt_by_narrow_tasks(spark, tmp_path):
    """What a task holds for the shuffle does not grow with the files for each core."""
    book = PriceBook(spark, f"narrow_{tmp_path.name}", str(tmp_path / "book"))
    book.provision()
    day = date(2024, 1, 5)
    rows = docs.history_rows(spark, day, [("A", f"r{k}") for k in range(96)])
    path = str(tmp_path / "rows")
    rows.write.option("maxRecordsPerFile", 1).parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    fresh = spark.read.schema(rows.schema).parquet(path)
    fresh = fresh.withColumn("description", F.spark_partition_id().cast("string"))
    changed = A.written_keys(rows.select("service_code", "region_code"), str(tmp_path / "pairs"))
    parts = book.compose_day(None, day, fresh, changed.frame)
    dealt = [r.description for r in book.written_rows(parts).collect()]
    # A file counts as 4 MB at least, and a task has 8 MB.
    assert len(dealt) == 96 and max(map(dealt.count, dealt)) <= 2
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
