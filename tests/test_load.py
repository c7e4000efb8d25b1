"""Consecutive loads, compared by what the tables hold."""

import subprocess
import sys
from datetime import date, datetime, timedelta, timezone
from pathlib import Path
from uuid import uuid4

import docs
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ratebook.operators import audit
from ratebook.operators.guards import LoadRefused
from ratebook.operators.keys import written_keys
from ratebook.plans.load import run_load
from ratebook.plans.writer import Busy, TakenOver, writing
from ratebook.sources import offers
from ratebook.sources.book import PriceBook, UnknownContent

DAY1 = datetime(2025, 5, 1, 2, tzinfo=timezone.utc)


@pytest.fixture
def book(spark, tmp_path):
    return PriceBook(spark, f"t_{uuid4().hex}", str(tmp_path / "book"))


@pytest.fixture
def catalogue(tmp_path):
    return docs.Catalogue(tmp_path / "landing")


def live(book):
    rows = book.read_live().groupBy("service_code", "region_code").agg(
        F.count(F.lit(1)).alias("n"), F.max("price_per_unit").alias("p")
    )
    return {(r[0], r[1]): (r.n, float(r.p)) for r in rows.collect()}


def day_rows(book, day):
    return book.read_history(on=day).count()


def versions(book):
    return {
        (r.service_code, r.region_code): (r.version, r.publication_date)
        for r in book.read_versions().collect()
    }


def last_run(book):
    return audit.list_runs(book.read_runs(), 1).first()


def load(book, catalogue, now, **options):
    options.setdefault("include_plans", False)
    corrupt = options.pop("corrupt", ())
    return run_load(book, catalogue.landing(corrupt), now=now, **options)


def counts(result):
    return (result.rows_loaded, result.services_changed, result.services_skipped)


def test_five_loads(spark, book, catalogue):
    published = datetime(2025, 4, 2, 10)
    catalogue.offer("A", "r1", "v1", docs.priced(1, n=3))
    catalogue.offer("A", "r2", "v1", docs.priced(2, n=2))

    # 1. First run: fresh rows only.
    assert counts(load(book, catalogue, DAY1)) == (5, 2, 0)
    assert live(book) == {("A", "r1"): (3, 1), ("A", "r2"): (2, 2)}
    assert versions(book) == {("A", "r1"): ("v1", published), ("A", "r2"): ("v1", published)}
    run = last_run(book)
    assert (run.status, run.rows_loaded, run.services_changed) == ("succeeded", 5, 2)
    assert "ingestion_date" not in book.read_live().columns

    # 2. Nothing changed and today is there: nothing is written, nothing moves.
    parts = book.parts(date(2025, 5, 1))
    assert counts(load(book, catalogue, DAY1 + timedelta(hours=1))) == (0, 0, 2)
    assert book.parts(date(2025, 5, 1)) == parts
    assert (last_run(book).status, last_run(book).services_skipped) == ("succeeded", 2)

    # 3. Same day, one document changed: only its rows are replaced.
    catalogue.offer("A", "r1", "v2", docs.priced(10, n=4))
    assert counts(load(book, catalogue, DAY1 + timedelta(hours=2))) == (4, 1, 1)
    assert live(book) == {("A", "r1"): (4, 10), ("A", "r2"): (2, 2)}
    assert day_rows(book, date(2025, 5, 1)) == 6
    assert versions(book)["A", "r1"][0] == "v2" and versions(book)["A", "r2"][0] == "v1"

    # 4. Next day, another one changed: the rest is carried forward.
    catalogue.offer("A", "r2", "v2", docs.priced(20, n=1))
    assert counts(load(book, catalogue, DAY1 + timedelta(days=1))) == (1, 1, 1)
    assert live(book) == {("A", "r1"): (4, 10), ("A", "r2"): (1, 20)}
    assert day_rows(book, date(2025, 5, 1)) == 6 and day_rows(book, date(2025, 5, 2)) == 5
    carried = book.read_history(on=date(2025, 5, 2)).where("region_code = 'r1'")
    assert {r[0] for r in carried.select("ingested_at").distinct().collect()} == {
        datetime(2025, 5, 1, 4)
    }

    # 5. A day later one document became a shell and a new shell appears: the old
    # rows go, both versions are recorded, a new key without a publication date.
    catalogue.offer("A", "r2", "v3", docs.SHELL)
    catalogue.offer("B", "r1", "v1", docs.SHELL)
    assert counts(load(book, catalogue, DAY1 + timedelta(days=2))) == (0, 2, 1)
    assert live(book) == {("A", "r1"): (4, 10)}
    assert versions(book) == {
        ("A", "r1"): ("v2", published),
        ("A", "r2"): ("v3", published),
        ("B", "r1"): ("v1", None),
    }
    # ... and is not opened again.
    assert counts(load(book, catalogue, DAY1 + timedelta(days=3))) == (0, 0, 3)
    assert live(book) == {("A", "r1"): (4, 10)}
    # A day without changes shares the folders of the day before.
    assert book.partition_dates()[0] == date(2025, 5, 4)
    assert book.parts(date(2025, 5, 4)) == book.parts(date(2025, 5, 3))
    assert {r[0] for r in book.read_history(on=date(2025, 5, 4)).select("ingestion_date").collect()} == {
        date(2025, 5, 4)
    }
    assert book.read_runs().where("status = 'succeeded'").count() == 6


def test_force_reloads_everything(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    assert counts(load(book, catalogue, DAY1 + timedelta(hours=1), force=True)) == (1, 1, 0)
    assert day_rows(book, date(2025, 5, 1)) == 1


def test_gone_and_filtered_services_stay(book, catalogue):
    """A service that is filtered out or whose index fails keeps its rows."""
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    catalogue.offer("B", "r1", "v1", docs.priced(2))
    load(book, catalogue, DAY1)
    catalogue.offer("A", "r1", "v2", docs.priced(3))
    catalogue.offer("B", "r1", "v2", docs.priced(4))
    load(book, catalogue, DAY1 + timedelta(days=1), service_filter="A")
    assert live(book) == {("A", "r1"): (1, 3), ("B", "r1"): (1, 2)}
    load(book, catalogue, DAY1 + timedelta(days=2), corrupt=("B",))
    assert live(book) == {("A", "r1"): (1, 3), ("B", "r1"): (1, 2)}
    load(book, catalogue, DAY1 + timedelta(days=3))
    assert live(book) == {("A", "r1"): (1, 3), ("B", "r1"): (1, 4)}


def test_plans_are_loaded_with_services(book, catalogue):
    from test_flatten import PRODUCT, plan_document

    from ratebook.sources.indexes import PLAN_CODES

    catalogue.offer("A", "r1", "v1", docs.priced(1))
    catalogue.offer_plan(PLAN_CODES[0], "r1", "v1", plan_document([PRODUCT]))
    assert counts(load(book, catalogue, DAY1, include_plans=True)) == (4, 2, 0)
    assert {r[0] for r in book.read_versions().select("offer_type").collect()} == {
        "service",
        "savings_plan",
    }


def test_only_shells_and_no_history_is_refused(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.SHELL)
    with pytest.raises(LoadRefused, match="nothing to serve"):
        load(book, catalogue, DAY1)
    assert book.partition_dates() == [] and versions(book) == {}
    assert last_run(book).status == "failed" and "nothing to serve" in last_run(book).error


def test_document_that_was_not_landed_is_refused(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    catalogue.offer("A", "r1", "v2", None)
    with pytest.raises(LoadRefused, match="not landed.*/v2/"):
        load(book, catalogue, DAY1 + timedelta(days=1))
    assert live(book) == {("A", "r1"): (1, 1)} and versions(book)["A", "r1"][0] == "v1"


def test_zero_targets_is_refused(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    with pytest.raises(LoadRefused):
        load(book, catalogue, DAY1 + timedelta(days=1), service_filter="NONE")
    assert live(book) == {("A", "r1"): (1, 1)}
    assert last_run(book).status == "failed"


def test_failed_load_changes_nothing_and_is_healed(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    catalogue.offer("A", "r2", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    before = versions(book)
    catalogue.offer("A", "r1", "v2", docs.priced(5))
    catalogue.offer("A", "r2", "v2", docs.priced("not a price"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load(book, catalogue, DAY1 + timedelta(days=1))
    assert live(book) == {("A", "r1"): (1, 1), ("A", "r2"): (1, 1)}
    assert versions(book) == before and len(book.partition_dates()) == 1
    run = last_run(book)
    assert run.status == "failed" and 0 < len(run.error) <= 8000

    catalogue.offer("A", "r2", "v3", docs.priced(6))
    load(book, catalogue, DAY1 + timedelta(days=1, hours=1))
    assert live(book) == {("A", "r1"): (1, 5), ("A", "r2"): (1, 6)}


def reopened(spark, book):
    """The same location through another catalog database."""
    return PriceBook(spark, f"t_{uuid4().hex}", book.location)


def test_another_catalog_sees_everything(spark, book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1, n=3))
    catalogue.offer("B", "r1", "v1", docs.priced(2, n=2))
    load(book, catalogue, DAY1)
    catalogue.offer("A", "r1", "v2", docs.priced(5))
    again = reopened(spark, book)
    assert counts(load(again, catalogue, DAY1 + timedelta(days=1), service_filter="A")) == (1, 1, 0)
    assert live(again) == {("A", "r1"): (1, 5), ("B", "r1"): (2, 2)}
    assert day_rows(again, date(2025, 5, 1)) == 5
    assert {k: v[0] for k, v in versions(again).items()} == {("A", "r1"): "v2", ("B", "r1"): "v1"}
    # the first one catches up when it is opened
    book.provision()
    assert live(book) == live(again) and versions(book) == versions(again)


_SECOND_PROCESS = """
import sys, datetime
sys.path[:0] = [{root!r}, {tests!r}]
from ratebook.session import local_session
from ratebook.sources.book import PriceBook
spark = local_session("2", **{{"spark.sql.shuffle.partitions": "2"}})
book = PriceBook(spark, "elsewhere", {location!r})
book.provision()
rows = book.read_live().groupBy("service_code").count().collect()
print(sorted(map(tuple, rows)), len(book.partition_dates()), book.read_versions().count())
"""


def test_another_process_sees_everything(book, catalogue, tmp_path):
    catalogue.offer("A", "r1", "v1", docs.priced(1, n=3))
    catalogue.offer("B", "r1", "v1", docs.priced(2, n=2))
    load(book, catalogue, DAY1)
    here = Path(__file__).resolve().parent
    code = _SECOND_PROCESS.format(root=str(here.parent), tests=str(here), location=book.location)
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert out.stdout.splitlines()[-1] == "[('A', 3), ('B', 2)] 1 2", out.stderr[-2000:]


def test_a_publish_that_died_half_way_is_finished(spark, book, catalogue, monkeypatch):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    catalogue.offer("A", "r1", "v2", docs.priced(2))
    with monkeypatch.context() as broken:
        whole = PriceBook._serve
        broken.setattr(
            PriceBook, "_serve", lambda self, names: 1 / 0 if self._state.number > 1 else whole(self, names)
        )
        with pytest.raises(ZeroDivisionError):
            load(book, catalogue, DAY1 + timedelta(days=1))
    assert live(book) == {("A", "r1"): (1, 1)}
    load(book, catalogue, DAY1 + timedelta(days=1, hours=1))
    assert live(book) == {("A", "r1"): (1, 2)} and versions(book)["A", "r1"][0] == "v2"


def test_data_without_pointers_is_refused(spark, book):
    spark.range(1).write.parquet(f"{book.location}/data/history/old")
    with pytest.raises(UnknownContent):
        book.provision()


def test_unusable_indexes_are_kept(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    catalogue.offer("B", "r1", "v1", docs.priced(1))
    result = load(book, catalogue, DAY1, corrupt=("B",))
    (reject,) = book.read_rejects().collect()
    assert (reject.run_id, reject.service_code) == (result.run_id, "B")
    assert reject.reason == "index not readable" and reject.record


def test_carried_days_stay_clustered(spark, book, tmp_path):
    """A pair's rows lie in few files however often they were carried."""
    pairs = [("S03" if n % 2 else f"S{n % 20:02}", f"r{n % 7}") for n in range(4000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    book.provision()
    try:
        day = date(2025, 5, 1)
        changed = written_keys(
            spark.createDataFrame([("S03", "r1")], "service_code string, region_code string"),
            str(tmp_path / "pairs"),
        ).frame
        book.publish({day: book.write_rows(docs.history_rows(spark, day, pairs), day)})
        for _ in range(5):
            earlier, day = day, day + timedelta(days=1)
            fresh = docs.history_rows(spark, day, [("S03", "r1")] * 30)
            book.publish({day: book.compose_day(earlier, day, fresh, changed)})
        (folder,) = book.parts(day)["S03"]
        files = (
            book.written_rows({"S03": folder})
            .groupBy(F.input_file_name())
            .agg(F.min("region_code").alias("a"), F.max("region_code").alias("b"))
            .collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(files) >= 6
    assert sum(f.a <= "r3" <= f.b for f in files) <= 3


# --- parts ------------------------------------------------------------------


def services(book, catalogue, n):
    for k in range(n):
        for region in ("r1", "r2"):
            catalogue.offer(f"S{k}", region, "v1", docs.priced(k + 1, n=20))
    load(book, catalogue, DAY1)


def written_bytes(book):
    root = f"{book.location}/data/history"
    return sum(book.files.bytes(f"{root}/{name}") for name in book.files.names(root))


def test_a_changed_service_writes_only_its_own_bytes(spark, book, catalogue):
    services(book, catalogue, 8)
    first, day1, day2 = written_bytes(book), date(2025, 5, 1), date(2025, 5, 2)
    catalogue.offer("S3", "r1", "v2", docs.priced(40, n=20))
    assert counts(load(book, catalogue, DAY1 + timedelta(days=1))) == (20, 1, 15)
    assert written_bytes(book) - first < 1.5 * first / 8
    before, after = book.parts(day1), book.parts(day2)
    assert {s for s in after if after[s] != before[s]} == {"S3"}
    assert live(book)["S3", "r1"] == (20, 40) and live(book)["S3", "r2"] == (20, 4)
    assert len(live(book)) == 16 and day_rows(book, day1) == day_rows(book, day2) == 320


def test_a_rerun_with_one_pair_leaves_the_other_folders(book, catalogue):
    services(book, catalogue, 4)
    day = date(2025, 5, 1)
    before = book.parts(day)
    catalogue.offer("S2", "r2", "v2", docs.priced(9, n=1))
    assert counts(load(book, catalogue, DAY1 + timedelta(hours=3))) == (1, 1, 7)
    after = book.parts(day)
    assert {s for s in after if after[s] != before[s]} == {"S2"}
    assert live(book)["S2", "r2"] == (1, 9) and live(book)["S2", "r1"] == (20, 3)


def test_a_service_without_rows_leaves_the_day(book, catalogue):
    services(book, catalogue, 2)
    for region in ("r1", "r2"):
        catalogue.offer("S1", region, "v2", docs.SHELL)
    load(book, catalogue, DAY1 + timedelta(days=1))
    assert set(book.parts(date(2025, 5, 2))) == {"S0"} and len(live(book)) == 2


def test_services_with_odd_names(spark, book):
    names = ["it's", "a\\b", "a=b/c d", "100%", "é"]
    day = date(2025, 5, 1)
    book.provision()
    rows = docs.history_rows(spark, day, [(n, "r1") for n in names])
    book.commit(days={day: book.write_rows(rows, day)}, live=day)
    assert {s for s, _ in live_pairs(book)} == set(names) == set(book.parts(day))
    again = reopened(spark, book)
    again.provision()
    assert {s for s, _ in live_pairs(again)} == set(names)


def live_pairs(book):
    return [tuple(r) for r in book.read_live().select("service_code", "region_code").collect()]


# --- appended rows ----------------------------------------------------------


def test_append_reads_no_old_row(spark, book, monkeypatch):
    day = date(2025, 5, 1)
    book.provision()
    book.publish({day: book.write_rows(docs.history_rows(spark, day, [("A", "r1"), ("B", "r1")]), day)})
    before = book.parts(day)
    with monkeypatch.context() as blind:
        blind.setattr(PriceBook, "read_history", None)
        blind.setattr(PriceBook, "read_live", None)
        book.append(docs.history_rows(spark, day, [("A", "r2")] * 3), day)
    after = book.parts(day)
    assert after["B"] == before["B"] and after["A"][0] == before["A"][0] and len(after["A"]) == 2
    assert day_rows(book, day) == 5
    # a day carried from it puts a service's rows together again
    later = date(2025, 5, 2)
    book.publish({later: book.compose_day(day, later)})
    assert day_rows(book, later) == 5 and len(book.parts(later)["A"]) == 1
    assert book.parts(later)["B"] == before["B"]


def test_live_follows_appended_rows_when_turned(spark, book):
    day = date(2025, 5, 1)
    book.provision()
    rows = docs.history_rows(spark, day, [("A", "r1")])
    book.commit(days={day: book.write_rows(rows, day)}, live=day)
    book.append(rows, day)
    assert book.read_live().count() == 1 and day_rows(book, day) == 2
    book.swap_live(day)
    assert book.read_live().count() == 2
    again = reopened(spark, book)
    again.provision()
    assert again.read_live().count() == 2 and day_rows(again, day) == 2


def test_appended_rows_are_checked(spark, book):
    day = date(2025, 5, 1)
    book.provision()
    rows = docs.history_rows(spark, day, [("A", "r1")])
    with pytest.raises(ValueError):
        book.append(rows, day)
    book.publish({day: {}})
    with pytest.raises(Exception, match="a row is not dated"):
        book.append(docs.history_rows(spark, date(2025, 5, 2), [("A", "r1")]), day)
    with pytest.raises(Exception, match="required column sku is NULL"):
        book.append(rows.withColumn("sku", F.lit(None).cast("string")), day)
    assert day_rows(book, day) == 0


# --- SQL --------------------------------------------------------------------


def test_sql_needs_dates(spark, book):
    days = [date(2025, 5, d) for d in (1, 2, 3)]
    book.provision()
    for day in days:
        rows = docs.history_rows(spark, day, [("A", "r1"), ("B", "r1")])
        book.publish({day: book.write_rows(rows, day)})
    spark.sql(f"USE `{book.database}`")
    try:
        for text in ("history", "history()", "history(DATE '2025-05-01')"):
            with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND|WRONG_NUM_ARGS|REQUIRED"):
                spark.sql(f"SELECT * FROM {text}")
        found = spark.sql(
            "SELECT * FROM history(DATE '2025-05-02', DATE '2025-05-03') WHERE service_code = 'A'"
        )
        assert found.columns == book.read_history(on=days[0]).columns
        assert found.count() == 2
        paths = found.inputFiles()
        kept = [book.parts(d)["A"][0].rpartition("/data/")[2] for d in days]
        assert all(any(k in p for k in kept[1:]) for p in paths)
        assert not any(kept[0] in p for p in paths)
        # a day published again: the function serves the new rows alone
        book.publish({days[2]: book.write_rows(docs.history_rows(spark, days[2], [("A", "r1")] * 4), days[2])})
        assert spark.sql("SELECT * FROM history(DATE '2025-05-01', DATE '2025-05-03')").count() == 8
    finally:
        spark.sql("USE default")


def test_readers_see_one_publish(spark, book):
    """The folders of a publish are partitions before anybody reads them."""
    day = date(2025, 5, 1)
    book.provision()
    book.commit(days={day: book.write_rows(docs.history_rows(spark, day, [("A", "r1"), ("B", "r1")]), day)}, live=day)
    seen = []
    serve = book._serve

    def watched(names):
        seen.append((book.spark.table(book.name("live")).count(), names))
        serve(names)

    book._serve = watched
    rows = docs.history_rows(spark, day, [("A", "r1")] * 5)
    book.commit(days={day: book.write_rows(rows, day)}, live=day)
    assert seen == [(2, {"history", "live"})]
    assert book.read_live().count() == day_rows(book, day) == 5


# --- buckets ----------------------------------------------------------------


def test_a_load_opens_the_buckets_of_its_targets(spark, book, tmp_path):
    catalogue = docs.Catalogue(tmp_path / "bucketed", buckets=32)
    for k in range(40):
        catalogue.offer(f"S{k}", "r1", "v1", docs.priced(k + 1))
    assert counts(load(book, catalogue, DAY1)) == (40, 40, 0)
    catalogue.offer("S7", "r1", "v2", docs.priced(70))
    landing = catalogue.landing()
    # beyond the limit of broadcasts, where no join prunes
    one = written_keys(
        spark.createDataFrame(
            [("S7", "r1", "service", "v2", docs.url("S7", "r1", "v2"))],
            "service_code string, region_code string, offer_type string, version string, "
            "offer_url string",
        ),
        str(tmp_path / "one"),
        limit=0,
    ).frame
    (folder,) = landing.folders(landing.service_offers, one)
    read = offers.read_service_offers(
        spark, landing.service_offers, layout="file", folders=[folder]
    )
    listed = {p.rpartition("/offer_url=")[0].rpartition("/")[2] for p in read.inputFiles()}
    assert listed == {folder.rpartition("/")[2]}
    assert counts(load(book, catalogue, DAY1 + timedelta(days=1))) == (1, 1, 39)
    assert live(book)["S7", "r1"] == (1, 70) and len(live(book)) == 40
    catalogue.offer("S8", "r1", "v2", None)
    with pytest.raises(LoadRefused, match="not landed"):
        load(book, catalogue, DAY1 + timedelta(days=2))


# --- one writer -------------------------------------------------------------


def test_a_second_load_is_refused(spark, book, catalogue, monkeypatch):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    other = PriceBook(spark.newSession(), f"t_{uuid4().hex}", book.location)
    refused = []
    commit = PriceBook.commit

    def meanwhile(self, **published):
        with pytest.raises(Busy):
            load(other, catalogue, DAY1)
        refused.append(True)
        commit(self, **published)

    with monkeypatch.context() as both:
        both.setattr(PriceBook, "commit", meanwhile)
        load(book, catalogue, DAY1)
    assert refused and live(book) == {("A", "r1"): (1, 1)}
    # ended: the other session may load, and knows what is loaded
    assert counts(load(other, catalogue, DAY1 + timedelta(hours=1))) == (0, 0, 1)


def test_a_dead_load_is_taken_over(spark, book, catalogue, monkeypatch):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    with writing(book.files, book.location) as dead:
        with pytest.raises(Busy):
            load(book, catalogue, DAY1)
        assert counts(load(book, catalogue, DAY1, lease=0.0)) == (1, 1, 0)
        # it was alive after all: it must not publish
        with pytest.raises(TakenOver):
            dead.require_own()
    assert live(book) == {("A", "r1"): (1, 1)}
    assert counts(load(book, catalogue, DAY1 + timedelta(hours=1))) == (0, 0, 1)


def test_a_taken_over_load_publishes_nothing(book, catalogue, monkeypatch):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    write = PriceBook.write_rows

    def slow(self, rows, day):
        files, folder = self.files, f"{self.location}/writers"
        files.create(f"{folder}/{int(files.names(folder)[-1]) + 1:09}")
        return write(self, rows, day)

    with monkeypatch.context() as late:
        late.setattr(PriceBook, "write_rows", slow)
        with pytest.raises(TakenOver):
            load(book, catalogue, DAY1)
    assert book.partition_dates() == [] and last_run(book).status == "failed"


def test_work_of_a_load_is_removed(book, catalogue):
    catalogue.offer("A", "r1", "v1", docs.priced(1))
    load(book, catalogue, DAY1)
    catalogue.offer("A", "r1", "v2", docs.priced("not a price"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load(book, catalogue, DAY1 + timedelta(days=1))
    assert book.files.names(f"{book.location}/data/work") == []


def test_rows_are_written_small(spark, book, catalogue, monkeypatch):
    """Twice, with the denser codec; what is staged in row groups that tasks can share."""
    monkeypatch.setattr("ratebook.plans.load.DEALT_BYTES", 1 << 14)
    monkeypatch.setattr(book.files, "remove", lambda path: None)
    catalogue.offer("A", "r1", "v1", docs.priced(1, n=5000))
    assert counts(load(book, catalogue, DAY1)) == (5000, 1, 0)
    for kind in ("work/*/fresh", "history/*/service_code=A"):
        files = list(Path(book.location).glob(f"data/{kind}/*.parquet"))
        found = [pq.ParquetFile(f).metadata for f in files]
        assert sum(m.num_rows for m in found) == 5000
        groups = [m.row_group(k) for m in found for k in range(m.num_row_groups)]
        assert {g.column(0).compression for g in groups} == {"ZSTD"}
        if "fresh" in kind:
            assert max(g.num_rows for g in groups) <= 2500


def test_mandatory_parameters(spark, book, catalogue):
    landing = catalogue.landing()
    landing.service_offers = ""
    with pytest.raises(ValueError):
        run_load(book, landing)
    with pytest.raises(ValueError):
        PriceBook(spark, "", "/x")
