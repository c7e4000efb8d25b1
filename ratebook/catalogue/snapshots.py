"""History, live and versions tables built from events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.catalogue import adapters as A
from ratebook.catalogue import sql as S
from ratebook.catalogue.registry import (
    day,
    query,
    shown_live,
    shown_snapshot,
    shown_versions,
)
from ratebook.operators import compose, upsert
from ratebook.plans import consumer
from ratebook.scratch import new_folder

_HIST = f"WITH {S.HISTORY}"
_CHANGED = f"WITH {S.HISTORY}, {S.CHANGED_PAIRS}"
_REST = S.SNAPSHOT.removeprefix("ingestion_date, ")


def last_days(spark, sf_dir):
    """The shared book, its newest day and the day before."""
    book = A.history_book(spark, sf_dir)
    newest, before = book.partition_dates()[:2]
    return book, newest, before


def all_days(spark, sf_dir):
    book = A.history_book(spark, sf_dir)
    dates = book.partition_dates()
    return book.read_history(between=(dates[-1], dates[0]))


# --- scans ------------------------------------------------------------------


@query(f"{_HIST} SELECT {S.SNAPSHOT} FROM hist WHERE ingestion_date = {S.LAST}")
def history_partition_scan(spark, sf_dir):
    book, newest, _ = last_days(spark, sf_dir)
    return shown_snapshot(book.read_history(on=newest))


@query(f"{_HIST} SELECT {S.LIVE} FROM hist WHERE ingestion_date = {S.LAST}")
def live_scan(spark, sf_dir):
    return shown_live(A.history_book(spark, sf_dir).read_live())


@query(f"{_HIST} SELECT {S.LIVE} FROM hist WHERE ingestion_date = {S.BEFORE_LAST}")
def live_projection(spark, sf_dir):
    book, _, before = last_days(spark, sf_dir)
    return shown_live(book.read_history(on=before).drop("ingestion_date"))


@query(f"{_HIST} SELECT max(ingestion_date) AS previous FROM hist WHERE ingestion_date < {S.LAST}")
def latest_previous_partition(spark, sf_dir):
    book, newest, _ = last_days(spark, sf_dir)
    previous = book.latest_previous_partition(newest)
    rows = book.read_history(on=previous).limit(1)
    return rows.select(day("ingestion_date").alias("previous"))


@query(
    f"""{_HIST} SELECT ingestion_date, count(*) AS rows, count(*) > 0 AS has_data
    FROM hist WHERE ingestion_date = {S.LAST} GROUP BY 1"""
)
def partition_has_data(spark, sf_dir):
    book, newest, _ = last_days(spark, sf_dir)
    return book.read_history(on=newest).agg(
        F.lit(str(newest)).alias("ingestion_date"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(book.partition_has_data(newest)).alias("has_data"),
    )


# --- changed pairs ----------------------------------------------------------


@query(
    f"""{_CHANGED} SELECT {S.SNAPSHOT} FROM hist
    WHERE ingestion_date = {S.BEFORE_LAST} AND {S.IN_CHANGED}"""
)
def pairs_in_changed(spark, sf_dir):
    book, _, before = last_days(spark, sf_dir)
    pairs = A.changed_pairs(spark, sf_dir)
    return shown_snapshot(compose.pairs_in_changed(book.read_history(on=before), pairs))


@query(
    f"""{_CHANGED} SELECT strftime({S.LAST}::DATE + 1, '%Y-%m-%d') AS ingestion_date, {_REST}
    FROM hist WHERE ingestion_date = {S.LAST} AND NOT {S.IN_CHANGED}"""
)
def carry_forward(spark, sf_dir):
    book, newest, _ = last_days(spark, sf_dir)
    pairs = A.changed_pairs(spark, sf_dir)
    carried = compose.carry_forward(
        book.read_history(on=newest), pairs, newest + timedelta(days=1)
    )
    return shown_snapshot(carried)


# --- composing a day --------------------------------------------------------

_FRESH = _REST.replace("price_per_unit", "price_per_unit + 1 AS price_per_unit")
_FRESH_ROWS = f"FROM hist WHERE {S.CHANGED_REGION} AND term_type = 'OnDemand'"


def with_days(spark, sf_dir, name, *days):
    """A book of its own that holds days of the shared one, in the same folders."""
    shared = A.history_book(spark, sf_dir)
    book = A.new_book(spark, name)
    book.publish({d: shared.compose_day(d, d) for d in days})
    return book


def composed(spark, sf_dir, base, run_date, source_day):
    """Compose and publish a day after `base`; the day as read back."""
    fresh = A.fresh_rows(spark, sf_dir, source_day, run_date)
    book = with_days(spark, sf_dir, "composed", *([base] if base else []))
    pairs = A.changed_pairs(spark, sf_dir)
    book.publish({run_date: book.compose_day(base, run_date, fresh, pairs)})
    return book.read_history(on=run_date)


@query(
    f"""{_CHANGED}
    SELECT strftime({S.LAST}::DATE + 1, '%Y-%m-%d') AS ingestion_date, {_REST}
    FROM hist WHERE ingestion_date = {S.LAST} AND NOT {S.IN_CHANGED}
    UNION ALL
    SELECT strftime({S.LAST}::DATE + 1, '%Y-%m-%d'), {_FRESH}
    {_FRESH_ROWS} AND ingestion_date = {S.LAST}"""
)
def compose_new_day(spark, sf_dir):
    _, newest, _ = last_days(spark, sf_dir)
    run_date = newest + timedelta(days=1)
    return shown_snapshot(composed(spark, sf_dir, newest, run_date, newest))


@query(
    f"""{_CHANGED}
    SELECT {S.SNAPSHOT} FROM hist WHERE ingestion_date = {S.LAST} AND NOT {S.IN_CHANGED}
    UNION ALL
    SELECT ingestion_date, {_FRESH} {_FRESH_ROWS} AND ingestion_date = {S.LAST}"""
)
def compose_same_day(spark, sf_dir):
    _, newest, _ = last_days(spark, sf_dir)
    return shown_snapshot(composed(spark, sf_dir, newest, newest, newest))


@query(
    f"""{_HIST} SELECT ingestion_date, {_FRESH} {_FRESH_ROWS}
    AND ingestion_date = {S.LAST}"""
)
def compose_first_run(spark, sf_dir):
    _, newest, _ = last_days(spark, sf_dir)
    return shown_snapshot(composed(spark, sf_dir, None, newest, newest))


@query(
    f"""{_HIST} SELECT {S.SNAPSHOT} FROM hist WHERE ingestion_date = {S.LAST}
    UNION ALL
    SELECT {S.LAST}, {_FRESH} {_FRESH_ROWS} AND ingestion_date = {S.BEFORE_LAST}"""
)
def history_append(spark, sf_dir):
    """Nothing is read or replaced: the new rows stand beside the partition's."""
    _, newest, before = last_days(spark, sf_dir)
    book = with_days(spark, sf_dir, "appended", newest)
    book.append(A.fresh_rows(spark, sf_dir, before, newest), newest)
    return shown_snapshot(book.read_history(on=newest))


@query(f"{_HIST} SELECT {S.LIVE} FROM hist WHERE ingestion_date = {S.LAST}")
def swap_live(spark, sf_dir):
    """Live served the day before, then the last one."""
    _, newest, before = last_days(spark, sf_dir)
    book = with_days(spark, sf_dir, "swap", before, newest)
    book.swap_live(before)
    book.swap_live(newest)
    return shown_live(book.read_live())


@query(f"{_HIST} SELECT {S.SNAPSHOT} FROM hist")
def clustered_write_roundtrip(spark, sf_dir):
    path = new_folder(spark, "clustered")
    compose.clustered(all_days(spark, sf_dir)).write.parquet(path)
    return shown_snapshot(spark.read.schema(schemas.HISTORY).parquet(path))


# --- versions ---------------------------------------------------------------

_OLD = f"old AS ({S.VERSION_OF} FROM hist WHERE ingestion_date = {S.BEFORE_LAST} GROUP BY ALL)"
_NEW = f"""new AS ({S.VERSION_OF} FROM hist
  WHERE ingestion_date = {S.LAST} AND {S.IN_CHANGED} GROUP BY ALL)"""


def _versions(spark, sf_dir):
    """Versions of the day before, and those of the last day's changed pairs."""
    book, newest, before = last_days(spark, sf_dir)
    loaded = compose.pairs_in_changed(
        book.read_history(on=newest), A.changed_pairs(spark, sf_dir)
    )
    old = upsert.versions_from_history(book.read_history(on=before))
    return old, upsert.versions_from_history(loaded)


@query(f"{_CHANGED}, {_NEW} SELECT * FROM new")
def versions_from_history(spark, sf_dir):
    return shown_versions(_versions(spark, sf_dir)[1])


@query(
    f"""{_CHANGED}, {_OLD}, {_NEW}
    SELECT * FROM old WHERE (service_code, region_code, offer_type) NOT IN
      (SELECT (service_code, region_code, offer_type) FROM new)
    UNION ALL SELECT * FROM new"""
)
def merge_versions(spark, sf_dir):
    book = A.new_book(spark, "versions")
    old, new = _versions(spark, sf_dir)
    book.replace_versions(old)
    book.replace_versions(upsert.merge_versions(book.read_versions(), new))
    return shown_versions(book.read_versions())


_SHELLS = f"""shells AS (
  SELECT DISTINCT service_code, region_code, offer_type FROM hist
  WHERE ingestion_date = {S.LAST} AND {S.CHANGED_REGION}
  UNION ALL
  SELECT DISTINCT service_code, 'region-new', offer_type FROM hist
  WHERE ingestion_date = {S.LAST})"""


@query(
    f"""{_HIST}, {_OLD}, {_SHELLS}
    SELECT coalesce(o.service_code, s.service_code) AS service_code,
      coalesce(o.region_code, s.region_code) AS region_code,
      coalesce(o.offer_type, s.offer_type) AS offer_type,
      CASE WHEN s.service_code IS NULL THEN o.version ELSE 'shell' END AS version,
      o.publication_date,
      CASE WHEN s.service_code IS NULL THEN o.loaded_at
        ELSE '2024-02-01 06:30:00' END AS loaded_at,
      CASE WHEN s.service_code IS NULL THEN o.source_url
        ELSE 'url of ' || s.service_code END AS source_url
    FROM old o FULL JOIN shells s ON o.service_code = s.service_code
      AND o.region_code = s.region_code AND o.offer_type = s.offer_type"""
)
def upsert_empty_targets(spark, sf_dir):
    book, newest, _ = last_days(spark, sf_dir)
    rows = book.read_history(on=newest)
    keys = rows.where(F.col("region_code").isin(*A.CHANGED_REGIONS)).select(
        *schemas.VERSION_KEY
    ).unionByName(
        rows.select("service_code", F.lit("region-new").alias("region_code"), "offer_type")
    )
    shells = keys.distinct().select(
        "*",
        F.lit("shell").alias("version"),
        F.concat(F.lit("url of "), "service_code").alias("offer_url"),
    )
    old = _versions(spark, sf_dir)[0]
    merged = upsert.upsert_empty_targets(old, shells, F.lit(A.NOW).cast("timestamp"))
    return shown_versions(merged)


# --- consumer queries -------------------------------------------------------


@query(
    f"""{_HIST} SELECT service_code, region_code, count(*) AS rows FROM hist
    WHERE ingestion_date = {S.LAST} GROUP BY 1, 2
    ORDER BY rows DESC, service_code, region_code LIMIT 10"""
)
def rows_by_service_region(spark, sf_dir):
    return consumer.rows_by_service_region(A.history_book(spark, sf_dir).read_live())


@query(
    f"""{_HIST} SELECT region_code, k, price_per_unit FROM hist
    WHERE ingestion_date = {S.LAST} AND service_code = 'view'
      AND term_type = 'OnDemand' AND region_code = 'region-1'
    ORDER BY k, price_per_unit LIMIT 20"""
)
def json_column_sample(spark, sf_dir):
    sample = consumer.json_column_sample(
        A.history_book(spark, sf_dir).read_live(),
        "view",
        "region-1",
        {"k": "k"},
        order_by=("k", "price_per_unit"),
    )
    return sample.withColumn("price_per_unit", F.col("price_per_unit").cast("double"))


@query(
    f"""WITH {S.HISTORY.replace(" FROM events", ", user_id FROM events")}
    SELECT ingestion_date, region_code, price_per_unit FROM hist
    WHERE ingestion_date BETWEEN '2024-01-05' AND '2024-01-20' AND service_code = 'click'
      AND user_id % 4 = 1 AND region_code = 'region-3' AND term_type = 'OnDemand'
    ORDER BY ingestion_date"""
)
def price_over_time(spark, sf_dir):
    prices = consumer.price_over_time(
        A.history_book(spark, sf_dir),
        A.date(2024, 1, 5),
        A.date(2024, 1, 20),
        "click",
        "region-3",
        {"class": "c1"},
    )
    return prices.select(
        day("ingestion_date"),
        "region_code",
        F.col("price_per_unit").cast("double").alias("price_per_unit"),
    )
