"""The incremental load: discover, diff, flatten, compose, upsert, swap, audit."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.operators import audit, diff, flatten, guards, upsert
from ratebook.operators.discover import discover_rejects, discover_targets
from ratebook.operators.keys import written_keys
from ratebook.plans.writer import LEASE, writing
from ratebook.scratch import written
from ratebook.session import DEALT_BYTES, sized_shuffles
from ratebook.sources import offers
from ratebook.sources.book import CODEC, PriceBook

log = logging.getLogger(__name__)


@dataclass
class LoadResult:
    run_id: str
    run_date: date
    rows_loaded: int
    services_changed: int
    services_skipped: int
    elapsed_s: float


@dataclass
class Landing:
    """Where the documents were put, and the host their relative urls belong to."""

    master_index: str
    region_indexes: str
    service_offers: str
    plan_offers: str
    base_url: str
    layout: str = "lines"
    #: Buckets that the documents' folders are dealt to; 0 if there is no such level.
    buckets: int = 0

    def folders(self, root: str, targets: DataFrame) -> list[str]:
        return offers.bucket_folders(root, targets, self.buckets)


def fresh_rows(
    spark: SparkSession,
    landing: Landing,
    changed: DataFrame,
    *,
    run_date: date,
    ingested_at: datetime,
    include_plans: bool,
    include_reserved: bool,
) -> DataFrame:
    """History rows of the changed documents; the others are never opened."""
    services = changed.where(F.col("offer_type") == "service")
    documents = offers.of_targets(
        offers.read_service_offers(
            spark,
            landing.service_offers,
            layout=landing.layout,
            include_reserved=include_reserved,
            folders=landing.folders(landing.service_offers, services),
        ),
        services,
    )
    stamp = {"run_date": run_date, "ingested_at": ingested_at}
    if not include_plans:
        return flatten.flatten_service_offers(
            documents, include_reserved=include_reserved, **stamp
        )
    plan_targets = changed.where(F.col("offer_type") == "savings_plan")
    plans = offers.of_targets(
        offers.read_plan_offers(
            spark,
            landing.plan_offers,
            layout=landing.layout,
            folders=landing.folders(landing.plan_offers, plan_targets),
        ),
        plan_targets,
    )
    return flatten.flatten_all_offers(
        documents, plans, include_reserved=include_reserved, **stamp
    )


def run_load(
    book: PriceBook,
    landing: Landing,
    *,
    now: datetime | None = None,
    service_filter: str = "",
    include_plans: bool = True,
    include_reserved: bool = True,
    force: bool = False,
    lease: float = LEASE,
) -> LoadResult:
    """One load.  The day, the versions and live move in one commit, so a run that failed
    anywhere has either changed nothing or is finished by the next one.

    A second load of the same book is refused until this one has ended, or `lease` seconds
    after it began.
    """
    if not landing.service_offers or not landing.master_index:
        raise ValueError("a load needs a landing directory")
    spark = book.spark
    started = time.monotonic()
    now = now or datetime.now(timezone.utc)
    run_id, run_date = uuid4().hex, now.astimezone(timezone.utc).date()
    with writing(book.files, book.location, lease) as writer:
        book.provision()
        book.record(audit.start_run(spark, run_id, now, service_filter, run_date))
        work = book.folder("work")
        try:
            loaded, changed, skipped = _load(
                book,
                landing,
                writer,
                work,
                run_id=run_id,
                run_date=run_date,
                now=now,
                service_filter=service_filter,
                include_plans=include_plans,
                include_reserved=include_reserved,
                force=force,
            )
            book.record(audit.finish_run(spark, run_id, loaded, changed, skipped))
        except Exception as failure:
            log.exception("load %s failed", run_id)
            try:
                book.record(audit.fail_run(spark, run_id, str(failure)))
            except Exception:
                log.exception("load %s: its failure could not be recorded", run_id)
            raise
        finally:
            book.files.remove(work)
    return LoadResult(
        run_id, run_date, loaded, changed, skipped, time.monotonic() - started
    )


def _load(
    book,
    landing,
    writer,
    work,
    *,
    run_id,
    run_date,
    now,
    service_filter,
    include_plans,
    include_reserved,
    force,
) -> tuple[int, int, int]:
    spark = book.spark
    targets, n_targets = written_keys(
        discover_targets(
            spark,
            landing.master_index,
            landing.region_indexes,
            base_url=landing.base_url,
            service_filter=service_filter,
            include_plans=include_plans,
        ),
        f"{work}/targets",
    )
    guards.require_targets(n_targets)

    rejects = written(
        discover_rejects(
            spark,
            landing.master_index,
            landing.region_indexes,
            service_filter=service_filter,
            include_plans=include_plans,
        ).withColumn("run_id", F.lit(run_id)),
        f"{work}/rejects",
    )
    book.reject(rejects)
    n_rejects = rejects.count()
    if n_rejects:
        log.warning("load %s: %d services have no usable index", run_id, n_rejects)

    known = diff.known_versions(book.read_versions())
    if force:
        known = diff.no_known_versions(book.read_versions())
    changed, n_changed = written_keys(diff.changed(targets, known), f"{work}/changed")
    n_skipped = n_targets - n_changed

    days = book.partition_dates()
    today = run_date in days and not book.read_history(on=run_date).isEmpty()
    previous = book.latest_previous_partition(run_date, days)
    if guards.is_noop(n_changed > 0, today, force):
        return 0, 0, n_skipped

    base = run_date if today else previous
    if not n_changed:
        # A new day without changes is the previous day's content as it stands: the
        # date is not part of a folder, so both days can share them.
        guards.require_some_data(0, today, previous is not None)
        parts = book.compose_day(base, run_date)
        writer.require_own()
        book.commit(days={run_date: parts}, live=run_date)
        return 0, 0, n_skipped

    kinds = {"service": landing.service_offers}
    if include_plans:
        kinds["savings_plan"] = landing.plan_offers
    to_read = 0
    for kind, root in kinds.items():
        wanted = changed.where(F.col("offer_type") == kind)
        landed = offers.landed_documents(spark, root, landing.folders(root, wanted))
        to_read += guards.require_landed(wanted, landed)

    # The fresh rows are written once; what was loaded is counted from those files, and the
    # changed services are put in order from them and the carried rows, without flattening
    # again.
    fresh = fresh_rows(
        spark,
        landing,
        changed,
        run_date=run_date,
        ingested_at=now,
        include_plans=include_plans,
        include_reserved=include_reserved,
    )
    pairs = diff.changed_pairs(changed)
    with sized_shuffles(spark, to_read):
        # In row groups that tasks can share, however many rows a file gets.
        groups = {"parquet.block.size": str(DEALT_BYTES)}
        fresh = written(fresh, f"{work}/fresh", compression=CODEC, **groups)
        summary = written(
            fresh.groupBy(
                *schemas.TARGET_KEY, "publication_date", "ingested_at", "source_url"
            ).agg(F.count(F.lit(1)).alias("rows_loaded")),
            f"{work}/summary",
        )
        n_rows = summary.agg(F.coalesce(F.sum("rows_loaded"), F.lit(0))).first()[0]
        guards.require_some_data(n_rows, today, previous is not None)
        parts = book.compose_day(base, run_date, fresh, pairs)
    merged = upsert.merge_versions(
        book.read_versions(), upsert.versions_from_history(summary)
    )
    empty = flatten.empty_targets(changed, summary)
    versions = book.write_versions(
        upsert.upsert_empty_targets(merged, empty, F.lit(now).cast("timestamp"))
    )
    writer.require_own()
    book.commit(days={run_date: parts}, versions=versions, live=run_date)
    return n_rows, n_changed, n_skipped
