"""Run audit: events are appended, the state of a run is derived from them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.functions import exprs as X

STARTED, ENDED = 0, 1


def _event(source: DataFrame, seq: int, values: dict[str, Column]) -> DataFrame:
    columns = values | {"event_seq": F.lit(seq)}
    return source.select(
        *[
            columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.RUN_EVENTS
        ]
    )


def start_events(
    source: DataFrame,
    *,
    run_id: Column,
    started_at: Column,
    service_filter: Column,
    ingestion_date: Column,
) -> DataFrame:
    return _event(
        source,
        STARTED,
        {
            "run_id": run_id,
            "started_at": started_at,
            "status": F.lit("running"),
            "service_filter": service_filter,
            "ingestion_date": ingestion_date,
        },
    )


def finish_events(
    source: DataFrame,
    *,
    run_id: Column,
    finished_at: Column,
    rows_loaded: Column,
    services_changed: Column,
    services_skipped: Column,
) -> DataFrame:
    return _event(
        source,
        ENDED,
        {
            "run_id": run_id,
            "finished_at": finished_at,
            "status": F.lit("succeeded"),
            "rows_loaded": rows_loaded,
            "services_changed": services_changed,
            "services_skipped": services_skipped,
        },
    )


def fail_events(
    source: DataFrame, *, run_id: Column, finished_at: Column, error: Column
) -> DataFrame:
    return _event(
        source,
        ENDED,
        {
            "run_id": run_id,
            "finished_at": finished_at,
            "status": F.lit("failed"),
            "error": X.error_text(error),
        },
    )


def run_states(events: DataFrame) -> DataFrame:
    """Current row of every started run: per column the latest value that was set."""

    def latest(name: str) -> Column:
        order = F.when(
            F.col(name).isNotNull(), F.struct("event_seq", "finished_at")
        )
        return F.max_by(F.col(name), order).alias(name)

    names = [n for n in schemas.RUNS.names if n != "run_id"]
    return (
        events.groupBy("run_id")
        .agg(*[latest(n) for n in names], F.min("event_seq").alias("first_event"))
        .where(F.col("first_event") == STARTED)
        .select(*schemas.RUNS.names)
    )


def list_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    return runs.orderBy(F.desc("started_at")).limit(limit)


def get_run(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.where(F.col("run_id") == run_id).limit(1)


def shown_counts(runs: DataFrame) -> DataFrame:
    """Missing counters are shown as 0."""
    counters = ("rows_loaded", "services_changed", "services_skipped")
    return runs.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counters})


def start_run(
    spark, run_id: str, started_at: datetime, service_filter: str, run_date: date
) -> DataFrame:
    return start_events(
        spark.range(1),
        run_id=F.lit(run_id),
        started_at=F.lit(started_at),
        service_filter=F.lit(service_filter),
        ingestion_date=F.lit(run_date),
    )


def finish_run(
    spark, run_id: str, rows_loaded: int, changed: int, skipped: int
) -> DataFrame:
    return finish_events(
        spark.range(1),
        run_id=F.lit(run_id),
        finished_at=F.current_timestamp(),
        rows_loaded=F.lit(rows_loaded),
        services_changed=F.lit(changed),
        services_skipped=F.lit(skipped),
    )


def fail_run(spark, run_id: str, error: str) -> DataFrame:
    return fail_events(
        spark.range(1),
        run_id=F.lit(run_id),
        finished_at=F.current_timestamp(),
        error=F.lit(error),
    )
