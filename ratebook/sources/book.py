"""The price book: history, versions, runs and live as external parquet tables.

Rows are kept by service: a folder holds the rows that one load wrote of one service, in order,
and never changes.  A day is a list of folders, one a service, so a day on which one service
changed writes that service and lists the folders of the day before for the others.  Rows added
to a published day are a load of their own beside it.

What a book serves is said by its pointers, a small append-only table below the book's own
location: (load number, kind, day, service) -> folder.  A publish appends all of its pointers as
one file, which is the only commit.  The catalog follows: the load's folders become partitions
that nobody reads yet, then one statement for each of `history`, `versions` and `live` turns it
to the loads it serves, so a reader has one publish or the other, never a part of one, and a
query planned before still finds its files.  Any session that opens the location attaches what
the pointers say, so nothing depends on the catalog that wrote them, and a publish that died
between its commit and the catalog is finished by whoever opens the book next.

SQL reaches history as a table function that asks for its dates:

    USE prices;
    SELECT * FROM history(DATE '2025-05-01', DATE '2025-05-31') WHERE service_code = 'A'
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratebook import schemas
from ratebook.operators import audit, compose
from ratebook.operators.guards import require_columns, require_day
from ratebook.session import narrow_splits
from ratebook.sources.files import Files

#: Folders that one statement adds.
_ADDED = 1000
#: Parquet keeps bloom filters of the columns that single rows are looked up by.
_LOOKED_UP = ("sku", "rate_code")
#: Of history rows, which are written twice by a load: some 0.6 of what Spark's own takes.
CODEC = "zstd"

#: Folders of a day, by service.
Parts = dict[str, str]


class UnknownContent(RuntimeError):
    """The location holds data that no pointer knows."""


@dataclass
class _State:
    """What the pointers say."""

    number: int = 0
    #: The loads that make up each day, the replacing one first.
    days: dict[date, list[int]] = field(default_factory=dict)
    #: What live serves: a day, and the loads it had when live was turned to it.
    live: tuple[date, tuple[int, ...]] | None = None
    versions: int | None = None


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class PriceBook:
    def __init__(self, spark: SparkSession, database: str, location: str):
        if not database or not location:
            raise ValueError("a price book needs a database and a location")
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")
        self.files = Files(spark)
        self._known: _State | None = None
        #: Pointers of parts by load, as far as they were asked for.
        self._folders: dict[int, list[tuple[str, date, str, str]]] = {}

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def folder(self, kind: str) -> str:
        return f"{self.location}/data/{kind}/{uuid4().hex}"

    # --- provisioning -------------------------------------------------------

    def _create(self, table: str, schema: T.StructType, more: str = "") -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}) "
            f"USING parquet {more} LOCATION '{self.location}/{table}'"
        )

    def provision(self) -> None:
        """Database and tables, holding what the location's pointers say; the first
        publish creates live."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
            f"LOCATION '{self.location}/database'"
        )
        self._create(
            "history_parts",
            T.StructType([*schemas.PART.fields, *schemas.PART_OF.fields]),
            "PARTITIONED BY (ingestion_date, load, service_code)",
        )
        self._create(
            "versions_parts",
            T.StructType([*schemas.VERSIONS.fields, schemas.PART_OF["load"]]),
            "PARTITIONED BY (load)",
        )
        self._create("runs", schemas.RUN_EVENTS)
        self._create("rejects", schemas.REJECTS)
        self._create("pointers", schemas.POINTERS)
        self._known = None
        if not self._state.number and not self.files.exists(f"{self.location}/opened"):
            if self.files.exists(f"{self.location}/data"):
                raise UnknownContent(
                    f"{self.location} holds data but no pointers; a new book needs an empty folder"
                )
            self.files.create(f"{self.location}/opened")
        self._attach()

    # --- pointers -----------------------------------------------------------

    @property
    def _state(self) -> _State:
        """Read once a session, and again whenever the book is opened."""
        if self._known is None:
            rows = []
            if self.files.names(f"{self.location}/pointers"):
                pointers = self.spark.table(self.name("pointers"))
                rows = pointers.select("number", "kind", "day").distinct().collect()
            state = _State()
            for r in sorted(rows, key=lambda r: (r.number, r.kind)):
                self._follow(state, r.number, r.kind, r.day)
            self._known = state
        return self._known

    @staticmethod
    def _follow(state: _State, number: int, kind: str, day: date | None) -> None:
        state.number = max(state.number, number)
        if kind == "history":
            state.days[day] = [number]
        elif kind == "append":
            state.days.setdefault(day, []).append(number)
        elif kind == "versions":
            state.versions = number
        elif kind == "live":
            state.live = (day, tuple(state.days[day]))

    def _append_pointers(self, moved: list[tuple[str, date | None, str | None, str]]) -> int:
        """One file: all pointers of a publish appear at once.  One load at a time writes to a
        book (see `plans.writer`), so the number is this load's own."""
        state = self._state
        number = state.number + 1
        rows = ", ".join(
            f"({number}L, {_text(kind)}, {f"DATE '{day}'" if day else 'NULL'}, "
            f"{_text(service) if service is not None else 'NULL'}, {_text(folder)})"
            for kind, day, service, folder in moved
        )
        self.spark.sql(
            f"INSERT INTO {self.name('pointers')} SELECT /*+ COALESCE(1) */ * FROM VALUES {rows}"
        )
        self._folders[number] = [m for m in moved if m[2] is not None]
        # live follows the days of its own publish
        for kind, day in dict.fromkeys((m[0], m[1]) for m in sorted(moved, key=lambda m: m[0])):
            self._follow(state, number, kind, day)
        return number

    def _attach(self) -> None:
        """Have the catalog follow the pointers: folders first, then what is served."""
        state = self._state
        wanted = {n for loads in state.days.values() for n in loads}
        wanted |= set(state.live[1] if state.live else ())
        attached = self.spark.sql(f"SHOW PARTITIONS {self.name('history_parts')}").collect()
        wanted -= {int(r[0].split("/")[1].removeprefix("load=")) for r in attached}
        if wanted or state.versions:
            pointers = self.spark.table(self.name("pointers"))
            rows = pointers.where(
                F.col("number").isin(*wanted, state.versions or 0)
                & F.col("kind").isin("history", "append", "versions")
            ).collect()
            self._add_parts(r for r in rows if r.kind != "versions" and r.number in wanted)
            self._add_versions(r for r in rows if r.number == state.versions)
        self._serve({"history", "versions", "live"})

    def _add_parts(self, pointers) -> None:
        parts = [
            f"PARTITION (ingestion_date = DATE '{p.day}', load = {p.number}, "
            f"service_code = {_text(p.service_code)}) LOCATION {_text(p.folder)}"
            for p in pointers
            if p.service_code is not None
        ]
        for k in range(0, len(parts), _ADDED):
            self.spark.sql(
                f"ALTER TABLE {self.name('history_parts')} ADD IF NOT EXISTS "
                + " ".join(parts[k : k + _ADDED])
            )

    def _add_versions(self, pointers) -> None:
        for p in pointers:
            if p.kind == "versions":
                self.spark.sql(
                    f"ALTER TABLE {self.name('versions_parts')} ADD IF NOT EXISTS "
                    f"PARTITION (load = {p.number}) LOCATION {_text(p.folder)}"
                )

    def _serve(self, names: set[str]) -> None:
        """Turn history, versions and live to their loads, one statement each."""
        state = self._state

        def view(name: str, columns: list[str], source: str, where: str) -> None:
            shown = ", ".join(f"`{c}`" for c in columns)
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {self.name(name)} AS "
                f"SELECT {shown} FROM {self.name(source)} WHERE {where}"
            )

        if "history" in names:
            columns = ", ".join(f"`{c}`" for c in schemas.HISTORY.names)
            typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.HISTORY)
            self.spark.sql(
                f"CREATE OR REPLACE FUNCTION {self.name('history')}"
                f"(first_day DATE, last_day DATE) RETURNS TABLE ({typed}) RETURN "
                f"SELECT {columns} FROM {self.name('history_parts')} "
                f"WHERE ingestion_date BETWEEN first_day AND last_day AND {self._current()}"
            )
        if "versions" in names:
            view("versions", schemas.VERSIONS.names, "versions_parts",
                 f"load = {state.versions or 0}")
        if "live" in names and state.live:
            day, loads = state.live
            view("live", schemas.LIVE.names, "history_parts",
                 f"ingestion_date = DATE '{day}' AND load IN ({', '.join(map(str, loads))})")

    def _current(self) -> str:
        loads = sorted(n for loads in self._state.days.values() for n in loads)
        return f"load IN ({', '.join(map(str, loads)) or '0'})"

    def commit(
        self,
        *,
        days: dict[date, Parts] | None = None,
        added: dict[date, Parts] | None = None,
        versions: str | None = None,
        live: date | None = None,
    ) -> None:
        """Publish together: the parts of days, parts added to days, versions, and the day
        that live serves.  A day without parts is a day without rows."""
        moved: list[tuple[str, date | None, str | None, str]] = []
        for kind, published in (("history", days), ("append", added)):
            for day, parts in (published or {}).items():
                rows = [(kind, day, s, folder) for s, folder in parts.items()]
                moved += rows or [(kind, day, None, "")]
        if versions:
            moved.append(("versions", None, None, versions))
        if live:
            if live not in (days or {}) and live not in self._state.days:
                raise ValueError(f"{live} was never published")
            moved.append(("live", live, None, ""))
        if not moved:
            return
        number = self._append_pointers(moved)
        pointers = [Row(**dict(zip(schemas.POINTERS.names, (number, *m)))) for m in moved]
        self._add_parts(p for p in pointers if p.kind in ("history", "append"))
        self._add_versions(pointers)
        kinds = {p.kind for p in pointers}
        self._serve({"history" if k == "append" else k for k in kinds})

    # --- readers ------------------------------------------------------------

    def read_history(
        self, *, on: date | None = None, between: tuple[date, date] | None = None
    ) -> DataFrame:
        """History with its mandatory partition filter."""
        if (on is None) == (between is None):
            raise ValueError("read_history needs exactly one of on= and between=")
        first, last = between or (on, on)
        loads = [n for d, loads in self._state.days.items() if first <= d <= last for n in loads]
        return (
            self.spark.table(self.name("history_parts"))
            .where(F.col("ingestion_date").between(F.lit(first), F.lit(last)))
            .where(F.col("load").isin(*loads) if loads else F.lit(False))
            .select(*schemas.HISTORY.names)
        )

    def read_live(self) -> DataFrame:
        return self.spark.table(self.name("live"))

    def read_versions(self) -> DataFrame:
        return self.spark.table(self.name("versions"))

    def read_runs(self) -> DataFrame:
        return audit.run_states(self.spark.table(self.name("runs")))

    def read_rejects(self) -> DataFrame:
        return self.spark.table(self.name("rejects"))

    # --- days and their parts -----------------------------------------------

    def partition_dates(self) -> list[date]:
        """Published days, newest first; no data is read."""
        return sorted(self._state.days, reverse=True)

    def partition_has_data(self, day: date) -> bool:
        return day in self._state.days and not self.read_history(on=day).isEmpty()

    def latest_previous_partition(
        self, run_date: date, days: list[date] | None = None
    ) -> date | None:
        """Newest day before `run_date` that has rows."""
        days = self.partition_dates() if days is None else days
        earlier = (d for d in days if d < run_date)
        return next((d for d in earlier if not self.read_history(on=d).isEmpty()), None)

    def parts(self, day: date) -> dict[str, list[str]]:
        """The folders of a day, by service; several, where rows were added."""
        loads = self._state.days.get(day, [])
        unread = [n for n in loads if n not in self._folders]
        if unread:
            rows = (
                self.spark.table(self.name("pointers"))
                .where(F.col("number").isin(*unread) & F.col("service_code").isNotNull())
                .collect()
            )
            self._folders |= {n: [] for n in unread}
            for r in rows:
                self._folders[r.number].append((r.kind, r.day, r.service_code, r.folder))
        found: dict[str, list[str]] = {}
        for n in loads:
            for _, of_day, service, folder in self._folders[n]:
                if of_day == day:
                    found.setdefault(service, []).append(folder)
        return found

    # --- writers ------------------------------------------------------------

    def write_rows(self, rows: DataFrame, day: date) -> Parts:
        """Write one day's rows, in order, to new folders that no table knows yet."""
        path = self.folder("history")
        checked = require_columns(require_day(rows, day), schemas.REQUIRED_HISTORY)
        # Put in order after the checks: the writer then knows that services come one by one.
        writer = compose.clustered(self._as_history(checked)).write.partitionBy("service_code")
        for column in _LOOKED_UP:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # Filters as large as the values in a row group need.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.option("compression", CODEC).parquet(path)
        return self.files.parts(path, "service_code")

    def _as_history(self, checked: DataFrame) -> DataFrame:
        # The filter keeps the check of the day, a column that is not written.
        return checked.where(F.col("ingestion_date").isNotNull()).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.LIVE]
        )

    def compose_day(
        self,
        base: date | None,
        run_date: date,
        fresh: DataFrame | None = None,
        pairs: DataFrame | None = None,
    ) -> Parts:
        """The parts of `run_date`: what is carried from the day `base`, and `fresh` rows of
        the changed `pairs`.

        Only services with a changed pair are written: their carried and their fresh rows, in
        order.  The others keep their folders, unless rows were added to them: these are put
        in order together.
        """
        earlier = self.parts(base) if base else {}
        touched = {s for s, folders in earlier.items() if len(folders) > 1}
        if pairs is not None:
            # At most one name a service of the catalogue.
            touched |= {r[0] for r in pairs.select("service_code").distinct().collect()}
        kept = {s: folders[0] for s, folders in earlier.items() if s not in touched}
        if not touched:
            return kept
        rows = fresh
        if touched & earlier.keys():
            carried = self.read_history(on=base).where(F.col("service_code").isin(*touched))
            rows = compose.compose(carried, fresh, pairs, run_date)
        if rows is None:
            return kept
        with narrow_splits(self.spark):
            return kept | self.write_rows(rows, run_date)

    def append(self, rows: DataFrame, day: date) -> None:
        """Add rows to a day; what it holds is neither read nor replaced.  Live follows when it
        is turned to the day again."""
        if day not in self._state.days:
            raise ValueError(f"{day} was never published")
        self.commit(added={day: self.write_rows(rows, day)})

    def written_rows(self, parts: Parts) -> DataFrame:
        """Rows of written parts, before or after they were published."""
        return self.spark.read.schema(schemas.LIVE).option(
            "basePath", next(iter(parts.values())).rpartition("/")[0]
        ).parquet(*parts.values())

    def publish(self, days: dict[date, Parts]) -> None:
        """Replace what each day holds."""
        self.commit(days=days)

    def write_versions(self, versions: DataFrame) -> str:
        path = self.folder("versions")
        checked = require_columns(versions, schemas.REQUIRED_VERSIONS)
        checked.select(
            *[F.col(f.name).cast(f.dataType) for f in schemas.VERSIONS]
        ).write.parquet(path)
        return path

    def replace_versions(self, versions: DataFrame) -> None:
        self.commit(versions=self.write_versions(versions))

    def swap_live(self, day: date) -> None:
        """Serve `day` as it is published now.  Nothing is copied."""
        self.commit(live=day)

    def reject(self, rejects: DataFrame) -> None:
        """Keep what a run could not use."""
        rejects.select(*schemas.REJECTS.names).write.insertInto(self.name("rejects"))

    def record(self, events: DataFrame) -> None:
        required = tuple(c for c in schemas.REQUIRED_RUNS if c != "started_at")
        checked = require_columns(events.coalesce(1), required)
        started = F.col("started_at")
        absent = F.raise_error(F.lit("required column started_at is NULL"))
        checked.withColumn(
            "started_at",
            F.when((F.col("event_seq") == audit.STARTED) & started.isNull(), absent).otherwise(
                started
            ),
        ).select(
            *schemas.RUN_EVENTS.names
        ).write.insertInto(self.name("runs"))
