"""Index documents, targets and the version diff."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.catalogue import adapters as A
from ratebook.catalogue import sql as S
from ratebook.catalogue.registry import query
from ratebook.functions import exprs as X
from ratebook.operators import diff, discover
from ratebook.scratch import written
from ratebook.sources import indexes as I

_COLUMNS = "service_code, region_code, offer_type, version, offer_url"


def targets(spark, sf_dir, *, corrupt=False, **options):
    return discover.discover_targets(
        spark,
        A.landed_master_index(spark, sf_dir),
        A.landed_region_indexes(spark, sf_dir, corrupt=corrupt),
        base_url=A.BASE_URL,
        **options,
    )


def known(spark, sf_dir):
    return A.once(
        spark,
        sf_dir,
        "known-versions",
        lambda path: written(A.known_table(spark, sf_dir, targets(spark, sf_dir)), path),
    )


def services(spark, sf_dir):
    return I.read_master_index(spark, A.landed_master_index(spark, sf_dir))


def entries(spark, sf_dir):
    root = A.landed_region_indexes(spark, sf_dir)
    return I.region_entries(I.readable(I.read_region_indexes(spark, root)))


# --- index documents --------------------------------------------------------

_SERVICES = f"""
SELECT DISTINCT c_mktsegment AS service_code,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN '{S.BASE}' ELSE '' END
    || '/offers/v1.0/' || c_mktsegment || '/current/region_index.json'
    AS region_index_url
FROM customer"""


@query(
    f"""{_SERVICES} UNION ALL
    SELECT DISTINCT o_orderpriority,
      CASE WHEN o_orderpriority LIKE '4%' THEN '' END FROM orders"""
)
def master_index_services(spark, sf_dir):
    return services(spark, sf_dir)


@query(
    f"""WITH counted AS (
      SELECT {S.PLAN_CODE} AS service_code, count(*) AS customers FROM customer GROUP BY 1)
    SELECT service_code, 'savings_plan' AS offer_type, customers,
      '/savingsPlan/v1.0/aws/' || service_code || '/current/region_index.json'
        AS region_index_url
    FROM counted"""
)
def plan_code_literals(spark, sf_dir):
    """The literal plan codes, next to the customers each one serves."""
    customers = (
        A.table(spark, sf_dir, "customer")
        .groupBy(A.plan_code().alias("service_code"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )
    return I.plan_codes(spark).join(customers, "service_code")


_ENTRIES = f"""
SELECT '/offers/v1.0/' || c_mktsegment || '/current/region_index.json' AS index_path,
  n_name AS region_code,
  CASE WHEN n_nationkey % 7 <> 0 THEN
    CASE WHEN n_nationkey % 2 = 1 THEN '{S.BASE}' ELSE '' END || '/offers/v1.0/'
    || c_mktsegment || '/v' || newest || '/' || n_name || '/index.json' END AS version_url
FROM newest WHERE {S.ENTRY}"""
_PLAN_ENTRIES = """
SELECT '/savingsPlan/v1.0/aws/' || code || '/current/region_index.json' AS index_path,
  n_name AS region_code,
  '/savingsPlan/v1.0/aws/' || code || '/p' || newest || '/' || n_name || '/index.json'
    AS version_url
FROM plan_newest"""
_WITH = f"WITH {S.SALES}, {S.NEWEST}, {S.PLAN_NEWEST}"


@query(f"{_WITH} {_ENTRIES} UNION ALL {_PLAN_ENTRIES}")
def region_index_entries(spark, sf_dir):
    return entries(spark, sf_dir)


@query(f"{_WITH} {_ENTRIES} AND {S.LISTED}")
def filter_missing_region(spark, sf_dir):
    """List-shaped indexes of services: entries without a region code are dropped."""
    return entries(spark, sf_dir).where(
        F.split("index_path", "/")[3].isin(*A.LIST_SHAPED)
    )


@query(f"{_WITH} {_ENTRIES} AND n_nationkey % 7 <> 0 UNION ALL {_PLAN_ENTRIES}")
def filter_missing_version_url(spark, sf_dir):
    return entries(spark, sf_dir).where(F.col("version_url") != "")


@query(_SERVICES)
def filter_missing_index_url(spark, sf_dir):
    jobs = discover.service_jobs(
        services(spark, sf_dir), I.plan_codes(spark), service_filter="", include_plans=False
    )
    return jobs.drop("offer_type")


# --- targets ----------------------------------------------------------------


@query(f"{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets")
def discover_targets(spark, sf_dir):
    return targets(spark, sf_dir)


@query(f"{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets WHERE offer_type = 'service'")
def discover_without_plans(spark, sf_dir):
    return targets(spark, sf_dir, include_plans=False)


@query(
    f"""{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets
    WHERE service_code IN ('BUILDING', 'FURNITURE') OR offer_type = 'savings_plan'"""
)
def service_filter(spark, sf_dir):
    return targets(spark, sf_dir, service_filter=" BUILDING, ,FURNITURE,")


@query(
    f"""{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets
    WHERE service_code <> '{A.CORRUPT_SERVICE}'"""
)
def discover_skip_corrupt(spark, sf_dir):
    return targets(spark, sf_dir, corrupt=True)


@query(
    f"""SELECT DISTINCT o_orderpriority AS service_code, 'service' AS offer_type,
      CAST(NULL AS VARCHAR) AS index_path, 'no index named' AS reason FROM orders
    UNION ALL
    SELECT DISTINCT c_mktsegment, 'service',
      '/offers/v1.0/' || c_mktsegment || '/current/region_index.json', 'index not readable'
    FROM customer WHERE c_mktsegment = '{A.CORRUPT_SERVICE}'"""
)
def rejected_indexes(spark, sf_dir):
    """Services on offer whose index cannot be used."""
    return discover.discover_rejects(
        spark,
        A.landed_master_index(spark, sf_dir),
        A.landed_region_indexes(spark, sf_dir, corrupt=True),
    ).drop("record")


# --- version diff -----------------------------------------------------------


@query(
    f"""{S.WITH_TARGETS} SELECT DISTINCT service_code, region_code, offer_type,
      CASE WHEN {S.EVEN} THEN version ELSE 'v0' END AS version FROM targets"""
)
def known_versions(spark, sf_dir):
    return diff.known_versions(known(spark, sf_dir))


@query(f"{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets WHERE NOT {S.EVEN}")
def version_diff_changed(spark, sf_dir):
    return diff.changed(targets(spark, sf_dir), known(spark, sf_dir))


@query(f"{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets WHERE {S.EVEN}")
def version_diff_skipped(spark, sf_dir):
    return diff.skipped(targets(spark, sf_dir), known(spark, sf_dir))


@query(f"{S.WITH_TARGETS} SELECT {_COLUMNS} FROM targets")
def version_diff_forced(spark, sf_dir):
    nothing = diff.no_known_versions(known(spark, sf_dir))
    return diff.changed(targets(spark, sf_dir), nothing)


@query(
    f"""{S.WITH_TARGETS} SELECT count(*) FILTER (NOT {S.EVEN}) AS changed,
      count(*) FILTER ({S.EVEN}) AS skipped FROM targets"""
)
def diff_counts(spark, sf_dir):
    return diff.diff_counts(targets(spark, sf_dir), known(spark, sf_dir))


@query(
    f"""{S.WITH_TARGETS} SELECT DISTINCT service_code, region_code,
      service_code || '|' || region_code AS pair
    FROM targets WHERE NOT {S.EVEN}"""
)
def changed_pairs(spark, sf_dir):
    changed = diff.changed(targets(spark, sf_dir), known(spark, sf_dir))
    return diff.changed_pairs(changed).withColumn(
        "pair", X.pair_label(*[F.col(c) for c in schemas.PAIR])
    )
