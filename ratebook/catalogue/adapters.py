"""Driver tables -> the inputs the jobs work on.

Documents are landed from `orders`, `customer` and `nation`, history and audit rows
come from `events`.  Edge cases are spread over the rows by key arithmetic.  What is
landed goes to a new folder on shared storage, once per session and input directory.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratebook.functions import exprs as X
from ratebook.operators import audit
from ratebook.operators.keys import written_keys
from ratebook.plans.load import Landing
from ratebook.schemas import HISTORY
from ratebook.scratch import new_folder, written
from ratebook.sources import indexes, offers
from ratebook.sources.book import PriceBook

BASE_URL = "https://prices.example.com"
RUN_DATE = date(2024, 2, 1)
NOW = datetime(2024, 2, 1, 6, 30, tzinfo=timezone.utc)
PUBLISHED = "2024-01-15T08:30:00Z"
# Orders per document slice at most: a slice's size is bounded whatever the skew.
# Slices landed as files of their own are wider, so that files do not get too many.
SLICE = 1 << 16
FILE_SLICE = 1 << 21
# Orders whose slices of a document go to the same task, and share a file.
SPAN = 1 << 20
# Orders per landing task, about: tasks get more, not larger, with more orders.
TASK_ORDERS = 1 << 16
# Events per task that writes history, the same way.
TASK_EVENTS = 1 << 17
LANDED_BUCKETS = 16

_LANDED: dict[tuple[str, str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_bytes(spark: SparkSession, sf_dir: str) -> int:
    """Size of all tables, from the directory listing."""

    def listed(_: str) -> int:
        files = spark.read.format("binaryFile").load(f"{sf_dir}/*.parquet")
        return files.agg(F.sum("length")).first()[0]

    return once(spark, sf_dir, "table-bytes", listed)


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]):
    """Result of `make(new folder)`, made once per session and input directory."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        _LANDED[key] = make(new_folder(spark, name))
    return _LANDED[key]


def _pick(key: str, by: int, *cases: Column) -> Column:
    """Case number `key % by`; NULL past the last one."""
    rest = F.col(key) % by
    chosen = F.lit(None)
    for i, case in reversed(list(enumerate(cases))):
        chosen = F.when(rest == i, case).otherwise(chosen)
    return chosen


def _nonzero(key: str, by: int, value: Column) -> Column:
    return F.when(F.col(key) % by != 0, value)


def _text(key: str) -> Column:
    return F.col(key).cast("string")


def _map_of(entries: Column) -> Column:
    return F.map_from_entries(F.collect_list(entries))


# --- A: service documents ---------------------------------------------------


def sales(spark: SparkSession, sf_dir: str, width: int = SLICE) -> DataFrame:
    """orders with their customer and nation, the slice they fall in, and its span."""
    return (
        table(spark, sf_dir, "orders")
        .join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
        .join(
            table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
        )
        .withColumn("slice", F.floor(F.col("o_orderkey") / width).cast("int"))
        .withColumn("span", F.floor(F.col("o_orderkey") / max(SPAN, width)))
    )


# What documents are made of: everything nested is put together behind the shuffle.
_SOLD = (
    "o_orderkey",
    "o_orderstatus",
    "o_orderpriority",
    "o_totalprice",
    "c_custkey",
    "c_name",
    "c_mktsegment",
    "n_nationkey",
    "n_name",
    "span",
    "slice",
)


def dealt(spark: SparkSession, sf_dir: str, rows: DataFrame, *document: str) -> DataFrame:
    """Sales in tasks of whole slices.

    Their number follows the orders, so what a task groups, sorts and writes does not grow
    with the input; it is given, as AQE would merge what is narrow here and unfolds later.
    """
    tasks = _tasks(spark, sf_dir, "orders", TASK_ORDERS)
    return rows.repartition(tasks, *document, "span")


def _tasks(spark: SparkSession, sf_dir: str, name: str, rows: int) -> int:
    """Tasks of about `rows` rows of a table, at least one a core."""
    count = once(spark, sf_dir, f"{name}-count", lambda _: table(spark, sf_dir, name).count())
    return max(spark.sparkContext.defaultParallelism, math.ceil(count / rows))


def price_text() -> Column:
    """The price as text, in scientific notation now and then."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string")
    return F.when(F.col("o_orderkey") % 14 == 3, F.concat(cents, F.lit("E-2"))).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )


def price_map() -> Column:
    return F.coalesce(
        _pick(
            "o_orderkey",
            7,
            F.create_map(F.lit("CNY"), price_text()),
            F.create_map(F.lit("EUR"), F.lit("1.5"), F.lit("USD"), price_text()),
            F.create_map().cast("map<string,string>"),
        ),
        F.create_map(F.lit("USD"), price_text()),
    )


def begin_range() -> Column:
    return _pick("o_orderkey", 6, F.lit("0"), F.lit(" 12.5\t"), F.lit(None), F.lit(" "))


def end_range() -> Column:
    return F.coalesce(
        _pick("o_orderkey", 5, F.lit("Inf"), F.lit(" infinity "), F.lit("")),
        _text("o_orderkey"),
    )


def rate_code_text() -> Column:
    return F.when(
        F.col("o_orderkey") % 10 != 0,
        F.when(F.col("o_orderkey") % 10 == 1, "").otherwise(
            F.concat(F.lit("RC"), _text("o_orderkey"))
        ),
    )


def effective_text() -> Column:
    day = F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0")
    stamp = F.concat(F.lit("2024-01-"), day, F.lit("T00:00:00Z"))
    return F.when(
        F.col("c_custkey") % 9 != 0,
        F.when(F.col("c_custkey") % 9 == 1, "").otherwise(stamp),
    )


def customer_attributes() -> Column:
    """Attribute bag with the service name under one of its spellings."""
    name = F.concat(F.lit("Service "), F.col("c_mktsegment"))
    named = F.coalesce(
        _pick(
            "c_custkey",
            4,
            F.create_map(F.lit("servicename"), name),
            F.create_map(F.lit("servicename"), F.lit(""), F.lit("serviceName"), name),
            F.create_map(F.lit("ServiceName"), name),
        ),
        F.create_map().cast("map<string,string>"),
    )
    bag = F.create_map(
        F.lit("customer"),
        F.col("c_name"),
        F.lit("instanceType"),
        F.concat(F.lit("type."), (F.col("c_custkey") % 50).cast("string")),
        F.lit("storageClass"),
        F.concat(F.lit("class "), (F.col("c_custkey") % 6).cast("string")),
    )
    return F.when(
        F.col("c_custkey") % 17 == 0, F.create_map().cast("map<string,string>")
    ).otherwise(F.map_concat(named, bag))


def product_family() -> Column:
    return _nonzero("c_custkey", 13, F.concat(F.col("c_mktsegment"), F.lit(" family")))


def term_bucket() -> Column:
    """OnDemand, Reserved, or a bucket nobody reads."""
    return (
        F.when(F.col("o_orderkey") % 19 == 0, "Archived")
        .when(F.col("o_orderstatus") == "P", "Reserved")
        .otherwise("OnDemand")
    )


def offer_url(service: Column, region: Column, version: Column) -> Column:
    return F.concat(
        F.lit(f"{BASE_URL}/offers/v1.0/"),
        F.concat_ws("/", service, version, region, F.lit("index.json")),
    )


def service_bodies(
    spark: SparkSession, sf_dir: str, width: int = SLICE
) -> DataFrame:
    """(offer_url, slice, body): one row per document slice.

    One shuffle, on (service, region, span of slices); every nesting level groups within
    it, and no group exceeds a slice.
    """
    document = ("c_mktsegment", "n_name", "span", "slice")
    rate = F.struct(
        rate_code_text().alias("rateCode"),
        F.concat(F.lit("order "), _text("o_orderkey")).alias("description"),
        begin_range().alias("beginRange"),
        end_range().alias("endRange"),
        F.lit("Hrs").alias("unit"),
        price_map().alias("pricePerUnit"),
    )
    product = F.struct(
        F.concat(F.lit("C"), _text("c_custkey")).alias("sku"),
        product_family().alias("productFamily"),
        customer_attributes().alias("attributes"),
    )
    sold = sales(spark, sf_dir, width).select(*_SOLD)
    rates = (
        dealt(spark, sf_dir, sold, "c_mktsegment", "n_name")
        .withColumn("bucket", term_bucket())
        .withColumn("rate_id", F.concat(F.lit("R"), _text("o_orderkey")))
        .withColumn("rate", rate)
        .withColumn("effective", effective_text())
        .withColumn("product", F.when(F.col("c_custkey") % 11 != 0, product))
        .withColumn("sku", F.concat(F.lit("C"), _text("c_custkey")))
        .select(
            *document,
            "bucket",
            "sku",
            "o_orderpriority",
            "effective",
            "rate_id",
            "rate",
            "product",
        )
    )
    term = F.struct(
        F.concat(F.lit("T"), F.left("o_orderpriority", F.lit(1))).alias("offerTermCode"),
        F.col("effective").alias("effectiveDate"),
        F.when(
            F.col("bucket") == "Reserved",
            F.create_map(F.lit("PurchaseOption"), F.col("o_orderpriority")),
        )
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("termAttributes"),
        F.col("dimensions").alias("priceDimensions"),
    )
    by_term = rates.groupBy(*document, "bucket", "sku", "o_orderpriority", "effective").agg(
        _map_of(F.struct("rate_id", "rate")).alias("dimensions"),
        F.any_value("product").alias("product"),
    )
    by_bucket_sku = by_term.groupBy(*document, "bucket", "sku").agg(
        _map_of(F.struct(F.col("o_orderpriority"), term.alias("term"))).alias("terms"),
        F.any_value("product").alias("product"),
    )
    by_sku = by_bucket_sku.groupBy(*document, "sku").agg(
        F.any_value(F.when(F.col("bucket") == "OnDemand", F.col("terms")), True).alias("o"),
        F.any_value(F.when(F.col("bucket") == "Reserved", F.col("terms")), True).alias("r"),
        F.any_value(F.when(F.col("bucket") == "Archived", F.col("terms")), True).alias("a"),
        F.any_value("product", True).alias("product"),
    )

    def sku_map(column: str) -> Column:
        return F.map_from_entries(
            F.collect_list(
                F.when(F.col(column).isNotNull(), F.struct(F.col("sku"), F.col(column)))
            )
        )

    body = F.struct(
        F.lit("v1.0").alias("formatVersion"),
        F.lit("sample").alias("disclaimer"),
        F.col("c_mktsegment").alias("offerCode"),
        F.lit("20240115").alias("version"),
        F.lit(PUBLISHED).alias("publicationDate"),
        F.col("slice"),
        F.col("products"),
        F.struct(
            F.col("o").alias("OnDemand"),
            F.col("r").alias("Reserved"),
            F.col("a").alias("Archived"),
        ).alias("terms"),
    )
    documents = (
        by_sku.groupBy(*document)
        .agg(
            sku_map("product").alias("products"),
            sku_map("o").alias("o"),
            sku_map("r").alias("r"),
            sku_map("a").alias("a"),
        )
        .select(
            offer_url(F.col("c_mktsegment"), F.col("n_name"), F.lit("20240115")).alias(
                "offer_url"
            ),
            "slice",
            F.to_json(body).alias("body"),
        )
    )
    return documents.unionByName(shell_bodies(spark, sf_dir))


def shell_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A valid document without a single price, one per nation."""
    body = F.lit(
        '{"formatVersion":"v1.0","disclaimer":"sample","offerCode":"SHELL",'
        f'"version":"20240115","publicationDate":"{PUBLISHED}",'
        '"products":{},"terms":{"OnDemand":{},"Reserved":{}}}'
    )
    return table(spark, sf_dir, "nation").select(
        offer_url(F.lit("SHELL"), F.col("n_name"), F.lit("20240115")).alias("offer_url"),
        F.lit(0).alias("slice"),
        body.alias("body"),
    )


def _land(bodies: DataFrame, path: str, *, layout: str, gzip: bool) -> str:
    writer = bodies.select("offer_url", "body").write.partitionBy("offer_url")
    if layout == "file":
        writer = writer.option("maxRecordsPerFile", 1)
    writer.option("compression", "gzip" if gzip else "none").text(path)
    return path


def landed_services(
    spark: SparkSession, sf_dir: str, *, layout: str = "lines", gzip: bool = False
) -> str:
    name = f"service-{layout}{'-gz' if gzip else ''}"
    width = FILE_SLICE if layout == "file" else SLICE
    return once(
        spark,
        sf_dir,
        name,
        lambda path: _land(
            service_bodies(spark, sf_dir, width), path, layout=layout, gzip=gzip
        ),
    )


def service_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(
        spark,
        sf_dir,
        "service-targets",
        lambda path: written_keys(_service_targets(spark, sf_dir), path).frame,
    )


def _service_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target per segment and nation, and per shell document."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pairs = (
        table(spark, sf_dir, "customer")
        .select("c_mktsegment", "c_nationkey")
        .distinct()
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_mktsegment").alias("service_code"), "n_name")
    )
    shells = nations.select(F.lit("SHELL").alias("service_code"), "n_name")
    return pairs.unionByName(shells).select(
        "service_code",
        F.col("n_name").alias("region_code"),
        F.lit("service").alias("offer_type"),
        F.lit("20240115").alias("version"),
        offer_url(F.col("service_code"), F.col("n_name"), F.lit("20240115")).alias(
            "offer_url"
        ),
    )


def service_documents(
    spark: SparkSession,
    sf_dir: str,
    *,
    layout: str = "lines",
    gzip: bool = False,
    include_reserved: bool = True,
) -> DataFrame:
    root = landed_services(spark, sf_dir, layout=layout, gzip=gzip)
    documents = offers.read_service_offers(
        spark, root, layout=layout, include_reserved=include_reserved
    )
    return offers.of_targets(documents, service_targets(spark, sf_dir))


# --- A2: plan documents -----------------------------------------------------


def plan_code() -> Column:
    return _pick("c_custkey", 3, *[F.lit(c) for c in indexes.PLAN_CODES])


def plan_url(code: Column, region: Column) -> Column:
    return F.concat(
        F.lit(f"{BASE_URL}/savingsPlan/v1.0/aws/"),
        F.concat_ws("/", code, F.lit("20240115"), region, F.lit("index.json")),
    )


def plan_sku() -> Column:
    """Blank or missing now and then."""
    filled = F.concat(F.lit("P"), _text("c_custkey"))
    blank = F.when(F.col("c_custkey") % 46 == 23, "")
    return F.when(F.col("c_custkey") % 23 == 0, blank).otherwise(filled)


def plan_description() -> Column:
    return _nonzero("c_custkey", 4, F.concat(F.lit("plan of "), F.col("c_name")))


def lease() -> Column:
    return _nonzero(
        "c_custkey",
        6,
        F.struct(F.lit(1).alias("duration"), F.lit("year").alias("unit")),
    )


def rate_description() -> Column:
    return _pick(
        "o_orderkey",
        3,
        F.lit(None),
        F.lit(""),
        F.concat(F.lit("rate "), _text("o_orderkey")),
    )


def plan_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(offer_url, slice, body).  `products` is a list in every other region, with
    outdated entries before the valid ones, and a map in the rest."""
    document = ("code", "n_nationkey", "n_name", "span", "slice")
    plan = (
        *document,
        "c_custkey",
        "sku",
        "description",
        "effective",
        "leaseContractLength",
        "product",
        "stale",
    )
    rate = F.struct(
        F.concat(F.lit("RC"), _text("o_orderkey")).alias("rateCode"),
        rate_description().alias("description"),
        F.lit("not this one").alias("unit"),
        _nonzero(
            "o_orderkey",
            8,
            F.struct(price_text().alias("price"), F.lit("Hrs").alias("unit")),
        ).alias("discountedRate"),
    )
    entry = F.struct(
        F.col("sku"),
        product_family().alias("productFamily"),
        customer_attributes().alias("attributes"),
    )
    stale = F.struct(F.col("sku"), F.lit("stale").alias("productFamily"))
    sold = sales(spark, sf_dir).select(*_SOLD, plan_code().alias("code"))
    by_plan = (
        dealt(spark, sf_dir, sold, "code", "n_nationkey", "n_name")
        .withColumn("sku", plan_sku())
        .withColumn("description", plan_description())
        .withColumn("effective", effective_text())
        .withColumn("leaseContractLength", lease())
        .withColumn("product", F.when(F.col("c_custkey") % 11 != 0, entry))
        .withColumn(
            "stale", F.when(F.col("product").isNotNull() & (F.col("c_custkey") % 5 == 0), stale)
        )
        .select(
            *document,
            "c_custkey",
            "sku",
            "description",
            "effective",
            "leaseContractLength",
            "product",
            "stale",
            rate.alias("rate"),
        )
        .groupBy(*document, "c_custkey")
        .agg(
            *[F.any_value(c).alias(c) for c in plan[len(document) + 1 :]],
            F.collect_list("rate").alias("rates"),
        )
    )
    member = F.struct(
        "sku",
        "description",
        F.col("effective").alias("effectiveDate"),
        "leaseContractLength",
        "rates",
    )
    keyed = F.when(
        F.col("product").isNotNull() & (F.col("sku") != ""),
        F.struct(F.col("sku"), F.col("product")),
    )
    documents = by_plan.groupBy(*document).agg(
        F.to_json(F.collect_list(member)).alias("plans"),
        F.to_json(F.collect_list("stale")).alias("stale"),
        F.to_json(F.collect_list("product")).alias("listed"),
        F.to_json(F.map_from_entries(F.collect_list(keyed))).alias("keyed"),
    )
    inner = lambda c: F.expr(f"substring({c}, 2, length({c}) - 2)")
    listed = F.concat(
        F.lit("["),
        F.concat_ws(
            ",", F.nullif(inner("stale"), F.lit("")), F.nullif(inner("listed"), F.lit(""))
        ),
        F.lit("]"),
    )
    products = F.when(F.col("n_nationkey") % 2 == 0, listed).otherwise(F.col("keyed"))
    body = F.concat(
        F.lit('{"formatVersion":"v1.0","offerCode":"'),
        F.col("code"),
        F.lit(f'","version":"20240115","publicationDate":"{PUBLISHED}","slice":'),
        F.col("slice").cast("string"),
        F.lit(',"products":'),
        products,
        F.lit(',"terms":{"savingsPlan":'),
        F.col("plans"),
        F.lit("}}"),
    )
    return documents.select(
        plan_url(F.col("code"), F.col("n_name")).alias("offer_url"),
        "slice",
        body.alias("body"),
    )


def landed_plans(spark: SparkSession, sf_dir: str) -> str:
    return once(
        spark,
        sf_dir,
        "plans",
        lambda path: _land(plan_bodies(spark, sf_dir), path, layout="lines", gzip=False),
    )


def plan_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(
        spark,
        sf_dir,
        "plan-targets",
        lambda path: written_keys(_plan_targets(spark, sf_dir), path).frame,
    )


def _plan_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .select(plan_code().alias("service_code"), "c_nationkey")
        .distinct()
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "service_code",
            F.col("n_name").alias("region_code"),
            F.lit("savings_plan").alias("offer_type"),
            # No version of its own: the document's counts.
            F.lit("").alias("version"),
            plan_url(F.col("service_code"), F.col("n_name")).alias("offer_url"),
        )
    )


def plan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = offers.read_plan_offers(spark, landed_plans(spark, sf_dir))
    return offers.of_targets(documents, plan_targets(spark, sf_dir))


# --- E: index documents -----------------------------------------------------

CORRUPT_SERVICE = "AUTOMOBILE"
LIST_SHAPED = ("BUILDING", "MACHINERY")


def newest_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per segment, nation and plan code, of one pass over all sales: the pairs'
    versions come from these few rows."""

    def land(path: str) -> DataFrame:
        keys = ("c_mktsegment", "n_nationkey", "n_name", "code")
        sold = sales(spark, sf_dir).withColumn("code", plan_code())
        return written(sold.groupBy(*keys).agg(F.max("o_orderkey").alias("newest")), path)

    return once(spark, sf_dir, "newest-sales", land)


def newest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order per segment and nation: the version on offer."""
    return (
        newest_sales(spark, sf_dir)
        .groupBy("c_mktsegment", "n_nationkey", "n_name")
        .agg(F.max("newest").alias("newest"))
    )


def newest_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same per plan code and nation."""
    return (
        newest_sales(spark, sf_dir).groupBy("code", "n_name").agg(F.max("newest").alias("newest"))
    )


def index_version() -> Column:
    return F.concat(F.lit("v"), _text("newest"))


def region_index_bodies(spark: SparkSession, sf_dir: str, *, corrupt: bool) -> DataFrame:
    """(index_path, body): one region index per service and per plan."""
    path = F.concat_ws(
        "/",
        F.lit("/offers/v1.0"),
        F.col("c_mktsegment"),
        index_version(),
        F.col("n_name"),
        F.lit("index.json"),
    )
    url = F.when(F.col("n_nationkey") % 2 == 1, F.concat(F.lit(BASE_URL), path)).otherwise(
        path
    )
    listed = F.struct(
        _nonzero("n_nationkey", 5, F.col("n_name")).alias("regionCode"),
        _nonzero("n_nationkey", 7, url).alias("versionUrl"),
    )
    named = F.struct(
        F.col("n_name").alias("regionCode"),
        F.when(F.col("n_nationkey") % 6 == 1, "")
        .otherwise(_nonzero("n_nationkey", 7, url))
        .alias("currentVersionUrl"),
        F.when(F.col("n_nationkey") % 6 == 1, _nonzero("n_nationkey", 7, url)).alias(
            "versionUrl"
        ),
    )
    services = (
        newest_orders(spark, sf_dir)
        .groupBy("c_mktsegment")
        .agg(
            F.to_json(F.collect_list(listed)).alias("listed"),
            F.to_json(_map_of(F.struct("n_name", named.alias("meta")))).alias("named"),
        )
        .select(
            F.concat_ws(
                "/",
                F.lit("/offers/v1.0"),
                F.col("c_mktsegment"),
                F.lit("current/region_index.json"),
            ).alias("index_path"),
            F.when(F.col("c_mktsegment").isin(*LIST_SHAPED), F.col("listed"))
            .otherwise(F.col("named"))
            .alias("regions"),
            (F.lit(corrupt) & (F.col("c_mktsegment") == CORRUPT_SERVICE)).alias("broken"),
        )
    )
    plan_entry = F.struct(
        F.col("n_name").alias("regionCode"),
        F.concat_ws(
            "/",
            F.lit("/savingsPlan/v1.0/aws"),
            F.col("code"),
            F.concat(F.lit("p"), _text("newest")),
            F.col("n_name"),
            F.lit("index.json"),
        ).alias("versionUrl"),
    )
    plans = (
        newest_plans(spark, sf_dir)
        .groupBy("code")
        .agg(F.to_json(F.collect_list(plan_entry)).alias("regions"))
        .select(
            F.format_string(
                "/savingsPlan/v1.0/aws/%s/current/region_index.json", "code"
            ).alias("index_path"),
            "regions",
            F.lit(False).alias("broken"),
        )
    )
    whole = F.concat(F.lit('{"formatVersion":"v1.0","regions":'), F.col("regions"))
    return services.unionByName(plans).select(
        "index_path",
        F.when(F.col("broken"), whole).otherwise(F.concat(whole, F.lit("}"))).alias("body"),
    )


def landed_region_indexes(
    spark: SparkSession, sf_dir: str, *, corrupt: bool = False
) -> str:
    def land(path: str) -> str:
        bodies = region_index_bodies(spark, sf_dir, corrupt=corrupt)
        bodies.write.partitionBy("index_path").option("maxRecordsPerFile", 1).text(path)
        return path

    return once(spark, sf_dir, f"region-index{'-corrupt' if corrupt else ''}", land)


def landed_master_index(spark: SparkSession, sf_dir: str) -> str:
    """Segments have a region index; order priorities are services without one."""

    def land(path: str) -> str:
        segments = (
            table(spark, sf_dir, "customer")
            .select(F.col("c_mktsegment").alias("code"))
            .distinct()
            .withColumn(
                "url",
                F.concat_ws(
                    "/",
                    F.when(
                        F.col("code") == "FURNITURE", f"{BASE_URL}/offers/v1.0"
                    ).otherwise("/offers/v1.0"),
                    F.col("code"),
                    F.lit("current/region_index.json"),
                ),
            )
        )
        others = (
            table(spark, sf_dir, "orders")
            .select(F.col("o_orderpriority").alias("code"))
            .distinct()
            .withColumn("url", F.when(F.col("code").startswith("4"), ""))
        )
        meta = F.struct(
            F.col("code").alias("offerCode"), F.col("url").alias("currentRegionIndexUrl")
        )
        body = segments.unionByName(others).agg(
            _map_of(F.struct("code", meta.alias("meta"))).alias("offers")
        )
        body.select(F.to_json(F.struct("offers"))).write.text(path)
        return path

    return once(spark, sf_dir, "master-index", land)


def known_table(spark: SparkSession, sf_dir: str, targets: DataFrame) -> DataFrame:
    """Versions table of an earlier load: every other nation is up to date."""
    number = F.regexp_extract("region_code", r"(\d+)$", 1).cast("int")
    return targets.select(
        "service_code",
        "region_code",
        "offer_type",
        F.when(number % 2 == 0, F.col("version")).otherwise(F.lit("v0")).alias("version"),
        F.lit(PUBLISHED).cast("timestamp").alias("publication_date"),
        F.lit(NOW).cast("timestamp").alias("loaded_at"),
        F.col("offer_url").alias("source_url"),
    )


# --- B: history from events -------------------------------------------------


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type, in tasks whose number follows the events: what a task that
    writes history sorts does not grow with the input, and it holds few days."""
    tasks = _tasks(spark, sf_dir, "events", TASK_EVENTS)
    day = F.to_date(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").repartitionByRange(
        tasks, day, "event_type", "event_id"
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_of(table(spark, sf_dir, "events"))


def history_of(events: DataFrame) -> DataFrame:
    """One price per event; the day of the event is its snapshot."""
    ts = F.col("ts").cast("timestamp")
    hour = F.date_trunc("hour", ts)
    service = F.col("event_type")
    region = F.concat(F.lit("region-"), (F.col("user_id") % 10).cast("string"))
    version = F.concat(F.lit("v"), F.date_format(hour, "yyyyMMddHH"))
    price = F.col("value").cast("decimal(18,2)").cast("string")
    values = {
        "ingestion_date": F.to_date(ts),
        "service_code": service,
        "region_code": region,
        "version": version,
        "publication_date": hour,
        "offer_type": F.when(service == "signup", "savings_plan").otherwise("service"),
        "sku": F.concat(F.lit("U"), _text("user_id")),
        "rate_code": F.concat(F.lit("E"), _text("event_id")),
        "term_type": F.when(F.col("event_id") % 3 == 0, "Reserved").otherwise("OnDemand"),
        "price_per_unit": X.exact_price(price),
        "currency": F.lit(X.USD),
        "unit": F.lit("Hrs"),
        "attributes": F.parse_json(
            F.regexp_replace(
                F.col("props"),
                F.lit(r"\}$"),
                F.concat(
                    F.lit(', "class": "c'),
                    (F.col("user_id") % 4).cast("string"),
                    F.lit('"}'),
                ),
            )
        ),
        "price_per_unit_raw": F.create_map(F.lit(X.USD), price),
        "source_url": offer_url(service, region, version),
        "ingested_at": hour,
    }
    return events.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in HISTORY]
    )


def new_book(spark: SparkSession, name: str) -> PriceBook:
    book = PriceBook(spark, f"{name}_{uuid4().hex}", new_folder(spark, name))
    book.provision()
    return book


def history_book(spark: SparkSession, sf_dir: str) -> PriceBook:
    """A book holding one history partition per day of events, the last one live."""

    def land(path: str) -> PriceBook:
        book = PriceBook(spark, f"history_{uuid4().hex}", path)
        book.provision()
        root = book.folder("history")
        rows = history_of(dealt_events(spark, sf_dir))
        rows.write.partitionBy("ingestion_date", "service_code").parquet(root)
        days = {
            date.fromisoformat(day): book.files.parts(folder, "service_code")
            for day, folder in book.files.parts(root, "ingestion_date").items()
        }
        book.publish(days)
        book.swap_live(max(days))
        return book

    return once(spark, sf_dir, "history", land)


CHANGED_REGIONS = ("region-0", "region-1", "region-2")


def changed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of the last day whose region changed."""

    def land(path: str) -> DataFrame:
        book = history_book(spark, sf_dir)
        rows = book.read_history(on=book.partition_dates()[0])
        pairs = rows.where(F.col("region_code").isin(*CHANGED_REGIONS))
        return written_keys(pairs.select("service_code", "region_code").distinct(), path).frame

    return once(spark, sf_dir, "changed-pairs", land)


def fresh_rows(spark: SparkSession, sf_dir: str, source_day: date, day: date) -> DataFrame:
    """New rows of the changed pairs, dated `day`: a day's OnDemand prices plus one."""
    rows = history_book(spark, sf_dir).read_history(on=source_day)
    return (
        rows.where(
            F.col("region_code").isin(*CHANGED_REGIONS)
            & (F.col("term_type") == "OnDemand")
        )
        .withColumn("ingestion_date", F.lit(day))
        .withColumn("price_per_unit", (F.col("price_per_unit") + 1).cast("decimal(38,18)"))
    )


# --- C: run audit -----------------------------------------------------------


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit events: every event starts a run; purchases finish, errors fail."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    run_id = F.concat(F.lit("run-"), _text("event_id"))
    later = F.col("ts") + F.expr("INTERVAL 1 HOUR")
    started = audit.start_events(
        events,
        run_id=run_id,
        started_at=F.col("ts"),
        service_filter=F.col("event_type"),
        ingestion_date=F.to_date("ts"),
    )
    return started.unionByName(
        audit.finish_events(
            events.where(F.col("event_type") == "purchase"),
            run_id=run_id,
            finished_at=later,
            rows_loaded=F.col("user_id") * 10,
            services_changed=F.col("user_id"),
            services_skipped=F.col("event_id") % 7,
        )
    ).unionByName(
        audit.fail_events(
            events.where(F.col("event_type") == "error"),
            run_id=run_id,
            finished_at=later,
            error=F.when(F.col("event_id") % 4 != 0, F.repeat("props", F.lit(1000))),
        )
    )


# --- whole load -------------------------------------------------------------


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    return Landing(
        master_index=landed_master_index(spark, sf_dir),
        region_indexes=landed_region_indexes(spark, sf_dir),
        service_offers=landed_load_services(spark, sf_dir),
        plan_offers=landed_load_plans(spark, sf_dir),
        base_url=BASE_URL,
        buckets=LANDED_BUCKETS,
    )


def _versioned(bodies: DataFrame, newest: DataFrame, path: str) -> str:
    """Land bodies under the url of the version on offer for their pair, compressed: plain
    documents are many times as large as the rows that are loaded from them."""
    moved = bodies.join(written_keys(newest, f"{path}-urls").frame, "offer_url").select(
        F.col("current_url").alias("offer_url"), "slice", "body"
    )
    bucket = offers.bucket_of(F.col("offer_url"), LANDED_BUCKETS)
    moved.select(bucket.alias("bucket"), "offer_url", "body").write.partitionBy(
        "bucket", "offer_url"
    ).option("compression", "gzip").text(path)
    return path


def landed_load_services(spark: SparkSession, sf_dir: str) -> str:
    def land(path: str) -> str:
        newest = newest_orders(spark, sf_dir).select(
            offer_url(F.col("c_mktsegment"), F.col("n_name"), F.lit("20240115")).alias(
                "offer_url"
            ),
            offer_url(F.col("c_mktsegment"), F.col("n_name"), index_version()).alias(
                "current_url"
            ),
        )
        return _versioned(service_bodies(spark, sf_dir), newest, path)

    return once(spark, sf_dir, "load-services", land)


def landed_load_plans(spark: SparkSession, sf_dir: str) -> str:
    def land(path: str) -> str:
        newest = newest_plans(spark, sf_dir).select(
            plan_url(F.col("code"), F.col("n_name")).alias("offer_url"),
            F.concat(
                F.lit(f"{BASE_URL}/savingsPlan/v1.0/aws/"),
                F.concat_ws(
                    "/",
                    F.col("code"),
                    F.concat(F.lit("p"), _text("newest")),
                    F.col("n_name"),
                    F.lit("index.json"),
                ),
            ).alias("current_url"),
        )
        return _versioned(plan_bodies(spark, sf_dir), newest, path)

    return once(spark, sf_dir, "load-plans", land)
