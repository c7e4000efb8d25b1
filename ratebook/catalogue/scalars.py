"""Scalar rules, applied to columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratebook.catalogue import adapters as A
from ratebook.catalogue import sql as S
from ratebook.catalogue.registry import query
from ratebook.functions import exprs as X
from ratebook.operators import upsert

_PARTS = "string_split(regexp_replace(url, '/+$', ''), '/')"
_VERSION = f"CASE WHEN len({_PARTS}) >= 3 THEN {_PARTS}[len({_PARTS}) - 2] ELSE '' END"


@query(f"SELECT page_id, {_VERSION} AS version FROM pages")
def version_from_url(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select(
        "page_id", X.version_from_url(F.col("url")).alias("version")
    )


def _path_or_url():
    """Absolute, rooted or relative by turns."""
    path = F.regexp_replace("url", "^https?://", "")
    return (
        F.when(F.col("page_id") % 3 == 0, F.col("url"))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("/"), path))
        .otherwise(path)
    )


@query(
    f"""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url
      ELSE '{S.BASE}/' || regexp_replace(url, '^https?://', '') END AS absolute_url
    FROM pages"""
)
def absolute_url(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select(
        "page_id", X.absolute_url(_path_or_url(), A.BASE_URL + "/").alias("absolute_url")
    )


@query(
    f"""SELECT page_id, regexp_replace(
      url || '--' || page_id || '--' || {_VERSION},
      '[^A-Za-z0-9._-]+', '_', 'g') AS object_name
    FROM pages"""
)
def safe_object_name(spark, sf_dir):
    name = X.safe_object_name(
        F.col("url"),
        F.col("page_id").cast("string"),
        X.version_from_url(F.col("url")),
    )
    return A.table(spark, sf_dir, "pages").select("page_id", name.alias("object_name"))


@query(
    """SELECT o_orderkey,
      CASE o_orderkey % 6 WHEN 0 THEN '0' WHEN 1 THEN '12.5' END AS starting_range,
      CASE WHEN o_orderkey % 5 > 2 THEN CAST(o_orderkey AS VARCHAR) END AS ending_range
    FROM orders"""
)
def normalise_range(spark, sf_dir):
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.normalise_range(A.begin_range()).alias("starting_range"),
        X.normalise_range(A.end_range()).alias("ending_range"),
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 2 THEN {S.PRICE_TEXT} END AS price,
      CASE o_orderkey % 7 WHEN 0 THEN 'CNY' WHEN 2 THEN NULL ELSE 'USD' END AS currency
    FROM orders"""
)
def pick_currency(spark, sf_dir):
    prices = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", A.price_map().alias("prices")
    )
    return prices.select(
        "o_orderkey",
        X.picked_price(F.col("prices")).alias("price"),
        X.picked_currency(F.col("prices")).alias("currency"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 4 <> 3
      THEN 'Service ' || c_mktsegment END AS service_name FROM customer"""
)
def service_name(spark, sf_dir):
    attributes = F.parse_json(F.to_json(A.customer_attributes()))
    return A.table(spark, sf_dir, "customer").select(
        "c_custkey", X.service_name(attributes).alias("service_name")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 5 > 2
      THEN '{"name":"' || c_name || '"}' END AS kept FROM customer"""
)
def json_empty_to_null(spark, sf_dir):
    bag = F.to_json(F.struct(F.col("c_name").alias("name")))
    text = F.coalesce(A._pick("c_custkey", 5, F.lit("{}"), F.lit("[]"), F.lit("null")), bag)
    kept = X.json_or_null(F.parse_json(text))
    return A.table(spark, sf_dir, "customer").select(
        "c_custkey", F.to_json(kept).alias("kept")
    )


@query(f"SELECT c_custkey, {S.EFFECTIVE} AS effective_date FROM customer")
def effective_date(spark, sf_dir):
    return A.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.date_format(X.effective_date(A.effective_text()), "yyyy-MM-dd").alias(
            "effective_date"
        ),
    )


@query(
    """SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(18, 2))
      AS DECIMAL(38, 18)) AS VARCHAR) AS price FROM orders"""
)
def exact_decimal_price(spark, sf_dir):
    """All 38 digits as text: a price that was ever a double shows."""
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", X.exact_price(A.price_text()).cast("string").alias("price")
    )


@query(
    """SELECT event_id, json_extract_string(props, '$.k') AS k,
      CAST(NULL AS VARCHAR) AS object_path, json_extract_string(props, '$.k') AS deep_path,
      CAST(NULL AS VARCHAR) AS absent
    FROM events"""
)
def json_value(spark, sf_dir):
    wrapped = F.concat(F.lit('{"outer": '), F.col("props"), F.lit("}"))
    return (
        A.table(spark, sf_dir, "events")
        .select(
            "event_id",
            F.parse_json("props").alias("flat"),
            F.parse_json(wrapped).alias("nested"),
        )
        .select(
            "event_id",
            X.json_value(F.col("flat"), "$.k").alias("k"),
            X.json_value(F.col("nested"), "$.outer").alias("object_path"),
            X.json_value(F.col("nested"), "$.outer.k").alias("deep_path"),
            X.json_value(F.col("flat"), "$.none").alias("absent"),
        )
    )


@query(
    """SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys
    FROM events"""
)
def json_keys(spark, sf_dir):
    keys = X.json_keys(F.parse_json("props"))
    return A.table(spark, sf_dir, "events").select(
        "event_id", F.array_join(F.sort_array(keys), ",").alias("keys")
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 IN (0, 1) THEN o_orderpriority
      ELSE 'RC' || o_orderkey END AS rate_code FROM orders"""
)
def rate_code_fallback(spark, sf_dir):
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.rate_code(A.rate_code_text(), F.col("o_orderpriority")).alias("rate_code"),
    )


@query(
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'target'
      WHEN 1 THEN o_orderpriority ELSE '' END AS version FROM orders"""
)
def version_fallback(spark, sf_dir):
    target = A._pick("o_orderkey", 4, F.lit("target"), F.lit(""), F.lit(""))
    document = A._pick(
        "o_orderkey", 4, F.lit("not used"), F.col("o_orderpriority"), F.lit("")
    )
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", X.effective_version(target, document).alias("version")
    )


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'rate ' || o_orderkey
      ELSE o_orderpriority END AS description FROM orders"""
)
def description_fallback(spark, sf_dir):
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.description(A.rate_description(), F.col("o_orderpriority")).alias("description"),
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN 'year' END AS lease_unit,
      CASE WHEN c_custkey % 6 <> 0 THEN '1' END AS lease_duration,
      CASE WHEN c_custkey % 4 <> 0 THEN 'plan of ' || c_name END AS description,
      'description,effectiveDate,leaseContractLength' AS members
    FROM customer"""
)
def plan_term_attributes(spark, sf_dir):
    terms = A.table(spark, sf_dir, "customer").select(
        "c_custkey",
        X.plan_term_attributes(
            F.parse_json(F.to_json(A.lease())), A.plan_description(), A.effective_text()
        ).alias("terms"),
    )
    terms_column = F.col("terms")
    return terms.select(
        "c_custkey",
        X.json_value(terms_column, "$.leaseContractLength.unit").alias("lease_unit"),
        X.json_value(terms_column, "$.leaseContractLength.duration").alias(
            "lease_duration"
        ),
        X.json_value(terms_column, "$.description").alias("description"),
        F.array_join(F.sort_array(X.json_keys(terms_column)), ",").alias("members"),
    )


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 8 <> 0
      THEN '{{"USD":"' || {S.PRICE_TEXT} || '"}}' END AS raw FROM orders"""
)
def plan_raw_price(spark, sf_dir):
    price = A._nonzero("o_orderkey", 8, A.price_text())
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_json(X.plan_raw_price(price)).alias("raw")
    )


@query(
    """SELECT event_id, left(CASE WHEN event_id % 4 <> 0 THEN repeat(props, 1000)
      ELSE '' END, 8000) AS error FROM events"""
)
def error_truncate(spark, sf_dir):
    error = F.when(F.col("event_id") % 4 != 0, F.repeat("props", F.lit(1000)))
    return A.table(spark, sf_dir, "events").select(
        "event_id", X.error_text(error).alias("error")
    )


@query(
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS published FROM orders"
)
def publication_ts(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    stamp = X.publication_ts(text)
    return A.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("published")
    )


_FIELDS = ["service_code", "region_code", "offer_type", "version", "offer_url"]


@query(
    """SELECT c_mktsegment AS service_code, CAST(c_nationkey AS VARCHAR) AS region_code,
      'service' AS offer_type, c_name AS version, 'first' AS offer_url FROM customer
    UNION ALL
    SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR), 'service', c_name, 'second'
    FROM customer"""
)
def delimited_lines_to_rows(spark, sf_dir):
    def line(last: str):
        return F.concat_ws(
            "|",
            "c_mktsegment",
            F.col("c_nationkey").cast("string"),
            F.lit("service"),
            "c_name",
            F.lit(last),
        )

    text = A.table(spark, sf_dir, "customer").select(
        F.concat_ws("\n", line("first"), F.lit(""), line("second"), F.lit("")).alias("text")
    )
    return upsert.delimited_lines_to_rows(text, "text", _FIELDS)
