import json
from datetime import date, datetime, timezone
from decimal import Decimal

import docs
import pytest
from pyspark.sql import functions as F

from ratebook import schemas
from ratebook.operators import flatten
from ratebook.operators.keys import written_keys
from ratebook.sources import offers

STAMP = {"run_date": date(2025, 5, 1), "ingested_at": datetime(2025, 5, 1, tzinfo=timezone.utc)}
HOME = docs.url("S", "r1", "20250401")


def targets(spark, tmp_path, *rows):
    rows = rows or (("S", "r1", "service", "20250401", HOME),)
    frame = spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in schemas.TARGET))
    return written_keys(frame, str(tmp_path / "targets")).frame


def flat(spark, tmp_path, wanted=None, layout="file", include_reserved=True):
    read = offers.read_service_offers(
        spark, str(tmp_path / "landing"), layout=layout, include_reserved=include_reserved
    )
    wanted = targets(spark, tmp_path) if wanted is None else wanted
    return flatten.flatten_service_offers(
        offers.of_targets(read, wanted), include_reserved=include_reserved, **STAMP
    )


def plain(rows):
    """Rows as text: variants cannot be collected side by side."""
    return sorted(
        rows.withColumn("attributes", F.to_json("attributes"))
        .withColumn("term_attributes", F.to_json("term_attributes"))
        .collect(),
        key=lambda r: (r.rate_code or "", str(r.price_per_unit)),
    )


def test_sample_document(spark, tmp_path):
    docs.land_document(tmp_path / "landing", HOME, docs.SAMPLE)
    rows = {r.rate_code: r for r in plain(flat(spark, tmp_path))}
    assert len(rows) == 6 and not any(code.startswith("IDLE") for code in rows)
    assert rows["QUEUE7.OD.c"].price_per_unit == Decimal("0.0000003")
    tiers = [(rows[f"QUEUE7.OD.{t}"].starting_range, rows[f"QUEUE7.OD.{t}"].ending_range) for t in "abc"]
    assert tiers == [(0, 10), (10, Decimal("900.5")), (Decimal("900.5"), None)]
    queue = rows["QUEUE7.OD.a"]
    assert json.loads(queue.attributes)["group"] == "fifo" and queue.service_name == "Letter Box"
    assert (queue.effective_date, queue.offer_term_code) == (date(2025, 3, 17), "TERM0001")
    assert (queue.currency, queue.price_per_unit_raw) == ("USD", {"USD": "0.25"})
    assert queue.ingestion_date == date(2025, 5, 1)
    disk = rows["DISK9.OD.a"]
    assert (disk.product_family, disk.attributes, disk.ending_range) == ("Disks", None, None)
    for part in ("up", "hr"):
        reserved = rows[f"DISK2.RS.{part}"]
        assert reserved.term_type == "Reserved" and json.loads(reserved.attributes) == {"iops": "300"}
        assert json.loads(reserved.term_attributes)["OfferingClass"] == "standard"
    for row in rows.values():
        assert all(row[c] is not None for c in schemas.REQUIRED_HISTORY)


def test_reserved_is_optional(spark, tmp_path):
    docs.land_document(tmp_path / "landing", HOME, docs.SAMPLE)
    rows = flat(spark, tmp_path, include_reserved=False)
    assert rows.count() == 4
    assert {r.term_type for r in rows.select("term_type").distinct().collect()} == {"OnDemand"}


def test_gzip_and_lines_equal_plain(spark, tmp_path):
    for kind in ("plain", "zipped", "lines"):
        (tmp_path / kind).mkdir()
    docs.land_document(tmp_path / "plain/landing", HOME, docs.SAMPLE)
    docs.land_document(tmp_path / "zipped/landing", HOME, docs.SAMPLE, zipped=True)
    line = json.dumps(docs.SAMPLE).encode() + b"\n"
    docs.land_document(tmp_path / "lines/landing", HOME, line)
    expected = plain(flat(spark, tmp_path / "plain"))
    assert plain(flat(spark, tmp_path / "zipped")) == expected
    assert plain(flat(spark, tmp_path / "lines", layout="lines")) == expected


def test_slices_equal_the_whole_document(spark, tmp_path):
    """One line per sku and bucket, each with its own products."""
    slices = []
    for bucket in ("OnDemand", "Reserved"):
        for sku, terms in docs.SAMPLE["terms"][bucket].items():
            one = {**docs.SAMPLE, "slice": len(slices), "terms": {bucket: {sku: terms}}}
            one["products"] = {sku: docs.SAMPLE["products"][sku]}
            slices.append(json.dumps(one))
    docs.land_document(tmp_path / "whole/landing", HOME, docs.SAMPLE)
    docs.land_document(tmp_path / "cut/landing", HOME, "\n".join(slices).encode())
    assert plain(flat(spark, tmp_path / "cut", layout="lines")) == plain(
        flat(spark, tmp_path / "whole")
    )


def test_edges(spark, tmp_path):
    document = docs.service_offer(
        {"NOATTR": {"sku": "NOATTR"}, "EMPTY": {"sku": "EMPTY", "attributes": {}}},
        {
            "NOATTR": {"NOATTR.T": {"priceDimensions": {"r": docs.rate({"CNY": "7"})}}},
            "EMPTY": {"EMPTY.T": docs.term({"r": docs.rate({}, "")})},
            "ORPHAN": {"ORPHAN.T": docs.term({"r": docs.rate("3", "ORPHAN.T.r")})},
            "NORATES": {"NORATES.T": docs.term({})},
        },
    )
    docs.land_document(tmp_path / "landing", HOME, document)
    rows = {r.sku: r for r in plain(flat(spark, tmp_path))}
    assert sorted(rows) == ["EMPTY", "NOATTR", "ORPHAN"]
    cny = rows["NOATTR"]
    assert (cny.price_per_unit, cny.currency) == (7, "CNY")
    assert cny.price_per_unit_raw == {"CNY": "7"}
    assert cny.attributes is None and cny.term_attributes is None
    assert cny.rate_code == "NOATTR.T" and cny.effective_date is None
    empty = rows["EMPTY"]
    assert (empty.price_per_unit, empty.currency, empty.price_per_unit_raw) == (None, None, None)
    assert empty.attributes is None and empty.rate_code == "EMPTY.T"
    assert rows["ORPHAN"].product_family is None and rows["ORPHAN"].price_per_unit == 3


def test_repeated_product_last_one_counts(spark, tmp_path):
    text = json.dumps(docs.priced(1)).replace(
        '"products": {', '"products": {"A": {"productFamily": "stale", "attributes": {"k": "old"}}, '
    )
    docs.land_document(tmp_path / "landing", HOME, text.encode())
    (row,) = plain(flat(spark, tmp_path))
    assert row.product_family == "f" and json.loads(row.attributes) == {"k": "v"}


def test_repeated_members_last_one_counts(spark, tmp_path):
    text = (
        json.dumps(docs.priced(1))
        .replace('"pricePerUnit": {', '"pricePerUnit": {"USD": "77", ')
        .replace('"priceDimensions": {', '"priceDimensions": {"A.T.0": {"rateCode": "stale"}, ')
    )
    docs.land_document(tmp_path / "landing", HOME, text.encode())
    (row,) = plain(flat(spark, tmp_path))
    assert (row.rate_code, row.price_per_unit) == ("A.T.0", 1)
    assert row.price_per_unit_raw == {"USD": "1"}


def test_documents_do_not_share_products(spark, tmp_path):
    """The same sku in two documents, only one of which describes it."""
    bare = {**docs.priced(2), "products": {}}
    other = docs.url("S", "r2", "20250401")
    docs.land_document(tmp_path / "landing", HOME, docs.priced(1))
    docs.land_document(tmp_path / "landing", other, bare)
    wanted = targets(
        spark,
        tmp_path,
        ("S", "r1", "service", "20250401", HOME),
        ("S", "r2", "service", "", other),
    )
    rows = {r.region_code: r for r in plain(flat(spark, tmp_path, wanted))}
    assert rows["r1"].product_family == "f" and rows["r2"].product_family is None
    # No version of its own: the document's.
    assert rows["r2"].version == "20250401"


def test_only_targets_are_read(spark, tmp_path):
    """A broken document that is not a target is never opened."""
    docs.land_document(tmp_path / "landing", HOME, docs.priced(1))
    docs.land_document(tmp_path / "landing", docs.url("S", "r9", "1"), b'{"products": {')
    assert flat(spark, tmp_path).count() == 1


def test_unreadable_document_fails(spark, tmp_path):
    docs.land_document(tmp_path / "landing", HOME, b'{"products": {"A": ')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        flat(spark, tmp_path).count()


def plan_document(products):
    plan = {
        "sku": "P1",
        "description": "plan text",
        "effectiveDate": "2025-04-01T00:00:00Z",
        "leaseContractLength": {"duration": 1, "unit": "year"},
        "rates": [
            {
                "rateCode": "P1.1",
                "description": "rate text",
                "unit": "not this",
                "discountedRate": {"price": "0.05", "unit": "Hrs"},
            },
            {"rateCode": "P1.2", "discountedRate": None},
        ],
    }
    return {
        "version": "20250401",
        "publicationDate": "2025-04-02T10:00:00Z",
        "products": products,
        "terms": {
            "savingsPlan": [
                plan,
                {"sku": "", "rates": [{"rateCode": "lost"}]},
                {"rates": [{"rateCode": "lost"}]},
                {"sku": "P2", "rates": None},
                {"sku": "P3", "effectiveDate": "", "rates": [{"rateCode": "P3.1"}]},
            ]
        },
    }


PRODUCT = {"sku": "P1", "productFamily": "plans", "attributes": {"serviceName": "Plans"}}


@pytest.mark.parametrize(
    "products",
    [
        [{"sku": "P1", "productFamily": "stale"}, PRODUCT, {"productFamily": "nameless"}],
        {"P1": PRODUCT},
        None,
        [],
        {},
    ],
)
def test_plan_documents(spark, tmp_path, products):
    at = docs.url("Plan", "r1", "20250401", "savingsPlan")
    docs.land_document(tmp_path / "landing", at, plan_document(products))
    read = offers.read_plan_offers(spark, str(tmp_path / "landing"), layout="file")
    wanted = targets(spark, tmp_path, ("Plan", "r1", "savings_plan", "20250401", at))
    flat_rows = flatten.flatten_plan_offers(offers.of_targets(read, wanted), **STAMP)
    rows = {r.rate_code: r for r in plain(flat_rows)}
    assert sorted(rows) == ["P1.1", "P1.2", "P3.1"]
    full = rows["P1.1"]
    assert (full.price_per_unit, full.currency, full.unit) == (Decimal("0.05"), "USD", "Hrs")
    assert full.description == "rate text" and full.term_type == "SavingsPlan"
    assert full.price_per_unit_raw == {"USD": "0.05"} and full.offer_term_code is None
    assert json.loads(full.term_attributes) == {
        "leaseContractLength": {"duration": 1, "unit": "year"},
        "description": "plan text",
        "effectiveDate": "2025-04-01T00:00:00Z",
    }
    assert full.product_family == ("plans" if products else None)
    assert full.service_name == ("Plans" if products else None)
    bare = rows["P1.2"]
    assert (bare.price_per_unit, bare.currency, bare.unit) == (None, "USD", None)
    assert bare.price_per_unit_raw is None and bare.description == "plan text"
    assert json.loads(rows["P3.1"].term_attributes)["leaseContractLength"] == {}
    assert rows["P3.1"].effective_date is None


def test_headers(spark, tmp_path):
    docs.land_document(tmp_path / "landing", HOME, docs.SAMPLE)
    (row,) = offers.read_offer_headers(spark, str(tmp_path / "landing"), layout="file").collect()
    assert (row.version, row.offerCode, row.offer_url) == ("20250401", "Compute", HOME)


def test_empty_targets_and_counts(spark, tmp_path):
    other = docs.url("S", "r2", "1")
    docs.land_document(tmp_path / "landing", HOME, docs.priced(1, n=5))
    docs.land_document(tmp_path / "landing", other, docs.SHELL)
    wanted = targets(
        spark,
        tmp_path,
        ("S", "r1", "service", "20250401", HOME),
        ("S", "r2", "service", "1", other),
    )
    rows = flat(spark, tmp_path, wanted)
    assert [r.rows_loaded for r in flatten.rows_per_target(rows).collect()] == [5]
    assert [r.region_code for r in flatten.empty_targets(wanted, rows).collect()] == ["r2"]
