"""Hand-made documents and a landing directory to put them in."""

import gzip
import json
import zlib
from pathlib import Path
from urllib.parse import quote

BASE = "https://prices.test"


def rate(price, code=None, **more):
    made = {
        "rateCode": code,
        "description": "d",
        "unit": "Hrs",
        "pricePerUnit": price if isinstance(price, dict) else {"USD": price},
    }
    return {k: v for k, v in {**made, **more}.items() if v is not None}


def term(rates, **more):
    return {
        "offerTermCode": "TERM0001",
        "effectiveDate": "2025-03-17T00:00:00Z",
        "termAttributes": {},
        "priceDimensions": rates,
        **more,
    }


def service_offer(products, on_demand, reserved=None, **more):
    return {
        "formatVersion": "v1.0",
        "offerCode": "Compute",
        "version": "20250401",
        "publicationDate": "2025-04-02T10:00:00Z",
        "products": products,
        "terms": {"OnDemand": on_demand, "Reserved": reserved or {}},
        **more,
    }


SAMPLE = service_offer(
    {
        "QUEUE7": {
            "sku": "QUEUE7",
            "productFamily": "Queues",
            "attributes": {"servicename": "Letter Box", "group": "fifo", "unitSize": "64KB"},
        },
        "DISK2": {"sku": "DISK2", "productFamily": "Disks", "attributes": {"iops": "300"}},
        "DISK9": {"sku": "DISK9", "productFamily": "Disks"},
        "IDLE": {"sku": "IDLE"},
    },
    {
        "QUEUE7": {
            "QUEUE7.OD": term(
                {
                    "QUEUE7.OD.a": rate("0.25", "QUEUE7.OD.a", beginRange="0", endRange="10"),
                    "QUEUE7.OD.b": rate("0.125", "QUEUE7.OD.b", beginRange="10", endRange="900.5"),
                    "QUEUE7.OD.c": rate("3E-7", "QUEUE7.OD.c", beginRange="900.5", endRange="Inf"),
                }
            )
        },
        "DISK9": {"DISK9.OD": term({"DISK9.OD.a": rate("12.5", "DISK9.OD.a", endRange="infinity")})},
    },
    {
        "DISK2": {
            "DISK2.RS": term(
                {
                    "DISK2.RS.up": rate("700", "DISK2.RS.up"),
                    "DISK2.RS.hr": rate("0.01", "DISK2.RS.hr"),
                },
                termAttributes={"LeaseContractLength": "3yr", "OfferingClass": "standard"},
            )
        }
    },
)


def url(service, region, version, kind="offers"):
    return f"{BASE}/{kind}/v1.0/{service}/{version}/{region}/index.json"


def land_document(root: Path, offer_url: str, document, *, name="doc", zipped=False):
    folder = root / f"offer_url={quote(offer_url, safe='.-_')}"
    folder.mkdir(parents=True, exist_ok=True)
    # Pretty-printed: a file is one document over several lines.
    data = document if isinstance(document, bytes) else json.dumps(document, indent=1).encode()
    path = folder / (f"{name}.json.gz" if zipped else f"{name}.json")
    path.write_bytes(gzip.compress(data) if zipped else data)


class Catalogue:
    """A price list on disk: master index, region indexes, documents."""

    def __init__(self, root: Path, buckets: int = 0):
        self.root = root
        self.buckets = buckets
        (root / "service").mkdir(parents=True)
        (root / "plan").mkdir()
        self.services: dict[str, dict[str, str]] = {}
        self.plans: dict[str, list] = {}
        self.issue = 0

    def folder(self, kind, at):
        if not self.buckets:
            return self.root / kind
        return self.root / kind / f"bucket={zlib.crc32(at.encode()) % self.buckets}"

    def offer(self, service, region, version, document):
        at = url(service, region, version)
        self.services.setdefault(service, {})[region] = at
        if document is not None:
            land_document(self.folder("service", at), at, document)

    def offer_plan(self, code, region, version, document):
        at = url(code, region, version, "savingsPlan")
        self.plans.setdefault(code, []).append({"regionCode": region, "versionUrl": at})
        land_document(self.folder("plan", at), at, document)

    def landing(self, corrupt=()):
        """Write the indexes as they are now and describe the landing."""
        from ratebook.plans.load import Landing
        from ratebook.sources.indexes import PLAN_INDEX_PATH

        self.issue += 1
        at = self.root / f"indexes-{self.issue}"
        at.mkdir()
        offers = {}
        indexes = {}
        for service, regions in self.services.items():
            path = f"/offers/v1.0/{service}/current/region_index.json"
            offers[service] = {"offerCode": service, "currentRegionIndexUrl": path}
            indexes[path] = {
                "regions": {r: {"regionCode": r, "currentVersionUrl": u} for r, u in regions.items()}
            }
        for code, regions in self.plans.items():
            indexes[PLAN_INDEX_PATH.format(code=code)] = {"regions": regions}
        (at / "master.json").write_text(json.dumps({"offers": offers}, indent=1))
        for path, index in indexes.items():
            folder = at / "regions" / f"index_path={quote(path, safe='.-_')}"
            folder.mkdir(parents=True)
            text = json.dumps(index, indent=1)
            broken = any(f"/{service}/" in path for service in corrupt)
            (folder / "index.json").write_text(text[: len(text) // 2] if broken else text)
        (at / "regions").mkdir(exist_ok=True)
        return Landing(
            master_index=str(at / "master.json"),
            region_indexes=str(at / "regions"),
            service_offers=str(self.root / "service"),
            plan_offers=str(self.root / "plan"),
            base_url=BASE,
            layout="file",
            buckets=self.buckets,
        )


def priced(price, sku="A", n=1):
    """A small document: `n` rates of one sku."""
    rates = {f"{sku}.T.{i}": rate(str(price), f"{sku}.T.{i}") for i in range(n)}
    return service_offer(
        {sku: {"sku": sku, "productFamily": "f", "attributes": {"k": "v"}}},
        {sku: {f"{sku}.T": term(rates)}},
    )


SHELL = service_offer({}, {})


def history_rows(spark, day, pairs):
    """One history row for each (service, region) pair."""
    from pyspark.sql import functions as F

    from ratebook import schemas

    rows = spark.createDataFrame(
        [(s, r, n) for n, (s, r) in enumerate(pairs)],
        "service_code string, region_code string, n int",
    )
    values = {
        "ingestion_date": F.lit(day),
        "service_code": F.col("service_code"),
        "region_code": F.col("region_code"),
        "version": F.lit("v1"),
        "offer_type": F.lit("service"),
        "sku": F.concat(F.lit("K"), F.col("n")),
        "rate_code": F.concat(F.lit("K"), F.col("n")),
        "ingested_at": F.lit(day).cast("timestamp"),
    }
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.HISTORY]
    )
