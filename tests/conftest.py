import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice.operators.enrich import Lookup
from sluice.plans.ingest import FileSource, ingest
from sluice.session import build_session
from sluice.sources.config import read_layout_mappings, read_product_configs
from sluice.sources.events import open_envelopes
from sluice.sources.zones import Lake

CLOCK = "2027-11-09T08:00:00+00:00"
DOMAIN_FIELDS = ["transaction_id", "customer_id", "amount", "transaction_date"]
ORDERS_CSV = "pedido_id,cliente_id,valor_total,data_pedido\n7301,ana,48.25,2027-11-08\n7302,rui,12.75,2027-11-08\n"
PAYMENTS_CSV = (
    "pagamento_id,cliente,valor,data_pagamento\nTX70,ana,48.25,2027-11-08\nTX71,rui,12.75,2027-11-08\n"
)
INVOICES_CSV = "invoice_id,customer_id,total,issued_at\nbill-5,ana,48.25,2027-11-08\n"
LAYOUTS = {
    "orders": ["pedido_id", "cliente_id", "valor_total", "data_pedido"],
    "payments": ["pagamento_id", "cliente", "valor", "data_pagamento"],
}


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def product(percent=1.0, count=1000, **changes):
    config = {
        "domain": "transaction",
        "mapping_key": "de-para/orders-transaction.json",
        "publish": {"destinations": ["billing-events", "analytics-events"]},
        "rejection_policy": {
            "max_error_percent": percent,
            "max_error_count": count,
            "destinations": ["data-quality-events"],
        },
    }
    return {**config, **changes}


class Bench:
    """A source root, configs, mappings and a lake in a temporary folder."""

    def __init__(self, spark, root: Path):
        self.spark, self.root = spark, root
        self.source = root / "source"
        self.events_dir = root / "events"
        self.events_dir.mkdir()
        self.mappings_dir = root / "mappings"
        self.mappings_dir.mkdir()
        for name, fields in LAYOUTS.items():
            self.mapping(name, dict(zip(fields, DOMAIN_FIELDS)))
        self.config(orders=product(), payments=product(mapping_key="de-para/payments-transaction.json"))
        self.lake = Lake(spark, str(root / "lake"))

    def mapping(self, name, layout, required=DOMAIN_FIELDS, domain="transaction"):
        doc = {"domain": domain, "domain_required_fields": list(required), "layout_mapping": layout}
        (self.mappings_dir / f"{name}-transaction.json").write_text(json.dumps(doc))

    def config(self, **products):
        (self.root / "products.json").write_text(json.dumps({"products": products}, indent=2))

    def put(self, product_name, file_name, content):
        path = self.source / product_name / file_name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode())

    def configs(self):
        return read_product_configs(self.spark, str(self.root / "products.json"))

    def mappings(self):
        return read_layout_mappings(self.spark, str(self.mappings_dir))

    def reference(self, *customers):
        return [Lookup(self.spark.createDataFrame([(c,) for c in customers], "customer_id string"))]

    def ingest(self, *events, **options):
        messages = self.spark.createDataFrame([(json.dumps(e) if isinstance(e, dict) else e,) for e in events], "value string")
        return ingest(
            self.lake,
            open_envelopes(messages),
            self.configs(),
            self.mappings(),
            FileSource(str(self.source)),
            F.lit(options.pop("clock", CLOCK)),
            **options,
        )

    def rows(self, table, *columns, order=None):
        df = self.lake.read(table)
        df = df.select(*columns) if columns else df
        return [r.asDict() for r in df.orderBy(*(order or columns or df.columns)).collect()]


def event(product_name="orders", day="2027-11-08", **more):
    return {"product": product_name, "file_name": f"{product_name}-{day}.csv", "business_date": day, **more}


@pytest.fixture
def bench(spark, tmp_path):
    return Bench(spark, tmp_path)
