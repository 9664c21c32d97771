"""Stages of the mart that do not need each other are stored at the same time."""

import threading

from holdfast.plans import bindings
from holdfast.plans.mart import Mart


def test_customers_and_telemetry_are_stored_at_the_same_time(spark, raw_frame, kpi_frame, monkeypatch):
    meet = threading.Barrier(2, timeout=60)
    monkeypatch.setattr(bindings, "raw_feed", lambda t: (meet.wait(), raw_frame())[1])
    monkeypatch.setattr(bindings, "telemetry", lambda t: (meet.wait(), kpi_frame(["K-17", "K-58"]))[1])
    m = Mart(spark, "/nowhere")
    assert {r["customer_id"]: r["kpi_months"] for r in m.features.collect()} == {"K-17": 12, "K-23": 0, "K-58": 12}
    monthly = m.star["fact_network_monthly"]
    assert monthly.count() == 24 and monthly.select("customer_key").distinct().count() == 2
