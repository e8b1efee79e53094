"""Repeated messages count once in every window and session."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.catalog import warehouse
from tidemark.session import prepare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("model", "column"), [("events_5m", "total_events"), ("session_metrics", "event_count")])
def test_windows_and_sessions_add_up_to_distinct_events(spark, model, column):
    w = warehouse(prepare(spark), SF)
    raw = w["events_raw"].agg(F.count("*"), F.count_distinct("event_id")).first()
    assert raw[0] > raw[1]  # the sample holds repeats
    assert w[model].agg(F.sum(column)).first()[0] == raw[1]
