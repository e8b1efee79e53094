import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import rows, ts
from tidemark.operators import sessions

START = ts("2024-01-01 10:07:00")
GAP = dt.timedelta(minutes=30)
PAGES = ("home", "department", "category", "product")


def frame(spark, events):
    """(session, seconds after START, event id, type, page, category) per event."""
    return spark.createDataFrame(
        [
            (s, START + dt.timedelta(seconds=sec), i, i % 5, f"src{i % 3}", "IE", kind, page, cat)
            for s, sec, i, kind, page, cat in events
        ],
        "session_id string, event_timestamp timestamp, event_id long, user_id long, traffic_source string, browser string,"
        " event_type string, page_type string, product_category string",
    )


def brute(events, cap=None):
    """Sessions by definition: sort, cut where the silence reaches the gap."""
    result = []
    by_id = {}
    for s, sec, i, kind, page, cat in events:
        by_id.setdefault(s, []).append((START + dt.timedelta(seconds=sec), i, kind, page, cat))
    for s, visits in by_id.items():
        visits.sort(key=lambda v: v[:2])
        groups = [[visits[0]]]
        for visit in visits[1:]:
            if visit[0] - groups[-1][-1][0] < GAP:
                groups[-1].append(visit)
            else:
                groups.append([visit])
        for group in groups:
            group = group[:cap]
            counts = Counter(v[4] for v in group if v[4])
            top = max(counts, key=lambda c: (counts[c], -min(v[0] for v in group if v[4] == c).timestamp())) if counts else None
            result.append(
                (
                    s, group[0][0], group[-1][0], len(group), sum(v[3] in PAGES for v in group),
                    sum(v[2] == "purchase" for v in group), group[0][1] % 5, top,
                )
            )
    return sorted(result)


def found(spark, events, **options):
    metrics = sessions.sessions(frame(spark, events), F.col("session_end"), **options)
    return sorted(
        rows(
            metrics.select(
                "session_id", "session_start", "session_end", "event_count", "pageview_count", "purchase_count",
                "user_id", "top_category",
            )
        )
    )


def visit(sec, i=None, cat=None, session="s"):
    return (session, sec, sec if i is None else i, "product", "product", cat)


def test_gap_edges(spark):
    for silence, expected in ((1799, 1), (1800, 2), (1801, 2)):
        assert len(found(spark, [visit(0), visit(silence)])) == expected


def test_one_id_in_two_windows(spark):
    frame_ = frame(spark, [visit(0), visit(60), visit(7200)])
    versions = sessions.sessions(frame_, F.col("session_end"))
    assert versions.count() == 2
    assert rows(sessions.session_metrics_latest(versions).select("event_count")) == [(1,)]
    assert sessions.session_window_latest(versions).count() == 2


def test_tied_categories_go_to_the_first_seen(spark):
    events = [visit(0, 1, "b"), visit(5, 2, "a"), visit(9, 3, "a"), visit(12, 4, "b"), visit(20, 5, None)]
    assert found(spark, events)[0][-1] == "b"


def _random_events(n, ids, span, seed):
    rng = random.Random(seed)
    kinds, pages = ("product", "cart", "purchase", "home"), PAGES + ("cart", "unknown")
    return [
        (f"s{rng.choice(ids)}", rng.randrange(span), i, rng.choice(kinds), rng.choice(pages), rng.choice((None, "a", "b", "c")))
        for i in range(n)
    ]


def test_against_definition_with_one_hot_session(spark):
    events = _random_events(1500, [0] * 20 + list(range(1, 40)), 200_000, seed=1)
    distinct_times = list({(e[0], e[1]): e for e in events}.values())
    assert found(spark, distinct_times) == brute(distinct_times)


def test_whole_sessions_by_default(spark):
    events = [visit(i % 1700, i) for i in range(6000)]
    assert found(spark, events)[0][3] == 6000
