"""Property tests for the custom distributed operators against direct
single-machine computations on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwheel.operators.metrics import auc, running_totals
from cartwheel.operators.skew import salted_counts
from cartwheel.streaming.ingest import resume_from

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 5)), min_size=1, max_size=60, unique_by=lambda t: t[0]),
       st.sampled_from([1, 2, 3, 8]))
def test_running_totals_equal_prefix_sums(spark, rows, buckets):
    df = spark.createDataFrame([(float(s), v) for s, v in rows], "s double, v int")
    got = {r.s: r.cum_v for r in running_totals(df, "s", ["v"], buckets).collect()}
    acc, want = 0, {}
    for s, v in sorted(rows, key=lambda t: -t[0]):
        acc += v
        want[float(s)] = acc
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 1)), min_size=2, max_size=80))
def test_auc_equals_trapezoid(spark, rows):
    if len({lab for _, lab in rows}) < 2:
        return
    df = spark.createDataFrame([(float(s), lab) for s, lab in rows], "score double, label int")
    got = auc(df, buckets=4).first()["auc"]
    p = sum(lab for _, lab in rows)
    n = len(rows) - p
    pts, tp, fp = [(0.0, 0.0)], 0, 0
    for s in sorted({s for s, _ in rows}, reverse=True):
        tp += sum(1 for x, lab in rows if x == s and lab == 1)
        fp += sum(1 for x, lab in rows if x == s and lab == 0)
        pts.append((fp / n, tp / p))
    want = sum((x1 - x0) * (y1 + y0) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))
    assert abs(got - want) < 1e-12


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=80),
       st.integers(1, 9))
def test_salted_counts_exact(spark, rows, buckets):
    df = spark.createDataFrame(rows, "k int, v int")
    got = {r.k: (r.rows, r.distinct_values) for r in salted_counts(df, "k", "v", buckets).collect()}
    want = {}
    for k, v in rows:
        want.setdefault(k, []).append(v)
    assert got == {k: (len(vs), len(set(vs))) for k, vs in want.items()}


@SETTINGS
@given(st.dictionaries(st.integers(0, 3), st.integers(0, 130), max_size=4),
       st.lists(st.integers(100, 120), min_size=1, max_size=30))
def test_resume_keeps_exactly_the_tail(spark, committed, offsets):
    log_rows = [("t", p, o, "") for p in range(4) for o in sorted(set(offsets))]
    log = spark.createDataFrame(log_rows, "topic string, partition int, offset long, value string")
    com = spark.createDataFrame([("t", p, c) for p, c in committed.items()] or [("x", 9, 0)],
                                "topic string, partition int, committed long")
    got = sorted((r.partition, r.offset) for r in resume_from(log, com, default="earliest", whole_topic=False).collect())
    low, high = min(offsets), max(offsets) + 1
    want = []
    for p in range(4):
        start = low if p not in committed else max(low, min(committed[p], high))
        want += [(p, o) for o in sorted(set(offsets)) if o >= start]
    assert got == sorted(want)
