import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from turnwise.operators import sessions as S

T0 = dt.datetime(2024, 1, 1)
DDL = "event_id bigint, namespace string, user_id string, ts timestamp, force_new boolean, is_close boolean"


def events(spark, rows):
    return spark.createDataFrame(
        [(i, ns, u, T0 + dt.timedelta(seconds=s), f, c) for i, (ns, u, s, f, c) in enumerate(rows)], DDL)


def starts(spark, rows, **kw):
    out = S.sessionize(events(spark, rows), force_new=F.col("force_new"), close=F.col("is_close"), **kw)
    return {r.event_id: (r.session_no, r.session_id) for r in out.collect()}


@pytest.mark.parametrize("gap,sessions", [(119, 1), (120, 2), (121, 2)])
def test_timeout_boundary(spark, gap, sessions):
    got = starts(spark, [("n", "u", 0, False, False), ("n", "u", gap, False, False)])
    assert got[1][0] == sessions


def test_force_close_users_and_format(spark):
    got = starts(spark, [("n", "a", 0, False, False), ("n", "a", 5, True, False), ("n", "a", 6, False, True),
                         ("n", "a", 7, False, False), ("n", "b", 0, False, False), ("n", None, 1, False, False),
                         ("n", "", 2, False, False)])
    assert [got[i][0] for i in range(4)] == [1, 2, 2, 3]
    assert got[4][1] == "n-b-20240101-000000-000000"
    assert got[5][1].startswith("n-anonymous-") and got[5][1] == got[6][1]
    assert len(got[0][1].removeprefix("n-a-")) == 22


def brute(rows, timeout):
    """The rule, event by event."""
    out, state = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][2], i))
    for i in order:
        ns, user, at, force, close = rows[i]
        key = (ns, user or "anonymous")
        no, last, closed = state.get(key, (0, None, False))
        if last is None or force or closed or at - last >= timeout:
            no += 1
        out[i] = no
        state[key] = (no, at, close)
    return out


def test_random_against_brute_force(spark):
    rnd = random.Random(11)
    rows = [("n" + str(rnd.randrange(2)), "hot" if rnd.random() < 0.4 else rnd.choice("abc"), rnd.randrange(0, 20000) / 2,
             rnd.random() < 0.05, rnd.random() < 0.05) for _ in range(800)]
    want = brute(rows, 60)
    for block in (1, 60, 100000):
        got = starts(spark, rows, timeout=60, block_seconds=block)
        assert {i: n for i, (n, _) in got.items()} == want


def test_expiry_boundary_and_info(spark):
    df = events(spark, [("n", u, s, False, False) for u, s in (("a", 0), ("b", 1), ("c", 2))])
    table = S.sessions_table(S.sessionize(df))
    as_of = F.lit(T0 + dt.timedelta(seconds=121))
    assert {r.user_id for r in S.expired_sessions(table, as_of, 120).collect()} == {"a"}
    info = {r.user_id: (r.duration, r.inactive_for) for r in S.session_info(table, as_of, 120).collect()}
    assert info == {"b": (120.0, 120.0), "c": (119.0, 119.0)}
    assert {r.user_id for r in S.latest_sessions(table, as_of, 120).collect()} == {"c"}


def test_attach_session(spark):
    df = events(spark, [("n", "a", 0, False, False), ("n", "a", 50, False, False), ("n", "a", 500, False, False)])
    table = S.sessions_table(S.sessionize(df))
    probe = events(spark, [("n", "a", s, False, False) for s in (0, 25, 50, 51, 169, 170, 499, 500)])
    hit = {r.event_id: r.session_id is not None for r in S.attach_session(probe, table, bucket_seconds=30).collect()}
    assert hit == {0: True, 1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: True}
    open_until = {r.event_id: r.session_id is not None for r in S.attach_session(probe, table, timeout=120).collect()}
    assert open_until == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: True}


def test_attach_missing_users(spark):
    """Events without a user find the anonymous session, whatever stands for the missing name."""
    df = events(spark, [("n", None, 0, False, False), ("n", "", 50, False, False), (None, "a", 0, False, False)])
    table = S.sessions_table(S.sessionize(df).withColumns({"namespace": F.coalesce("namespace", F.lit(""))}))
    got = {r.event_id: r.session_id for r in S.attach_session(df, table).collect()}
    assert got[0] == got[1] and got[0].startswith("n-anonymous-") and got[2] is not None
