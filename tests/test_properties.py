"""Randomised checks of the cleaning operators against brute-force Python."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larder.operators.dedup import keep_first, later_duplicates
from larder.operators.impute import impute_group_mean
from larder.plans.inventory import IMPUTE_COLUMNS

KEY = ["ProductID", "WarehouseLocation", "SnapshotDate"]
DATES = [dt.date(2022, 1, 1), dt.date(2022, 2, 1)]

row = st.tuples(
    st.sampled_from([None, 1, 2]),
    st.sampled_from([None, "W1", "W2"]),
    st.sampled_from(DATES),
    st.one_of(st.none(), st.integers(-5, 50).map(float)),
    st.one_of(st.none(), st.integers(0, 50).map(float)),
)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def to_df(inv, rows):
    return inv([(i + 1, p, "n", w, a, d, day) for i, (p, w, day, a, d) in enumerate(rows)])


@SETTINGS
@given(st.lists(row, min_size=0, max_size=25))
def test_keep_first_matches_brute_force(inv, rows):
    df = to_df(inv, rows)
    first = {}
    for i, (p, w, day, _, _) in enumerate(rows):
        first.setdefault((p, w, day), i + 1)
    kept = sorted(r["SnapshotInvID"] for r in keep_first(df, KEY, ["SnapshotInvID"]).collect())
    assert kept == sorted(first.values())
    later = sorted(r["SnapshotInvID"] for r in later_duplicates(df, KEY, ["SnapshotInvID"]).collect())
    assert later == sorted(set(range(1, len(rows) + 1)) - set(first.values()))


@SETTINGS
@given(st.lists(row, min_size=0, max_size=25))
def test_impute_matches_brute_force(inv, rows):
    df = to_df(inv, rows)
    sums = defaultdict(lambda: [0.0, 0.0, 0])
    for p, _, _, a, d in rows:
        if p is not None and a is not None and d is not None:
            s = sums[p]
            s[0] += d
            s[1] += a
            s[2] += 1
    got = {r["SnapshotInvID"]: r for r in impute_group_mean(df, "ProductID", IMPUTE_COLUMNS).collect()}
    assert len(got) == len(rows)
    for i, (p, _, _, a, d) in enumerate(rows):
        r = got[i + 1]
        mean = sums.get(p) if p is not None else None
        want_d = d if d is not None else (mean[0] / mean[2] if mean else None)
        want_a = a if a is not None else (mean[1] / mean[2] if mean else None)
        for have, want in ((r["unitsDemanded"], want_d), (r["unitsAvailable"], want_a)):
            assert (have is None and want is None) or abs(have - want) < 1e-9
