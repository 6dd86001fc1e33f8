"""Membership through time against plain Python."""

import random
from datetime import datetime, timedelta

import pytest

from tickerloom.operators import membership

TYPES = ("symbol string, security string, gics_sector string, gics_sub_industry string, "
         "updated_at timestamp")
BEGIN = datetime(2020, 1, 28)


def run(n):
    return BEGIN + timedelta(days=3 * n)


def snapshots(spark, rows):
    return spark.createDataFrame(rows, TYPES)


def random_rows(seed, runs=25, symbols=6):
    rng = random.Random(seed)
    state = {f"S{i}": rng.random() < 0.6 for i in range(symbols)}
    sector = {s: "old" for s in state}
    rows = []
    for n in range(runs):
        for s in state:
            if rng.random() < 0.15:
                state[s] = not state[s]
            if rng.random() < 0.1:
                sector[s] = rng.choice(["old", "new", None])
            if state[s]:
                rows.append((s, f"{s} Inc", sector[s], "x", run(n)))
                if rng.random() < 0.2:
                    rows.append((s, f"{s} Inc", sector[s], "y", run(n)))    # a second, larger row
    return rows + [(None, "none", "a", "b", run(0)), ("S0", "no time", "a", "b", None)]


def least(rows):
    """(symbol, run): smallest attributes, of complete rows."""
    found = {}
    for symbol, *attributes, at in rows:
        if symbol is not None and at is not None:
            key = [(a is None, a or "") for a in attributes]
            if (symbol, at) not in found or key < found[symbol, at][0]:
                found[symbol, at] = key, tuple(attributes)
    return {k: v[1] for k, v in found.items()}


def brute_intervals(rows):
    held = least(rows)
    times = sorted({at for _, at in held})
    found = []
    for symbol in sorted({s for s, _ in held}):
        current = None
        for at in [*times, None]:
            now = held.get((symbol, at)) if at is not None else None
            if current and (at is None or now != current[0]):
                found.append((symbol, *current[0], current[1], at))
                current = None
            if now and not current:
                current = now, at
    return sorted(found, key=repr)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals(spark, seed):
    rows = random_rows(seed)
    assert content(membership.membership_intervals(snapshots(spark, rows))) == brute_intervals(rows)


def test_intervals_of_few_snapshots(spark):
    assert content(membership.membership_intervals(snapshots(spark, []))) == []
    one = [("A", "a", None, None, run(0)), ("A", "a", None, None, run(0))]
    assert content(membership.membership_intervals(snapshots(spark, one))) == [
        ("A", "a", None, None, run(0), None)]


def test_later_snapshots_change_nothing_before_them(spark):
    rows = random_rows(3)
    for n in (0, 7, 24):
        as_of = run(n) + timedelta(days=1)
        known = [r for r in rows if r[4] is not None and r[4] <= as_of]
        early = snapshots(spark, known)
        intervals = membership.membership_intervals(snapshots(spark, rows))
        held = least(known)
        members = sorted([(s, *held[s, at]) for s, at in held if at == run(n)], key=repr)
        assert content(membership.members_as_of(intervals, as_of)) == members
        assert content(membership.companies_as_of(intervals, as_of)) == content(
            membership.latest_company(early.filter("symbol is not null")))
        every = snapshots(spark, rows)
        for function in (membership.latest_company, membership.snapshot_times,
                         membership.latest_members, membership.previous_members,
                         membership.snapshot_diff, membership.new_members):
            assert content(function(every, as_of=as_of)) == content(function(early))
    assert content(membership.members_as_of(intervals, BEGIN - timedelta(days=1))) == []


@pytest.mark.parametrize("cuts", [(10,), (0, 1, 2, 24), (5, 11, 17)])
def test_extended_intervals_equal_a_build_from_all(spark, cuts):
    rows = [r for r in random_rows(4) if r[4] is not None]
    done = None
    for cut in [*cuts, 24]:
        known = snapshots(spark, [r for r in rows if r[4] <= run(cut)])
        if done is None:
            built = membership.membership_intervals(known)
        else:
            built = membership.extend_intervals(built, known, run(done))
        built = spark.createDataFrame(built.collect(), built.schema)
        done = cut
    assert content(built) == brute_intervals(rows)
