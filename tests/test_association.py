"""Onsets of excursions and stops at each lag."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from shiftloom.operators.association import association, lag_counts

ZERO = datetime(2026, 1, 5)


def run(spark, onsets, stops, observed, **more):
    def frame(rows, columns):
        return spark.createDataFrame([(*r[:-1], ZERO + timedelta(minutes=r[-1])) for r in rows], columns)

    return lag_counts(
        frame(onsets, "line int, sensor string, t0 timestamp_ntz"),
        frame(stops, "line int, motive string, StartDate timestamp_ntz"),
        frame(observed, "line int, LocalTime timestamp_ntz"),
        "line", ["sensor"], ["motive"], width=60, **more,
    )


def test_every_lag_against_all_turns_of_the_train(spark):
    """The expected number is the mean over all circular shifts of the sensor's train."""
    pick = random.Random(5)
    n = 31
    observed = [(1, 0), (1, n - 1), (2, 7), (2, 7)]
    onsets = [(1, pick.choice("ab"), pick.randrange(n)) for _ in range(25)] + [(2, "a", 7), (3, "a", 1)]
    stops = [(1, pick.choice(["x", None]), pick.randrange(-3, n + 3)) for _ in range(30)] + [(2, "x", 7)]
    want = {}
    for line, size, start in ((1, n, 0), (2, 1, 7)):
        events = {(s, t - start) for ln, s, t in onsets if ln == line}
        halts = {(m, t - start) for ln, m, t in stops if ln == line and 0 <= t - start < size}
        for sensor in {s for s, _ in events}:
            for motive in {m for m, _ in halts}:
                a = {t for s, t in events if s == sensor}
                b = {t for m, t in halts if m == motive}
                for lag in range(-4, 10):
                    met = [sum(0 <= (t + turn) % size + lag < size and (t + turn) % size + lag in b for t in a) for turn in range(size)]
                    want[line, sensor, motive, lag] = (met[0], round(sum(met) / size, 9))
    got = {tuple(r)[:4]: (r.together, round(r.expected, 9)) for r in run(spark, onsets, stops, observed, first=-4, last=9).collect()}
    assert got == want


@pytest.mark.parametrize("first,last", [(0, 0), (3, 3), (-2, -1), (-40, 40)])
def test_each_pair_meets_once(spark, first, last):
    pick = random.Random(first)
    onsets = [(1, "a", t) for t in sorted(pick.sample(range(60), 20))]
    stops = [(1, "x", t) for t in sorted(pick.sample(range(60), 20))]
    got = Counter({r.lag: r.together for r in run(spark, onsets, stops, [(1, 0), (1, 59)], first=first, last=last).collect()})
    want = Counter(b - a for _, _, a in onsets for _, _, b in stops)
    assert got == Counter({lag: want[lag] for lag in range(first, last + 1)})
    assert len(got) == last - first + 1


def test_a_planted_lag_is_the_strongest(spark):
    pick = random.Random(1)
    times = sorted(pick.sample(range(0, 900, 3), 60))
    onsets = [(line, "hot", t) for line in (1, 2) for t in times] + [(1, "calm", t) for t in sorted(pick.sample(range(900), 60))]
    stops = [(line, "jam", t + 5) for line in (1, 2) for t in times] + [(1, "break", t) for t in range(0, 900, 90)]
    lags = run(spark, onsets, stops, [(1, 0), (1, 999), (2, 0), (2, 999)], first=0, last=8)
    found = {(r.sensor, r.motive): r for r in association(lags, ["sensor"], ["motive"]).collect()}
    best = found["hot", "jam"]
    assert (best.lag, best.together, best["rank"]) == (5, 120, 1)
    assert best.strength > 20 and found["calm", "jam"].strength < 5 and found["hot", "break"]["rank"] == 2


def test_empty_and_bad_ranges(spark):
    assert run(spark, [], [(1, "x", 1)], [(1, 0)]).count() == 0
    assert association(run(spark, [], [], []), ["sensor"], ["motive"]).count() == 0
    with pytest.raises(ValueError, match="lag"):
        run(spark, [], [], [], first=1, last=0)
