"""Quarantined rows, corrected and entered into the ledger once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from tickerloom.sources import commits, delimited, ledger, replay, routing

FIX = ("row_id string, ticker string, date string, adj_close string, dividends string, "
       "corrected_at timestamp")


@pytest.fixture
def places(spark, tmp_path):
    """A folder of two files, routed, its good rows committed as 0."""
    source = tmp_path / "tape"
    source.mkdir()
    (source / "a.csv").write_text(
        "Date,Ticker,Adj Close,Dividends\n2024-01-02,AAA,1.0,0\nbad,AAA,2.0,0\n"
        "bad,AAA,2.0,0\n2024-01-04,BBB,oops,0\n2024-01-05,CCC,4.0\n")
    path, folder = str(tmp_path / "ledger"), str(tmp_path / "replays")
    routed = str(tmp_path / "routed")
    routing.write_routed(routing.route(delimited.read_tape(spark, str(source))), routed)
    ledger.append(routing.read_route(spark, routed, routing.ACCEPTED), path, 0)
    return path, folder, routing.read_route(spark, routed, routing.QUARANTINED)


def rows(spark, path):
    return sorted((r["ticker"], str(r["date"])[:10], r["adj_close"], r["dividends"])
                  for r in ledger.read_current(spark, path).collect())


def fixes(spark, refused, *wanted):
    """Corrections by a piece of the refused text."""
    ids = {r["raw_row"]: r["row_id"] for r in replay.identified(refused).collect()}
    found = []
    for piece, fields, day in wanted:
        row_id = next((i for text, i in ids.items() if piece in text), piece)
        found.append((row_id, *fields, datetime(2024, 2, day)))
    return spark.createDataFrame(found, FIX)


def test_replayed_twice_is_there_once(spark, places):
    path, folder, refused = places
    assert replay.waiting(spark, refused, folder).count() == 4
    given = fixes(spark, refused, ('"bad"', ("AAA", "2024-01-03", "2.0", "0"), 1),
                  ("oops", ("BBB", "2024-01-04", "still", "0"), 1),
                  ("no such row", ("ZZZ", "2024-01-04", "1", "0"), 1))
    expected = [("AAA", "2024-01-02", 1.0, 0.0), ("AAA", "2024-01-03", 2.0, 0.0)]
    replay.enter(refused, given, path, folder, 1)
    assert rows(spark, path) == expected
    assert [r["reason"] for r in replay.refused_again(spark, folder, 1).collect()] == ["bad price"]
    replay.enter(refused, given, path, folder, 1)
    replay.enter(refused, given, path, folder, 2)
    assert rows(spark, path) == expected
    assert ledger.changes(spark, path, 2).count() == 0
    left = replay.waiting(spark, refused, folder).collect()      # both copies are closed
    assert sorted(r["reason"] for r in left) == ["bad price", "malformed line"]


def test_newest_correction_counts_and_closes_the_row(spark, places):
    path, folder, refused = places
    given = fixes(spark, refused, ("oops", ("BBB", "2024-01-04", "5", "0"), 1),
                  ("oops", ("BBB", "2024-01-04", "6", None), 2),
                  ("CCC", ("CCC", "2024-01-05", "4", "0.5"), 1))
    replay.enter(refused, given, path, folder, 1)
    expected = [("AAA", "2024-01-02", 1.0, 0.0), ("BBB", "2024-01-04", 6.0, None),
                ("CCC", "2024-01-05", 4.0, 0.5)]
    assert rows(spark, path) == expected
    late = fixes(spark, refused, ("oops", ("BBB", "2024-01-04", "7", "0"), 9))
    replay.enter(refused, late, path, folder, 2)
    assert rows(spark, path) == expected


def test_newer_file_wins_over_a_correction_of_an_older_one(spark, places):
    path, folder, refused = places
    rank = refused.agg(F.min("source_rank")).first()[0]
    newer = spark.createDataFrame(
        [("AAA", datetime(2024, 1, 3), 8.0, 0.0, rank - 10)],
        "ticker string, date timestamp, adj_close double, dividends double, source_rank long")
    ledger.append(newer, path, 1)
    given = fixes(spark, refused, ('"bad"', ("AAA", "2024-01-03", "2.0", "0"), 1))
    replay.enter(refused, given, path, folder, 2)
    assert ("AAA", "2024-01-03", 8.0, 0.0) in rows(spark, path)


@pytest.mark.parametrize("stop", ["before the commit", "before the mark"])
def test_replay_that_failed_is_run_again(spark, places, monkeypatch, stop):
    path, folder, refused = places
    given = fixes(spark, refused, ('"bad"', ("AAA", "2024-01-03", "2.0", "0"), 1))

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        if stop == "before the commit":
            broken.setattr(ledger, "append", fail)
        else:
            broken.setattr(replay, "write_text", fail)
        with pytest.raises(OSError):
            replay.enter(refused, given, path, folder, 1)
    assert commits.is_committed(spark, path, 1) == (stop == "before the mark")
    assert replay.entered(spark, folder).count() == 0
    replay.enter(refused, given, path, folder, 1)
    assert ("AAA", "2024-01-03", 2.0, 0.0) in rows(spark, path)
    assert replay.entered(spark, folder).count() == 1


def test_without_rows_or_ranks(spark, places):
    path, folder, refused = places
    replay.enter(refused, spark.createDataFrame([], FIX), path, folder, 1)
    assert rows(spark, path) == [("AAA", "2024-01-02", 1.0, 0.0)]
    plain = refused.drop("source_rank")
    given = fixes(spark, plain, ("oops", ("BBB", "2024-01-04", "5", "0"), 1))
    found = replay.corrected(plain, given).collect()
    assert [(r["ticker"], r["adj_close"], r["source_rank"]) for r in found] == [("BBB", 5.0, None)]
