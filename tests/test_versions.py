"""Versions: two writers, crashes, checks."""

import threading

import pytest
from frames import values

from civitas.operators import generations as g
from civitas.sources import sinks
from civitas.sources.versions import Versions


def test_versions_follow_each_other(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/t")
    assert table.latest() is None and table.read() is None
    assert [table.put(lambda _, n=n: spark.range(n)) for n in (1, 2, 3)] == [0, 1, 2]
    assert table.read().count() == 3
    assert table.put(lambda now: now.union(now)) == 3 and table.read().count() == 6


def test_a_number_is_claimed_once(spark, tmp_path):
    table = Versions(spark, f"{tmp_path}/t")
    table.put(lambda _: spark.range(1))
    won = []
    threads = [threading.Thread(target=lambda n=n: won.append((table.claim(1, f"x{n}"), f"x{n}"))) for n in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [name for ok, name in won if ok]
    assert len(won) == 12 and len(winners) == 1 and table._content(1) == winners[0]
    assert not list((tmp_path / "t").glob("_novo-*"))


def test_a_loser_sees_the_winners_change(spark, tmp_path):
    """Another writer gets in between reading and claiming; neither change is lost."""
    table = Versions(spark, f"{tmp_path}/t")
    table.put(lambda _: spark.range(1))
    seen = []

    def change(now):
        seen.append(now.count())
        if len(seen) == 1:
            Versions(spark, f"{tmp_path}/t").put(lambda n: n.union(spark.range(10, 12)))
        return now.union(spark.range(20, 21))

    assert table.put(change) == 2 and seen == [1, 3]
    assert values(table.read()) == [(0,), (10,), (11,), (20,)]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    store = g.GenerationStore(spark, str(tmp_path))
    threads = [threading.Thread(target=lambda n=n: store.record(f"20260{n}", g.VALIDATED)) for n in range(1, 5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [r[0] for r in values(store.cycles(), "load_id")] == ["202601", "202602", "202603", "202604"]


def test_a_crash_before_the_claim_changes_nothing(spark, tmp_path, monkeypatch):
    table = Versions(spark, f"{tmp_path}/t")
    table.put(lambda _: spark.range(4))
    with monkeypatch.context() as m:
        m.setattr(Versions, "claim", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            table.put(lambda _: spark.range(9))
    assert table.latest()[0] == 0 and table.read().count() == 4
    assert table.put(lambda _: spark.range(9)) == 1 and table.read().count() == 9


def test_a_wrong_count_leaves_the_version_in_force(spark, tmp_path):
    target = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, target)
    assert sinks.build_version(spark.range(5), target, 5).count() == 5
    with pytest.raises(sinks.CountMismatch):
        sinks.build_version(spark.range(4), target, 5)
    assert sinks.read_version(spark, target).count() == 5
