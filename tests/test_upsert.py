"""Upserts that break off at any step, writers that meet, marks without their copies."""

import os
import time
from datetime import date

import pytest

from flightloom import session
from flightloom.operators import UpsertDamaged, UpsertLocked, finish_upsert, leased, stage_upsert, upsert_fact
from flightloom.operators import upsert as upsert_module
from flightloom.operators.upsert import Lease, LeaseLost
from flightloom.sources import read_fact

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
OLD = [(f"k{n}", D1 if n % 2 else D2, "old") for n in range(100)]
NEW = [(f"k{n}", D1 if n % 2 else D2, "new") for n in range(0, 60, 3)] + [("fresh", D1, "new")]
BOTH = sorted({k: (k, d, v) for k, d, v in OLD + NEW}.values())
SCHEMA = "flight_key string, flight_date date, v string"


class Killed(BaseException):
    """The process ends here: nothing is given back or cleaned up."""


def rows(spark, path):
    return sorted((r.flight_key, r.flight_date, r.v) for r in read_fact(spark, path).collect())


def batch(spark, values):
    return spark.createDataFrame(values, SCHEMA).repartition(4)


#: What an upsert does to files, in order.
STEPS = ("create_file", "discard", "write_mart", "mark", "discard_part")


def kill_at(monkeypatch, at, partly=False):
    """Let the process end at the ``at``-th change of files: before it, or with a folder's removal done in part."""
    done = []

    def counted(name, real):
        def run(spark, *args, **kwargs):
            target = args[0] if name != "write_mart" else None
            if len(done) == at:
                if partly and name == "discard" and os.path.isdir(target):
                    parts = sorted(f for root, _, names in os.walk(target) for f in (os.path.join(root, n) for n in names))
                    for file in parts[: max(1, len(parts) // 3)]:
                        os.unlink(file)
                done.append("killed")
                raise Killed
            if len(done) > at:
                raise Killed  # the process is gone: not even a lease is given back
            done.append(name)
            return real(spark, *args, **kwargs)

        return run

    for name in ("create_file", "mark", "discard", "write_mart"):
        monkeypatch.setattr(upsert_module, name, counted(name, getattr(upsert_module, name)))
    return done


@pytest.mark.parametrize("partly", [False, True])
def test_an_upsert_that_breaks_off_anywhere_is_all_or_nothing(spark, tmp_path, monkeypatch, partly):
    """Killed before each of its changes, and in the middle of each removal; then another writer comes after the lease has run out."""
    seen = set()
    for at in range(30):
        path = str(tmp_path / f"fact-{at}")
        upsert_fact(spark, path, batch(spark, OLD))
        with monkeypatch.context() as patched:
            done = kill_at(patched, at, partly)
            try:
                upsert_fact(spark, path, batch(spark, NEW), owner="first")
            except Killed:
                pass
        if "killed" not in done:
            break
        if os.path.exists(f"{path}.lease") and open(f"{path}.lease").read():
            with pytest.raises(UpsertLocked, match="first"):
                upsert_fact(spark, path, batch(spark, [("other", D1, "x")]), owner="second")
        finish_upsert(spark, path, owner="second", lease_seconds=-1)
        found = rows(spark, path)
        assert found in (OLD_SORTED, BOTH), at
        seen.add(found == BOTH)
        # and the retry under the first name ends where it would have
        upsert_fact(spark, path, batch(spark, NEW), owner="first", lease_seconds=-1)
        assert rows(spark, path) == BOTH
        assert not os.path.exists(f"{path}.upsert") and not os.path.exists(f"{path}.lease")
    assert at > 6 and seen == {False, True}


OLD_SORTED = sorted(OLD)


def test_a_cleanup_that_breaks_off_loses_no_rows(spark, tmp_path):
    """The mark is gone before the first copy: a rest of copies is never taken for a batch."""
    path = str(tmp_path / "fact")
    upsert_fact(spark, path, batch(spark, OLD))
    with leased(spark, path, "w") as lease:
        stage_upsert(spark, path, batch(spark, NEW), lease)
    removed = []
    real = session.discard
    upsert_module.discard, kept = lambda s, target: removed.append(target) or (_ for _ in ()).throw(RuntimeError) if len(removed) == 1 else (removed.append(target), real(s, target)), real
    try:
        with pytest.raises(RuntimeError):
            finish_upsert(spark, path)
    finally:
        upsert_module.discard = kept
    assert removed[0].endswith("/READY") and removed[1].endswith(".upsert")
    for root, _, names in os.walk(f"{path}.upsert"):
        for name in [n for n in names if n.startswith("part")][:1]:
            os.unlink(os.path.join(root, name))
    os.path.exists(f"{path}.lease") and os.unlink(f"{path}.lease")
    assert finish_upsert(spark, path) is False
    assert rows(spark, path) == BOTH


def test_a_mark_without_its_copies_raises(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_fact(spark, path, batch(spark, OLD))
    with leased(spark, path, "w") as lease:
        stage_upsert(spark, path, batch(spark, NEW), lease)
    folder = next(p for p in (tmp_path / "fact.upsert").iterdir() if p.is_dir())
    (folder / "survivors" / "_SUCCESS").unlink()
    with pytest.raises(UpsertDamaged, match="survivors"):
        upsert_fact(spark, path, batch(spark, NEW))
    assert rows(spark, path) == OLD_SORTED
    assert not os.path.exists(f"{path}.lease")  # an exception gives the lease back


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "fact")
    upsert_fact(spark, path, batch(spark, OLD))
    with leased(spark, path, "first") as lease:
        stage_upsert(spark, path, batch(spark, NEW), lease)
        for call in (lambda: upsert_fact(spark, path, batch(spark, [("z", D1, "z")])), lambda: finish_upsert(spark, path, owner="second")):
            with pytest.raises(UpsertLocked, match="first"):
                call()
        assert rows(spark, path) == OLD_SORTED and (tmp_path / "fact.upsert" / "READY").exists()
    # the second one first finishes what the first had marked
    assert upsert_fact(spark, path, batch(spark, [("z", D1, "z")]), owner="second") == (1, [D1])
    assert rows(spark, path) == sorted([*BOTH, ("z", D1, "z")])


def test_a_lease_that_was_taken_over_stops_its_first_holder(spark, tmp_path):
    path = str(tmp_path / "fact")
    first, second = Lease(spark, path, "first", 3600), Lease(spark, path, "second", 3600)
    first.take()
    first.take()  # the same owner goes on
    with pytest.raises(UpsertLocked):
        second.take()
    long_ago = time.time() - 7200
    os.utime(f"{path}.lease", (long_ago, long_ago))
    second.take()
    with pytest.raises(LeaseLost, match="second"):
        stage_upsert(spark, path, batch(spark, NEW), first)
    assert not (tmp_path / "fact.upsert" / "READY").exists()
    first.release()  # does nothing
    second.renew()
    second.release()
    assert second.holder() is None
