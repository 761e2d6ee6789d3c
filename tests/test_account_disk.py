"""The account flow deletes its written steps, and keeps events that come twice apart."""

import pathlib

from helpers import feed, tables
from test_modern_accounts import add

from duosync.plans import modern_side as M
from duosync.plans.lineage import Scratch, let_go, no_cut


def test_frames_let_go_are_deleted(spark):
    cut = Scratch(spark)
    first, second = cut(spark.range(3)), cut(spark.range(4))
    let_go(cut, first)
    let_go(no_cut, second)
    assert [p.name for p in pathlib.Path(cut.folder).iterdir()] == ["1"]
    assert second.count() == 4
    cut.release()


def test_steps_are_deleted_and_equal_events_stay_apart(spark):
    """Both events of a pair have one id and number, so neither names its row."""
    events = [add(1, seq=1), add(2, seq=2), add(2, seq=2)]
    ev, t = feed(spark, "modern_account", events), tables(spark)
    cut, steps = Scratch(spark), Scratch(spark)
    parties = M.resolve_parties(ev, t, cut)
    decided = cut(M.decide_accounts(parties[0], t, cut=steps))
    # The events as read, and those with their gates and the accounts' entries.
    assert "0" not in {p.name for p in pathlib.Path(cut.folder).iterdir()}
    assert not {"0", "1"} & {p.name for p in pathlib.Path(steps.folder).iterdir()}
    steps.release()
    assert "before" not in decided.columns
    assert sorted(r.seq for r in decided.collect()) == [1, 2, 2]
    cut.release()
