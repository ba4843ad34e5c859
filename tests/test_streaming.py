"""The streaming fold agrees with the batch fold, also over several archives and restarts."""

import pytest

from railflow.operators.fold import fold_changes
from railflow.plans.incremental import read_change_state
from railflow.streaming import fold_into_state, read_change_stream
from tests.handfixture import change_docs, write_tar


def _run(spark, folder, state, checkpoint, policy):
    query = fold_into_state(read_change_stream(spark, str(folder)), state, checkpoint, policy,
                            trigger={"availableNow": True})
    assert query.awaitTermination(240)


@pytest.mark.parametrize("policy", ["max", "last"])
def test_stream_fold_equals_batch(spark, rail, tmp_path, policy):
    folder, state, checkpoint = tmp_path / "in", f"{tmp_path}/state", f"{tmp_path}/checkpoint"
    folder.mkdir()
    docs = sorted(change_docs().items())
    # a change for a trip far ahead comes first; later archives must not be lost behind it
    ahead = {"2509020600/X/c.xml": '<timetable station="X" eva="7"><s id="7-2612010700-1"><ar ct="2612010701"/></s></timetable>'}
    for n, part in enumerate((ahead, dict(docs[::2]), dict(docs[1::2]))):
        write_tar(folder / f"{n}.tar.gz", part)
        _run(spark, folder, state, checkpoint, policy)       # a new query each time: a restart
    got = read_change_state(spark, state, policy)
    want = fold_changes(rail.changes_star, policy)
    rows = {tuple(r) for r in got.select(*want.columns).collect()}
    assert {tuple(r) for r in want.collect()} == {r for r in rows if r[0] != "7-2612010700-1"}
    assert len(rows) == want.count() + 1
