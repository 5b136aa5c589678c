"""mzML runs read in short stretches: how many tasks that takes."""

import pytest

from massloom.sources import mzml_fragments


@pytest.mark.parametrize("stretch", [50, 1000])
def test_short_stretches_share_tasks(stretch):
    """every stretch is read once, in no more tasks than cores can use."""
    files = [("a", 100_000), ("b", 1), ("c", 0), ("d.gz", 5_000)]
    tasks = mzml_fragments._Reader(files, stretch, 20).partitions()
    parts = [p for t in tasks for p in t.parts]
    assert 20 <= len(tasks) <= 45
    assert [(p.start, p.stop) for p in parts if p.path == "a"] == [(k, k + stretch) for k in range(0, 100_000, stretch)]
    assert [p.path for p in parts if p.last] == ["a", "b", "c", "d.gz"]
