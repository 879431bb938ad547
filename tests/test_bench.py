"""What the bench times."""

import bench
from tallyloom.plans.catalog import QUERIES


def test_bench_times_the_whole_grid():
    assert "a15_score_grid" in bench.HEADLINE
    assert set(bench.HEADLINE) <= set(QUERIES)
