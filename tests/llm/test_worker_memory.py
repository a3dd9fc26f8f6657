"""Python workers let go of what tasks have kept in them."""

from __future__ import annotations

import sys

import pytest

from fraudfeatures.llm.common import forget_in_worker, per_worker
from fraudfeatures.llm.neardup import _runs_of


def resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096 / 1e6


def test_tasks_without_a_cache_let_go_of_the_one_before():
    assert per_worker(("words",), lambda: [1]) == [1]
    assert not list(_runs_of(iter([])))
    assert per_worker(("words",), lambda: [2]) == [2]
    forget_in_worker()


@pytest.mark.skipif(sys.platform != "linux", reason="memory is read from /proc, and only glibc gives it back when asked")
def test_memory_that_is_free_goes_back_to_the_system():
    blocks = [bytearray(600) for _ in range(400_000)]
    held = resident_mb()
    blocks = blocks[::4096] + blocks[-1:]  # so that no end of the memory is free by itself
    forget_in_worker()
    assert resident_mb() < held - 120
    assert blocks
