"""What a worker keeps between tasks."""

from pathlib import Path

import numpy as np

from tidemark.llm.words import give_back


def resident() -> int:
    return int(Path("/proc/self/statm").read_text().split()[1]) * 4096


def test_free_memory_goes_back():
    parts = [np.ones(1 << 12) for _ in range(8000)]  # 256 MB of arrays too small to be mapped on their own
    last = parts[-1]
    full = resident()
    del parts
    give_back()
    assert full - resident() > 200 << 20 and last.sum() == 1 << 12
