"""What the test runner needs of the folder."""

from __future__ import annotations

from collections import Counter
from pathlib import Path


def test_no_two_test_files_share_a_name():
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert [n for n, k in names.items() if k > 1] == []
