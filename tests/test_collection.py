"""The tree of tests is collected whole: two modules of one name would keep one of them from running."""

from collections import Counter
from pathlib import Path


def test_names_of_modules_are_unique():
    names = Counter(p.name for p in Path(__file__).parent.rglob("test_*.py"))
    assert not [name for name, n in names.items() if n > 1]
