"""The documentation lists every query of the library's own operators."""

from __future__ import annotations

import os

from ledgerlake.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _read(name: str) -> str:
    with open(os.path.join(ROOT, name), encoding="utf-8") as f:
        return f.read()


def test_every_key_is_documented():
    readme, coverage, plans = _read("README.md"), _read("COVERAGE.md"), _read("PLANS.md")
    for key in QUERIES:
        assert f"`{key}`" in readme, key
        assert f"`{key}`" in coverage, key
        assert f"| {key} |" in plans, key
