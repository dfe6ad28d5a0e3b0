"""Header name resolution (schema drift between report files)."""

from __future__ import annotations

from collections.abc import Sequence


def strip_bom(name: str) -> str:
    return name.lstrip("﻿")


def first_with_prefix(names: Sequence[str], prefix: str) -> int | None:
    """Index of the first name that starts with ``prefix``."""
    for i, name in enumerate(names):
        if strip_bom(name).startswith(prefix):
            return i
    return None


def last_with_prefix(names: Sequence[str], prefix: str) -> int | None:
    """Index of the last name that starts with ``prefix``."""
    found = None
    for i, name in enumerate(names):
        if strip_bom(name).startswith(prefix):
            found = i
    return found
