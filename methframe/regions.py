"""Regions of a genome as text."""

from __future__ import annotations

import re


def parse_region(text: str) -> tuple[str, int, int]:
    """('chr7', 1234, 5678) from 'chr7:1,234-5,678'."""
    m = re.fullmatch(r"\s*([^:\s]+):([\d,]+)-([\d,]+)\s*", text)
    if not m:
        raise ValueError(f"not a region: {text!r}")
    start, end = (int(x.replace(",", "")) for x in m.groups()[1:])
    if start > end:
        raise ValueError(f"a region's start lies after its end: {text!r}")
    return m[1], start, end
