"""Tiers of parts: many small parts become few, so that readers stay cheap.

Every batch adds a part of tier 0. When a tier has ``fan`` parts they are merged
into one of the next tier, so after k batches at most ``(fan - 1) * log_fan(k) + fan``
parts are left to read, and each row has been rewritten ``log_fan(k)`` times.

A part's folder name says its tier and the batches it covers:
``part=t0_12_12``, ``part=t1_5_12``. A part is *live* if no part of a higher tier
covers its batches. A merge is in force the moment its folder is there: the parts it covers are
then dead, and are deleted afterwards, whenever. So a crash before, between
or after these steps loses and repeats nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import SparkSession

from tripflow.sinks.files import _file_system

PART_COL = "part"


class Part(NamedTuple):
    tier: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"t{self.tier}_{self.first}_{self.last}"

    def covers(self, other: Part) -> bool:
        return self.tier > other.tier and self.first <= other.first and other.last <= self.last


def new_part(batch: int) -> Part:
    return Part(0, batch, batch)


def parse(name: str) -> Part | None:
    found = re.fullmatch(r"t(\d+)_(\d+)_(\d+)", name)
    return Part(*map(int, found.groups())) if found else None


def live(parts: Iterable[Part]) -> list[Part]:
    """Parts that no other covers, oldest batches first."""
    out: list[Part] = []
    # Parts nest or are apart, so only the last live one can cover the next.
    for p in sorted(set(parts), key=lambda p: (p.first, -p.last, -p.tier)):
        if not out or not out[-1].covers(p):
            out.append(p)
    return out


def due(parts: Iterable[Part], fan: int) -> tuple[Part, list[Part]] | None:
    """The merge that live parts ask for: (new part, parts it merges), or None.

    If several tiers are full at once, their parts go into one merge.
    """
    parts = live(parts)
    tier, merged = 0, []
    while len(at := [p for p in parts if p.tier == tier]) + bool(merged) >= fan:
        merged += at
        tier += 1
    if not merged:
        return None
    return Part(tier, min(p.first for p in merged), max(p.last for p in merged)), merged


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; of none if it is missing."""
    fs, at = _file_system(spark, folder)
    if not fs.exists(at):
        return []
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]


def parts_in(spark: SparkSession, folder: str) -> list[Part]:
    """All parts in a folder, dead ones too."""
    names = (n.partition("=") for n in children(spark, folder))
    return [p for key, _, name in names if key == PART_COL and (p := parse(name))]
