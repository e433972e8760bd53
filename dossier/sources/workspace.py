"""The saved work of a user: screens that were run, and companies kept at hand (WSP-01).

A workspace is a small JSON document of one user. What it takes from a screen are organisation numbers of a result that
was already cut to its top rows; it is never a place for whole tables.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import asdict, dataclass, replace
from datetime import UTC, datetime

#: The version of the format, and how many screens the history keeps.
SCHEMA_VERSION, KEPT_SCREENS = 1, 100


@dataclass(frozen=True)
class Workspace:
    schema_version: int = SCHEMA_VERSION
    pins: tuple[str, ...] = ()
    history: tuple[dict, ...] = ()

    def with_screen(self, query: str, plan: dict, found: list[str], pins: list[str] | None = None, at: datetime | None = None) -> Workspace:
        """This workspace after a screen that found these companies; of the history the latest screens stay."""
        entry = {
            "created_at": (at or datetime.now(UTC)).isoformat(timespec="seconds"),
            "query": query,
            "plan": plan,
            "result_count": len(found),
            "result_organisation_numbers": list(found),
        }
        return replace(self, history=(*self.history, entry)[-KEPT_SCREENS:], pins=tuple(sorted({*self.pins, *(pins or ())})))

    def save(self, path: str) -> None:
        """Written beside ``path`` and then moved there, so that a reader never meets half a file."""
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        own = f"{path}.{uuid.uuid4().hex}"
        with open(own, "w", encoding="utf-8") as out:
            json.dump(asdict(self), out, ensure_ascii=False, indent=2)
        os.replace(own, path)


def load(path: str) -> tuple[Workspace, str | None]:
    """The workspace of ``path``, or an empty one with the reason why the file was set aside; a missing file has no reason."""
    if not os.path.exists(path):
        return Workspace(), None
    try:
        with open(path, encoding="utf-8") as source:
            held = json.load(source)
    except (OSError, ValueError) as fault:
        return Workspace(), f"unreadable workspace: {type(fault).__name__}"
    lists = isinstance(held, dict) and all(isinstance(held.get(k), list) for k in ("pins", "history"))
    if not lists or held.get("schema_version") != SCHEMA_VERSION:
        return Workspace(), "workspace of another schema"
    return Workspace(pins=tuple(held["pins"]), history=tuple(held["history"])), None
