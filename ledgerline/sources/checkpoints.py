"""Which tables of a transfer are done, in a small file that is replaced as a whole."""

from __future__ import annotations

import hashlib
import json
import os
import threading
from pathlib import Path


class Checkpoint:
    """State of one transfer between two schemas under one set of options.

    A file that another transfer has left (other schemas or options) is refused; a damaged one counts as absent.
    """

    def __init__(self, path: str, source: str, target: str, options: dict | None = None) -> None:
        self.path = Path(path)
        self.lock = threading.Lock()
        plain = json.dumps(options or {}, sort_keys=True)
        self.state = {
            "schema": source,
            "target": target,
            "options": hashlib.sha256(plain.encode()).hexdigest()[:16],
            "completed": [],
            "in_progress": {},
        }
        try:
            found = json.loads(self.path.read_text())
        except (OSError, ValueError):
            found = {}
        for k in ("schema", "target", "options"):
            if k in found and found[k] != self.state[k]:
                raise ValueError(f"{path} is of another transfer: {k} is {found[k]}, not {self.state[k]}")
        self.state |= {k: found[k] for k in ("completed", "in_progress") if k in found}

    def _save(self) -> None:
        new = self.path.with_name(self.path.name + ".new")
        new.write_text(json.dumps(self.state, indent=1))
        os.replace(new, self.path)

    def is_completed(self, table: str) -> bool:
        return table.lower() in self.state["completed"]

    def begin(self, table: str, there: int, batches: int) -> tuple[int, int]:
        """(batches done, rows written) by earlier runs.  there: rows that the target has now."""
        with self.lock:
            found = self.state["in_progress"].get(table.lower())
            if not found:
                found = {"base": there, "batches": batches, "done": 0, "rows": 0}
            if found["batches"] != batches:
                raise ValueError(f"{table} was begun in {found['batches']} batches, not {batches}")
            if there > found["base"] + found["rows"]:
                # one more batch was committed, but not noted
                found |= {"done": found["done"] + 1, "rows": there - found["base"]}
            self.state["in_progress"][table.lower()] = found
            self._save()
            return found["done"], found["rows"]

    def update(self, table: str, done: int, rows: int) -> None:
        with self.lock:
            self.state["in_progress"][table.lower()] |= {"done": done, "rows": rows}
            self._save()

    def complete(self, table: str) -> None:
        with self.lock:
            self.state["in_progress"].pop(table.lower(), None)
            self.state["completed"] = sorted({*self.state["completed"], table.lower()})
            self._save()

    @property
    def completed(self) -> list[str]:
        return list(self.state["completed"])

    def summary(self) -> dict[str, int]:
        return {"completed": len(self.state["completed"]), "in_progress": len(self.state["in_progress"])}
