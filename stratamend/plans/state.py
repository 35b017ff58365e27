"""What a change feed remembers: watermark, page generations and keys of each table.

The watermark is each table's own: a table that failed resumes where it
stopped, whatever the others did.  State is advanced after the change set is
in its target, so a crash in between replays it, which the merge makes
harmless.  Generations and keys are kept by page, and only changed pages are
written again; one file, replaced by a rename, names the watermark and all
parts, so a state is seen whole or not at all.  A state
that can't be read counts as none: the next scan starts anew, and emits no
vanished keys.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .files import Files
from .table import VersionedTable


@dataclass
class TableState:
    watermark: int = 0
    generation: int | None = None
    page_gens: DataFrame | None = None
    keys: DataFrame | None = None


class StateStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def _file(self, table: str) -> str:
        return f"{self.path}/{table.lower()}/_STATE"

    def _part(self, table: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.path}/{table.lower()}/{name}", ["page"])

    def _body(self, table: str) -> dict | None:
        try:
            return json.loads(self.files.read(self._file(table)) or "null")
        except ValueError:
            return None

    def load(self, table: str) -> TableState:
        try:
            body = self._body(table)
            read = lambda name: self._part(table, name).read(manifest=body[name]) if body[name] else None
            return TableState(int(body["watermark"]), body["generation"], read("page_gens"), read("keys"))
        except (TypeError, KeyError, ValueError):
            return TableState()

    def save(self, table: str, watermark: int, generation: int | None, page_gens: DataFrame, keys: DataFrame | None, pages: DataFrame | None = None) -> None:
        """The state of a scan; with ``pages`` (page), ``page_gens`` and ``keys`` replace those pages' rows of the last state only."""
        was = self._body(table) if pages is not None else None
        body = {"watermark": watermark, "generation": generation}
        for name, rows in (("page_gens", page_gens), ("keys", keys)):
            part, old = self._part(table, name), was and was.get(name)
            if rows is None:
                body[name] = None
            elif old:
                body[name] = part.staged(old, rows, pages)
            else:
                body[name] = part.staged_swap(rows)
        self.files.replace(self._file(table), json.dumps(body))
        for name in ("page_gens", "keys"):
            if body[name]:
                self._part(table, name).vacuum(body[name])
