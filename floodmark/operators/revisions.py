"""A small document that replaces itself: the newest revision counts, the last are kept.

Every change writes one small JSON file under the next number, by renaming it into its
place, and the oldest goes.  So the last good one is never touched, whenever a writer
dies, and a reader lists a handful of names and opens one file, after ten changes or
ten million.  No Spark job is run for it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from floodmark.sources import folders

KEPT = 16


@dataclass(frozen=True)
class RevisionLog:
    """Revisions of one document.  One job at a time may write."""

    spark: SparkSession
    path: str

    def take(self) -> tuple[object, int] | None:
        """The document in force and its number; none where there is none."""
        numbers = self._numbers()
        return (self._read(numbers[-1]), numbers[-1]) if numbers else None

    def all(self) -> list[object]:
        """The documents that are kept, oldest first."""
        return [self._read(number) for number in self._numbers()]

    def clear(self) -> None:
        """Forget all revisions."""
        folders.remove(self.spark, self.path)

    def reset(self, document) -> None:
        """Begin anew with a document."""
        self.clear()
        self.append(document, 0)

    def append(self, document, revision: int) -> None:
        """Put a document in force; its number is one above that of the one so far."""
        folders.put_text(self.spark, self._file(revision), json.dumps(document))
        for old in self._numbers()[:-KEPT]:
            folders.remove(self.spark, self._file(old))

    def _read(self, number: int):
        return json.loads(folders.text(self.spark, self._file(number)))

    def _file(self, number: int) -> str:
        return f"{self.path}/{number}.json"

    def _numbers(self) -> list[int]:
        names = [e.name for e in folders.entries(self.spark, self.path) if not e.is_folder]
        return sorted(int(name.removesuffix(".json")) for name in names)
