"""A mapping of named tables that are defined on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping[str, DataFrame]):
    """Plans are only put together for the tables a query touches; each one once."""

    def __init__(self, definitions: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._definitions = dict(definitions)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._definitions[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._definitions)

    def __len__(self) -> int:
        return len(self._definitions)
