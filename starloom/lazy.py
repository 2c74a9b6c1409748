"""Tables by name, each defined when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class LazyTables(Mapping):
    """A report that reads one dimension does not have to analyse the plans of the others."""

    def __init__(self, **define: Callable[[], DataFrame]):
        self._define = define
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._define[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._define)

    def __len__(self) -> int:
        return len(self._define)
