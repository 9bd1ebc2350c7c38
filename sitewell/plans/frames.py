"""Named DataFrames that are only planned when somebody asks for them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Frames(Mapping):
    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Stand ``df`` in for a frame, so that frames made later build on it."""
        self._made[name] = df

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)
