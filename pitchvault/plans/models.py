"""Named models built when first asked for."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from threading import RLock

from pyspark.sql import DataFrame

from pitchvault.sources.tables import export_bucketed, export_mart


class Models(dict):
    """Mapping of model names to DataFrames; an unread model costs no analysis.

    A builder gets the mapping itself, so models can read each other by name. Models
    named in ``write`` are written below ``root`` when built and read back: those that
    several others read are then worked out once; ``export`` writes one. Those of them in ``dealt`` are written in
    ``buckets()`` buckets of the column given there, by which their builders have dealt them out, and are not shuffled
    when grouped or joined by it. Threads that ask for one model at the same time get the same one.
    """

    def __init__(
        self,
        builders: Mapping[str, Callable[["Models"], DataFrame]],
        given: Mapping[str, DataFrame] | None = None,
        write: Collection[str] = (),
        root: str | None = None,
        export: Callable[[str, DataFrame, str], int] = lambda name, df, path: export_mart(df, path),
        dealt: Mapping[str, str] | None = None,
        buckets: Callable[[], int] | None = None,
    ):
        super().__init__(given or {})
        self._builders, self._write, self._root, self._export = builders, set(write), root, export
        self._dealt, self._buckets = dealt or {}, buckets
        # A builder asks only for models below its own, so no two of these wait for each other.
        self._locks = {name: RLock() for name in builders}

    def __missing__(self, name: str) -> DataFrame:
        builder = self._builders[name]
        with self._locks[name]:
            if name in self:
                return self[name]
            return self._build(name, builder)

    def _build(self, name: str, builder: Callable[["Models"], DataFrame]) -> DataFrame:
        df = builder(self)
        if name in self._write:
            path = f"{self._root}/{name}"
            if name in self._dealt:
                df = export_bucketed(df, path, self._dealt[name], self._buckets())
            else:
                self._export(name, df, path)
                df = df.sparkSession.read.parquet(path)
        self[name] = df
        return df
