"""Grouped pandas hooks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def per_key_apply(df: DataFrame, keys: Sequence[str], fn: Callable, schema: str) -> DataFrame:
    """Run a pandas function on every group (``applyInPandas``).

    Each group is materialised in one Python worker, so keys must bound the
    group size: use a time bucket next to the symbol (e.g. ``symbol, month``)
    rather than the symbol alone, or ``per_key_stream`` for a function that can
    go through a group piece by piece.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def per_key_stream(df: DataFrame, keys: Sequence[str], fn: Callable, schema: str, order: Sequence[str] = ()) -> DataFrame:
    """Run ``fn(key, pieces)`` on every group, its rows streamed in pieces of one Arrow batch at most.

    ``fn`` takes the key's values and an iterator of pandas frames in ``order`` and yields pandas
    frames; it holds no more of a group than it keeps itself, so one key may have a third of
    all rows. Groups come one after the other from partitions sorted by key and order (an external sort, which
    spills); rows that ``fn`` leaves unread are skipped. A group of a null key is a group too. A piece may be
    shorter than a batch. Row order within equal ``order`` values is not fixed.
    """
    keys = list(keys)
    rows = df.repartition(*keys).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys], *order)

    def run(batches: Iterator) -> Iterator:
        pieces = _Pieces(batches, keys)
        while pieces.next_group():
            yield from fn(pieces.key, pieces.rows())
    return rows.mapInPandas(run, schema)


class _Pieces:
    """Batches of sorted rows as groups of pieces."""

    def __init__(self, batches: Iterator, keys: list[str]):
        self.batches, self.keys = batches, keys
        self.batch, self.at, self.key = None, 0, None

    def _fill(self) -> bool:
        while self.batch is None or self.at >= len(self.batch):
            self.batch, self.at = next(self.batches, None), 0
            if self.batch is None:
                return False
            values = [self.batch[k] for k in self.keys]
            change = sum((~(v.eq(v.shift()) | (v.isna() & v.shift().isna()))).astype(int) for v in values).to_numpy()
            change[:1] = 1
            self.starts = change.nonzero()[0]
        return True

    def _key_at(self, k: int) -> tuple:
        import pandas as pd
        return tuple(None if pd.isna(v) else v for v in (self.batch[c].iloc[k] for c in self.keys))

    def rows(self) -> Iterator:
        """The rest of the current group, piece by piece."""
        while self._fill() and self._key_at(self.at) == self.key:
            stops = self.starts[self.starts > self.at]
            stop = int(stops[0]) if len(stops) else len(self.batch)
            piece, self.at = self.batch.iloc[self.at:stop], stop
            yield piece

    def next_group(self) -> bool:
        if self.key is not None:
            for _ in self.rows():       # what the function left
                pass
        if not self._fill():
            return False
        self.key = self._key_at(self.at)
        return True
