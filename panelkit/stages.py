"""Stage tables with an owner.

A stage that several later steps read is written once as Parquet below the
shared checkpoint folder. The ledger knows these tables, finds in a frame's plan
which of them it reads, and deletes a table once its last reader is written, so
a job's disk holds the stages still needed and not all it ever made."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from panelkit.session import delete_path, scratch_dir

_CURRENT: ContextVar[StageLedger | None] = ContextVar("panelkit_ledger", default=None)


class StageLedger:
    """The stage tables of one job.

    ``readers`` is the number of frames that will be written from a table: it
    goes with the last of them (:meth:`wrote`, which :meth:`store` calls for
    what it writes). Without a number a table stays until :meth:`release` finds
    that no frame still in use reads it, or until :meth:`close`."""

    def __init__(self, spark: SparkSession, outer: StageLedger | None = None):
        self.spark, self.outer = spark, outer
        self._left: dict[str, int | None] = {}
        self._kept: list[DataFrame] = []

    @property
    def tables(self) -> list[str]:
        """Paths of the tables that are still there, oldest first."""
        return list(self._left)

    def store(self, df: DataFrame, label: str = "stage", readers: int | None = None) -> DataFrame:
        """``df`` written once and read back: the lineage ends at reliable
        storage, and every reader still gets column pruning and pushed filters."""
        path = scratch_dir(self.spark, label)
        df.write.parquet(path)
        self.wrote(df)
        self._left[path] = readers
        return self.spark.read.schema(df.schema).parquet(path)

    def read_by(self, *frames: DataFrame) -> set[str]:
        """The ledger's tables that the plans of ``frames`` scan."""
        if not self._left:
            return set()
        folders = {path.rsplit("/", 1)[1]: path for path in self._left}
        return {folders[part] for df in frames for file in df.inputFiles() for part in file.split("/") if part in folders}

    def wrote(self, df: DataFrame) -> None:
        """``df`` has been written: one reader less for each table it scans,
        here and in the ledgers around this one."""
        for path in self.read_by(df):
            if self._left[path] is not None:
                self._left[path] -= 1
                if self._left[path] <= 0:
                    self._drop(path)
        if self.outer is not None:
            self.outer.wrote(df)

    def release(self, *live: DataFrame) -> None:
        """Delete the tables that none of ``live``, the frames still in use, scans."""
        needed = self.read_by(*live)
        for path in [p for p in self._left if p not in needed]:
            self._drop(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` is a result of the step this ledger belongs to (:func:`releasing`)."""
        self._kept.append(df)
        return df

    def adopt(self, other: StageLedger) -> None:
        """Take over the tables of another ledger."""
        self._left.update(other._left)
        other._left.clear()

    def close(self) -> None:
        self.release()

    def _drop(self, path: str) -> None:
        del self._left[path]
        delete_path(self.spark, path)

    @contextmanager
    def recording(self):
        """Tables written by :func:`store_stage` in this block belong to this ledger."""
        token = _CURRENT.set(self)
        try:
            yield self
        finally:
            _CURRENT.reset(token)


def store_stage(df: DataFrame, label: str = "stage", readers: int | None = None) -> DataFrame:
    """:meth:`StageLedger.store` in the ledger whose block this runs in; without
    one the table stays (see ``scratch_scope``)."""
    ledger = _CURRENT.get()
    return (ledger or StageLedger(df.sparkSession)).store(df, label, readers)


def wrote(df: DataFrame) -> None:
    """Tell the ledger whose block this runs in that ``df`` has been written."""
    if (ledger := _CURRENT.get()) is not None:
        ledger.wrote(df)


@contextmanager
def releasing(spark: SparkSession):
    """Run a step whose tables belong to a ledger of its own, which the block
    gets: it names its results by ``keep(frame)`` and may ``release`` in between.
    Every table that the results don't scan goes when the block ends, the others
    pass to the ledger around it."""
    outer = _CURRENT.get()
    inner = StageLedger(spark, outer)
    with inner.recording():
        yield inner
    inner.release(*inner._kept)
    if outer is not None:
        outer.adopt(inner)
