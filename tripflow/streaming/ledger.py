"""Ledger of source files: which files a table already holds, whatever became of the checkpoint.

A streaming checkpoint knows the files it has read. With a new checkpoint (a
lost one, a changed source option, a second query) all files look new again, and
batch numbers start again at 0. The ledger is kept with the table instead:

* ``run=<query id>/part=…``: JSON rows (batch_id, seq, file) of the batches a
  run has finished, merged by tiers (see ``tiers``);
* ``_begun/<run>~<batch id>~<seq>``: an empty folder for the batch in flight.

``begin`` gives a batch its number in the table (``seq``): the one it had, if it is run again,
else one after all others. A batch that *another* run has begun and not finished will
not be run again, so what it wrote is undone first. ``seen`` names the files of a batch that
other runs have finished: a run's own checkpoint already tells it its own files, so
with one run nothing is read. ``finish`` records the files and then drops the mark.

One query at a time may write to a table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sinks.files import _file_system, delete_folder, folder_exists, replace_folder, write_text
from tripflow.streaming import tiers as T

SCHEMA = "batch_id long, seq long, file string"
FAN = 32


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint: the same after a restart, another with a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id


class SourceLedger:
    def __init__(self, spark: SparkSession, path: str, run: str):
        self.spark, self.path, self.run = spark, path.rstrip("/"), run
        self.next: int | None = None  # known after the first batch of this process

    def _run_folder(self, run: str) -> str:
        return f"{self.path}/run={run}"

    def _runs(self) -> list[str]:
        return [n.partition("=")[2] for n in T.children(self.spark, self.path) if n.startswith("run=")]

    def _rows(self, runs: Iterable[str]) -> DataFrame | None:
        paths = [f"{self._run_folder(r)}/{T.PART_COL}={p.name}" for r in runs for p in T.live(T.parts_in(self.spark, self._run_folder(r)))]
        return self.spark.read.schema(SCHEMA).json(paths) if paths else None

    def files(self) -> DataFrame:
        """(batch_id, seq, file) of all finished batches."""
        rows = self._rows(self._runs())
        return self.spark.createDataFrame([], SCHEMA) if rows is None else rows

    def _begun(self) -> list[tuple[str, int, int]]:
        marks = (n.split("~") for n in T.children(self.spark, f"{self.path}/_begun"))
        return [(m[0], int(m[1]), int(m[2])) for m in marks if len(m) == 3]

    def _mark(self, run: str, batch_id: int, seq: int) -> str:
        return f"{self.path}/_begun/{run}~{batch_id}~{seq}"

    def _finished(self, run: str, seq: int) -> bool:
        rows = self._rows([run])
        return rows is not None and not rows.filter(F.col("seq") == seq).isEmpty()

    def begin(self, batch_id: int, undo: Callable[[int], None]) -> int:
        """Number of this batch in the table. ``undo(seq)`` removes what an unfinished batch of another run wrote."""
        if self.next is None:
            begun = self._begun()
            for run, batch, seq in begun:
                if (run, batch) != (self.run, batch_id):
                    if not self._finished(run, seq):
                        undo(seq)
                    delete_folder(self.spark, self._mark(run, batch, seq))
            used = [p.last for r in self._runs() for p in T.parts_in(self.spark, self._run_folder(r))]
            self.next = max([*used, *(seq for _, _, seq in begun)], default=-1) + 1
            for run, batch, seq in begun:
                if (run, batch) == (self.run, batch_id):
                    return seq  # it was cut off
            own = self._rows([self.run])
            again = None if own is None else own.filter(F.col("batch_id") == batch_id).first()
            if again is not None:
                return again.seq  # it was finished, but the checkpoint does not know
        seq, self.next = self.next, self.next + 1
        fs, at = _file_system(self.spark, self._mark(self.run, batch_id, seq))
        fs.mkdirs(at)
        return seq

    def seen(self, files: DataFrame) -> list[str] | None:
        """Which of a batch's files (column ``file``) other runs have finished; None if there are no other runs."""
        others = self._rows(r for r in self._runs() if r != self.run)
        if others is None:
            return None
        # The batch's files are few (bounded by the trigger), the ledger may be long: it is not shuffled.
        return [r.file for r in others.join(F.broadcast(files.select("file").distinct()), "file").select("file").distinct().collect()]

    def finish(self, batch_id: int, seq: int, files: list[str]) -> None:
        folder, part = self._run_folder(self.run), T.new_part(seq)
        lines = "".join(json.dumps({"batch_id": batch_id, "seq": seq, "file": f}) + "\n" for f in files)
        write_text(self.spark, f"{folder}/_{part.name}/files.json", lines)  # bounded by the trigger
        self._place(folder, part)
        if merge := T.due(T.parts_in(self.spark, folder), FAN):
            new, old = merge
            rows = self.spark.read.schema(SCHEMA).json([f"{folder}/{T.PART_COL}={p.name}" for p in old])
            rows.write.mode("overwrite").json(f"{folder}/_{new.name}")
            self._place(folder, new)
        every = T.parts_in(self.spark, folder)
        for dead in {*every} - {*T.live(every)}:
            delete_folder(self.spark, f"{folder}/{T.PART_COL}={dead.name}")
        if folder_exists(self.spark, mark := self._mark(self.run, batch_id, seq)):
            delete_folder(self.spark, mark)

    def _place(self, folder: str, part: T.Part) -> None:
        replace_folder(self.spark, f"{folder}/_{part.name}", f"{folder}/{T.PART_COL}={part.name}")
