"""A run's journal: one entry before a step and one after it, so a restart knows what to repeat.

A step that is ``done`` is not run again; its result is what the entry holds. A step that has only begun
may have left anything behind, so each step writes below a folder that belongs to the run and the step,
is cleared before the step runs, and is read by later steps only through the journal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from fxtape import versions


class Journal:
    """The journal of one run below ``root``, read afresh by every process that opens it."""

    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.run_id = spark, run_id
        self.folder = f"{root.rstrip('/')}/run_id={run_id}"

    def state(self, step: str) -> str:
        """``open``, ``begun`` or ``done``."""
        if versions.read_small(self.spark, f"{self.folder}/{step}.done.json") is not None:
            return "done"
        begun = versions.read_small(self.spark, f"{self.folder}/{step}.begun.json")
        return "open" if begun is None else "begun"

    def place(self, step: str) -> str:
        """The folder a step may write to."""
        return f"{self.folder}/{step}"

    def step(self, name: str, work: Callable[[str], dict]) -> dict:
        """The result of a step: as it was recorded, or of ``work`` on the step's empty folder."""
        recorded = versions.read_small(self.spark, f"{self.folder}/{name}.done.json")
        if recorded is not None:
            return recorded
        self.begun(name)
        versions.remove(self.spark, self.place(name))
        result = work(self.place(name))
        self.done(name, result)
        return result

    def begun(self, name: str) -> None:
        versions.write_small(self.spark, f"{self.folder}/{name}.begun.json", {"run_id": self.run_id}, True)

    def done(self, name: str, result: dict) -> None:
        versions.write_small(self.spark, f"{self.folder}/{name}.done.json", result, True)
