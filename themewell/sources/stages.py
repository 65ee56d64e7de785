"""Stage tables: what one run has made so far, as Parquet under one folder."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from themewell.sources.tables import path_exists, require_columns, write_whole

STAGES = {
    "raw": "id long, text string, category string, intent string",
    "texts": "id long, text string",
    "labels": "id long, category string, intent string",
    "vectors": "id long, embedding array<float>",
    "assigned": "id long, method string, cluster_id int",
    "k_search": "k int, silhouette double, n_scored long",
    "metrics": "method string, metric string, value double",
    "coords": "id long, x double, y double, method string",
    "catalogue": "cluster_id int, label string, description string, size long, examples array<string>, "
    "method string, made_from string",
}

# What the report needs before it can be made.
REPORT_STAGES = ("texts", "assigned", "coords", "metrics", "catalogue")


class StaleStage(RuntimeError):
    """A stage was made from inputs that have been made anew since."""


class StageStore:
    """Tables under ``<root>/<stage>/run_id=<run>``; each write is one commit.

    A write goes to a new folder. Then one small file takes the place of the
    former one: it names the folders that are the table, and what it was made with:
    settings, the stamps of the stages it was made from, and a stamp of its own. A
    write that breaks off changes nothing. A stage is used again only if all of that
    still holds. The folders of the table before the last write stay for those who
    read them, older ones go. One run has one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id

    def path(self, stage: str) -> str:
        if stage not in STAGES:
            raise KeyError(f"no stage {stage}; there are {', '.join(STAGES)}")
        return f"{self.root}/{stage}/run_id={self.run_id}"

    def _pointer(self, stage: str) -> str:
        return f"{self.path(stage)}/current.json"

    def about(self, stage: str) -> dict:
        """Folders, settings, inputs and stamp of a stage; empty if it has none."""
        if not path_exists(self.spark, self._pointer(stage)):
            return {}
        return json.loads(self.spark.read.text(self._pointer(stage), wholetext=True).first()["value"])

    def stamp(self, stage: str) -> str | None:
        return self.about(stage).get("stamp")

    def has(self, stage: str) -> bool:
        return bool(self.about(stage))

    def _paths(self, stage: str) -> list[str]:
        return [f"{self.path(stage)}/{folder}" for folder in self.about(stage)["folders"]]

    def missing(self, stages: Iterable[str] = REPORT_STAGES) -> list[str]:
        """Stages that are not there, or whose files lack a column or have another type in it."""
        return [s for s in stages if not self.has(s) or not self._fits(s)]

    def _fits(self, stage: str) -> bool:
        there = {f.name: f.dataType for f in self.spark.read.parquet(*self._paths(stage)).schema}
        return all(there.get(f.name) == f.dataType for f in self._schema(stage))

    def _schema(self, stage: str):
        return self.spark.createDataFrame([], STAGES[stage]).schema

    def write(
        self,
        stage: str,
        df: DataFrame,
        mode: str = "overwrite",
        settings: Mapping | None = None,
        inputs: Iterable[str] = (),
    ) -> DataFrame:
        wanted = self._schema(stage)
        require_columns(df, wanted.fieldNames(), f"stage {stage}")
        about = {"settings": dict(settings or {}), "inputs": {i: self.stamp(i) for i in inputs}, "stamp": uuid.uuid4().hex}
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in wanted])
        before = self.about(stage).get("folders", [])
        about["folders"] = [*(before if mode == "append" else []), f"part-{about['stamp']}"]
        typed.write.parquet(f"{self.path(stage)}/{about['folders'][-1]}")
        write_whole(self.spark, self._pointer(stage), json.dumps(about, sort_keys=True))
        self._clear(stage, {*before, *about["folders"]})
        return self.read(stage)

    def _clear(self, stage: str, kept: set[str]) -> None:
        """Deletes folders of earlier writes, and of those that broke off."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(stage))
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in files.listStatus(at):
            name = found.getPath().getName()
            if name.startswith("part-") and found.isDirectory() and name not in kept:
                files.delete(found.getPath(), True)

    def read(self, stage: str) -> DataFrame:
        """The table; an error if it is not there, or made from inputs that have changed since."""
        if not self.has(stage):
            raise FileNotFoundError(f"stage {stage} of run {self.run_id} is not there; run the step that makes it")
        if old := self._changed(self.about(stage)):
            raise StaleStage(f"stage {stage} of run {self.run_id} was made from an older {', '.join(old)}; make it anew")
        return self.spark.read.schema(STAGES[stage]).parquet(*self._paths(stage))

    def _changed(self, about: dict) -> list[str]:
        return [i for i, stamp in about.get("inputs", {}).items() if self.stamp(i) != stamp]

    def once(
        self,
        stage: str,
        make: Callable[[], DataFrame],
        force: bool = False,
        settings: Mapping | None = None,
        inputs: Iterable[str] = (),
    ) -> DataFrame:
        """The stage as it is if it was made with these settings from the inputs as they are; else made anew.

        ``force`` always makes it anew.
        """
        if not force and self.has(stage):
            about = self.about(stage)
            same = about.get("settings", {}) == dict(settings or {}) and set(about.get("inputs", {})) == set(inputs)
            if same and not self._changed(about):
                return self.read(stage)
        return self.write(stage, make(), settings=settings, inputs=inputs)


def with_source_ids(raw: DataFrame) -> DataFrame:
    """Ids for a source that has no key, in the order rows are read.

    Store the result before use: the ids are fixed once written.
    """
    return raw.withColumn("id", F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str) -> None:
    """A report table as CSV with a header; columns that CSV cannot hold are left out."""
    flat = [f.name for f in df.schema if f.dataType.typeName() not in ("array", "map", "struct")]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)
