"""A versioned registry of models in a shared folder, with atomic publication.

A model is written first, below a name of its own. One small file then makes it the champion: the marker of the next
generation, which can be created once. Whoever judged its challenger against an older generation finds the marker
taken and is refused; a job that dies before the marker leaves the champion untouched.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

PROMOTED, TOO_WEAK, NOT_BETTER, LOST_RACE = "promoted", "below the minimum", "not better", "lost the race"


@dataclass(frozen=True)
class Champion:
    generation: int
    model: str
    version: int
    value: float
    path: str | None

    def load(self) -> PipelineModel:
        return PipelineModel.load(self.path)


class Registry:
    """Generations of champions below `folder`, which driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.markers = f"{self.folder}/generations"
        self._path(self.markers)[0].mkdirs(self._path(self.markers)[1])

    def _path(self, path: str):
        """Hadoop's file system of a path, and the path."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def history(self) -> DataFrame:
        """(generation, model, version, value, path), a row per champion so far."""
        schema = "generation int, model string, version int, value double, path string"
        return self.spark.read.schema(schema).json(self.markers)  # names that begin with a dot are not read

    def champion(self) -> Champion | None:
        last = self.history().orderBy("generation", ascending=False).first()
        return Champion(*last) if last else None

    def promote(self, model: str, version: int, value: float, minimum: float, against: Champion | None,
                fitted: PipelineModel | None = None) -> str:
        """Make a challenger the next champion if it passes the gate and beats `against`, the champion it was judged by."""
        if value < minimum:
            return TOO_WEAK
        if against is not None and value <= against.value:
            return NOT_BETTER
        path = None
        if fitted is not None:
            path = f"{self.folder}/models/{uuid.uuid4().hex}"
            fitted.write().save(path)
        generation = (against.generation if against else 0) + 1
        row = {"generation": generation, "model": model, "version": version, "value": value, "path": path}
        return PROMOTED if self._publish(f"{self.markers}/generation-{generation:08d}.json", json.dumps(row)) else LOST_RACE

    def _publish(self, path: str, content: str) -> bool:
        """Create a file whole or not at all; False if it exists. The content is written aside and then put in its place."""
        aside = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        store, part = self._path(aside)
        out = store.create(part, False)
        out.write(bytearray(content.encode()))
        out.close()
        try:
            if store.getUri().getScheme() == "file":
                os.link(urlparse(aside).path, urlparse(path).path)  # a local rename would replace the other's marker
            else:
                jvm = self.spark._jvm.org.apache.hadoop.fs
                none = self.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
                jvm.FileContext.getFileContext(store.getUri()).rename(part, self._path(path)[1], none)
            return True
        except Exception:
            if store.exists(self._path(path)[1]):
                return False
            raise
        finally:
            store.delete(part, False)
