"""Model versions beside a running stream.

    <path>/models/<version>-<id>/       one saved bundle, written whole and never changed
    <path>/current/<n>.json             pointers in order; the last one is in use
    <path>/used/<query>/<batch>.json    which pointer scored a micro-batch

Publishing saves the bundle first and then puts its pointer in place by one
rename, so a reader sees the old model or the new one, never half of one. A
stream resolves the pointer anew for every micro-batch, so a retrained model
takes over without a restart. The pointer a batch was scored with is written
before its rows are, and a replay of the batch takes the same one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import replace

from pyspark.sql import SparkSession

from ..streaming.day_table import _Files
from .hybrid import ModelBundle
from .lifecycle import load_bundle, save_bundle


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path, _Files(spark, path)
        self._loaded: tuple[str, ModelBundle] | None = None

    def _pointers(self) -> list[str]:
        return self.files.matching(f"{self.path}/current/*.json")

    def _point(self, content: dict) -> int:
        """The next pointer; a publisher that loses the race takes the one after."""
        while True:
            n = len(self._pointers()) + 1
            if self.files.put(f"{self.path}/current/{n:010d}.json", json.dumps(content)):
                return n

    def publish(self, bundle: ModelBundle, version: str) -> int:
        """Saves a bundle under a version name and makes it the current one."""
        folder = f"{self.path}/models/{version}-{uuid.uuid4().hex[:8]}"
        save_bundle(self.spark, replace(bundle, version=version), folder)
        return self._point({"version": version, "folder": folder})

    def use(self, version: str) -> int:
        """Makes an earlier version current again (the newest of that name)."""
        held = [p for p in self.history() if p["version"] == version]
        if not held:
            raise ValueError(f"unknown version {version}")
        return self._point(held[-1])

    def history(self) -> list[dict]:
        return [json.loads(self.files.read(p)) for p in self._pointers()]

    def current(self) -> dict | None:
        pointers = self._pointers()
        return json.loads(self.files.read(pointers[-1])) if pointers else None

    def load(self, pointer: dict | None) -> ModelBundle | None:
        """The bundle of a pointer; the last one is kept."""
        if pointer is None:
            return None
        if self._loaded is None or self._loaded[0] != pointer["folder"]:
            self._loaded = (pointer["folder"], load_bundle(self.spark, pointer["folder"]))
        return self._loaded[1]

    def for_batch(self, query: str, batch_id: int) -> ModelBundle | None:
        """The current bundle, or the one this batch was scored with before."""
        used = f"{self.path}/used/{query}/{int(batch_id):010d}.json"
        if not self.files.matching(used):
            self.files.put(used, json.dumps(self.current()))
        return self.load(json.loads(self.files.read(used)))
