"""Numbered snapshots of a folder: small JSON files, of which the highest number counts.

A snapshot is published last, by a rename to the next number, so that readers see all of a change or nothing, and of two writers at once one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from shelfmark.session import file_system


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def numbers(self) -> list[int]:
        system, place = file_system(self.spark, f"{self.path}/snapshots")
        if not system.exists(place):
            return []
        return sorted(int(n[:-5]) for x in system.listStatus(place) if (n := x.getPath().getName()).endswith(".json") and not n.startswith("."))

    def read(self, number: int) -> dict:
        system, place = file_system(self.spark, f"{self.path}/snapshots/{number:09d}.json")
        stream = system.open(place)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self, empty: dict) -> dict:
        """The snapshot that counts; ``empty`` with number 0 where there is none."""
        known = self.numbers()
        return self.read(known[-1]) if known else {"number": 0} | empty

    def publish(self, snapshot: dict) -> None:
        system, place = file_system(self.spark, f"{self.path}/snapshots/.{uuid.uuid4().hex}")
        out = system.create(place, False)
        out.write(bytearray(json.dumps(snapshot).encode()))
        out.close()
        _, final = file_system(self.spark, f"{self.path}/snapshots/{snapshot['number']:09d}.json")
        if system.exists(final) or not system.rename(place, final):
            system.delete(place, False)
            raise RuntimeError(f"another change of {self.path} came first")
