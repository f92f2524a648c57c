"""Steps that run only when their inputs changed, by fingerprints kept in a log of numbered entries.

Runs may race: an entry is a file that is put only if its number is free, so that all runs see one order, and no clock decides. A run that finds its number
taken reads what came before; where another run has made the same step from the same inputs meanwhile, it takes that result.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "version LONG, step STRING, fingerprint STRING, path STRING"


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; whether it was written. On a local disk by a link to a whole file, elsewhere by the file system's own exclusive create."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() == "file":
        local = where.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        aside = f"{local}.{uuid.uuid4().hex}.aside"
        with open(aside, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(aside, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    try:
        stream = system.create(where, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


@dataclass(frozen=True)
class Step:
    """A named plan of earlier steps' tables; `needs` must be there, `may_use` may lack."""

    name: str
    build: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    may_use: tuple[str, ...] = ()
    settings: dict = field(default_factory=dict)


class Pipeline:
    """Runs steps in order into folder, reusing outputs whose fingerprint is known."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _versions(self) -> int:
        """The last number in the log."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_log")
        system = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json")], default=0)

    def known(self) -> DataFrame:
        """All entries of the log."""
        if not self._versions():
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).option("pathGlobFilter", "*.json").json(f"{self.folder}/_log")

    def latest(self) -> dict[str, tuple[str, str]]:
        """step -> fingerprint and path of its last entry."""
        last = self.known().groupBy("step").agg(F.max_by(F.struct("fingerprint", "path"), "version").alias("r"))
        return {r["step"]: (r["r"]["fingerprint"], r["r"]["path"]) for r in last.collect()}

    def commit(self, step: str, mark: str, path: str, since: int) -> tuple[str, str]:
        """Enter a result that was made from what the log said up to version `since`; gives the entry that holds: an earlier one of the same step and mark since then wins."""
        while True:
            version = self._versions() + 1
            if version > since + 1:
                same = self.known().where((F.col("version") > since) & (F.col("step") == step) & (F.col("fingerprint") == mark))
                rival = same.agg(F.min_by("path", "version")).first()[0]
                if rival is not None:
                    return mark, rival
            entry = json.dumps({"version": version, "step": step, "fingerprint": mark, "path": path})
            if put_if_absent(self.spark, f"{self.folder}/_log/{version:012d}.json", entry):
                return mark, path

    def run(self, steps: list[Step], inputs: dict[str, tuple[str, DataFrame]], skip: tuple[str, ...] = (), force: bool = False) -> dict[str, DataFrame | None]:
        """inputs: name -> (version, table). A skipped step gives its kept output or None; a missing need is an error."""
        held, marks = {n: df for n, (_, df) in inputs.items()}, {n: v for n, (v, _) in inputs.items()}
        since = self._versions()
        known = {} if force else self.latest()
        for step in steps:
            lacking = [n for n in step.needs if held.get(n) is None]
            if lacking and step.name not in skip:
                raise ValueError(f"step {step.name} lacks {lacking}")
            used = [*step.needs, *step.may_use]
            mark = json.dumps([step.name, [(n, marks.get(n)) for n in used], sorted(step.settings.items())])
            found = known.get(step.name)
            if step.name in skip:
                held[step.name] = self.spark.read.parquet(found[1]) if found else None
                marks[step.name] = found[0] if found else None
                continue
            if not found or found[0] != mark:
                path = f"{self.folder}/{step.name}-{uuid.uuid4().hex}"
                step.build(*[held.get(n) for n in used], **step.settings).write.parquet(path)
                found = self.commit(step.name, mark, path, since)
            held[step.name], marks[step.name] = self.spark.read.parquet(found[1]), found[0]
        return held
