"""Landings with a folder per inverter on a local file system, through a Python data source (K2).

Without its native library Hadoop's local file system starts a ``chmod`` process for each folder,
file and checksum it makes, which takes most of the time of a landing of small files.
Here the tasks write the files themselves. Each attempt writes below a folder of its own in
``<root>/.landing-<id>``, which readers skip, and returns the names of its folders; when all tasks are
through, the driver puts the folders in place by renames. A folder that is there already is set
aside before and removed at the end. A failed job leaves the landing as it was.
"""

from __future__ import annotations

import errno
import os
import shutil
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from heliolake.sources.tables import NO_VALUE

FORMAT = "landed_documents"
BODY = "_body"
#: What Spark escapes in a partition folder's name.
ESCAPED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}


def folder_name(key: str, value: str | None) -> str:
    """``key=value`` as Spark's partitioned writers name the folder."""
    return f"{_escaped(key)}={_escaped(value) if value else NO_VALUE}"


def _escaped(text: str) -> str:
    return text.translate(str.maketrans(ESCAPED))


@dataclass
class LandedFolders(WriterCommitMessage):
    attempt: str
    folders: list[str]


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, root: str, keys: list[str]):
        self.root, self.keys, self.job = root, keys, uuid.uuid4().hex
        self.stage = f"{root}/.landing-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> LandedFolders:
        task = TaskContext.get()
        # an attempt's own folder: attempts of one task may run at the same time
        attempt = f"{task.partitionId():05d}-{task.taskAttemptId()}"
        name = f"part-{task.partitionId():05d}-{self.job}.c000.json"
        folders, made, last, out = [], set(), None, None
        try:
            for batch in iterator:
                columns = [batch.column(c).to_pylist() for c in (*self.keys, BODY)]
                for *values, body in zip(*columns, strict=True):
                    if values != last:
                        if out is not None:
                            out.close()
                        *parents, leaf = map(folder_name, self.keys, values)
                        parent = "/".join([self.stage, attempt, *parents])
                        if parent not in made:
                            os.makedirs(parent, exist_ok=True)
                            made.add(parent)
                        os.mkdir(f"{parent}/{leaf}")  # rows come sorted by folder
                        out, last = open(f"{parent}/{leaf}/{name}", "wb"), values
                        folders.append("/".join([*parents, leaf]))
                    out.write(f"{body}\n".encode())
        finally:
            if out is not None:
                out.close()
        return LandedFolders(attempt, folders)

    def commit(self, messages: list[LandedFolders | None]) -> None:
        os.makedirs(f"{self.stage}/old", exist_ok=True)
        placed, parents = set(), set()
        for m in messages:
            for folder in m.folders if m is not None else ():
                source, target = f"{self.stage}/{m.attempt}/{folder}", f"{self.root}/{folder}"
                if folder in placed:  # rows of one folder in several tasks
                    for name in os.listdir(source):
                        os.rename(f"{source}/{name}", f"{target}/{name}")
                    continue
                parent = os.path.dirname(target)
                if parent not in parents:
                    os.makedirs(parent, exist_ok=True)
                    parents.add(parent)
                self._place(source, target, f"{self.stage}/old/{len(placed)}")
                placed.add(folder)
        shutil.rmtree(self.stage)

    @staticmethod
    def _place(source: str, target: str, aside: str) -> None:
        try:
            os.rename(source, target)
        except OSError as e:
            if e.errno not in (errno.ENOTEMPTY, errno.EEXIST, errno.ENOTDIR):
                raise
            os.rename(target, aside)
            os.rename(source, target)

    def abort(self, messages: list[LandedFolders | None]) -> None:
        shutil.rmtree(self.stage, ignore_errors=True)


class LandedDocuments(DataSource):
    """``path``: a local folder that driver and executors share; ``keys``: the path columns, joined
    by slashes, from the outermost on."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{BODY} string"

    def writer(self, schema, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(self.options["path"], self.options["keys"].split("/"))


def land_documents(df: DataFrame, path: str, *keys: str) -> None:
    """The columns of ``df`` but ``keys`` as JSON Lines below the folders that ``keys`` name."""
    os.makedirs(path, exist_ok=True)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not import it
    df.sparkSession.dataSource.register(LandedDocuments)
    document = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in keys]))
    (df.select(*[F.col(k).cast("string").alias(k) for k in keys], document.alias(BODY))
       .sortWithinPartitions(*keys).write.format(FORMAT).mode("append")
       .option("path", path).option("keys", "/".join(keys)).save())
