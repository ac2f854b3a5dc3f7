"""Time-series records as line-protocol files through a Python data source (K3).

``df.write.format("line_records").mode("append").option("path", p).option("run", r).save()`` lets
each task attempt write one file of its own below ``<p>/runs/<r>/`` and return its name. When all
tasks are through, the driver stores the list of their files as ``<p>/runs/<r>.json``; only
listed files count. A lost or repeated attempt leaves an unlisted file, which the commit removes;
a failed job removes its files and stores no list. A run that is repeated under its name replaces its
list, so the records of a run are there once, however often it was tried.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "line_records"
#: Columns of a record, as ``export_timeseries`` gives them: tags, then name, value and time.
TAGS = ("data_source", "local_site_id", "local_inverter_id")


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:")
                                  else f"file://{path}")


def _escaped(column: pa.ChunkedArray) -> pa.ChunkedArray:
    """Commas, spaces, equal signs and backslashes of a name or tag get a backslash; line ends
    become ``\\n`` and ``\\r`` in letters."""
    text = pc.replace_substring_regex(column.cast(pa.string()), r"([\\,= ])", r"\\\1")
    return pc.replace_substring(pc.replace_substring(text, "\n", "\\n"), "\r", "\\r")


def record_lines(batch: pa.RecordBatch) -> pa.Array:
    """``measure,tag=value,... value=<double> <time>`` per row; a NULL tag is left out, a row
    without a name, value or time gives no line (NULL)."""
    parts = [_escaped(batch.column("measure_name"))]
    for tag in TAGS:
        value = _escaped(batch.column(tag))
        parts.append(pc.fill_null(pc.binary_join_element_wise(f",{tag}=", value, ""), ""))
    head = pc.binary_join_element_wise(*parts, "")
    return pc.binary_join_element_wise(
        head, " value=", batch.column("measure_value").cast(pa.string()), " ",
        batch.column("time").cast(pa.string()), "")


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str
    records: int


class LineRecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str):
        self.path, self.run = path.rstrip("/"), run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        task = TaskContext.get()
        # an attempt's own name: attempts of one task may run at the same time
        name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.lp"
        where, root = _file_system(self.path)
        where.create_dir(f"{root}/runs/{self.run}", recursive=True)
        records = 0
        with where.open_output_stream(f"{root}/runs/{self.run}/{name}") as out:
            for batch in iterator:
                lines = record_lines(batch).drop_null()
                if len(lines):
                    out.write(("\n".join(lines.to_pylist()) + "\n").encode())
                records += len(lines)
        return WrittenFile(name, records)

    def commit(self, messages: list[WrittenFile | None]) -> None:
        where, root = _file_system(self.path)
        files = {m.name: m.records for m in messages if m is not None}
        where.create_dir(f"{root}/runs", recursive=True)
        side = f"{root}/runs/_{self.run}-{uuid.uuid4().hex[:8]}"
        with where.open_output_stream(side) as out:
            out.write(json.dumps({"run": self.run, "files": files}).encode())
        where.move(side, f"{root}/runs/{self.run}.json")
        self._remove(where, root, keep=set(files))

    def abort(self, messages: list[WrittenFile | None]) -> None:
        """Removes what this job's finished attempts wrote; files an earlier commit of the run lists
        stay."""
        where, root = _file_system(self.path)
        for m in messages:
            if m is not None:
                where.delete_file(f"{root}/runs/{self.run}/{m.name}")

    def _remove(self, where: fs.FileSystem, root: str, keep: set[str]) -> None:
        folder = fs.FileSelector(f"{root}/runs/{self.run}", allow_not_found=True)
        for info in where.get_file_info(folder):
            if info.base_name not in keep:
                where.delete_file(info.path)


class LineRecords(DataSource):
    """``path``: root folder that driver and executors share; ``run``: name of the run."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> LineRecordWriter:
        run = self.options.get("run", "")
        if not run or any(c in run for c in "/\\ "):
            raise ValueError("option run: a name without slashes or spaces")
        missing = {*TAGS, "measure_name", "measure_value", "time"} - set(schema.names)
        if missing:
            raise ValueError(f"records lack {sorted(missing)}")
        return LineRecordWriter(self.options["path"], run)


def write_records(df: DataFrame, path: str, run: str) -> None:
    """Write the long records of ``df`` as run ``run`` below ``path``."""
    df.sparkSession.dataSource.register(LineRecords)
    columns = [*TAGS, "measure_name", F.col("measure_value").cast("double").alias("measure_value"),
               F.col("time").cast("long").alias("time")]
    df.select(*columns).write.format(FORMAT).mode("append").option("path", path).option(
        "run", run).save()


def committed_files(path: str) -> dict[str, dict[str, int]]:
    """Per committed run its files and their numbers of records."""
    where, root = _file_system(path.rstrip("/"))
    out = {}
    for info in where.get_file_info(fs.FileSelector(f"{root}/runs", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with where.open_input_stream(info.path) as f:
                found = json.loads(f.read())
            out[found["run"]] = found["files"]
    return out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all committed runs: run, the tags, measure_name, measure_value, time."""
    files = [f"{path.rstrip('/')}/runs/{run}/{name}"
             for run, names in committed_files(path).items() for name, n in names.items() if n]
    columns = ["run", *TAGS, "measure_name", "measure_value", "time"]
    if not files:
        return spark.createDataFrame([], "run string, " + ", ".join(f"{t} string" for t in TAGS)
                                     + ", measure_name string, measure_value double, time long")
    plain = r"((?:\\.|[^\\,= ])*)"

    def tag(name: str) -> F.Column:
        found = F.regexp_extract("value", rf"(?<!\\),{name}={plain}", 1)
        given = F.col("value").rlike(rf"(?<!\\),{name}=")
        return F.when(given, _unescaped(found)).alias(name)

    lines = spark.read.text(files).withColumn(
        "run", F.regexp_extract("_metadata.file_path", "/runs/([^/]+)/[^/]+$", 1))
    return lines.select(
        "run", *[tag(t) for t in TAGS],
        _unescaped(F.regexp_extract("value", f"^{plain}", 1)).alias("measure_name"),
        F.regexp_extract("value", r" value=(\S+) -?\d+$", 1).cast("double").alias("measure_value"),
        F.regexp_extract("value", r" (-?\d+)$", 1).cast("long").alias("time")).select(*columns)


def _unescaped(text: F.Column) -> F.Column:
    """The reverse of the writer's escapes; ``\\n`` stands for a line end unless its backslash
    is itself escaped."""
    text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    text = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\r", "$1\r")
    return F.regexp_replace(text, r"\\([\\,= ])", "$1")
