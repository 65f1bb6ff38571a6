"""Table versions: folders that never change, and one pointer to them.

A table is a folder with ``data/`` and ``_versions/``. Every write puts its files
into folders of its own name below ``data/`` (``order_month=200001/_version=ab12``)
and touches no file that is there. It becomes visible by one small numbered
file in ``_versions/`` that names the table's schema and the folders of every
part; the highest number is the table. So readers see all of a write or
nothing of it, whatever it touches, keep what they have opened while others write,
and change nothing themselves; a crash leaves the table as it was. Two writers
that started from one version cannot both publish: the second is told.

Folders that no version kept names are removed by ``vacuum`` alone.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..session import STORED_CODEC, delete_path, folder_names, modified_at, read_text, rename_path, source_state, write_text

VERSION_COL = "_version"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class WriteConflict(RuntimeError):
    """Another writer has published since this one read the table."""


@dataclass(frozen=True)
class Version:
    """One state of a table. ``parts`` maps a part's folder name
    ("order_month=200001", or "" without partitions) to its version folders."""
    number: int
    schema: StructType
    partition: str | None
    parts: dict[str, list[str]]
    notes: dict = field(default_factory=dict)

    def folders(self, path: str, names=None) -> list[str]:
        return [f"{data_folder(path)}/{name + '/' if name else ''}{VERSION_COL}={v}"
                for name in sorted(self.parts if names is None else names) for v in self.parts.get(name, [])]


def data_folder(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def part_name(partition: str | None, value) -> str:
    if partition is None:
        return ""
    return f"{partition}={NULL_PART if value is None else value}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in folder_names(spark, f"{path.rstrip('/')}/_versions") if n.endswith(".json"))


def _load(spark: SparkSession, path: str, number: int) -> Version:
    kept = json.loads(read_text(spark, f"{path.rstrip('/')}/_versions/{number:08d}.json"))
    return Version(number, StructType.fromJson(kept["schema"]), kept["partition"], kept["parts"], kept["notes"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The table's version; None if there is no table."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def numbered(spark: SparkSession, path: str, number: int | None) -> Version | None:
    """An older version, if it is still kept."""
    return _load(spark, path, number) if number in _numbers(spark, path) else None


def publish(spark: SparkSession, path: str, based_on: Version | None, schema: StructType, partition: str | None,
            parts: dict[str, list[str]], notes: dict | None = None) -> Version:
    """Make a state of the table its next version."""
    new = Version(1 + (based_on.number if based_on else 0), schema, partition, parts, notes or {})
    folder = f"{path.rstrip('/')}/_versions"
    told = json.dumps({"schema": schema.jsonValue(), "partition": partition, "parts": parts, "notes": new.notes})
    unseen, pointer = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{new.number:08d}.json"
    write_text(spark, unseen, told)
    # A rename onto a name that is there fails: one writer gets the number.
    if f"{new.number:08d}.json" in folder_names(spark, folder) or not rename_path(spark, unseen, pointer):
        delete_path(spark, unseen)
        raise WriteConflict(f"{path} has a version {new.number} already")
    return new


def write_parts(df: DataFrame, path: str, partition: str | None, name: str | None = None) -> tuple[str, list[str]]:
    """Write rows as folders of a new name: that name, and the parts written. With
    the ``name`` of an earlier write, the rows join those that it wrote."""
    spark, name = df.sparkSession, name or uuid.uuid4().hex[:12]
    by = [VERSION_COL] if partition is None else [partition, VERSION_COL]
    (df.withColumn(VERSION_COL, F.lit(name)).write.mode("append").option("compression", STORED_CODEC)
     .partitionBy(*by).parquet(data_folder(path)))
    if partition is None:
        return name, [""] if f"{VERSION_COL}={name}" in folder_names(spark, data_folder(path)) else []
    found = [p for p in folder_names(spark, data_folder(path)) if p.startswith(f"{partition}=")]
    return name, [p for p in found if f"{VERSION_COL}={name}" in folder_names(spark, f"{data_folder(path)}/{p}")]


def discard(spark: SparkSession, path: str, name: str, parts: list[str]) -> None:
    """Remove the folders of a write that is not to be published."""
    for part in parts:
        delete_path(spark, f"{data_folder(path)}/{part + '/' if part else ''}{VERSION_COL}={name}")


def part_bytes(spark: SparkSession, path: str, version: Version, parts=None) -> dict[str, int]:
    """Bytes of the files of a version's parts, or of some of them."""
    names = sorted(version.parts if parts is None else parts)
    return {p: source_state(spark, version.folders(path, [p]))[1] for p in names}


def read(spark: SparkSession, path: str, version: Version, parts=None) -> DataFrame:
    """The rows of a version, or of some of its parts. Columns that older files
    lack are NULL there."""
    folders = version.folders(path, parts)
    if not folders:
        return spark.createDataFrame([], version.schema)
    schema = StructType([*version.schema.fields]).add(VERSION_COL, StringType())
    return (spark.read.schema(schema).option("basePath", data_folder(path)).parquet(*folders)
            .select(*version.schema.fieldNames()))


def vacuum(spark: SparkSession, path: str, keep: int = 3, older_than_seconds: float = 86_400) -> list[str]:
    """Remove old versions but the last ``keep``, and folders that none of those
    names and that nothing has written to for a while (of crashed writes, too).
    Returns the folders removed. Readers of a removed version fail, so keep as
    many as the longest query may span."""
    numbers = _numbers(spark, path)
    kept = [_load(spark, path, n) for n in numbers[-keep:]]
    named = {f for v in kept for f in v.folders(path)}
    partition = kept[-1].partition if kept else None
    data, before, removed = data_folder(path), time.time() - older_than_seconds, []
    parents = [data] if partition is None else [f"{data}/{p}" for p in folder_names(spark, data)
                                                if p.startswith(f"{partition}=")]
    for number in numbers[:-keep]:
        delete_path(spark, f"{path.rstrip('/')}/_versions/{number:08d}.json")
    for parent in parents:
        for name in folder_names(spark, parent):
            folder = f"{parent}/{name}"
            if name.startswith(VERSION_COL) and folder not in named and modified_at(spark, folder) < before:
                delete_path(spark, folder)
                removed.append(folder)
    return removed
