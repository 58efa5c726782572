"""Stage tables that change in one step.

A stage table is a folder of version folders and a folder of markers. A writer writes a
version folder of its own, whole, and then puts one numbered marker that lists which folders
make up the table. Readers go by the newest marker, so they see the old table until the
marker is there and the new one after; a writer that dies leaves a folder that no marker
names. A marker's number is claimed by exclusive creation: of two writers one is first, and
the other starts over from the first one's table (only the listing, not the data).

``publish`` replaces the table; ``publish_partitions`` replaces the partitions that its frame
has rows in and keeps the others where they are. ``vacuum`` removes what no kept marker names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MARKERS = "_versions"
#: Unnamed folders younger than this may belong to a writer that is still at work.
UNFINISHED_S = 24 * 3600


@dataclass(frozen=True)
class Version:
    """A table's state: ``parts`` are (folder, its partitions in use, or None for all)."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    parts: tuple[tuple[str, tuple[str, ...] | None], ...]
    about: dict


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list:
    fs, p = _path(spark, path)
    return list(fs.listStatus(p)) if fs.exists(p) else []


def _read_marker(spark: SparkSession, path: str) -> dict | None:
    fs, p = _path(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:  # its writer died between claiming the number and writing the list
        return None


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = [st.getPath().getName() for st in _children(spark, f"{base}/{_MARKERS}")]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def versions(spark: SparkSession, base: str) -> list[Version]:
    """The table's states that are complete, oldest first."""
    found = []
    for n in _numbers(spark, base):
        m = _read_marker(spark, f"{base}/{_MARKERS}/{n:012d}.json")
        if m:
            found.append(Version(n, T.StructType.fromJson(m["schema"]), tuple(m["partition_by"]),
                                 tuple((f, None if p is None else tuple(p)) for f, p in m["parts"]), m["about"]))
    return found


def current(spark: SparkSession, base: str) -> Version | None:
    for n in reversed(_numbers(spark, base)):
        m = _read_marker(spark, f"{base}/{_MARKERS}/{n:012d}.json")
        if m:
            return Version(n, T.StructType.fromJson(m["schema"]), tuple(m["partition_by"]),
                           tuple((f, None if p is None else tuple(p)) for f, p in m["parts"]), m["about"])
    return None


def _claim(spark: SparkSession, base: str, number: int, marker: dict) -> bool:
    """Puts the marker, unless the number is taken."""
    fs, p = _path(spark, f"{base}/{_MARKERS}/{number:012d}.json")
    if fs.exists(p):
        return False
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - another writer created it meanwhile
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(json.dumps(marker).encode()))
    finally:
        out.close()
    return True


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    names = [""]
    for _ in range(depth):
        names = [f"{n}/{st.getPath().getName()}".lstrip("/") for n in names for st in _children(spark, f"{folder}/{n}" if n else folder)
                 if st.isDirectory() and "=" in st.getPath().getName()]
    return names


def _commit(spark: SparkSession, base: str, df: DataFrame, folder: str, partition_by: Sequence[str], only: bool,
            about: dict) -> Version:
    mine = _partitions(spark, f"{base}/{folder}", len(partition_by)) if only else None
    while True:
        taken = _numbers(spark, base)
        old = current(spark, base) if only else None
        parts: list = []
        if old:
            if old.partition_by != tuple(partition_by):
                raise ValueError(f"the table is partitioned by {old.partition_by}")
            if [(f.name, f.dataType) for f in old.schema] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError("the new partitions have other columns than the table")
            for f, p in old.parts:
                p = _partitions(spark, f"{base}/{f}", len(partition_by)) if p is None else p
                left = [x for x in p if x not in set(mine)]
                if left:
                    parts.append([f, left])
        if mine is None or mine:
            parts.append([folder, mine])
        marker = {"schema": json.loads(df.schema.json()), "partition_by": list(partition_by), "parts": parts, "about": about}
        number = (taken[-1] if taken else 0) + 1
        if _claim(spark, base, number, marker):
            return current(spark, base)


def _write(df: DataFrame, base: str, partition_by: Sequence[str]) -> str:
    folder = f"v-{uuid.uuid4().hex}"
    w = df.write.format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{base}/{folder}")
    return folder


def publish(df: DataFrame, base: str, partition_by: Sequence[str] = (), about: dict | None = None) -> DataFrame:
    """Makes ``df`` the whole table at ``base``; returns the frame that reads it. ``about``:
    facts kept with the version (JSON values)."""
    folder = _write(df, base, partition_by)
    return read(df.sparkSession, base, _commit(df.sparkSession, base, df, folder, partition_by, False, about or {}))


def publish_partitions(df: DataFrame, base: str, partition_by: Sequence[str], about: dict | None = None) -> DataFrame:
    """Replaces the partitions that ``df`` has rows in; the table's others stay as they are."""
    if not partition_by:
        raise ValueError("name the partition columns")
    folder = _write(df, base, partition_by)
    return read(df.sparkSession, base, _commit(df.sparkSession, base, df, folder, partition_by, True, about or {}))


def read(spark: SparkSession, base: str, version: Version | None = None) -> DataFrame:
    """The table as of ``version``, by default the newest. A frame keeps the version it was made of."""
    v = version or current(spark, base)
    if v is None:
        raise FileNotFoundError(f"no finished stage table at {base}")
    frames = []
    for folder, used in v.parts:
        root = f"{base}/{folder}"
        r = spark.read.schema(v.schema).option("basePath", root)
        frames.append(r.parquet(*([root] if used is None else [f"{root}/{p}" for p in used])).select(*v.schema.names))
    if not frames:
        return spark.createDataFrame([], v.schema)
    for more in frames[1:]:
        frames[0] = frames[0].unionByName(more)
    return frames[0]


def vacuum(spark: SparkSession, base: str, keep: int = 2, unfinished_s: float = UNFINISHED_S) -> list[str]:
    """Removes versions before the newest ``keep``, and unfinished ones that are old enough
    for their writer to be gone. Returns the removed folders."""
    known = versions(spark, base)
    kept = known[-max(keep, 1):]
    named = {f for v in known for f, _ in v.parts}
    wanted = {f for v in kept for f, _ in v.parts}
    removed = []
    for st in _children(spark, base):
        name = st.getPath().getName()
        if not name.startswith("v-") or name in wanted:
            continue
        if name in named or time.time() - st.getModificationTime() / 1000 >= unfinished_s:
            fs, p = _path(spark, f"{base}/{name}")
            fs.delete(p, True)
            removed.append(name)
    for v in known[:-max(keep, 1)]:
        fs, p = _path(spark, f"{base}/{_MARKERS}/{v.number:012d}.json")
        fs.delete(p, False)
    return sorted(removed)
