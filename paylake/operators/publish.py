"""Publishing staged folders so that a crash at any point can be repaired.

What is to be published is complete in a staging folder beside the table
before anything of the table changes. A manifest next to the table then says
what is to be done; publishing does it; the manifest goes last. A run that
finds a manifest first does what it says once more: every step may be repeated.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import hadoop_path, remove_path


def staging_beside(path: str) -> str:
    return f"{path.rstrip('/')}__staging-{uuid.uuid4().hex[:12]}"


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}__pending.json"


def _rename(fs, old, new) -> None:
    """A rename that fails says so (some stores only return false)."""
    if not fs.rename(old, new):
        raise OSError(f"could not rename {old} to {new}")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Written under another name and renamed: it is there whole or not at all."""
    fs, tmp = hadoop_path(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _rename(fs, tmp, hadoop_path(spark, path)[1])


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def swap_table(spark: SparkSession, staging: str, path: str) -> None:
    """The staged folder becomes the table: two renames, then the old one goes.
    A rename that fails leaves both for the next run."""
    fs, new = hadoop_path(spark, staging)
    table, old = hadoop_path(spark, path)[1], hadoop_path(spark, f"{path.rstrip('/')}__old")[1]
    if fs.exists(new):  # else done before
        if fs.exists(table):
            fs.delete(old, True)
            _rename(fs, table, old)
        _rename(fs, new, table)
    fs.delete(old, True)


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, length) of the Parquet files below a folder."""
    fs, root = hadoop_path(spark, path)
    found, out = fs.listFiles(root, True), []
    while found.hasNext():
        status = found.next()
        name = status.getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")):
            out.append((status.getPath().toString(), status.getLen()))
    return out


def add_files(spark: SparkSession, moves: list[list[str]]) -> None:
    """Staged files go to their places; one that is gone went before."""
    for source, place in moves:
        fs, old = hadoop_path(spark, source)
        new = hadoop_path(spark, place)[1]
        if fs.exists(old):
            fs.mkdirs(new.getParent())
            _rename(fs, old, new)


def drop_files(spark: SparkSession, files: list[str], path: str) -> None:
    """Files that were replaced go, and the partition folders they leave empty."""
    root = hadoop_path(spark, path)[1].toUri().getPath()
    for name in files:
        fs, p = hadoop_path(spark, name)
        fs.delete(p, False)
        folder = p.getParent()
        while folder.toUri().getPath() != root and fs.exists(folder) and len(fs.listStatus(folder)) == 0:
            fs.delete(folder, False)
            folder = folder.getParent()


def write_summary(spark: SparkSession, schema, path: str) -> None:
    """An empty Parquet file with the columns of a table, where Spark looks for
    them first: files written before a column came have it NULL, files with a
    column that went are read without it."""
    tmp = staging_beside(path)
    spark.createDataFrame([], schema).coalesce(1).write.parquet(tmp)
    fs, place = hadoop_path(spark, path)
    fs.mkdirs(place.getParent())
    fs.delete(place, False)
    _rename(fs, hadoop_path(spark, files_below(spark, tmp)[0][0])[1], place)
    remove_path(spark, tmp)


def _dropped_path(path: str) -> str:
    return f"{path.rstrip('/')}__dropped.json"


def dropped_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that the table had once and that old files may still hold."""
    return json.loads(read_text(spark, _dropped_path(path)) or "[]")


def _applied_path(path: str) -> str:
    return f"{path.rstrip('/')}__applied.json"


def applied(spark: SparkSession, path: str) -> dict[str, int]:
    """Per streaming query (its id), the last batch whose rows the table has."""
    return json.loads(read_text(spark, _applied_path(path)) or "{}")


def _record(spark: SparkSession, path: str, batch: list | None) -> None:
    if batch:
        done = applied(spark, path) | {batch[0]: batch[1]}
        remove_path(spark, _applied_path(path))  # gone for a moment: the manifest still holds the batch
        _write_text(spark, _applied_path(path), json.dumps(done))


def _perform(spark: SparkSession, path: str, todo: dict) -> None:
    if todo["mode"] == "table":
        swap_table(spark, todo["staging"], path)
        remove_path(spark, _dropped_path(path))
    else:
        add_files(spark, todo["moves"])
        if todo["schema"] is not None:
            from pyspark.sql.types import StructType
            write_summary(spark, StructType.fromJson(todo["schema"]), f"{path.rstrip('/')}/_common_metadata")
            remove_path(spark, _dropped_path(path))
            if todo["dropped"]:
                _write_text(spark, _dropped_path(path), json.dumps(todo["dropped"]))
        drop_files(spark, todo["remove"], path)
        remove_path(spark, todo["staging"])
    _record(spark, path, todo.get("batch"))
    remove_path(spark, _manifest_path(path))


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a publication that a crash cut short; True if there was one."""
    text = read_text(spark, _manifest_path(path))
    if text is None:
        return False
    _perform(spark, path, json.loads(text))
    return True


def publish_table(spark: SparkSession, staging: str, path: str, batch: list | None = None) -> None:
    """``batch``: (query id, batch id) of a streaming query, recorded with what is published."""
    todo = {"mode": "table", "staging": staging, "batch": batch}
    _write_text(spark, _manifest_path(path), json.dumps(todo))
    _perform(spark, path, todo)


def publish_files(spark: SparkSession, staging: str, path: str, replaced: list[str], schema=None,
                  dropped: list[str] = (), batch: list | None = None) -> None:
    """The files staged below ``staging`` join the table's, and the files
    ``replaced`` go. ``schema``: the columns (without those of folders) that the
    table has from now on, if they change, and ``dropped`` those that old files
    still hold. Readers in between see replaced rows twice."""
    root, table = hadoop_path(spark, staging)[1].toUri().getPath(), path.rstrip("/")
    moves = []
    for name, _ in files_below(spark, staging):
        inside = hadoop_path(spark, name)[1].toUri().getPath()
        moves.append([name, f"{table}{inside[len(root):]}"])
    todo = {"mode": "files", "staging": staging, "moves": moves, "remove": list(replaced), "batch": batch,
            "schema": None if schema is None else schema.jsonValue(), "dropped": list(dropped)}
    _write_text(spark, _manifest_path(path), json.dumps(todo))
    _perform(spark, path, todo)


def rebuild_table(df: DataFrame, path: str, parts: list[str] | None = None, batch: list | None = None,
                  options: dict[str, str] | None = None) -> None:
    """Full rebuild of a table: staged beside it, then swapped in. ``options`` are the writer's."""
    spark = df.sparkSession
    recover(spark, path)
    staging = staging_beside(path)
    writer = df.write
    if parts:
        writer = df.hint("REBALANCE", *[F.col(p) for p in parts]).write.partitionBy(*parts)
    writer.options(**(options or {})).parquet(staging)
    publish_table(spark, staging, path, batch)
