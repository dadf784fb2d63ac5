"""Partitions of several tables replaced together.

Everything is written beside the tables first; what can fail by its data fails there, and the tables
are as before. Then folders are renamed, one by one, and renamed back if one can't be.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str) -> Any:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def folders(spark: SparkSession, top: str, depth: int) -> list[str]:
    """Folders that lie so deep below top, by their paths from there."""
    system, level = _system(spark, top), [""]
    for _ in range(depth):
        level = [f"{at}/{s.getPath().getName()}" for at in level for s in system.listStatus(_path(spark, top + at)) if s.isDirectory()]
    return level


def _stage(df: DataFrame, aside: str, by: Sequence[str]) -> None:
    """Write df beside its table, dealt out by its partitions; large partitions by several tasks."""
    if by:
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(aside)
    else:
        df.write.parquet(aside)


def replace_together(spark: SparkSession, changes: Sequence[tuple[DataFrame, str, Sequence[str]]]) -> None:
    """For each (df, path, by): the partitions by that df has replace those of the table, all others stay; without by, the whole table.

    Either all tables are changed or, if anything fails, none.
    """
    asides = [f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}" for _, path, _ in changes]
    try:
        with ThreadPoolExecutor(len(changes)) as pool:  # Spark runs the jobs side by side
            for job in [pool.submit(inheritable_thread_target(spark)(_stage), df, aside, by) for (df, _, by), aside in zip(changes, asides, strict=True)]:
                job.result()
        _swap(spark, [(aside, path.rstrip("/"), len(by)) for (_, path, by), aside in zip(changes, asides, strict=True)])
    finally:
        _drop(spark, asides)


def _swap(spark: SparkSession, made: Sequence[tuple[str, str, int]]) -> None:
    done: list[tuple[str, str]] = []
    old = [f"{path}-replaced-{uuid.uuid4().hex}" for _, path, _ in made]

    def move(a: str, b: str) -> None:
        system, to = _system(spark, a), _path(spark, b)
        system.mkdirs(to.getParent())
        if not system.rename(_path(spark, a), to):
            raise OSError(f"{a} could not be renamed to {b}")
        done.append((a, b))

    try:
        for (aside, path, depth), gone in zip(made, old, strict=True):
            for part in folders(spark, aside, depth):
                if exists(spark, path + part):
                    move(path + part, gone + part)
                move(aside + part, path + part)
    except BaseException as error:
        if not all([_system(spark, a).rename(_path(spark, b), _path(spark, a)) for a, b in reversed(done)]):
            raise OSError(f"not all folders could be renamed back; what was replaced lies in {', '.join(old)}") from error
        _drop(spark, old)
        raise
    _drop(spark, old)


def _drop(spark: SparkSession, paths: Sequence[str]) -> None:
    for gone in paths:
        _system(spark, gone).delete(_path(spark, gone), True)
