"""Files that tasks write to and read from the folder all executors share."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from starlane.sources.scratch import scratch_folder


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path there; local paths may lack a scheme."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


@contextmanager
def new_file(folder: str, stem: str):
    """A new file with a name of its own, as (stream, name).

    A task that is run twice writes two files. Only names that reach a committed table
    are ever read, so what a lost attempt left is never mixed in.
    """
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    name = f"{stem}-{uuid.uuid4().hex}"
    with system.open_output_stream(f"{path}/{name}") as stream:
        yield stream, name


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` whose worker gives back freed Arrow memory before and after.

    Workers live on between tasks and stages, and Arrow keeps the pages of a task's batches
    for the next one; beside a large cache of another stage that is memory held twice.
    """

    def leanly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return leanly


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the scratch folder and read them back: computed once, lineage cut."""
    spark: SparkSession = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
