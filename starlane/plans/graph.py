"""Steps of a job, run as soon as what they need is there."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlane.sources import versions
from starlane.sources.readers import input_files

MARKER = "_fingerprint"


@dataclass(frozen=True)
class Step:
    """``work`` is called with the results of the steps it ``needs``, in their order."""

    needs: Sequence[str]
    work: Callable[..., Any]


def run_steps(spark: SparkSession, steps: Mapping[str, Step], threads: int = 4) -> dict[str, Any]:
    """The results of all steps by name. Steps that need nothing of each other run at once.

    Each runs in a thread of the driver and in a scheduler pool of its name, which share the
    cluster where the scheduler is fair. A step that fails lets those under way end and no
    other begin; what finished stays where it wrote it.
    """
    done: dict[str, Any] = {}
    running: dict[Future, str] = {}
    failure: BaseException | None = None

    def in_pool(name: str, work: Callable[[], Any]) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return work()

    with ThreadPoolExecutor(threads) as pool:
        waiting = dict(steps)
        while waiting or running:
            for name in [n for n, s in waiting.items() if failure is None and all(d in done for d in s.needs)]:
                step = waiting.pop(name)
                given = [done[d] for d in step.needs]
                target = inheritable_thread_target(lambda n=name, s=step, g=given: in_pool(n, lambda: s.work(*g)))
                running[pool.submit(target)] = name
            if not running:
                if failure is None:
                    raise ValueError(f"steps that wait for each other: {sorted(waiting)}")
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if error := future.exception():
                    failure = failure or error
                else:
                    done[name] = future.result()
    if failure is not None:
        raise failure
    return done


@dataclass(frozen=True)
class Input:
    """What an input consists of, without its content."""

    files: int
    size: int
    digest: str


def describe_inputs(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, Input]:
    """Number, bytes and a digest of names, sizes and times of the files of each input, in one job."""
    listed = [input_files(spark, [path]).select(F.lit(name).alias("name"), "path", "length", "modificationTime") for name, path in paths.items()]
    files = listed[0]
    for more in listed[1:]:
        files = files.unionByName(more)
    of_file = F.xxhash64("path", "length", "modificationTime")
    found = files.groupBy("name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("size"), F.bit_xor(of_file).alias("a"), F.bit_xor(F.xxhash64(of_file)).alias("b")
    )
    by_name = {r["name"]: Input(r["files"], r["size"], f"{r['a']}:{r['b']}") for r in found.collect()}
    return {name: by_name.get(name, Input(0, 0, "")) for name in paths}


def fingerprint(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


class Finished:
    """Marks on stage folders that say what they were made from, so that a rerun can leave them."""

    def __init__(self, spark: SparkSession, resume: bool):
        self.spark, self.resume = spark, resume

    def stage(self, folder: str, made_from: str, build: Callable[[], tuple[DataFrame, dict]]) -> tuple[DataFrame, dict]:
        """The stage in a folder and what was counted when it was written.

        ``build`` writes it, unless it stands there already, made from the same.
        """
        place = f"{folder}/{MARKER}"
        if self.resume and versions.exists(self.spark, place):
            mark = json.loads(versions.read_text(self.spark, place))
            if mark["made_from"] == made_from:
                schema = T.StructType.fromJson(mark["schema"])
                return self.spark.read.schema(schema).parquet(folder), mark["counts"]
        df, counts = build()
        # The folder was replaced with its mark, so a mark always belongs to the rows beside it.
        versions.write_text(self.spark, place, json.dumps({"made_from": made_from, "schema": df.schema.jsonValue(), "counts": counts}))
        return df, counts
