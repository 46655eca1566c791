"""Scans. Every row file is read under a declared schema, never an inferred one."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class InputError(Exception):
    """An input does not have the columns its schema declares."""


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """A delimited file with a header row under a declared ``schema``.

    The header must name the declared columns in their order, or raises; ``aliases``
    gives another accepted spelling of a declared name. Spark checks it in every file
    that it reads. A cell that does not parse becomes NULL; :func:`unparsed_cells`
    counts those. Unreadable input raises.
    """
    return spark.read.schema(_headed(spark, path, schema, sep, aliases)).csv(
        path, header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False
    ).toDF(*T.StructType.fromDDL(schema).names)


def _headed(
    spark: SparkSession, path: str | list[str], schema: str, sep: str, aliases: Mapping[str, str] | None, text: bool = False
) -> T.StructType:
    """The declared schema under the spellings that the header uses."""
    declared, known = T.StructType.fromDDL(schema), dict(aliases or {})
    header = spark.read.csv(path, header=True, sep=sep).columns
    accepted = [{f.name.lower(), known.get(f.name, f.name).lower()} for f in declared]
    if len(header) != len(declared) or any(h.lower() not in names for h, names in zip(header, accepted)):
        raise InputError(f"{path}: expected the columns {declared.names} in this order, found {header}")
    kinds = [T.StringType() if text else f.dataType for f in declared]
    return T.StructType([T.StructField(h, k) for h, k in zip(header, kinds)])


def unparsed_cells(
    spark: SparkSession, path: str | list[str], schema: str, sep: str = ",", aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Report per column of a delimited file: cells without a value, and cells that do not parse."""
    declared = T.StructType.fromDDL(schema)
    raw = spark.read.schema(_headed(spark, path, schema, sep, aliases, text=True)).csv(
        path, header=True, sep=sep, enforceSchema=False
    ).toDF(*declared.names)
    lines = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("missing"),
            F.count_if(F.col(f"`{f.name}`").isNotNull() & F.trim(f"`{f.name}`").try_cast(f.dataType).isNull()).alias("unparsed"),
        )
        for f in declared
    ]
    return raw.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or more Parquet tables; the files carry their own schema."""
    return spark.read.parquet(*paths)


def read_many(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    source: str = "parquet",
    lineage: str | None = None,
    **options: str,
) -> DataFrame:
    """Many files (say, one per month) as one table, in one scan.

    ``paths`` may hold folders and glob patterns: Spark lists and splits the files
    itself, so a hundred files are one wide stage rather than a union of a hundred
    plans. ``source`` is any format known to the session. ``lineage`` names a
    column that receives each row's file path.

    A file that lacks a declared column raises, as does the header of a CSV file that
    differs; without that check its rows would be read as NULLs. Parquet and ORC files are
    looked into by their footers, JSON files by the keys of their objects, other formats by
    whether the file holds any value of the column.
    """
    where = [paths] if isinstance(paths, str) else list(paths)
    if source == "csv":
        options.setdefault("enforceSchema", "false")
    df = spark.read.format(source).schema(schema).options(**options).load(where)
    if source != "csv":
        require_columns(df, where, source, options)
    if lineage:
        df = df.withColumn(lineage, F.col("_metadata.file_path"))
    return df


def input_files(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str] | None = None) -> DataFrame:
    """The files below paths: path, length and modificationTime. Their content is not read."""
    listed = {k: v for k, v in (options or {}).items() if k in ("basePath", "pathGlobFilter", "recursiveFileLookup")}
    return spark.read.format("binaryFile").options(**listed).load(list(paths)).select("path", "length", "modificationTime")


def require_columns(df: DataFrame, paths: Sequence[str], source: str, options: Mapping[str, str]) -> None:
    """Raise if any file that ``df`` scans lacks one of its columns, naming the first of them.

    Only one row comes back: how many files there are, how many fall short, and the first.
    """
    spark = df.sparkSession
    if source in ("parquet", "orc"):
        seen = _footer_evidence(input_files(spark, paths, options), df.columns, source)
    elif source == "json":
        seen = _key_evidence(spark, paths, options, df.columns)
    else:
        seen = _value_evidence(df)
    found = _worst(seen)
    if found["unread"]:
        # A store that only Spark opens: the scan itself has to tell.
        found = _worst(_value_evidence(df))
    if not found["files"] and input_files(spark, paths, options).isEmpty():
        raise InputError("there are no input files")
    if found["short"]:
        more = f", and so do {found['short'] - 1} more files" if found["short"] > 1 else ""
        raise InputError(f"{found['first']['file']} lacks {found['first']['missing']}{more}")


def _worst(seen: DataFrame) -> Row:
    """One row about files with the columns they lack (NULL: could not be opened)."""
    short = F.col("missing") != ""
    return seen.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(short).alias("short"),
        F.count_if(F.col("missing").isNull()).alias("unread"),
        F.min(F.when(short, F.struct("file", "missing"))).alias("first"),
    ).first()


def _footer_evidence(files: DataFrame, names: Sequence[str], source: str) -> DataFrame:
    """file and the columns it lacks, from footers that tasks read; many small files go to one task."""

    def run(batches: Iterator) -> Iterator:
        from pyarrow import ArrowException, fs, orc, parquet

        def columns(path: str) -> list[str]:
            system, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
            if source == "parquet":
                return parquet.read_schema(name, filesystem=system).names
            with system.open_input_file(name) as file:
                return orc.ORCFile(file).schema.names

        for batch in batches:
            missing = []
            for path in batch["path"]:
                try:
                    present = {n.lower() for n in columns(path)} | _folders(path)
                    missing.append(", ".join(n for n in names if n.lower() not in present))
                except (ArrowException, OSError, ImportError):
                    missing.append(None)
            yield batch.rename(columns={"path": "file"}).assign(missing=missing)

    return files.select("path").mapInPandas(run, "file string, missing string")


def _folders(path: str) -> set[str]:
    """Columns that the folders of a path give a value to."""
    return {part.partition("=")[0].lower() for part in path.split("/")[:-1] if "=" in part}


def _missing(names: Sequence[str], present: Sequence[Column]) -> Column:
    """The names that are neither present nor columns of the file's folders, joined."""
    by_folder = [F.col("file").rlike(f"(?i)/{re.escape(n)}=[^/]*/") for n in names]
    return F.array_join(F.array(*[F.when(~(p | f), F.lit(n)) for n, p, f in zip(names, present, by_folder)]), ", ")


def _key_evidence(spark: SparkSession, paths: Sequence[str], options: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """file and the columns that none of its objects has as a key."""
    whole = str(options.get("multiLine", "false")).lower() == "true"
    shared = {k: v for k, v in options.items() if k in ("basePath", "pathGlobFilter", "recursiveFileLookup")}
    text = spark.read.options(**shared).text(list(paths), wholetext=whole)
    keys = F.coalesce(F.json_object_keys("value"), F.json_object_keys(F.get_json_object("value", "$[0]")))
    lines = text.where("trim(value) <> ''").select(F.col("_metadata.file_path").alias("file"), keys.alias("keys"))
    has = [F.coalesce(F.bool_or(F.array_contains("keys", n)), F.lit(False)) for n in names]
    return lines.groupBy("file").agg(*[h.alias(f"__{i}") for i, h in enumerate(has)]).select(
        "file", _missing(names, [F.col(f"__{i}") for i in range(len(names))]).alias("missing")
    )


def _value_evidence(df: DataFrame) -> DataFrame:
    """file and the columns it holds no value of, by a scan."""
    names = df.columns
    rows = df.select(F.col("_metadata.file_path").alias("file"), *[F.col(f"`{n}`").alias(f"__{i}") for i, n in enumerate(names)])
    counted = rows.groupBy("file").agg(*[F.count(f"__{i}").alias(f"__{i}") for i in range(len(names))])
    return counted.select("file", _missing(names, [F.col(f"__{i}") > 0 for i in range(len(names))]).alias("missing"))


@dataclass(frozen=True)
class Landed:
    """A delimited file as a stage: its rows, those with a fault, and what was counted on the way."""

    staged: DataFrame
    counts: dict[str, int]
    columns: tuple[str, ...]

    @property
    def rows(self) -> DataFrame:
        """The rows that were to be kept, the faulty ones with NULL in cells that do not parse."""
        return self.staged.where("__kept").select(*[f"`{n}`" for n in self.columns])

    @property
    def rejected(self) -> DataFrame:
        """The faulty rows as file, line, and names of the columns at fault."""
        of = {"__file": "file", "__line": "line", "__faults": "faults"}
        return self.staged.where("__faulty = 1").select(*[F.col(c).alias(n) for c, n in of.items()])

    def unparsed(self) -> dict[str, int]:
        """Cells that do not parse, by column: a look at the faulty rows, if there are any."""
        found = dict.fromkeys(self.columns, 0)
        if self.counts["faulty"]:
            cells = self.rejected.select(F.explode("faults").alias("column")).groupBy("column").count()
            found |= {r["column"]: r["count"] for r in cells.collect()}
        return found

    def report(self) -> DataFrame:
        """Per column: cells without a value, and cells that do not parse; all rows must have been kept."""
        unparsed = self.unparsed()
        nulls = self.rows.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in self.columns])
        lines = [F.struct(F.lit(c).alias("column"), (F.col(f"`{c}`") - n).alias("missing"), F.lit(n).cast("long").alias("unparsed")) for c, n in unparsed.items()]
        return nulls.select(F.inline(F.array(*lines)))


def land_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    folder: str,
    sep: str = ",",
    aliases: Mapping[str, str] | None = None,
    keep: Column | None = None,
    most_faulty: int | None = None,
    mode: str = "errorifexists",
) -> Landed:
    """Parse a delimited file once: its rows and its faulty rows to one stage table.

    A row is faulty if a cell does not parse or the number of cells differs. It stays among
    the rows with NULL in such cells, as :func:`read_csv` gives it, and is marked there as
    faulty, with its file, its line as it was, and the columns at fault.
    ``keep`` thins out the rows; faulty ones are kept whatever it says, and all rows are
    counted before it. More than ``most_faulty`` faulty rows raise, once the stage shows them.
    """
    declared = T.StructType.fromDDL(schema)
    names = declared.names
    headed = _headed(spark, path, schema, sep, aliases)
    whole = T.StructType([*headed.fields, T.StructField("__line", T.StringType())])
    parsed = spark.read.schema(whole).csv(
        path, header=True, sep=sep, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord="__line"
    )
    rows = parsed.select(
        *[F.col(f"`{h}`").alias(n) for h, n in zip(headed.names, names)], "__line", F.col("_metadata.file_path").alias("__file")
    )
    # Only the few lines at fault are taken apart again, to see which cells had something in them.
    cells = F.from_csv("__line", ", ".join(f"`{n}` string" for n in names), {"sep": sep})
    rows = rows.withColumn("__cells", F.when(F.col("__line").isNotNull(), cells))
    at_fault = [F.col(f"`{n}`").isNull() & F.col("__cells").getField(n).isNotNull() for n in names]
    rows = rows.withColumn("__faults", F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in zip(names, at_fault)])))
    counts = {"rows": F.count(F.lit(1)), "faulty": F.count("__line")}
    rows = rows.drop("__cells").withColumn("__faulty", F.col("__line").isNotNull().cast("int"))
    rows = rows.withColumn("__kept", F.lit(True) if keep is None else F.coalesce(keep, F.lit(False)))
    landed = Landed(*_landed(rows, folder, counts, mode), tuple(names))
    if most_faulty is not None and landed.counts["faulty"] > most_faulty:
        first = landed.rejected.orderBy("file", "line").first()
        raise InputError(
            f"{landed.counts['faulty']} faulty rows where {most_faulty} are allowed, such as {first['line']!r} in {first['file']}"
        )
    return landed


def _landed(rows: DataFrame, folder: str, counts: Mapping[str, Column], mode: str) -> tuple[DataFrame, dict[str, int]]:
    """Write the rows where they were parsed, and count before thinning.

    No shuffle and no sort lies between, so a task streams its share of the text and holds none of
    it. ``__faulty`` is a plain column: the files' statistics let a look at the faulty rows skip
    the row groups without any.
    """
    from starlane.sources.sinks import write_stage

    seen = Observation()
    observed = rows.observe(seen, *[c.alias(name) for name, c in counts.items()]).where("__kept OR __faulty = 1")
    return write_stage(observed, folder, mode=mode), seen.get
