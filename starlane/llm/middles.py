"""Fill-in-the-middle examples, cut by repeated-capture matching.

A text is a repetition of units: one ``fullmatch`` of ``(unit)*`` keeps every repetition of
its group, so ``match.ends(1)`` holds the number of units and the offset after each of
them, and both cuts are read from it. Texts of more than ``BLOCK`` code points are matched
block by block, as a match holds about a hundred bytes for each repetition; the last unit
of a block that goes on is matched again with what follows, so the units are the same.

Where to cut and how to arrange the parts comes from a digest of the document's id, so a
document is always arranged alike, whatever the partitions. The example is turned back
into the text from itself and its form alone: a text that holds a mark stays plain, and a
mark cannot come about where two parts meet, as marks overlap with nothing but themselves.

Defined cases: NULL or empty text is an empty plain example of no units; a NULL doc_id is
arranged by the empty id; a text that is no repetition of units stays plain, its number of
units NULL; repeated rows are arranged each for itself; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import table

BLOCK = 1_000_000
CODE_POINT = "."

EXAMPLES = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        for mark in self.all:
            inner = mark[1:-1]
            if len(mark) < 2 or mark[0] == mark[-1] or any(end in inner for end in (mark[0], mark[-1])):
                raise ValueError(f"{mark} can overlap with a part of itself")
        if len({(m[0], m[-1]) for m in self.all}) > 1 or len(set(self.all)) < 3:
            raise ValueError("the marks have to differ, and to begin and end alike")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@dataclass(frozen=True)
class Rates:
    """How many of a hundred documents stay plain, and how many of the rest lead with the suffix."""

    plain: int = 10
    suffix_first: int = 20


class Cutter:
    """The ends of the units of a text."""

    def __init__(self, unit: str = CODE_POINT, block: int = BLOCK):
        self.units = regex.compile(f"({unit})*", regex.DOTALL)
        self.block = block

    def ends(self, text: str) -> np.ndarray | list[int] | None:
        """The offset after each unit, None if the text is no repetition of units."""
        if len(text) <= self.block:
            match = self.units.fullmatch(text)
            return None if match is None else match.ends(1)
        found, at, size = [], 0, self.block
        while at < len(text):
            to = min(len(text), at + size)
            ends = self.units.match(text, at, to).ends(1)
            if to < len(text):
                ends = ends[:-1]
            if ends:
                found.append(np.array(ends, dtype=np.int64))
                at, size = ends[-1], self.block
            elif to < len(text):
                size *= 2  # a unit longer than the block
            else:
                return None
        return np.concatenate(found)


def draws(salt: int, doc_id: int | None) -> list[int]:
    """Four numbers from a document's id: two cuts, plain or not, and the arrangement."""
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def arranged(text: str, doc_id: int | None, cutter: Cutter, marks: Marks, rates: Rates, salt: int) -> tuple:
    """(units, form, code points of the prefix and of the middle, example) of one text."""
    ends = cutter.ends(text)
    n = None if ends is None else len(ends)
    a, b, plain, way = draws(salt, doc_id)
    if not n or plain % 100 >= 100 - rates.plain or any(m in text for m in marks.all):
        return n, "plain", None, None, text
    first, second = sorted((a % (n + 1), b % (n + 1)))
    i, j = (int(ends[k - 1]) if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if way % 100 < rates.suffix_first:
        form, output = "spm", f"{marks.suffix}{suffix}{marks.prefix}{prefix}{marks.middle}{middle}"
    else:
        form, output = "psm", f"{marks.prefix}{prefix}{marks.suffix}{suffix}{marks.middle}{middle}"
    return n, form, i, j - i, output


def fill_in_middle(
    docs: DataFrame, unit: str = CODE_POINT, marks: Marks = Marks(), rates: Rates = Rates(), salt: int = 1
) -> DataFrame:
    """One example per document: its units, form, the lengths of prefix and middle, and the example."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(unit)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = some.column(0)
                rows = [arranged(t or "", d, cutter, marks, rates, salt) for d, t in zip(ids.to_pylist(), some.column(1).to_pylist())]
                n, form, prefix, middle, output = zip(*rows)
                whole = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, whole), pa.array(form, pa.string()), pa.array(prefix, whole), pa.array(middle, whole), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, EXAMPLES)


def restored(form: str = "form", output: str = "output", marks: Marks = Marks()) -> Column:
    """The text of an example, from its form and itself alone."""
    example = F.col(output)

    def after(mark: str) -> Column:
        return F.locate(mark, example) + F.lit(len(mark))

    def between(left: str, right: str) -> Column:
        start = after(left)
        return F.substring(example, start, F.locate(right, example) - start)

    middle = F.substring(example, after(marks.middle), F.length(example))
    psm = F.concat(between(marks.prefix, marks.suffix), middle, between(marks.suffix, marks.middle))
    spm = F.concat(between(marks.prefix, marks.middle), middle, between(marks.suffix, marks.prefix))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(example)


def op12_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fill_in_middle(table(spark, sf_dir, "documents"))
    return examples.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
cut AS (
    SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
           CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT *, substring(text, 1, least(a, b)) AS prefix, substring(text, least(a, b) + 1, abs(a - b)) AS middle,
           substring(text, greatest(a, b) + 1) AS suffix
    FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""
