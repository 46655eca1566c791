"""Licence scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright statements dropped, punctuation and
white space turned into single spaces, and equivalent spellings made equal. A statement is the
word or sign with a year or a holder; a line of the licence's body that happens to begin with
the word is kept, so the form does not depend on where the lines break. The digest of the
whole form is looked up among the digests of known licence texts and notices by a hash join.
Texts looked up are each document as a whole, each of its lines, as notices mostly stand on
a line of their own, and runs of lines, as headers of several lines do; blank and comment lines
within a run do not count. Of all runs, those are made that begin with the first words of a
known text and have as many words as one in canonical form. All of it is DataFrame expressions.

Defined cases: a NULL text, and one that has no letter or digit in its canonical form, matches
nothing; NULL doc_id and repeated rows are looked up each for itself; a text that is one line
is found as a whole and as that line; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import stage, table

#: What can follow a copyright statement on its line: the body of a licence.
BODY = (
    r"permission is hereby|permission to use|redistribution and use|redistributions of|licensed under|licensed to|released under|"
    r"this (?:program|library|software|file|work|project|source|code|product|material|license|is) |the above copyright|"
    r"everyone is permitted|use of this|your use of|you may|see (?:the )?licen[cs]e|distributed under"
)
#: Words that follow "copyright" within the body of a licence, where a holder's name would follow in a statement.
NOT_A_HOLDER = (
    r"holders?|owners?|notices?|licen[cs]es?|licen[cs]ed|laws?|acts?|interests?|in|and|or|as|is|are|to|of|on|for|from|that|which|with|under|"
    r"statements?|protection|treaty|treaties|ownership|claims?|rights?|disclaimers?|information|infringement|permissions?|grants?|terms?|"
    r"materials?|legends?|status|control|management|resulting|applies|applicable|conditions?|lines?|page|appl\w*|but|if|may|must|shall|s"
)
_YEAR = r"[^a-z0-9\n]{0,3}(?:[12][0-9]{3}|yyyy|year)\b"
_MARK = r"(?:copyright|©|\(c\))(?:[^a-z0-9\n]*?(?:copyright|©|\(c\)))*"
_NAMED = rf"copyright[ \t:]+(?:by[ \t]+)?(?!(?:{NOT_A_HOLDER})\b)(?=\p{{L}}|\[|<)(?=(?:[^\s]+[ \t\r]*){{1,8}}\Z)"
#: A statement at the start of a line: a mark and a year, a sign and a holder, or the word and a short name.
STATEMENT = rf"\A[^a-z0-9]*(?:portions[ \t]+)?(?:{_MARK}{_YEAR}|(?:copyright\s*)?©|copyright\s*\(c\)|{_NAMED})(?:[^\n]*?(?=\b(?:{BODY}))|[^\n]*\Z)"
#: A statement with a year between other words of a line and the body. It is looked for in what comes before the last
#: words of a body on its line, so every search ends at some, and a line of any length is read once.
STATEMENT_WITHIN = rf"{_MARK}{_YEAR}[^\n]*?(?=\b(?:{BODY})|\Z)"
BEFORE_BODY = rf"\A([^\n]*)\b(?:{BODY})"
RESERVED = "all rights reserved"

#: The rule of the SQL counterpart, which drops any line that begins with the word.
COPYRIGHT_LINE = r"\A[^a-z0-9]*(copyright|©|\(c\) *[0-9]|all rights reserved)[^\n]*"
#: Spellings that count as equal, after punctuation is gone.
SPELLINGS = [
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("licencing", "licensing"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("organisation", "organization"),
    ("organisations", "organizations"), ("favour", "favor"), ("fulfil", "fulfill"), ("judgement", "judgment"),
    ("merchantibility", "merchantability"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"), ("whilst", "while"), ("wilful", "willful"), ("v ([0-9])", "version $1"),
    ("https", "http"),
]

MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.
"""
#: The licence texts and notices of the SQL counterpart, by SPDX identifier; ``registry`` holds more.
KNOWN = [
    ("MIT", "text", MIT), ("MIT", "text", "The MIT License (MIT)\n" + MIT), ("MIT", "text", "MIT License\n" + MIT),
    ("ISC", "text", ISC), ("ISC", "text", "ISC License\n" + ISC),
    ("Apache-2.0", "notice", APACHE_NOTICE),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "notice", "Released under the MIT License."), ("MIT", "notice", "Licensed under the MIT License."),
    ("GPL-3.0-only", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "notice", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "notice", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "notice", "Licensed under the BSD 3-Clause License."),
]


#: Whether a form has any of the spellings, so that few forms are searched for each.
ANY_SPELLING = rf"\b({'|'.join(old for old, _ in SPELLINGS)})\b"


def plain_line(line: Column) -> Column:
    """A line in lower case with single spaces for punctuation, without copyright statements."""

    def plain(low: Column) -> Column:
        marked = low.contains("copyright") | low.contains("©") | low.contains("(c)")
        bare = bound(F.regexp_replace(low, STATEMENT, " "), without_inner_statements)
        return without_reserved(F.trim(F.regexp_replace(F.when(marked, bare).otherwise(low), r"[^\p{L}\p{N}]+", " ")))

    return bound(F.lower(line), plain)


def without_inner_statements(line: Column) -> Column:
    def cut(lead: Column) -> Column:
        return F.concat(F.regexp_replace(lead, STATEMENT_WITHIN, " "), F.substring(line, F.length(lead) + 1, F.length(line)))

    return bound(F.regexp_extract(line, BEFORE_BODY, 1), cut)


def without_reserved(form: Column) -> Column:
    bare = F.trim(F.regexp_replace(form, rf"\b{RESERVED}\b ?", ""))
    return F.when(form.contains(RESERVED), bare).otherwise(form)


def one_spelling(form: Column) -> Column:
    chain = reduce(lambda t, s: F.regexp_replace(t, rf"\b{s[0]}\b", s[1]), SPELLINGS, form)
    return F.when(form.rlike(ANY_SPELLING), chain).otherwise(form)


def digest(form: Column) -> Column:
    """The digest of a canonical form; NULL where that is empty."""
    form = without_reserved(form)
    return F.when(form != "", F.sha2(one_spelling(form), 256))


def registry() -> list[tuple[str, str, str]]:
    """All known texts: those of the data file and ``KNOWN``."""
    held = files("starlane.llm").joinpath("licence_registry.jsonl").read_text("utf-8").splitlines()
    return [*KNOWN, *((r["license_id"], r["kind"], r["text"]) for r in map(json.loads, held))]


def bound(value: Column, function) -> Column:
    """The function of a value, which is made once: an array of one binds it."""
    return F.transform(F.array(value), function)[0]


def joined(forms: Column) -> Column:
    return F.array_join(F.filter(forms, lambda x: x != ""), " ")


def plain_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), plain_line)


def unit_digests(lines: Column) -> Column:
    """Digests of the whole text, first, and of each of its lines."""
    return F.transform(F.concat(F.array(joined(lines)), lines), digest)


HEAD = 3


def head(form: Column) -> Column:
    return F.substring_index(form, " ", HEAD)


def n_words(form: Column) -> Column:
    return F.size(F.split(form, " "))


def known_digests(known: DataFrame) -> DataFrame:
    """Digests of known texts (license_id, kind, text), each with its first identifier."""
    form = one_spelling(without_reserved(joined(plain_lines(F.col("text")))))
    found = known.select("license_id", "kind", form.alias("form")).where("form != ''")
    return found.groupBy(F.sha2("form", 256).alias("digest")).agg(
        F.min("license_id").alias("license_id"), F.min("kind").alias("kind"), F.first(head(F.col("form"))).alias("head"), F.first(n_words(F.col("form"))).alias("words")
    )


def words_of_line(form: Column, before: Column) -> Column:
    """(words, merged): the words of a line's canonical form, and how many are gone where it follows the line before.

    Two words that are one in the common spelling, or the words of a reservation, may stand on two lines.
    """

    def counted(pair: Column) -> Column:
        own, above = pair["own"], pair["above"]
        tail, front = F.substring_index(above, " ", -2), F.substring_index(own, " ", 2)
        seam = one_spelling(without_reserved(F.concat(tail, F.lit(" "), front)))
        merged = n_words(tail) + n_words(front) - F.when(seam == "", 0).otherwise(n_words(seam))
        return F.struct(n_words(own).alias("words"), F.coalesce(merged, F.lit(0)).alias("merged"))

    return bound(F.struct(one_spelling(form).alias("own"), one_spelling(before).alias("above")), counted)


def run_digests(lines: Column, heads: Column, words: Column) -> Column:
    """(line, digest) of runs of two lines and more, but for the whole text, that may be known texts."""

    def of_filled(filled: Column) -> Column:
        forms, last = filled["form"], F.size(filled)

        def starts_known(i: Column) -> Column:
            return F.array_contains(heads, head(one_spelling(F.substring_index(F.array_join(F.slice(forms, i, 2 * HEAD), " "), " ", 2 * HEAD))))

        def of_starts(starts: Column) -> Column:
            steps = F.transform(forms, lambda x, t: words_of_line(x, F.when(t > 0, F.get(forms, t - 1))))

            def of_steps(steps: Column) -> Column:
                sums = F.aggregate(steps, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["words"] - x["merged"])))

                def runs(below: Column) -> Column:
                    def from_start(i: Column) -> Column:
                        def may_be_known(j: Column) -> Column:
                            n = below[j] - below[i - 1] + steps[i - 1]["merged"]
                            return ((i > 1) | (j < last)) & F.array_contains(words, n)

                        # Of two lines one adds a word at least.
                        ends = F.filter(F.sequence(i + 1, F.least(last, i + 2 * F.array_max(words))), may_be_known)
                        return F.transform(ends, lambda j: F.struct(filled[i - 1]["at"].alias("line"), digest(F.array_join(F.slice(forms, i, j - i + 1), " ")).alias("digest")))

                    return F.flatten(F.transform(starts, from_start))

                return bound(sums, runs)

            return F.when(F.size(starts) > 0, bound(steps, of_steps))

        return F.when(last > 1, bound(F.filter(F.sequence(F.lit(1), last - 1), starts_known), of_starts))

    placed = F.transform(lines, lambda x, i: F.struct((i + 1).alias("at"), x.alias("form")))
    return F.coalesce(bound(F.filter(placed, lambda x: x["form"] != ""), of_filled), F.array().cast("array<struct<line:int,digest:string>>"))


def scan(docs: DataFrame, known: DataFrame, few_known: bool = False, runs: bool = False) -> DataFrame:
    """A row for each document, or line or run of lines of one, that is a known text.

    Line 0 is the whole document; a run has the number of its first line. Runs are looked up
    if ``runs`` is set. ``few_known`` tells that the known texts are a fixed short list, which
    is then broadcast.
    """
    digests = known_digests(known)
    parts = docs.select("doc_id", F.coalesce(plain_lines(F.col("text")), F.array().cast("array<string>")).alias("lines"))
    units = F.transform(unit_digests(F.col("lines")), lambda x, i: F.struct(i.alias("line"), x.alias("digest")))
    if runs:
        marks = digests.agg(F.collect_set("head").alias("heads"), F.collect_set("words").alias("words"))
        parts = parts.crossJoin(F.broadcast(marks))
        units = F.concat(units, run_digests(F.col("lines"), F.col("heads"), F.col("words")))
    rows = parts.select("doc_id", F.explode(units).alias("unit")).select("doc_id", F.col("unit.line").cast("long").alias("line"), "unit.digest")
    found = digests.drop("head", "words")
    return rows.join(F.broadcast(found) if few_known else found, "digest").select("doc_id", "line", "license_id", "kind", "digest")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = stage(spark.createDataFrame(registry(), "license_id string, kind string, text string").coalesce(1), "licences")
    return scan(table(spark, sf_dir, "documents"), known, few_known=True, runs=True)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain_line_sql(line: str) -> str:
    bare = f"regexp_replace(lower({line}), {_quoted(COPYRIGHT_LINE)}, ' ')"
    return f"trim(regexp_replace({bare}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _one_spelling_sql(form: str) -> str:
    for old, new in SPELLINGS:
        form = f"regexp_replace({form}, '\\b{old}\\b', {_quoted(new.replace('$1', chr(92) + '1'))}, 'g')"
    return form


_LINES = f"list_transform(string_split(text, chr(10)), lambda x: {_plain_line_sql('x')})"
_WHOLE = "coalesce(list_aggregate(list_filter(lines, lambda x: x <> ''), 'string_agg', ' '), '')"
_KNOWN = ", ".join(f"({', '.join(map(_quoted, row))})" for row in KNOWN)

OP8_SQL = f"""
WITH known(license_id, kind, text) AS (VALUES {_KNOWN}),
k AS (SELECT sha256({_one_spelling_sql("form")}) AS digest, min(license_id) AS license_id, min(kind) AS kind
      FROM (SELECT license_id, kind, {_WHOLE} AS form FROM (SELECT license_id, kind, {_LINES} AS lines FROM known)) GROUP BY 1),
parts AS (SELECT doc_id, list_concat([{_WHOLE}], lines) AS units FROM (SELECT doc_id, {_LINES} AS lines FROM documents)),
units AS (SELECT doc_id, unnest(range(len(units))) AS line, unnest(units) AS form FROM parts),
found AS (SELECT doc_id, line, sha256({_one_spelling_sql("form")}) AS digest FROM units WHERE form <> '')
SELECT doc_id, line, license_id, kind, digest FROM found JOIN k USING (digest)
"""
