"""Benchmark decontamination with generalised suffix automata of the test items.

The words of the items are dealt into shards of bounded size, long items as overlapping
segments, and a task builds one automaton per shard: a state stands for the word sequences
that end at the same places of the items. The automata are written to the shared folder.
Texts are streamed through them word by word; the automaton's state and the length matched
so far give the longest run of words, ending at each word, that also stands in some item.
A run of at least ``window`` words marks its words as hit, and the state whose sequences
have ``window`` words names the items. Items shorter than a window count as a whole:
each state knows the longest whole item that ends it.

Documents are neither shuffled nor joined. Each task holds a few automata at a time, and
streams its texts through the shards one after the other.

Defined cases: NULL text has no words, and neither do texts of marks only; an item without
words matches nothing; an item without an id is matched but not named; equal items are all
named; a NULL doc_id and repeated documents are kept; an empty table of items leaves all
documents clean, an empty table of documents gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import new_file, open_folder, stage, table
from starlane.sources.scratch import scratch_folder

WINDOW = 10
SHARD_WORDS = 50_000
SEGMENT_WORDS = 2_000
PAIR_BITS = 22
# Words are runs of ASCII letters, digits, and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PARTED = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,stop:long,from:long,to:long>>"


SPAN = pa.struct([(c, pa.int64()) for c in ("start", "stop", "from", "to")])


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8, A to Z in lower case."""
    return text.translate(PARTED).split() if text else []


class Automaton:
    """A generalised suffix automaton over numbered words, built item by item."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, word: int, q: int) -> int:
        """The part of state ``q`` that is reached from ``p``, as a state of its own."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, last: int, word: int) -> int:
        """Append a word to the sequence that ends in state ``last``."""
        q = self.next[last].get(word)
        if q is not None:  # an earlier item has this sequence
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return new

    def ends(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """The state and matched length after each word of a sequence."""
        state, matched = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(word, 0)
            matched = matched + 1 if state else 0
            yield state, matched


def built(items: list[tuple[str | None, bool, list[bytes]]], window: int) -> dict[str, pa.Array]:
    """The automaton of (item_id, whole, words) as arrays.

    ``whole`` tells that the words are all of the item's, not a segment of them.
    """
    number: dict[bytes, int] = {}
    coded = [[number.setdefault(w, len(number)) for w in words] for _, _, words in items]
    automaton = Automaton()
    for words in coded:
        last = 0
        for word in words:
            last = automaton.add(last, word)
    link, length, n = automaton.link, automaton.length, len(automaton.link)

    # The state on the way to the root that holds the sequences of ``window`` words.
    at_window, named = [-1] * n, {}
    for s in sorted(range(1, n), key=length.__getitem__):
        if length[s] >= window:
            at_window[s] = at_window[link[s]] if at_window[link[s]] >= 0 else s
    # The longest item below a window that ends in a state, and the states where such items end.
    short = [0] * n
    for i, words in enumerate(coded):
        name = items[i][0]
        for state, matched in automaton.ends(words):
            if matched >= window:
                named.setdefault(at_window[state], {})[name] = None
        if items[i][1] and 0 < len(words) < window:
            short[state] = len(words)
            named.setdefault(state, {})[name] = None
    # The nearest state on the way to the root, the state itself left out, where a short item ends.
    above = [0] * n
    for s in sorted(range(1, n), key=length.__getitem__):
        above[s] = link[s] if short[link[s]] else above[link[s]]
    pairs = [(s, w, t) for s, following in enumerate(automaton.next) for w, t in following.items()]
    states = sorted(named)
    return {
        "words": pa.array(list(number), pa.binary()),
        "from": pa.array([p[0] for p in pairs], pa.int64()),
        "by": pa.array([p[1] for p in pairs], pa.int64()),
        "to": pa.array([p[2] for p in pairs], pa.int64()),
        "link": pa.array(link, pa.int64()),
        "length": pa.array(length, pa.int64()),
        "at_window": pa.array(at_window, pa.int64()),
        "short": pa.array(short, pa.int64()),
        "above": pa.array(above, pa.int64()),
        "named": pa.array(states, pa.int64()),
        "names": pa.array([[x for x in named[s] if x is not None] for s in states], pa.list_(pa.string())),
        "least": pa.array([min([window, *[len(w) for (_, whole, _), w in zip(items, coded) if whole and w]])], pa.int64()),
    }


class Scanner:
    """Streams words through a stored automaton."""

    def __init__(self, arrays: dict[str, list], window: int):
        self.window = window
        self.number = {w: i for i, w in enumerate(arrays["words"])}
        self.step: list[dict[int, int]] = [{} for _ in arrays["link"]]
        for s, w, t in zip(arrays["from"], arrays["by"], arrays["to"]):
            self.step[s][w] = t
        self.link, self.length = arrays["link"], arrays["length"]
        self.at_window, self.short, self.above = arrays["at_window"], arrays["short"], arrays["above"]
        self.names = dict(zip(arrays["named"], arrays["names"]))
        self.least = arrays["least"][0]
        # Which two words follow one another in an item: a hashed table, so it may hold others too.
        last = np.full(len(self.link), -1, dtype=np.int64)
        last[arrays["to"]] = arrays["by"]  # all sequences of a state end with the same word
        first = last[np.array(arrays["from"], dtype=np.int64)]
        self.pairs = np.zeros(1 << PAIR_BITS, dtype=bool)
        self.pairs[self._slots(first, np.array(arrays["by"], dtype=np.int64))[first >= 0]] = True

    @staticmethod
    def _slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return (first * 40_503 + second) & ((1 << PAIR_BITS) - 1)

    def runs(self, words: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
        """Stretches of words whose neighbours all follow one another in some item, long enough to hold a match."""
        if not words:
            return
        get = self.number.get
        ids = np.fromiter([get(w, -1) for w in words], dtype=np.int64, count=len(words))
        known = ids >= 0
        joined = known[:-1] & known[1:] & self.pairs[self._slots(ids[:-1], ids[1:])]
        # A stretch starts at a known word that is not joined to the one before it.
        starts = np.flatnonzero(known & ~np.concatenate([[False], joined]))
        stops = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
        for k in np.flatnonzero(stops - starts >= self.least):
            a, b = int(starts[k]), int(stops[k])
            yield a, b, ids[a:b].tolist()

    def scan(self, words: list[bytes], spans: list[tuple[int, int]], names: set[str]) -> None:
        """Add the hit spans of words, and the names of the items they stem from."""
        step, link, length, window = self.step, self.link, self.length, self.window
        for a, _, ids in self.runs(words):
            state = matched = 0
            for i, word in enumerate(ids, a + 1):
                to = step[state].get(word)
                while to is None and state:
                    state = link[state]
                    matched = length[state]
                    to = step[state].get(word)
                state, matched = (0, 0) if to is None else (to, matched + 1)
                if matched >= window:
                    spans.append((i - matched, i))
                    names.update(self.names.get(self.at_window[state], ()))
                # Whole short items that end here: in this state if matched in full, and in those above it.
                s = state if self.short[state] and self.short[state] <= matched else self.above[state]
                while s:
                    spans.append((i - self.short[s], i))
                    names.update(self.names[s])
                    s = self.above[s]


@lru_cache(maxsize=4)
def scanner(folder: str, name: str, window: int) -> Scanner:
    system, path = open_folder(folder)
    with system.open_input_file(f"{path}/{name}") as file, pa.ipc.open_file(file) as reader:
        row = reader.read_all().to_pylist()[0]
    return Scanner(row, window)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def item_segments(items: DataFrame, window: int = WINDOW, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The items' words in segments that overlap by a window less one word: item_id, whole, words."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.col("item_id").cast("string").alias("item_id"), F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)).alias("words"))
    size, step = F.size("words"), segment_words
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), size - F.lit(window - 1)), F.lit(step))
    return (
        words.where("size(words) > 0")
        .select("item_id", (size <= step + window - 1).alias("whole"), "words", F.explode(starts).alias("at"))
        .select("item_id", "whole", F.slice("words", F.col("at"), F.lit(step + window - 1)).alias("words"))
        .distinct()
    )


def write_automata(items: DataFrame, folder: str, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> list[str]:
    """Build and write an automaton per shard of the items; the names of the files.

    The driver sees one name per ``shard_words`` words of test items.
    """
    segments = stage(item_segments(items, window), "segments")
    total = segments.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    shards = -(-total // shard_words)
    if not shards:
        return []

    def build(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        arrays = built([(r["item_id"], r["whole"], [w.encode() for w in r["words"]]) for r in rows], window)
        stored = pa.RecordBatch.from_arrays([pa.array([a.to_pylist()], pa.list_(a.type)) for a in arrays.values()], list(arrays))
        with new_file(folder, "automaton") as (stream, name):
            with pa.ipc.new_file(stream, stored.schema) as writer:
                writer.write(stored)
        return pa.table({"shard": pa.array([rows[0]["shard"]], pa.int64()), "name": [name]})

    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))
    index = stage(dealt.groupBy("shard").applyInArrow(build, "shard long, name string"), "automata")
    return [r["name"] for r in index.orderBy("shard").collect()]


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, keep_text: bool = False
) -> DataFrame:
    """Every document with its words, its hit words, the items it holds, and the hit spans.

    A span has its first word and the one after its last, and the bytes of the text from the
    first to the end of the last. ``items`` are the ids as strings, sorted. ``keep_text`` adds
    the text, for :func:`remove_leaks`.
    """
    folder = scratch_folder(docs.sparkSession, "automata")
    files = write_automata(items, folder, window, shard_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                texts = [t or b"" for t in some.column(1).cast(pa.binary()).to_pylist()]
                found: list[tuple[list, set]] = [([], set()) for _ in texts]
                counts = [0] * len(texts)
                for k, name in enumerate(files):
                    automaton = scanner(folder, name, window)
                    for i, text in enumerate(texts):
                        words = words_of(text)
                        counts[i] = len(words)
                        automaton.scan(words, *found[i])
                if not files:
                    counts = [len(words_of(t)) for t in texts]
                spans = [merged(s) for s, _ in found]
                columns = {
                    "doc_id": some.column(0),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_hit": pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                    "items": pa.array([sorted(names, key=str.encode) for _, names in found], pa.list_(pa.string())),
                    "spans": pa.array([placed(t, s) for t, s in zip(texts, spans)], pa.list_(SPAN)),
                }
                if keep_text:
                    columns["text"] = some.column(1)
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return docs.select("doc_id", "text").mapInArrow(run, f"{FOUND}, text string" if keep_text else FOUND)


def placed(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Spans of words with the bytes they take in a text."""
    if not spans:
        return []
    parted = np.frombuffer(text.translate(PARTED), dtype=np.uint8) != 0x20
    edges = np.diff(np.concatenate([[False], parted, [False]]).astype(np.int8))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [{"start": a, "stop": b, "from": int(starts[a]), "to": int(stops[b - 1])} for a, b in spans]


def remove_leaks(leaks: DataFrame, least_words: int = WINDOW, most_coverage: float = 0.5) -> DataFrame:
    """The documents (doc_id, text) without spans of at least ``least_words`` words.

    A document with more than ``most_coverage`` of its words hit goes as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                for span in reversed([s for s in spans if s["stop"] - s["start"] >= least_words]):
                    text = text[: span["from"]] + text[span["to"] :]
                texts.append(None if text is None else text.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kept = leaks.where(F.col("n_hit") <= F.lit(most_coverage) * F.col("n_words"))
    return kept.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string")


def op13_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP13_SQL = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (
    SELECT row_number() OVER () AS r, doc_id, CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS w FROM documents
),
places AS (
    SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM doc, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
),
met AS (SELECT r, i, size, item_id FROM places JOIN windows USING (size, win)),
hit AS (
    SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT DISTINCT r, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT r, i, size FROM met)) GROUP BY r
),
named AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""
