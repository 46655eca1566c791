"""Language identification in two steps: the family first, then languages within it.

A text is a vector of hashed letter n-grams (one to three letters or spaces, lower case;
everything else is a space). Linear support vector machines, one versus one, part the
families of languages, and then the languages within the chosen family, where closely
related ones need a boundary of their own. Each machine is trained in a task of its own, on
at most about ``SAMPLE`` labelled texts of either side; prediction reads every whole text.

Defined cases: NULL text, or one without a letter, is ``und`` with score 0, as is every text
where nothing could be learned; rows with NULL lang or doc_id are not learned from; a NULL
doc_id is not held out; repeated rows are predicted each for itself; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import table

#: The families of common languages. Any other language is a family by itself.
FAMILIES = {
    "germanic": ["en", "de", "nl", "da", "sv", "no", "nb", "nn", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ca", "ro", "gl"],
    "slavic": ["ru", "uk", "be", "bg", "pl", "cs", "sk", "sl", "hr", "sr", "mk"],
    "finnic": ["fi", "et"],
    "turkic": ["tr", "az", "kk"],
    "semitic": ["ar", "he"],
    "indic": ["hi", "ur", "bn", "mr", "ne"],
    "sinitic": ["zh", "yue"],
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}

BUCKETS = 1 << 13
#: Labelled texts of a language, or of a family, that a machine learns from.
SAMPLE = 800
SLOPE = 4.0
UNKNOWN = "und"
SPACE = 32


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point of the basic plane the lower-case letter, or a space."""
    return np.array([ord(chr(c).lower()[0]) if chr(c).isalpha() else SPACE for c in range(1 << 16)], dtype=np.uint32)


def letters(text: str) -> np.ndarray:
    """The letters of a text in lower case, with one space for all that stands between them."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    if points.max(initial=0) < 1 << 16:
        out = letter_table()[points]
    else:
        high = points >> 16 > 0
        out = letter_table()[np.where(high, SPACE, points)]
        out[high] = [c if chr(c).isalpha() else SPACE for c in points[high].tolist()]
    gap = out == SPACE
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    return out[keep]


def features(text: str | None) -> np.ndarray | None:
    """The square root of each bucket's share of n-grams: a vector of length one. None without a letter."""
    a = letters(text or "")
    if not (a != SPACE).any():
        return None
    a = np.concatenate([[SPACE], a, [SPACE]]).astype(np.uint32)
    one = a * np.uint32(0x9E3779B1)
    two = one[:-1] * np.uint32(31) ^ a[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(31) ^ a[2:] * np.uint32(0xC2B2AE35)
    counts = np.zeros(BUCKETS)
    for grams in (one, two, three):
        grams = (grams ^ grams >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
        counts += np.bincount(grams >> np.uint32(19), minlength=BUCKETS)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, strength: float = 30.0, steps: int = 120) -> np.ndarray:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradients."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    cost = (2 * strength * share).astype(np.float32)
    step = 1.0 / (1.0 + 2 * 2 * strength)
    w = ahead = np.zeros(x.shape[1], dtype=np.float32)
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        gradient = ahead - x.T @ (cost * y * slack)
        new = ahead - step * gradient
        ahead = new + t / (t + 3) * (new - w)
        w = new
    return w


def labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` rows to learn from for each language, by a hash of the doc_id."""
    usable = docs.where("lang is not null and doc_id is not null and text is not null").where(~held_out())
    # One number a language: as a map in the filter, it spares moving any text.
    counts = usable.groupBy("lang").count().collect()
    if not counts:
        return usable.select("lang", "text").limit(0)
    shares = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, 1_000_000 * sample // n + 1)])
    return usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < shares[F.col("lang")]).select("lang", "text")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Machines by the two classes they part; a positive value speaks for the first.

    A class is a language, or a family as :func:`family` gives it.
    """

    def __init__(self, weights: dict[tuple, np.ndarray], langs: list[str]):
        self.langs = sorted(langs)
        self.pairs = list(weights)
        self.matrix = np.array([weights[p] for p in self.pairs], dtype=np.float32).reshape(len(self.pairs), BUCKETS + 1)
        self.members: dict[tuple, list[str]] = {}
        for lang in self.langs:
            self.members.setdefault(family(lang), []).append(lang)

    def _winner(self, classes: list, values: dict[tuple, float]) -> tuple:
        """The class that wins most of its machines, and its surest doubt."""
        if len(classes) == 1:
            return classes[0], 1.0
        votes = dict.fromkeys(classes, 0.0)
        for i, a in enumerate(classes):
            for b in classes[i + 1 :]:
                v = float(np.clip(values[a, b], -1, 1))
                votes[a] += v
                votes[b] -= v
        best = max(classes, key=lambda c: votes[c])
        worst = min(values[best, b] if (best, b) in values else -values[b, best] for b in classes if b != best)
        return best, float(1 / (1 + np.exp(-SLOPE * worst)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        known = [(i, x) for i, t in enumerate(texts) if (x := features(t)) is not None]
        if not known or not self.langs:
            return langs, scores
        x = np.array([v for _, v in known])
        values = x @ self.matrix[:, :-1].T + self.matrix[:, -1]
        families = sorted(self.members)
        for (i, _), row in zip(known, values.tolist()):
            of = dict(zip(self.pairs, row))
            best, sure = self._winner(families, of)
            lang, surer = self._winner(self.members[best], of)
            langs[i], scores[i] = lang, sure * surer
        return langs, scores


def family(lang: str) -> tuple[bool, str]:
    """The family of a language, whether or not it is a listed one; others are each their own."""
    return (True, FAMILY_OF[lang]) if lang in FAMILY_OF else (False, lang)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Train every machine in a task of its own; only their weights come to the driver."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang, x) for lang, t in zip(*[c.to_pylist() for c in batch.columns]) if (x := features(t)) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, _ in found], pa.string()), pa.array([x.tobytes() for _, x in found], pa.binary())], ["lang", "x"]
            )

    rows = labelled_sample(docs.select("doc_id", "lang", "text"), sample).mapInArrow(vectors, "lang string, x binary")
    langs = sorted(r[0] for r in docs.where("lang is not null and doc_id is not null").where(~held_out()).select("lang").distinct().collect())
    members: dict[tuple, list[str]] = {}
    for lang in langs:
        members.setdefault(family(lang), []).append(lang)
    # The two classes of each machine, and the languages on either side.
    sides = {(a, b): ([a], [b]) for of in members.values() for a in of for b in of if a < b}
    sides |= {(a, b): (members[a], members[b]) for a in members for b in members if a < b}
    pairs = list(sides)
    tasks = [(lang, i, side) for i, p in enumerate(pairs) for side, of in zip((1, -1), sides[p]) for lang in of]
    if not tasks:
        return Model({}, langs)

    def machine(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows["x"]), dtype=np.float32).reshape(-1, BUCKETS)
        return pd.DataFrame({"pair": [key[0]], "w": [train(x, rows["side"].to_numpy(np.float32)).astype("<f4").tobytes()]})

    by_lang = docs.sparkSession.createDataFrame(tasks, "lang string, pair int, side int")
    trained = rows.join(F.broadcast(by_lang), "lang").groupBy("pair").applyInPandas(machine, "pair int, w binary")
    # A pair without a sample on either side has no machine and cannot be told apart.
    weights = {p: np.zeros(BUCKETS + 1, dtype=np.float32) for p in pairs}
    return Model({**weights, **{pairs[r["pair"]]: np.frombuffer(r["w"], dtype="<f4") for r in trained.collect()}}, langs)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                langs, scores = model.predict(some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.35) -> DataFrame:
    """The documents whose language is told with a score of ``least`` or more, with all their columns."""
    model, at = fit(docs), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                langs, scores = model.predict(some.column(at).to_pylist())
                yield some.filter(pa.array([lang != UNKNOWN and s >= least for lang, s in zip(langs, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
