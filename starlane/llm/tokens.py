"""Token ids of whole texts from a tokenizers file, fast enough for a large corpus.

Text is cut at single spaces, where neither kind of vocabulary ever merges across, and pieces
into a word and the marks after it. Arrow cuts many texts at once and tells the different words
apart; only these are looked up in a bounded table that the Python worker keeps. Words that are
not there are encoded many at a time, and the ids of the texts are gathered by position, so no
step of Python is taken for a piece of a text. The ids equal those of encoding the whole
text; texts whose white space allows no such cut, and texts that hold the string of a
token added to the vocabulary (``<|endoftext|>``), are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Runs of three or more, or two at the end, are matched as a whole by byte-level vocabularies.
LONG_SPACE = re.compile(r"\s\s\s|\s\s\Z|[\x1c-\x1f\x85]")
CONTROL = "\x1c\x1d\x1e\x1f\x85"
ODD_SPACE = "\t\r\v\f" + CONTROL + "\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
SPACE = re.compile(r"\s")
# Letters, then ASCII marks but no apostrophe: both vocabularies part such a piece there.
WORD_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
LETTERS = "".join(c for c in map(chr, range(0x100)) if WORD_AND_MARKS.fullmatch(c))
MARKS = "".join(c for c in map(chr, range(0x80)) if WORD_AND_MARKS.fullmatch("a" + c) and c not in LETTERS)
#: Bytes of the texts that are cut together. More hold fewer different pieces for their length, but take more memory.
PORTION_BYTES = 8 << 20


def holds(text: str, characters: str) -> bool:
    """Whether any of the characters is in a text; a search for each is quicker than one for the class."""
    return any(c in text for c in characters)


def has_long_space(text: str) -> bool:
    pairs = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
    return (pairs or holds(text, ODD_SPACE)) and bool(LONG_SPACE.search(text))


def portions(batch: pa.RecordBatch, column: int = 1) -> Iterator[pa.RecordBatch]:
    """A batch in slices of whole rows, each with about ``PORTION_BYTES`` of text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PORTION_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def strings(array: pa.Array) -> list[str]:
    """An array of strings without spaces; one string of all is quicker to turn into Python's than each alone."""
    if not len(array):
        return []
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(array)], pa.int32()), array), " ")[0].as_py().split(" ")


def gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of coded spans one after the other, and the number of each."""
    found = sizes[codes]
    ends = np.cumsum(found)
    at = np.repeat(starts[codes] - (ends - found), found)
    at += np.arange(len(at))
    return ids[at], found


def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids as one array, and the number of each."""
    return np.frombuffer(b"".join(ids), dtype="<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4


class Words:
    """Ids of words in arrays: at most twice ``limit`` words, or 128 bytes of text for each of ``limit``, and those of one portion.

    Where there are more, the words of up to 64 bytes used last are kept, ``limit`` of them at most.
    """

    def __init__(self, limit: int):
        self.limit, self.clock = limit, 0
        self.words = pa.array([], pa.string())
        self.ids, self.sizes, self.used = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def _trim(self) -> None:
        if len(self.words) <= 2 * self.limit and self.words.nbytes <= 128 * self.limit:
            return
        last = np.argsort(-self.used, kind="stable")
        short = pc.binary_length(self.words).to_numpy()[last] <= 64
        keep = np.sort(last[short][: self.limit])
        self.ids, sizes = gather(self.ids, self.starts, self.sizes, keep)
        self.words, self.sizes, self.used = self.words.take(pa.array(keep)), sizes, self.used[keep]

    def find(self, words: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> np.ndarray:
        """The places of different words; those that are not there are encoded and added."""
        self._trim()
        self.clock += 1
        places = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().copy()
        missing = np.flatnonzero(places < 0)
        if len(missing):
            new = words.take(pa.array(missing))
            ids, sizes = joined(encode(strings(new)))
            places[missing] = np.arange(len(self.words), len(self.words) + len(new))
            self.words = pa.concat_arrays([self.words, new])
            self.ids, self.sizes = np.concatenate((self.ids, ids)), np.concatenate((self.sizes, sizes))
            self.used = np.concatenate((self.used, np.zeros(len(new), dtype=np.int64)))
        self.used[places] = self.clock
        return places


class PieceEncoder:
    """Encode texts as the tokenizers library does, adding no special tokens to them.

    ``spaced`` tells that a space belongs to the word after it (byte-level vocabularies);
    otherwise white space is dropped. ``cache_size`` is the limit of :class:`Words`.
    """

    def __init__(self, path: str, cache_size: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.spaced = bool(self._plain(" "))
        self.cache_size = cache_size
        self.words = Words(cache_size)
        self.first: dict[str, bytes] = {}
        # A mark that always is one token of its own and parts two pieces in one call.
        self.mark = "\n" if self.spaced else next(m for m in "~^|=" if len(self._plain(f"a {m} a")) == 3)
        self.mark_id = self._plain(self.mark)[0]
        self.line_end = np.array(self._plain("\n"), dtype="<u4").tobytes()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode_pieces(self, pieces: list[str], lead: str) -> list[bytes]:
        joinable = [p for p in pieces if p and self.mark not in p and not SPACE.search(p)]
        found: dict[str, bytes] = {}
        part = self.mark if self.spaced else f" {self.mark} "
        # The library's results hold far more than ids, so few pieces at a time.
        for i in range(0, len(joinable), 2000):
            groups = [joinable[k : k + 200] for k in range(i, min(i + 2000, len(joinable)), 200)]
            texts = [part.join([lead + p for p in some]) + part for some in groups]
            for some, encoded in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(encoded.ids, dtype="<u4")
                ends = np.flatnonzero(ids == self.mark_id)
                if len(ends) != len(some):
                    raise ValueError("a mark was merged with its neighbours")
                starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
                raw = ids.tobytes()
                found.update((p, raw[4 * a : 4 * b]) for p, a, b in zip(some, starts, ends.tolist()))
        rest = [p for p in pieces if p not in found]
        for p, e in zip(rest, self.tokenizer.encode_batch_fast([lead + p for p in rest], add_special_tokens=False)):
            found[p] = np.array(e.ids, dtype="<u4").tobytes()
        return [found[p] for p in pieces]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of words, a word after a line end with it."""
        lines = [w for w in words if self.spaced and w[:1] == "\n" and len(w) > 1]
        self._lead_pieces({w[1:] for w in lines})
        ready = {w: self.line_end + self.first[w[1:]] for w in lines}
        new = [w for w in words if w not in ready]
        ready.update(zip(new, self._encode_pieces(new, " " if self.spaced else "")))
        return [ready[w] for w in words]

    def _encode_different(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different pieces one after the other, and the number of each.

        A piece of letters and marks is cut between them: the word alone is more often met.
        """
        word, tail = pc.utf8_rtrim(pieces, MARKS), pc.utf8_ltrim(pieces, LETTERS)
        n = pc.binary_length(word)
        cut = pc.and_(pc.equal(pc.add(n, pc.binary_length(tail)), pc.binary_length(pieces)), pc.greater(n, 0))
        words = pc.if_else(cut, word if self.spaced else pc.utf8_lower(word), pieces).dictionary_encode()
        tails = pc.if_else(cut, tail, "").dictionary_encode()
        places = self.words.find(words.dictionary, self._encode_words)
        marks = strings(tails.dictionary)
        self._lead_pieces(set(marks))
        ids, sizes = joined([self.first[m] for m in marks])
        known, starts = len(self.words.sizes), self.words.starts
        codes = np.stack((places[words.indices.to_numpy()], tails.indices.to_numpy() + known), axis=1).ravel()
        found, n = gather(
            np.concatenate((self.words.ids, ids)), np.concatenate((starts, len(self.words.ids) + np.cumsum(sizes) - sizes)),
            np.concatenate((self.words.sizes, sizes)), codes,
        )
        return found, n.reshape(-1, 2).sum(axis=1)

    def _lead_pieces(self, pieces: set[str]) -> None:
        """Have the ids of pieces with no space before them in ``first``."""
        new = pieces.difference(self.first)
        if new and len(self.first) + len(new) > self.cache_size // 5:
            self.first, new = {}, pieces
        if new:
            cut = {p: m for p in new if (m := WORD_AND_MARKS.fullmatch(p)) and m[2]}
            whole = sorted(new.difference(cut).union(*[(m[1], m[2]) for m in cut.values()]).difference(self.first))
            self.first.update(zip(whole, self._encode_pieces(whole, "")))
            self.first.update((p, self.first[m[1]] + self.first[m[2]]) for p, m in cut.items())

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (NULL: none) as little-endian unsigned 32-bit integers."""
        texts = [t or "" for t in texts]
        spaces = [self._spaces(t) for t in texts]
        apart = self._encode_apart([t for t in spaces if t is not None])
        return [np.array(self._plain(t), dtype="<u4") if s is None else next(apart) for t, s in zip(texts, spaces)]

    def _spaces(self, text: str) -> str | None:
        """A text whose pieces between single spaces are encoded apart, the first with no space before it; None if it is encoded whole."""
        if any(token in text for token in self.added):
            return None
        if not self.spaced:
            if holds(text, CONTROL):
                return text
            return " ".join(text.split()) if holds(text, ODD_SPACE) else text.replace("\n", " ")
        if " \n" in text or has_long_space(text):
            return None
        # A line end between two words goes with the word after it.
        if "\n" in text and not ("\n\n" in text or "\n " in text or text[0] == "\n" or text[-1] == "\n"):
            text = text.replace("\n", " \n")
        return text

    def _encode_apart(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of texts, piece by piece."""
        if not texts:
            return
        split = pc.split_pattern(pa.array(texts, pa.string()), " ")
        bounds, coded = split.offsets.to_numpy(), split.values.dictionary_encode()
        codes = coded.indices.to_numpy()
        ids, sizes = self._encode_different(coded.dictionary)
        if self.spaced:
            heads = [t.partition(" ")[0] for t in texts]
            self._lead_pieces(set(heads))
            head_ids, head_sizes = joined([self.first[h] for h in heads])
            codes = codes.copy()
            codes[bounds[:-1]] = np.arange(len(sizes), len(sizes) + len(heads))
            ids, sizes = np.concatenate((ids, head_ids)), np.concatenate((sizes, head_sizes))
        found, n = gather(ids, np.cumsum(sizes) - sizes, sizes, codes)
        ends = np.concatenate(([0], np.cumsum(n)))[bounds].tolist()
        for a, b in zip(ends, ends[1:]):
            yield found[a:b]


@lru_cache(maxsize=2)
def encoder(path: str, cache_size: int = 800_000) -> PieceEncoder:
    """One encoder per worker and vocabulary, kept between tasks."""
    return PieceEncoder(path, cache_size)
