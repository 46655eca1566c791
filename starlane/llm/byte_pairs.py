"""Byte-level BPE as a monoid: the halves of a piece are encoded apart and joined.

Encoding maps a string of bytes to a token sequence; joining two sequences gives the
encoding of the concatenated bytes, so a piece of any length is reduced over a tree. Only
tokens near the seam can change. The join encodes a window of tokens around it anew, and
widens the window on either side until the tokens beyond are known to stay: a sequence is
the encoding of its bytes exactly if each two neighbours are the encoding of theirs, which
holds inside both halves and inside the window, so it is left to hold at the window's two
ends. Decoding concatenates the bytes of the tokens up the same tree.

The text is parted by the vocabulary's pattern first, and no token crosses a match; what
a match encodes to is kept in a bounded cache of the worker.

Defined cases: NULL or empty text has no tokens; a NULL doc_id and repeated rows are kept;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from starlane.llm.files import table
from starlane.llm.tokens import PieceEncoder, Words, portions

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Two in three matches of running text are longer, and so pass a join.
LEAF_BYTES = 3
LEAF_IDS = 512
MEMO = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}


class BytePairs:
    def __init__(self, ranks: dict[bytes, int], leaf_bytes: int = LEAF_BYTES):
        self.ranks, self.leaf_bytes = ranks, leaf_bytes
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.stable: dict[tuple[int, int], bool] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The encoding by definition: merge the leftmost pair of the lowest rank until none is left."""
        ranks, worst = self.ranks, len(self.ranks)
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [ranks.get(a + b, worst) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < worst:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], worst)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], worst)
        return [ranks[p] for p in parts]

    def stays(self, a: int, b: int) -> bool:
        """Whether two neighbours are the encoding of their bytes."""
        known = self.stable.get((a, b))
        if known is None:
            if len(self.stable) >= MEMO:
                self.stable.clear()
            known = self.stable[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right:
            return left or right
        if self.stays(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            raw = self.decode(left[len(left) - i :] + right[:j])
            # A window is encoded by definition, whatever its length: it is where the tree has no say.
            window = self.merge(raw)
            left_ends = i >= len(left) or self.stays(left[-i - 1], window[0])
            right_ends = j >= len(right) or self.stays(window[-1], right[j])
            if left_ends and right_ends:
                return left[: max(0, len(left) - i)] + window + right[j:]
            i = i if left_ends else min(len(left), 2 * i)
            j = j if right_ends else min(len(right), 2 * j)

    def encode(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf_bytes:
            return self.merge(piece) if piece else []
        half = len(piece) // 2
        return self.join(self.encode(piece[:half]), self.encode(piece[half:]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join([self.bytes_of[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class TextEncoder(PieceEncoder):
    """Whole texts: matches of the pattern, each encoded by the tree."""

    def __init__(self, path: str, pattern: str, cache_size: int = 400_000):
        self.pairs = BytePairs(read_ranks(path))
        self.pattern = regex.compile(pattern)
        self.spaced, self.cache_size, self.added = True, cache_size, []
        self.words, self.first = Words(cache_size), {}
        self.line_end = np.array(self._plain("\n"), dtype="<u4").tobytes()

    def _plain(self, text: str) -> list[int]:
        encode = self.pairs.encode
        return [i for match in self.pattern.findall(text) for i in encode(match.encode())]

    def _encode_pieces(self, pieces: list[str], lead: str) -> list[bytes]:
        return [np.array(self._plain(lead + p), dtype="<u4").tobytes() for p in pieces]


@lru_cache(maxsize=1)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The token ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = text_encoder(vocabulary, pattern)
        for batch in batches:
            for some in portions(batch):
                ids = tokens.encode(some.column(1).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([some.column(0), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_texts(tokens: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The digests of ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = text_encoder(vocabulary, pattern).pairs
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for value in batch.column(1):
                ids = np.asarray(value.values)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(pairs.decode(ids.tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return tokens.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return decode_texts(encode_texts(table(spark, sf_dir, "documents"), vocabulary, pattern), vocabulary, pattern)
