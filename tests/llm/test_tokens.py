import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starlane.llm import byte_pairs, packing, token_files
from starlane.llm.tokens import PieceEncoder, Words, portions
from messy_tables import documents, no_documents

TEXTS = st.text(st.sampled_from(list("abcéüß  \n\n\t.,'!#12 \xa0　漢🙂̈sltrevmd|<>")), max_size=60)


def library(name):
    """The library as it comes: the strings of added tokens in a text are those tokens."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(name):
    plain, pieces = library(name), PieceEncoder(public_tokenizers.path(name), cache_size=50)
    added = ["hi <|endoftext|> there", "a<|startoftext|>b  <|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "\n<|endoftext|>\n"]
    assert [x.tolist() for x in pieces.encode(added)] == [plain(t) for t in added]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(TEXTS, max_size=4))
    def check(texts):
        assert [x.tolist() for x in pieces.encode(texts)] == [plain(t) for t in texts]

    check()


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_only_different_words_are_looked_up(name, monkeypatch):
    plain, pieces, looked_up = library(name), PieceEncoder(public_tokenizers.path(name)), []
    find = Words.find
    monkeypatch.setattr(Words, "find", lambda self, words, encode: looked_up.extend(words.to_pylist()) or find(self, words, encode))
    texts = ["it was so, so (and) so!", "\nÉté. it was, so: it 12, 12 ,,, été\nwas it"] * 500
    assert [x.tolist() for x in pieces.encode(texts)] == [plain(t) for t in texts]
    assert len(looked_up) == len(set(looked_up)) < 20 and not {"so,", "so!", "was,", "so:"} & set(looked_up)


def test_words_kept_are_those_used_last():
    words, made = Words(limit=4), []

    def find(*some):
        places = words.find(pa.array(some, pa.string()), lambda new: made.extend(new) or [np.full(len(w), ord(w[:1] or "-"), "<u4").tobytes() for w in new])
        for w, at in zip(some, places.tolist()):
            start, n = words.starts[at], words.sizes[at]
            assert words.words[at].as_py() == w and words.ids[start : start + n].tolist() == [ord(w[:1] or "-")] * len(w)

    find("a", "bb", "", "dd")
    find("e", "f", "ggg", "h", "i", "bb")
    find("a")  # full: e to i and bb were used last, four of them stay
    assert len(words.words) == 5 and made.count("a") == 2 and made.count("bb") == 1
    find("x" * 2000, "bb")  # long words do not stay either
    find("a")
    assert words.words.nbytes < 128 * 4 and made.count("a") == 2


def test_portions_hold_every_row_once():
    texts = ["a" * 5_000_000, None, "b" * 9_000_000, "", "c" * 3_000_000, "d" * 6_000_000, None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    got = [some.column(0).to_pylist() for some in portions(batch.slice(0, 7))]
    assert got == [[0, 1], [2], [3, 4], [5, 6]]
    assert [some.column(0).to_pylist() for some in portions(batch.slice(3, 2))] == [[3, 4]] and not list(portions(batch.slice(0, 0)))


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_values_round_trip(values):
    control, data = token_files.encode_values(np.array(values, dtype="<u4"))
    assert len(control) == -(-len(values) // 4)
    back = token_files.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert back.tolist() == values


def test_token_files_hold_the_corpus_in_order(spark, tmp_path):
    docs, plain = documents(spark), library(token_files.VOCABULARY)
    folder = str(tmp_path / "tokens")
    index = token_files.write_tokens(docs, public_tokenizers.path(token_files.VOCABULARY), folder, docs_per_shard=4)
    assert index.count() > 1
    got = token_files.read_tokens(index, folder, checksums=True).collect()
    plainly = {r["start"]: r["ids"] for r in token_files.read_tokens(index, folder).collect()}
    assert all(zlib.crc32(np.array(plainly[r["start"]], dtype="<u4").tobytes()) == r["ids_crc32"] for r in got)
    ids = [(r["doc_id"], plain(r["text"]) + [2]) for r in docs.collect()]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], dtype="<u2").tobytes()))
    want, start = [], 0
    for doc_id, x in ids:
        want.append((doc_id, start, len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())))
        start += len(x)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    # The most frequent id is the shortest to write.
    shard = index.first()["name"]
    with open(f"{folder}/{shard}", "rb") as f:
        head = f.read(12)
        ranks = np.frombuffer(f.read(4 * int.from_bytes(head[8:12], "little")), dtype="<u4")
    counts = np.bincount(np.concatenate([x for _, x in ids]))
    assert counts[ranks[0]] == counts.max() and (np.diff(counts[ranks]) <= 0).all()


def test_no_documents_give_no_token_files(spark, tmp_path):
    folder = str(tmp_path / "tokens")
    index = token_files.write_tokens(no_documents(spark), public_tokenizers.path(token_files.VOCABULARY), folder)
    assert index.count() == 0 and token_files.read_tokens(index, folder).count() == 0


RANKS = byte_pairs.read_ranks(public_tokenizers.path(byte_pairs.VOCABULARY))
PUBLIC = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "the", "ing", "é", "zz", "aaaa", "tion", "x", "漢"]), max_size=40), st.integers(1, 9))
def test_tree_of_joins_is_the_encoding(parts, leaf):
    piece = "".join(parts).encode()
    pairs = byte_pairs.BytePairs(RANKS, leaf_bytes=leaf)
    ids = pairs.encode(piece)
    assert ids == (PUBLIC._core_bpe.encode_single_piece(piece) if piece else [])
    assert pairs.decode(ids) == piece


def test_most_matches_of_a_text_pass_a_join():
    import regex

    text = "Most words of running text are longer than a leaf, so that the tree of joins has something to do."
    sizes = [len(m.encode()) for m in regex.findall(public_tokenizers.PATTERN, text)]
    assert sum(n > byte_pairs.LEAF_BYTES for n in sizes) > len(sizes) / 2
    pairs = byte_pairs.BytePairs(RANKS)
    assert [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in pairs.encode(m.encode())] == PUBLIC.encode_ordinary(text)


def test_byte_pairs_of_documents(spark):
    import hashlib

    path, pattern = public_tokenizers.path(byte_pairs.VOCABULARY), public_tokenizers.PATTERN
    docs = documents(spark, extra=[(20, "a" * 5000 + "thationing" * 800, "en", "a")])
    got = byte_pairs.decode_texts(byte_pairs.encode_texts(docs, path, pattern), path, pattern).collect()
    want = []
    for r in docs.collect():
        text = r["text"] or ""
        ids = PUBLIC.encode_ordinary(text)
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert byte_pairs.encode_texts(no_documents(spark), path, pattern).count() == 0


def unpacked(pieces):
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for ps in sequences.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
    return sequences


def test_packing_places_every_id_once(spark):
    plain = library(packing.VOCABULARY)
    docs = documents(spark).coalesce(2)
    pieces = packing.pack(docs, public_tokenizers.path(packing.VOCABULARY)).collect()
    for ps in unpacked(pieces).values():
        total = sum(p["length"] for p in ps)
        assert total == 4096 or total & (total - 1) == 0
    for doc_id in (1, 2, 3, 5, 11):
        own = sorted((p for p in pieces if p["doc_id"] == doc_id), key=lambda p: p["start"])
        ids = plain(docs.where(f"doc_id = {doc_id}").first()["text"]) + [2]
        assert [i for p in own for i in p["ids"]] == ids and {p["doc_tokens"] for p in own} == {len(ids)}
        assert own[0]["start"] == 0 and sum(p["loss_tokens"] for p in own) == len(ids) - 1
    assert sum(p["length"] for p in pieces if p["doc_id"] == 9) == 2 * (len(plain(docs.where("doc_id = 9").first()["text"])) + 1)
    assert packing.pack(no_documents(spark), public_tokenizers.path(packing.VOCABULARY)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 90), st.integers(0, 3)), max_size=60), st.integers(1, 5), st.integers(1, 20))
def test_packer_keeps_all_limits(items, segments, loss):
    limits = packing.Limits(tokens=32, segments=segments, loss=loss)
    packer, seen, closed = packing.Packer(limits, pool=3), {}, []
    for key, (n, every) in enumerate(items):
        flags = np.array([every > 0 and i % every == 0 for i in range(n)], dtype=np.int8)
        closed += packer.add(key, np.arange(n, dtype="<u4"), flags)
    closed += packer.finish()
    for pieces in closed:
        assert sum(len(p[2]) for p in pieces) <= 32
        assert len(pieces) <= segments and sum(p[4] for p in pieces) <= loss
        for p in pieces:
            seen.setdefault(p[0], []).extend(p[2].tolist())
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, (n, _) in enumerate(items)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 32), st.integers(0, 4), st.integers(0, 20)), max_size=6), st.integers(1, 32), st.integers(0, 20))
def test_a_piece_goes_where_the_dot_product_is_largest(free, tokens, loss):
    packer = packing.Packer(packing.Limits(tokens=32, segments=4, loss=20), pool=6)
    packer.open = [[] for _ in free]
    packer.free[: len(free)] = np.array(free, dtype=float).reshape(-1, 3)
    fits = {k: t * tokens / 32**2 + s / 4**2 + x * loss / 20**2 for k, (t, s, x) in enumerate(free) if t >= tokens and s >= 1 and x >= loss}
    best = packer._best(tokens, loss)
    assert (best is None) == (not fits) and (best is None or fits[best] >= max(fits.values()) - 1e-9)


def test_checksums_of_pieces(spark):
    docs, path = documents(spark).coalesce(1), public_tokenizers.path(packing.VOCABULARY)
    pieces = {(p["sequence_id"], p["offset"]): p for p in packing.pack(docs, path).collect()}
    checked = packing.pack(docs, path, checksums=True).collect()
    assert len(checked) == len(pieces)
    for c in checked:
        p = pieces[c["sequence_id"], c["offset"]]
        assert c["ids_crc32"] == zlib.crc32(np.array(p["ids"], dtype="<u4").tobytes())
        assert all(c[n] == p[n] for n in ("doc_id", "start", "length", "doc_tokens", "loss_tokens"))
