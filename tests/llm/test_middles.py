"""Fill-in-the-middle examples against slicing by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from messy_tables import documents, no_documents
from starlane.llm.middles import Cutter, Marks, Rates, draws, fill_in_middle, restored


def reference(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    text, n = text or "", len(text or "")
    if not n or h3 % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", i, j - i, f"<S>{text[j:]}<P>{text[:i]}<M>{text[i:j]}"
    return n, "psm", i, j - i, f"<P>{text[:i]}<S>{text[j:]}<M>{text[i:j]}"


def test_examples_equal_slices_and_turn_back(spark):
    tricky = ["<", "<P", "P>", "<S<S", "x<M>y", "<P><S><M>", "S>M><", "a\nb\r\n c", "🙂" * 9, "é" * 7, "\0\0"]
    extra = [(1000 + i, tricky[i % len(tricky)], "en", "a") for i in range(300)]
    docs = documents(spark, extra)
    rows = fill_in_middle(docs).withColumn("back", restored()).collect()
    assert len(rows) == docs.count()
    wanted = sorted((r.doc_id, *reference(r.doc_id, r.text), r.text or "") for r in docs.collect() if r.doc_id is not None)
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == wanted
    unnamed = sorted(reference(None, r.text)[4] for r in docs.where("doc_id IS NULL").collect())
    assert sorted(r.output for r in rows if r.doc_id is None) == unnamed
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fill_in_middle(no_documents(spark)).count() == 0


def test_blocks_give_the_same_units():
    r = random.Random(3)
    text = "".join(r.choice("ab \n<é🙂") for _ in range(5000))
    whole = list(Cutter().ends(text))
    assert whole == list(range(1, 5001))
    for block in (1, 7, 4999, 5000):
        assert list(Cutter(block=block).ends(text)) == whole
    words = r"\s*[^\s]+\s*"
    wide = "  ".join("w" * r.randrange(1, 90) for _ in range(400)) + "\n"
    by_word = list(Cutter(words).ends(wide))
    assert len(by_word) == 400 and by_word[-1] == len(wide)
    assert list(Cutter(words, block=64).ends(wide)) == by_word
    assert Cutter(words).ends("   ") is None and Cutter(words, block=1).ends("   ") is None


def test_other_units_rates_and_marks(spark):
    docs = spark.createDataFrame([(i, f"line {i}\nsecond\n\nlast") for i in range(200)], "doc_id long, text string")
    marks = Marks("[p]", "[s]", "[m]")
    found = fill_in_middle(docs, unit=r"[^\n]*\n|[^\n]+", marks=marks, rates=Rates(plain=0, suffix_first=100), salt=5)
    rows = found.withColumn("back", restored(marks=marks)).join(docs, "doc_id").collect()
    assert {(r.n, r.form) for r in rows} == {(4, "spm")} and all(r.back == r.text for r in rows)
    assert all(r.text[: r.prefix_chars][-1:] in ("", "\n", "t") for r in rows) and len({r.prefix_chars for r in rows}) > 3
    assert fill_in_middle(docs, unit="[a-z]").where(F.col("n").isNull() & (F.col("form") == "plain")).count() == 200


def test_the_draw_is_fixed_by_the_id():
    assert draws(1, 7) == draws(1, 7) != draws(2, 7)
    with pytest.raises(ValueError, match="overlap"):
        Marks("aba", "<S>", "<M>")
    with pytest.raises(ValueError, match="differ"):
        Marks("<P>", "<P>", "<M>")
