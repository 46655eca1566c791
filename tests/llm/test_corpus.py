import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from starlane.llm import languages, near_dups, outliers
from starlane.llm.files import stage
from messy_tables import documents, no_documents, words


def brute_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, x in enumerate(windows):
        if counts[x] > 1:
            covered.update(range(i, i + 5))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_statistics_equal_brute_force(spark):
    extra = [(30, "a b c d e f\na b c d e f\n\n \n g", "en", "a"), (31, "x " * 300, "en", "a"), (32, "\x0b|a\x0c&b \x85c d", "en", "a")]
    docs = documents(spark, extra)
    rows = outliers.with_statistics(docs.drop("n_words", "kept")).collect()
    for r in rows:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute_statistics(r["text"])
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])


def test_outliers_are_rejected_and_the_rest_kept(spark):
    extra = [(100 + i, words(80 + i, i), "en", "a" if i % 3 else "b") for i in range(150)]
    extra += [(300 + i, "### ".join(words(80, 50 + i).split(" ")), "en", "a") for i in range(20)]
    docs = documents(spark, extra)
    got = {r["doc_id"]: r for r in outliers.outliers(docs).collect()}
    assert all(got[100 + i]["kept"] for i in range(150))
    assert not any(got[300 + i]["kept"] or got[300 + i]["base_failed"] for i in range(20))
    assert not got[2]["kept"] and got[2]["n_words"] == 0
    kept = outliers.keep_inliers(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == {k for k, r in got.items() if r["kept"]} - {None}


def test_estimates_equal_the_same_steps_in_numpy(spark):
    random, names = np.random.default_rng(1), outliers.FEATURES
    x = random.normal(size=(400, 4)) @ np.array([[1, 0, 0, 0], [0.5, 1, 0, 0], [0, 0.3, 1, 0], [0.2, 0, 0, 1]])
    x[:60] += 12
    rows = spark.createDataFrame([("g", "s", *map(float, r)) for r in x], "group_lang string, group_source string, " + ", ".join(f"{n} double" for n in names))
    got = outliers.estimate(rows, outliers.Settings()).first()

    floors = np.diag([outliers.FLOORS[n] ** 2 for n in names])

    def lower(v, q):
        return np.sort(v)[int(np.ceil(q * len(v))) - 1]

    m = np.array([lower(x[:, i], 0.5) for i in range(4)])
    s = np.diag([(1.4826 * lower(np.abs(x[:, i] - m[i]), 0.5)) ** 2 for i in range(4)]) + floors

    def far():
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)

    for _ in range(4):
        near = x[far() <= lower(far(), 0.75)]
        m, s = near.mean(axis=0), np.cov(near.T, bias=True) + floors
    near = x[far() <= outliers.CHI_975 * max(1.0, lower(far(), 0.5) / outliers.CHI_MEDIAN)]
    m, factor = near.mean(axis=0), np.linalg.cholesky(np.cov(near.T, bias=True) + floors)
    assert [got[f"m_{n}"] for n in names] == pytest.approx(m.tolist())
    assert [got[f"l_{i}{j}"] for i in range(4) for j in range(i + 1)] == pytest.approx([factor[i, j] for i in range(4) for j in range(i + 1)])
    assert abs(m).max() < 1  # the planted tenth has no say


def test_no_documents(spark):
    empty = no_documents(spark)
    assert outliers.outliers(empty).count() == 0 and outliers.keep_inliers(empty).count() == 0
    assert near_dups.near_duplicates(empty).count() == 0 and near_dups.keep_one(empty).count() == 0
    assert languages.identify(empty, languages.fit(empty)).count() == 0 and languages.keep_identified(empty).count() == 0


STEMS = {"en": ["the", "thing", "wher", "ough"], "de": ["sch", "ung", "ein", "heit"], "fr": ["eau", "oux", "que", "ment"], "xx": ["zzk", "kqk"]}


def sentence(lang, n, seed):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(STEMS[lang], r.integers(1, 4))) for _ in range(n))


def test_languages_are_told_apart(spark):
    extra = [(1000 + 4 * i + j, sentence(lang, 30, 4 * i + j), lang, "a") for i in range(60) for j, lang in enumerate(STEMS)]
    docs = documents(spark, extra)
    model = languages.fit(docs)
    rows = languages.identify(docs, model).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.where("doc_id >= 1000").collect()}
    tested = [r for r in rows if r["doc_id"] in truth and r["held_out"]]
    assert len(tested) > 40 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in tested]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert unknown == {2, 3, 4, 10, None}
    import zlib

    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    kept = languages.keep_identified(docs)
    assert kept.columns == docs.columns and not {r["doc_id"] for r in kept.collect()} & {2, 3, 4, 10}


def test_one_language_and_none(spark):
    docs = documents(spark).where("lang = 'en'")
    model = languages.fit(docs)
    assert {r["lang_pred"] for r in languages.identify(docs, model).collect()} == {"en", "und"}
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert languages.identify(unlabelled, languages.fit(unlabelled)).first()["lang_pred"] == "und"


def brute_components(docs, width, percent):
    sets = [(r["doc_id"], set(near_dups.shingles(r["text"], width).tolist())) for r in docs if r["doc_id"] is not None]
    label = {d: d for d, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {d: root(d) for d in label}


def edited(text, changes, seed):
    r, w = np.random.default_rng(seed), text.split(" ")
    for i in r.choice(len(w), changes, replace=False):
        w[i] = f"new{r.integers(1_000_000)}"
    return " ".join(w)


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 16)
    base = words(300, 77)
    extra = [(400 + i, edited(base, i % 14, i), "en", "a") for i in range(80)]
    extra += [(600 + i, words(20 + i, i) + " " + words(55, 1), "en", "a") for i in range(30)]
    extra += [(700, "A b", "en", "a"), (701, "a B ", "en", "a"), (702, "b a", "en", "a")]
    docs = documents(spark, extra)
    rows = near_dups.near_duplicates(docs, 3, 85).collect()
    want = brute_components(docs.collect(), 3, 85)
    assert {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None} == want
    assert len(rows) == docs.count() and want[701] == 700 and want[702] == 702
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in rows)
    kept = near_dups.keep_one(docs, 3, 85)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({d for d, c in want.items() if d == c}) and ids.count(None) == 2


def test_every_pair_within_the_radius_shares_a_key():
    random, radius = np.random.default_rng(3), near_dups.radius_for(85)
    chunks = near_dups.chunks_for(radius)
    for _ in range(200):
        a = random.integers(0, 256, near_dups.SLOTS).astype(np.uint8)
        b = a.copy()
        b[random.choice(near_dups.SLOTS, radius, replace=False)] += 1
        keys = near_dups.keys_of(np.array([a, b]), chunks)
        assert set(keys[0]) & set(keys[1])


def test_pipeline_keeps_what_its_stages_keep(spark):
    extra = [(1000 + 4 * i + j, sentence(lang, 40, 4 * i + j), lang, "a") for i in range(40) for j, lang in enumerate(STEMS)]
    base = sentence("en", 200, 9)
    extra += [(2000 + i, base, "en", "a") for i in range(3)]
    rows, counts = documents(spark, extra), []
    for name, function in corpus_pipeline.STAGES[:-1]:
        after = stage(function(spark, rows, ""), name)
        assert after.columns == rows.columns
        counts.append((rows.count(), after.count()))
        rows = after
    assert all(a >= b > 0 for a, b in counts)
    left = {r["doc_id"] for r in rows.collect()}
    assert not left & {2, 3, 4, 10, 2001, 2002} and 2000 in left
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
    assert {p["doc_id"] for p in packed} == left


def test_any_language_value_can_be_learned(spark):
    names = {"a|b": "en", "slavic": "de", "family:slavic": "fr", "ru": "xx"}
    rows = [(4 * i + j, sentence(stem, 30, 4 * i + j), lang) for i in range(60) for j, (lang, stem) in enumerate(names.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {r[0]: r[2] for r in rows}
    got = [r for r in languages.identify(docs, languages.fit(docs)).collect() if r["held_out"]]
    assert len(got) > 40 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in got]) > 0.95


def test_texts_little_alike_are_not_chained_into_one_group(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK_ROWS", 16)
    monkeypatch.setattr(near_dups, "KEY_BLOCK", 2, raising=False)
    seen, compared = [], near_dups.compared
    monkeypatch.setattr(near_dups, "compared", lambda members, *rest: seen.append(members) or compared(members, *rest))
    parts = [words(60, i) for i in range(62)]
    # Each shares half of its shingles with the next one, so they share keys from end to end.
    rows = [(i, " ".join(parts[i : i + 3])) for i in range(60)]
    rows += [(100 + i, edited(rows[i][1], 2, i)) for i in range(0, 60, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(docs).collect()}
    assert found == brute_components(docs.collect(), 5, 80) and found[154] == 54 and found[55] == 55
    groups = [r["count"] for r in seen[0].groupBy("grp").count().collect()]
    assert sum(groups) >= 20 and max(groups) < 10


@pytest.mark.parametrize("block", [1, 2, 2048])
def test_members_far_from_their_hub_meet(spark, monkeypatch, block):
    monkeypatch.setattr(near_dups, "KEY_BLOCK", block)
    random = np.random.default_rng(5)
    signs = random.integers(0, 256, (6, near_dups.SLOTS)).astype(np.uint8)
    signs[3, 30:], signs[5, 30:] = signs[2, 30:], signs[4, 30:]
    signed = spark.createDataFrame([(i, 100 if i < 5 else 200, bytearray(s.tobytes())) for i, s in enumerate(signs)], "rep long, n long, signature binary")
    shared = spark.createDataFrame([(key, i, 0, 6) for key in (7, 8) for i in range(6)] + [(9, 0, 0, 2), (9, 1, 0, 2)], "key long, rep long, hub long, size long")
    apart = spark.createDataFrame([], "rep long, component long")
    got = near_dups.key_links(shared, apart, signed, 46, 80).collect()
    assert {tuple(sorted(r)) for r in got} == {(2, 3)}  # the sizes of 4 and 5 rule them out
    joined = spark.createDataFrame([(2, 2), (3, 2)], "rep long, component long")
    assert near_dups.key_links(shared, joined, signed, 46, 80).count() == 0
    assert near_dups.near_ties(shared, signed, 46, 80).count() == 0


def test_only_texts_that_may_go_are_shuffled(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = [(i, words(60, i)) for i in range(40)] + [(41, words(60, 3)), (41, words(60, 51)), (5, words(60, 50)), (None, words(9, 1)), (None, words(9, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = near_dups.keep_one(docs)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*range(40), None, None])
    optimized = kept._jdf.queryExecution().optimizedPlan().toString()
    alone, shuffled = optimized.split("\n+- ", 1)
    assert "getbit" in alone and "Join" not in alone and "Aggregate" not in alone
    assert "getbit" in shuffled[shuffled.index("Join") :]
