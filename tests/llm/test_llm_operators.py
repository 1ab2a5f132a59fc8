"""Operators for training text against brute force, exact encoders and held-out labels."""

import os

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from marlstone.llm import bpe, leaks, quantiles, subjects, text


TABLES = "/root/testdata/sf0.1"

# ---------------------------------------------------------------- percentiles


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=3000), st.integers(2, 64), st.integers(1, 5))
def test_rank_error_stays_in_its_bound(values, k, parts):
    whole = quantiles.Buffers(k)
    for chunk in np.array_split(np.array(values, float), parts):
        b = quantiles.Buffers(k)
        b.add(chunk)
        whole.merge(b.rows())
    v = np.sort(values)
    assert whole.n == len(v)
    for p, q in zip((0.05, 0.5, 0.99), whole.quantiles((0.05, 0.5, 0.99))):
        rank = max(1, int(np.ceil(p * len(v))))
        low, high = np.searchsorted(v, q, "left") + 1, np.searchsorted(v, q, "right")
        assert low - whole.err <= rank <= high + whole.err


def test_percentiles_combine(spark):
    rows = [(None if i % 5 == 0 else i % 3, i % 7, float(i * 37 % 1000) if i % 11 else None, "x") for i in range(5000)] + [(1, 0, float("nan"), "x")]
    df = spark.createDataFrame(rows, "g int, day int, v double, metric2 string")
    one = quantiles.read_quantiles(quantiles.combine(quantiles.summarise(df, ["g"], ["v"], k=4096), ["g"], k=4096), ["g"], k=4096)
    days = quantiles.read_quantiles(quantiles.combine(quantiles.summarise(df, ["g", "day"], ["v"], k=4096), ["g"], k=4096), ["g"], k=4096)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, days.collect()), key=str)
    for r in one.collect():
        v = np.sort([x[2] for x in rows if x[0] == r.g and x[2] is not None and x[2] == x[2]])
        assert r.n == len(v) and r.rank_error == 0 and r.p50 == v[int(np.ceil(0.5 * len(v))) - 1]
    empty = quantiles.summarise(df.where("false"), ["g"], ["v"])
    assert quantiles.read_quantiles(quantiles.combine(empty, ["g"]), ["g"]).count() == 0


def test_summaries_of_a_partition_are_given_out_before_they_grow(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i % 40), float(v)) for i, v in enumerate(rng.normal(size=30_000))]
    df = spark.createDataFrame(rows, "g int, v double").coalesce(2)
    parts = quantiles.summarise(df, ["g"], ["v"], k=64, most=5_000)
    assert parts.groupBy("g", "part").agg({"n": "count"}).agg({"count(n)": "max"}).first()[0] > 2
    for r in quantiles.read_quantiles(quantiles.combine(parts, ["g"], k=64, fan=2, most=5_000), ["g"], k=64).collect():
        v = np.sort([x for g, x in rows if g == r.g])
        assert r.n == len(v) and 0 < r.rank_error < 0.1
        assert abs(np.searchsorted(v, r.p50) + 1 - np.ceil(0.5 * len(v))) <= r.rank_error * len(v) + 1e-6


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")
def test_stated_rank_error_holds_in_collapsed_groups(spark):
    from marlstone.llm import queries

    got = queries.p6_percentiles(spark, TABLES).where("rank_error > 0").collect()
    assert len(got) >= 5
    rows = queries._fares(spark, TABLES).select("zone_id", *queries._FARES).toPandas()
    for r in got:
        zone = rows["zone_id"].isna() if r.zone_id is None else rows["zone_id"] == r.zone_id
        v = np.sort(rows.loc[zone, r.metric].dropna().to_numpy())
        assert r.n == len(v)
        for p in quantiles.PROBS:
            q, rank = r[f"p{round(p * 100)}"], np.ceil(p * len(v))
            low, high = np.searchsorted(v, q, "left") + 1, np.searchsorted(v, q, "right")
            assert max(low - rank, rank - high, 0) <= r.rank_error * len(v) + 1e-6


# ---------------------------------------------------------------- encoding


@pytest.fixture(scope="module")
def encoders():
    import public_tokenizers
    import tiktoken

    enc = bpe.load(*bpe.public_vocabulary())
    return enc, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=enc.ranks, special_tokens={})


def test_encoding_matches_public_encoder(encoders):
    enc, ref = encoders

    @settings(max_examples=200, deadline=None)
    @given(st.text(max_size=200))
    def same(s):
        assert enc.encode(s) == ref.encode_ordinary(s)

    same()
    for s in ("<|endoftext|>", "a" * 20_000, "ab" * 5000 + " é택시" * 50, " \n\t" * 300):
        assert enc.encode(s) == ref.encode_ordinary(s)


def test_encoding_of_null_and_empty(spark, encoders):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "cab"), (3, "cab")], "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in df.select("doc_id", bpe.token_ids(df.text, *bpe.public_vocabulary()).alias("ids")).collect()}
    assert got == {1: [], 2: [], 3: encoders[1].encode_ordinary("cab")}


def test_rank_queue_orders_by_rank_then_position():
    q = bpe.RankQueue(50_000)
    items = [(49_999, 3), (0, 9), (70, 4), (70, 1), (4097, 2)]
    for r, p in items:
        q.push(r, p)
    assert [q.pop() for _ in items] == sorted(items) and q.pop() is None


# ---------------------------------------------------------------- leaks

PROMPT = "Give the missing figure. The folded ledger of Grinethan lists 4876 seats, 460 more than Casmothath. Only 8284 of the 243 badges sent by Tasmostiss ever reached Quonequith. When Velodor closed, 9764 seats moved over to Ormanosk within 338 hours."
OTHER = "Give the missing figure. The folded ledger of Pelnebay lists 1111 seats, 222 more than Yarmobay. Only 3333 of the 444 badges sent by Zandaton ever reached Kelguton. When Murfan closed, 5555 seats moved over to Orrusk within 666 hours."


def leaked(spark, docs, items=((1, PROMPT), (2, OTHER), (3, None), (4, " ")), few=1):
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id bigint, text string, item_id string")
    e = spark.createDataFrame([(i, p, "x") for i, p in items], "item_id bigint, prompt string, text string")
    return {(r.doc_id, r.item_id) for r in leaks.find_leaks(d, e, leaks.LeakRules(few=few)).collect()}


def test_leaks(spark):
    cut = PROMPT.split(". ")
    docs = [
        PROMPT,
        "Rain again. " + cut[3].upper() + " and so on. " + "<b>" + cut[1].replace("4876", "4,876") + "</b>.\nNothing else. " + cut[2].replace("e", "е"),  # reordered, marked up, Cyrillic е
        "Somebody wrote \"lists 4876 seats, 460 more than Casmothath\" on the wall.",
        OTHER.replace("1111", "9"),
        "Give the missing figure. The folded ledger of Nowhere lists 7 seats, 8 more than Elsewhere.",
        None, "", "  \n ",
        "filler words here " * 20_000 + PROMPT.replace("badges", "plates"),
    ]
    assert leaked(spark, docs) == {(0, 1), (1, 1), (3, 2), (8, 1)}


def test_leaks_of_many_copies_and_near_copies_of_an_item(spark):
    docs = [PROMPT, OTHER, "Give the missing figure. Nothing of it."]
    copies = [(i, (PROMPT, OTHER)[i % 2]) for i in range(80)]  # every word stands in half of the items
    assert leaked(spark, docs, copies) == {(i % 2, i) for i in range(80)}
    near = [(i, PROMPT + f" Variant {i}.") for i in range(5)]
    assert leaked(spark, docs, [*near, (99, OTHER)], few=5) == {(0, i) for i in range(5)} | {(1, 99)}


def test_repeated_document_rows_and_a_null_id(spark):
    d = spark.createDataFrame([(7, PROMPT), (7, PROMPT), (7, OTHER), (None, OTHER)], "doc_id bigint, text string")
    e = spark.createDataFrame([(1, PROMPT), (2, OTHER), (2, OTHER)], "item_id bigint, prompt string")
    got = sorted(((r.doc_id, r.item_id) for r in leaks.find_leaks(d, e, leaks.LeakRules(few=1)).collect()), key=str)
    assert got == [(7, 1), (7, 1), (7, 2), (None, 2)]


def test_leaks_empty(spark):
    d = spark.createDataFrame([], "doc_id bigint, text string")
    e = spark.createDataFrame([], "item_id bigint, prompt string")
    assert leaks.find_leaks(d, e).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), max_size=25))
def test_tiles_are_true_and_apart(a, b):
    got = leaks.tiles(a, b, 2)
    used_a, used_b = set(), set()
    for p, q, n in got:
        assert n >= 2 and a[p : p + n] == b[q : q + n]
        assert not used_a & set(range(p, p + n)) and not used_b & set(range(q, q + n))
        used_a |= set(range(p, p + n))
        used_b |= set(range(q, q + n))
    left_a = [x if i not in used_a else None for i, x in enumerate(a)]
    left_b = [x if i not in used_b else None for i, x in enumerate(b)]
    pairs = {(x, y) for x, y in zip(left_b, left_b[1:]) if None not in (x, y)}
    assert not any((x, y) in pairs for x, y in zip(left_a, left_a[1:]) if None not in (x, y))


def test_words_fold_disguises():
    assert text.words("Оnly 8,284 of <i>the</i> ba​dges&nbsp;at **Velodor**") == ["only", "8284", "of", "the", "badges", "at", "velodor"]
    assert text.words("") == []


# ---------------------------------------------------------------- subjects


def _corpus():
    rng = np.random.default_rng(5)
    nouns = {"sport": ["striker", "goalkeeper", "derby"], "law": ["permit", "court", "clause"], "roads": ["tunnel", "junction", "bypass"]}
    verbs = {"sport": ["scored in extra time", "won the cup final"], "law": ["upheld the fine", "revoked the licence"], "roads": ["held the traffic", "was closed for works"]}
    docs, labels, truth = [], [], {}
    for i in range(240):
        mine = list(rng.choice(list(nouns), rng.integers(1, 3), replace=False))
        parts = [f"The {rng.choice(nouns[s])} {rng.choice(verbs[s])} at {rng.integers(9)}." for s in mine for _ in range(3)]
        parts += ["That is all I know.", "Ticket 4 stays open."][: rng.integers(0, 3)]
        rng.shuffle(parts)
        docs.append((i, " ".join(parts), "x"))
        truth[i] = set(mine)
        if i % 5 == 0:
            labels += [(i, s, "me") for s in mine]
    return docs, labels, truth


def test_subjects_of_unlabelled_documents(spark):
    docs, labels, truth = _corpus()
    docs += [(900, None, "x"), (901, "", "x"), (902, " \n", "x"), (903, "One.", "x")]
    labels += [(77777, "law", "me"), (3, "no such", "me")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    lab = spark.createDataFrame(labels, "doc_id bigint, subject string, by string")
    sub = spark.createDataFrame([(s, "") for s in ("sport", "law", "roads")], "subject string, about string")
    rows = subjects.classify(d, lab, sub, subjects.SubjectRules(buckets=1 << 12)).collect()
    got = {}
    for r in rows:
        if r.share >= 0.2:
            got.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in truth if i % 5]
    assert sum(got.get(i) == truth[i] for i in held) >= 0.95 * len(held)
    assert not got.keys() & {900, 901, 902, 903}


def test_subjects_without_labels_or_documents(spark):
    d = spark.createDataFrame([(1, "The court upheld the fine.")], "doc_id bigint, text string")
    lab = spark.createDataFrame([], "doc_id bigint, subject string")
    sub = spark.createDataFrame([("law",)], "subject string")
    assert subjects.classify(d, lab, sub).count() == 0
    assert subjects.classify(d.where("false"), lab, sub).count() == 0


def test_complement_weights_and_posteriors():
    counts = np.array([[9.0, 0], [0, 9.0], [5, 5]])
    w = subjects.complement_weights(counts)
    assert w[0, 0] > 0 > w[0, 1] and w[1, 1] > 0 and abs(w[2]).max() < 1e-9


def test_more_subjects_than_bits(spark):
    names = [f"s{i:02d}" for i in range(70)]
    text = lambda i, n: " ".join(f"The {'abcdefgh'[i % 8]}{'klmnopqrst'[i // 8]}one and {'abcdefgh'[i % 8]}{'klmnopqrst'[i // 8]}two stand here." for _ in range(n))
    docs = [(i, text(i, 5)) for i in range(70)] + [(100 + i, text(i, 3) + " " + text(69 - i, 3)) for i in range(10)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, names[i], "a") for i in range(70)], "doc_id bigint, subject string, labelled_by string")
    sub = spark.createDataFrame([(n, "x") for n in names] + [(None, "x")], "subject string, about string")
    got = {(r.doc_id, r.subject) for r in subjects.classify(d, lab, sub, subjects.SubjectRules(buckets=1 << 12)).where("posterior >= 0.5").collect()}
    assert got == {(i, names[i]) for i in range(70)} | {(100 + i, names[j]) for i in range(10) for j in (i, 69 - i)}


def test_rising_curve():
    got = subjects.rising(np.array([0.0, 0.4, 0.2, 1.0, 0.9]), np.array([1.0, 1.0, 3.0, 1.0, 1.0]))
    assert got == pytest.approx([0.0, 0.25, 0.25, 0.95, 0.95])


def test_pairs_hash_like_their_text():
    import zlib

    assert set(subjects.features(["ab", "7", "cd"], 1 << 20)) == ({zlib.crc32(x.encode()) % (1 << 20) for x in ("ab", "#", "cd", "ab #", "# cd")})


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")
def test_held_out_subjects(spark):
    from pyspark.sql import functions as F

    docs, lab, sub = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "subject_labels", "subjects"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    want = {(r.doc_id, r.subject) for r in lab.where(held).collect()}
    got = subjects.classify(docs, lab.where(~held), sub).where("posterior >= 0.5").join(lab.where(held).select("doc_id").distinct(), "doc_id")
    got = {(r.doc_id, r.subject) for r in got.collect()}
    assert len(got & want) >= 0.92 * len(want) and len(got & want) >= 0.92 * len(got)  # a few labels are wrong
