"""Language, toxicity, near-duplicates, decontamination and tokens on small and awkward tables."""

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_common import importable, middle, small  # noqa: F401
from pyspark.sql import functions as F

from ledgerlog.llm import bpe, components, langid, minhash, suffixes, toxicity
from ledgerlog.llm.queries import QUERIES
from ledgerlog.llm.shared import remainder, scratch

DOCS = "doc_id bigint, text string, id string, n int, score string, items string, label string"


def docs(spark, rows):
    """Documents with columns whose names clash with those the operators use."""
    return spark.createDataFrame([(k, t, "x", 1, "y", "z", "w") for k, t in rows], DOCS)


def awkward(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    return docs(spark, [(1, None), (2, ""), (3, " \n\t "), (None, "some words stand here for once"), (4, "one two"),
                        (4, "one two"), (5, "ONE  two"), (6, long), (7, long + " tail"), (8, "\0 é 日本 ½ !!"), (9, "12 34")])


def by_key(df, key="doc_id"):
    found = {}
    for row in df.collect():
        found.setdefault(row[key], []).append(row)
    return found


# near-duplicates


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_components(rows, k, percent=80):
    sets = [(key, shingles(text, k)) for key, text in rows]
    least = {key: key for key, _ in rows}
    changed = True
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if x and y
             and 100 * len(x & y) >= percent * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_near_duplicates_awkward(spark):
    found = by_key(minhash.near_duplicates(awkward(spark), words=4))
    assert sum(map(len, found.values())) == 11
    assert [r.n_shingles for r in (found[1] + found[2] + found[3])] == [0, 0, 0]
    assert all(found[k][0].component_id == k and found[k][0].kept for k in (1, 2, 3, 8, 9))
    assert found[None][0].component_id is None and found[None][0].kept
    assert [(r.component_id, r.kept, r.n_shingles) for r in found[4]] == [(4, True, 1)] * 2
    assert (found[5][0].component_id, found[5][0].kept) == (4, False)
    assert (found[6][0].component_id, found[7][0].component_id) == (6, 6)


def test_near_duplicates_empty(spark):
    out = minhash.near_duplicates(docs(spark, []))
    assert out.collect() == [] and out.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_near_duplicates_match_brute_force(spark):
    """Chains of small changes around the threshold, and groups whose members differ from the smallest."""
    rng = random.Random(5)
    rows, key = [], 100
    for _ in range(12):
        base = [f"v{rng.randrange(300)}" for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(rng.choice([2, 8, 40])):
            text = list(base)
            for _ in range(rng.randrange(1 + len(base) // 20)):
                text[rng.randrange(len(text))] = f"v{rng.randrange(300)}"
            rows.append((key, " ".join(text)))
            key += rng.randrange(1, 4)
            if rng.random() < 0.3:
                base = text
    rng.shuffle(rows)
    want = brute_components(rows, 4)
    assert len(set(want.values())) > 20
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(spark, rows), words=4).collect()} == want


def test_residual_blocks_join_components(spark):
    """Two stars in one bucket that only their rims link."""
    base = [f"a{i}" for i in range(200)]

    def edit(at):
        text = list(base)
        for i in at:
            text[i] = f"b{i}"
        return " ".join(text)

    # 5-word steps: 1 ~ 2 ~ 3 ~ 4 by shared edits, but 1 is not similar to 4
    rows = [(1, edit(range(0, 60, 20))), (2, edit(range(0, 100, 20))), (3, edit(range(0, 160, 20))),
            (4, edit(range(0, 200, 20)))]
    want = brute_components(rows, 4)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(spark, rows), words=4).collect()} == want


def test_posterior_bounds_rise_and_spare_similar_pairs():
    steps = minhash.least_matches(0.8, 1e-5)
    assert [n for n, _ in steps] == list(range(32, 161, 32))
    shares = [m / n for n, m in steps]
    assert shares == sorted(shares) and shares[-1] < 0.8
    assert all(minhash.least_matches(0.8, 1e-2)[i][1] >= m for i, (_, m) in enumerate(steps))


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300, 300), (None, 5)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = dict(components.connected(df, scratch(spark, "test")).collect())
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}}


# decontamination


def brute_overlap(text, items, window=13):
    split = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words = split((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
    hit, names, longest = set(), set(), 0
    for key, item in items:
        w = split((item or "").lower().encode())
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            for j in range(len(words) - k + 1):
                if words[j:j + k] == w[i:i + k]:
                    hit.update(range(j, j + k))
                    names.add(key)
                    n = k
                    while i + n < len(w) and j + n < len(words) and w[i + n] == words[j + n]:
                        n += 1
                    longest = max(longest, n)
    return len(words), len(hit), sorted(names), longest


@pytest.mark.parametrize("item_bytes", [1 << 20, 300])
def test_overlaps_match_brute_force(spark, item_bytes):
    rng = random.Random(2)
    items = [(i, " ".join(f"t{rng.randrange(6)}" for _ in range(rng.choice([1, 5, 13, 14, 40])))) for i in range(12)]
    items += [(50, None), (51, " !! "), (3, items[3][1]), (None, "t1 t2")]
    texts = [" ".join(f"t{rng.randrange(6)}" for _ in range(rng.randrange(80))) for _ in range(30)]
    texts += [f"x {items[k][1]} y, {items[k][1].upper()}" for k in range(12)] + [None, "", "T0-t1"]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    bench = spark.createDataFrame([(k, t, "c") for k, t in items], "item_id bigint, text string, doc_id string")
    found = by_key(suffixes.overlaps(docs(spark, rows), bench, item_bytes=item_bytes))
    known = [(k, t) for k, t in items if k is not None]
    assert sum(map(len, found.values())) == len(rows) and len(found[0]) == 2
    for key, text in rows:
        n, hit, names, longest = brute_overlap(text, known)
        for row in found[key]:
            assert (row.n_words, row.n_hit, row["items"], row.longest) == (n, hit, names, longest)
            assert row.contaminated == (hit > 0 and 20 * hit >= n)
            assert sum(b - a for a, b in row.hits) == hit


def test_overlaps_awkward_and_empty(spark):
    bench = spark.createDataFrame([(1, "ONE two")], "item_id bigint, text string")
    found = by_key(suffixes.overlaps(awkward(spark), bench))
    assert [(r.n_words, r.n_hit, r["items"]) for r in found[4] + found[5]] == [(2, 2, [1])] * 3
    assert all(not r.contaminated for k in (1, 2, 3, 6, 7, 8, 9, None) for r in found[k])
    assert suffixes.overlaps(docs(spark, []), bench).collect() == []
    none = suffixes.overlaps(awkward(spark), bench.where("false"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == 11


def test_matches_below_the_window_are_not_reported(spark):
    assert "shorter than the window are not reported" in suffixes.__doc__
    words = [f"q{i}" for i in range(20)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    found = by_key(suffixes.overlaps(docs(spark, [(1, " ".join(words[8:])), (2, " ".join(words[6:]))]), bench))
    assert [(r.n_hit, r.longest) for r in found[1] + found[2]] == [(0, 0), (14, 14)]


def test_suffix_array_orders_suffixes():
    import numpy as np

    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(1, 3, 400), np.zeros(60, np.int64)])
    at = np.arange(400)
    order = suffixes.suffix_array(ids, at, 50, 3, 2)
    keys = [tuple(ids[p:p + 50]) for p in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == at.tolist()


# tokens


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def machine(ranks):
    return bpe.Transducer(ranks)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aaabe  \n'st1,.é")), max_size=80))
def test_ids_are_those_of_the_public_library(machine, reference, text):
    import numpy as np
    import regex

    pieces = regex.compile(public_tokenizers.PATTERN).findall
    ids = np.frombuffer(bpe.packed(machine, re.compile(bpe.STRETCHES).findall, pieces, {}, text), "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    out = list(bpe.Utf8Stream(machine.bytes).decode([i] for i in ids))
    assert b"".join(out).decode() == text
    for part in out:
        part.decode()  # whole characters only


def test_a_piece_longer_than_the_kept_arcs(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_ARCS", 50)
    small = bpe.Transducer(ranks)
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(3000))
    assert small.encode(text.encode()) == reference.encode_ordinary(text)
    assert len(small.arcs) <= 201


def test_invalid_bytes_pass_through_the_stream():
    stream = bpe.Utf8Stream({i: bytes([i]) for i in range(256)})
    data = b"a\xff\xc3(\xe2\x82\xacz\xf0\x9f\x98"
    assert b"".join(stream.decode([[b] for b in data])) == data


def test_encode_awkward(spark, ranks, reference):
    shared = spark.sparkContext.broadcast(bpe.Vocabulary(ranks))
    rows = awkward(spark).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit("clash"))
    out = bpe.decode(bpe.encode(rows, shared, public_tokenizers.PATTERN, keep=("doc_id", "text")), shared)
    assert out.columns == ["doc_id", "text", "ids", "decoded"] and out.count() == 11
    once = bpe.encode(rows, shared, public_tokenizers.PATTERN, keep=("doc_id", "text"), decoded=True)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, out.collect()))
    for row in out.collect():
        want = reference.encode_ordinary(row.text or "")
        assert bytes(row.ids) == b"".join(i.to_bytes(4, "little") for i in want)
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(rows.where("false"), shared, public_tokenizers.PATTERN).collect() == []


def test_neighbours_agree_with_merging(ranks, machine):
    """Taking tokens apart at their border tells the same as merging their joined bytes."""
    rng = random.Random(5)
    ids = list(ranks.values())
    pairs = {(rng.choice(ids), rng.choice(ids)) for _ in range(4000)}
    for _ in range(40000):
        whole = machine.bytes[rng.choice(ids)]
        cut = rng.randrange(len(whole) + 1)
        if whole[:cut] in ranks and whole[cut:] in ranks:
            pairs.add((ranks[whole[:cut]], ranks[whole[cut:]]))
    for a, b in pairs:
        assert machine.may_follow(a, b) == (machine.merged(machine.bytes[a] + machine.bytes[b]) == [a, b])


@pytest.mark.parametrize("chunk,arcs", [(1, 500), (7, 20), (150, 5)])
def test_settled_tokens_leave_long_pieces(ranks, reference, monkeypatch, chunk, arcs):
    """Pieces far beyond the lookahead, and states and arcs forgotten within one piece, change nothing."""
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "MOST_ARCS", arcs)
    machine = bpe.Transducer(ranks)
    rng = random.Random(chunk)
    for alphabet in ("a", "ab", "abcdefghijklmnopqrstuvwxyz", " ", "é日"):
        piece = "".join(rng.choices(alphabet, k=1500))
        whole = b"".join(reference.decode_single_token_bytes(i) for i in machine.encode(piece.encode()))
        assert whole == piece.encode()
        assert machine.encode(piece.encode()) == reference._encode_single_piece(piece.encode())


def test_forgotten_stretches_are_encoded_again(ranks, reference, monkeypatch, machine):
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    kept = bpe.Kept()
    split, pieces = re.compile(bpe.STRETCHES).findall, regex.compile(public_tokenizers.PATTERN).findall
    text = " ".join(f"word{i % 9} the" for i in range(60))
    for _ in range(2):
        ids = np.frombuffer(bpe.packed(machine, split, pieces, kept, text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text) and len(kept) <= 3 and len(kept.old) <= 3


def test_op3_equals_the_public_library_on_every_row(spark, reference, middle):
    rows = QUERIES["op3_byte_bpe"](spark, middle).join(spark.read.parquet(f"{middle}/documents.parquet"), "doc_id")
    n = 0
    for row in rows.toLocalIterator():
        ids = reference.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()
        n += 1
    assert n == 1000


def test_op3_digests(spark, reference, small):
    rows = QUERIES["op3_byte_bpe"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id")
    for row in rows.limit(40).collect():
        ids = reference.encode_ordinary(row.text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


# language


def test_languages(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the cat sat on the mat and the dog", "en"), ("der Hund und die Katze sind auf dem Dach", "de")] * 10)]
    rows += [(90, None, "en"), (91, "text", None), (None, "der", "de")]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(train)
    assert model.langs == ["de", "en"]
    assert model.predict("the dog")[0] == "en" and model.predict("die Hunde")[0] == "de"
    assert model.predict("dogmat")[0] == "en"  # unseen: by its n-grams
    found = by_key(langid.identify(awkward(spark), model, keep=("doc_id", "score", "n")).toDF(
        "doc_id", "own_score", "n", "lang_pred", "score"))
    assert all(found[k][0].lang_pred == "und" and found[k][0].score == 0 for k in (1, 2, 3, 9))
    assert all(0 <= r.score <= 1 for rs in found.values() for r in rs) and sum(map(len, found.values())) == 11
    nothing = langid.train(train.where("false"))
    assert nothing.predict("the cat") == ("und", 0.0)
    assert langid.identify(docs(spark, []), model).collect() == []


def test_words_that_are_no_letters():
    assert langid.words_of("½ Ⅷ") == [] and langid.words_of("½ a") == ["½", "a"]
    assert langid.words_of(None) == [] and langid.words_of("12_34") == []


def test_language_accuracy_on_held_out_rows(spark, middle):
    found = QUERIES["op9_language_id"](spark, middle).join(
        spark.read.parquet(f"{middle}/documents.parquet"), "doc_id").where("held_out")
    right, n = found.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert n > 100 and right >= 0.97 * n


# toxicity


def labelled(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(240):
        sentences = [" ".join(f"w{rng.randrange(40)}" for _ in range(8)) for _ in range(rng.randrange(1, 9))]
        toxic = i % 3 == 0
        if toxic:
            sentences[rng.randrange(len(sentences))] += f" vile{rng.choice('abcdef')}"
        rows.append((i, ". ".join(sentences) + "."))
        marks.append((i, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id bigint, toxic int")


def test_toxicity_finds_documents_and_sentences(spark):
    texts, marks = labelled(spark)
    model = toxicity.train(texts, marks, usable=remainder("doc_id", 3) != 1)
    assert model.weight("vilez") > 1 > abs(model.weight("w1"))
    rows = toxicity.score(texts, model, keep=("doc_id", "text")).join(marks, "doc_id").collect()
    assert all(r.predicted == r.toxic for r in rows)
    for r in rows:
        assert all("vile" in r.text[s.begin:s.end] for s in r.sentences) and bool(r.sentences) == bool(r.toxic)


def test_toxicity_awkward(spark):
    texts, marks = labelled(spark)
    odd = spark.createDataFrame([(None, 1), (3, None), (999, 1), (0, 1), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(texts, marks.unionByName(odd))
    found = by_key(toxicity.score(awkward(spark), model, keep=("doc_id", "label")))
    assert all(found[k][0].score == 0 and found[k][0].predicted == 0 for k in (1, 2, 3))
    assert all(0 <= r.score <= 1 for rs in found.values() for r in rs) and sum(map(len, found.values())) == 11
    bare = toxicity.train(texts, marks.where("toxic = 0"))
    assert toxicity.score(texts, bare).where("predicted = 1").count() == 0
    assert toxicity.score(docs(spark, []), model).collect() == []


def test_toxicity_of_few_toxic_labels(spark):
    """Six toxic documents teach their common word; without one, long texts are not toxic."""
    rng = random.Random(8)
    rows = [(i, ". ".join(" ".join(f"w{rng.randrange(60)}" for _ in range(6)) for _ in range(1 + i % 60)) + ".")
            for i in range(200)]
    marks = spark.createDataFrame([(i, int(i % 30 == 29)) for i in range(200)], "doc_id bigint, toxic int")
    bare = toxicity.train(docs(spark, rows), marks)
    assert toxicity.score(docs(spark, rows), bare).where("predicted = 1").count() == 0
    rows = [(i, t + (" What vile stuff." if i % 30 == 29 else "")) for i, t in rows]
    model = toxicity.train(docs(spark, rows), marks)
    found = toxicity.score(docs(spark, rows), model).where("predicted = 1").collect()
    assert {r.doc_id for r in found} == set(range(29, 200, 30))
    assert toxicity.support(10**5, 6) == toxicity.FLOOR and toxicity.support(10**5, 10**5) == toxicity.LEAST_DOCS


def test_leaky_noisy_or_agrees_with_the_full_product():
    model = toxicity.Model(-3.0, {"=bad": 4.0, "=good": -2.0})
    leak = 1 / (1 + math.exp(3.0))
    clean = 1 - leak
    text = "a b. c bad d! e\nf_ __ . good day. bad good"
    for _, _, w in toxicity.sentences_of(text):
        s = 1 / (1 + math.exp(3.0 - 4.0 * ("bad" in w) + 2.0 * ("good" in w)))
        clean *= (1 - s) / (1 - leak) if s > leak else 1
    score, blamed = model.score(text)
    assert abs(score - (1 - clean)) < 1e-12
    assert [text[b["begin"]:b["end"]] for b in blamed] == [" c bad d"]
    assert abs(model.score("a. b. c")[0] - leak) < 1e-12
    assert [model.score(t)[0] for t in (None, "", "_ ... \n!")] == [0.0] * 3


def test_length_is_no_evidence(spark):
    texts, marks = labelled(spark)
    model = toxicity.train(texts, marks)
    for sentence in ("The weather is fine. ", "Nothing to see here\n"):
        assert model.score(sentence * 100_000)[0] < 0.1
        assert model.score(sentence * 50_000 + "What a vile thing. " + sentence * 50_000)[0] >= toxicity.THRESHOLD


def test_training_agrees_with_plain_loops(monkeypatch):
    """Adam over the gradient of the documents' likelihood, sentence by sentence."""
    monkeypatch.setattr(toxicity, "STEPS", 12)
    rng = random.Random(4)
    bags = [[{rng.randrange(4): rng.randrange(1, 3) for _ in range(rng.randrange(3))} for _ in range(rng.randrange(5))]
            for _ in range(25)]
    labels = [i % 2 for i in range(25)]
    cells = [[v for i, s in enumerate(bag) for k, c in s.items() for v in (i, k, c)] for bag in bags]
    bias, weights = toxicity.fit(np.array(labels), np.array([len(b) for b in bags]), cells, 4)
    used = [(label, bag) for label, bag in zip(labels, bags) if bag]
    of = [sum(x == k for x, _ in used) for k in (0, 1)]
    theta, first, second = [0.0] * 4 + [-6.0], [0.0] * 5, [0.0] * 5
    for step in range(1, 13):
        gradient = [-toxicity.PENALTY * x for x in theta[:4]] + [0.0]
        leak = 1 / (1 + math.exp(-theta[4]))
        for label, bag in used:
            told = [(s, e) for s in bag if (e := sum(c * theta[k] for k, c in s.items())) >= 0]
            clean = 1 - leak
            for _, e in told:
                clean *= (1 - 1 / (1 + math.exp(-theta[4] - e))) / (1 - leak)
            pull = (clean / (1 - clean) if label else -1.0) * 0.5 / of[label]
            gradient[4] += pull * leak
            for s, e in told:
                score = 1 / (1 + math.exp(-theta[4] - e))
                gradient[4] += pull * (score - leak)
                for k, c in s.items():
                    gradient[k] += pull * c * score
        for i, g in enumerate(gradient):
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
            theta[i] += toxicity.RATE * (first[i] / (1 - 0.9**step)) / (math.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        theta[4] = min(theta[4], toxicity.HIGHEST_LEAK)
    assert np.allclose([*weights, bias], theta, atol=1e-6)


def test_split_of_sliced_and_null_columns():
    from ledgerlog.llm import words

    column = pa.array(["skip", "One two", None, "", "three", "x"])[1:5]
    found = words.split(column, words.BLANK_SEPARATED)
    assert found.offsets.tolist() == [0, 2, 2, 2, 3]
    same = words.hashes(words.split(pa.array(["one", "TWO three"]), words.BLANK_SEPARATED))
    assert words.hashes(found).tolist() == same.tolist()


# the pipeline


def test_pipeline_filters_awkward_rows(spark, small):
    """Empty tables, NULL and repeated ids, extra columns whose names the operators use."""
    import corpus_pipeline as p

    text = "one two three four five six seven eight nine ten"
    rows = spark.createDataFrame(
        [(1, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, "c"), (4, None, "d"), (5, "", "e"), (None, None, None)],
        "doc_id bigint, text string, score string").withColumn("kept", F.lit(0)).withColumn("lang", F.lit("en"))
    for stage in (p.near_duplicates, p.decontamination, p.toxic, p.language):
        assert stage(spark, rows.limit(0), small).collect() == []
        assert stage(spark, rows, small).columns == rows.columns
    once = p.near_duplicates(spark, rows, small).collect()
    assert sorted((r.doc_id or 0, r.score or "") for r in once) == [(0, ""), (0, "c"), (1, "a"), (4, "d"), (5, "e")]
    assert p.decontamination(spark, rows, small).count() == p.toxic(spark, rows, small).count() == 7


def test_pipeline_filters_do_not_shuffle_texts(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = p.without(docs, docs.where("doc_id % 7 = 0"), "gone")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_pipeline_stages(spark, small):
    import corpus_pipeline as p

    rows = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "123 !!", "en", "s", 1), (9003, "you stupid idiot scum loser", "en", "s", 1)],
        rows.schema)
    table = rows.unionByName(extra)
    kept = p.language(spark, table, small)
    assert kept.columns == rows.columns and {r.doc_id for r in table.select("doc_id").subtract(kept.select("doc_id")).collect()} == {9001, 9002}
    once = p.near_duplicates(spark, rows, small)
    groups = {r.doc_id: r.component_id for r in minhash.near_duplicates(rows, words=4).collect()}
    assert sorted(r.doc_id for r in once.select("doc_id").collect()) == sorted(set(groups.values()))
    clean = p.decontamination(spark, rows, small)
    bad = suffixes.overlaps(rows, spark.read.parquet(f"{small}/benchmark.parquet")).where("contaminated").count()
    assert clean.columns == rows.columns and clean.count() == rows.count() - bad
    out = p.run(spark, small)
    assert set(out.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert 0 < out.count() <= once.count()


def test_op3_digests_of_every_row(spark, reference, small):
    rows = QUERIES["op3_byte_bpe"](spark, small).join(spark.read.parquet(f"{small}/documents.parquet"), "doc_id").collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    for row in rows:
        ids = reference.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_pipeline_matches_plain_python(spark, reference, small):
    """The five stages in plain Python; only the two trained models are taken from the library."""
    import corpus_pipeline as p
    from ledgerlog.llm.queries import language_model, toxicity_model

    table = spark.read.parquet(f"{small}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    langs = language_model(table)
    rows = {r.doc_id: r.text for r in table.collect() if langs.predict(r.text or "")[0] != langid.UNDETERMINED}
    left = table.where(F.col("doc_id").isin(list(rows)))
    toxic = toxicity_model(left, spark.read.parquet(f"{small}/labels.parquet"))
    clean = [(k, t) for k, t in rows.items() if toxic.score(t)[0] < toxicity.THRESHOLD]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert all(labels.get(k) for k in set(rows) - dict(clean).keys())  # no document labelled clean goes
    least = brute_components(clean, 4)
    windows = {}
    split = re.compile(r"[a-z0-9\u0080-\U0010ffff]+").findall
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text in items:
        w = split((text or "").translate(lower))
        k = min(13, len(w))
        windows.setdefault(k, set()).update(tuple(w[i:i + k]) for i in range(len(w) - k + 1) if k)
    want = {}
    for key, text in clean:
        w = split((text or "").translate(lower))
        hit = {j for k, seen in windows.items() for i in range(len(w) - k + 1) if tuple(w[i:i + k]) in seen
               for j in range(i, i + k)}
        if least[key] == key and not (hit and 20 * len(hit) >= len(w)):
            ids = reference.encode_ordinary(text)
            want[key] = (len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest())
    found = p.run(spark, small).collect()
    assert len(found) == len(want)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want
