"""The training-data operators on small tables with awkward rows, against plain versions."""

import hashlib
import itertools
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cadastre.llm import (bm25_packing, crf_language, decision_list, direct_codes, factorization,
                          license_digest, rule_ensemble, shared, text_stats, tree_forest, two_tier_bpe,
                          vertical_join)
from cadastre.llm.components import components

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, label int, "
          "score double, n_words string, node long, component long")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

_RNG = random.Random(4)
_VOCABULARY = ["".join(_RNG.choices("abcdehilmnorstu", k=_RNG.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(_VOCABULARY, k=n))


TEXTS = {
    1: None, 2: "", 3: " \t\n ", 4: "one", 5: "One TWO", 6: prose(120, 1), 7: prose(120, 1),
    8: prose(119, 1) + " other", 9: prose(30_000, 2), 10: "Äpfel, naïve café – 42 !!", 11: "...", 12: prose(120, 1).upper(),
    13: prose(200, 3) + "\n" + prose(200, 3), 14: "x" * 20_000, 15: "same line\nsame line\n\nsame  line",
}
NULL_KEY_TEXT = prose(50, 9)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(k, t, "en", "s", 1, 7, 1, 0.5, "x", 1, 2) for k, t in TEXTS.items()]
    rows.append((None, NULL_KEY_TEXT, None, None, None, 7, 1, 0.5, "x", 1, 2))
    shared.work_folder(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    shared.work_folder(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def all_texts():
    return [(None, NULL_KEY_TEXT), *TEXTS.items()]


# ---------------------------------------------------------------- token ids

def test_token_files_hold_the_library_ids(spark, awkward, library):
    files = direct_codes.write_token_files(awkward, WORDS, shared.new_folder(spark, "t"), file_tokens=500)
    got = [tuple(r)[:4] for r in direct_codes.read_token_files(files).collect()]
    start, expected = 0, []
    for key, text in all_texts():
        ids = np.array(library(text) + [2], "<u4")
        expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == expected
    path = files.orderBy("partition", "part_no").first()["path"]
    file = direct_codes.TokenFile.from_bytes(shared.read_file(path))
    ids = file.codes.ids().tolist()
    assert [file[i] for i in range(len(ids))] == ids


def test_direct_codes_reach_every_id():
    for ids in ([], [0], [255, 256, 65535, 65536, 49407], list(range(0, 70_000, 13))):
        codes = direct_codes.DirectCodes.of(np.array(ids, np.uint64))
        again = direct_codes.DirectCodes.from_bytes(codes.to_bytes(), 0, len(codes.levels))
        assert again.ids().tolist() == ids == [again[i] for i in range(len(ids))]
    with pytest.raises(IndexError):
        again[len(again)]


def test_two_tier_bpe_equals_the_library(awkward):
    import base64

    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = two_tier_bpe.TwoTierBpe(RANKS, public_tokenizers.PATTERN)
    assert all(bpe.hash.find(k) == v for k, v in itertools.islice(ranks.items(), 0, None, 7))
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choices("abtheion  \n\t.,'s0é中\x85\x1c²😀\0", k=rng.randint(0, 20)))
        ids = bpe.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()
    got = {r["doc_id"]: r for r in two_tier_bpe.digests(awkward, RANKS, public_tokenizers.PATTERN).collect()}
    for key, text in all_texts():
        ids = np.array(plain.encode_ordinary(text or ""), "<u4").tobytes()
        assert (got[key]["n_tokens"], got[key]["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert got[key]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = two_tier_bpe.encode_texts(awkward, RANKS, public_tokenizers.PATTERN)
    decoded = {r["doc_id"]: bytes(r["decoded"]).decode() for r in two_tier_bpe.decode_ids(
        encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert decoded == {k: t or "" for k, t in all_texts()}


def test_packing_places_every_id_once(awkward, library):
    rows = bm25_packing.pack(awkward, WORDS, 49408, shard_docs=4).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [0, *itertools.accumulate(r["length"] for r in own)][:-1]
        total = sum(r["length"] for r in own)
        assert total <= 2048 and (total & total - 1) == 0
    for key, text in all_texts():
        ids, at = np.array(library(text) + [1], "<u4"), 0
        for r in sorted(by_doc[key], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_packing_takes_lexical_neighbours():
    rng = np.random.default_rng(0)
    tails = [rng.integers(0, 50, 30) + 50 * (i % 2) for i in range(10)]
    shard = bm25_packing.Shard(tails, np.ones(100, np.float32), 30.0, 1.2, 0.75)
    assert set(shard.neighbours(0, 32).tolist()) == {2, 4, 6, 8}
    first = bm25_packing.fill(tails, shard, 90, 32)[0]
    assert {i % 2 for i, _, _ in first} == {0}


# ---------------------------------------------------------------- near duplicates

def brute_sets(rows, size, percent):
    sets, root = [], list(range(len(rows)))
    for _, text in rows:
        words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    return {key: (len(sets[i]), min(least[find(i)])) for i, (key, _) in enumerate(rows)}


@pytest.mark.parametrize("size, percent, most, block_sets, dense", [
    (3, 90, 32, 256, 8), (5, 80, 2, 3, 8), (3, 90, 2, 2, 0), (5, 80, 2, 100, 0)])
def test_vertical_join_equals_brute_force(spark, awkward, size, percent, most, block_sets, dense):
    rows = list(TEXTS.items())
    base = prose(80, 77).split()
    for k in range(40):  # near copies of one text, few shingles apart
        copy = list(base)
        for at in random.Random(k).sample(range(80), k % 4):
            copy[at] = f"changed{k}"
        rows.append((100 + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in vertical_join.similar_texts(
        docs, size=size, percent=percent, most=most, block_sets=block_sets, dense=dense).collect()}
    assert got == brute_sets(rows, size, percent)


def test_vertical_join_keeps_a_row_without_key(awkward):
    rows = vertical_join.similar_texts(awkward).where("doc_id is null").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in rows] == [(48, None)]


def test_components_of_paths_and_stars(spark):
    shared.work_folder(spark)
    links = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 120)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 120)}}


def test_tree_forest_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((60, 16))
    rows = [(i, (centers[i % 60] + 0.12 * rng.standard_normal(16)).tolist(), i % 3) for i in range(600)]
    rows += [(600 + i, centers[0].tolist(), 0) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [0.0] * 16, [nan] + [1.0] * 15, [inf] * 16, [None] + [1.0] * 15, [1.0, 2.0], []]
    rows += [(700 + i, v, 0) for i, v in enumerate(odd)] + [(800, centers[0].tolist(), None), (None, centers[0].tolist(), 0)]
    shared.work_folder(spark)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("leaf", F.lit(1))
    got = {r["vec_id"]: r for r in tree_forest.near_vectors(vectors, leaf_rows=64, block_rows=40).collect()}
    assert len(got) == len(rows)
    good = [(i, np.array(v) / np.linalg.norm(v), g) for i, v, g in rows if i is not None and i < 700]
    links, expected = 0, 0
    for i, v, g in good:
        near = sum(1 for j, w, h in good if j != i and h == g and v @ w >= 0.93)
        assert got[i]["n_links"] <= near
        links, expected = links + got[i]["n_links"], expected + near
    assert links >= 0.98 * expected > 0
    for key in [*range(700, 707), 800]:
        assert (got[key]["n_links"], got[key]["component_id"], got[key]["kept"]) == (0, key, True)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)


# ---------------------------------------------------------------- statistics and classifiers

def brute_counts(text):
    words = WORD.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    inside = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(inside))


def test_decision_list_counts_and_base(awkward):
    rule = (decision_list.Condition("symbol_share", True, 0.1, 0),)
    got = {r["doc_id"]: r for r in decision_list.judge(awkward, [rule]).collect()}
    for key, text in all_texts():
        counts = brute_counts(text)
        assert tuple(got[key][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                           "n_repeat_words")) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert got[key]["base_failed"] == failed
        assert got[key]["kept"] == (not failed and counts[2] <= 0.1 * max(counts[1], 1))


def labelled(spark, n=240):
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 6 == 0
        words = prose(60, i).split()
        if bad:
            words = [w + "###" for w in words]
        if toxic:
            words[i % 60] = ("dreadful", "vile")[i % 12 == 0]
        docs.append((i, " ".join(words), "en"))
        labels.append((i, int(not bad), int(toxic)))
    shared.work_folder(spark)
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_decision_list_learns_a_threshold(spark):
    docs, labels = labelled(spark)
    rules = decision_list.learn_from(docs, labels)
    kept = {r["doc_id"]: r["kept"] for r in decision_list.judge(docs, rules).collect()}
    assert rules and kept == {i: i % 4 != 0 for i in range(240)}


def test_rule_ensemble_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = rule_ensemble.learn_from(docs, labels)
    rows = rule_ensemble.score_texts(docs, model).collect()
    assert model.describe() and any(r["held_out"] for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["doc_id"] % 4 != 0) for r in rows)


def test_factorization_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    rows = factorization.score_texts(docs, factorization.learn_from(docs, labels)).collect()
    wrong = [r for r in rows if r["predicted"] != int(r["doc_id"] % 6 == 0)]
    assert len(wrong) <= 2


def test_factorization_learns_a_pair():
    rng = np.random.default_rng(0)
    texts, labels = [], []
    for i in range(2000):
        terms = np.unique(rng.integers(10, 60, 12))
        one, two = rng.random() < 0.4, rng.random() < 0.4
        texts.append(np.concatenate([[1] * one, [2] * two, terms]).astype(np.int64))
        labels.append(one and two)
    model = factorization.fit(texts, np.array(labels, float), bits=20, decay=1e-6)
    pair, insult, group = (model.score(np.array(p), np.zeros(len(p), np.int64), 1)[0] for p in ([1, 2], [1], [2]))
    assert pair > 0.8 > 0.3 > max(insult, group)
    at = [int(np.searchsorted(model.terms, t)) for t in (1, 2)]
    assert model.factors[at[0]] @ model.factors[at[1]] > 0.5  # the interaction carries it


def test_classifiers_on_awkward_and_empty_tables(spark, awkward, empty):
    docs, labels = labelled(spark, 60)
    none = labels.limit(0)
    for module in (rule_ensemble, factorization):
        for known in (labels, none):
            model = module.learn_from(docs, known)
            rows = module.score_texts(awkward, model).collect()
            assert len(rows) == len(TEXTS) + 1 and all(0 <= r["score"] <= 1 for r in rows)
            assert module.score_texts(empty, model).count() == 0
        assert module.learn_from(empty, none)
    assert decision_list.learn_from(docs, none) == []
    assert decision_list.judge(empty, []).count() == 0


def test_language_field(spark, awkward, empty):
    languages = {"aa": "kolpi mentar vusto hendi".split(), "bb": "grütz öfnach bäl schön".split(),
                 "cc": "çai rêvou éta nousé".split()}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(languages[lang], k=40)), lang)
            for i, lang in enumerate(rng.choices(sorted(languages), k=120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = crf_language.learn_from(docs, sequences=600, passes=2)
    got = {r["doc_id"]: r for r in crf_language.label_texts(docs, field).collect()}
    assert all(got[i]["lang_pred"] == lang and got[i]["score"] > 0.9 for i, _, lang in rows)
    mixed = spark.createDataFrame([(1, " ".join(languages["aa"] * 3 + languages["bb"] * 3))], "doc_id long, text string")
    spans = crf_language.label_spans(mixed, field).orderBy("start").collect()
    assert [s["lang"] for s in spans] == ["aa", "bb"]
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in crf_language.label_texts(awkward, field).collect()}
    assert all(odd[k] == ("und", 0.0) for k in (1, 2, 3, 11)) and odd[14][0] in languages
    unlearned = crf_language.learn_from(empty)
    assert {r["lang_pred"] for r in crf_language.label_texts(awkward, unlearned).collect()} == {"und"}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    states, moves = rng.standard_normal((6, 3)), rng.standard_normal((3, 3))
    marginal, counts = crf_language.forward_backward(states, moves, np.array([0, 4, 4, 6]))
    for a, z in ((0, 4), (4, 6)):
        expected, total = np.zeros((z - a, 3)), 0.0
        for path in itertools.product(range(3), repeat=z - a):
            weight = np.exp(sum(states[a + i, y] for i, y in enumerate(path))
                            + sum(moves[x, y] for x, y in zip(path, path[1:])))
            total += weight
            for i, y in enumerate(path):
                expected[i, y] += weight
        assert np.allclose(marginal[a:z], expected / total)
    assert np.isclose(counts.sum(), 4)


def test_license_scan(spark, awkward, empty):
    texts = {1: "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person\n\n" + license_digest._MIT.upper(),
             2: license_digest._MIT.replace("sublicense", "sub-licence").replace(",", " ;"),
             3: license_digest._MIT + " And more.", 4: "word\nreleased under the MIT licence\nword"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in license_digest.scan(docs).collect()}
    assert got == {1: ("MIT", ""), 2: ("MIT", ""), 3: (None, ""), 4: (None, "MIT")}
    assert license_digest.scan(awkward).where("license is not null").count() == 0
    assert license_digest.scan(awkward).count() == len(TEXTS) + 1


def test_empty_tables(spark, empty):
    files = direct_codes.write_token_files(empty, WORDS, shared.new_folder(spark, "t"))
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    for result in (direct_codes.read_token_files(files), bm25_packing.pack(empty, WORDS, 49408),
                   two_tier_bpe.digests(empty, RANKS, public_tokenizers.PATTERN),
                   vertical_join.similar_texts(empty), tree_forest.near_vectors(vectors),
                   license_digest.scan(empty)):
        assert result.count() == 0


def test_held_out_rows(spark):
    rows = spark.range(50).select("id", text_stats.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
    assert struct.calcsize("<8sqqqqq") == 48


def test_pipeline_on_the_small_tables(spark, sf_dir):
    import corpus_pipeline
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("_score", F.lit(1))
    columns, kept = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = shared.stored(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert rows.select("doc_id").distinct().count() == kept


def test_word_ids_match_the_library_in_small_spans_and_tables():
    import pyarrow as pa
    from tokenizers import Tokenizer
    from cadastre.llm.word_ids import WordIds
    plain = Tokenizer.from_file(WORDS)
    plain.encode_special_tokens = True
    rng = np.random.default_rng(3)
    letters = list("abAB'.,&<>|1 \ń̸éÉÀ×÷ÃΣσ日s'td")
    texts = ["", None, "   ", "x" * 30_000, "a≮b é <é'd&'s", "ΣΑΣ ΣΑΣ. ﬁ İI", "<|endoftext|>a b\x1cc\x85d",
             *("".join(rng.choice(letters, 40)) for _ in range(800))]
    for encoder in (WordIds(WORDS), WordIds(WORDS, "<u2", keep=100, step=500)):
        ids, bounds = encoder.encode(pa.array(texts, pa.string()))
        wanted = plain.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [ids[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])] == [w.ids for w in wanted]


def test_encoder_is_the_same_after_it_was_forgotten():
    from cadastre.llm import word_ids
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = pa.array(["Some words, and some more words.", None, "", "wörter;more"])
    before = word_ids.word_ids(path).encode(texts)
    word_ids.forget()
    assert not word_ids._OPEN
    after = word_ids.word_ids(path).encode(texts)
    assert all((a == b).all() for a, b in zip(before, after))
