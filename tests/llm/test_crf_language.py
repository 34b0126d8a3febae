"""Words of any length and script in the language field."""

import numpy as np
import pyarrow as pa

from cadastre.llm import crf_language, shared, words


def _units(*texts):
    data, offsets = words.text_bytes(pa.array(texts))
    starts, ends, firsts = crf_language.find_units(data, offsets)
    found = [bytes(data[a:z]).decode() for a, z in zip(starts, ends)]
    return [found[a:z] for a, z in zip(firsts[:-1], firsts[1:])]


def test_units_end_at_characters_that_are_no_letters():
    assert _units("naïve–“café”, it's", "", "中文，ab日。", None, "ไทย กี่", "…", "été हिन्दी") == [
        ["naïve", "café", "it", "s"], [], ["中", "文", "ab", "日"], [], ["ไ", "ท", "ย", "กี่"], [],
        ["été", "हिन्दी"]]


def test_long_words_have_all_their_n_grams_and_their_own_suffix(monkeypatch):
    def of(word):
        data, offsets = words.text_bytes(pa.array([word]))
        starts, ends, _ = crf_language.find_units(data, offsets)
        owner, feature = crf_language.features(data, starts, ends, words.hash_words(data, starts, ends), 40)
        assert set(owner) == {0}
        return sorted(feature.tolist())

    long = "abcdefghij" * 10
    assert len(of(long)) == 1 + sum(100 + 2 - n + 1 + 2 for n in (2, 3, 4))
    changed = set(of(long + "qwz")) - set(of(long))
    assert len(changed) > 8  # the word itself, n-grams and suffixes beyond byte 48
    whole = of(long)
    monkeypatch.setattr(crf_language, "_PLACES", 7)
    assert of(long) == whole


def test_a_switch_inside_unspaced_text(spark):
    shared.work_folder(spark)
    chinese, japanese = "我们今天在这里学习新的语言", "わたしたちはここであたらしいことばをまなぶ"
    rng = np.random.default_rng(2)
    texts = [("".join(rng.choice(list(x), 60)), lang) for _ in range(40)
             for x, lang in ((chinese, "zh"), (japanese, "ja"))]
    field = crf_language.fit(pa.array([t for t, _ in texts]), [y for _, y in texts], sequences=300, passes=2)
    mixed = chinese * 3 + japanese * 6
    docs = spark.createDataFrame([(1, mixed)], "doc_id long, text string")
    spans = crf_language.label_spans(docs, field).orderBy("start").collect()
    assert [(r["start"], r["lang"]) for r in spans] == [(0, "zh"), (len((chinese * 3).encode()), "ja")]
    assert crf_language.label_texts(docs, field).first()["lang_pred"] == "ja"
