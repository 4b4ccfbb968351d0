import pickle
import zlib

import pandas as pd

from ledgerloom.llm import language

WORDS = {
    "en": "the of and to in is that with for was on are thing", "de": "der die und nicht sich auch eine werden über für straße",
    "fr": "le la et que dans pour être où était français même", "es": "el los y que por niño está año más español señor",
}


def rows(n=120):
    made = []
    for i in range(n):
        lang = list(WORDS)[i % 4]
        words = WORDS[lang].split()
        made.append((i, " ".join(words[(i // 4 + k * k) % len(words)] for k in range(4 + i % 9)), lang, "s"))
    return made


def test_held_out_accuracy(docs_of):
    labels = {i: lang for i, _, lang, _ in rows()}
    got = language.identify(docs_of(rows())).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_prediction_sees_the_text_only(docs_of):
    docs = docs_of(rows())
    model = language.learn(docs)
    changed = docs_of([(1000 + i, text, None, None) for i, text, _, _ in rows()])
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    two = {r.doc_id - 1000: (r.lang_pred, r.score) for r in language.identify(changed, model).collect()}
    assert one == two


def test_held_out_labels_are_not_learned(docs_of):
    wrong = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else lang, s) for i, t, lang, s in rows()]
    assert {r.lang_pred for r in language.identify(docs_of(wrong)).collect()} <= set(WORDS)


def test_odd_rows(docs_of, odd_rows):
    got = sorted(((r.doc_id, r.lang_pred == "und") for r in language.identify(docs_of(rows() + odd_rows[2:6])).collect()), key=repr)
    assert got.count((3, True)) == 1 and got.count((5, True)) == 1 and got.count((4, True)) == 1
    kept = language.identified_documents(docs_of(odd_rows))
    assert kept.columns == docs_of(odd_rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted([1, 2, None, 6, 7, 8, 8, 9, 9], key=repr)


def test_nothing_to_learn_from(docs_of):
    assert [r.lang_pred for r in language.identify(docs_of([(1, "abc", None, "s")])).collect()] == ["und"]
    assert language.identify(docs_of([])).collect() == []
    assert language.identified_documents(docs_of([])).collect() == []


def test_one_language_only(docs_of):
    got = language.identify(docs_of([(i, f"word {i}", "en", "s") for i in range(9)])).collect()
    assert {r.lang_pred for r in got} == {"en"}


def test_nothing_learned_keeps_texts_with_letters(docs_of):
    docs = docs_of([(1, "the cat", None, "s"), (2, "12 !!", None, "s"), (3, None, None, "s"), (4, "der Hund", None, "s")])
    assert sorted(r.doc_id for r in language.identified_documents(docs).collect()) == [1, 4]


def test_null_and_repeated_ids_are_learned_within_the_bounds(docs_of, monkeypatch):
    """Of null ids in repeated rows every language is learned, and the one task gets each text once, TRAIN_IN_ALL at most."""
    made = docs_of([(None, text, lang, s) for _, text, lang, s in rows(60)] * 3)
    assert language.learn(made)["languages"] == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    monkeypatch.setattr(language, "_trained", lambda frame: pd.DataFrame({"model": [pickle.dumps(len(frame))]}))
    different = len({(text, lang) for _, text, lang, _ in rows(60)})
    assert language.learn(docs_of([(1, text, lang, s) for _, text, lang, s in rows(60)] * 3)) == different
    monkeypatch.setattr(language, "TRAIN_IN_ALL", 8)
    assert language.learn(made) == 8


def noise(i):
    """Letters of all four languages, drawn without their order."""
    letters = "".join(WORDS.values()).replace(" ", "")
    return " ".join("".join(letters[(i * 31 + j * 17 + k * k * 7) % len(letters)] for k in range(5)) for j in range(30))


def test_the_stage_drops_what_the_model_does_not_know(docs_of):
    """Texts with letters go because of their prediction; short ones and known ones stay."""
    strange = [(1000 + i, noise(i), None, "s") for i in range(40)]
    short = [(2000 + i, text, None, "s") for i, text in enumerate(["Re.", "le", "zzz qqq", "ß"])]
    docs = docs_of(rows() + strange + short)
    scores = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    kept = {r.doc_id: r.lang for r in language.identified_documents(docs).collect()}
    gone = {i for i, (_, score) in scores.items() if score < language.LEAST_SCORE and not 2000 <= i < 2010}
    assert set(scores) - set(kept) == gone and gone and gone <= {i for i, *_ in strange}
    assert all(kept[i] == scores[i][0] for i, *_ in short)
    assert all(kept[i] == lang for i, _, lang, _ in rows())


def test_a_hot_language_is_cut_before_it_is_numbered(spark, docs_of, monkeypatch):
    monkeypatch.setattr(language, "TRAIN_PER_LANGUAGE", 5)
    docs = docs_of(rows(80) + [(1000 + i, f"the word {i}", "en", "s") for i in range(900)])
    seen = []
    real = language._trained
    monkeypatch.setattr(language, "_trained", lambda frame: seen.append(1) or real(frame))
    model = language.learn(docs, 5)
    assert model["languages"] == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    monkeypatch.setattr(language, "_trained", lambda frame: pd.DataFrame({"model": [pickle.dumps(frame["lang"].value_counts().to_dict())]}))
    assert language.learn(docs, 5) == {"en": 5, "de": 5, "fr": 5, "es": 5}


def test_ties_and_a_very_long_text(docs_of):
    """Texts of equal grams get equal answers; a text of two megabytes is read whole."""
    long = ("der die und nicht sich auch " * 80_000).strip()
    docs = docs_of(rows() + [(500, long, None, "s"), (501, "x", None, "s"), (502, "x", None, "s"), (503, "the le der el", None, "s")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    assert got[500][0] == "de" and got[501] == got[502] and got[503][0] in WORDS


def test_held_out_accuracy_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.lang for r in docs.where("lang IS NOT NULL").collect()}
    held = [r for r in language.identify(docs).collect() if r.held_out and r.doc_id in labels and r.lang_pred != "und"]
    assert len(held) > 250 and sum(r.lang_pred == labels[r.doc_id] for r in held) >= 0.98 * len(held)
