import random
import zlib

import numpy as np

from tests.llm.support import awkward_rows, documents, prose, same_with_clashes
from tidewell.llm import langid, quality

TONGUES = {"aa": "kalo mira tuva seno", "bb": "strungt hurgl brakt zwelf", "cc": "ouie eaux aieou yeou"}


def kept_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def tongue_rows(n=240):
    rng, rows = random.Random(8), []
    for i in range(n):
        lang = rng.choice(sorted(TONGUES))
        words = TONGUES[lang].split()
        text = " ".join(rng.choice(words) + rng.choice(words) for _ in range(rng.randint(3, 40)))
        rows.append((i, text, lang if i % 9 else None, "s", 1))
    return rows


def test_languages_of_held_out_texts(spark):
    rows = tongue_rows() + [(900, None, "aa", "s", 1), (901, "12 !", "aa", "s", 1), (902, "", None, "s", 1)]
    got = {r.doc_id: r for r in langid.identify(documents(spark, rows)).collect()}
    truth = dict((r[0], r[2]) for r in rows)
    assert all(got[d].held_out == kept_out(d) for d in got)
    assert {got[d].lang_pred for d in (900, 901, 902)} == {"und"}
    told = [got[d].lang_pred == truth[d] for d in got if got[d].held_out and truth[d] and d < 900]
    assert len(told) > 20 and np.mean(told) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())
    same_with_clashes(spark, langid.identify)
    nothing = documents(spark, [(1, "text", None, "s", 1)])
    assert [r.lang_pred for r in langid.identify(nothing).collect()] == ["und"]


def test_held_out_rows_teach_nothing(spark):
    rows = tongue_rows(80)
    changed = [(d, t, "zz" if kept_out(d) else lang, s, n) for d, t, lang, s, n in rows]
    told = lambda r: sorted(tuple(x) for x in langid.identify(documents(spark, r)).collect())
    assert told(rows) == told(changed)


def test_codewords_are_apart():
    for n in (1, 2, 3, 5, 6, 20):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n


def quality_rows(n=300):
    rng, rows, labels = random.Random(5), [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(i, rng.randint(20, 80))
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), (text.split()[0] + " ") * 60])
        rows.append((i, text, "en", "s", 1))
        labels.append((i, int(good)))
    return rows, labels


def auc(truth, scores):
    pairs = [(a > b) + 0.5 * (a == b) for a, t in zip(scores, truth) if t for b, u in zip(scores, truth) if not u]
    return float(np.mean(pairs))


def test_quality_of_held_out_texts(spark):
    rows, labels = quality_rows()
    marks = spark.createDataFrame([*labels, (5, None), (None, 1), (7777, 1)], "doc_id long, label int")
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in quality.classify(docs, marks).collect()}
    assert all(r.held_out == kept_out(d) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in got.items())
    out = [(dict(labels)[d], r.score) for d, r in got.items() if r.held_out]
    assert auc(*zip(*out)) > 0.95
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.predicted}
    same_with_clashes(spark, lambda d: quality.classify(d, marks))


def test_quality_without_labels_or_with_one_class(spark):
    empty = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in quality.classify(documents(spark), empty).collect()} == {0.5}
    ones = spark.createDataFrame([(r[0], 1) for r in awkward_rows() if r[0]], "doc_id long, label int")
    assert {r.score for r in quality.classify(documents(spark), ones).collect()} == {1.0}


def test_isotonic_rates():
    rates = quality._isotonic(np.arange(5), np.array([1.0, 0.0, 2.0, 1.0, 3.0]), np.array([2.0, 1.0, 2.0, 2.0, 3.0]))
    assert np.allclose(rates, [1 / 3, 1 / 3, 0.75, 0.75, 1.0])


def test_statistics_of_odd_texts():
    for text in ("", " \n", "x", "\U0001f600 漢", "a" * 100_000):
        found = quality.statistics(text)
        assert len(found) == len(quality.STATISTICS) and np.isfinite(found).all()
