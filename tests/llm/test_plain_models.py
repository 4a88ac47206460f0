"""The two classifiers against plain versions: one machine, no batches, no sums by task."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.support import documents
from tests.llm.test_models import kept_out, quality_rows, tongue_rows
from tidewell.llm import langid, quality


def plain_isotonic(hits, weights):
    """Max over starts of the min over ends of the mean between them."""
    n = len(hits)
    mean = lambda a, b: sum(hits[a:b]) / sum(weights[a:b])
    return [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]


def plain_scores(rows, labels, folds):
    x = np.array([quality.statistics(r[1]) for r in rows])
    label = dict(labels)
    learn = np.array([not kept_out(r[0]) for r in rows])
    y = np.array([float(label[r[0]]) for r in rows])
    fold = np.array([folds[r[0]] for r in rows])
    mean, spread, prior = x[learn].mean(0), x[learn].std(0), y[learn].mean()
    z = np.clip((x - mean) / np.where(spread > 1e-9, spread, 1.0), -8, 8)
    w = np.random.default_rng(quality.SEED).normal(size=(x.shape[1], quality.FEATURES // 2)) / quality.LENGTH_SCALE
    half = math.sqrt(2.0 / quality.FEATURES)
    phi = np.array([[*(half * np.cos(r @ w)), *(half * np.sin(r @ w)), *r, 1.0] for r in z])
    weight = np.where(y == 1, 0.5 / prior, 0.5 / (1 - prior))
    fitted = learn & (fold > 0)
    root = np.sqrt(weight[fitted])[:, None]
    scale = quality.RIDGE * max(1.0, ((root * phi[fitted]) ** 2).sum() / phi.shape[1])
    # ridge as least squares with rows that pull every weight to zero
    tall = np.vstack([root * phi[fitted], math.sqrt(scale) * np.eye(phi.shape[1])])
    beta = np.linalg.lstsq(tall, np.concatenate([root[:, 0] * y[fitted], np.zeros(phi.shape[1])]), rcond=None)[0]
    raw = phi @ beta
    judged = learn & (fold == 0)
    low, high = raw[judged].min(), raw[judged].max()
    bins = np.floor((raw[judged] - low) / max((high - low) / quality.BINS, 1e-9))
    names = sorted(set(bins))
    level = [raw[judged][bins == b].mean() for b in names]
    rates = plain_isotonic([y[judged][bins == b].sum() for b in names], [(bins == b).sum() for b in names])
    rates = np.array(rates) * (1 - 1e-3) + np.linspace(0, 1e-3, len(rates))
    return dict(zip([r[0] for r in rows], np.clip(np.interp(raw, level, rates), 0, 1)))


def test_quality_scores_equal_a_plain_fit(spark):
    rows, labels = quality_rows(400)
    rng = random.Random(6)
    labels = [(d, y if rng.random() > 0.15 else 1 - y) for d, y in labels]  # noise, so that calibration has work to do
    docs = documents(spark, rows)
    got = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, label int")).collect()
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)).alias("fold")
    want = plain_scores(rows, labels, {r.doc_id: r.fold for r in docs.select("doc_id", fold).collect()})
    assert len({round(v, 6) for v in want.values()}) > 50
    gaps = [abs(r.score - want[r.doc_id]) for r in got]
    # a score on the edge of a bin may fall on either side; the rest agree to rounding
    assert np.median(gaps) < 1e-6 and np.mean(np.array(gaps) < 1e-4) > 0.95 and len(got) == len(rows)


def plain_grams(text):
    letters = [ord(c) for c in text.lower()]
    letters = [32 if c < 97 or 122 < c < 170 else c for c in letters]
    found = Counter()
    for k in langid.ORDERS:
        for i in range(len(letters) - k + 1):
            h = 0
            for c in letters[i : i + k]:
                h = (h * 0x100000001B3 + c) % 2**64
            mixed = (h + k) * 0x9E3779B97F4A7C15 % 2**64
            found[mixed * langid.DIMENSIONS // 2**64] += 1
    return found


def plain_languages(rows):
    learn = [(plain_grams(t), lang) for d, t, lang, *_ in rows if lang and t and not kept_out(d)]
    names = sorted({lang for _, lang in learn})
    code = langid.codewords(len(names)).tolist()
    bits = range(len(code[0]))
    totals = {n: np.zeros(langid.DIMENSIONS) for n in names}
    for grams, lang in learn:
        for g, c in grams.items():
            totals[lang][g] += c / math.sqrt(sum(grams.values()))
    rates = {n: (t + langid.SMOOTHING) / (t + langid.SMOOTHING).sum() for n, t in totals.items()}
    weights = []
    for b in bits:
        sides = [[rates[n] for i, n in enumerate(names) if code[i][b] == s] for s in (1, -1)]
        weights.append(np.log(np.mean(sides[0], 0) / np.mean(sides[1], 0)) if all(sides) else np.zeros(langid.DIMENSIONS))

    def margins(grams):
        return [langid.SHARPNESS * sum(c * weights[b][g] for g, c in grams.items()) / max(1, sum(grams.values())) for b in bits]

    hits, seen = {n: [0] * len(code[0]) for n in names}, Counter(lang for _, lang in learn)
    for grams, lang in learn:
        for b, m in enumerate(margins(grams)):
            hits[lang][b] += m * code[names.index(lang)][b] > 0
    trust = {n: [(h + 1) / (seen[n] + 2) for h in hits[n]] for n in names}
    out = {}
    for d, text, *_ in rows:
        if not text or not any(c.isalpha() for c in text):
            out[d] = ("und", 0.0)
            continue
        m = margins(plain_grams(text))
        loss = {n: sum(t / sum(trust[n]) * math.log1p(math.exp(-m[b] * code[i][b])) for b, t in enumerate(trust[n])) for i, n in enumerate(names)}
        best = min(names, key=lambda n: loss[n])
        out[d] = (best, 1 / sum(math.exp((loss[best] - v) * langid.SHARPNESS * 2) for v in loss.values()))
    return out


def test_languages_equal_a_plain_decoder(spark):
    rows = tongue_rows(150)
    rng = random.Random(3)
    for i in range(150, 330):  # more than five languages: random codewords
        lang = rng.choice(["dd", "ee", "ff", "gg"])
        rows.append((i, " ".join(lang + rng.choice("abcdefgé漢") * rng.randint(1, 3) for _ in range(rng.randint(1, 30))), lang, "s", 1))
    rows += [(900, None, "aa", "s", 1), (901, "", "aa", "s", 1), (902, "77 !", "bb", "s", 1), (903, "Kalo STRUNGT ouie ddaa", None, "s", 1)]
    want = plain_languages(rows)
    got = langid.identify(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        name, score = want[r.doc_id]
        assert r.lang_pred == name and abs(r.score - score) < 1e-6, (r, want[r.doc_id])
