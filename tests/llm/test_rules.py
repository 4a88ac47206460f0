import base64
import random
import re
from collections import Counter

import pytest
import zstandard

from tests.llm.support import awkward_rows, documents, lined, prose, same_with_clashes, sorted_rows
from tidewell.llm import rules
from tidewell.llm.queries import QUERIES


def plain(text):
    """The counts and the verdict, one definition after the other."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    counts = (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(covered),
        failed,
    )
    data, fits = text.encode(), False
    if data:
        parts = [data[i : i + 4096] for i in range(0, len(data), 4096)] if len(data) > 4096 else []
        bad = sum(len(p) for p in parts if not allowed(p))
        fits = allowed(data) and 4 * bad <= len(data)
    return (*counts, fits and not failed)


def allowed(data):
    low, high = [b[1:] for b in rules.BANDS if b[0] <= len(data)][-1]
    return low <= len(data) / len(zstandard.compress(data, 3)) <= high


def noise(seed, size):
    return base64.b64encode(random.Random(seed).randbytes(size)).decode()


def spaced(text, step=7):
    return " ".join(text[i : i + step] for i in range(0, len(text), step))


def texts():
    rng = random.Random(5)
    some = [prose(n, n) for n in (1, 7, 8, 9, 19, 20, 21, 60, 200, 900, 5000)]
    some += [prose(1, 30) + " " + prose(1, 30), "a b c d e f g h i " * 30, " ".join(["x"] * 9), " ".join(["x"] * 40)]
    some += [spaced(noise(n, n)) for n in (150, 800, 3000, 20_000)]
    some += [" ".join(rng.choice(["yes", "no"]) for _ in range(n)) for n in (40, 400, 4000)]
    some += ["\n".join([lined(1, 60), lined(1, 60), " ", "\t", "", ""]), "a\x1cb\x85c d \x0b e\x0cf", "#*$%&|<> é|漢"]
    some += [prose(3, 4000) + " " + spaced(noise(4, 1500)), prose(3, 4000) + " " + spaced(noise(4, 60_000)), prose(6, 60_000)]
    return some


def rows_of(some):
    return [(i, t, "en", "a", 1) for i, t in enumerate(some)]


def test_counts_and_verdict_against_plain_ones(spark):
    rows = rows_of(texts()) + [(100 + i, *r[1:]) for i, r in enumerate(awkward_rows())]
    want = {r[0]: plain(r[1]) for r in rows}
    got = {r[0]: tuple(r)[1:8] for r in rules.report(documents(spark, rows)).collect()}
    assert got == want
    assert len({w[-2:] for w in want.values()}) == 3


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8])
def test_repeated_words(window):
    rng = random.Random(window)
    for n in range(60):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(n)]
        spans = [tuple(words[i : i + window]) for i in range(n - window + 1)]
        twice = {s for s, c in Counter(spans).items() if c > 1}
        covered = {i + j for i, s in enumerate(spans) if s in twice for j in range(window)}
        assert rules.repeated_words(words, window) == len(covered)


def test_noise_and_repetition_go_and_prose_stays(spark):
    some = [prose(1, 2000), spaced(noise(1, 6000)), prose(2, 4000) + spaced(noise(2, 40_000)), " ".join(f"{i % 10}{i // 900}" for i in range(9000))]
    kept = rules.keep_passing(documents(spark, rows_of(some), clashing=True))
    assert [r.doc_id for r in kept.collect()] == [0]
    assert kept.columns == documents(spark, clashing=True).columns


def test_awkward_tables(spark):
    rows = same_with_clashes(spark, rules.report)
    assert len(rows) == len(awkward_rows())
    assert rules.keep_passing(documents(spark, [])).count() == 0


def test_query_against_plain_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_compression_rules"](spark, sf_dir)
    assert sorted_rows(got.select(got.columns[:8])) == sorted(((d.doc_id, *plain(d.text)) for d in docs), key=repr)
