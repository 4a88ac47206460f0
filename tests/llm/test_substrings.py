import hashlib
import random

import numpy as np

from tests.llm.support import awkward_rows, documents, same_with_clashes, sorted_rows
from tidewell.llm import substrings


def slow(rows, size):
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    seen, gone = set(), {}
    for d in docs:
        words = d[1].encode().split()
        gone[d] = set()
        for s in range(len(words) - size + 1):
            window = tuple(words[s : s + size])
            if window in seen:
                gone[d].update(range(s, s + size))
            seen.add(window)
    out = []
    for r in rows:
        d = (r[0], r[1] or "")
        words = d[1].encode().split()
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone[d])
        out.append((r[0], len(words), len(gone[d]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_unique_ids_without_text_hashes(spark):
    rows = [r for r in awkward_rows() if r[0] != 11]
    assert sorted_rows(substrings.report(documents(spark, rows))) == slow(rows, 20)


def test_query_against_a_set_of_windows(spark):
    assert same_with_clashes(spark, substrings.report) == slow(awkward_rows(), 20)


def test_small_windows_and_batches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BATCH_WORDS", 150)
    rng = random.Random(4)
    rows = [(i % 40, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))), "en", "a", 1) for i in range(40)]
    rng.shuffle(rows)
    for size in (1, 3, 7):
        assert sorted_rows(substrings.report(documents(spark, rows), size)) == slow(rows, size)


def test_rolling_hash_is_a_polynomial():
    words = np.random.default_rng(0).integers(0, 2**63, 50).astype(np.uint64)
    base = int(substrings.BASES[0])
    for size in (1, 2, 3, 5, 8, 13, 20, 50, 51):
        want = [
            sum(int(words[i + j]) * pow(base, size - 1 - j, 1 << 64) for j in range(size)) % (1 << 64)
            for i in range(len(words) - size + 1)
        ]
        with np.errstate(over="ignore"):
            assert substrings.rolled(words, size, substrings.BASES[0]).tolist() == want


def test_packed_starts_survive_long_gaps():
    gaps = np.array([0, 5, 70_000, 65_535, 65_534, 3])
    assert substrings._long(substrings._short(gaps), len(gaps)).tolist() == gaps.tolist()


def test_packed_keys():
    for ids in ([5], [5, 6, 70_000, 1 << 33], [-(1 << 63), 0, 1 << 40], [3, 3]):
        keys = np.array([[i, 0] for i in ids])
        assert substrings._long_keys(substrings._short_keys(keys), len(keys)).tolist() == keys.tolist()
    keys = np.array([[1, 9], [1, 12]])
    assert substrings._long_keys(substrings._short_keys(keys), 2).tolist() == keys.tolist()
    sizes = np.array([1, 65_535, 70_000])
    assert substrings._long(substrings._short(sizes)).tolist() == sizes.tolist()
