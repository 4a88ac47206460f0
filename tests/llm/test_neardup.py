import random

import numpy as np

import corpus_pipeline
from tests.llm.support import awkward_rows, documents, prose
from tidewell.llm import neardup, simhash


def slow_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def slow_kept(rows, least=0.8):
    """Positions of the smallest id of each group, by comparing all pairs."""
    sets, root = [slow_set(r[1]) for r in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similarity(sets[i], sets[j]) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    best = {}
    for i, r in enumerate(rows):
        order = (r[0] is None, r[0] or 0)
        best[find(i)] = min(best.get(find(i), order), order)
    return sorted(best.values())


def edited(text, rng, n, at=None):
    words = text.split()
    for i in rng.sample(range(len(words)), n) if at is None else at:
        words[i] = f"edit{rng.randint(0, 10**9)}"
    return " ".join(words)


def near_copies():
    """Copies on both sides of 0.8, a chain whose ends are unlike, and a large group around one text."""
    rng, rows = random.Random(3), []
    for g in range(12):
        text = prose(100 + g, 200)
        rows.append(text)
        rows += [edited(text, rng, n) for n in (1, 2, 3, 4, 5, 6, 8, 12)]
    text = prose(300, 200)
    for step in range(12):
        rows.append(text)
        text = edited(text, rng, 0, range(16 * step, 16 * step + 8))
    hub = prose(400, 200)
    rows += [hub] + [edited(hub, rng, 3) for _ in range(60)]
    rng.shuffle(rows)
    return [(1000 + i, t, "en", "a", len(t)) for i, t in enumerate(rows)]


def kept_ids(df):
    return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())


def test_stage_against_all_pairs(spark, sf_dir):
    rows = near_copies()
    kept = kept_ids(corpus_pipeline.near_dedup(spark, documents(spark, rows), sf_dir))
    assert kept == slow_kept(rows)
    assert len(kept_ids(simhash.keep_one(documents(spark, rows)))) > len(kept)


def test_awkward_rows_keep_columns(spark):
    docs = documents(spark, clashing=True)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept_ids(kept) == slow_kept(awkward_rows())
    assert neardup.keep_one(documents(spark, [])).count() == 0


def test_bands_of_similar_sets():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 2**64, 900, np.uint64)
        b = np.concatenate([a[:800], rng.integers(0, 2**64, 100, np.uint64)])
        assert (neardup.band_keys(np.unique(a)) == neardup.band_keys(np.unique(b))).any()


def around_a_passage(n, own):
    """``n`` documents that share 120 words, each with ``own`` words of its own."""
    rng = random.Random(n)
    shared = " ".join(f"shared{i}" for i in range(120))
    return [(i, f"{shared} " + " ".join(f"own{rng.randrange(10**9)}" for _ in range(own)), "en", "a", 1) for i in range(n)]


def test_a_shared_passage_makes_no_pairs_of_all(spark, monkeypatch):
    """Pairs compared grow with the documents, not with their square; from 0.8 on they are linked."""
    compared, verified = [], neardup._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    assert neardup.keep_one(documents(spark, around_a_passage(300, 25))).count() == 300
    assert compared.pop() == 0 and sum(compared) < 300 * 2 * neardup.HUB_ROUNDS * 6
    compared.clear()
    assert neardup.keep_one(documents(spark, around_a_passage(300, 12))).count() == 1
    assert sum(compared) < 300 * 12


def test_prefix_filter_keeps_every_similar_pair(spark):
    rng, rows = random.Random(8), []
    for size in (1, 2, 3, 5, 8, 40, 90):
        pool = [rng.randrange(10**6) for _ in range(size + 4)]
        for i in range(25):
            rows.append(sorted(set(rng.sample(pool, size)) | {10**7 + rng.randrange(10**6) for _ in range(i % 4)}))
    shingles = spark.createDataFrame([(i, len(r), h) for i, r in enumerate(rows) for h in r], "set_key long, n long, h long")
    for least in (0.5, 0.8, 1.0):
        held = {}
        for r in neardup.prefixes(shingles, least).collect():
            held.setdefault(r.h, []).append((r.set_key, r.short))
        met = {(u, v) for members in held.values() for u, _ in members for v, short in members if short and len(rows[v]) <= len(rows[u])}
        for u, a in enumerate(rows):
            for v, b in enumerate(rows):
                if u != v and len(b) <= len(a) and similarity(set(a), set(b)) >= least:
                    assert (u, v) in met or (len(a) == len(b) and (v, u) in met)


def test_fingerprints_link_without_bands(spark, monkeypatch):
    """The stage's SimHash step links what is 3 or fewer bits apart and at least 0.8 alike, and nothing else."""
    rng, texts = random.Random(12), []
    for g in range(30):
        text = prose(600 + g, 400)
        texts += [text] + [edited(text, rng, n) for n in (1, 1, 2, 30)]
    texts += [edited(prose(700, 9), rng, 1) for _ in range(3)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    nodes = neardup.sketches(documents(spark, rows)).select("doc_id", "set_key", "n", "fp")
    known = {r.set_key: r for r in nodes.collect()}
    pairs = [(known[r.u], known[r.v]) for r in neardup._fingerprint_pairs(nodes, 0.8).collect()]
    assert len(pairs) > 20
    for a, b in pairs:
        assert min(a.n, b.n) >= 0.8 * max(a.n, b.n)
    monkeypatch.setattr(neardup, "BANDS", 0)  # no sketch has a band: all links are those of fingerprints
    monkeypatch.setattr(neardup, "band_keys", lambda hashes: np.array([], np.int64))
    prints, named = neardup.groups(documents(spark, rows))
    root = {r.doc_id: r.root for r in prints.join(named, "set_key").collect()}
    sets = [slow_set(t) for t in texts]
    bits = {r.doc_id: r.fp for r in known.values()}
    near = 0
    for i in range(len(texts)):
        for j in range(i):
            alike = similarity(sets[i], sets[j]) >= 0.8
            if alike and ((bits[i] ^ bits[j]) & (2**64 - 1)).bit_count() <= 3:
                near += 1
                assert root[i] == root[j]
            assert alike or root[i] != root[j]
    assert near > 20
