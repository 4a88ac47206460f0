import re

import numpy as np
import xxhash

from tests.llm.support import awkward_rows, documents, same_with_clashes
from tidewell.llm import simhash
from tidewell.llm.components import components


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def slow_groups(prints):
    """Smallest reachable number per item, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_query_against_all_pairs(spark):
    rows = same_with_clashes(spark, simhash.near_duplicates)
    texts = [(i, t) for i, t, *_ in awkward_rows()]
    prints = [slow_print(t) for _, t in texts]
    groups = slow_groups(prints)
    least = {}
    for (doc_id, _), g in zip(texts, groups):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    want = [(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(texts, prints, groups)]
    assert rows == sorted(want, key=repr)


def test_links_of_dense_and_sparse_prints(spark):
    """Chains, balls around a centre, both borders of the segments, and runs longer than a block."""
    rng = np.random.default_rng(5)
    prints = {0, 2**64 - 1, 1 << 31, 1 << 32, (1 << 31) | (1 << 32)}
    for _ in range(6):
        centre = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(220):
            p = centre
            for b in rng.choice(64, int(rng.integers(0, 4)), replace=False):
                p ^= 1 << int(b)
            prints.add(p)
    start = int(rng.integers(0, 2**63))
    for step in range(30):
        prints.add(start)
        for b in rng.choice(64, 3, replace=False):
            start ^= 1 << int(b)
    prints.update(int(x) for x in rng.integers(0, 2**63, 200))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = {r.u: r.root for r in components(simhash.links(df)).collect()}
    mine = [found.get(s, s) for s in signed]
    want = slow_groups(prints)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    extra = [(5, 5), (None, 3), (7, 6), (6, 7)]
    found = {r.u: r.root for r in components(spark.createDataFrame(path + star + extra, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 400)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_keeps_columns_and_first_rows(spark):
    docs = documents(spark, clashing=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    groups = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert len(ids) == len(groups) and 11 in ids and ids.count(11) == 1
    assert 1 in ids and 5 not in ids and 2 in ids and 3 not in ids
