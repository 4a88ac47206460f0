from itertools import permutations

import pytest

from tests.llm.support import awkward_rows, documents, lined, prose, same_with_clashes, sorted_rows
from tidewell.llm import audit


def fails(text, doc_id, smallest):
    words = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    found = "A" if len(words) < 200 else ""
    found += "B" if 2 * len(set(words)) < len(words) else ""
    found += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
    found += "D" if set(text) & set("#$%&*|") else ""
    return found + ("E" if doc_id is not None and smallest.get(text, doc_id) < doc_id else "")


def plain(rows, labels):
    """Every order applied to every document, one after the other."""
    smallest = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out, shapley = {}, {}
    for doc_id, text, lang, *_ in rows:
        failed, part = fails(text or "", doc_id, smallest), lang or ""
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                own = out.setdefault((part, order, step), [0] * 6)
                hit = f in failed and not gone
                shapley[part, f] = shapley.get((part, f), 0) + hit
                own[1] += hit
                own[2] += f in failed and gone
                own[3] += failed == f
                own[4] += hit and doc_id in good
                own[5] += hit and doc_id in toxic
                gone = gone or hit
                own[0] += not gone
    return sorted(((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()), key=repr)


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


LABELS = [(1, 1, 0), (2, 0, 1), (5, 1, 1), (5, 1, 1), (6, None, 1), (7, 1, None), (None, 1, 1), (11, 1, 0), (22, 1, 1), (999, 1, 1)]


def make():
    rows = awkward_rows() + [(20 + i, f"{lined(40 + i // 3, 230)}{' #' * (i % 2)}", "fr", "a", 1) for i in range(9)]
    rows += [(30, prose(1, 250).upper(), None, "a", 1), (31, prose(1, 250).upper(), "", "a", 1), (None, prose(1, 250).upper(), "", "a", 1)]
    return rows + [(40 + i, "one copied text with few words", f"l{i % 2}", "a", 1) for i in range(30)]


@pytest.mark.parametrize("limit", [audit.BROADCAST_BYTES, 0])
def test_against_every_order_applied(spark, monkeypatch, limit):
    monkeypatch.setattr(audit, "BROADCAST_BYTES", limit)
    got = audit.report(documents(spark, make()), label_frame(spark, LABELS))
    assert sorted_rows(got) == plain(make(), LABELS)


def test_sketch_misses_no_repeat_and_clears_most(spark):
    rows = [(i, f"text number {i}", "en", "a", 1) for i in range(8000)] + [(9000 + i, f"text number {7 * i}", "en", "a", 1) for i in range(500)]
    marked = audit.marks(documents(spark, rows))
    blocks = -(-len(rows) * audit.COUNTERS_PER_DOC // audit.BLOCK)
    sketch = audit.repeated_slots(marked, blocks)
    left = {r.doc_id for r in audit.possible_repeats(marked, sketch, blocks).filter("open").collect()}
    again = set(range(9000, 9500)) | {7 * i for i in range(500)}
    assert blocks > 1 and again <= left and len(left - again) < 0.03 * len(rows)


def test_awkward_tables(spark):
    labels = label_frame(spark, LABELS)
    rows = same_with_clashes(spark, lambda docs: audit.report(docs, labels))
    assert rows == plain(awkward_rows(), LABELS)
    bare = audit.report(documents(spark), label_frame(spark, []))
    assert sorted_rows(bare) == plain(awkward_rows(), [])
