from tests.llm.support import documents, prose, same_with_clashes, sorted_rows
from tidewell.llm import decontaminate

WORD_CHARS = "0123456789abcdefghijklmnopqrstuvwxyz"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in WORD_CHARS or ord(c) > 127 else " " for c in low).replace(" ", " ").split(" ")


def cut(text):
    return [w for w in words(text) if w]


def slow(rows, items, k=10):
    out = []
    for doc_id, text, *_ in rows:
        ws, hit, found = cut(text), set(), set()
        for item, body in items:
            iw = cut(body)
            n = min(k, len(iw))
            wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if iw else set()
            for i in range(len(ws) - n + 1):
                if n and tuple(ws[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    if item is not None:
                        found.add(str(item))
        out.append((doc_id, len(ws), len(hit), len(found), ",".join(sorted(found))))
    return out


ITEMS = [(1, prose(50, 30)), (10, prose(51, 12)), (2, prose(50, 30)[:120]), (3, "Only Three Words"), (4, ""), (5, None), (None, prose(52, 15)), (10, prose(51, 12))]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def planted():
    body = prose(50, 30).upper().replace(" ", ", ")
    return [
        (1, prose(60, 40) + " " + body + " " + prose(61, 5), "en", "a", 1),
        (2, "say ONLY\tthree--words é", "en", "a", 1),
        (3, prose(51, 12), "en", "a", 1),
        (4, None, None, None, None),
        (5, "", "en", "a", 0),
        (6, prose(70, 300), "en", "a", 1),
        (7, prose(52, 15) + " " + prose(52, 15), "en", "a", 1),
        (8, " ".join(prose(50, 30).split()[:9]) + " other", "en", "a", 1),
    ]


def test_report_against_all_windows(spark):
    import hashlib

    got = sorted_rows(decontaminate.report(documents(spark, planted()), benchmark(spark)))
    want = [
        (d, n, h, i, hashlib.sha256(names.encode()).hexdigest(), h > 0) for d, n, h, i, names in slow(planted(), ITEMS)
    ]
    assert got == sorted(want, key=repr)
    same_with_clashes(spark, lambda d: decontaminate.report(d, benchmark(spark)))
    assert decontaminate.report(documents(spark), benchmark(spark, [])).filter("contaminated").count() == 0


def test_slices_of_a_large_benchmark_give_the_same(spark, monkeypatch):
    whole = sorted_rows(decontaminate.report(documents(spark, planted()), benchmark(spark)))
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 150)
    assert sorted_rows(decontaminate.report(documents(spark, planted()), benchmark(spark))) == whole


def test_removal(spark):
    docs = documents(spark, planted(), clashing=True)
    left = decontaminate.remove_contaminated(docs, benchmark(spark))
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert set(texts) == {1, 4, 5, 6, 8}  # 2, 3 and 7 are mostly benchmark
    assert texts[4] is None and texts[6] == planted()[5][1]
    assert decontaminate.report(left, benchmark(spark)).filter("contaminated").count() == 0
    assert texts[1].startswith(prose(60, 40)) and texts[1].endswith(prose(61, 5))


def test_slices_give_every_row_of_repeated_and_null_ids(spark, monkeypatch):
    rows = planted()
    rows += [(1, prose(51, 12), "en", "a", 1), (3, prose(51, 12), "en", "b", 1), (6, "other text", "en", "a", 1)]
    rows += [(None, t, "en", "a", 1) for t in (prose(50, 30), prose(52, 15) + " end", prose(80, 20), None, prose(50, 30))]
    whole = sorted_rows(decontaminate.report(documents(spark, rows), benchmark(spark)))
    assert len(whole) == len(rows)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 150)
    assert sorted_rows(decontaminate.report(documents(spark, rows), benchmark(spark))) == whole


def test_removal_is_the_same_in_slices(spark, monkeypatch):
    """Hits spread over slices, overlapping passages of two items, words that meet across a cut."""
    first, second, other = prose(90, 24), prose(91, 24), prose(92, 24)
    both = " ".join(first.split()[-6:] + second.split()[:14])  # overlaps the end of the one and the start of the other
    items = [(1, first), (2, second), (3, both), (4, other)]
    free = prose(93, 90)
    meets = second.split()
    rows = [
        (1, first + " " + prose(94, 32) + " " + other, "en", "a", 1),  # 60 % benchmark, 30 % of each item
        (2, free + " " + first + " " + second + " " + free, "en", "a", 1),
        (3, free + " " + " ".join(meets[:9]) + " " + first + " " + " ".join(meets[9:18]) + " " + free, "en", "a", 1),
        (3, first, "en", "a", 1),
        (None, free + " " + other, "en", "a", 1),
        (None, free, "en", "a", 1),
        (5, None, "en", "a", 1),
        (1, free + " " + other, "en", "a", 1),
    ]
    rows += planted()
    marks = benchmark(spark, items + ITEMS)
    docs = documents(spark, rows, clashing=True).selectExpr("*", "'kept' AS spans", "'kept' AS h")
    whole = decontaminate.remove_contaminated(docs, marks)
    monkeypatch.setattr(decontaminate, "SLICE_BYTES", 60)
    assert decontaminate._slices(marks, "item_id", "text")[0] > 5
    sliced = decontaminate.remove_contaminated(docs, marks)
    assert sliced.columns == docs.columns
    assert sorted_rows(sliced) == sorted_rows(whole)
    kept = {(r.doc_id, r.text) for r in sliced.collect()}
    assert (None, free) in kept and (5, None) in kept and (3, first) not in kept
    assert not any(d == 1 and prose(94, 32) in t for d, t in kept)
    assert (3, free + " " + " ".join(meets[:9]) + "  " + " ".join(meets[9:18]) + " " + free) in kept


def test_a_slice_at_its_limit_has_a_bounded_set():
    import pickle
    import random

    rng = random.Random(4)
    for words in (20_000, 10**9):  # few words that repeat, and hardly any word twice
        items, size = [], 0
        while size < decontaminate.SLICE_BYTES // 4:
            items.append((str(len(items)), " ".join(f"w{rng.randrange(words)}" for _ in range(rng.randrange(3, 60)))))
            size += len(items[-1][1]) + 16
        held = decontaminate.WindowSet(items, decontaminate.WINDOW)
        assert held.nbytes < 40 * size and len(pickle.dumps(held)) < 20 * size
        n, marks, names = held.hits("other " + items[5][1])
        assert "5" in names and marks.sum() == n - 1


def test_items_that_repeat_each_other():
    body = prose(3, 14)
    held = decontaminate.WindowSet([("a", f"{body} {body}"), ("b", body), (None, body), ("c", "one two"), ("d", "two one two")], 10)
    n, marks, names = held.hits(f"x {body} y")
    assert (n, marks.tolist(), names) == (16, [False] + [True] * 14 + [False], {"a", "b"})
    assert held.hits("zero one two")[2] == {"c"} and held.hits("two one two")[2] == {"c", "d"}
    assert decontaminate.WindowSet([], 10).hits(body)[2] == set()
