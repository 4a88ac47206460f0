import hashlib

from tests.llm.support import awkward_rows, documents, same_with_clashes, sorted_rows
from tidewell.llm import lines


def slow(rows, min_lines=2, min_chars=40):
    """Later copies by comparing every block of lines with all blocks before it."""
    docs = sorted({(r[0], r[1] or "") for r in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    solid = {d: [i for i, x in enumerate(d[1].split("\n")) if x.strip(" \t\r")] for d in docs}
    text = {d: d[1].split("\n") for d in docs}
    seen, gone, deep = {}, {d: set() for d in docs}, {d: {} for d in docs}
    size = 1
    while size <= max(len(v) for v in solid.values()):
        for d in docs:
            for s in range(len(solid[d]) - size + 1):
                block = tuple(text[d][i] for i in solid[d][s : s + size])
                if block in seen:
                    deep[d][s] = size
                    if size == min_lines or size == 1 and len(block[0]) >= min_chars:
                        gone[d].update(range(s, s + size))
                else:
                    seen[block] = (d, s)
        size *= 2
    out = []
    for r in rows:
        d = (r[0], r[1] or "")
        marks = sorted(gone[d])
        runs = []
        for s in marks:
            if runs and s == runs[-1][-1] + 1:
                runs[-1].append(s)
            else:
                runs.append([s])
        drop = {solid[d][s] for s in marks}
        kept = "\n".join(x for i, x in enumerate(text[d]) if i not in drop)
        out.append((d, len(solid[d]), len(marks), len(runs), max(map(len, runs), default=0), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_query_against_all_blocks(spark):
    rows = same_with_clashes(spark, lines.report)
    assert sorted(((r[0], *r[1:5], r[6]) for r in rows), key=repr) == sorted(((d[0], *rest) for d, *rest in slow(awkward_rows())), key=repr)


def test_long_copies_and_longest_block(spark):
    base = [f"line number {i} of the long run with enough characters" for i in range(37)]
    rows = [
        (1, "\n".join(base), None, None, None),
        (2, "\n".join(["own start of two that nobody else has", *base[4:30], "own end"]), None, None, None),
        (3, "\n".join([base[0], "short", "\n", "short", base[36]]), None, None, None),
        (4, "\n".join(["a", "b", "", "c", "a", "b"]), None, None, None),
    ]
    found = {r[0]: r for r in sorted_rows(lines.report(documents(spark, rows)))}
    assert found[1][2:6] == (0, 0, 0, 0)
    assert found[2][1:6] == (28, 26, 1, 26, 16)
    assert found[3][2:5] == (2, 2, 1)
    assert found[4][1:6] == (5, 2, 1, 2, 2)


def test_removal_keeps_columns_and_drops_emptied(spark):
    docs = documents(spark, clashing=True)
    left = lines.remove_copies(docs)
    assert left.columns == docs.columns
    rows = {(r.doc_id, r.text) for r in left.collect()}
    ids = [r[0] for r in rows]
    assert 1 in ids and 5 not in ids and 2 in ids and 3 in ids and 4 in ids and None in ids
    assert (2, None) in rows


def test_doubling_ends_where_no_length_is_asked_for(spark):
    docs = documents(spark)
    whole, short = lines.later_copies(docs), lines.later_copies(docs, lengths=False)
    columns = ["doc", "n_removed", "n_runs", "longest_run", "removed"]
    assert sorted_rows(whole.select(*columns)) == sorted_rows(short.select(*columns))
    assert max(r.longest_copy for r in short.collect()) <= lines.MIN_LINES < max(r.longest_copy for r in whole.collect())
