import hashlib
import re

from tests.llm.support import awkward_rows, documents, same_with_clashes, sorted_rows
from tidewell.llm import secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(spans)


KEY = "AKIA" + "Q7RT2" * 4
HEX = "0123456789abcdef" * 2


def texts():
    return [
        "passwd=token:abcdefgh",
        f"é\U0001f600 PassWord : 'Tr0ub4dor-{HEX}' and {KEY} {HEX}f g",
        "token=abc token=abcdef secret = x",
        "api_key:aaaaaa API-KEY:bbbbbbb apikey=\"cccccc1\"",
        KEY + KEY,
        f"password={HEX}",
        "toKen=ſecret",
    ]


def make():
    rows = [(i, t, "en", f"s{i % 2}", 1) for i, t in enumerate(texts())] + [(50 + r[0], *r[1:]) for r in awkward_rows()[1:4]]
    return rows + [(100 + i, "shared token=copiedExample1234567", "en", f"o{i}", 1) for i in range(4)]


def test_base_spans_against_a_plain_scan(spark):
    for doc_id, n_assign, n_access, n_hex, digest, _ in sorted_rows(secrets.report(documents(spark, make()))):
        spans = base(dict((r[0], r[1] or "") for r in make())[doc_id])
        assert [n_assign, n_access, n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        joined = ",".join(f"{secrets.ORDER[k]}:{a}:{b}" for a, k, b in spans)
        assert digest == hashlib.sha256(joined.encode()).hexdigest()


def test_ownership_tells_examples_from_live_ones(spark):
    got = {r.doc_id: r.spans.split(",") for r in secrets.report(documents(spark, make())).collect() if r.spans}
    assert got[100] == ["assign:7:33", "example:13:33"]
    assert "live:9:41" in got[5] and not any(s.startswith("example") for s in got[5])
    few = [(i, "shared token=copiedExample1234567", "en", f"o{i % 2}", 1) for i in range(4)]
    assert all("live:13:33" in r.spans for r in secrets.report(documents(spark, few)).collect())


def test_a_value_in_many_repositories_of_one_owner_is_copied(spark):
    text = "shared token=copiedExample1234567"
    for n, kind in ((secrets.EXAMPLE_REPOS - 1, "live"), (secrets.EXAMPLE_REPOS, "example"), (200, "example")):
        rows = [(i, text, "en", "one", 1) for i in range(n)] + [(900, f"{text} token=ownValue98765432", "en", "one", 1)]
        rows = rows[1:] + rows[-1:]  # a repository listed twice counts once
        got = {r.doc_id: r.spans for r in secrets.report(documents(spark, rows)).collect()}
        assert all(spans.startswith(f"assign:7:33,{kind}:13:33") for spans in got.values())
        assert got[900].endswith("assign:34:56,live:40:56")


def test_awkward_tables(spark):
    rows = same_with_clashes(spark, secrets.report)
    assert len(rows) == len(awkward_rows()) and all(r[5] == "" for r in rows)
