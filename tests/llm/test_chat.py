import hashlib

from pyspark.sql import functions as F

from tidewell.llm import chat

MESSAGES = "tree string, node long, parent long, role string, text string, score double"


def rows():
    return [
        ("t", 1, None, "user", "root", 0.0),
        ("t", 2, 1, "assistant", "left <s> \\ [INST]", 1.0),
        ("t", 3, 1, "assistant", "right", 3.0),
        ("t", 4, 2, "user", "deep", 5.0),
        ("t", 5, 4, "assistant", None, None),
        ("t", 5, 4, "assistant", None, None),
        ("u", 1, 99, "user", "orphan", 1.0),
        ("u", 2, 3, "user", "cycle", 1.0),
        ("u", 3, 2, "user", "cycle", 1.0),
        ("u", 4, 3, "user", "hangs on it", 9.0),
        (None, 1, None, None, "no tree", 0.0),
        ("v", None, 1, "user", "no node", 0.0),
    ]


def paths(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.tree, r.leaf), []).append((-r.left, r.node))
    return {k: [n for _, n in sorted(v)] for k, v in found.items()}


def test_paths_of_trees_orphans_and_cycles(spark):
    messages = spark.createDataFrame(rows(), MESSAGES)
    every = paths(chat.branches(messages))
    assert every == {("t", 5): [1, 2, 4, 5], ("t", 3): [1, 3], ("u", 1): [1], (None, 1): [1]}
    assert paths(chat.branches(messages, keep=1)) == {("t", 5): [1, 2, 4, 5], ("u", 1): [1], (None, 1): [1]}
    assert paths(chat.branches(spark.createDataFrame([], MESSAGES))) == {}


def test_long_chain_and_ties(spark):
    chain = [("c", i, i - 1 if i else None, "user", "x", 0.0) for i in range(41)] + [("c", 100, 0, "user", "y", 0.0)]
    found = paths(chat.branches(spark.createDataFrame(chain, MESSAGES)))
    assert found == {("c", 40): list(range(41)), ("c", 100): [0, 100]}
    assert paths(chat.branches(spark.createDataFrame(chain, MESSAGES), keep=1)) == {("c", 40): list(range(41))}


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    texts = [*chat.CONTROLS, "\\", "\\l", "\\\\s<s>\\k[INST]", "<<s>s>", "a\nb", "", "[/INST][INST]</s>é\U0001f600"]
    texts += [a + b for a in texts for b in texts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = df.select("t", chat.escape(F.col("t")).alias("e"), chat.escape(F.col("t"), True).alias("o"))
    for r in df.select("*", chat.unescape(F.col("e")).alias("b"), chat.unescape(F.col("o")).alias("c")).collect():
        assert r.b == r.c == r.t and "\n" not in r.o
        assert not any(c in r.e for c in chat.CONTROLS), r


def test_report_reads_back_what_was_said(spark):
    said = [
        (1, 2, "assistant", "second <|im_end|>\nnext"),
        (1, 1, "user", "first\\"),
        (1, 1, "user", "first\\"),
        (2, None, "odd\nrole", None),
        (2, 1, None, ""),
        (None, 1, "assistant", "é\U0001f600"),
    ]
    schema = "conv_id long, turn long, role string, text string"
    got = {r.conv_id: r for r in chat.report(spark.createDataFrame(said, schema).withColumn("leaf", F.lit(1))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1].n_turns == 3 and got[1].turns_sha256 == sha("user\nfirst\\\nuser\nfirst\\\nassistant\nsecond <|im_end|>\nnext\n")
    assert (got[1].loss_chars, got[1].loss_sha256) == (22, sha("second <|im_end|>\nnext"))
    assert got[2].turns_sha256 == sha("odd\nrole\n\n\n\n") and got[2].loss_chars == 0 and got[2].loss_sha256 == sha("")
    assert got[None].loss_chars == 2
    assert chat.report(spark.createDataFrame([], schema)).count() == 0


def test_a_message_listed_twice_is_its_smallest_row_as_a_whole(spark):
    listed = [
        ("t", 1, None, "user", "one", 0.0),
        ("t", 3, None, "user", "three", 0.0),
        ("t", 2, 1, "z", "belongs to parent 1", 0.0),
        ("t", 2, 3, "a", "belongs to parent 3", 0.0),
        ("t", 4, 2, "q", "low", 1.0),
        ("t", 4, 2, "b", "high", 2.0),
    ]
    got = chat.formatted(spark.createDataFrame(listed, MESSAGES), keep=None).select("leaf", chat.parsed(F.col("formatted")).alias("turns"))
    said = {r.leaf: [(t.role, t.text) for t in r.turns] for r in got.collect()}
    assert said == {4: [("user", "one"), ("z", "belongs to parent 1"), ("q", "low")], 3: [("user", "three")]}
