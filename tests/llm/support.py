"""Documents with the awkward cases every operator has to take."""

import random

WORDS = "the of and river stone light wind over under house tree bird small large quick song red blue four five".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def lined(seed: int, n: int) -> str:
    words = prose(seed, n).split()
    return "\n".join(" ".join(words[i : i + 9]) for i in range(0, n, 9))


def awkward_rows():
    """``(doc_id, text, lang, source, n_chars)``: nulls, empty, blank, long, repeated and near-equal texts."""
    base = lined(1, 120)
    rows = [
        (1, base, "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t \n", "en", "b", 5),
        (5, base, "en", "b", 1),
        (6, base.replace("river", "stream", 1), "fr", "c", 1),
        (7, lined(2, 20_000), "en", "a", 1),
        (8, "one", "de", "a", 3),
        (9, "Üñí 漢字 \U0001f600 ﬁ x y", "de", "a", 3),
        (10, lined(3, 40) + "\n" + "\n".join(base.split("\n")[3:8]), "en", "a", 1),
        (None, "no id here at all " + prose(9, 30), "en", "a", 1),
        (11, lined(4, 60), "en", "d", 1),
        (11, lined(4, 60), "en", "d", 1),
        (12, "x " * 50, "en", "d", 1),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["score", "fp", "kept", "p", "ids", "__key", "stats", "rank"]


def documents(spark, rows=None, clashing=False):
    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    if clashing:  # columns under names the operators use themselves
        for name in EXTRA:
            df = df.selectExpr("*", f"'kept' AS `{name}`")
    return df


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_with_clashes(spark, report):
    """``report`` gives the same rows whatever other columns the documents have, and none for no documents."""
    plain = sorted_rows(report(documents(spark)))
    assert sorted_rows(report(documents(spark, clashing=True))) == plain
    assert sorted_rows(report(documents(spark, rows=[]))) == []
    return plain
