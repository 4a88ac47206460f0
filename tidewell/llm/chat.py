"""Chat formatting over reply trees; DataFrame functions only.

``branches`` enumerates root-to-leaf paths with iterative self-joins: a table of jumps (a message and its ancestor
1, 2, 4, ... levels up) is joined with itself, and the paths known so far are joined with it, so a tree of depth d
takes about log2(d) rounds and every path is held as rows of ids, never as one growing cell.  Branches are ranked per tree by
the sum of their messages' scores (null: 0), ties to the smaller leaf; with ``keep`` the ranking is cut per task before
it is shuffled.  ``formatted`` renders each chosen path as one conversation.

The template marks turns with control strings.  Inside roles and texts a backslash and the first character of every
control string are written as two-character escapes, so no control string of a text survives and unescaping is exact.

Null texts and roles are empty.  A message whose parent is missing is a root; messages that hang on a cycle have no
path and are left out; a message listed twice counts once (the smaller row).  Empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import durable

HEAD, ROLE_END, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"
# Control strings of common chat templates.
CONTROLS = [
    "<|im_start|>",
    "<|im_end|>",
    "<|endoftext|>",
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
]
ESCAPES = {"<": "\\l", "[": "\\k", "\n": "\\e", "\\": "\\s"}  # what is written for a character
LEARNED_ROLES = ("assistant",)


def escape(text: Column, one_line: bool = False) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit(ESCAPES["\\"]))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(ESCAPES[control[0]] + control[1:]))
    return F.replace(text, F.lit("\n"), F.lit(ESCAPES["\n"])) if one_line else text


def unescape(text: Column) -> Column:
    """The backslash comes last: before that, every backslash starts an escape."""
    return reduce(lambda t, c: F.replace(t, F.lit(ESCAPES[c]), F.lit(c)), ["<", "[", "\n", "\\"], text)


def _same(left: str, right: str, *pairs: tuple[str, str]) -> Column:
    keys = [F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree"))]
    keys += [F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in pairs]
    return reduce(lambda x, y: x & y, keys)


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """``tree, leaf, node, left`` (levels down to the leaf) of the paths of ``tree, node, parent, score``.

    ``keep`` leaves the best-scored branches of each tree.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = nodes.filter("node is not null").groupBy("tree", "node")
    nodes = nodes.agg(F.min(F.struct("parent", "score")).alias("m")).select("tree", "node", "m.*")
    nodes = durable(nodes, "nodes")
    known = nodes.select("tree", "node")
    jumps = nodes.filter("parent is not null").select("tree", "node", F.col("parent").alias("up"))
    jumps = durable(
        jumps.alias("j").join(known.alias("n"), _same("j", "n", ("up", "node")), "left_semi").filter("node <> up"),
        "jumps",
    )
    parents = jumps.select("tree", F.col("up").alias("node"))
    leaves = known.alias("n").join(parents.alias("p"), _same("n", "p", ("node", "node")), "left_anti")
    paths = [durable(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("left")), "paths")]
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    step, cyclic = 1, None
    while not jumps.isEmpty():
        if step > most:  # an ancestor this far up can only lie on a cycle
            cyclic = jumps.select("tree", F.col("node").alias("leaf"))
            break
        so_far = reduce(DataFrame.unionAll, paths)
        longer = so_far.alias("p").join(jumps.alias("j"), _same("p", "j", ("node", "node")))
        longer = longer.select(
            F.col("p.tree").alias("tree"), "leaf", F.col("up").alias("node"), (F.col("left") + step).alias("left")
        )
        paths.append(durable(longer, "paths"))
        doubled = jumps.alias("a").join(jumps.alias("b"), _same("a", "b", ("up", "node")))
        jumps = durable(
            doubled.select(F.col("a.tree").alias("tree"), F.col("a.node").alias("node"), F.col("b.up").alias("up")), "jumps"
        )
        step *= 2
    found = reduce(DataFrame.unionAll, paths)
    if cyclic is not None:
        found = found.alias("p").join(cyclic.alias("c"), _same("p", "c", ("leaf", "leaf")), "left_anti")
    if keep is None:
        return found
    scored = found.alias("p").join(nodes.alias("n"), _same("p", "n", ("node", "node"))).select("p.*", "n.score")
    totals = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
    best = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)
    return found.alias("p").join(best.alias("b"), _same("p", "b", ("leaf", "leaf")), "left_semi")


def formatted(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """One row per chosen path: ``tree, leaf, formatted, loss`` (code point spans of the learned texts)."""
    score = F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    # the whole smallest row of a message listed twice: ``branches`` takes the parent and score of the same one
    texts = messages.filter("node is not null").groupBy("tree", "node").agg(F.min(F.struct("parent", score, role, text)).alias("m"))
    paths = branches(messages, keep)
    rows = paths.alias("p").join(texts.alias("t"), _same("p", "t", ("node", "node"))).select("p.*", "m.role", "m.text")
    rows = rows.withColumn("body", escape(F.col("text"))).withColumn(
        "head", F.concat(F.lit(HEAD), escape(F.col("role"), True), F.lit(ROLE_END))
    )
    rows = rows.withColumn("turn", F.concat("head", "body", F.lit(TAIL)))
    ahead = Window.partitionBy("tree", "leaf").orderBy(F.col("left").desc()).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(ahead), F.lit(0)) + F.length("head")
    rows = rows.withColumn("start", start.cast("int"))
    span = F.struct(F.col("start").alias("start"), (F.col("start") + F.length("body")).alias("end"))
    turns = F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("at"), "turn")))
    return rows.groupBy("tree", "leaf").agg(
        F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role").isin(*LEARNED_ROLES), span))).alias("loss"),
    )


def parsed(text: Column) -> Column:
    """Turns read back from a formatted conversation: an array of ``(role, text)``."""
    turns = F.split(text, r"<\|im_end\|>\n", -1)
    turns = F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))
    bare = F.transform(turns, lambda t: F.substring(t, F.lit(len(HEAD) + 1), F.length(t)))

    def fields(t):
        role = F.substring_index(t, "\n", 1)
        return F.struct(
            unescape(role).alias("role"), unescape(F.substring(t, F.length(role) + 2, F.length(t))).alias("text")
        )

    return F.transform(bare, fields)


def chains(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each message replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(
        F.col("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def report(conversations: DataFrame) -> DataFrame:
    """Counts and digests read back from the formatted conversations."""
    done = formatted(chains(conversations))
    turns = F.col("turns")
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(
        F.transform(
            F.col("loss"),
            lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])),
        ),
        "",
    )
    rows = done.withColumn("turns", parsed(F.col("formatted"))).withColumn("learned", learned)
    return rows.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
