"""Chat formatting of reply trees.

Messages name their parent. Scores are summed from the root down and every leaf's path is ranked within its tree; the
best branches are walked from leaf to root. Both use pointer doubling: each round joins the messages to themselves
and doubles the distance covered, so a conversation of a thousand turns takes ten rounds. Only keys and numbers are
joined; texts meet their path once, at the end.

A turn is written as ``<|im_start|>role``, a line break, its text, ``<|im_end|>`` and a line break. In texts and
roles a backslash, ``<``, ``[`` and, in roles, a line break are written as a backslash and a digit, so no control
string of this or another common template can come from a text, and reading back restores every character.

Defined cases: a null text or role is empty. A message whose parent is missing is a root. Messages in a circle of
parents have no root and are left out of paths. Rows without a conversation id form a conversation with id null.
Rows that tie in turn are ordered by role, then text. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.words import same, stored

# The template and its escapes.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ESCAPES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "\\3"))
LOSS_ROLE = "assistant"


def escaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def chains(conversations: DataFrame) -> DataFrame:
    """Rows of conversations as messages: each replies to the one before in turn order.

    Gives ``tree, node, parent, score, role, text``; node numbers count from 0 within a tree.
    """
    rows = conversations.select(
        F.col("conv_id").alias("tree"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    nth = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    rows = rows.withColumn("node", (nth - 1).cast("bigint"))
    return rows.select("tree", "node", F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def _self_join(left: DataFrame, right: DataFrame, at: str, how: str = "left") -> DataFrame:
    """``left`` with the columns of the message that its column ``at`` names."""
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    return left.join(right, left["tree"].eqNullSafe(right["r_tree"]) & (left[at] == right["r_node"]), how)


def _jumps(messages: DataFrame) -> list[DataFrame]:
    """Tables of ``tree, node, up, sum``: ``up`` is 1, 2, 4, ... messages above, null beyond the root.

    The last table has no ``up`` but for messages in circles; ``sum`` adds the scores from the message to its root.
    """
    links = messages.select("tree", "node", "parent", "score")
    step = _self_join(links, links.select("tree", "node"), "parent")
    step = stored(step.select("tree", "node", F.col("r_node").alias("up"), F.col("score").alias("sum")), "replies")
    tables, n = [step], messages.count()
    while step.where("up is not null").limit(1).count() and 2 ** (len(tables) - 1) <= n:
        # Messages that have reached their root are done; only the others go on.
        far = _self_join(step.where("up is not null"), step, "up", "inner")
        far = far.select("tree", "node", F.col("r_up").alias("up"), (F.col("sum") + F.col("r_sum")).alias("sum"))
        step = stored(step.where("up is null").unionByName(far), "replies")
        tables.append(step)
    return tables


def best_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """Best root-to-leaf paths: ``tree, leaf, branch, depth, node``; depth counts from the leaf, 0, up.

    A branch scores the mean of its messages; ties go to the smaller leaf. ``branches=None`` keeps all.
    """
    tables = _jumps(messages)
    circles = tables[-1].where("up is not null").select("tree", "node")
    parents = tables[0].where("up is not null").select("tree", F.col("up").alias("node")).distinct()
    last = tables[-1].select("tree", "node", "sum")
    leaves = last.join(parents, same(last, parents, "tree", "node"), "left_anti")
    leaves = leaves.join(circles, same(leaves, circles, "tree", "node"), "left_anti")

    order = Window.partitionBy("tree").orderBy(F.desc(F.col("sum") / (F.col("depth") + 1)), "node")
    ranked = _depths(leaves, tables).withColumn("branch", F.row_number().over(order))
    ranked = stored(ranked if branches is None else ranked.where(F.col("branch") <= branches), "branches")
    paths = ranked.select("tree", F.col("node").alias("leaf"), "branch", F.lit(0).cast("bigint").alias("depth"), "node")
    for n, table in enumerate(tables):
        far = _self_join(paths, table.select("tree", "node", "up").where("up is not null"), "node", "inner")
        far = far.select("tree", "leaf", "branch", (F.col("depth") + 2**n).alias("depth"), F.col("r_up").alias("node"))
        paths = stored(paths.unionByName(far), "paths")
    return paths


def _depths(leaves: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Leaves with ``depth``, their distance from the root: the largest jumps that fit, added up."""
    own = leaves.select("tree", "node", "sum", F.col("node").alias("at"), F.lit(0).cast("bigint").alias("depth"))
    for n in range(len(tables) - 1, -1, -1):
        far = _self_join(own, tables[n].select("tree", "node", "up"), "at")
        own = far.select("tree", "node", "sum", F.coalesce("r_up", "at").alias("at"), (F.col("depth") + F.when(F.col("r_up").isNotNull(), 2**n).otherwise(0)).alias("depth"))
    return own


def format_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """One row per chosen path: ``tree, branch, formatted``, and ``loss``, the spans of assistant texts in it.

    Spans are ``start, stop`` in code points of ``formatted``.
    """
    paths = best_paths(messages, branches)
    texts = messages.select("tree", "node", "role", "text")
    rows = _self_join(paths, texts, "node")
    head = F.concat(F.lit(OPEN), escaped(F.coalesce("r_role", F.lit("")), ROLE_ESCAPES), F.lit("\n"))
    body = escaped(F.coalesce("r_text", F.lit("")))
    turn = F.struct((-F.col("depth")).alias("at"), F.concat(head, body, F.lit(CLOSE)).alias("turn"), F.length(head).alias("head"), F.length(body).alias("body"), (F.col("r_role") == LOSS_ROLE).alias("loss"))
    turns = rows.groupBy("tree", "leaf", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(acc, t):
        first = acc["at"] + t["head"]
        out = F.when(t["loss"], F.concat(acc["out"], F.array(F.struct(first.alias("start"), (first + t["body"]).alias("stop"))))).otherwise(acc["out"])
        return F.struct((acc["at"] + F.length(t["turn"])).alias("at"), out.alias("out"))

    loss = F.aggregate("turns", start, step, lambda acc: acc["out"])
    return turns.select("tree", "branch", F.array_join(F.col("turns.turn"), "").alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """``role`` and ``text`` of each turn of a formatted conversation."""
    turns = F.filter(F.split(formatted, F.lit(r"<\|im_end\|>\n"), -1), lambda t: t != "")
    bare = lambda t: F.substring(t, len(OPEN) + 1, 1 << 30)
    pair = lambda t: F.struct(
        unescaped(F.substring_index(t, "\n", 1), ROLE_ESCAPES).alias("role"), unescaped(F.substr(t, F.instr(t, "\n") + 1)).alias("text")
    )
    return F.transform(F.transform(turns, bare), pair)


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, in order, nothing between."""
    parts = F.transform(loss, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int")))
    return F.array_join(F.transform(parts, lambda t: unescaped(t)), "")
