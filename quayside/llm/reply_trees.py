"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees by their parents.  Self-joins that double their reach give
each message its ancestor 1, 2, 4, ... steps up; with these every leaf's path to
its root is enumerated, each message of it once, in as many joins as the depth
has binary digits.  Branches are ranked by score, and each chosen path becomes
one conversation: a formatted string, and the spans in it that bear loss.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``.  In texts and roles
each ``<`` that is followed by any number of backslashes and ``|`` gets one
backslash more, so no control string stands in a text, and :func:`unescaped`
gives back what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, ranked

# The strings that mark a turn, and the role whose texts bear loss.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_in(role: Column) -> Column:
    """A role on one line."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def chains(messages: DataFrame, tree: str, turn: str, role: str, text: str, scratch: Scratch) -> DataFrame:
    """Rows of plain conversations as reply trees of one branch: ``tree, node,
    parent, role, text, score``.

    Rows answer the row before them by ``turn``; of equal turns the order is that
    of role and text.  Null turns come first.  The numbered rows are written
    once; only their numbers are sorted, by ranges, so one conversation may hold
    any share of the rows.  A null tree is one conversation.
    """
    rows = scratch.keep(messages.select(
        F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("node", F.monotonically_increasing_id()))
    keys = rows.select(F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")).alias("of"), "turn", "role",
                       F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"), "node")
    places = scratch.keep(ranked(keys, ["turn", "role", "h1", "h2", "node"], scratch, within="of").select("of", "__rank", "node"))
    before = places.select("of", (F.col("__rank") + 1).alias("__rank"), F.col("node").alias("parent"))
    parents = places.join(before, ["of", "__rank"], "left").select("node", "parent")
    return scratch.keep(rows.join(parents, "node").select("tree", "node", "parent", "role", "text", F.lit(0.0).alias("score")))


def paths(messages: DataFrame, scratch: Scratch, branches: int | None = None) -> DataFrame:
    """Every root-to-leaf path, or the ``branches`` best of each tree: ``tree, path
    (its leaf), branch (rank from 1), branch_score, steps, node, up`` with a row
    per message, ``up`` steps above the leaf.

    A path's score is the mean of its messages' scores (null: 0); equal scores
    rank by leaf.  A message whose parent is not there is a root; messages in a
    cycle are in no path, as no root leads to them.
    """
    links = messages.select("tree", "node", "parent", F.coalesce(F.col("score"), F.lit(0.0)).alias("score"))
    heads = links.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    first = links.join(heads, "parent", "left").select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("to"), "score", F.lit(1).alias("steps"))
    # Only messages that are not yet at their root go on; the others are settled.
    state = scratch.keep(first)
    total, settled = state.count(), state.filter("to IS NULL")
    jumps = [state.filter("to IS NOT NULL")]
    while 1 << (len(jumps) - 1) <= total and not jumps[-1].isEmpty():
        far = jumps[-1]
        behind = settled.unionAll(far).select(F.col("node").alias("to"), F.col("to").alias("next"), F.col("score").alias("s"), F.col("steps").alias("n"))
        state = scratch.keep(far.join(behind, "to").select(
            "tree", "node", F.col("next").alias("to"), (F.col("score") + F.col("s")).alias("score"), (F.col("steps") + F.col("n")).alias("steps")))
        settled = settled.unionAll(state.filter("to IS NULL"))
        jumps.append(state.filter("to IS NOT NULL"))
    answered = links.select(F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = (settled.join(answered, "node", "left_anti")
              .select(F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("")).alias("of"), "tree", "node",
                      (F.col("score") / F.col("steps")).alias("branch_score"), "steps"))
    order = ranked(leaves.withColumn("below", -F.col("branch_score")), ["below", "node"], scratch, within="of")
    chosen = order.select("tree", F.col("node").alias("path"), (F.col("__rank") + 1).alias("branch"), "branch_score", "steps")
    chosen = scratch.keep(chosen if branches is None else chosen.filter(F.col("branch") <= branches))
    steps = chosen.select("path", F.col("path").alias("node"), F.lit(0).cast("long").alias("up"))
    for k in range(len(jumps) - 1, -1, -1):
        further = steps.join(jumps[k].select("node", "to"), "node").select("path", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        steps = scratch.keep(steps.unionAll(further))
    return steps.join(chosen, "path")


def format_paths(messages: DataFrame, branches: int | None = None, loss_role: str = LOSS_ROLE, scratch: Scratch | None = None) -> DataFrame:
    """One conversation per chosen path of reply trees ``messages`` (``tree, node,
    parent, role, text, score``; ``node`` unique): ``tree, path, branch,
    branch_score, formatted, turns``.

    ``turns`` has for each turn ``start``, ``text_start`` and ``text_length`` in
    code points of ``formatted``, and ``loss``: whether its text, and nothing
    else of the turn, is under the loss mask.  Null roles and texts are empty.
    An empty table gives an empty one; other columns are not read.  A path's
    string is one row, as it is one conversation; trees are never gathered.
    """
    scratch = scratch or Scratch(messages.sparkSession, "replies")
    role = _role_in(F.coalesce(F.col("role"), F.lit("")))
    text = escaped(F.coalesce(F.col("text"), F.lit("")))
    on_path = paths(messages, scratch, branches)
    turns = (on_path.join(messages.select("node", "role", "text"), "node")
             .select("tree", "path", "branch", "branch_score", (F.col("steps") - F.col("up")).alias("at"),
                     F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), text.alias("body"),
                     (F.coalesce(F.col("role"), F.lit("")) == loss_role).alias("loss")))
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(before), F.lit(0))).select(
        "tree", "path", "branch", "branch_score", F.struct(
            "at", F.concat("head", "body", F.lit(CLOSE)).alias("block"), "start", (F.col("start") + F.length("head")).alias("text_start"),
            F.length("body").cast("long").alias("text_length"), "loss").alias("turn"))
    whole = placed.groupBy("path").agg(*[F.first(c).alias(c) for c in ("tree", "branch", "branch_score")], F.sort_array(F.collect_list("turn")).alias("turns"))
    return whole.select("tree", "path", "branch", "branch_score", F.array_join("turns.block", "").alias("formatted"),
                        F.transform("turns", lambda t: F.struct(*[t[c].alias(c) for c in ("start", "text_start", "text_length", "loss")])).alias("turns"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of ``role, text``."""
    def turn(block: Column) -> Column:
        line = F.substring_index(block, "\n", 1)
        body = F.substring(block, F.length(line) + 2, F.length(block) - F.length(line) - F.lit(1 + len(CLOSE)))
        return F.struct(_role_out(F.substring(line, F.lit(len(OPEN) + 1), F.length(line))).alias("role"), unescaped(body).alias("text"))

    return F.transform(blocks_of(formatted), turn)


def blocks_of(formatted: Column) -> Column:
    """A formatted conversation's turns as they are written: none for no turns."""
    return F.filter(F.split(formatted, r"(?=<\|im_start\|>)"), lambda b: b != "")


def under_loss(formatted: Column, turns: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    marked = F.filter(F.arrays_zip(blocks_of(formatted).alias("block"), turns.alias("turn")), lambda x: x["turn"]["loss"])
    return F.transform(marked, lambda x: unescaped(F.substring(
        x["block"], (x["turn"]["text_start"] - x["turn"]["start"] + 1).cast("int"), x["turn"]["text_length"].cast("int"))))
