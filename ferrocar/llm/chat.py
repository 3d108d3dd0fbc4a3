"""Chat formatting of reply trees, with DataFrame operations only.

A tree's root-to-leaf paths are enumerated by iterative self-joins that double the distance to an
ancestor each time: first every message's ancestors at distances 1, 2, 4, ..., then, from the largest
distance down, all ancestors of every leaf. Branches are ranked by score, and each chosen path is
formatted as one conversation.

In the format every turn stands between marks of its role. Control strings within texts are made
harmless by a backslash after their first character, and backslashes are doubled, which is undone
when texts are read back. The loss mask is a list of spans of the formatted text: those of the
assistant's texts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrocar.session import stage

# The marks around a turn by role; other roles are named in theirs.
MARKS = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n\n"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s> ", " </s>"),
}
OTHER = ("[ROLE] ", " [/ROLE] ", " [/TURN]")
# All control strings, as a regular expression; none of them can overlap another.
CONTROL = r"(<|\[)(/?s>|</?SYS>>|/?INST\]|/?ROLE\]|/?TURN\])"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    """A text without control strings from which :func:`unescape` gives it back."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _marks(role: Column) -> tuple[Column, Column]:
    """What stands before and after a turn's text."""
    before, after = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for name, (start, end) in MARKS.items():
        before, after = F.when(role == name, F.lit(start)).otherwise(before), F.when(role == name, F.lit(end)).otherwise(after)
    return before, after


def leaf_paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, depth): the messages on each root-to-leaf path, depth 0 at the root.

    ``messages`` has tree, node and parent, each node once. A node whose parent is null or unknown is
    a root. Messages on a cycle are on no path, since no leaf is reached from them.
    """
    nodes = stage(messages.select("tree", "node", "parent"), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"))
    hops = [stage(nodes.join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up")), "hops")]
    limit = nodes.count()
    while 1 << len(hops) <= limit:
        last = hops[-1]
        further = last.join(last.select("tree", F.col("node").alias("up"), F.col("up").alias("top")), ["tree", "up"])
        further = stage(further.select("tree", "node", F.col("top").alias("up")), "hops")
        if further.isEmpty():
            break
        hops.append(further)
    leaves = nodes.join(hops[0].select("tree", F.col("up").alias("node")).distinct(), ["tree", "node"], "left_anti")
    found = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height"))
    for k in reversed(range(len(hops))):
        higher = found.join(hops[k], ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("height") + (1 << k)).alias("height"))
        found = stage(found.union(higher), "paths")
    length = found.groupBy("tree", "leaf").agg(F.max("height").alias("top"))
    return found.join(length, ["tree", "leaf"]).select("tree", "leaf", "node", (F.col("top") - F.col("height")).alias("depth"))


def conversations(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss_spans) for the chosen paths of each tree.

    ``messages`` has tree, node, parent, role, text and score, each node of a tree once. A path's score
    is the mean over its messages, null scores counting as zero; ties go to the smaller leaf. ``best``
    keeps so many paths of a tree, all if it is not given. Null roles and texts are empty. Rows with a
    null tree or node are left out; other columns are ignored. ``loss_spans`` holds (start, length) of
    the escaped texts of role ``LEARNT``, in code points.
    """
    rows = messages.where("tree IS NOT NULL AND node IS NOT NULL").select(
        "tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
    rows = stage(rows, "messages")
    paths = leaf_paths(rows)
    if best is not None:
        scores = paths.join(rows.select("tree", "node", "score"), ["tree", "node"]).groupBy("tree", "leaf").agg(F.avg("score").alias("score"))
        place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
        chosen = scores.withColumn("rank", place).where(F.col("rank") <= best).select("tree", "leaf", "rank")
        paths = paths.join(chosen, ["tree", "leaf"])
    else:
        paths = paths.withColumn("rank", F.lit(None).cast("int"))
    before, after = _marks(F.col("role"))
    turns = paths.join(rows, ["tree", "node"]).withColumn("body", escape(F.col("text")))
    turns = turns.select("tree", "leaf", "rank", "depth", "role", before.alias("open"), "body", after.alias("close"))
    along = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    length = F.char_length("open") + F.char_length("body") + F.char_length("close")
    start = F.coalesce(F.sum(length.cast("long")).over(along), F.lit(0)) + F.char_length("open")
    span = F.when(F.col("role") == LEARNT, F.struct(start.alias("start"), F.char_length("body").cast("long").alias("length")))
    turns = turns.select("tree", "leaf", "rank", F.struct("depth", F.concat("open", "body", "close").alias("turn"), span.alias("span")).alias("at"))
    met = turns.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list("at")).alias("turns"))
    return met.select(
        "tree",
        "leaf",
        "rank",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def learnt_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(pieces, "")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    names = F.expr("map(" + ", ".join(f"'{start[:6]}', '{role}'" for role, (start, _) in MARKS.items()) + ")")
    closes = "|".join(_quoted(end) for _, end in [*MARKS.values(), ("", OTHER[2])])
    opens = "|".join(_quoted(start) for start, _ in [*MARKS.values(), (OTHER[0], "")])
    turns = F.regexp_extract_all(formatted, F.lit(f"(?s)((?:{opens}).*?(?:{closes}))"), F.lit(1))
    split = F.lit(f"(?s)^(?:{opens})(.*)(?:{closes})$")

    def turn(t: Column) -> Column:
        inner = F.regexp_extract(t, split, 1) if isinstance(split, str) else F.call_function("regexp_extract", t, split, F.lit(1))
        named = t.startswith(F.lit(OTHER[0]))
        role = F.when(named, unescape(F.substring_index(inner, OTHER[1], 1))).otherwise(F.coalesce(F.try_element_at(names, F.substring(t, 1, 6)), F.try_element_at(names, F.substring(t, 1, 4))))
        text = F.when(named, F.expr("null")).otherwise(inner)
        rest = F.call_function("substring", inner, F.char_length(F.substring_index(inner, OTHER[1], 1)) + len(OTHER[1]) + 1)
        return F.struct(role.alias("role"), unescape(F.coalesce(text, rest)).alias("text"))

    return F.transform(turns, turn)


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in "[]<>/" else "\\n" if c == "\n" else c for c in text)


def chains(rows: DataFrame) -> DataFrame:
    """Messages of conversations whose rows follow one another: (conv_id, turn, role, text) as reply trees.

    Rows are ordered by turn, then role and text, nulls first. They are numbered by a range sort over all
    conversations, so a very long one is spread over tasks; each row's parent is the row before it.
    """
    order = ["conv_id", "turn", "role", "text"]
    placed = stage(rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per task of the sort: a running sum over those.
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    numbered = placed.withColumn("part", part).join(before, "part").withColumn("node", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1))
    first = numbered.groupBy("conv_id").agg(F.min("node").alias("first"))
    whole = numbered.join(first.withColumnRenamed("conv_id", "__conv"), F.col("conv_id").eqNullSafe(F.col("__conv")))
    parent = F.when(F.col("node") > F.col("first"), F.col("node") - 1)
    return whole.select("conv_id", F.col("first").alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def digests(rows: DataFrame) -> DataFrame:
    """What each conversation's formatted text says when it is read back.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): turns' digest over role,
    newline, text, newline; the code points and the digest of all text under the loss mask. A null
    conv_id is a conversation of its own; repeated rows are turns of their own.
    """
    messages = stage(chains(rows), "chains")
    ids = messages.where("node = tree").select("conv_id", "tree")
    said = conversations(messages).join(ids, "tree")
    said = said.withColumn("turns", read_back(F.col("formatted"))).withColumn("learnt", learnt_text(F.col("formatted"), F.col("loss_spans")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return said.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
