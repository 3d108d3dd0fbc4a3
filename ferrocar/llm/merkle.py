"""A Merkle manifest of a table of documents, by time-forward processing.

Every row is a leaf: the SHA-256 of its fields, each written as ``-`` when null, else as its UTF-8 byte
count, ``:`` and its text. Within a source the leaves stand in the order of their doc_id; every run of
``FAN`` neighbours becomes the hash of their digests (the last run may be shorter, even one), level
by level, until one node is left: the source's subroot. The subroots, in the order of their source
(null first, then bytewise), make the root tree in the same way.

Time-forward processing sends each node's digest forward to the node with the next label that needs
it, its parent. Labels are (source, level, position); the external priority queue ordered by label
is the shuffle sorted by the parent's label, so a level is one grouping of at most ``FAN`` rows a
parent, and nothing larger ever meets in one place. The reversed sweep then goes from the root down:
a parent hands each child the digests of its siblings before and after it, followed by its own proof,
so that every leaf ends with the siblings of all its ancestors, leaf to root.

Positions in a source come from one range sort of all rows, counted per task and source and summed
over the tasks before: a source with a third of all rows is spread over many tasks. Each level and
each sweep step is written to the shared folder, so a lost executor costs one level at most.

Edge cases: null fields are ``-``; empty texts are ``0:``; very long texts are hashed whole; rows that
repeat are leaves each, in any order among themselves (they have equal digests); rows with a null
doc_id stand first in their source and are never tampered; other columns of the input are ignored;
an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrocar.session import stage

FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The leaf digest of one row."""
    return F.sha2(F.concat(*(_field(c) for c in (doc_id, source, lang, n_chars, text))), 256)


def tampered(doc_id: Column) -> Column:
    """Whether a row is tampered with: 2 divides the unsigned crc32 of its decimal doc_id (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def _group_key(source: Column) -> Column:
    # Null first, then the sources bytewise: "" sorts before every "+" + source.
    return F.coalesce(F.concat(F.lit("+"), source), F.lit(""))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``pos`` (from 0) and ``n`` (the group's size) within groups ``g`` in ``order``.

    One range sort of all rows (ties spread by a row number, so equal keys need not meet); rows are
    counted per task and group, and each group's counts of earlier tasks are summed up.
    """
    keys = ["g", *order]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "_tie")
    ranged = ranged.sortWithinPartitions(*keys, "_tie").drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    staged = stage(ranged.withColumn("_part", F.col("_at").bitwiseAND(F.lit(-(1 << 33)))), "merkle-sorted")
    counts = staged.groupBy("g", "_part").agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    before = Window.partitionBy("g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "g",
        "_part",
        "_first",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"),
        F.sum("_c").over(Window.partitionBy("g")).alias("n"),
    )
    out = staged.join(counts, ["g", "_part"])
    return out.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def fold(nodes: DataFrame) -> list[DataFrame]:
    """The levels of the trees over (g, pos, n, digest): level 0 is ``nodes``, each next one the parents.

    A parent is (g, pos // FAN) with the sorted digests of its children ``kids``; only groups with
    more than one node at a level go up. The node with n = 1 is its group's top.
    """
    levels = [stage(nodes.select("g", "pos", "n", "digest"), "merkle-level")]
    top = levels[0].agg(F.max("n")).first()[0] or 1
    width = 1
    while width < top:
        width *= FAN
        below = levels[-1].where("n > 1")
        up = below.groupBy("g", F.floor(F.col("pos") / FAN).alias("pos")).agg(
            F.first("n").alias("n_below"), F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("kids")
        )
        up = up.select(
            "g",
            "pos",
            F.ceil(F.col("n_below") / FAN).alias("n"),
            F.sha2(F.array_join(F.col("kids.digest"), ""), 256).alias("digest"),
            F.col("kids.digest").alias("kids"),
        )
        levels.append(stage(up, "merkle-level"))
    return levels


def sweep(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(g, pos, proof) of level 0: proofs from the tops (g, proof) down through ``levels``."""
    empty = F.array().cast("array<struct<left:string,right:string>>")
    proofs = None
    for at in range(len(levels) - 1, -1, -1):
        here = levels[at]
        start = here.where("n = 1").join(tops, "g").select("g", "pos", F.coalesce("proof", empty).alias("proof"))
        proofs = start if proofs is None else start.unionByName(proofs)
        if at:
            parents = here.join(proofs, ["g", "pos"]).select("g", "pos", "kids", "proof")
            proofs = stage(_handed_down(parents), "merkle-proofs")
    return proofs


def _handed_down(parents: DataFrame) -> DataFrame:
    """(g, pos, proof) of the children of (g, pos, kids, proof): siblings before and after, then the parent's proof."""
    one = parents.select("g", "pos", "proof", "kids", F.posexplode("kids").alias("i", "digest"))
    step = F.array(
        F.struct(
            F.expr("array_join(slice(kids, 1, i), '')").alias("left"),
            F.expr(f"array_join(slice(kids, i + 2, {FAN}), '')").alias("right"),
        )
    )
    return one.select("g", (F.col("pos") * FAN + F.col("i")).alias("pos"), F.concat(step, "proof").alias("proof"))


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, source, leaf, subroot, root, proof, proof_sha256, folded_root, verified.

    ``proof`` lists (left, right) sibling digests level by level from the leaf to the root;
    ``folded_root`` hashes the tampered leaf (``tampered``: text without its line feeds) with them.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        leaf(*(F.col(c) for c in FIELDS)).alias("digest"),
        F.when(
            tampered(F.col("doc_id")),
            leaf(*(F.col(c) for c in FIELDS[:4]), F.translate(F.col("text").cast("string"), "\n", "")),
        ).alias("changed"),
    ).withColumn("g", _group_key(F.col("source")))
    leaves = numbered(rows, ["doc_id", "digest"])
    trees = fold(leaves)
    tops = trees[0].where("n = 1").select("g", "digest")
    for level in trees[1:]:
        tops = tops.unionByName(level.where("n = 1").select("g", "digest"))
    tops = stage(tops, "merkle-subroots")
    # The root tree: one group, its leaves the subroots in the order of their sources.
    outer = numbered(tops.select(F.col("g").alias("source_key"), "digest").withColumn("g", F.lit("")), ["source_key"])
    root_levels = fold(outer)
    # One digest: the only value that reaches the driver.
    root = root_levels[-1].where("n = 1").first()
    at_top = sweep(root_levels, root_levels[-1].where("n = 1").select("g", F.lit(None).alias("proof")))
    handed = at_top.join(outer.select("pos", "source_key"), "pos").select(F.col("source_key").alias("g"), "proof")
    proofs = sweep(trees, handed)
    out = leaves.join(proofs, ["g", "pos"]).join(tops.withColumnRenamed("digest", "subroot"), "g")
    out = out.withColumn("root", F.lit(root.digest if root else None).cast("string"))
    folded = F.aggregate("proof", F.coalesce("changed", "digest"), lambda acc, x: F.sha2(F.concat(x.left, acc, x.right), 256))
    return out.select(
        "doc_id",
        "source",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "proof",
        F.sha2(F.array_join(F.transform("proof", lambda x: F.concat(x.left, x.right)), ""), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
