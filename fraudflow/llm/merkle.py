"""Merkle manifest of a dataset (dealt operator 13): nested-interval labels, DataFrame functions only.

Leaves are ranked within their source by a distributed sort.  A node carries
the interval [lo, hi) of leaf ranks that it covers, so a node's ancestors are
those whose intervals contain its own, and its siblings are what its parent's
interval holds besides.  Levels are filed in bands of five: a bucket of a
band is a subtree of 243 nodes at most, kept as one row.  Subtrees meet their
ancestors in joins on (tree, band, bucket) that test containment, one join a
band, so a tree of n leaves takes log3(n) / 5 joins over n / 243 rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .quality import let
from .store import stored

ARITY = 3
BAND = 5  # levels of a band
WIDTH = ARITY ** BAND


def field(value: Column) -> Column:
    """A value as UTF-8 byte count, colon, text; null is a minus sign."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    return digest(*map(field, values))


def fold(start: Column, path: Column) -> Column:
    """The root that follows from a node's digest and the siblings on its path."""
    return F.aggregate(path, start, lambda h, s: digest(s["left"], h, s["right"]))


def siblings(path: Column) -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(nodes: Column) -> Column:
    """The next level: runs of three become one node over their joint interval."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY))
    return F.transform(runs, lambda i: let(F.slice(nodes, (i * ARITY + 1).cast("int"), ARITY), lambda run: F.struct(
        F.element_at(run, 1)["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
        digest(F.array_join(F.transform(run, lambda x: x["digest"]), "")).alias("digest"))))


def _step(nodes: Column, node: Column, span: int) -> Column:
    """What the parent of ``node`` covers besides it, left and right; a parent's interval has ``span`` ranks."""
    run = F.slice(nodes, (F.floor((node["lo"] - F.element_at(nodes, 1)["lo"]) / span) * ARITY + 1).cast("int"), ARITY)
    say = lambda xs: F.array_join(F.transform(xs, lambda x: x["digest"]), "")
    return let(run, lambda r: F.struct(say(F.filter(r, lambda x: x["hi"] <= node["lo"])).alias("left"),
                                       say(F.filter(r, lambda x: x["lo"] >= node["hi"])).alias("right")))


def _level_step(j: int, unit: int) -> Column:
    """The step from a subtree's level j, of ``unit`` ranks a node, for the leaf at place ``at``; null if the tree ends below."""
    own = F.element_at(f"l{j}", (F.floor(F.col("at") / ARITY ** j) + 1).cast("int"))
    return F.when(F.col("n") > unit, let(own, lambda node: _step(F.col(f"l{j}"), node, unit * ARITY)))


def subtrees(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Bands of subtrees over nodes (tree, n, lo, digest, payload), n being the tree's leaves; each band is stored.

    A row: tree, n, bucket, lo, hi, payloads, l0 (its nodes) to l5 (its top).
    While a tree has several nodes, each run of three in a row becomes one;
    the last run may be shorter, down to one node.
    """
    bands = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while not bands or most > WIDTH ** len(bands):
        b = len(bands)
        unit = WIDTH ** b  # ranks of a node at the bottom of this band
        node = F.struct("lo", F.least(F.col("lo") + unit, F.col("n")).alias("hi"), "digest", "payload")
        s = (nodes.groupBy("tree", "n", F.floor(F.col("lo") / (unit * WIDTH)).alias("bucket"))
             .agg(F.sort_array(F.collect_list(node)).alias("all")))
        s = s.select("tree", "n", "bucket", F.element_at("all", 1)["lo"].alias("lo"), F.element_at("all", -1)["hi"].alias("hi"),
                     F.transform("all", lambda x: x["payload"]).alias("payloads"),
                     F.transform("all", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"))).alias("l0"))
        for j in range(1, BAND + 1):
            below = F.col(f"l{j - 1}")
            s = s.withColumn(f"l{j}", F.when(F.col("n") > unit * ARITY ** (j - 1), _parents(below)).otherwise(below))
        bands.append(stored(s, f"{name}-band-{b}"))
        nodes = bands[b].where(F.col("n") > unit * WIDTH).select(
            "tree", "n", "lo", F.element_at(f"l{BAND}", 1)["digest"].alias("digest"), F.lit(None).cast("string").alias("payload"))
    return bands


def _finished(bands: list[DataFrame], b: int) -> DataFrame:
    """Rows of a band that hold the root of their tree."""
    return bands[b].where(F.col("n") <= WIDTH ** (b + 1))


def roots(bands: list[DataFrame]) -> DataFrame:
    """tree, n, digest of every tree's root."""
    out = None
    for b in range(len(bands)):
        part = _finished(bands, b).select("tree", "n", F.element_at(f"l{BAND}", 1)["digest"].alias("digest"))
        out = part if out is None else out.union(part)
    return out


def interval_nodes(bands: list[DataFrame]) -> DataFrame:
    """The manifest as a table of labelled nodes: tree, level, lo, hi, digest."""
    out = None
    for b, band in enumerate(bands):
        for j in range(BAND + 1):
            level = b * BAND + j
            exists = F.lit(True) if level == 0 else F.col("n") > ARITY ** (level - 1)
            if j == BAND:  # a taller tree has this level in the next band
                exists = exists & (F.col("n") <= WIDTH ** (b + 1))
            part = band.where(exists).select("tree", F.lit(level).alias("level"), F.explode(f"l{j}").alias("x")).select("tree", "level", "x.*")
            out = part if out is None else out.union(part)
    return out


def paths(bands: list[DataFrame], above: DataFrame) -> DataFrame:
    """tree, lo, digest, payload, path and top of every leaf.

    ``above``: tree, path, top; the path goes on from the tree's root.  Each
    band's subtrees are joined to the node of the band above that contains
    them, and pass its path on.
    """
    found = None
    for b in range(len(bands) - 1, -1, -1):
        unit = WIDTH ** b
        rows = _finished(bands, b).join(above, "tree")
        if found is not None:
            inner = bands[b].where(F.col("n") > unit * WIDTH).alias("s")
            held = ((F.col("s.tree") == F.col("p.tree")) & (F.col("s.bucket") == F.col("p.bucket"))
                    & (F.col("p.lo") <= F.col("s.lo")) & (F.col("s.hi") <= F.col("p.hi")))
            rows = rows.unionByName(inner.join(found.alias("p"), held).select("s.*", "p.path", "p.top"))
        each = rows.select("*", F.posexplode("l0").alias("at", "x"))
        path_of = [_level_step(j, unit * ARITY ** j) for j in range(BAND)]
        path = F.concat(F.filter(F.array(*path_of), lambda s: s.isNotNull()), "path")
        found = each.select("tree", F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"), F.col("x.digest").alias("digest"),
                            F.floor(F.col("x.lo") / unit).alias("bucket"), F.get("payloads", F.col("at")).alias("payload"), path.alias("path"), "top")
        if b:
            found = stored(found.select("tree", "bucket", "lo", "hi", "path", "top"), "merkle-paths")
    return found


def manifest(docs: DataFrame, values: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
             source_col: str = "source", carry: dict[str, Column] | None = None) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The sources' bands, the bands of the tree over their roots, and its leaves' table (tree, source, n).

    ``carry`` names narrow expressions over ``docs`` that stay with the leaves.
    Leaves ascend by id within a source (null first), rows of equal id by
    digest; rows equal in all are alike.  Sources ascend bytewise, null first.
    """
    leaves = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                leaf(*(F.col(c) for c in values)).alias("digest"),
                                F.struct(F.col(id_col).alias("doc_id"), *(c.alias(k) for k, c in (carry or {}).items())).alias("payload"),
                                F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    first = lambda c: F.col(c).asc_nulls_first()
    ranked = global_row_number(leaves, [first("source"), first("doc_id"), "digest", "row"], out="at")
    sources = stored(ranked.groupBy("source").agg(F.min("at").alias("first"), F.count("*").alias("n")), "merkle-sources")
    sources = stored(global_row_number(sources, ["first"], out="tree"), "merkle-trees").withColumnRenamed("source", "s")
    nodes = ranked.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        "tree", "n", (F.col("at") - F.col("first")).alias("lo"), "digest", "payload")
    bands = subtrees(nodes, "merkle")
    tops = stored(roots(bands), "merkle-roots")
    total = F.lit(tops.count())
    over = tops.select(F.lit(-1).cast("long").alias("tree"), total.cast("long").alias("n"), F.col("tree").alias("lo"), "digest", F.col("tree").alias("payload"))
    return bands, subtrees(over, "merkle-top"), sources.select("tree", F.col("s").alias("source"), "n")


def prove(docs: DataFrame, values: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
          source_col: str = "source", carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, path (left and right siblings of each level) of every row, and the carried columns.

    A leaf is the digest of its row's values.  Null ids and sources sort
    first, repeated rows have a leaf each, an empty table gives no rows.  A
    table of one row is its own root, with an empty path.  Only the columns
    named are read, so others may have any name.
    """
    bands, top, _ = manifest(docs, values, id_col, source_col, carry)
    spark = docs.sparkSession
    start = spark.range(1).select((F.col("id") - 1).alias("tree"), F.lit(None).cast("string").alias("top"),
                                  F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    over = paths(top, start).select(F.col("payload").cast("long").alias("tree"), "path", F.col("digest").alias("top"))
    over = stored(over, "merkle-over")
    out = paths(bands, over)
    root = roots(top).select("digest").first()
    names = ["payload." + k for k in carry or {}]
    return out.select("payload.doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
                      F.lit(root[0] if root else None).cast("string").alias("root"), "path", *names)
