"""Merkle manifest of a dataset: nodes labelled by the leaf ranks they cover, proofs from interval joins.

A row's leaf is the hash of its fields. Per tree (source) leaves are ranked by id; every ``FAN`` neighbouring nodes become
their parent until one is left, and the trees' roots make one more tree in the same way. A node is the half-open
interval ``[lo, hi)`` of the leaf ranks under it, so a node is an ancestor where its interval contains the leaf's.

Levels are taken in bands of ``BAND``. The nodes of a band that lie under one node of the band above make a bucket of at
most ``FAN ** BAND`` rows, which holds all their ancestors in the band, level by level. Going up, buckets are grouped by
tree and the interval they fall into; going down, each is joined by equality of tree and interval with the node
it hangs from, which brings the path above it. In a bucket, the siblings of a path are what is left of the parent's
interval without the child's. So a leaf meets log(n) / BAND joins, on buckets, and no group exceeds a bucket.

Ranks come from a range partitioning by (tree, id), stored, with the place of a row in its partition and the sums
of the partitions before: no task sees more than its part of a large tree. Everything is stored between steps.

Defined results: a null field counts as ``-``; a null id comes first, equal ids are ordered by their leaf; rows without a
tree form one, first of all; repeated rows are leaves of their own; a lone leaf is its tree's root; an empty
table gives an empty result; extra columns pass, a clashing one is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hitlens.llm.common import others, register, stored, table

FAN = 3
BAND = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
POWERS = [FAN**k for k in range(39)]  # all that fit in 63 bits
PRODUCED = ["leaf", "subroot", "root", "proof", "folded_root", "verified"]
NODE = "struct<lo:bigint,hi:bigint,digest:string>"
STEPS = "array<struct<left:string,right:string>>"


def hashed(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hash of fields, each as its UTF-8 byte count, a colon and its text, or ``-`` where it is null."""
    texts = [f.cast("string") for f in fields]
    return hashed(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def ranked(rows: DataFrame, tree: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``rank`` of every row in its tree, from 0, and the tree's size ``n``."""
    by = [*tree, *order]
    sorted_ = rows.repartitionByRange(*[F.col(c) for c in by]).sortWithinPartitions(*by)
    placed = stored(sorted_.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "ordered")
    spans = placed.groupBy(*tree, "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("here"))
    whole = Window.partitionBy(*tree)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")
    spans = stored(
        spans.select(*[F.col(c).alias(f"of_{c}") for c in tree], F.col("part").alias("at"), shift.alias("shift"), F.sum("here").over(whole).alias("n")),
        "spans",
    )  # a row for each partition and tree in it
    same = reduce(lambda a, b: a & b, [placed[c].eqNullSafe(spans[f"of_{c}"]) for c in tree], placed["part"] == spans["at"])
    return placed.join(spans, same).select(*rows.columns, (F.col("row") + F.col("shift")).alias("rank"), "n")


def levels(n: Column) -> Column:
    """Levels of a tree above its ``n`` leaves."""
    return F.size(F.filter(F.array(*[F.lit(p) for p in POWERS]), lambda p: p < n))


def first_of(k: Column, start: int) -> Column:
    """``start, start + 1, ..``: k numbers, of a band's levels."""
    return F.slice(F.array(*[F.lit(start + j) for j in range(BAND)]), 1, k)


def in_band(band: int) -> Column:
    """How many levels a bucket of this band has above its first."""
    return F.least(F.lit(BAND), levels(F.col("n")) - band * BAND)


def grown(nodes: Column, k: Column) -> Column:
    """All levels of a bucket from its lowest, each node with the interval and the hash of its run."""

    def parents(below: Column) -> Column:
        def parent(i: Column) -> Column:
            run = F.slice(below, i * FAN + 1, FAN)
            text = F.array_join(F.transform(run, lambda x: x["digest"]), "")
            return F.struct(F.get(run, F.lit(0))["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"), hashed(text).alias("digest"))

        return F.transform(F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int")), parent)

    return F.aggregate(first_of(k, 1), F.array(nodes), lambda made, _: F.concat(made, F.array(parents(F.element_at(made, -1)))))


def path(nodes: Column, x: Column, i: Column, k: Column) -> Column:
    """Hashes to the left and right of the path of node ``x`` (the ``i``-th of its bucket), level by level."""
    width = F.array(*[F.lit(p) for p in POWERS[: BAND + 1]])

    def step(level: Column) -> Column:
        parent = F.floor(i / F.get(width, level + 1)).cast("int")
        children = F.slice(F.get(nodes, level), parent * FAN + 1, FAN)  # the parent's interval

        def joined(part: Column) -> Column:
            return F.array_join(F.transform(part, lambda c: c["digest"]), "")

        left, right = F.filter(children, lambda c: c["hi"] <= x["lo"]), F.filter(children, lambda c: c["lo"] >= x["hi"])
        return F.struct(joined(left).alias("left"), joined(right).alias("right"))

    return F.transform(first_of(k, 0), step)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, s: hashed(F.concat(s["left"], acc, s["right"])))


def _pathed(band: int) -> Callable[[Column, Column], Column]:
    """What a bucket's lowest node gets on the way down: its path in the band and the bucket's own above it."""

    def each(x: Column, i: Column) -> Column:
        steps = F.concat(path(F.col("nodes"), x, i, in_band(band)), F.col("steps"))
        if band:
            return F.struct(x["lo"].alias("of_lo"), steps.alias("steps"))
        return F.struct(x["digest"].alias("digest"), F.get("payloads", i).alias("payload"), steps.alias("proof"))

    return each


class Forest:
    """The nodes over ranked leaves (``tree, rank, n, digest, payload``), one stored table of buckets for each band."""

    def __init__(self, leaves: DataFrame, name: str) -> None:
        self.most = leaves.agg(F.max(levels(F.col("n")))).first()[0] or 0
        node = F.struct(F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "payload")
        nodes = leaves.select("tree", "n", node.alias("node"))
        self.bands: list[DataFrame] = []
        roots = []
        for band in range(max(1, -(-self.most // BAND))):
            cover = F.floor(F.col("node.lo") / POWERS[(band + 1) * BAND]).alias("bucket")
            held = nodes.groupBy("tree", "n", cover).agg(F.collect_list("node").alias("items"))
            held = held.withColumn("items", F.array_sort("items", lambda a, b: (a["lo"] - b["lo"]).cast("int")))
            lowest = F.transform("items", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))
            payloads = F.transform("items", lambda x: x["payload"]) if not band else F.lit(None)
            made = held.select("tree", "n", "bucket", grown(lowest, in_band(band)).alias("nodes"), payloads.alias("payloads"))
            made = stored(made if not band else made.drop("payloads"), f"{name}-nodes")
            self.bands.append(made)
            top = F.get(F.element_at("nodes", -1), F.lit(0))
            higher = levels(F.col("n")) > (band + 1) * BAND
            roots.append(made.filter(~higher).select("tree", top["digest"].alias("digest")))
            nodes = made.filter(higher).select("tree", "n", F.struct(top["lo"].alias("lo"), top["hi"].alias("hi"), top["digest"].alias("digest"), F.lit(None).alias("payload")).alias("node"))
        self.roots = stored(reduce(DataFrame.union, roots), f"{name}-roots")

    def nodes(self) -> DataFrame:
        """Every node: ``tree, level, lo, hi, digest``; the first nodes of a band are the last of the one below."""
        parts = []
        for band, made in enumerate(self.bands):
            each = made.select("tree", F.posexplode("nodes").alias("at", "row")).filter("at > 0" if band else "true")
            parts.append(each.select("tree", (F.col("at") + band * BAND).alias("level"), F.explode("row").alias("x")).select("tree", "level", "x.*"))
        return reduce(DataFrame.union, parts)

    def proofs(self, tops: DataFrame) -> DataFrame:
        """Per leaf ``digest, payload, top, proof``; ``tops`` has the path above each tree's root and what to carry."""
        above = None
        for band in reversed(range(len(self.bands))):
            made = self.bands[band]
            ends = made.filter(levels(F.col("n")) <= (band + 1) * BAND).select(F.col("tree").alias("in_tree"))
            begun = ends.join(tops, F.col("in_tree").eqNullSafe(F.col("of_tree"))).select("of_tree", F.lit(0).cast("bigint").alias("of_lo"), "top", "steps")
            above = begun if above is None else above.unionByName(begun)
            # the node that a bucket hangs from covers the same leaf ranks
            under = F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("bucket") == F.floor(F.col("of_lo") / POWERS[(band + 1) * BAND]))
            joined = stored(made.join(above, under).drop("of_tree", "of_lo"), "paths")
            rows = joined.select("tree", "top", F.inline(F.transform(F.get(F.col("nodes"), F.lit(0)), _pathed(band))))
            if band:
                above = stored(rows.select(F.col("tree").alias("of_tree"), "of_lo", "top", "steps"), "above")
        return rows.select("digest", "payload", "top", "proof")


def audited(docs: DataFrame, altered: Column | None = None, fields: Sequence[str] = FIELDS, tree: str = "source", order: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` but its text, with leaf, tree root, root, proof and the root that the leaf's proof gives.

    ``altered`` is the leaf to prove in place of a row's own, where it is not null.
    """
    own = leaf_of([docs[c] for c in fields])
    kept = others(docs, [*PRODUCED, "text"])
    carried = F.struct(F.struct(*kept).alias("doc"), (F.lit(None).cast("string") if altered is None else altered).alias("altered"))
    leaves = stored(docs.select(docs[tree].cast("string").alias("tree"), docs[order].alias("id"), own.alias("digest"), carried.alias("payload")), "leaves")
    sources = Forest(ranked(leaves, ["tree"], ["id", "digest"]).drop("id"), "source")
    tops = sources.roots.select("tree", "digest", F.lit("").alias("payload"))
    whole = Forest(ranked(tops, [], ["tree"]).select(F.lit("").alias("tree"), "rank", "n", "digest", F.struct("tree").alias("payload")), "whole")
    root = whole.roots.first()
    start = docs.sparkSession.createDataFrame([("", "", [])], f"of_tree string, top string, steps {STEPS}")
    upper = whole.proofs(start).select(F.col("payload.tree").alias("of_tree"), F.col("digest").alias("top"), F.col("proof").alias("steps"))
    rows = sources.proofs(stored(upper, "tops"))
    found = rows.select(
        "payload.doc", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.lit(root.digest if root else None).cast("string").alias("root"), "proof",
        folded(F.coalesce(F.col("payload.altered"), F.col("digest")), F.col("proof")).alias("folded_root"),
    )
    names = [c for c in docs.columns if c.lower() not in {*PRODUCED, "text"}]
    passed = [F.col("doc").getField(c).alias(c) for c in names]
    return found.select(*passed, *PRODUCED[:-1], (F.col("folded_root") == F.col("root")).alias("verified"))


def without_breaks(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The leaf of a document whose line breaks were deleted, for ids with an even crc32; null for the others."""
    fields = [F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in FIELDS]
    even = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    return F.when(even & F.col(text).contains("\n"), leaf_of(fields))


def _sql(depth: int = 12) -> str:
    """Level by level; ``depth`` levels are enough for 3^12 documents of a source and as many sources."""
    crc = (
        "list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(d) + 1), lambda i: "
        "[ascii(substr(d, i::INT, 1))::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))), lambda s, x: "
        "CASE WHEN x < 256 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)"
    )

    def leaf(text: str) -> str:
        parts = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"

    steps = [
        "d0 AS (SELECT *, CAST(doc_id AS VARCHAR) AS d FROM documents)",
        # the checksum's last bit is the opposite of the state's
        f"d1 AS (SELECT *, {crc} & 1 = 1 AS even FROM d0)",
        f"""p0 AS MATERIALIZED (SELECT doc_id, source AS t, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, {leaf("text")} AS leaf,
  CASE WHEN even THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS f, '' AS proof FROM d1)""",
        "a0 AS MATERIALIZED (SELECT t, i, leaf AS h FROM p0)",
    ]

    def climb(nodes: str, paths: str, kept: str) -> None:
        for k in range(depth):
            steps.extend([
                f"{nodes}r{k} AS MATERIALIZED (SELECT t, i // 3 AS g, list(h ORDER BY i) AS hs, max(n) AS n FROM (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM {nodes}{k}) GROUP BY t, i // 3)",
                f"{nodes}{k + 1} AS MATERIALIZED (SELECT t, g AS i, CASE WHEN n = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {nodes}r{k})",
                f"{paths}{k + 1} AS MATERIALIZED (SELECT {kept}, t, i // 3 AS i,"
                " CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(list_concat(hs[1:w], [f], hs[w + 2:len(hs)]), '')) END AS f,"
                " CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(list_concat(hs[1:w], hs[w + 2:len(hs)]), '') END AS proof"
                f" FROM (SELECT p.*, hs, n, CAST(p.i % 3 AS INT) AS w FROM {paths}{k} p JOIN {nodes}r{k} r ON p.t IS NOT DISTINCT FROM r.t AND p.i // 3 = r.g))",
            ])

    climb("a", "p", "doc_id, leaf")
    steps += [
        f"s0 AS MATERIALIZED (SELECT t AS source, row_number() OVER (ORDER BY t NULLS FIRST) - 1 AS i, h FROM a{depth})",
        "b0 AS MATERIALIZED (SELECT 0 AS t, i, h FROM s0)",
        f"q0 AS MATERIALIZED (SELECT doc_id, leaf, s.h AS subroot, 0 AS t, s.i, f, proof FROM p{depth} p JOIN s0 s ON p.t IS NOT DISTINCT FROM s.source)",
    ]
    climb("b", "q", "doc_id, leaf, subroot")
    return (
        f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, b.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = b.h AS verified"
        f" FROM q{depth} q JOIN b{depth} b ON q.t = b.t"
    )


@register("op12_merkle_manifest", _sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audited(table(spark, sf_dir, "documents").select(*FIELDS), without_breaks())
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return rows.select("doc_id", "leaf", "subroot", "root", hashed(siblings).alias("proof_sha256"), "folded_root", "verified")
