"""A Merkle manifest of a dataset: content-addressed nodes, and proofs by descent from the root.

Rows are leaves.  Each group of rows (a language, say) is a tree of its own:
its leaves stand in order, every ``FAN`` neighbours become the digest of their
digests, and so on until one is left, the subroot.  The subroots, in the order
of their groups, make the tree above in the same way.

A node is kept as a record ``digest -> children``, and nothing but the digest
leads to it.  A request for a leaf names its rank; the rank's digits to the base
``FAN`` say which child to enter at each node on the way down from the root, the
children not entered are the proof, and the segments of the way reversed are the
order in which a verifier folds them.

Requests that agree in their first digits go down as one, so a level of the
descent has no more rows than the tree has nodes there, whatever the number of
requests; each level is one join of the requested nodes with the records of that
height.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.common import land, ranked, scratch_path

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(parts: Column) -> Column:
    """Lower-case hex SHA-256 of digests (hex text) put together."""
    return F.sha2(F.array_join(parts, ""), 256)


def leaf_digest(*columns: Column) -> Column:
    """Digest of one row: each value as its UTF-8 byte count, a colon and its text; ``-`` for NULL."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(
        F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256
    )


@dataclass(frozen=True)
class Manifest:
    """A written manifest: ``leaves`` (grp, the caller's columns, leaf, idx, n), and the records by tree and height."""

    spark: SparkSession
    path: str
    root: str | None
    height: int
    upper_height: int

    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/leaves")

    def groups(self) -> DataFrame:
        """grp, subroot, height, rank (place among the groups), of each group."""
        return self.spark.read.parquet(f"{self.path}/groups")

    def records(self, tree: str, height: int) -> DataFrame:
        """digest -> children; equal nodes are one record."""
        return self.spark.read.parquet(f"{self.path}/{tree}/height={height}").select("digest", "children").dropDuplicates(["digest"])


def _heights(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _grow(nodes: DataFrame, height: int, path: str) -> list[DataFrame]:
    """Write the levels above ``nodes`` (grp, idx, n, digest); return all levels, the given one first.

    ``n`` is the number of nodes of the group on this level; a group whose
    ``n`` is 1 has its subroot there and does not go on.
    """
    levels = [nodes]
    for k in range(1, height + 1):
        parents = (
            levels[-1].filter("n > 1")
            .groupBy("grp", F.expr(f"idx div {FAN}").alias("idx"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))
            .agg(F.array_sort(F.collect_list(F.struct("idx", "digest")))["digest"].alias("children"))
        )
        parents.withColumn("digest", digest_of(F.col("children"))).write.parquet(f"{path}/height={k}")
        levels.append(nodes.sparkSession.read.parquet(f"{path}/height={k}"))
    return levels


def write(leaves: DataFrame, path: str, group: str = "grp", order: str = "ord", leaf: str = "leaf") -> Manifest:
    """Write the manifest of ``leaves`` (a group, an order within it, the leaf digest, other columns) to a new folder.

    Groups stand in the order of their values, NULL first; so do leaves in
    theirs, and leaves that agree in it by digest.  A group of any size spreads
    over many tasks.  Repeated rows are leaves of their own.  An empty table has
    the root None.
    """
    spark = leaves.sparkSession
    named = leaves.withColumnsRenamed({group: "grp", order: "ord", leaf: "leaf"})
    ranked(named, ["grp"], [F.col("ord"), F.col("leaf")], "idx", "n", "merkle-ranks").write.parquet(f"{path}/leaves")
    placed = spark.read.parquet(f"{path}/leaves")
    nodes = placed.select("grp", "idx", "n", F.col("leaf").alias("digest"))
    height = _heights(nodes.agg(F.max("n")).first()[0] or 0)
    levels = _grow(nodes, height, f"{path}/lower")
    tops = levels[0].filter("n = 1").select("grp", F.col("digest").alias("subroot"), F.lit(0).alias("height"))
    for k, level in enumerate(levels[1:], 1):
        tops = tops.unionAll(level.filter("n = 1").select("grp", "digest", F.lit(k)))
    # One row for each group, in the order of the groups.
    ranked(tops.withColumn("whole", F.lit(0)), ["whole"], [F.col("grp")], "rank", "n", "merkle-groups").write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    upper_height = _heights(groups.count())
    upper = _grow(
        groups.select(F.lit(0).alias("grp"), F.col("rank").alias("idx"), "n", F.col("subroot").alias("digest")), upper_height, f"{path}/upper"
    )
    upper[-1].filter("n = 1").select("grp", "idx", "digest").write.parquet(f"{path}/root")
    top = spark.read.parquet(f"{path}/root").first()
    return Manifest(spark, path, top.digest if top else None, height, upper_height)


def _down(frontier: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """From nodes (keys, idx, digest, segments, digits) to their wanted children.

    ``wanted``: keys, idx and ``asked``, the digits to enter with what each
    brings along.  The digest alone finds the children; the others of them
    become the segment of this step.
    """
    keys = [c for c in ("grp", "idx") if c in wanted.columns]
    met = frontier.join(records, "digest").join(
        wanted.withColumnsRenamed({k: f"_{k}" for k in keys}),
        [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys],
    ).drop("digest", *(f"_{k}" for k in keys))
    entered = met.withColumn("ask", F.explode("asked")).drop("asked")
    digit = F.col("ask.digit")
    others = F.filter("children", lambda _, i: i != digit)
    return entered.withColumns(
        {
            "segments": F.concat("segments", F.array(others)),
            "digits": F.concat("digits", F.array(digit)),
            "digest": F.get("children", digit),
            "idx": F.col("idx") * FAN + digit,
        }
    ).drop("children")


def _asked(requests: DataFrame, brings: list[str]) -> DataFrame:
    """Requests (grp, idx, ...) met at their parents: grp, idx of the parent, asked (digit, ...)."""
    ask = F.struct((F.col("idx") % FAN).cast("int").alias("digit"), *brings)
    return requests.groupBy("grp", F.expr(f"idx div {FAN}").alias("idx")).agg(F.collect_list(ask).alias("asked"))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Add to each request (grp, idx, other columns) what leads from its leaf to the root.

    Columns added: ``found`` (the leaf's digest as the records have it),
    ``subroot``, and the way in the order of folding: ``segments`` (arrays of
    the siblings of each level, from left to right) and ``digits`` (where among
    them the node itself stands).  Requests for leaves that do not exist have
    no row.  Names of other columns must not clash with these.
    """
    others = [c for c in requests.columns if c not in ("grp", "idx")]
    groups = manifest.groups().select("grp", "subroot", F.col("height").alias("_height"), "rank")
    # The tree above: which groups are asked for, down from the root.
    named = requests.select("grp").distinct()
    asked_groups = groups.join(named.withColumnRenamed("grp", "_asked"), F.col("grp").eqNullSafe(F.col("_asked")), "left_semi")
    levels, wanted = [], asked_groups.select(F.lit(0).alias("grp"), F.col("rank").alias("idx"))
    for _ in range(manifest.upper_height):
        levels.append(_asked(wanted, []))
        wanted = levels[-1].select("grp", "idx")
    at = manifest.spark.read.parquet(f"{manifest.path}/root").select(
        "grp", "idx", "digest",
        F.array().cast("array<array<string>>").alias("segments"), F.array().cast("array<int>").alias("digits"),
    )
    for k in range(manifest.upper_height, 0, -1):
        at = _down(at, manifest.records("upper", k), levels[k - 1]).drop("ask")
    entered = land(
        at.select(F.col("idx").alias("rank"), "digest", "segments", "digits").join(groups, "rank").drop("rank")
        .withColumn("idx", F.lit(0).cast("long")),
        "merkle-entered",
    )
    # The trees below, by height: requests meet at their parents, these at theirs, and so on.
    levels = [_asked(requests, others)]
    parents = requests.select("grp", F.expr(f"idx div {FAN}").alias("idx")).distinct()
    for _ in range(1, manifest.height):
        levels.append(land(_asked(parents, []), "merkle-asked"))
        parents = levels[-1].select("grp", "idx")
    steps = ["grp", "subroot", "idx", "digest", "segments", "digits"]

    def starting(k: int) -> DataFrame:
        return entered.filter(F.col("_height") == k).select(*steps)

    at = starting(manifest.height)
    result = None
    for k in range(manifest.height, 0, -1):
        below = _down(at, manifest.records("lower", k), levels[k - 1])
        if k == 1:
            result = below.select(*steps, *(F.col(f"ask.{c}").alias(c) for c in others))
        else:
            at = land(below.select(*steps).unionAll(starting(k - 1)), "merkle-descent")
    # Groups of a single leaf are their own subroots.
    lone = starting(0).withColumnsRenamed({"grp": "_grp", "idx": "_idx"}).join(
        requests, F.col("_grp").eqNullSafe(F.col("grp")) & (F.col("_idx") == F.col("idx"))
    ).select(*steps, *others)
    result = lone if result is None else result.unionAll(lone)
    return result.withColumnRenamed("digest", "found").withColumns(
        {"segments": F.reverse("segments"), "digits": F.reverse("digits")}
    )


def proof_digest(segments: Column) -> Column:
    return digest_of(F.flatten(segments))


def fold(leaf: Column, segments: Column, digits: Column) -> Column:
    """The root that ``leaf`` and its siblings lead to."""

    def up(node: Column, step: Column) -> Column:
        left = F.array_join(F.slice(step["segments"], F.lit(1), step["digits"]), "")
        right = F.array_join(F.slice(step["segments"], step["digits"] + 1, F.lit(FAN)), "")
        return F.sha2(F.concat(left, node, right), 256)

    steps = F.zip_with(segments, digits, lambda s, d: F.struct(s.alias("segments"), d.alias("digits")))
    return F.aggregate(steps, leaf, up)


def tampered(doc_id: Column) -> Column:
    """Which documents the digest tampers with; a NULL id is left alone."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of ``docs`` (doc_id, source, lang, n_chars, text).

    ``folded_root`` starts from a tampered leaf (text with A-Z in lower case)
    where ``tampered`` says so.  NULL in any column is a value of its own; a
    NULL lang is a group, the first.  Repeated rows are leaves of their own and
    agree in their roots.  Extra columns are not read; an empty table has no
    rows.  Texts are hashed whole where they are read and never shuffled.
    """
    values = [F.col(c) for c in COLUMNS]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select(
        F.col("lang").alias("grp"),
        F.col("doc_id").alias("ord"),
        leaf_digest(*values).alias("leaf"),
        F.when(tampered(F.col("doc_id")), leaf_digest(*(lowered if c == "text" else F.col(c) for c in COLUMNS))).alias("altered"),
    )
    manifest = write(rows, scratch_path(docs.sparkSession, "merkle"))
    proven = prove(manifest, manifest.leaves().select("grp", "idx", "ord", "leaf", "altered"))
    folded = fold(F.coalesce("altered", "leaf"), F.col("segments"), F.col("digits"))
    return proven.select(
        F.col("ord").alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("segments")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
