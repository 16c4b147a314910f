"""A Merkle manifest of a dataset, with a proof of membership for every row.

A row is a leaf; per language every ``FANOUT`` consecutive nodes become a parent until one is left,
the subroot, and the subroots become the root the same way.  Proofs come by pointer jumping: a node
starts with the segment of siblings on the way to its parent, and a self-join hands it the segment
of the node it points to, so the distance doubles each time and every node reaches the root after
a logarithmic number of joins.  The leaves of one parent move as one row (a bundle), as what they
need above it is the same; their own siblings are in the bundle already.

Leaves are numbered by range partitions, so no language is ever sorted or numbered by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.session import bounded, discard, written

FANOUT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that any tree of at most 2**63 leaves can have.
LEVELS = 21


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.concat_ws("", F.transform(digests, _hex))


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (hex) of the fields, each as its UTF-8 byte count, a colon and its text; ``-`` if null."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_ids() -> Column:
    """Rows whose crc32 of the decimal doc_id is divisible by three; never a row without one."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))


def numbered(rows: DataFrame, by: list[str], order: list[str], lookup: DataFrame | None = None) -> DataFrame:
    """Add ``_i``, the 0-based place in its ``by`` group (nulls first, equal rows in any order), and ``_total``.

    Rows are sorted by range partitions; places inside a partition are shifted by the sizes of the
    earlier pieces of the group, of which there are at most as many as partitions.  Rows that agree
    in everything are spread by a hash of their place in the written input.  ``lookup`` adds
    columns per group.
    """
    salt = F.xxhash64(F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (*by, *order, "_salt")]
    sorted_rows = rows.withColumn("_salt", salt).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(sorted_rows.drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    piece = F.shiftright("_at", 33)
    pieces = placed.groupBy(*by, piece.alias("_piece")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    found = pieces.select(*by, "_piece", shift.alias("_shift"), F.sum("_n").over(group).alias("_total"))
    if lookup is not None:
        found = _null_safe(found, lookup, by)
    joined = _null_safe(placed.withColumn("_piece", piece), bounded(written(found)), [*by, "_piece"])
    return joined.withColumn("_i", F.col("_at") + F.col("_shift")).drop("_at", "_piece", "_shift")


def _null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition &= F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition).drop(*[f"_r_{c}" for c in on])


def _self(group: Column, level: int, i: Column) -> Column:
    return F.struct(group.cast("bigint").alias("g"), F.lit(level).alias("level"), i.alias("i"))


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    """The level above: (self, g, i, m, digest, kids); ``m`` counts the nodes of a level of the tree."""
    up = nodes.groupBy("g", F.expr(f"i div {FANOUT}").alias("i"), F.ceil(F.col("m") / FANOUT).alias("m")).agg(
        F.array_sort(F.collect_list(F.struct("i", "self", "digest"))).alias("kids")
    )
    digest = F.unhex(F.sha2(_joined(F.col("kids.digest")), 256))
    return written(up.select(_self(F.col("g"), level, F.col("i")).alias("self"), "g", "i", "m", digest.alias("digest"), "kids"))


def _edges(parents: DataFrame) -> DataFrame:
    """Every node's pointer to its parent with its first segment: its place and the run it is in."""
    kids = parents.select("self", F.col("kids.digest").alias("run"), F.posexplode("kids").alias("at", "kid"))
    step = F.struct(F.col("at"), F.col("run"))
    return kids.select(F.col("kid.self").alias("node"), F.col("self").alias("up"), F.array(step).alias("path"))


def _jumped(paths: DataFrame, targets: DataFrame, root: Column) -> DataFrame:
    """Pointers twice as far: each path is extended by the path of the node it leads to."""
    there = targets.select(F.col("node").alias("_node"), F.col("up").alias("_up"), F.col("path").alias("_path"))
    open_paths = paths.where(F.col("up") != root).join(there, F.col("up") == F.col("_node"))
    further = open_paths.select("node", F.col("_up").alias("up"), F.concat("path", "_path").alias("path"))
    return written(paths.where(F.col("up") == root).unionByName(further))


def _folded(digest: Column, path: Column) -> Column:
    """Digest (hex) of the last ancestor on ``path``, recomputed from ``digest`` (hex) and the siblings."""

    def up(below: Column, step: Column) -> Column:
        run, at = step["run"], step["at"]
        left, right = F.slice(run, F.lit(1), at), F.slice(run, at + 2, F.lit(FANOUT))
        return F.sha2(F.concat(_joined(left), below, _joined(right)), 256)

    return F.aggregate(path, digest, up)


def _siblings(path: Column) -> Column:
    """The siblings (hex) on ``path``, level by level from left to right."""

    def others(step: Column) -> Column:
        return F.concat(F.slice(step["run"], F.lit(1), step["at"]), F.slice(step["run"], step["at"] + 2, F.lit(FANOUT)))

    return F.transform(F.flatten(F.transform(path, others)), _hex)


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs``.

    Returns doc_id, lang, leaf, claimed (the leaf as it is after lower-casing the text where
    ``tampered`` holds, else the leaf), subroot, root (all hex) and ``path``: per level from the
    leaf's run to the root, the place ``at`` in the run and the run's digests.  A level whose run
    has one node has a path step without siblings.

    Nulls are fields of their own kind, null languages a tree of their own that comes first; null
    ids come first in their language and are never tampered with by :func:`tampered_ids`.  Rows
    that share an id are ordered by leaf; equal rows are interchangeable leaves with a proof each.
    Other columns are ignored; an empty table gives no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    leaf = leaf_digest(fields)
    lowered = leaf_digest([*fields[:-1], F.translate(fields[-1], UPPER, LOWER)])
    changed = F.lit(False) if tampered is None else tampered
    leaves = written(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.unhex(leaf).alias("leaf"),
            F.when(changed, F.unhex(lowered)).alias("claimed"),
        )
    )
    langs = numbered(leaves.select("lang").distinct(), [], ["lang"]).select("lang", F.col("_i").alias("g"), F.col("_total").alias("n_langs"))
    places = numbered(leaves, ["lang"], ["doc_id", "leaf"], langs)
    discard(leaves)
    kids = F.array_sort(F.collect_list(F.struct("_i", "doc_id", "leaf", "claimed")))
    runs = places.groupBy("g", "lang", "n_langs", F.expr(f"_i div {FANOUT}").alias("i"), F.col("_total").alias("n")).agg(kids.alias("leaves"))
    parent = F.unhex(F.sha2(_joined(F.col("leaves.leaf")), 256))
    bundles = written(
        runs.select(
            _self(F.col("g"), 0, F.col("i")).alias("self"), "g", "lang", "i", "n", "n_langs", "leaves",
            F.ceil(F.col("n") / FANOUT).alias("m"),
            F.when(F.col("n") == 1, F.col("leaves.leaf")[0]).otherwise(parent).alias("digest"),
        )
    )
    widest, n_langs = bundles.agg(F.max("m"), F.max("n_langs")).first()
    if widest is None:
        return _rows(bundles, F.lit(""), F.expr("array()"))

    columns = ["self", "g", "i", "m", "digest"]
    now, grown, height = bundles.select(columns), [], 0
    tops = [now.where("m = 1")]
    while widest > 1:
        height, widest = height + 1, -(-widest // FANOUT)
        grown.append(_parents(now.where("m > 1"), height))
        now = grown[-1].select(columns)
        tops.append(now.where("m = 1"))
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.unionByName(more)
    now = subroots.select("self", F.lit(-1).cast("bigint").alias("g"), F.col("g").alias("i"), F.lit(n_langs).alias("m"), "digest")
    level = 0
    while n_langs > 1:
        level, height, n_langs = level + 1, height + 1, -(-n_langs // FANOUT)
        grown.append(_parents(now, level))
        now = grown[-1].select(columns)
    top = now.select("self", F.hex("digest").alias("digest")).first()
    root = F.lit(top.digest.lower())
    if not grown:
        return _rows(bundles, root, F.expr("array()"))

    root_key = _self(F.lit(top.self.g), top.self.level, F.lit(top.self.i))
    edges = _edges(grown[0])
    for parents in grown[1:]:
        edges = edges.unionByName(_edges(parents))
    # Bundles are seven in eight of the nodes and nobody's ancestors.
    is_bundle = F.expr("node.level = 0 and node.g >= 0")
    low, high = written(edges.where(is_bundle)), written(edges.where(~is_bundle))
    distance = 1
    while distance < height:
        # What a path of this length can lead to: few nodes where many paths meet in one.
        targets = written(high.where((F.col("node.level") >= distance) | (F.col("node.g") < 0)))
        old = low, high, targets
        low, high = (_jumped(paths, bounded(targets), root_key) for paths in (low, high))
        discard(*old)
        distance *= 2
    paths = low.select(F.col("node").alias("_node"), "path")
    return _rows(bundles.join(paths, F.col("self") == F.col("_node"), "left"), root, F.col("path"))


def _rows(bundles: DataFrame, root: Column, path: Column) -> DataFrame:
    """One row per leaf of bundles that know the path above them."""
    steps = "array<struct<at:int,run:array<binary>>>"
    above = F.coalesce(path.cast(steps), F.expr("array()").cast(steps))
    # Levels of the language's tree above the bundle: as often as m nodes can be divided.
    levels = F.size(F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: F.pow(F.lit(float(FANOUT)), k) < F.col("m")))
    subroot = _folded(_hex(F.col("digest")), F.slice(above, F.lit(1), levels))
    found = bundles.select("lang", "n", "leaves", above.alias("above"), subroot.alias("subroot"))
    step = F.array(F.struct(F.col("at"), F.col("leaves.leaf").alias("run"))).cast(steps)
    own = F.when(F.col("n") > 1, F.concat(step, F.col("above"))).otherwise(F.col("above"))
    return found.select("*", F.posexplode("leaves").alias("at", "_row")).select(
        F.col("_row.doc_id").alias("doc_id"), "lang", _hex(F.col("_row.leaf")).alias("leaf"),
        _hex(F.coalesce("_row.claimed", "_row.leaf")).alias("claimed"), "subroot", root.alias("root"), own.alias("path"),
    )


def checked(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Every row's proof as a digest, and whether its claimed leaf still leads to the root.

    Returns doc_id, leaf, subroot, root, proof_sha256 (SHA-256 of the siblings in hex, from the leaf
    up and left to right; of nothing for a row alone), folded_root (from the claimed leaf and the
    original siblings) and verified.
    """
    folded = manifest(docs, tampered).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", _siblings(F.col("path"))), 256).alias("proof_sha256"),
        _folded(F.col("claimed"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
