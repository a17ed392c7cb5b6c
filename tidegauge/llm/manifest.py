"""A Merkle manifest of a table, with an inclusion proof per row found by pointer jumping.

Rows are hashed once. The leaves of a language, in the order of their ids, are hashed together
in runs of ``ARITY`` until one node is left, the subroot; subroots in the order of their
languages are the leaves of a last tree, whose root stands for the table. Every node but the
root knows its parent and a segment: the siblings on its left and right in its run.

A proof is the row of segments from leaf to root. Instead of climbing level by level, nodes
jump: joined with the node it points to, a node takes over that one's pointer and appends
its segment, so the distance doubles with every join. Only nodes high enough to be pointed to
take part, an eighth of an eighth and so on of the rows, so the first joins are the large ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, settle
from .order import numbered, placed

ARITY = 8
#: Names of the trees: one per language, null apart from the empty text, and the one above them, which sorts first.
TOP, NO_LANG, LANG = "", "-", "="
#: Nodes of subroots and above are pointed to from any distance.
ALWAYS = 1 << 30
#: Nodes that are sent to all tasks: at most so many bytes, by their number and the length of their segments.
SENT_BYTES = 4 << 20
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SEGMENT = "array<struct<left:binary,right:binary>>"


def _part(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def _digest(*texts: Column) -> Column:
    """SHA-256 over the texts put together, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*texts).cast("binary"), 256))


def shown(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def tampered(doc_id: Column) -> Column:
    """Rows whose copy is taken to be damaged. A null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and ``found``: the leaf of the row as it is found later, damaged or not."""
    same, text = [_part(F.col(name)) for name in FIELDS[:-1]], F.col("text")
    lowered = F.when(text.isNotNull(), lower_ascii(text))
    rows = docs.select(
        F.coalesce(F.concat(F.lit(LANG), F.col("lang").cast("string")), F.lit(NO_LANG)).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _digest(*same, _part(text)).alias("leaf"),
        F.when(tampered(F.col("doc_id")) & (lowered != text), _digest(*same, _part(lowered))).alias("found"),
    )
    # Place in the written table: it tells equal rows apart.
    rows = settle(numbered(rows, "part", "at"), "manifest-leaves")
    return rows.withColumn("found", F.coalesce("found", "leaf"))


def families(nodes: DataFrame, *payload: str) -> DataFrame:
    """tree, pos, n, digest of each parent, and ``kids``: up to ``ARITY`` structs pos, digest and payload.

    ``nodes`` has tree, pos, n (nodes of that level in the tree), digest.
    """
    up = nodes.groupBy("tree", F.floor(F.col("pos") / ARITY).alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"))
    rows = up.agg(F.array_sort(F.collect_list(F.struct("pos", "digest", *payload))).alias("kids"))
    return rows.withColumn("digest", _digest(F.array_join(F.transform("kids", lambda kid: shown(kid["digest"])), "")))


def _joined(kids: Column) -> Column:
    return F.aggregate(kids, F.lit(b""), lambda out, kid: F.concat(out, kid["digest"]))


def children(families_: DataFrame) -> DataFrame:
    """A row per kid: tree, ``above`` (its parent's pos), ``kid`` and ``step`` (its siblings on either side)."""
    row = families_.select("tree", F.col("pos").alias("above"), "kids", F.posexplode("kids").alias("i", "kid"))
    left, right = F.slice("kids", F.lit(1), F.col("i")), F.slice("kids", F.col("i") + 2, F.lit(ARITY))
    step = F.struct(_joined(left).alias("left"), _joined(right).alias("right"))
    return row.select("tree", "above", "kid", step.alias("step"))


def _at(tree, level, pos) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def _grown(nodes: DataFrame, level: int, purpose: str, *payload: str) -> list[DataFrame]:
    """The written families of each level of trees of more than one node. There are as many levels as the largest tree has."""
    out, largest = [], nodes.agg(F.max("n")).first()[0] or 0
    while largest > 1:
        more = payload if not out else ()
        out.append(settle(families(nodes.filter("n > 1"), *more), f"{purpose}-{level + len(out)}"))
        nodes = out[-1].select("tree", "pos", "n", "digest")
        largest = -(-largest // ARITY)
    return out


class Manifest:
    """The trees of a table: ``root`` (hexadecimal, None for an empty table), ``leaves`` and ``nodes``.

    ``leaves``: tree, doc_id, leaf, found, segment (empty for the only leaf of its tree) and
    ``above``, the node that it points to. ``nodes``: id, above, segment and rank (its level)
    of all others but the root. ``subroots``: tree, digest.
    """

    def __init__(self, docs: DataFrame):
        named = docs.select(*[F.col(f"`{name}`") for name in FIELDS])
        sorted_ = placed(leaves(named), "tree", ["doc_id", "leaf", "part", "at"], "manifest-order").withColumnRenamed("leaf", "digest")
        levels = _grown(sorted_, 1, "manifest-level", "doc_id", "found")
        one = [sorted_.filter("n = 1").select("tree", "digest", F.lit(0).alias("level"))]
        one += [rows.filter("n = 1").select("tree", "digest", F.lit(i + 1).alias("level")) for i, rows in enumerate(levels)]
        subroots = one[0]
        for rows in one[1:]:
            subroots = subroots.unionByName(rows)
        self.subroots = settle(subroots, "manifest-subroots")
        top = placed(self.subroots.withColumn("group", F.lit(TOP)), "group", ["tree"], "manifest-top")
        upper = _grown(top.select(F.col("group").alias("tree"), "pos", "n", "digest", F.col("tree").alias("of"), "level"), 0, "manifest-upper", "of", "level")
        root = upper[-1] if upper else self.subroots
        found = root.select(shown(F.col("digest"))).first()
        self.root = found[0] if found else None
        self.height = len(levels) + len(upper)
        self.leaves = self._leaves(sorted_, levels)
        self.nodes = self._nodes(levels, upper)

    @staticmethod
    def _leaves(sorted_: DataFrame, levels: list[DataFrame]) -> DataFrame:
        none = F.array().cast(SEGMENT)
        zero = F.lit(0)
        alone = sorted_.filter("n = 1").select("tree", "doc_id", F.col("digest").alias("leaf"), "found", none.alias("segment"), _at(F.col("tree"), zero, zero).alias("above"))
        if not levels:
            return alone
        kids = children(levels[0])
        many = kids.select("tree", "kid.doc_id", F.col("kid.digest").alias("leaf"), "kid.found", F.array("step").cast(SEGMENT).alias("segment"), _at(F.col("tree"), F.lit(1), F.col("above")).alias("above"))
        return many.unionByName(alone)

    @staticmethod
    def _nodes(levels: list[DataFrame], upper: list[DataFrame]) -> DataFrame | None:
        parts = []
        for level, rows in enumerate(levels[1:], 1):
            kids = children(rows)
            parts.append((kids, _at(F.col("tree"), F.lit(level), F.col("kid.pos")), F.lit(level), _at(F.col("tree"), F.lit(level + 1), F.col("above"))))
        for level, rows in enumerate(upper):
            kids = children(rows)
            here = _at(F.col("tree"), F.lit(level), F.col("kid.pos")) if level else _at(F.col("kid.of"), F.col("kid.level"), F.lit(0))
            parts.append((kids, here, F.lit(ALWAYS), _at(F.col("tree"), F.lit(level + 1), F.col("above"))))
        out = None
        for kids, here, rank, above in parts:
            some = kids.select(here.alias("id"), rank.alias("rank"), above.alias("above"), F.array("step").cast(SEGMENT).alias("segment"))
            out = some if out is None else out.unionByName(some)
        return None if out is None else settle(out, "manifest-nodes")

    def proofs(self) -> DataFrame:
        """The leaves with ``segment`` grown up to the root. Rows that point to the root find no node and stay."""
        rows, nodes, distance = self.leaves, self.nodes, 1
        while nodes is not None and distance <= self.height:
            # A lone leaf begins one step behind, so distances add up to 2 * distance - 1 at least.
            high = nodes.filter(F.col("rank") >= distance)
            if distance > 1:
                high = settle(high, f"manifest-high-{distance}")
            size = high.count() * distance * (32 * ARITY + 64)
            ahead = F.broadcast(high) if size <= SENT_BYTES else high
            rows, nodes, distance = jumped(rows, ahead), settle(jumped(high, ahead), f"manifest-nodes-{2 * distance}"), 2 * distance
        return rows


def jumped(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` that point to one of ``nodes`` take over its pointer and append its segment."""
    ahead = nodes.select(F.col("id.tree").alias("_tree"), F.col("id.level").alias("_level"), F.col("id.pos").alias("_pos"), F.col("above").alias("_above"), F.col("segment").alias("_segment"))
    met = (F.col("above.tree") == F.col("_tree")) & (F.col("above.level") == F.col("_level")) & (F.col("above.pos") == F.col("_pos"))
    joined = rows.join(ahead, met, "left")
    return joined.select(
        *[name for name in rows.columns if name not in ("above", "segment")],
        F.coalesce("_above", "above").alias("above"),
        F.when(F.col("_segment").isNull(), F.col("segment")).otherwise(F.concat("segment", "_segment")).alias("segment"),
    )


def folded(start: Column, segment: Column) -> Column:
    """The root that a leaf (hexadecimal) and its proof lead to."""
    return F.aggregate(segment, start, lambda out, step: F.sha2(F.concat(shown(step["left"]), out, shown(step["right"])).cast("binary"), 256))


def proof_digest(segment: Column) -> Column:
    """SHA-256 over all siblings of a proof from leaf to root, left to right."""
    siblings = F.array_join(F.transform(segment, lambda step: F.concat(shown(step["left"]), shown(step["right"]))), "")
    return F.sha2(siblings.cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A null field is hashed apart from an empty one; a null language has its own tree, the
    first. Rows of one id are put in the order of their leaves; rows equal in all fields take
    neighbouring places, each with its own proof. The length of a text does not matter beyond its
    row; it is read once and not shuffled. An empty table gives no row; other columns are ignored.
    """
    trees = Manifest(docs)
    # One row per language, sent or shuffled by its size.
    subroots = trees.subroots.select("tree", shown(F.col("digest")).alias("subroot"))
    rows = trees.proofs().join(subroots, "tree")
    root, ended = F.lit(trees.root), folded(shown(F.col("found")), F.col("segment"))
    rows = rows.select("doc_id", shown(F.col("leaf")).alias("leaf"), "subroot", root.cast("string").alias("root"), proof_digest(F.col("segment")).alias("proof_sha256"), ended.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
