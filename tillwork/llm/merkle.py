"""Merkle manifest of a dataset by a nested-struct rollup, with a proof for every row.

Rows become leaves; the leaves of a group stand in key order and are hashed two by two until
one node, the group's subroot, remains; the subroots of all groups, in order, are hashed
likewise to the root. A row's place comes from a range shuffle: its rank in its task plus
what earlier tasks hold of its group. The rank's low binary digits are columns. Blocks of
2^DIGITS nodes are shuffled once, and inside them the digits are grouped away one by one, each
grouping nesting the structs of two children in their parent. A block's top is a leaf of the
next round, so no row ever holds more than a block, however large the group; the number of
rounds grows with the logarithm of the rows.

Proofs go the other way. The path above a block meets the block's nested struct in a grouping
by block, one row each; transforms then walk down the nesting, noting the sibling at each
level, and an explode gives one row per node. There is no join in it.

Defined results. A null value enters a leaf as ``-``, a null group is the first one. Rows
with a null key come first in their group and are never tampered with; rows that repeat a key
stand in the order of their leaves and are leaves of their own. A lone row's leaf is its
subroot, a lone subroot is the root; a proof without siblings is the hash of the empty text.
Texts of any length are hashed whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillwork.llm.common import staged, table

DIGITS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def counted(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(rows: DataFrame, fields: Sequence[str], group: str, key: str, changed: dict[str, Column], where: Column) -> DataFrame:
    """``(grp, key, leaf, tampered, salt)``; ``tampered`` is the leaf with ``changed`` values ``where`` that holds."""
    leaf = digest(*[counted(F.col(n)) for n in fields])
    tampered = digest(*[counted(changed.get(n, F.col(n))) for n in fields])
    return staged(
        rows.select(
            F.col(group).cast("string").alias("grp"), F.col(key).cast("long").alias("key"), leaf.alias("leaf"),
            F.when(where, tampered).alias("tampered"),
            # Equal rows may be cut between tasks by it.
            F.monotonically_increasing_id().alias("salt"),
        ),
        "leaves",
    )


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, the place in ``grp`` by ``order``, and ``n``, the group's size."""
    sort = ["grp", *order]
    placed = staged(
        rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
        .withColumn("task", F.spark_partition_id())
        .withColumn("turn", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    # One row for each task and group in it: tasks and groups added up, not multiplied.
    parts = placed.groupBy("grp", "task").agg(F.count("*").alias("size"), F.min("turn").alias("first"))
    group = Window.partitionBy("grp")
    offsets = parts.select(
        F.col("grp").alias("of"), F.col("task").alias("at"),
        (F.sum("size").over(group.orderBy("task")) - F.col("size") - F.col("first")).alias("before"),
        F.sum("size").over(group).alias("n"),
    )
    same = placed["grp"].eqNullSafe(offsets["of"]) & (placed["task"] == offsets["at"])
    return placed.join(offsets, same).select(
        *rows.columns, (F.col("turn") + F.col("before")).alias("pos"), "n"
    )


def blocks(nodes: DataFrame, digits: int) -> DataFrame:
    """``(grp, n, block, node)`` from ``(grp, n, pos, node)``, the low digits of ``pos`` grouped away.

    Level by level, ``node`` becomes ``(digest, hashed, kids)``. A group of which one node is
    left at a level goes up unhashed.
    """
    names = [f"digit{i}" for i in range(digits)]
    rows = nodes.select(
        "grp", "n", F.shiftright("pos", digits).alias("block"), "node",
        *[F.shiftright("pos", i).bitwiseAND(F.lit(1)).alias(name) for i, name in enumerate(names)],
    ).repartition("grp", "block")
    for level, name in enumerate(names):
        hashed = F.col("n") > F.lit(1 << level)
        kids = F.array_sort(F.collect_list(F.struct(F.col(name).alias("digit"), F.col("node").alias("node"))))
        above = ["grp", "n", "block", *names[level + 1 :]]
        joined = F.array_join(F.transform("kids", lambda k: k["node"]["digest"]), "")
        rows = rows.groupBy(*above).agg(kids.alias("kids")).select(
            *above,
            F.struct(
                F.when(hashed, F.sha2(joined, 256)).otherwise(joined).alias("digest"),
                hashed.alias("hashed"), F.col("kids").alias("kids"),
            ).alias("node"),
        )
    return rows


def rounds(nodes: DataFrame) -> list[tuple[DataFrame, int]]:
    """Blocks with their digits, blocks of their tops, and so on, until every group is in one block."""
    out, most = [], nodes.agg(F.max("n")).first()[0] or 1
    while True:
        digits = max(1, min(DIGITS, (most - 1).bit_length()))
        level = staged(blocks(nodes, digits), "blocks")
        out.append((level, digits))
        most = -(-most >> digits)
        if most <= 1:
            return out
        nodes = level.select(
            "grp", F.shiftright(F.col("n") + F.lit((1 << digits) - 1), digits).alias("n"),
            F.col("block").alias("pos"),
            F.struct(F.col("node.digest").alias("digest"), F.col("block").alias("block")).alias("node"),
        )


def _below(places: Column) -> Column:
    """The children of all ``(node, path)`` places; the path starts with the nearest level."""

    def children(place: Column) -> Column:
        kids = place["node"]["kids"]

        def child(kid: Column, i: Column) -> Column:
            other = F.get(kids, F.lit(1) - i)["node"]["digest"]
            step = F.struct(
                F.when(i == 1, other).alias("left"), F.when(i == 0, other).alias("right")
            )
            path = F.when(place["node"]["hashed"], F.concat(F.array(step), place["path"])).otherwise(place["path"])
            return F.struct(kid["node"].alias("node"), path.alias("path"))

        return F.transform(kids, child)

    return F.flatten(F.transform(places, children))


def walked_down(tree: list[tuple[DataFrame, int]], above: DataFrame) -> DataFrame:
    """``(grp, node, path, top)`` of all nodes at the bottom of ``tree``.

    ``above`` has ``(grp, block, path, top)`` for block 0 of every group: the path that goes on
    from the tree's top, and whatever is to be handed down.
    """
    for i, (level, digits) in reversed(list(enumerate(tree))):
        known = above.select("grp", "block", F.lit(None).cast(level.schema["node"].dataType).alias("node"), "path", "top")
        blank = {n: F.lit(None).cast(above.schema[n].dataType).alias(n) for n in ("path", "top")}
        met = level.select("grp", "block", "node", blank["path"], blank["top"]).unionAll(known).groupBy("grp", "block").agg(
            *[F.first(n, ignorenulls=True).alias(n) for n in ("node", "path", "top")]
        )
        places = F.array(F.struct(F.col("node"), F.col("path")))
        for _ in range(digits):
            places = _below(places)
        bottom = met.select("grp", "top", F.explode(places).alias("place")).select(
            "grp", "top", "place.node", "place.path"
        )
        above = bottom if i == 0 else bottom.select("grp", F.col("node.block").alias("block"), "path", "top")
    return above


PATH = "array<struct<left: string, right: string>>"


def manifest(
    rows: DataFrame, fields: Sequence[str], group: str, key: str, changed: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``(grp, key, leaf, tampered, subroot, root, path)``, one row for each of ``rows``.

    ``path`` lists the levels from the leaf to the root; a level's ``left`` or ``right`` is the
    sibling, and both are null where a node without one is hashed alone.
    """
    found = leaves(rows, fields, group, key, changed or {}, F.lit(False) if where is None else where)
    leaf = F.struct(F.col("leaf").alias("digest"), "key", "tampered").alias("node")
    of_rows = rounds(ranked(found, ["key", "leaf", "salt"]).select("grp", "n", "pos", leaf))
    # The groups' subroots are the leaves of one more tree, whose only group is null.
    subroots = of_rows[-1][0].select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), F.col("node.digest").alias("subroot"))
    top = F.struct(F.col("subroot").alias("digest"), "name").alias("node")
    of_groups = rounds(ranked(subroots, ["name"]).select("grp", "n", "pos", top))
    empty = F.array().cast(PATH)
    roots = of_groups[-1][0].select("grp", "block", empty.alias("path"), F.col("node.digest").alias("top"))
    above = walked_down(of_groups, roots).select(
        F.col("node.name").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
        F.struct(F.col("node.digest").alias("subroot"), F.col("top").alias("root")).alias("top"),
    )
    return walked_down(of_rows, above).select(
        "grp", "node.key", F.col("node.digest").alias("leaf"), "node.tampered", "top.subroot", "top.root", "path"
    )


def proof(path: str) -> Column:
    """The hash of all siblings on a path."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.coalesce(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: str) -> Column:
    """The root that a leaf leads to along a path."""
    blank = F.lit("")
    return F.aggregate(
        F.col(path), leaf,
        lambda h, s: digest(F.coalesce(s["left"], blank), h, F.coalesce(s["right"], blank)),
    )


def documents_manifest(docs: DataFrame) -> DataFrame:
    """The manifest by language, with every seventh id's proof tried on a row that was tampered with."""
    picked = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    later = F.try_add(F.col("n_chars").cast("long"), F.lit(1).cast("long"))
    rows = manifest(docs, FIELDS, "lang", "doc_id", {"n_chars": later}, F.coalesce(picked, F.lit(False)))
    reached = folded(F.coalesce("tampered", "leaf"), "path")
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof("path").alias("proof_sha256"),
        reached.alias("folded_root"), (reached == F.col("root")).alias("verified"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_manifest(table(spark, sf_dir, "documents"))


# crc32 bit by bit over the decimal digits; the tree level by level in a recursive query. A
# node's row keeps its level, so the proof of a leaf is one sibling a level.
ORACLE_SQL = """
WITH RECURSIVE bits AS (SELECT range AS b FROM range(256)),
fold8 AS (
  SELECT b, list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM bits
), folds AS (SELECT list(v ORDER BY b) AS t FROM fold8),
fields AS (
  SELECT doc_id, lang, n_chars,
    coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
    coalesce(xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::BIGINT])), 4294967295) % 7 = 0, false) AS picked
  FROM documents, folds
), leafs AS (
  SELECT doc_id, lang,
    sha256(head || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    CASE WHEN picked THEN
      sha256(head || coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-') || tail)
    END AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n
  FROM leafs
), tree AS (
  SELECT lang, 0 AS lvl, pos AS idx, leaf AS h, n FROM placed
  UNION ALL
  SELECT lang, any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM tree WHERE n > 1 GROUP BY lang, idx // 2
), subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
), upper_tree AS (
  SELECT 0 AS lvl, pos AS idx, h, n FROM subroots
  UNION ALL
  SELECT any_value(lvl) + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM upper_tree WHERE n > 1 GROUP BY idx // 2
), root AS (SELECT h AS root FROM upper_tree WHERE n = 1),
steps AS (
  SELECT p.lang, p.pos, t.lvl, t.n > 1 AS hashed, (p.pos >> t.lvl) & 1 = 1 AS is_right, s.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT lang, lvl, n FROM tree) t ON t.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = t.lvl AND s.idx = xor(p.pos >> t.lvl, 1)
  WHERE t.n > 1
), paths AS (
  SELECT lang, pos, list({'s': sibling, 'r': is_right} ORDER BY lvl) AS path FROM steps GROUP BY lang, pos
), upper_paths AS (
  SELECT p.lang, p.h AS subroot, list({'s': s.h, 'r': (p.pos >> t.lvl) & 1 = 1} ORDER BY t.lvl) FILTER (t.n > 1) AS path
  FROM subroots p CROSS JOIN (SELECT DISTINCT lvl, n FROM upper_tree) t
  LEFT JOIN upper_tree s ON s.lvl = t.lvl AND s.idx = xor(p.pos >> t.lvl, 1)
  GROUP BY p.lang, p.h
), whole AS (
  SELECT p.*, u.subroot, list_concat(coalesce(q.path, []), coalesce(u.path, [])) AS path
  FROM placed p JOIN upper_paths u ON u.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN paths q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
), folding AS (
  SELECT doc_id, lang, pos, leaf, subroot, path, coalesce(tampered, leaf) AS h, 1 AS i FROM whole
  UNION ALL
  SELECT doc_id, lang, pos, leaf, subroot, path,
    sha256(CASE WHEN path[i].r THEN coalesce(path[i].s, '') || h ELSE h || coalesce(path[i].s, '') END), i + 1
  FROM folding WHERE i <= len(path)
)
SELECT doc_id, leaf, subroot, root,
  sha256(coalesce(array_to_string(list_transform(path, lambda e: coalesce(e.s, '')), ''), '')) AS proof_sha256,
  h AS folded_root, h = root AS verified
FROM folding, root WHERE i = len(path) + 1
"""
