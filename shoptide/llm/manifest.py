"""Merkle manifest of a dataset: every row is a leaf of its source's tree, the sources' roots are leaves of one tree above.

Leaves get their places from bitmaps of identifiers with counts of the ones before them, not from a sort; trees are
reduced in slot arrays of a fixed number of places, so that no source is ever in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm.common import numbered, written
from shoptide.operators.keyed import near_keys

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
# Nodes that become one, and levels that a slot array reduces at once: 729 slots.
FAN, LEVELS = 3, 6
# Identifiers of a bitmap word as a power of two, and children of a directory node.
WORD_BITS, DIRECTORY_BITS = 6, 12


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    """Lower-case hex SHA-256 of the fields, each as its length in bytes and itself, a null as ``-``."""
    return F.sha2(F.encode(F.concat(*[_field(f) for f in fields]), "UTF-8"), 256)


def source_key(source: Column) -> Column:
    """A source as a string that is never null and in whose order a null source comes first."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def _before(counts: DataFrame, group: list[str], key: str) -> DataFrame:
    """``counts`` (group, key, n) with ``before``: the sum of ``n`` over smaller keys of the group.

    A directory of ``2 ** DIRECTORY_BITS`` children a node: running sums are taken among the children of one node only, and
    a node starts where its own place among its siblings says. There are as many levels as the keys are wide.
    """
    low, high = counts.agg(F.min(key), F.max(key)).first()
    if low is None:
        return counts.withColumn("before", F.lit(0).cast("long"))
    parent = F.shiftright(F.col(key), DIRECTORY_BITS)
    last = high - low < 1 << DIRECTORY_BITS
    inside = Window.partitionBy(*group, *([] if last else [parent])).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = counts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    if last:
        return out
    node = f"{key}_"
    nodes = written(counts.groupBy(*group, parent.alias(node)).agg(F.sum("n").alias("n")), "manifest-nodes")
    nodes = _before(nodes, group, node).select(*group, node, F.col("before").alias("_base"))
    return out.withColumn(node, parent).join(nodes, [*group, node]).withColumn("before", F.col("before") + F.col("_base")).select(*counts.columns, "before")


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (sid, _id, ...) with ``pos``, the row's place among its group's by ``_id``, and ``n``, the group's size.

    A group's identifiers are merged to bitmap words of 64 within the tasks and then over them. A row's place is the
    number of rows in words before its own and the ones before its own bit. Only in words where rows share an
    identifier, or have none, are rows put in order, by identifier and then by the leaf; null comes first.
    """
    word, bit = F.shiftright("_id", WORD_BITS), F.col("_id").bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
    # Null identifiers are a word of their own with no bits set.
    one = F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), bit), F.lit(0).cast("long"))
    words = leaves.select("sid", word.alias("word"), one.alias("one")).groupBy("sid", "word").agg(F.bit_or("one").alias("bits"), F.count("*").alias("n"))
    words = written(words, "manifest-words")
    sizes = words.groupBy("sid").agg(F.sum("n").alias("size"))
    nulls = words.filter("word IS NULL").select("sid", F.col("n").alias("nulls"))
    before = _before(words.filter("word IS NOT NULL"), ["sid"], "word").join(nulls, "sid", "left")
    before = before.select("sid", "word", "bits", "n", (F.col("before") + F.coalesce("nulls", F.lit(0))).alias("before"))
    # The sizes come with the words: rows themselves are never dealt out by their group alone.
    before = written(before.join(sizes, "sid"), "manifest-directory")
    single = F.bit_count("bits") == F.col("n")

    smaller = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))
    rank = F.bit_count(F.col("bits").bitwiseAND(smaller))
    plain = leaves.withColumn("word", word).join(before.filter(single), ["sid", "word"]).withColumn("pos", F.col("before") + rank)
    columns = [*leaves.columns, "pos", F.col("size").alias("n")]
    plain = plain.select(*columns)

    # Words with more rows than identifiers: equal rows are counted, then ordered among those of the first bits of their leaf.
    missing = nulls.join(sizes, "sid").select("sid", F.lit(None).cast("long").alias("word"), F.lit(0).cast("long").alias("before"), "size")
    crowded = before.filter(~single).select("sid", "word", "before", "size").unionByName(missing)
    crowded = written(crowded.withColumn("key", F.coalesce(F.col("word").cast("string"), F.lit("-"))), "manifest-crowded")
    if crowded.isEmpty():
        return plain
    rows = leaves.withColumn("key", F.coalesce(word.cast("string"), F.lit("-")))
    rows = near_keys(rows, crowded, ["sid", "key"]).join(crowded.select("sid", "key", "before", "size"), ["sid", "key"])
    rows = rows.groupBy(*leaves.columns, "key", "before", "size").agg(F.count("*").alias("n"))
    rows = rows.withColumn("_bit", F.coalesce(bit, F.lit(0))).withColumn("_part", F.conv(F.substring("leaf", 1, DIRECTORY_BITS // 4), 16, 10).cast("long"))
    parts = rows.groupBy("sid", "key", "_bit", "_part").agg(F.sum("n").alias("parts"))
    earlier = Window.partitionBy("sid", "key").orderBy("_bit", "_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "key", "_bit", "_part", F.coalesce(F.sum("parts").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("sid", "key", "_bit", "_part").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(parts, ["sid", "key", "_bit", "_part"])
    rows = rows.withColumn("_from", F.col("before") + F.col("_base") + F.col("_in"))
    rows = rows.withColumn("pos", F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("n") - 1)))
    return plain.unionByName(rows.select(*columns))


def reduced(nodes: list[str], size: int, count: int) -> list[list[str]]:
    """The levels above ``nodes``, each run of ``FAN`` becoming one: ``count`` of them where the ``size`` nodes of the tree are
    more than this array holds, else up to the one that has a single node. The first level is ``nodes`` itself."""
    levels = [nodes]
    while len(levels) <= count if size > FAN**count else len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha256("".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[str]], place: int) -> list[str]:
    """What stands left and right of the node at ``place`` and of those above it, two texts a level."""
    path = []
    for level in levels[:-1]:
        start = place - place % FAN
        path += ["".join(level[start:place]), "".join(level[place + 1 : start + FAN])]
        place //= FAN
    return path


def folded(leaf: str, path: list[str]) -> str:
    """The root that ``leaf`` and its siblings give."""
    for i in range(0, len(path), 2):
        leaf = sha256(path[i] + leaf + path[i + 1])
    return leaf


def slot_arrays(nodes: DataFrame, levels: int, name: str) -> DataFrame:
    """(sid, n, pos, slots): nodes (sid, n, pos, ...) as arrays of ``FAN ** levels`` places, ``slots`` ordered by their place, ``n`` the
    number of the tree's nodes on this level. Written, since a tree is gone through upwards and downwards."""
    fields, size = [c for c in nodes.columns if c not in ("sid", "n", "pos")], FAN**levels
    keyed = nodes.select("sid", "n", F.floor(F.col("pos") / size).alias("_array"), F.struct((F.col("pos") % size).cast("int").alias("slot"), *fields).alias("_slot"))
    arrays = keyed.groupBy("sid", "n", "_array").agg(F.sort_array(F.collect_list("_slot")).alias("slots"))
    return written(arrays.withColumnRenamed("_array", "pos"), name)


def _columns(batch: pa.RecordBatch, slots: int) -> Iterator[tuple[int, dict[str, list]]]:
    """(row, fields of its slots) of a batch of slot arrays."""
    column = batch.column(slots)
    flat = column.flatten()
    ends = np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))))
    fields = {f.name: flat.field(i).to_pylist() for i, f in enumerate(flat.type)}
    for row in range(batch.num_rows):
        yield row, {name: values[ends[row] : ends[row + 1]] for name, values in fields.items()}


def tops(arrays: DataFrame, levels: int) -> DataFrame:
    """(sid, n, pos, leaf): what every array becomes, a node ``levels`` levels above, and how many of them there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            found = [reduced(slots["leaf"], sizes[row], levels)[-1][0] for row, slots in _columns(batch, 3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string())], ["sid", "n", "pos", "leaf"])

    up = arrays.select("sid", "n", "pos", "slots").mapInArrow(run, "sid string, n bigint, pos bigint, leaf string")
    return up.withColumn("n", F.ceil(F.col("n") / FAN**levels))


def _paths_down(arrays: DataFrame, above: DataFrame, count: int) -> DataFrame:
    """(sid, pos, path) of the nodes in ``arrays``, whose own paths are in ``above`` (sid, pos, path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids, sizes, places, paths = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            for row, slots in _columns(batch, 3):
                levels = reduced(slots["leaf"], sizes[row], count)
                found = [siblings(levels, slot) + paths[row] for slot in slots["slot"]]
                at = np.asarray(slots["slot"], np.int64) + places[row] * FAN**count
                yield pa.RecordBatch.from_arrays([pa.array([sids[row]] * len(at), pa.string()), pa.array(at), pa.array(found, pa.list_(pa.string()))], ["sid", "pos", "path"])

    rows = arrays.join(above, ["sid", "pos"]).select("sid", "n", "pos", "slots", "path")
    return rows.mapInArrow(run, "sid string, pos bigint, path array<string>")


def _tree(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The slot arrays of all passes from ``nodes`` (sid, n, pos, leaf, ...) upwards, and the roots (sid, leaf)."""
    passes = []
    while True:
        arrays = slot_arrays(nodes, levels, f"{name}-slots")
        passes.append(arrays)
        up = written(tops(arrays, levels), f"{name}-tops")
        if not up.agg(F.max("n") > 1).first()[0]:
            return passes, up.select("sid", "leaf")
        nodes = up


def _checked(arrays: DataFrame, above: DataFrame, count: int) -> DataFrame:
    """The result rows of all leaves in ``arrays``; ``above`` holds (sid, pos, path, subroot, root)."""
    fields = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, paths, subroots, roots = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for row, slots in _columns(batch, 1):
                levels = reduced(slots["leaf"], sizes[row], count)
                out: list[list] = [[] for _ in range(5)]
                for slot, leaf, changed in zip(slots["slot"], slots["leaf"], slots["changed"], strict=True):
                    path = siblings(levels, slot) + paths[row]
                    again = folded(changed or leaf, path)
                    for column, value in zip(out, (subroots[row], roots[row], sha256("".join(path)), again, again == roots[row]), strict=True):
                        column.append(value)
                columns = [pa.array(slots["_id"], pa.int64()), pa.array(slots["leaf"], pa.string()), *[pa.array(c) for c in out]]
                yield pa.RecordBatch.from_arrays(columns, fields)

    rows = arrays.join(above, ["sid", "pos"]).select("n", "slots", "path", "subroot", "root")
    return rows.mapInArrow(run, "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def leaves_of(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", fields: list[str] | None = None) -> DataFrame:
    """(sid, _id, leaf, changed): ``changed`` is the leaf of the row as someone has tampered with it, null where that is
    the same: rows whose identifier has an even CRC-32 have lost the line feeds of their text."""
    fields = fields or FIELDS
    text = F.col(text_col)
    other = leaf_hash([F.replace(text, F.lit("\n"), F.lit("")) if f == text_col else F.col(f) for f in fields])
    tampered = (F.crc32(F.col(id_col).cast("string")) % 2 == 0) & F.contains(text, F.lit("\n"))
    return docs.select(
        source_key(F.col(source_col)).alias("sid"), F.col(id_col).cast("long").alias("_id"), leaf_hash([F.col(f) for f in fields]).alias("leaf"), F.when(tampered, other).alias("changed"))


def manifest(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", fields: list[str] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs``: (id, leaf, subroot, root, proof_sha256, folded_root, verified).

    Leaves of a source stand in the order of their identifiers, null first; rows that share an identifier in the order
    of their leaves, and equal rows are leaves each on their own. Sources stand in the order of their bytes, a null source
    first. Trees are reduced in arrays of ``FAN ** levels`` slots. Nulls and empty texts have leaves of their own; texts are hashed whole whatever their length. A source with
    one row has that leaf as its root, one source the dataset; a row with no siblings at all has the hash of an empty
    text as proof. Other columns are not read, whatever their names; an empty table gives an empty table.
    """
    leaves = written(leaves_of(docs, id_col=id_col, source_col=source_col, text_col=text_col, fields=fields), "manifest-leaves")
    passes, subroots = _tree(placed(leaves), levels, "manifest")
    # The tree over the sources: one group, its nodes in the order of the sources.
    sources = numbered(subroots, [F.col("sid")], "pos", "manifest-sources").withColumn("pos", F.col("pos") - 1)
    n_sources = sources.count()
    above = sources.select(F.lit("").alias("sid"), F.lit(n_sources).cast("long").alias("n"), "pos", "leaf")
    upper, root = _tree(above, levels, "manifest-upper")
    paths = _down(upper, root, levels)
    places = sources.select("pos", F.col("sid").alias("_source"), F.col("leaf").alias("subroot"))
    of_source = paths.join(places, "pos").select(F.col("_source").alias("sid"), F.lit(0).cast("long").alias("pos"), "path", "subroot")
    of_source = written(of_source.withColumn("root", F.lit(root.first().leaf if n_sources else "")), "manifest-paths")
    paths = of_source.select("sid", "pos", "path")
    for arrays in reversed(passes[1:]):
        paths = written(_paths_down(arrays, paths, levels), "manifest-paths")
    above = paths.join(of_source.select("sid", "subroot", "root"), "sid")
    return _checked(passes[0], above, levels).withColumnRenamed("doc_id", id_col)


def _down(passes: list[DataFrame], roots: DataFrame, levels: int) -> DataFrame:
    """(sid, pos, path) of the lowest nodes of a tree."""
    paths = roots.select("sid", F.lit(0).cast("long").alias("pos"), F.array().cast("array<string>").alias("path"))
    for arrays in reversed(passes):
        paths = written(_paths_down(arrays, paths, levels), "manifest-paths")
    return paths
