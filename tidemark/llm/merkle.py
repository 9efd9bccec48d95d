"""A Merkle manifest of a table: a digest of every row, of every source and of all, and each row's inclusion proof.

A row's leaf is the hash of its fields, each as `-` if null, else its UTF-8 byte count, `:` and its value. The leaves
of a source, ascending by id, form a tree whose runs of FANOUT consecutive nodes become one, until one is left, the
source's subroot; subroots in the order of their sources form the tree whose last node is the root.

No task holds a tree. Leaves are sorted by range, so a source of any size is dealt over many tasks, and cut into aligned
blocks of FANOUT ** BLOCK_LEVELS. A block is traversed in postorder: a recursive call gives its subtree's digest, and on
the way up the siblings are appended to the paths of the leaves below. Block roots are the nodes of the next traversal,
which goes on until every source has one node; then the subroots are traversed in the same way. Going down, each block's
path above is met with the block's rows, so that a row gets its siblings from leaf to root. Only counts at the borders
of partitions reach the driver.

Null fields count as `-`. A null or repeated id is a row like others: nulls first, repeats by leaf; equal rows have equal
leaves, each with a place of its own. A null source is a source of its own, before all others. An empty table gives no
rows. Other columns take no part.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tidemark.llm._store import forget, kept, small_batches

FANOUT, BLOCK_LEVELS = 16, 3
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Leaves sorted by a task, at most about so many.
TASK_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = ArrayType(StructType([StructField("left", StringType()), StructField("right", StringType())]))
_PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def lower_cased(text: Column) -> Column:
    """A-Z in lower case; all else stays."""
    return F.translate(text, _UPPER, _LOWER)


def leaf(fields: dict[str, Column]) -> Column:
    """The digest of a row whose fields are these columns, in this order."""
    sized = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*(sized(c.cast("string")) for c in fields.values())), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, source, leaf, other) of every row; `other` is the leaf of a row whose text is `tampered`, null where that is null or the same."""
    own = {c: F.col(f"`{c}`") for c in fields}
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull() & ~tampered.eqNullSafe(own["text"]), leaf(own | {"text": tampered}))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), leaf(own).alias("leaf"), other.alias("other"))


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _rows(batches):
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _numbered(nodes: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """nodes with `at`: each one's place, from 0, among its group's in order. No task needs a whole group.

    Rows are sorted by range and numbered inside their partition; a partition's first group may go on from earlier ones,
    and its offset follows from one row of counts a partition.
    """
    count = nodes.count()
    parts = max(-(-count // TASK_ROWS), min(nodes.sparkSession.sparkContext.defaultParallelism, 1 + count // 10_000))

    def kernel(batches):
        first, now, n, row = True, None, -1, 0
        for batch in batches:
            keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in group))) if group else [()] * batch.num_rows
            places, firsts = [], []
            for key in keys:
                if row and key != now:
                    first, n = False, -1
                now, n, row = key, n + 1, row + 1
                places.append(n)
                firsts.append(first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64()), pa.array(firsts, pa.bool_()), pa.array(range(row - len(keys), row), pa.int64())], names=[*batch.schema.names, "at", "__head", "__row"])

    by = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = nodes.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("__part", F.spark_partition_id())
    dealt = kept(dealt.mapInArrow(kernel, StructType([*dealt.schema.fields, StructField("at", LongType()), StructField("__head", BooleanType()), StructField("__row", LongType())])))
    key = F.struct(*(F.col(c) for c in group)) if group else F.struct(F.lit(0))
    ends = dealt.groupBy("__part").agg(F.min_by(key, "__row").alias("first"), F.max_by(key, "__row").alias("last"), F.max_by("at", "__row").alias("place"), F.min("__head").alias("one")).orderBy("__part").collect()
    starts, held, last = [], 0, None
    for e in ends:
        before = held if e["first"] == last else 0
        starts.append((e["__part"], before))
        held, last = e["place"] + 1 + (before if e["one"] else 0), e["last"]
    if not starts:
        return dealt.drop("__part", "__head", "__row")
    offsets = F.broadcast(nodes.sparkSession.createDataFrame(starts, "__part int, __before long"))
    out = kept(dealt.join(offsets, "__part").withColumn("at", F.col("at") + F.when(F.col("__head"), F.col("__before")).otherwise(0)).drop("__part", "__head", "__row", "__before"))
    forget(dealt)
    return out


def climb(nodes: list[str], levels: int, paths: list[list] | None = None) -> str:
    """The digest of an aligned block of nodes, `levels` up; each node's siblings, as (left, right) a level, are appended to its path, if paths are asked for."""

    def subtree(at: int, level: int) -> str:
        if not level:
            return nodes[at]
        width = FANOUT ** (level - 1)
        places = range(at, min(at + FANOUT * width, len(nodes)), width)
        children = [subtree(place, level - 1) for place in places]
        if paths is not None:
            for k, place in enumerate(places):
                step = ("".join(children[:k]), "".join(children[k + 1 :]))
                for path in paths[place : place + width]:
                    path.append(step)
        return digest("".join(children))

    return subtree(0, levels)


def height(block: int, n: int) -> int:
    """Levels of a block of n nodes: all, but for a group's only block, which ends when one node is left."""
    levels = BLOCK_LEVELS
    while not block and levels and FANOUT ** (levels - 1) >= n:
        levels -= 1
    return levels


def fold(start: str, path: list) -> str:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        start = digest(left + start + right)
    return start


def _blocks(rows, n_group: int):
    """(group, block, rows) of sorted rows (*group, block, at, ...), a block at a time."""
    now, held = None, []
    for row in rows:
        if row[: n_group + 1] != now:
            if held:
                yield now[:-1], now[-1], held
            now, held = row[: n_group + 1], []
        held.append(row[n_group + 1 :])
    if held:
        yield now[:-1], now[-1], held


def _dealt(nodes: DataFrame, group: list[str]) -> DataFrame:
    """Nodes in blocks: each block's rows in one task, in order."""
    own = nodes.repartition(*group, "block").sortWithinPartitions(*group, "block", "at")
    return own.select(*group, "block", "at", *(c for c in nodes.columns if c not in (*group, "block", "at")))


def _block() -> Column:
    return F.floor(F.col("at") / FANOUT**BLOCK_LEVELS).cast("long").alias("block")


def _up(nodes: DataFrame, group: list[str]) -> DataFrame:
    """The roots of the blocks of nodes (*group, at, digest), as nodes."""
    n_group, given = len(group), nodes.select(*group, _block(), "at", "digest")
    schema = StructType([*(given.schema[c] for c in group), StructField("at", LongType()), StructField("digest", StringType())])

    def kernel(batches):
        out = []
        for key, block, held in _blocks(_rows(batches), n_group):
            out.append((*key, block, climb([row[1] for row in held], height(block, len(held)))))
            if len(out) == 1000:
                yield _batch(out, names)
                out = []
        if out:
            yield _batch(out, names)

    names = [(f.name, pa.int64() if isinstance(f.dataType, LongType) else pa.string()) for f in schema]
    return kept(_dealt(given, group).mapInArrow(kernel, schema))


def _batch(rows: list, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, (_, kind) in zip(zip(*rows), columns)], names=[name for name, _ in columns])


def _down(nodes: DataFrame, above: DataFrame, group: list[str], made: list, result) -> DataFrame:
    """`result(row, path, of)` of every node row (at, digest, other columns), with its path up to the root and the struct `of` of its block.

    above has (*group, at, path, of) of the nodes a traversal up; it comes before the block's rows, whose path it goes on.
    """
    n_group, rest = len(group), [c for c in nodes.columns if c not in (*group, "at")]
    given = nodes.select(*group, _block(), "at", *rest, F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast(above.schema["of"].dataType).alias("of"))
    first = above.select(*group, F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), *(F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in rest), "path", "of")
    schema = StructType([*(nodes.schema[c] for c in group), *(f for f, _ in made)])
    names = [*((c, pa.string()) for c in group), *((f.name, kind) for f, kind in made)]

    def kernel(batches):
        out = []
        for key, block, (top, *held) in _blocks(_rows(batches), n_group):
            on, of = [(s["left"], s["right"]) for s in top[-2]], top[-1]
            paths = [[] for _ in held]
            climb([row[1] for row in held], height(block, len(held)), paths)
            for row, path in zip(held, paths):
                out.append((*key, *result(row, path + on, of)))
                if len(out) == 1000:
                    yield _batch(out, names)
                    out = []
        if out:
            yield _batch(out, names)

    return _dealt(given.unionByName(first), group).mapInArrow(kernel, schema)


def _steps(path: list) -> list:
    return [{"left": left, "right": right} for left, right in path]


def _tree(nodes: DataFrame, group: list[str]) -> list[DataFrame]:
    """Nodes (*group, at, digest, ...), their blocks' roots, and so on until every group has one."""
    levels = [nodes, _up(nodes, group)]
    while levels[-1].where("at > 0").limit(1).count():
        levels.append(_up(levels[-1], group))
    return levels


def _paths(levels: list[DataFrame], top: DataFrame, group: list[str]) -> DataFrame:
    """From the paths of the last level (*group, at, path, of), those of the level above the first."""
    of = top.schema["of"]
    made = [(StructField("at", LongType()), pa.int64()), (StructField("path", _PATH), _PATH_ARROW), (of, pa.struct([(f.name, pa.string()) for f in of.dataType]))]
    for nodes in levels[-2:0:-1]:
        before, top = top, kept(_down(nodes, top, group, made, lambda row, path, of: (row[0], _steps(path), of)))
        forget(before)
    return top


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of documents.

    proof_sha256 is the hash of a leaf's siblings, level by level and left to right. folded_root is made anew from the
    leaf, of the `tampered` text where that is not null, and the siblings; verified: whether it is the root.
    """
    small_batches(docs.sparkSession, 5000)
    own = kept(leaves(docs, tampered))
    numbered = _numbered(own.withColumn("tie", F.monotonically_increasing_id()), ["source"], ["doc_id", "leaf", "tie"])  # the tie divides a group of equal rows
    nodes = numbered.select("source", "at", F.col("leaf").alias("digest"), "doc_id", "other")
    levels = _tree(nodes, ["source"])
    subroots = levels[-1].select("source", "digest")
    over = _tree(_numbered(subroots, [], ["source"]), [])
    root = (over[-1].first() or [None, None])[1]
    text = lambda name: (StructField(name, StringType()), pa.string())
    top = over[-1].select("at", F.array().cast(_PATH).alias("path"), F.struct(F.col("digest").alias("root")).alias("of"))
    top = _paths(over, top, [])
    made = [text("source"), (StructField("at", LongType()), pa.int64()), (StructField("path", _PATH), _PATH_ARROW), (StructField("of", StructType([StructField("subroot", StringType())])), pa.struct([("subroot", pa.string())]))]
    top = kept(_down(over[0].select("at", "digest", "source"), top, [], made, lambda row, path, of: (row[2], 0, _steps(path), {"subroot": row[1]})))
    above = _paths(levels, top, ["source"])
    of_row = [(nodes.schema["doc_id"], to_arrow_type(nodes.schema["doc_id"].dataType)), *map(text, ("leaf", "subroot", "root", "proof_sha256", "folded_root")), (StructField("verified", BooleanType()), pa.bool_())]

    def result(row, path, of):
        _, own, doc_id, other = row[:4]
        proof = digest("".join(left + right for left, right in path))
        folded = fold(other or own, path)
        return doc_id, own, of["subroot"], root, proof, folded, folded == root

    out = kept(_down(nodes, above, ["source"], of_row, result).drop("source"))
    forget(own, numbered, above, *levels[1:], *over)
    return out
