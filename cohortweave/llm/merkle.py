"""Merkle manifest of a table: aligned appends, witnesses that grow as later siblings complete."""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import written

#: Children of a node, and levels that one append (one task's block of SPAN nodes) covers.
ARITY, LEVELS = 16, 2
SPAN = ARITY**LEVELS
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_PATH = "places array<int>, siblings array<string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values: Iterable[bytes | None]) -> str:
    """The digest of the values, each `-` if null, else its length in bytes, a colon and itself."""
    made = hashlib.sha256()
    for value in values:
        if value is None:
            made.update(b"-")
        else:
            made.update(b"%d:" % len(value))
            made.update(value)
    return made.hexdigest()


#: What is shown for a row's doc_id and text (as UTF-8); None where the row is shown as it is.
Claim = Callable[[int | None, bytes | None], bytes | None]


def lower_cased(doc_id: int | None, text: bytes | None) -> bytes | None:
    """Lower-cases A-Z of every fifth row's text, by the CRC of its doc_id."""
    if doc_id is None or text is None or zlib.crc32(str(doc_id).encode()) % 5:
        return None
    return text.lower()  # of bytes: A-Z only


def leaves_of(docs: DataFrame, claim: Claim | None) -> DataFrame:
    """(grp, tie, doc_id, node, claimed): each row's leaf and the one it is claimed to have, if another is shown."""
    columns = [F.col(c).cast("string").cast("binary").alias(f"_{i}") for i, c in enumerate(FIELDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, claims = [], []
            for doc_id, *values in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
                leaves.append(leaf_of(values))
                shown = claim and claim(doc_id, values[-1])
                claims.append(None if shown is None else leaf_of([*values[:-1], shown]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(leaves, pa.string()), pa.array(claims, pa.string())], names=["grp", "tie", "doc_id", "node", "claimed"]
            )

    tie = F.xxhash64(F.monotonically_increasing_id()).alias("tie")
    read = docs.select(F.col("source").cast("string").alias("grp"), tie, F.col("doc_id").cast("long"), *columns)
    return read.mapInArrow(run, "grp string, tie long, doc_id long, node string, claimed string")


# ---- places


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `pos`, gapless from 0 within each `grp` by `order`, and `n`, the nodes of the group.

    `nodes` is a written table. Ranges of (grp, order) are counted first, so a group that holds
    most rows is ranked by all tasks; rows that are equal in all of them are told apart by `tie`.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, "grp", *order, "tie").withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "merkle-ranges")
    counts = ranged.groupBy("grp", "_part").agg(F.count("*").alias("_count"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("grp").alias("_grp"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_count").over(group).alias("n"),
    )
    inside = Window.partitionBy("grp", "_part").orderBy(*order, "tie")
    numbered = ranged.withColumn("_in", F.row_number().over(inside) - 1)
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("_part") == F.col("_p"))
    return numbered.join(starts, same).withColumn("pos", F.col("_start") + F.col("_in")).drop("_grp", "_p", "_part", "_start", "_in", "tie")


def levels_of(n: Column) -> Column:
    """Levels above n leaves: the least d with ARITY ** d >= n."""
    steps = [F.when(n > F.lit(ARITY**d), 1).otherwise(0) for d in range(15)]
    return sum(steps[1:], steps[0])


def appends_of(n: int) -> int:
    """Appends, one above the other, that a group of n leaves needs."""
    rounds = 1
    while n > SPAN:
        n, rounds = -(-n // SPAN), rounds + 1
    return rounds


# ---- one append


class Block:
    """Nodes appended in order to one aligned subtree of at most `levels` levels.

    `open` holds, per level, the completed nodes whose parent is still open, each with the runs
    of leaves below it. When a parent completes, every run below each child gets that child's
    siblings as the next step of its witness; a run's own leaves are each other's siblings.
    """

    def __init__(self, levels: int):
        self.levels = levels
        self.open: list[list[tuple[str, list[int]]]] = [[] for _ in range(levels + 1)]
        self.runs: list[list[tuple]] = []
        self.witness: list[list[tuple[int, str]]] = []

    def append(self, node: str, carried: tuple) -> None:
        if len(self.open[0]) == 0:
            self.runs.append([])
            self.witness.append([])
        self.runs[-1].append((node, *carried))
        self.open[0].append((node, [len(self.runs) - 1]))
        level = 0
        while level < self.levels and len(self.open[level]) == ARITY:
            self._complete(level)
            level += 1

    def _complete(self, level: int) -> None:
        children = self.open[level]
        nodes = [node for node, _ in children]
        if level:
            for place, (_, runs) in enumerate(children):
                step = (place, "".join(nodes[:place] + nodes[place + 1 :]))
                for run in runs:
                    self.witness[run].append(step)
        below = children[0][1] if level == 0 else [run for _, runs in children for run in runs]
        self.open[level + 1].append((digest("".join(nodes)), below))
        self.open[level] = []

    def root(self) -> str:
        """Closes the last runs, which may be shorter, up to the top."""
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return self.open[self.levels][0][0]


def append_blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Appends the nodes of each (grp, block) in order of pos; one row per run of up to 16 nodes.

    Reads grp, pos, left (levels still to build, at most LEVELS of them here), n, node and the
    columns `carried`; a block has at most SPAN nodes, so a task's state is bounded. Returns
    grp, block, left, n, top (the block's root), first (pos of the run's first node), nodes, the
    carried columns as arrays, and the run's witness up to top: places and siblings by level.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    types = {f.name: f.dataType.simpleString() for f in nodes.schema}
    dealt = (
        nodes.select("grp", F.floor(F.col("pos") / SPAN).cast("long").alias("block"), "pos", "left", "n", "node", *carried)
        .repartition(parts, "grp", "block")
        .sortWithinPartitions("grp", "block", "pos")
    )
    schema = "grp string, block long, left int, n long, top string, first long, nodes array<string>"
    schema = ", ".join([schema, *(f"{c} array<{types[c]}>" for c in carried), _PATH])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        made: list[tuple] = []
        for (grp, at), of_block in itertools.groupby(rows, key=lambda r: r[:2]):
            block = None
            for _, _, pos, left, n, node, *more in of_block:
                block = block or Block(min(left, LEVELS))
                block.append(node, more)
            root = block.root()
            for number, (members, steps) in enumerate(zip(block.runs, block.witness, strict=True)):
                first = at * SPAN + number * ARITY
                made.append((grp, at, left, n, root, first, *map(list, zip(*members)), [p for p, _ in steps], [s for _, s in steps]))
            if len(made) >= 1000:
                yield from _batches(made, arrow)
                made = []
        yield from _batches(made, arrow)

    arrow = _arrow_schema(spark, schema)
    return dealt.mapInArrow(run, schema)


def _arrow_schema(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def grow(nodes: DataFrame, carried: list[str]) -> list[DataFrame]:
    """The tree over each group's nodes: the runs of every append, leaves first.

    Roots of complete blocks are the nodes of the next append, until one block per group is left.
    """
    nodes = nodes.withColumn("left", levels_of(F.col("n")).cast("int"))
    rounds = [written(append_blocks(nodes, carried), "merkle-runs")]
    most = rounds[0].agg(F.max("n")).first()[0]
    for _ in range(appends_of(most or 0) - 1):
        roots = rounds[-1].where((F.col("left") > LEVELS) & (F.col("first") == F.col("block") * SPAN))
        above = roots.select("grp", F.col("block").alias("pos"), (F.col("left") - LEVELS).alias("left"), "n", F.col("top").alias("node"))
        rounds.append(written(append_blocks(above, []), "merkle-runs"))
    return rounds


def group_roots(rounds: list[DataFrame]) -> DataFrame:
    """(grp, node): the root of each group, found where its last append ended."""
    ended = [r.where((F.col("left") <= LEVELS) & (F.col("first") == 0)).select("grp", F.col("top").alias("node")) for r in rounds]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


# ---- witnesses from the top down


def _extended(runs: DataFrame, above: DataFrame) -> DataFrame:
    """Runs with the witness of their block, which `above` gives by (grp, pos), behind their own."""
    upper = above.select(
        F.col("grp").alias("_grp"), F.col("pos").alias("_pos"), F.col("places").alias("_places"), F.col("siblings").alias("_siblings"), "subroot"
    )
    joined = runs.join(upper, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_pos")))
    return joined.withColumns(
        {"places": F.concat("places", "_places"), "siblings": F.concat("siblings", "_siblings")}
    ).drop("_grp", "_pos", "_places", "_siblings")


def _members(runs: DataFrame, *carried: str) -> DataFrame:
    """(grp, pos, node, places, siblings, subroot, carried) of every node: its run's others, then the run's witness."""
    one = runs.select("grp", "first", "left", "nodes", "places", "siblings", "subroot", *carried, F.posexplode("nodes").alias("_at", "node"))
    others = F.concat(
        F.array_join(F.slice("nodes", F.lit(1), F.col("_at")), ""), F.array_join(F.slice("nodes", F.col("_at") + 2, F.lit(ARITY)), "")
    )
    hashed = F.col("left") > 0  # a lone node is its group's root as it is
    return one.select(
        "grp",
        (F.col("first") + F.col("_at")).alias("pos"),
        "node",
        F.when(hashed, F.concat(F.array("_at"), "places")).otherwise(F.col("places")).alias("places"),
        F.when(hashed, F.concat(F.array(others), "siblings")).otherwise(F.col("siblings")).alias("siblings"),
        "subroot",
        *[F.get(c, F.col("_at")).alias(c) for c in carried],
    )


def witnessed(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The runs of the first append with their witnesses up to what `tops` gives for each group.

    `tops` is (grp, places, siblings, subroot). Only rows of blocks and runs travel: leaves
    share their run's witness.
    """
    found = None
    for i in reversed(range(len(rounds))):
        last = rounds[i].where((F.col("left") <= LEVELS) & (F.col("first") == 0)).select(F.col("grp").alias("_g"))
        ended = tops.join(last, F.col("grp").eqNullSafe(F.col("_g")), "left_semi").withColumn("pos", F.lit(0).cast("long"))
        columns = ["grp", "pos", "places", "siblings", "subroot"]
        above = ended.select(columns) if found is None else ended.select(columns).unionByName(_members(found).select(columns))
        found = _extended(rounds[i], above)
    return found


def witnessed_runs(docs: DataFrame, claim: Claim | None = None) -> tuple[DataFrame, str | None]:
    """(runs of up to 16 leaves with their witnesses up to the root, root).

    Leaves of one source ascend by doc_id, nulls first, equal ones by leaf; subroots ascend by
    source, null first. Leaves of what `claim` shows are kept beside the true ones. Only the
    columns of FIELDS are read. No rows: no runs, and None for the root.
    """
    leaves = written(leaves_of(docs, claim), "merkle-leaves")
    rounds = grow(placed(leaves, ["doc_id", "node"]), ["doc_id", "claimed"])
    subroots = group_roots(rounds).select(
        F.lit(None).cast("string").alias("grp"), F.col("grp").alias("source"), F.col("node"), F.lit(0).alias("tie")
    )
    over = grow(placed(written(subroots, "merkle-subroots"), ["source"]), ["source"])
    root = group_roots(over).first()
    start = docs.sparkSession.createDataFrame([(None, [], [], None)], f"grp string, {_PATH}, subroot string")
    sources = _members(witnessed(over, start), "source")
    tops = sources.select(F.col("source").alias("grp"), "places", "siblings", F.col("node").alias("subroot"))
    return witnessed(rounds, tops), root and root["node"]


def fold(node: str, places: list[int], siblings: list[str]) -> str:
    """The root that a node and its witness lead to."""
    for place, others in zip(places, siblings, strict=True):
        node = digest(others[: _HEX * place] + node + others[_HEX * place :])
    return node


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, places, siblings) of every row: the manifest itself.

    `siblings` has one text per level, the other nodes of the run from left to right, and
    `places` where the row's own node stands among them; `fold` leads from leaf to root.
    """
    runs, root = witnessed_runs(docs)
    return _members(runs, "doc_id").select(
        "doc_id", F.col("grp").alias("source"), F.col("node").alias("leaf"), "subroot", F.lit(root).alias("root"), "places", "siblings"
    )


_AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def audit(docs: DataFrame, claim: Claim) -> DataFrame:
    """Each row's leaf, roots and the digest of its proof, and where the claimed row leads.

    folded_root is recomputed from the claimed leaf, or the true one where nothing is claimed,
    and the true siblings; verified tells whether it is the root. See `witnessed_runs` for
    order, nulls, repeats and empty tables.
    """
    runs, root = witnessed_runs(docs, claim)
    arrow = _arrow_schema(docs.sparkSession, _AUDIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for left, nodes, ids, claims, places, siblings, subroot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                upper = "".join(siblings)
                for at, (leaf, doc_id, claimed) in enumerate(zip(nodes, ids, claims, strict=True)):
                    beside = "".join(nodes[:at] + nodes[at + 1 :]) if left else ""
                    way = ([at, *places], [beside, *siblings]) if left else (places, siblings)
                    folded = fold(claimed or leaf, *way)
                    out.append((doc_id, leaf, subroot, root, digest(beside + upper), folded, folded == root))
            yield from _batches(out, arrow)

    return runs.select("left", "nodes", "doc_id", "claimed", "places", "siblings", "subroot").mapInArrow(run, _AUDIT)


# ---- the same in SQL


def _tree_sql(name: str, leaves: str, depth: int) -> str:
    """CTEs of a tree over `leaves` (grp, pos, n, h): {name}{k} its level k, {name}_w{k} the siblings there."""
    ctes = [f"{name}0 AS (SELECT grp, pos, n, h FROM {leaves})"]
    for k in range(depth):
        ctes.append(f"""{name}{k + 1} AS (
  SELECT grp, pos // {ARITY} AS pos, (n + {ARITY - 1}) // {ARITY} AS n, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE min(h) END AS h
  FROM {name}{k} GROUP BY grp, pos // {ARITY}, n)""")
        ctes.append(f"""{name}_w{k} AS (
  SELECT a.grp, a.pos, a.n > 1 AS hashed, a.pos % {ARITY} AS place, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos <> a.pos), '') AS others
  FROM {name}{k} a JOIN {name}{k} b ON a.grp IS NOT DISTINCT FROM b.grp AND a.pos // {ARITY} = b.pos // {ARITY} GROUP BY a.grp, a.pos, a.n)""")
    return ",\n".join(ctes)


def _fold_sql(name: str, tree: str, start: str, depth: int) -> str:
    """CTEs {name}{k}: rows of `start` (with grp, pos, proof, folded) led up through level k of a tree."""
    ctes, before = [], start
    for k in range(depth):
        ctes.append(f"""{name}{k} AS (
  SELECT s.* REPLACE (s.proof || CASE WHEN hashed THEN others ELSE '' END AS proof,
    CASE WHEN hashed THEN sha256(left(others, {_HEX} * place) || folded || substr(others, {_HEX} * place + 1)) ELSE folded END AS folded)
  FROM {before} s JOIN {tree}_w{k} w ON s.grp IS NOT DISTINCT FROM w.grp AND s.pos // {ARITY**k} = w.pos)""")
        before = f"{name}{k}"
    return ",\n".join(ctes)


def audit_sql(depth: int = 6) -> str:
    """DuckDB SQL of `audit` with `lower_cased`, for at most 16 ** depth rows of a source and sources."""

    def leaf(text: str) -> str:
        fields = [*FIELDS[:-1], text]
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in fields) + ")"

    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')]), lambda r, c : list_reduce(list_prepend(xor(r, c), range(8)), lambda x, i : CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH leaves AS (
  SELECT doc_id, source AS grp, {leaf("text")} AS h, CASE WHEN {crc} % 5 = 0 AND text IS NOT NULL THEN {leaf(lower)} END AS claimed FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM leaves
), {_tree_sql("t", "placed", depth)}, subroots AS (
  SELECT grp AS source, h, NULL AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t{depth}
), {_tree_sql("s", "subroots", depth)}, shown AS (
  SELECT doc_id, grp, pos, h AS leaf, '' AS proof, coalesce(claimed, h) AS folded FROM placed
), {_fold_sql("f", "t", "shown", depth)}, over_sources AS (
  SELECT f.doc_id, f.leaf, r.h AS subroot, r.grp, r.pos, f.proof, f.folded
  FROM f{depth - 1} f JOIN subroots r ON f.grp IS NOT DISTINCT FROM r.source
), {_fold_sql("g", "s", "over_sources", depth)}
SELECT doc_id, leaf, subroot, root.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root.h AS verified
FROM g{depth - 1}, (SELECT h FROM s{depth}) AS root
"""
