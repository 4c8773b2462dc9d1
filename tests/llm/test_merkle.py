"""The manifest against a tree built in one go, and witnesses against their roots."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from cohortweave.llm import merkle
from cohortweave.llm.common import prepare

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, text):
    def told(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    return h(*map(told, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def tree(nodes):
    """Levels from the nodes up to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, pos):
    """Per level the place and the other nodes of the run."""
    out = []
    for nodes in levels[:-1]:
        start = pos // 16 * 16
        out.append((pos - start, nodes[start:pos] + nodes[pos + 1 : start + 16]))
        pos //= 16
    return out


def lower(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    """Rows of `audit`, by plain recursion over whole lists."""
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), i) for i, r in enumerate(sources[s])) for s in names}
    trees = {s: tree([key[2] for key, _ in leaves[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for pos, ((_, _, own), i) in enumerate(leaves[s]):
            row = sources[s][i]
            steps = way(trees[s], pos) + way(top, at)
            shown = own
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                shown = leaf(row, lower(row["text"]))
            for place, others in steps:
                shown = h(*others[:place], shown, *others[place:])
            proof = h(*(x for _, others in steps for x in others))
            out.append((row["doc_id"], own, trees[s][-1][0], top[-1][0], proof, shown, shown == top[-1][0]))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, merkle.audit(docs, merkle.lower_cased).collect()), key=repr)


def test_audit_matches_a_tree_built_in_one_go(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    rows = found(docs)
    assert rows == expected(docs.collect())
    assert 0 < sum(not r[-1] for r in rows) < len(rows) / 3


def test_several_appends_many_sources_and_a_hot_one(spark):
    hot = F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 351))
    docs = prepare(spark).range(7_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.lit("en").alias("lang"), hot.alias("source"), F.lit(7).alias("n_chars")
    )
    assert found(docs) == expected(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 4_097])
def test_one_block_holds_the_witness_of_each_run(n):
    nodes = [h(str(i)) for i in range(n)]
    levels = tree(nodes)
    block = merkle.Block(len(levels) - 1)
    for node in nodes:
        block.append(node, ())
    root = block.root()
    assert root == levels[-1][0]
    for number, (members, steps) in enumerate(zip(block.runs, block.witness, strict=True)):
        for at, (node,) in enumerate(members):
            own = "".join(m for i, (m,) in enumerate(members) if i != at)
            places, siblings = [p for p, _ in steps], [s for _, s in steps]
            if n > 1:
                places, siblings = [at, *places], [own, *siblings]
            assert merkle.fold(node, places, siblings) == root
            assert [(p, "".join(o)) for p, o in way(levels, 16 * number + at)] == list(zip(places, siblings))


def test_proofs_lead_to_the_root_and_others_do_not(spark):
    docs = prepare(spark).read.parquet(f"{SF}/documents.parquet")
    rows = merkle.proofs(docs).collect()
    assert len(rows) == docs.count() and len({r["root"] for r in rows}) == 1
    for r in rows:
        assert merkle.fold(r["leaf"], r["places"], r["siblings"]) == r["root"]
        assert merkle.fold(h(r["leaf"]), r["places"], r["siblings"]) != r["root"]


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    long_text = "Word " * 200_000
    rows = [(1, None, None, None, None), (None, "Alone", "en", "s", 3), (None, None, None, None, None), (2, "", "en", None, 0), (5, "X", None, "s", 1)]
    rows += [(4, long_text, "en", "s", 9)] * 40 + [(4, "Other", "en", "s", 9), (7, "é A", "fr", "ü", 3), (8, "B", "fr", "", 1)]
    docs = prepare(spark).createDataFrame(rows, DOCS)
    wider = docs.withColumns({c: F.lit("mine") for c in ("grp", "pos", "tie", "node", "places", "root", "_part", "n", "first")})
    assert found(wider) == expected(docs.collect())


def test_one_row_and_none(spark):
    docs = prepare(spark).createDataFrame([(10, "A", "en", "s", 1)], DOCS)
    assert found(docs) == expected(docs.collect())
    assert found(docs)[0][4] == h("")
    assert found(docs.limit(0)) == [] and merkle.proofs(docs.limit(0)).count() == 0
