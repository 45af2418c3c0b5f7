"""The Merkle manifest against a plain version, for several fan-outs."""

import hashlib

import pytest
from pyspark.sql import functions as F

from folkmeter.llm import merkle

COLUMNS = ["doc_id", "lang", "text"]
SCHEMA = "doc_id bigint, lang string, text string, tree string, idx string, leaf string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, fanout):
    """Root, and per leaf the (before, after) of each height."""
    paths, level, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        nodes, below = [], []
        for at in range(0, len(level), fanout):
            run = level[at : at + fanout]
            for i in range(len(run)):
                for one in under[at + i]:
                    paths[one].append(("".join(run[:i]), "".join(run[i + 1 :])))
            nodes.append(sha(*run))
            below.append(sum(under[at : at + fanout], []))
        level, under = nodes, below
    return level[0], paths


def plain(rows, fanout):
    trees = {}
    for doc_id, lang, text in rows:
        trees.setdefault(lang, []).append((doc_id is not None, doc_id, sha(field(doc_id), field(lang), field(text))))
    keys = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    roots, found = [], []
    for key in keys:
        leaves = sorted(trees[key], key=lambda x: (x[0], x[1] or 0, x[2]))
        root, paths = plain_tree([h for *_, h in leaves], fanout)
        roots.append(root)
        found += [(i, key, h, root, p) for (_, i, h), p in zip(leaves, paths)]
    root, upper = plain_tree(roots, fanout)
    place = {k: p for k, p in zip(keys, upper)}
    return sorted(
        (str((i, h, sub, root, [tuple(x) for x in p + place[k]])) for i, k, h, sub, p in found)
    )


def found(rows):
    return sorted(
        str((r.doc_id, r.leaf, r.subroot, r.root, [(p.before, p.after) for p in r.path])) for r in rows.collect()
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(5)


def build(docs, fanout):
    return merkle.manifest(docs, COLUMNS, "lang", ["doc_id"], {"doc_id": F.col("doc_id")}, fanout)


ODD = [
    (1, "en", "A"), (2, None, None), (3, "", ""), (None, "en", "no id"), (None, "en", None), (5, "en", "same"),
    (5, "en", "same"), (5, "en", "other"), (6, "é", "x" * 100_000), (7, "zz", "alone"), (-1, "en", "negative"),
]


@pytest.mark.parametrize("fanout", [2, 8])
def test_equals_the_plain_version(spark, fanout):
    rows = ODD + [(i, f"l{i % 3}", f"text {i}") for i in range(100, 231)]
    assert found(build(frame(spark, rows), fanout)) == plain(rows, fanout)


@pytest.mark.parametrize("n", [8, 65])
def test_one_tree_of_odd_sizes(spark, n):
    rows = [(i, "en", f"t{i}") for i in range(n)]
    assert found(build(frame(spark, rows), 8)) == plain(rows, 8)


def test_many_trees(spark):
    rows = [(i, f"k{i % 70}", f"t{i}") for i in range(150)]
    assert found(build(frame(spark, rows), 8)) == plain(rows, 8)


@pytest.fixture(scope="module")
def odd(spark):
    return build(frame(spark, ODD), 8).cache()


def test_tampering_shows_and_an_honest_leaf_folds_to_the_root(odd):
    rows = odd
    honest = rows.withColumn("end", merkle.fold("leaf"))
    assert honest.filter("end != root").count() == 0
    false = rows.withColumn("bad", F.sha2("leaf", 256)).withColumn("end", merkle.fold("bad"))
    assert false.filter("end = root").count() == 0


def test_digest_of_the_proof(odd):
    for r in odd.withColumn("proof", merkle.proof()).collect():
        assert r.proof == sha(*[p.before + p.after for p in r.path])


def test_empty_table(spark):
    assert build(spark.createDataFrame([], SCHEMA), 8).collect() == []


def test_a_level_is_dealt_once(spark):
    """The joins with the seven siblings take no exchange of their own."""
    nodes = spark.range(100).select(
        F.col("id").cast("string").substr(1, 1).alias("tree"), F.col("id").alias("idx"), F.lit(100).cast("bigint").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("hash"),
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with merkle._joins_by_part_of_the_keys(spark):
            plan = merkle._siblings(nodes, [], 8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Join [") == 7
    assert plan.count("ENSURE_REQUIREMENTS") == 0
