"""The helpers that the operators share."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest

from tillandsia.llm._common import Scratch, _with_least, connected_components, shared_root


def fake(master, conf=None):
    context = SimpleNamespace(master=master, applicationId=f"app {master}")
    return SimpleNamespace(conf=conf or {}, sparkContext=context)


def test_scratch_folder_of_the_session_wins():
    for master in ("local[8]", "spark://host:7077", "yarn", "local-cluster[3,2,1000]"):
        assert shared_root(fake(master, {"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://h", "local-cluster[3,2,1000]"])
def test_several_machines_need_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(fake(master))


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4,3]"])
def test_one_machine_needs_none(master):
    root = shared_root(fake(master))
    assert root.startswith("file:///") and shared_root(fake(master)) == root


def test_sessions_setting_stays_unset(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert Scratch(spark, "x").path.startswith((before or "file:///").rstrip("/"))
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def components_of(edges):
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}


def test_components_equal_a_plain_version(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1000, 1040)]
    star = [(5, i) for i in range(2000, 2300)] + [(2299, 9), (9, 9), (9, 2299)]
    low_hub = [(i, 4000) for i in range(3000, 3200)]  # the hub is the largest of its component
    edges = chain + star + low_hub + [(rng.randint(1, 60), rng.randint(1, 60)) for _ in range(40)] + [(7000, 7000)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(6)
    got = {r.node: r.root for r in connected_components(df, Scratch(spark, "t"), "c").collect()}
    want = components_of([e for e in edges if e[0] != e[1]])
    assert got == want
    assert connected_components(df.limit(0), Scratch(spark, "t"), "c").collect() == []
    # nodes with over 2n / 16 rows are dealt to several tasks; the result is the same
    salted = connected_components(df, Scratch(spark, "t"), "s", salt_edges=1, hot_nodes=16).collect()
    assert sorted((r.node, r.root) for r in salted) == sorted(want.items())


def test_rows_of_a_hot_node_are_dealt_out(spark):
    rows = [(1, i) for i in range(10, 1010)] + [(2, 5), (2, 7), (3, 9)]
    df = spark.createDataFrame(rows, "u bigint, v bigint").repartition(4)
    want = sorted((u, v, {1: 10, 2: 5, 3: 9}[u]) for u, v in rows)
    for most in (None, 1, 100, 5000):
        assert sorted(map(tuple, _with_least(df, most).collect())) == want
    plan = _with_least(df, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan
