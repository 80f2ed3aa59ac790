"""Operator 11 against a plain Merkle tree."""

import hashlib
import os
import sys
import zlib

import pytest
from pyspark.sql import functions as F

from boxstats.llm import merkle, queries

sys.path.insert(0, os.path.dirname(__file__))
from helpers import HARD, documents  # noqa: E402

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout):
    """(root, path of each leaf)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, w in zip(paths, where):
            run = nodes[w // fanout * fanout:w // fanout * fanout + fanout]
            path.append(("".join(run[:w % fanout]), "".join(run[w % fanout + 1:])))
        where = [w // fanout for w in where]
        nodes = [digest(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain(rows, fanout):
    """{(id, leaf): (subroot, root, path)}; ``rows``: tuples of COLUMNS."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], digest(*map(field, r))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        found[g] = tree([leaf for _, leaf in groups[g]], fanout)
    root, tops = tree([found[g][0] for g in order], fanout)
    out = []
    for g, top in zip(order, tops):
        out += [(i, leaf, found[g][0], root, path + top)
                for (i, leaf), path in zip(groups[g], found[g][1])]
    return out


def rows_of(df):
    return [(r["id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]])
            for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


@pytest.mark.parametrize("fanout, levels", [(2, 10), (2, 2), (3, 1)])
def test_equals_a_plain_tree(spark, fanout, levels):
    """One group holds most rows, one a single row; a block of 4 or 3 rows takes several steps."""
    rows = [(i * 3, f"s{i}", (None, "é", "z", "hot", "hot", "hot", "hot")[i % 7], i, f"text {i}")
            for i in range(150)] + [(5, "s", "only", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, "
                                       "text string").repartition(5)
    got = rows_of(merkle.manifest(docs, COLUMNS, fanout=fanout, levels=levels))
    assert order(got) == order(plain(rows, fanout))


def test_hard_rows(spark):
    """Nulls everywhere, repeated ids with other and with equal rows, columns named as its own."""
    langs = [("en", None, "", "fr")[i % 4] for i in range(len(HARD))]
    docs = documents(spark, HARD, langs=langs)
    docs = docs.unionByName(docs.limit(4)).unionByName(docs.withColumn("doc_id", F.lit(1).cast("long")))
    docs = docs.withColumns({c: F.lit("x") for c in ("g", "node", "idx", "n", "at", "path")})
    rows = [tuple(r[c] for c in COLUMNS) for r in docs.collect()]
    found = merkle.manifest(docs, COLUMNS, carry=("key",))
    assert order(rows_of(found)) == order(plain(rows, 2))
    assert {r["key"] for r in found.select("carried.key").collect()} == {"x"}
    folded = found.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    assert all(r["ok"] for r in folded.collect())


def test_one_row_and_none(spark):
    docs = documents(spark, ["a"])
    (row,) = merkle.manifest(docs, COLUMNS).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["path"] == []
    empty = merkle.manifest(docs.limit(0), COLUMNS)
    assert empty.collect() == [] and "path" in empty.columns


def test_one_exchange_and_one_sort_a_step(spark):
    nodes = spark.createDataFrame([("a", i, 9, f"{i:064}") for i in range(9)],
                                  "g string, idx long, n long, node string")
    plan = merkle.block_roots(nodes, 2, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_query_tells_tampered_rows(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op11_merkle_manifest(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS).collect()
    want = {r[0]: r for r in plain([tuple(r) for r in docs], 2)}
    size = {r["doc_id"]: r for r in docs}
    assert len(got) == len(docs)
    for r in got:
        i, leaf, subroot, root, path = want[r["doc_id"]]
        tampered = zlib.crc32(str(i).encode()) % 7 == 0 and size[i]["n_chars"] is not None
        node = digest(*[field(size[i][c] + (c == "n_chars" and tampered) if c == "n_chars"
                              and tampered else size[i][c]) for c in COLUMNS])
        for left, right in path:
            node = digest(left, node, right)
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, subroot, root)
        assert r["proof_sha256"] == digest(*[x + y for x, y in path])
        assert r["folded_root"] == node and r["verified"] is (not tampered)
