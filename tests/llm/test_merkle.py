"""The Merkle manifest against a plain one, and on odd input."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from gaugeflow.llm import merkle
from gaugeflow.llm.common import table

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree long, size long, steps string, digest string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    shown = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]]
    return digest("".join(shown))


def climb(nodes, proofs):
    """The top of a tree over (digest, places below), collecting for each place the digests around it."""
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), 16):
            run = nodes[i : i + 16]
            for j, (_, below) in enumerate(run):
                for place in below:
                    proofs[place].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((digest("".join(d for d, _ in run)), [p for _, below in run for p in below]))
        nodes = above
    return nodes[0]


def lowered(text):
    return None if text is None else text.translate({c: c + 32 for c in range(65, 91)})


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root and whether it is the root, of every row."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf(rows[i])))
    proofs, subroots = {i: [] for i in order}, {}
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        subroots[name] = climb([(leaf(rows[i]), [i]) for i in order if rows[i][1] == name], proofs)
    root = climb([subroots[n] for n in names], proofs)[0]
    found = []
    for i in order:
        doc_id, source, lang, n_chars, text = rows[i][:5]
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        own = leaf((doc_id, source, lang, n_chars, lowered(text))) if hit else leaf(rows[i])
        for left, right in proofs[i]:
            own = digest(left + own + right)
        proof = digest("".join(a + b for a, b in proofs[i]))
        found.append((doc_id, leaf(rows[i]), subroots[source][0], root, proof, own, own == root))
    return found


def both(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x", "y") for r in rows], DOCS)
    got = merkle.verify(merkle.manifest(df))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr), sorted(plain(rows), key=repr)


def test_manifest_equals_a_plain_one(spark, monkeypatch):
    """A hot source of three levels, sources of one, 16, 17 and 33 rows, more than 16 sources, nulls, ties."""
    monkeypatch.setattr(merkle, "BLOCK", 50)
    rng = random.Random(5)
    rows, sizes = [], [290, 1, 16, 17, 33, *[1] * 13]
    for k, size in enumerate(sizes):
        source = None if k == 3 else f"{'é' if k % 2 else 's'}{k}"
        for _ in range(size):
            text = "".join(rng.choice("aAbB é漢") for _ in range(rng.randrange(20)))
            rows.append((len(rows) * 7 % 401, source, rng.choice(["en", None]), rng.choice([None, len(text)]), text or None))
    rows += [(None, "s0", None, None, None), (None, "s0", "en", 1, "A"), (None, None, None, None, "Q"), rows[5], rows[5]]
    rows += [(rows[9][0], rows[9][1], "xx", 3, "other"), (-12, "", "", 0, ""), (10**15, "s0", "en", 5, "A" * 200_000)]
    got, expected = both(spark, rows)
    assert got == expected
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [1, 2, 16, 17, 256, 257])
def test_one_source_of_each_depth(spark, rows):
    got, expected = both(spark, [(i, "s", "en", 1, f"T{i}") for i in range(rows)])
    assert got == expected


def test_one_row_a_source(spark):
    got, expected = both(spark, [(1, f"s{i}", "en", 1, f"T{i}") for i in range(40)])
    assert got == expected


def test_steps_are_the_proof(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", 1, f"T{i}", 1, 2, "x", "y") for i in range(60)], DOCS)
    for row in merkle.manifest(docs).collect():
        own = row.leaf
        for step in row.steps:
            own = digest(step.left + own + step.right)
        assert own == row.root
    assert merkle.verify(merkle.manifest(spark.createDataFrame([], DOCS))).collect() == []


def test_agrees_with_sql(spark):
    """The registered SQL on the smallest table."""
    duckdb = pytest.importorskip("duckdb")
    from gaugeflow.llm.sql import ORACLES

    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    try:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    except duckdb.IOException:
        pytest.skip("given tables not found")
    got = merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))
    assert sorted(map(tuple, got.collect())) == sorted(con.sql(ORACLES["op12_manifest"]).select(*got.columns).fetchall())
