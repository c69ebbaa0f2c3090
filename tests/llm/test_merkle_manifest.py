"""The manifest against a plain tree: nulls, ties, repeated rows, one-leaf sources, several links, clashing names."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cyclonespark.llm import merkle_manifest as M

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, pos int, node string, digest string, up int, _salt int, size int"


def _sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n):
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)))


def _levels(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([_sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def _climb(levels, i, digest, proof):
    for level in levels[:-1]:
        run, o = level[i - i % 3 : i - i % 3 + 3], i % 3
        proof += run[:o] + run[o + 1 :]
        digest = _sha("".join([*run[:o], digest, *run[o + 1 :]]))
        i //= 3
    return digest


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
    trees = {s: _levels([_leaf(*r) for r in sources[s]]) for s in names}
    top = _levels([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (doc_id, text, *rest) in enumerate(sources[s]):
            if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            proof = []
            folded = _climb(trees[s], i, _leaf(doc_id, text, *rest), proof)
            folded = _climb(top, at, folded, proof)
            root = top[-1][0]
            out.append((doc_id, trees[s][0][i], trees[s][-1][0], root, _sha("".join(proof)), folded, folded == root))
    return out


def _rows(n, sources):
    rng = random.Random(n)
    texts = [None, "", "a\nb", "é\n日本", "plain", "x" * 50_000 + "\n", "\n\n"]
    rows = [(i, rng.choice(texts), rng.choice(["en", None]), rng.choice(sources), rng.choice([None, -3, 7])) for i in range(n)]
    return rows + [rows[0]] * 5 + [(None, "no id\n", None, sources[0], 1), (None, "no id", None, sources[0], 1), (3, "tie", "en", rows[-1][3], 2), (-5, "alone\n", "en", "Ω alone", 2)]


@pytest.mark.parametrize(("levels", "n", "sources"), [(1, 70, ["hot"] * 5 + ["b", "é", None]), (2, 100, [f"s{i}" for i in range(30)]), (6, 3, [None])])
def test_manifest(spark, monkeypatch, levels, n, sources):
    monkeypatch.setattr(M, "LEVELS", levels)
    rows = _rows(n, sources)
    docs = spark.createDataFrame([(*r, "k", 1, "n", "d", 2, 3, 4) for r in rows], DOCS).repartition(3)
    got = M.verify(docs, M.tampered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, brute(rows)))
    whole = M.verify(docs).collect()
    assert len(whole) == len(rows) and all(r.verified for r in whole)


def test_one_leaf_and_none(spark):
    one = spark.createDataFrame([(5, "t\n", "en", "s", 2)], ", ".join(DOCS.split(", ")[:5]))
    row = M.verify(one).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == _sha("") and row.verified
    assert M.verify(one.filter("doc_id < 0")).count() == 0


def test_a_changed_leaf_is_found(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(30)], ", ".join(DOCS.split(", ")[:5]))
    forged = F.when(F.col("doc_id") == 17, F.lit("text 71")).otherwise(F.col("text"))
    assert [r.doc_id for r in M.verify(docs, forged).filter("NOT verified").collect()] == [17]
