"""The Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from songweave.llm import merkle, queries  # noqa: E402

DOCS = (
    "doc_id long, source string, lang string, n_chars long, text string, "
    "tree int, node string, pos int, proof string, t int"
)


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climbed(nodes):
    """The top of a tree and each leaf's (before, after) a level."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            start = a // 8 * 8
            run = nodes[start : start + 8]
            steps[i].append(("".join(run[: a - start]), "".join(run[a - start + 1 :])))
        nodes = [digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], steps


def brute(rows):
    trees = {}
    for doc, source, lang, n, text in rows:
        leaf = own = digest(*map(written, (doc, source, lang, n, text)))
        if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and text is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            own = digest(*map(written, (doc, source, lang, n, low)))
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, own))
    tops = []
    for lang in sorted(trees, key=lambda x: (x is not None, (x or "").encode())):
        leaves = sorted(trees[lang])
        tops.append((*climbed([x[2] for x in leaves]), leaves))
    root, upper = climbed([t[0] for t in tops])
    out = []
    for (subroot, steps, leaves), above in zip(tops, upper):
        for (named, doc, leaf, own), within in zip(leaves, steps):
            node, path = own, within + above
            for before, after in path:
                node = digest(before, node, after)
            flat = digest(*[b + a for b, a in path])
            out.append((doc if named else None, leaf, subroot, root, flat, node, node == root))
    return out


def odd_rows():
    rng = random.Random(4)
    rows = [(i, "s", "aa", 3, f"Text {i}") for i in range(1300)]  # over two stored levels
    rows += [(i, "s", "bb", None, f"x{i}") for i in range(513)]
    rows += [(i, None, None, 1, "NULL lang") for i in range(65)]
    rows += [(7, "s", "cc", 1, "Same")] * 70 + [(None, "s", "cc", 1, f"no id {i}") for i in range(9)]
    rows += [(1, "s", "", 0, ""), (2, "s", "dd", 0, None), (3, "s", "é", 2, "É-É Ab" * 90_000)]
    rows += [(4, "s", "\U00010348", 1, "Z"), (5, "s", "￮", 1, "Z")]  # order by bytes
    rng.shuffle(rows)
    return rows


def ran(spark, rows, monkeypatch):
    full = [(*r, 1, "x", 2, "p", 3) for r in rows]
    frame = spark.createDataFrame(full, DOCS).repartition(5)
    monkeypatch.setattr(queries.common, "read_table", lambda *_: frame)
    return [tuple(r) for r in queries.op11_merkle_manifest(spark, "").collect()]


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def test_manifest_equals_a_plain_tree(spark, monkeypatch):
    rows = odd_rows()
    got = ran(spark, rows, monkeypatch)
    assert ordered(got) == ordered(brute(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 8, 9])
def test_small_trees(spark, monkeypatch, n):
    rows = [(i, "s", "aa", 1, f"T{i}") for i in range(n)]
    assert ordered(ran(spark, rows, monkeypatch)) == ordered(brute(rows))


def test_manifest_of_nothing(spark, monkeypatch):
    assert ran(spark, [], monkeypatch) == []


def test_stored_levels_and_chosen_proofs(spark):
    frame = spark.range(1300).select("id", F.lit("k").alias("key"), F.lit(None).alias("with_id"))
    manifest = merkle.build(frame, merkle.leaf_digest("id"), "key", ["id"], id=F.col("id"))
    counts = [level.count() for level in manifest.trees.levels]
    assert counts == [1300, 3, 1]  # every third level, and the top
    some = merkle.proofs(manifest, F.col("with_id").isin(0, 700, 1299))
    all_ = {r["id"]: r for r in merkle.proofs(manifest).collect()}
    rows = some.select("*", merkle.folded(F.col("leaf"), F.col("proof")).alias("top")).collect()
    assert sorted(r["id"] for r in rows) == [0, 700, 1299]
    assert all(r["top"] == manifest.root and r["proof"] == all_[r["id"]]["proof"] for r in rows)
    assert [len(all_[i]["proof"]) for i in (0, 1299)] == [4, 4]
