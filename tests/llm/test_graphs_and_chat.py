"""Graph search among near and parallel vectors and over shards; long conversations."""

import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from songweave.llm import ann, chat, queries  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, id long, shard int, dim int, score string"


def searched(spark, vectors, monkeypatch, shard_rows=10**6, more=()):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    rows = [(i, v.tolist(), 1, 2, 3, "x") for i, v in enumerate(vectors)] + list(more)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(queries.common, "read_table", lambda *_: frame)
    found = {}
    for r in queries.op1_graph_search(spark, "").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in found.items()}


def cosines(vectors, q):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    score = unit @ unit[q]
    score[q] = -2
    return score


def test_parallel_vectors_tie_by_id(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 16))
    group = np.arange(100, 140)
    vectors[group] = vectors[100] * 2.0 ** np.arange(-20, 20)[:, None]
    got = searched(spark, vectors, monkeypatch)
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105]
    assert all(abs(s - 1) < 1e-15 for _, s in got[100])


@pytest.mark.parametrize("noise", [1e-2, 1e-3, 1e-4, 1e-5])
def test_near_copies_are_all_reached(spark, monkeypatch, noise):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 32)).astype("f4").astype(float)
    group = np.arange(0, 1500, 5)  # a fifth of the rows, and all queries
    vectors[group] = (vectors[0] * (1 + noise * rng.normal(size=(len(group), 32)))).astype("f4")
    got = searched(spark, vectors, monkeypatch)
    hits = 0
    for q in range(0, 1500, 50):
        least = np.sort(cosines(vectors, q))[-5]
        hits += sum(s >= least - 1e-13 for _, s in got[q])
    assert hits >= 0.98 * 5 * len(range(0, 1500, 50))


def test_recall_over_several_shards(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(2400, 48))
    vectors[5:800] = vectors[4]  # a third of all rows is one vector
    more = [(7, [9.0] * 48, 1, 2, 3, "x"), (2500, [1.0], 1, 2, 3, "x"), (None, [1.0] * 48, 1, 2, 3, "x")]
    got = searched(spark, vectors, monkeypatch, shard_rows=600, more=more)
    hits = 0
    for q in range(0, 2400, 50):
        score = cosines(vectors, q)
        least = np.sort(score)[-5]
        hits += sum(s >= least - 1e-13 for _, s in got[q])
    assert hits >= 0.95 * 5 * 48
    assert [i for i, _ in got[50]] == [4, 5, 6, 7, 8]
    assert 2500 not in got


def test_leaders_are_apart_and_near_their_rows():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1, 8)) + rng.normal(size=(2500, 8)) * 0.01
    points = ann.unit(points)
    lead, node = ann.leaders(points)
    assert ((points * points[lead][node]).sum(1) >= ann.NEAR - 1e-12).all()
    between = points[lead] @ points[lead].T
    np.fill_diagonal(between, 0)
    assert between.max() < ann.NEAR and len(lead) < 2500
    assert (node[lead] == np.arange(len(lead))).all()


def test_examples_carry_the_loss(spark, monkeypatch):
    """The query's loss comes from the examples: without them there is none."""
    rng = random.Random(5)
    long = "".join(rng.choices("ab <|\\é😀\n", k=300_000))
    turns = [(1, i, "user" if i % 2 else "assistant", f"{long[i * 100 : i * 150 + 100]}") for i in range(120)]
    turns += [(2, 0, "user", long), (2, 1, "assistant", long), (None, 1, "assistant", "x")]
    frame = spark.createDataFrame(
        [(*t, 1, 2, 3) for t in turns],
        "conv_id long, turn long, role string, text string, target_start long, at long, conv long",
    )
    segments = chat.expand(frame)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    for conv in (1, 2, None):
        loss = "".join(t[3] for t in turns if t[0] == conv and t[2] == "assistant")
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    made = chat.render(segments, segments.where("conv_id = 2 and example is not null"))
    assert got[2]["expanded_chars"] == sum(len(r["text"]) for r in made.collect())
    monkeypatch.setattr(chat, "examples", lambda s, real=chat.examples: real(s).where("example < 0"))
    none = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    assert none[2]["loss_chars"] == 0 and none[2]["turns_sha256"] == got[2]["turns_sha256"]
