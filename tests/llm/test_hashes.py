"""Runs of bytes that polynomial hashes can't tell apart, and words between typographic signs."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from songweave.llm import common, decontaminate, jaccard, packing, queries  # noqa: E402


def alternating(letters, power):
    """The Thue-Morse word of ``2 ** power`` letters and its complement: the difference of their
    polynomials is a product of powers of two, so it vanishes modulo 2 ** 64 whatever the base."""
    bits = [bin(i).count("1") % 2 for i in range(2**power)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


PAIRS = [alternating("ab", 10), alternating("xy", 11), alternating("Ωж", 10)]


def plain_ids(text):
    from tokenizers import Tokenizer

    path = common.tokenizer_path(queries.BYTE_BPE)
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pair", PAIRS)
def test_encoder_tells_colliding_words_apart(pair):
    coder = common.Encoder(common.tokenizer_path(queries.BYTE_BPE))
    given = [*pair, f"one {pair[0]} {pair[1]}", pair[0]]
    for _ in range(2):
        assert [x.tolist() for x in coder.encode(given)] == [plain_ids(t) for t in given]


@pytest.mark.parametrize("pair", PAIRS)
def test_shingle_sets_of_colliding_words_differ(pair):
    x, y = pair
    texts = [f"{x} {x} {x}", f"{y} {y} {y}", f"{x} {y} {x} {y}"]
    sets = jaccard.text_sets([t.encode() for t in texts], 3)
    assert [len(s) for s in sets] == [1, 1, 2]
    assert len(np.unique(np.concatenate(sets))) == 4


def test_join_keeps_colliding_documents_apart(spark):
    x, y = PAIRS[0]
    rows = [(1, f"{x} {x} {x}"), (2, f"{y} {y} {y}"), (3, f"{x} {y} {x} {y}"), (4, f"{x} {x} {x}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame, 3, 90, 100).collect()}
    assert found == {1: 1, 2: 2, 3: 3, 4: 1}


def test_packing_keeps_colliding_documents_apart(spark):
    x, y = PAIRS[0]
    frame = spark.createDataFrame([(1, x), (2, y)], "doc_id long, text string")
    pieces = packing.pack(frame, common.tokenizer_path(queries.BYTE_BPE), end_id=1).collect()
    got = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        got.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], "<u4").tolist())
    assert got == {1: [*plain_ids(x), 1], 2: [*plain_ids(y), 1]}


def test_hashes_depend_on_bytes_and_length_alone():
    rng = random.Random(3)
    runs = [bytes(rng.choices(b"ab\0", k=n)) for n in [*range(1, 40), 255, 256, 257, 900] for _ in range(20)]
    hashes = {}
    for _ in range(3):
        rng.shuffle(runs)
        ends = np.cumsum([len(r) for r in runs])
        starts = ends - np.array([len(r) for r in runs])
        found = common.run_hashes(common.padded(b"".join(runs)), starts, ends)
        for run, value in zip(runs, found.tolist()):
            assert hashes.setdefault(run, value) == value
    assert len(set(hashes.values())) == len(set(runs))


def test_encoder_compares_runs_whole():
    """Runs that differ in nothing but trailing zero bytes, or after 16 bytes."""
    coder = common.Encoder(common.tokenizer_path(queries.BYTE_BPE))
    given = ["a", "a\0", "a\0\0", "b" * 16, "b" * 17, "b" * 16 + "\0", "long" * 9, "long" * 9 + "er", "é" * 8]
    for _ in range(2):
        assert [x.tolist() for x in coder.encode(given)] == [plain_ids(t) for t in given]


@pytest.mark.parametrize("text", ["a—b “foo” bar", "«a» b… foo‑bar", "a·b 。foo、bar", "a b foo bar €"])
def test_signs_beyond_ascii_part_words(text):
    (got,) = decontaminate.words_of([text])
    (want,) = decontaminate.words_of(["a b foo bar"])
    assert got.tolist() == want.tolist()


def test_letters_with_marks_stay_words():
    texts = ["क्षत्रिय नमस्ते", "étude", "naïve ٣٤ 漢字"]
    assert [len(w) for w in decontaminate.words_of(texts)] == [2, 1, 3]


def test_leak_with_typographic_signs_is_found(spark):
    item = " ".join(f"word{i}" for i in range(20))
    typed = "“" + item.replace(" ", "” — “") + "”"
    docs = spark.createDataFrame([(1, f"so {typed}…"), (2, "clean text")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    hits = decontaminate.benchmark_hits(docs, items).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"]) for r in hits] == [(1, 7, 1.0)]
