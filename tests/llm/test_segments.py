"""Segments of token ids: symbols are numbered without a sort of all ids."""

import numpy as np
import pytest

pytest.importorskip("songweave.llm.ans")

from songweave.llm import ans  # noqa: E402


def test_ids_of_a_vocabulary_are_not_sorted(monkeypatch):
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 50_000, n).astype(np.int32) for n in (1, 70_000, 3)]
    before = ans.pack_segment([1, 2, 3], ids)

    def refuse(*_, **__):
        raise AssertionError("all ids of a segment were sorted")

    with monkeypatch.context() as patched:
        patched.setattr(np, "unique", refuse)
        assert ans.pack_segment([1, 2, 3], ids) == before
    for got, given in zip(ans.Segment(before).documents(), ids):
        assert got.tolist() == given.tolist()


@pytest.mark.parametrize("ids", [[], [0], [7, 7, 2, 9, 2], [5, ans.SEGMENT_IDS, 5], [3, 2**31 - 1]])
def test_numbers_are_those_of_a_sort(ids):
    ids = np.array(ids, np.int64)
    for got, expected in zip(ans.numbered(ids), np.unique(ids, return_inverse=True, return_counts=True)):
        assert got.tolist() == expected.tolist()
