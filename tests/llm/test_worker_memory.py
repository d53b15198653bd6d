"""What a Python worker holds follows what it has met, not the largest it may meet."""

import ctypes
import random
import re
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from songweave.llm import common, jaccard
from songweave.llm.queries import BYTE_BPE


def test_an_encoders_table_grows_with_the_runs_it_has_met():
    coder = common.Encoder(common.tokenizer_path(BYTE_BPE))

    def held() -> int:
        return coder.low.nbytes + coder.high.nbytes + coder.places.nbytes

    coder.encode(["a few words"])
    assert held() < 1 << 20
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(30_000):x}" for _ in range(400)) for _ in range(60)]
    for at in range(0, len(texts), 20):
        coder.encode(texts[at : at + 20])
    met = np.count_nonzero(coder.places)
    assert met > 1 << 13 and 2 * met <= len(coder.places) <= 8 * met
    want = [x.ids for x in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts)] == want


def test_counters_travel_in_pieces(spark, monkeypatch):
    texts = [" ".join(f"t{(i * j) % 97}" for j in range(40)) for i in range(50)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(11)
    sizes, merge = [], common.merged_parts

    def watched(states, *rest):
        found = merge(states, *rest)
        for rows in (states, found):
            sizes.extend(len(zstandard.decompress(r["counts"])) for r in rows.select("counts").collect())
        return found

    monkeypatch.setattr(common, "merged_parts", watched)
    levels = jaccard.levels_of(docs, 5)
    assert max(sizes) <= 1 << 21
    counts = np.zeros(1 << jaccard.SKETCH_BITS)
    for found in jaccard.text_sets([(t or "").encode() for t in texts], 5):
        np.add.at(counts, (found >> np.uint64(64 - jaccard.SKETCH_BITS)).astype(np.int64), 1)
    assert np.array_equal(levels, (4 * np.log2(counts + 1)).astype(np.uint8))
    assert not jaccard.levels_of(docs.where(F.lit(False)), 5).any()


def test_texts_reach_python_in_small_batches(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/some.parquet")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, want in (("10000", common.BATCH_ROWS), ("0", common.BATCH_ROWS), ("7", 7)):
            spark.conf.set(name, given)
            assert common.read_table(spark, str(tmp_path), "some").count() == 3
            assert int(spark.conf.get(name)) == want
    finally:
        spark.conf.set(name, before)


def test_a_task_gives_its_memory_back():
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("no malloc_trim here")

    def held() -> int:
        about = Path("/proc/self/smaps_rollup").read_text()
        return int(re.search(r"Pss_Anon:\s+(\d+)", about)[1]) >> 10

    kept = []

    def run(batches):
        for batch in batches:
            parts = [np.ones(12_000, np.uint8) for _ in range(10_000)]
            kept.append(np.ones(12_000, np.uint8))  # above the free ones
            yield len(parts)

    before = held()
    assert list(common.tidy(run)(iter([1]))) == [10_000]
    assert held() < before + 60
