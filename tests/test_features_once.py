"""Features of a log are made once for all that is described by them."""

from conftest import rows

from songweave.catalog.queries import QUERIES
from songweave.plans import candidates
from songweave.plans.candidates import describe_candidates, feature_table
from songweave.session import cut_lineage

DAY = 86400


def test_stored_features_describe_like_made_ones(spark, make_log):
    log = make_log(
        [(1, 1, 0, "listen"), (1, 2, DAY, "listen"), (1, 2, 2 * DAY, "like"), (2, 1, DAY, "listen"), (None, 3, 5, "listen")]
    )
    meta = spark.createDataFrame([(1, 7, 8), (2, 7, 9)], "item_id long, artist_id long, album_id long")
    wanted = spark.createDataFrame(
        [(1, 1, 0.5), (1, 2, 0.25), (1, 2, 0.25), (2, 2, None), (None, 3, 1.0)], "uid long, item_id long, score double"
    )
    made = describe_candidates(wanted, log, meta)
    stored = describe_candidates(wanted, log, meta, features=cut_lineage(feature_table(log, meta)))
    assert made.columns == stored.columns and rows(made) == rows(stored)


def test_the_ranker_reduces_the_log_once(spark, monkeypatch):
    seen, reduce_log = [], candidates.reduce_log
    monkeypatch.setattr(candidates, "reduce_log", lambda *given: seen.append(1) or reduce_log(*given))
    QUERIES["ranker_scores"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 1
