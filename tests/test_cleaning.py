import pytest
from conftest import rows

from songweave.operators import cleaning
from songweave.operators.splits import time_split_with_gap, with_split
from songweave.sources.tables import concat_aligned, scan, sink, transform_table


def test_dedup_keeps_none_of_the_copies(spark):
    df = spark.createDataFrame(
        [(1, "u1", "click", 10), (1, "u1", "click", 11), (2, "u2", "view", 20)],
        "timestamp long, uid string, event_type string, value long",
    )
    assert rows(cleaning.dedup_keep_none(df)) == [(2, "u2", "view", 20)]


def test_dedup_without_copies_changes_nothing(spark):
    data = [(1, "u1", "click", 1), (2, "u1", "click", 2), (1, "u2", "click", None)]
    df = spark.createDataFrame(data, "timestamp long, uid string, event_type string, value long")
    assert sorted(map(str, rows(cleaning.dedup_keep_none(df).na.fill(-1)))) == sorted(
        map(str, [(1, "u1", "click", 1), (2, "u1", "click", 2), (1, "u2", "click", -1)])
    )


def test_listen_and_reaction_filters(spark):
    df = spark.createDataFrame(
        [("u1", "listen", 1), ("u1", "click", 2), ("u2", "listen", 3), ("u2", None, 4)],
        "uid string, event_type string, item_id long",
    )
    assert rows(cleaning.listen_events(df), "item_id") == [(1,), (3,)]
    assert rows(cleaning.reaction_events(df), "item_id") == [(2,)]


def test_rare_users(spark):
    data = [("u1", i, "listen") for i in range(3)] + [("u2", i, "listen") for i in range(5)]
    df = spark.createDataFrame(data, "uid string, item_id long, event_type string")
    kept = cleaning.filter_rare_users(df, 4)
    assert rows(kept, "uid", "item_id") == [("u2", i) for i in range(5)]
    assert cleaning.filter_rare_items(df, 2).count() == 6


def test_length_bounds_are_inclusive(spark):
    data = [("a", 30), ("b", 60), ("c", 200), ("d", 350), ("e", 400), ("f", None)]
    df = spark.createDataFrame(data, "uid string, track_length_seconds long")
    assert [r[0] for r in rows(cleaning.cut_track_length(df), "uid")] == ["b", "c", "d"]


def test_last_reaction(spark):
    data = [
        ("u1", 10, "like", 1), ("u1", 10, "dislike", 2), ("u1", 10, "unlike", 3),
        ("u2", 20, "undislike", 5), ("u2", 20, "like", 4), ("u3", 30, "listen", 1),
    ]
    df = spark.createDataFrame(data, "uid string, item_id long, event_type string, ts long")
    assert rows(cleaning.last_reaction(df, order=("ts",))) == [
        ("u1", 10, "unlike", 3), ("u2", 20, "undislike", 5)
    ]


def test_rename_events_keeps_unknown_names_and_schema(spark):
    data = [("like",), ("unlike",), ("dislike",), ("undislike",), ("other",)]
    df = spark.createDataFrame(data, "event_type string")
    renamed = cleaning.rename_events(df)
    assert [r[0] for r in renamed.collect()] == ["like", "dislike", "dislike", "like", "other"]
    assert renamed.schema == df.schema


def test_relevant_events_drops_dislikes_without_ratio(make_log):
    log = make_log([
        (1, 1, 1, "like"), (1, 2, 1, "dislike"), (1, 3, 1, "listen", 50.0),
        (1, 4, 1, "listen", 49.9),
    ])
    assert rows(cleaning.relevant_events(log), "item_id") == [(1,), (3,)]


@pytest.mark.parametrize("gap,train_items", [(30, [1, 2]), (1800, [1])])
def test_split_is_disjoint_and_leaves_a_gap(make_log, gap, train_items):
    last = 10 * 86400
    log = make_log([
        (1, 1, last - 86400 - 1801, "listen"), (1, 2, last - 86400 - 31, "listen"),
        (1, 3, last - 86400 - 30, "listen"), (1, 4, last - 86400, "listen"),
        (1, 5, last - 86399, "listen"), (1, 6, last, "listen"),
    ])
    train, test = time_split_with_gap(log, 1, gap)
    assert [r[0] for r in rows(train, "item_id")] == train_items
    assert rows(test, "item_id") == [(5,), (6,)]
    tagged = with_split(log, 1, gap)
    assert rows(tagged.where("split = 'test'"), "item_id") == [(5,), (6,)]


def test_concat_same_and_aligned_schema(spark):
    a = spark.createDataFrame(
        [("u1", 1, 1), ("u2", 2, 2)], "uid string, item_id long, timestamp long"
    )
    assert concat_aligned(a, a).count() == 4
    b = spark.createDataFrame([("u3", 3, 9), ("u4", 4, 9)], "uid string, item_id long, extra long")
    both = concat_aligned(a, b)
    assert both.columns == a.columns
    assert [r["timestamp"] for r in both.orderBy("uid").collect()] == [1, 2, None, None]


def test_store_and_transform(spark, tmp_path, make_log):
    log = make_log([(1, 1, 1, "listen"), (1, 2, 2, "like")])
    sink(log, f"{tmp_path}/log", ["event_type"])
    out = transform_table(spark, f"{tmp_path}/log", f"{tmp_path}/out", cleaning.listen_events)
    assert rows(out, "item_id") == [(1,)]
    assert rows(scan(spark, f"{tmp_path}/log", columns=["item_id"])) == [(1,), (2,)]
    with pytest.raises(ValueError):
        transform_table(spark, f"{tmp_path}/log", f"{tmp_path}/log/", cleaning.listen_events)


def test_hash_sample_by_user_keeps_whole_users(make_log):
    log = make_log([(u, i, i, "listen") for u in range(40) for i in range(5)])
    sample = cleaning.hash_sample(log, 0.3, keys=("uid",))
    sizes = {r["uid"]: r["count"] for r in sample.groupBy("uid").count().collect()}
    assert set(sizes.values()) == {5} and 3 <= len(sizes) <= 25
