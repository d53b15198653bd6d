"""DuckDB SQL for each query whose result SQL can state over whole tables."""

from __future__ import annotations

import re

# --- the data model as common table expressions ------------------------------

INTERACTIONS = """interactions as (
  select user_id as uid, item as item_id, ep - ep % 5 as "timestamp",
    case when event_type in ('view','click') then 'listen' when event_type = 'purchase' then 'like'
         when event_type = 'error' then 'dislike'
         when event_id % 2 = 0 then 'unlike' else 'undislike' end as event_type,
    case when event_type in ('view','click') then value end as played_ratio_pct,
    case when event_type in ('view','click') then 30 + (item * 37) % 400 end
      as track_length_seconds,
    cast(event_id % 3 <> 0 as int) as is_organic, event_id as seq
  from (select *, cast(floor(epoch(ts)) as bigint) as ep,
          cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as item from events))"""

PURCHASES = """purchases as (
  select o.o_custkey as uid, l.l_partkey as item_id,
    cast(floor(epoch(l.l_shipdate)) as bigint) + l.l_linenumber * 3600 as "timestamp",
    case when l.l_returnflag = 'R' then 'like' else 'listen' end as event_type,
    case when l.l_returnflag <> 'R' then l.l_quantity * 3 end as played_ratio_pct,
    case when l.l_returnflag <> 'R' then 30 + (l.l_partkey * 37) % 400 end
      as track_length_seconds,
    cast(l.l_linenumber % 3 <> 0 as int) as is_organic,
    l.l_orderkey * 10 + l.l_linenumber as seq
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey)"""

META = """meta as (
  select p_partkey as item_id,
    case when p_partkey % 17 <> 0 then cast(regexp_extract(p_brand, '([0-9]+)', 1) as bigint) end
      as artist_id,
    case when p_partkey % 13 <> 0 then cast(p_size as bigint) end as album_id,
    30 + (p_partkey * 37) % 400 as track_length_seconds
  from part)"""

# part has one row per item, so cleaning only drops rows with a null.
CLEAN_META = META + """,
clean_meta as (select * from meta where artist_id is not null and album_id is not null)"""

EMB = """emb as (
  select vec_id as item_id, embedding as normalized_embed, label from embeddings)"""

COPIES = EMB + """,
copies as (
  select * from emb union all
  select item_id + 1000000, normalized_embed, label from emb where label <= 1),
groups as (
  select normalized_embed as v, min(item_id) as canonical_id, count(*) as n
  from copies group by 1 having count(*) > 1)"""

SPLIT = INTERACTIONS + """,
train as (select * from interactions
  where "timestamp" < (select max("timestamp") from interactions) - 86400 - 30),
test as (select * from interactions
  where "timestamp" > (select max("timestamp") from interactions) - 86400)"""

COLS = """uid, item_id, "timestamp", event_type, round(played_ratio_pct, 6) as played_ratio_pct,
  track_length_seconds, is_organic, seq"""

REACTIONS = "'like','unlike','dislike','undislike'"


def reactions(source: str, name: str) -> str:
    """Last reaction per pair, renamed."""
    return f"""{name} as (
  select uid, item_id, "timestamp",
    case event_type when 'unlike' then 'dislike' when 'undislike' then 'like'
      else event_type end as event_type,
    played_ratio_pct, track_length_seconds, is_organic, seq
  from (select *, row_number() over (partition by uid, item_id
          order by "timestamp" desc, seq desc, event_type desc) as rn
        from {source} where event_type in ({REACTIONS})) where rn = 1)"""


TRUTH = SPLIT + ",\n" + reactions("test", "test_reactions") + """,
truth as (
  select * from (select * from test where event_type = 'listen'
                 union all select * from test_reactions)
  where event_type = 'like' or played_ratio_pct >= 50)"""


def with_(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def counts(source: str, name: str = "counts") -> str:
    """Counts over the last 300 days, or over the whole span of the sparse log."""
    days = 3650 if source == "purchases" else 300
    return f"""{name} as (
  select uid, item_id, count(*) filter (event_type = 'listen') as listen_count,
    coalesce(max(case when event_type = 'listen' then played_ratio_pct end), 0)
      as played_ratio_max,
    max(case when event_type = 'dislike' then 1 else 0 end) as dislike_flag,
    max(case when event_type = 'like' then 1 else 0 end) as like_flag
  from {source}
  where "timestamp" > (select max("timestamp") from {source}) - {days} * 86400
    and event_type in ('listen','like','dislike')
  group by uid, item_id)"""


def decayed(source: str, name: str, decay: float, hours: float, keep: str) -> str:
    tau = 0.0 if hours == 0 else decay ** (1.0 / (3600 * hours))
    return f"""{name} as (
  select uid, item_id, sum(pow(cast({tau!r} as double), last - "timestamp")) as conf
  from (select *, max("timestamp") over (partition by uid) as last from {source} where {keep})
  group by uid, item_id)"""


PLAYS = "event_type = 'listen' and played_ratio_pct > 50"
DECAY_2H = (0.9, 2)


def last_listen(
    source: str, name: str, n: int | None, decay: float = 0.9, hours: float = 2
) -> str:
    """Own items by decayed weight, at most ``n`` per user."""
    cut = f" where rank <= {n}" if n else ""
    return decayed(source, f"{name}_conf", decay, hours, PLAYS) + f""",
{name} as (
  select * from (
    select *, row_number() over (partition by uid order by order_key(score) desc, item_id) as rank
    from (select uid, item_id, case when conf < 1e-9 then 0 else conf end as score
          from {name}_conf)){cut})"""


def popular(source: str, name: str, days: int, n: int, users: str) -> str:
    return f"""{name} as (
  select uid, item_id, score, rank from (
    select *, row_number() over (order by order_key(score) desc, item_id) as rank from (
      select item_id, cast(count(*) as double) as score from {source}
      where event_type = 'like'
        and "timestamp" > (select max("timestamp") from {source}) - {days} * 86400
      group by item_id)) p
  cross join (select distinct uid from {users}) u where rank <= {n})"""


def time_profile(key: str, prefix: str, count_name: str, source: str, shift: int = 0) -> str:
    hour = '(("timestamp" // 3600) % 24)'
    weekday = f'((("timestamp" // 86400 + 3) % 7) + 1 - {shift})'

    def share(test: str, name: str) -> str:
        return f"round(avg(cast({test} as int)), 6) as {prefix}{name}"

    return f"""select {key}, count(*) as {count_name},
  {share(f"{hour} between 6 and 11", "morning_share")},
  {share(f"{hour} between 12 and 17", "day_share")},
  {share(f"{hour} between 18 and 23", "evening_share")},
  {share(f"{hour} between 0 and 5", "night_share")},
  {share(f"{weekday} < 5", "weekday_share")},
  {share(f"{weekday} >= 5", "weekend_share")},
  round(avg({hour}), 6) as {prefix}avg_listen_hour,
  round(avg({weekday}), 6) as {prefix}avg_listen_weekday
from {source} group by {key}"""


ITEM_TIME = ("item_id", "item_", "item_plays_for_time_profile")
USER_TIME = ("uid", "", "user_plays_for_time_profile")


def user_stats(source: str) -> str:
    last = f'(select max("timestamp") from {source})'
    return f"""user_stats as (
  select s.uid, user_total_plays, user_active_days, user_unique_tracks,
    round(median_daily_plays, 6) as median_daily_plays,
    round(user_unique_tracks / user_total_plays, 6) as unique_tracks_share,
    round(({last} - last_ts) / 86400, 6) as days_since_last_play, first_ts, last_ts,
    round(({last} - first_ts) / 86400, 6) as user_lifetime_days,
    round(case when {last} = first_ts then 1.0 else ({last} - first_ts) / 86400 end, 6)
      as user_lifetime_days_safe,
    t.* exclude (uid)
  from (select uid, count(*) as user_total_plays,
          count(distinct "timestamp" // 86400) as user_active_days,
          count(distinct item_id) as user_unique_tracks,
          min("timestamp") as first_ts, max("timestamp") as last_ts
        from {source} group by uid) s
  join (select uid, median(n) as median_daily_plays
        from (select uid, "timestamp" // 86400 as d, count(*) as n from {source} group by 1, 2)
        group by uid) m on s.uid = m.uid
  join ({time_profile(*USER_TIME, source)}) t on s.uid = t.uid)"""


def item_stats(source: str) -> str:
    last = f'(select max("timestamp") from {source})'
    return f"""item_stats as (
  select s.item_id, item_total_plays, item_unique_users, track_length_seconds, first_ts,
    p5 as item_plays_last_5d, p30 as item_plays_last_30d,
    round(({last} - first_ts) / 86400, 6) as item_age_days,
    round(p5 / greatest(p30, 1), 6) as item_trend, p5 as item_recent_popularity,
    t.* exclude (item_id)
  from (select item_id, count(*) as item_total_plays, count(distinct uid) as item_unique_users,
          max(track_length_seconds) as track_length_seconds, min("timestamp") as first_ts,
          count(*) filter ({last} - "timestamp" <= 5 * 86400) as p5,
          count(*) filter ({last} - "timestamp" <= 30 * 86400) as p30
        from {source} group by item_id) s
  join ({time_profile(*ITEM_TIME, source)}) t on s.item_id = t.item_id)"""


def pair_profile(source: str, meta: str) -> str:
    return f"""pairs as (
  select p.*, artist_id, album_id,
    round(coalesce(((select max("timestamp") from {source}) - last_listen_ts) / 86400, 9999), 6)
      as ui_days_since_last_play
  from (select uid, item_id,
          nullif(count(*) filter (event_type = 'listen'), 0) as listen_count,
          max(case when event_type = 'listen' then played_ratio_pct end) as played_ratio_max,
          max(case when event_type = 'listen' then "timestamp" end) as last_listen_ts,
          max(case when event_type = 'dislike' then 1 else 0 end) as dislike_flag,
          max(case when event_type = 'like' then 1 else 0 end) as like_flag
        from {source} where event_type in ('listen','like','dislike') group by 1, 2) p
  left join {meta} m on p.item_id = m.item_id),
profile as (
  select p.*, cast(coalesce(a.n, case when p.artist_id is not null then 0 end) as bigint)
      as artist_listen_count,
    cast(coalesce(b.n, case when p.album_id is not null then 0 end) as bigint)
      as album_listen_count
  from pairs p
  left join (select uid, artist_id, sum(listen_count) as n from pairs group by 1, 2) a
    on p.uid = a.uid and p.artist_id = a.artist_id
  left join (select uid, album_id, sum(listen_count) as n from pairs group by 1, 2) b
    on p.uid = b.uid and p.album_id = b.album_id)"""


PROFILE_COLS = """uid, item_id, listen_count, round(played_ratio_max, 6) as played_ratio_max,
  last_listen_ts, dislike_flag, like_flag, ui_days_since_last_play, artist_id, album_id,
  artist_listen_count, album_listen_count"""

ITEM_FEATURES = """item_plays_last_5d, item_plays_last_30d, item_age_days, item_trend,
  item_plays_for_time_profile, item_morning_share, item_day_share, item_evening_share,
  item_night_share, item_weekday_share, item_weekend_share, item_avg_listen_hour,
  item_avg_listen_weekday"""
USER_FEATURES = """user_total_plays, user_active_days, user_unique_tracks, median_daily_plays,
  unique_tracks_share, days_since_last_play, user_plays_for_time_profile, morning_share,
  day_share, evening_share, night_share, weekday_share, weekend_share, avg_listen_hour,
  avg_listen_weekday"""
PAIR_FEATURES = "ui_days_since_last_play, artist_listen_count, album_listen_count"

FEATURES = "\n,".join(
    [pair_profile("train", "clean_meta"), item_stats("train"), user_stats("train")]
) + f""",
features as (
  select p.uid, p.item_id, {PAIR_FEATURES}, {ITEM_FEATURES}, {USER_FEATURES}
  from profile p left join item_stats i on p.item_id = i.item_id
  left join user_stats u on p.uid = u.uid)"""


def unit_hash(seed: int, *keys: str) -> str:
    text = ", ".join([f"'{seed}'", *(f"cast({k} as varchar)" for k in keys)])
    return f"(cast('0x' || substr(md5(concat_ws('|', {text})), 1, 8) as bigint) / 4294967296.0)"


def flat(columns: str) -> list[str]:
    return [c.strip() for c in columns.replace("\n", " ").split(",")]


def filled(columns: str) -> str:
    return ", ".join(f"coalesce({c}, 0) as {c}" for c in flat(columns))


def dataset(keys: tuple[str, ...]) -> str:
    """Sampled candidates with label and features."""
    return f"""target as (
  select uid, item_id, ln(1 + count(*)) as weights from train
  where {PLAYS} and "timestamp" > (select max("timestamp") from train) - 5 * 86400
  group by 1, 2),
data as (
  select c.uid, c.item_id, round(score, 6) as score, round(coalesce(weights, 0), 6) as weights,
    {filled(PAIR_FEATURES)}, {filled(ITEM_FEATURES)}, {filled(USER_FEATURES)}
  from (select * from recs where {unit_hash(42, *keys)} < 0.3) c
  left join target t on c.uid = t.uid and c.item_id = t.item_id
  left join features f on c.uid = f.uid and c.item_id = f.item_id)"""


RECS = last_listen("train", "recs", 200)
DATASET = ",\n".join([SPLIT, CLEAN_META, RECS, FEATURES])
RANKABLE = "rankable as (select * from data where uid in (select uid from data group by uid" \
    " having min(weights) < max(weights)))"


def matrix(source: str, name: str, truncated: bool) -> str:
    weight = "ln(1 + listen_count)"
    if truncated:
        weight = f"trunc({weight})"
    return counts(source, f"{name}_counts") + f""",
{name}_raw as (select uid, item_id, cast({weight} as double) as w
  from {name}_counts where played_ratio_max > 50),
{name} as (
  select uid, item_id, case when len > 0 then w / len else 0 end as weight
  from (select *, sqrt(sum(w * w) over (partition by uid)) as len from {name}_raw))"""


def bm25(name: str, k1: float = 0.1, b: float = 0.75, k: int = 200) -> str:
    """BM25-weighted item neighbours of matrix ``name``."""
    return f"""bm_item as (select item_id, sum(weight) as len from {name} group by 1),
bm_user as (select uid, count(*) as df from {name} group by 1),
bm as (
  select m.uid, m.item_id,
    case when ({k1} * ((1 - {b}) + {b} * i.len / (select avg(len) from bm_item)) + weight) = 0
      then 0 else weight * ({k1} + 1) /
      ({k1} * ((1 - {b}) + {b} * i.len / (select avg(len) from bm_item)) + weight) end
      * (ln((select count(*) from bm_item)) - ln(1 + u.df)) as w
  from {name} m join bm_item i on m.item_id = i.item_id join bm_user u on m.uid = u.uid),
similar_items as (
  select item_id, neighbor, similarity, rank from (
    select *, row_number() over (partition by item_id order by order_key(similarity) desc, neighbor) as rank
    from (select a.item_id, b.item_id as neighbor, sum(a.w * b.w) as similarity
          from bm a join bm b on a.uid = b.uid where a.w <> 0 and b.w <> 0 group by 1, 2))
  where rank <= {k})"""


def bm25_lists(name: str, n: int) -> str:
    return f"""select uid, item_id, round(score, 6) as score, rank from (
  select *, row_number() over (partition by uid order by order_key(score) desc, item_id) as rank from (
    select uid, neighbor as item_id, sum(weight * similarity) as score
    from {name} m join similar_items s on m.item_id = s.item_id group by 1, 2)
  where score > 0) where rank <= {n}"""


def knn(source: str, truncated: bool) -> str:
    """Play matrices and the unit rows of the user overlap."""
    cut = "trunc(conf)" if truncated else "conf"
    return ",\n".join([
        decayed(source, "plays_conf", 0.9, 2, PLAYS),
        f"""plays as (
  select uid, item_id, cast(count(*) as double) as w from {source} where {PLAYS} group by 1, 2)""",
        f"""recent as (
  select uid, item_id, {cut} as w from plays_conf where conf >= 1e-9 and {cut} > 0)""",
        """overlap_raw as (
  select a.uid, b.uid as other_uid, sum(a.w * b.w) as s
  from recent a join plays b on a.item_id = b.item_id group by 1, 2)""",
        """overlap as (
  select uid, other_uid, s / sqrt(sum(s * s) over (partition by uid)) as weight
  from overlap_raw)""",
    ])


def knn_lists(name: str, n: int) -> str:
    return f"""{name} as (
  select uid, item_id, score, rank from (
    select *, row_number() over (partition by uid order by order_key(score) desc, item_id) as rank from (
      select o.uid, p.item_id, sum(o.weight * p.w) as score
      from overlap o join (
        select uid, item_id, w / sqrt(sum(w * w) over (partition by uid)) as w from plays) p
        on o.other_uid = p.uid
      group by 1, 2) where score > 0) where rank <= {n})"""


def walk_graph(source: str) -> str:
    """Edges and transition of the walk graph; kinds are 0 user, 1 track, 2 artist, 3 album."""
    return ",\n".join([
        counts(source, "walk_counts"),
        """walk_pairs as (
  select * from walk_counts where played_ratio_max >= 50 and listen_count > 0)""",
        """walk_tracks as (
  select t.item_id, artist_id, album_id
  from (select distinct item_id from walk_pairs) t
  left join clean_meta m on t.item_id = m.item_id)""",
        """one_way as (
  select 0 as src_type, uid as src, 1 as dst_type, item_id as dst,
    least(greatest(ln(1 + listen_count), 1e-6), 10.0) as w from walk_pairs
  union all
  select 1, item_id, 2, coalesce(artist_id, -1), 10.0 from walk_tracks
  union all
  select 1, item_id, 3, coalesce(album_id, -1), 10.0 from walk_tracks)""",
        """edges as (
  select * from one_way union all select dst_type, dst, src_type, src, w from one_way)""",
        """steps as (
  select src_type, src, dst_type, dst, w / sum(w) over (partition by src_type, src) as p
  from edges)""",
        """g0 as (
  select src_type as t, src as id, 1.0 / count(*) over () as g
  from (select distinct src_type, src from edges))""",
        """g1 as (
  select dst_type as t, dst as id, 0.5 * sum(p * g) as g
  from steps join g0 on src_type = t and src = id group by 1, 2)""",
        """g2 as (
  select dst_type as t, dst as id, 0.5 * sum(p * g) as g
  from steps join g1 on src_type = t and src = id group by 1, 2)""",
    ])


def walk_lists(name: str, n: int) -> str:
    """Every user against every track, two steps of the walk."""
    return f"""{name} as (
  select uid, item_id, score, rank from (
    select *, row_number() over (partition by uid order by order_key(score) desc, item_id) as rank from (
      select u.uid, g.id as item_id, g.g + 0.25 * coalesce(s.p, 0) as score
      from (select distinct src as uid from steps where src_type = 0) u
      cross join (select * from g2 where t = 1) g
      left join steps s on s.src_type = 0 and s.src = u.uid and s.dst_type = 1 and s.dst = g.id))
  where rank <= {n})"""


def listed(source: str) -> str:
    return f"select uid, item_id, round(score, 6) as score, rank from {source}"


def diversified(source: str, meta: str, max_artist: int, max_album: int) -> str:
    """Greedy walk down each list as a recursion over positions."""
    def fits(owner: str, seen: str, most: int) -> str:
        return f"(n.{owner} is null or len(list_filter(c.{seen}, lambda o: o = n.{owner})) < {most})"

    ok = f"({fits('artist_id', 'artists', max_artist)} and {fits('album_id', 'albums', max_album)})"
    return f"""places as (
  select r.uid, r.item_id, score, artist_id, album_id,
    row_number() over (partition by r.uid order by order_key(score) desc, r.item_id) as pos
  from {source} r left join {meta} m on r.item_id = m.item_id),
walked as (
  select uid, item_id, score, pos, true as taken, [artist_id] as artists, [album_id] as albums
  from places where pos = 1
  union all
  select n.uid, n.item_id, n.score, n.pos, {ok} as taken,
    case when {ok} then list_append(c.artists, n.artist_id) else c.artists end,
    case when {ok} then list_append(c.albums, n.album_id) else c.albums end
  from walked c join places n on n.uid = c.uid and n.pos = c.pos + 1),
diverse as (
  select uid, item_id, score, row_number() over (partition by uid order by pos) as rank
  from walked where taken)"""


def explored(source: str, k: int = 10, rate: float = 0.2, seed: int = 42) -> str:
    return f"""placed as (
  select uid, item_id, score, least({k}, count(*) over (partition by uid)) as kk,
    row_number() over (partition by uid order by order_key(score) desc, item_id) as place from {source}),
marked as (
  select *, place <= kk - cast(round_even(kk * {rate}, 0) as int) as exploit from placed),
final as (
  select * from (
    select uid, item_id, score, cast(not exploit as int) as explored, kk,
      row_number() over (partition by uid order by cast(exploit as int) desc,
        case when exploit then place end,
        md5(concat_ws('|', '{seed}', cast(uid as varchar), cast(item_id as varchar)))) as rank
    from marked) where rank <= kk)"""


KEPT_RECS = """kept as (
  select * from recs r where not exists (
    select 1 from (select uid, item_id, max("timestamp") as ts from train
                   where event_type = 'listen' group by 1, 2) h
    where h.uid = r.uid and h.item_id = r.item_id
      and ((select max("timestamp") from train) - h.ts) / 86400 < 2))"""


def user_metrics(recs: str, k: int = 10) -> str:
    return f"""pairs_true as (select distinct uid, item_id from truth),
rec_k as (select uid, item_id, rank from {recs} where rank <= {k}),
sizes as (select uid, count(*) as n_true,
    list_sum(list_transform(range(1, least(count(*), {k}) + 1), lambda i: 1 / log2(i + 1)))
      as idcg
  from pairs_true group by uid),
user_metrics as (
  select r.uid, count(t.item_id) / count(*) as precision,
    count(t.item_id) / any_value(n_true) as recall,
    sum(case when t.item_id is not null then 1 / log2(rank + 1) else 0 end) / any_value(idcg)
      as ndcg
  from rec_k r join sizes s on r.uid = s.uid
  left join pairs_true t on r.uid = t.uid and r.item_id = t.item_id group by r.uid),
shown as (select distinct item_id from rec_k where uid in (select uid from pairs_true)),
coverage as (
  select count(s.item_id) / count(*) as coverage
  from (select distinct item_id from train) c left join shown s on c.item_id = s.item_id),
cosines as (
  select uid, avg(coalesce(best, 0)) as cos_sim from (
    select r.uid, r.item_id,
      max(list_inner_product(a.normalized_embed::double[], b.normalized_embed::double[])) as best
    from rec_k r join pairs_true t on r.uid = t.uid
    left join emb a on r.item_id = a.item_id left join emb b on t.item_id = b.item_id
    group by 1, 2) group by uid),
summary as (
  select count(*) as users_scored,
    (select count(distinct uid) from truth) - count(*) as users_skipped,
    avg(precision) as precision, avg(recall) as recall, avg(ndcg) as ndcg,
    (select coverage from coverage) as coverage, avg(cos_sim) as cos_sim
  from user_metrics m join cosines c on m.uid = c.uid)"""


POPULAR_METRICS = with_(
    TRUTH, EMB, popular("train", "recs", 30, 50, "train"), user_metrics("recs")
)
SUMMARY = """select users_scored, users_skipped, round(precision, 6) as precision,
  round(recall, 6) as recall, round(ndcg, 6) as ndcg, round(coverage, 6) as coverage,
  round(cos_sim, 6) as cos_sim from summary"""

NORM = "sqrt(list_inner_product(normalized_embed::double[], normalized_embed::double[]))"


def cleaned(source: str, name: str) -> str:
    """Listens of ``source`` after duplicates, rare items, rare users and length."""
    return f"""l1 as (
  select * exclude (n) from (select *, count(*) over (partition by "timestamp", uid, event_type)
    as n from {source} where event_type = 'listen') where n = 1),
l2 as (select * exclude (n) from (select *, count(*) over (partition by item_id) as n from l1)
  where n >= 5),
l3 as (select * exclude (n) from (select *, count(*) over (partition by uid) as n from l2)
  where n >= 20),
{reactions(source, name + "_reactions")},
{name} as (
  select * from l3 where track_length_seconds between 60 and 350
  union all select * from {name}_reactions)"""


def keep_none(source: str) -> str:
    return f"""select {COLS} from (
  select *, count(*) over (partition by "timestamp", uid, event_type) as n
  from {source} where event_type = 'listen') where n = 1"""


def frequencies(key: str, most: str = "") -> str:
    return f"""select times, count(*) as keys from (
  select {key}, count(*) as times from purchases where event_type = 'listen' group by 1)
group by times {most}"""


def histogram(column: str) -> str:
    return f"""select {column}, count(*) as listens from purchases
where event_type = 'listen' and {column} is not null group by 1"""


def id_index(source: str, column: str, index: str) -> str:
    return f"""select {column}, row_number() over (
  order by substr(md5(cast({column} as varchar)), 1, 3), {column}) - 1 as {index}
from (select distinct {column} from {source})"""


CANDIDATES = with_(
    SPLIT,
    CLEAN_META,
    popular("train", "pop", 5, 50, "train"),
    RECS,
    knn("train", True),
    knn_lists("near", 200),
    walk_graph("train"),
    walk_lists("walk", 100),
    """cands as (
  select uid, item_id, 'MostPopular' as model, score, rank from pop
  union all select uid, item_id, 'LastListenRecommender', score, rank from recs
  union all select uid, item_id, 'ItemKNN', score, rank from near
  union all select uid, item_id, 'RandomWalkWithRestart', score, rank from walk)""",
)
MODEL_NAMES = ["MostPopular", "LastListenRecommender", "ItemKNN", "RandomWalkWithRestart"]

ORACLES: dict[str, str] = {
    # sources
    "scan_interactions": with_(INTERACTIONS) + f"select {COLS} from interactions",
    "concat_aligned": with_(INTERACTIONS, META) + """
select item_id, uid, track_length_seconds from interactions
union all select item_id, null, track_length_seconds from meta""",
    "embeddings_in_catalogue": with_(PURCHASES, EMB) + """
select item_id, label from emb where item_id in (select item_id from purchases)""",
    "embedding_table": with_(EMB) + f"""
select item_id, cast(len(normalized_embed) as int) as size, round({NORM} / {NORM}, 6) as length,
  round(normalized_embed[1]::double / {NORM}, 6) as first_value
from emb where normalized_embed is not null and {NORM} > 1e-12""",
    # cleaning
    "listen_events": with_(INTERACTIONS)
    + f"select {COLS} from interactions where event_type = 'listen'",
    "reaction_events": with_(INTERACTIONS)
    + f"select {COLS} from interactions where event_type <> 'listen'",
    "dedup_keep_none": with_(PURCHASES) + keep_none("purchases"),
    "dedup_keep_none_hourly": with_(INTERACTIONS, """hourly as (
  select * replace ("timestamp" - "timestamp" % 3600 as "timestamp") from interactions)""")
    + keep_none("hourly"),
    "filter_rare_items": with_(PURCHASES) + f"""
select {COLS} from (select *, count(*) over (partition by item_id) as n from purchases)
where n >= 30""",
    "filter_rare_users": with_(PURCHASES) + f"""
select {COLS} from (select *, count(*) over (partition by uid) as n from purchases)
where n >= 40""",
    "cut_track_length": with_(INTERACTIONS)
    + f"select {COLS} from interactions where track_length_seconds between 60 and 350",
    "last_reaction": with_(INTERACTIONS) + f"""
select {COLS} from (select *, row_number() over (partition by uid, item_id
    order by "timestamp" desc, seq desc) as rn
  from interactions where event_type in ({REACTIONS})) where rn = 1""",
    "rename_events": with_(INTERACTIONS) + """
select uid, item_id, "timestamp", case event_type when 'unlike' then 'dislike'
    when 'undislike' then 'like' else event_type end as event_type,
  round(played_ratio_pct, 6) as played_ratio_pct, track_length_seconds, is_organic, seq
from interactions""",
    "relevant_events": with_(INTERACTIONS)
    + f"select {COLS} from interactions where event_type = 'like' or played_ratio_pct >= 50",
    "time_split_with_gap": with_(SPLIT) + f"""
select {COLS}, 'train' as split from train union all select {COLS}, 'test' from test""",
    "time_split_with_wide_gap": with_(PURCHASES) + f"""
select {COLS}, 'train' as split from purchases
where "timestamp" < (select max("timestamp") from purchases) - 30 * 86400 - 1800
union all
select {COLS}, 'test' from purchases
where "timestamp" > (select max("timestamp") from purchases) - 30 * 86400""",
    "preprocess_train": with_(SPLIT, cleaned("train", "pre")) + f"select {COLS} from pre",
    "preprocess_train_sparse": with_(PURCHASES, """train as (select * from purchases
  where "timestamp" < (select max("timestamp") from purchases) - 30 * 86400 - 30)""",
        cleaned("train", "pre")) + f"select {COLS} from pre",
    "preprocess_test": with_(TRUTH) + f"select {COLS} from truth",
    "null_id_rows": with_(INTERACTIONS)
    + "select count(*) as null_rows from interactions where uid is null or item_id is null",
    "organic_split_counts": with_(INTERACTIONS)
    + "select is_organic, count(*) as events from interactions group by 1",
    "known_items_only": with_(PURCHASES, CLEAN_META, EMB) + f"""
select {COLS} from purchases where item_id in (select item_id from clean_meta)
  and item_id in (select item_id from emb)""",
    "hash_sample": with_(INTERACTIONS)
    + f"select {COLS} from interactions where {unit_hash(42, 'seq')} < 0.3",
    "hash_sample_users": with_(INTERACTIONS)
    + f"select {COLS} from interactions where {unit_hash(42, 'uid')} < 0.3",
    "clean_items_meta": with_(META) + """
select item_id, artist_id, album_id, track_length_seconds from (
  select *, row_number() over (partition by item_id
      order by artist_id, album_id, track_length_seconds) as rn
  from (select * from meta union all
        select item_id, artist_id, album_id + item_id % 3 - 1, track_length_seconds from meta)
  where artist_id is not null and album_id is not null) where rn = 1""",
    # aggregates and features
    "interaction_counts": with_(INTERACTIONS, counts("interactions")) + """
select uid, item_id, listen_count, round(played_ratio_max, 6) as played_ratio_max,
  dislike_flag, like_flag from counts""",
    "pair_profile": with_(INTERACTIONS, CLEAN_META, pair_profile("interactions", "clean_meta"))
    + f"select {PROFILE_COLS} from profile",
    "pair_profile_null_owners": with_(PURCHASES, META, pair_profile("purchases", "meta"))
    + f"select {PROFILE_COLS} from profile",
    "pair_profile_repeated_meta": with_(PURCHASES, META, """once as (
  select item_id, min(artist_id) as artist_id, min(album_id) as album_id from (
    select item_id, artist_id, album_id from meta union all
    select item_id, artist_id + 1000, album_id + 1000 from meta) group by 1)""",
        pair_profile("purchases", "once")) + f"select {PROFILE_COLS} from profile",
    "item_time_profile": with_(INTERACTIONS) + time_profile(*ITEM_TIME, "interactions"),
    "item_time_profile_documented": with_(PURCHASES) + time_profile(*ITEM_TIME, "purchases", 1),
    "user_time_profile": with_(INTERACTIONS) + time_profile(*USER_TIME, "interactions"),
    "user_music_stats": with_(INTERACTIONS, user_stats("interactions"))
    + "select * from user_stats",
    "median_daily_plays": with_(INTERACTIONS) + """
select uid, median(n) as median_daily_plays from (
  select uid, "timestamp" // 86400 as d, count(*) as n from interactions group by 1, 2)
group by uid""",
    "item_stats": with_(INTERACTIONS, item_stats("interactions")) + "select * from item_stats",
    "decayed_play_weight": with_(INTERACTIONS, decayed("interactions", "w", *DECAY_2H, PLAYS)) + """
select uid, item_id, round(conf, 6) as conf,
  round(case when conf < 1e-9 then 0 else conf end, 6) as weights from w""",
    "decayed_play_weight_last_only": with_(
        INTERACTIONS, decayed("interactions", "w", 0.9, 0, PLAYS)) + """
select uid, item_id, round(conf, 6) as conf,
  round(case when conf < 1e-9 then 0 else conf end, 6) as weights from w""",
    "ranking_target": with_(INTERACTIONS) + f"""
select uid, item_id, round(ln(1 + count(*)), 6) as weights from interactions
where {PLAYS} and "timestamp" > (select max("timestamp") from interactions) - 5 * 86400
group by 1, 2""",
    "confidence_weights": with_(INTERACTIONS, counts("interactions")) + """
select uid, item_id, listen_count, round(played_ratio_max, 6) as played_ratio_max,
  dislike_flag, like_flag, round(ln(1 + listen_count), 6) as weights
from counts where played_ratio_max > 50""",
    "user_taste_history": with_(INTERACTIONS, decayed(
        "interactions", "w", 0.9, 0.5,
        "(played_ratio_pct >= 100 or event_type = 'like') and is_organic = 1"))
    + "select uid, item_id from w where conf >= 1e-9",
    # profiling
    "event_type_counts": with_(INTERACTIONS)
    + "select event_type, count(*) as events from interactions group by 1",
    "item_freq_of_freq": with_(PURCHASES) + frequencies("item_id"),
    "user_freq_of_freq": with_(PURCHASES) + frequencies("uid", "having times <= 50"),
    "track_length_histogram": with_(PURCHASES) + histogram("track_length_seconds"),
    "played_ratio_histogram": with_(PURCHASES) + histogram("played_ratio_pct"),
    "replay_gap_hours": with_(SPLIT) + """
select b.uid, b.item_id, first_test_ts, last_train_ts,
  round((first_test_ts - last_train_ts) / 3600, 6) as gap_hours
from (select uid, item_id, min("timestamp") as first_test_ts from test where is_organic = 0
      group by 1, 2) b
left join (select uid, item_id, max("timestamp") as last_train_ts from train
      where is_organic = 1 group by 1, 2) a on a.uid = b.uid and a.item_id = b.item_id""",
    "duplicate_embeddings": with_(COPIES) + """
select canonical_id, item_id, n as copies from copies join groups on normalized_embed = v""",
    "duplicate_share": with_(COPIES) + """
select cast((select sum(n) from groups) as bigint) as copied_items,
  round(100.0 * (select sum(n) from groups) / count(distinct item_id), 6) as copied_pct
from copies""",
    "canonical_item_map": with_(COPIES) + """
select item_id, canonical_id from copies join groups on normalized_embed = v
where item_id <> canonical_id""",
    "remap_items": with_(INTERACTIONS, COPIES) + """
select uid, coalesce(canonical_id, i.item_id) as item_id, "timestamp", event_type,
  round(played_ratio_pct, 6) as played_ratio_pct, track_length_seconds, is_organic, seq
from (select * replace (item_id + case when is_organic = 0 then 1000000 else 0 end as item_id)
      from interactions) i
left join (select item_id, canonical_id from copies join groups on normalized_embed = v
           where item_id <> canonical_id) m on i.item_id = m.item_id""",
    "artist_catalogue": with_(META) + "select distinct artist_id, item_id from meta",
    "artist_cluster_purity": with_(EMB, META) + """
select artist_id, count(label) as total_tracks, count(distinct label) as n_clusters
from emb join meta on emb.item_id = meta.item_id where artist_id is not null
group by artist_id having count(distinct label) > 1""",
    "dataset_span": with_(INTERACTIONS) + """
select (max("timestamp") - min("timestamp")) // 86400 as days from interactions""",
    "embedding_usage": with_(INTERACTIONS, EMB) + """
select count(*) as vectors, (select count(distinct item_id) from interactions) as items_in_log,
  round(100.0 * (select count(distinct item_id) from interactions) / count(*), 6) as used_pct
from emb""",
    "event_timeline": with_(INTERACTIONS, """slice as (
  select * from (select *, row_number() over (order by "timestamp", seq) as rn from interactions
                 where event_type = 'listen') where rn > 900 and rn <= 1000)""") + """
select uid, item_id, "timestamp", seq,
  round(track_length_seconds * played_ratio_pct * 0.01, 6) as count_sec,
  row_number() over (partition by "timestamp" order by seq) - 1 as stack_level from slice""",
    "last_items_of_top_user": with_(INTERACTIONS) + """
select uid, item_id, "timestamp", seq from interactions
where uid = (select uid from interactions group by uid order by count(*) desc, uid limit 1)
order by "timestamp" desc, seq desc limit 200""",
    # vectors
    "l2_normalize": with_(EMB, """stretched as (
  select item_id, list_transform(normalized_embed::double[], lambda x: x * (label + 2)) as v
  from emb)""") + """
select item_id, cast(pos - 1 as int) as pos,
  round(v[pos] / greatest(sqrt(list_inner_product(v, v)), 1e-12), 6) as value
from stretched, unnest(range(1, len(v) + 1)) as t(pos)""",
    "mean_direction": with_(EMB, """m as (
  select pos, avg(normalized_embed[pos]::double) as x
  from emb, unnest(range(1, len(normalized_embed) + 1)) as t(pos) group by pos)""") + """
select cast(pos - 1 as int) as pos,
  round(x / greatest(sqrt((select sum(x * x) from m)), 1e-12), 6) as value from m""",
    "embedding_topk": with_(EMB) + """
select query_id, item_id, round(score, 6) as score, rank from (
  select *, row_number() over (partition by query_id order by score desc, item_id) as rank from (
    select a.item_id as query_id, b.item_id, round(list_inner_product(
      a.normalized_embed::double[], b.normalized_embed::double[]), 12) as score
    from emb a cross join emb b)) where rank <= 10""",
    "embedding_topk_cells": with_(EMB) + """
select query_id, item_id, round(score, 6) as score, rank from (
  select *, row_number() over (partition by query_id order by score desc, item_id) as rank from (
    select a.item_id as query_id, b.item_id, round(list_inner_product(
      a.normalized_embed::double[], b.normalized_embed::double[]), 12) as score
    from emb a cross join emb b)) where rank <= 10""",
    # models
    "most_popular": with_(
        INTERACTIONS, popular("interactions", "pop", 5, 50, "interactions")) + listed("pop"),
    "new_items": with_(PURCHASES) + """
select uid, item_id, score, rank from (
  select *, row_number() over (order by order_key(score) desc, item_id) as rank from (
    select item_id, cast(count(*) as double) as score from purchases group by item_id
    having min("timestamp") >= (select max("timestamp") from purchases) - 2300 * 86400)) p
cross join (select distinct uid from purchases) u where rank <= 50""",
    "last_listen": with_(INTERACTIONS, last_listen("interactions", "recs", None)) + listed("recs"),
    "user_item_weights": with_(INTERACTIONS, matrix("interactions", "m", True))
    + "select uid, item_id, round(weight, 6) as weight from m",
    "user_item_weights_float": with_(PURCHASES, matrix("purchases", "m", False))
    + "select uid, item_id, round(weight, 6) as weight from m",
    "user_id_map": with_(PURCHASES) + id_index("purchases", "uid", "uid_index"),
    "id_maps": with_(PURCHASES) + id_index("purchases", "item_id", "item_index"),
    "mapped_interactions": with_(INTERACTIONS, """known as (select * from interactions where item_id % 7 <> 0),
users as (select uid, row_number() over (
    order by substr(md5(cast(uid as varchar)), 1, 3), uid) - 1 as uid_index
  from (select distinct uid from known where uid is not null)),
items as (select item_id, row_number() over (
    order by substr(md5(cast(item_id as varchar)), 1, 3), item_id) - 1 as item_index
  from (select distinct item_id from known where item_id is not null))""") + """
select seq, uid_index as uid, item_index as item_id, event_type
from interactions i left join users u on i.uid = u.uid left join items t on i.item_id = t.item_id""",
    "bm25_similar_items": with_(PURCHASES, matrix("purchases", "m", False), bm25("m"))
    + "select item_id, neighbor, round(similarity, 6) as similarity, rank from similar_items",
    "bm25_recommend": with_(PURCHASES, matrix("purchases", "m", False), bm25("m"))
    + bm25_lists("m", 200),
    "bm25_recommend_truncated": with_(
        INTERACTIONS, matrix("interactions", "m", True), bm25("m")) + bm25_lists("m", 200),
    "user_overlap": with_(PURCHASES, knn("purchases", True))
    + "select uid, other_uid, round(weight, 6) as weight from overlap",
    "item_knn": with_(PURCHASES, knn("purchases", True), knn_lists("near", 200)) + listed("near"),
    "item_knn_float": with_(INTERACTIONS, knn("interactions", False), knn_lists("near", 200))
    + listed("near"),
    "rwr_edges": with_(INTERACTIONS, CLEAN_META, walk_graph("interactions"))
    + "select src_type, src, dst_type, dst, round(w, 6) as w from edges",
    "rwr_transition": with_(INTERACTIONS, CLEAN_META, walk_graph("interactions"))
    + "select src_type, src, dst_type, dst, round(p, 6) as p from steps",
    "rwr_recommend": with_(
        INTERACTIONS, CLEAN_META, walk_graph("interactions"), walk_lists("walk", 100))
    + listed("walk"),
    # candidates, ranking, final list
    "candidates_long": CANDIDATES
    + "select uid, item_id, model, round(score, 6) as score, rank from cands",
    "candidates_wide": CANDIDATES + "select uid, item_id, " + ", ".join(
        f"round(coalesce(max(case when model = '{n}' then score end), 0), 6) as score_{n}"
        for n in MODEL_NAMES) + " from cands group by 1, 2",
    "feature_table": with_(SPLIT, CLEAN_META, FEATURES) + "select * from features",
    "candidate_features_separate": with_(SPLIT, CLEAN_META, RECS, FEATURES) + """
select r.uid, r.item_id, round(score, 6) as score,
  coalesce(p.ui_days_since_last_play, 0) as ui_days_since_last_play,
  coalesce(i.item_plays_last_30d, 0) as item_plays_last_30d,
  coalesce(u.user_total_plays, 0) as user_total_plays
from recs r left join profile p on r.uid = p.uid and r.item_id = p.item_id
left join item_stats i on r.item_id = i.item_id left join user_stats u on r.uid = u.uid""",
    "ranking_dataset": with_(DATASET, dataset(("uid", "item_id"))) + "select * from data",
    "ranking_dataset_users": with_(DATASET, dataset(("uid",)))
    + "select uid, item_id, score, weights from data",
    "rankable_users": with_(DATASET, dataset(("uid", "item_id")), RANKABLE)
    + "select uid, item_id, weights from rankable",
    "ranker_train_pairs": with_(DATASET, dataset(("uid", "item_id")), RANKABLE, """numbered as (
  select *, row_number() over (partition by uid
    order by md5(concat_ws('|', '42', cast(uid as varchar), cast(item_id as varchar))), item_id) as rn
  from rankable)""") + """
select a.uid, a.item_id, b.item_id as other_id, cast(a.weights > b.weights as int) as label, """
    + ", ".join(
        f"round(cast(a.{c} - b.{c} as double), 6) as {c}"
        for c in ["score", *flat(PAIR_FEATURES), "item_plays_last_30d"]
    )
    + """
from numbered a join numbered b on a.uid = b.uid and b.rn between a.rn + 1 and a.rn + 8
where a.weights <> b.weights""",
    "ranker_listwise_gradients": with_(DATASET, dataset(("uid", "item_id")), RANKABLE, f"""gained as (
  select uid, item_id, score, pow(2.0, weights) - 1 as gain,
    score - ln(-ln(least(greatest({unit_hash(42, 'uid', 'item_id')}, 1e-9), 1 - 1e-9))) as spread
  from rankable),
placed as (
  select *, row_number() over (partition by uid order by gain desc, item_id) as best,
    row_number() over (partition by uid order by spread desc, item_id) as place from gained),
ideals as (select uid, sum(gain / log2(best + 1.0)) as ideal from placed group by uid),
met as (
  select a.uid, a.item_id, sign(a.gain - b.gain)
    * abs((a.gain - b.gain) * (1 / log2(a.place + 1.0) - 1 / log2(b.place + 1.0)))
    / (1 + exp(sign(a.gain - b.gain) * (a.score - b.score))) as pull
  from placed a join placed b
    on a.uid = b.uid and a.place <> b.place and abs(a.place - b.place) <= 4)""") + """
select p.uid, p.item_id,
  round(case when ideal > 0 then coalesce(s.pull, 0) / ideal else 0 end, 6) as gradient
from placed p join ideals i on p.uid = i.uid
left join (select uid, item_id, sum(pull) as pull from met group by 1, 2) s
  on p.uid = s.uid and p.item_id = s.item_id""",
    "hybrid_list_facts": with_(DATASET) + """
select count(distinct uid) as users, true as short, true as "distinct",
  cast(0 as bigint) as repeated_artists, cast(0 as bigint) as repeated_albums,
  cast(0 as bigint) as recently_played from train""",
    "ranker_split": with_(DATASET, dataset(("uid", "item_id")), RANKABLE) + f"""
select uid, item_id, weights,
  case when {unit_hash(43, 'uid', 'item_id')} < 0.2 then 'valid' else 'train' end as fold
from rankable""",
    "drop_recently_played": with_(SPLIT, RECS, KEPT_RECS)
    + "select uid, item_id, round(score, 6) as score from kept",
    "diversify_artist_album": "with recursive " + ",\n".join(
        [SPLIT, RECS, META, diversified("recs", "meta", 1, 1)]) + "\n" + listed("diverse"),
    "diversify_three_each": "with recursive " + ",\n".join(
        [PURCHASES, last_listen("purchases", "recs", None, hours=24 * 365), META,
         diversified("recs", "meta", 3, 3)]) + "\n" + listed("diverse"),
    "epsilon_greedy_topk": with_(SPLIT, RECS, explored("recs")) + """
select uid, item_id, round(score, 6) as score, explored, rank from final""",
    "recommend_final": "with recursive " + ",\n".join(
        [SPLIT, RECS, KEPT_RECS, META, diversified("kept", "meta", 1, 1), explored("diverse")])
    + "\n" + listed("final"),
    # evaluation
    "precision_at_k": POPULAR_METRICS
    + "select uid, round(precision, 6) as precision from user_metrics",
    "recall_at_k": POPULAR_METRICS + "select uid, round(recall, 6) as recall from user_metrics",
    "ndcg_at_k": POPULAR_METRICS + "select uid, round(ndcg, 6) as ndcg from user_metrics",
    "coverage_at_k": POPULAR_METRICS + "select round(coverage, 6) as coverage from coverage",
    "cosine_similarity_at_k": POPULAR_METRICS
    + "select uid, round(cos_sim, 6) as cos_sim from cosines",
    "evaluate_model": with_(TRUTH, EMB, RECS, user_metrics("recs")) + SUMMARY,
    "evaluate_models": "\nunion all\n".join(
        f"select '{name}' as model, {k} as k, * from ("
        + with_(TRUTH, EMB, recs, user_metrics("recs", k)) + SUMMARY + ")"
        for name, recs in (
            ("MostPopular", popular("train", "recs", 30, 50, "train")),
            ("LastListenRecommender", RECS),
        )
        for k in (10, 100)
    ),
    "evaluate_recommended_only": with_(
        TRUTH.replace("truth as (", "all_truth as (")
        + ",\ntruth as (select * from all_truth where is_organic = 0)",
        EMB, RECS, user_metrics("recs")) + SUMMARY,
    "compare_to_baseline": POPULAR_METRICS + """,
measured as (
  select 'recall' as metric, recall as value, 3.700 as baseline, 1.530 as published from summary
  union all select 'ndcg', ndcg, 7.810, 2.600 from summary
  union all select 'coverage', coverage, 2.570, 0.000 from summary
  union all select 'cos_sim', cos_sim, null, 46.070 from summary)
select 'MostPopular' as model, metric, round(value * 100, 6) as measured,
  cast(baseline as double) as baseline, cast(published as double) as published,
  cast(value * 100 > baseline as int) as above_baseline from measured""",
}


def expanded(sql: str) -> str:
    """Write out ``order_key(x)``: x at nine significant digits, by which lists are ordered."""
    scale = r"pow(10.0, 8 - floor(log10(abs(\1))))"
    key = rf"(case when \1 = 0 then 0 else round(\1 * {scale}) / {scale} end)"
    return re.sub(r"order_key\((\w+)\)", key, sql)


ORACLES = {name: expanded(sql) for name, sql in ORACLES.items()}
