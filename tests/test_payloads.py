import json

import pytest

from adweave import schemas as S
from adweave.plans.extracts import intake, lifetime_extract
from adweave.session import fresh_path
from adweave.sources import payloads as P
from adweave.sources.drift import drift, promoted


def landing(spark, *rows):
    full = [(r.get("account_id"), r.get("ad_id"), None, r.get("status", 200),
             r["body"] if isinstance(r["body"], str) else json.dumps(r["body"])) for r in rows]
    return spark.createDataFrame(full, S.LANDING)


def series(*days):
    return {"timeseries_stats": [{"timeseries_stat": {"timeseries": [
        {"start_time": f"2020-01-0{i + 1}T00:00:00.000-05:00", "stats": d}
        for i, d in enumerate(days)]}}]}


def test_absent_carries_null_overwrites(spark):
    rows = landing(spark, {"ad_id": "a", "body": series(
        {"spend": 1, "swipes": 2}, {"swipes": 3}, {"spend": None}, {})})
    got = P.read_day_stats(rows, ["spend", "swipes", "saves"]).orderBy("adstats_date").collect()
    assert [(r.spend, r.swipes, r.saves) for r in got] == [
        ("1", "2", None), ("1", "3", None), (None, "3", None), (None, "3", None)]
    plain = P.read_day_stats(rows, ["spend", "swipes"], carry_forward=False) \
        .orderBy("adstats_date").collect()
    assert [(r.spend, r.swipes) for r in plain] == [
        ("1", "2"), (None, "3"), (None, None), (None, None)]


def test_values_do_not_leak_between_responses(spark):
    rows = landing(spark, {"ad_id": "a", "body": series({"spend": 9})},
                   {"ad_id": "b", "body": series({"swipes": 1})})
    got = {r.ad_id: r.spend for r in P.read_day_stats(rows, ["spend"]).collect()}
    assert got == {"a": "9", "b": None}


def test_only_first_series_counts_and_empty_gives_nothing(spark):
    two = series({"spend": 1})
    two["timeseries_stats"].append(series({"spend": 2})["timeseries_stats"][0])
    rows = landing(spark, {"ad_id": "a", "body": two}, {"ad_id": "b", "body": series()})
    assert [(r.ad_id, r.spend) for r in P.read_day_stats(rows, ["spend"]).collect()] == [("a", "1")]


def test_long_series_is_whole(spark):
    days = [{"spend": i} if i % 7 == 0 else {"swipes": i} for i in range(400)]
    body = {"timeseries_stats": [{"timeseries_stat": {"timeseries": [
        {"start_time": f"{i:04d}", "stats": d} for i, d in enumerate(days)]}}]}
    got = P.read_day_stats(landing(spark, {"ad_id": "a", "body": body}), ["spend"]) \
        .orderBy("adstats_date").collect()
    assert [int(r.spend) for r in got] == [i - i % 7 for i in range(400)]


def test_lifetime_keeps_empty_geo_drops_empty(spark):
    life = landing(spark, {"ad_id": "a", "body": {"lifetime_stats": [
        {"lifetime_stat": {"stats": {}}}]}})
    assert [(r.ad_id, r.spend) for r in P.read_lifetime_stats(life, ["spend"]).collect()] == \
        [("a", None)]
    geo = landing(spark, {"ad_id": "a", "body": {"lifetime_stats": [
        {"lifetime_stat": {"dimension_stats": []}}]}})
    assert P.read_geo(geo).count() == 0


def test_geo_carries_dimensions(spark):
    geo = landing(spark, {"ad_id": "a", "body": {"lifetime_stats": [{"lifetime_stat": {
        "dimension_stats": [{"country": "us", "dma": "1", "spend": 5}, {"dma": "2"}]}}]}})
    got = P.read_geo(geo).orderBy("pos").collect()
    assert [(r.country, r.dma, r.geo_spend) for r in got] == [("us", "1", "5"), ("us", "2", "5")]


def test_triage_keeps_every_response(spark):
    rows = landing(spark, {"ad_id": "ok", "body": series({"spend": 1})},
                   {"ad_id": "auth", "status": 401, "body": "{}"},
                   {"ad_id": "down", "status": 500, "body": "oops"},
                   {"ad_id": "text", "body": "oops"}, {"ad_id": "other", "body": "{\"x\": 1}"})
    got = {r.ad_id: r.reject_reason for r in P.triage(rows, "day").collect()}
    assert got == {"ok": None, "auth": "status 401", "down": "status 500",
                   "text": "no payload", "other": "no payload"}
    assert P.rejects(rows, "day").count() == 4


@pytest.mark.parametrize("entity", list(S.ENTITY_FIELDS))
def test_entities_rename_and_tolerate_gaps(spark, entity):
    outer, inner = S.ENTITY_WRAPPERS[entity]
    body = {outer: [{inner: {"id": "1", "name": "n", "created_at": "2020-01-02T03:04:05Z",
                             "surprise": {"x": 1}}},
                    {inner: {"id": "2", "created_at": "2020-01-03T03:04:05Z",
                             "updated_at": "2020-02-03T03:04:05Z"}}]}
    rows = P.read_entity(landing(spark, {"account_id": "acc", "body": body}), entity,
                         render_dates=True)
    assert set(rows.columns) == {"account_id", *S.entity_columns(entity)}
    got = {r[f"{entity}_id"]: r for r in rows.collect()}
    assert got["1"][f"{entity}_created_at"] == "01/02/2020 0:00"
    assert got["1"][f"{entity}_updated_at"] is None
    assert got["2"][f"{entity}_updated_at"] == "02/03/2020 0:00"


GOOD = {"campaign": '{"campaigns":[{"campaign":{"id":"c"}}]}', "ad_squad": '{"adsquads":[]}',
        "ad": '{"ads":[{"ad":{"id":"a"}}]}',
        "day": '{"timeseries_stats":[{"timeseries_stat":{"timeseries":[{"start_time":"2020-01-01"}]}}]}',
        "lifetime": '{"lifetime_stats":[{"lifetime_stat":{"stats":{}}}]}',
        "geo": '{"lifetime_stats":[{"lifetime_stat":{"dimension_stats":[]}}]}'}


@pytest.mark.parametrize("kind", sorted(GOOD))
def test_accepted_and_rejects_are_all_that_landed(spark, kind):
    bodies = [(200, GOOD[kind]), (200, "oops"), (200, None), (200, "{}"), (401, GOOD[kind]),
              (None, GOOD[kind]), (200, '{"x":1}')]
    landing = spark.createDataFrame(
        [("1", f"a{i}", None, s, b) for i, (s, b) in enumerate(bodies)], S.LANDING)
    tagged = P.triage(landing, kind)
    assert tagged.where("reject_reason is null").select("ad_id").collect()[0].ad_id == "a0"
    assert tagged.where("reject_reason is null").count() + P.rejects(landing, kind).count() \
        == landing.count()
    readers = {"day": P.read_day_stats, "lifetime": P.read_lifetime_stats, "geo": P.read_geo}
    if kind in readers:
        assert {r.ad_id for r in readers[kind](landing).select("ad_id").collect()} <= {"a0"}
    if kind == "lifetime":
        assert P.read_lifetime_stats(landing).count() == 1


def test_entities_without_id_are_rejects_and_retries_count_once(spark):
    def landed(outer, inner, *items):
        body = '{"%s":[%s]}' % (outer, ",".join('{"%s":%s}' % (inner, i) for i in items))
        return spark.createDataFrame([("1", None, None, 200, body)], S.LANDING)

    squads = landed("adsquads", "adsquad", '{"id":"s","campaign_id":"c","updated_at":"2020-01-01T0"}',
                    '{"id":"s","campaign_id":"c","name":"new","updated_at":"2020-02-01T0"}', '{"name":"x"}')
    campaigns = landed("campaigns", "campaign", '{"id":"c"}', '{"id":"c"}')
    ads = landed("ads", "ad", '{"id":"a","ad_squad_id":"s"}')
    assert [r.reject_reason for r in P.rejects(squads, "ad_squad").collect()] == ["no id"]
    stats = spark.createDataFrame([("1", "a", None, 200, GOOD["lifetime"])], S.LANDING)
    wide = lifetime_extract(campaigns, squads, ads, stats)
    assert [(r.ad_id, r.ad_squad_name) for r in wide.collect()] == [("a", "new")]


def test_last_of_a_repeated_key_counts(spark):
    body = ('{"timeseries_stats":[{"timeseries_stat":{"timeseries":[{"start_time":"2020-01-01",'
            '"stats":{"spend":1,"swipes":4,"spend":2}}]}}]}')
    landing = spark.createDataFrame([("1", "a", None, 200, body)], S.LANDING)
    for carry in (True, False):
        r = P.read_day_stats(landing, carry_forward=carry).first()
        assert (r.spend, r.swipes) == ("2", "4")


def test_every_unknown_key_is_listed(spark):
    odd = {"a": 1, "b": [1, 2.5], "c": None, "d": {"x": {"y": True}}, "e": "t"}
    bodies = {
        "ad": {"ads": [{"ad": {"id": "1", **odd}, "more": 1}, {"other": {"id": "2"}}], "paging": {}},
        "day": {"timeseries_stats": [{"timeseries_stat": {"timeseries": [
            {"start_time": "2020", "end_time": "2021", "stats": {"spend": 1, **odd}}], "unit": "x"},
            "status": "ok"}], "request": 1},
        "lifetime": {"lifetime_stats": [{"lifetime_stat": {"stats": {"spend": 1, **odd}, "unit": 1}}]},
        "geo": {"lifetime_stats": [{"lifetime_stat": {"dimension_stats": [{"dma": 1, **odd}, odd], "unit": 1}}]}}
    want = {
        "ad": {("body", "paging", "OBJECT", 1), ("item", "more", "BIGINT", 1), ("item", "other", "OBJECT", 1)},
        "day": {("body", "request", "BIGINT", 1), ("item", "status", "STRING", 1), ("series", "unit", "STRING", 1),
                ("day", "end_time", "STRING", 1)},
        "lifetime": {("totals", "unit", "BIGINT", 1)}, "geo": {("totals", "unit", "BIGINT", 1)}}
    types = {"a": "BIGINT", "b": "ARRAY", "c": "VOID", "d": "OBJECT", "e": "STRING"}
    for kind, body in bodies.items():
        n = 2 if kind == "geo" else 1
        inner = {("ad" if kind == "ad" else "metrics", k, t, n) for k, t in types.items()}
        got = drift(landing(spark, {"body": body}), kind)
        assert {(r.place, r.key, r.type, r.n) for r in got.collect()} == want[kind] | inner
        assert got.where("key = 'd'").first().schema == "OBJECT<x: OBJECT<y: BOOLEAN>>"
        assert drift(landing(spark, {"body": body}).limit(0), kind).count() == 0


def test_bodies_that_variant_cannot_hold_are_counted(spark):
    rows = landing(spark, {"body": "oops"}, {"body": '{"ads":[{"ad":{"id":"1","id":"2"}}]}'},
                   {"body": "[1]"}, {"body": '{"ads":[3,null,{"ad":4}]}'}, {"status": 500, "body": '{"x":1}'})
    assert [(r.place, r.key, r.n) for r in drift(rows, "ad").collect()] == [("unreadable", None, 2)]


def test_unknown_keys_travel_with_their_entity(spark):
    body = {"adsquads": [{"adsquad": {"id": "1", "name": "n", "x": {"y": [1]}, "z": 2.5}},
                         {"adsquad": {"id": "2", "name": "m"}}, {"adsquad": {"x": 1}}]}
    rows = P.read_entity(landing(spark, {"account_id": "c", "body": body}), "ad_squad", rest="rest")
    wide = promoted(rows, "rest", {"z": "double", "x": "string", "none": "int"})
    got = {r.ad_squad_id: (r.ad_squad_name, r.rest and json.loads(r.rest), r.z, r.x, r.none)
           for r in wide.collect()}
    assert got == {"1": ("n", {"x": {"y": [1]}, "z": 2.5}, 2.5, '{"y":[1]}', None),
                   "2": ("m", None, None, None, None)}


def test_intake_parses_once_and_counts_everything(spark):
    ok, bad = GOOD["ad"], '{"ads":[{"ad":{"name":"x"}},{"ad":{"id":"b"}}]}'
    ads = landing(spark, {"body": ok}, {"body": bad}, {"body": "oops"}, {"status": 401, "body": ok})
    day = landing(spark, {"ad_id": "a", "body": GOOD["day"]}, {"status": None, "body": GOOD["day"]})
    path, counts = fresh_path(spark, "rejects"), fresh_path(spark, "counts")
    frames = intake({"ad": ads, "day": day, "geo": day.limit(0)}, path, counts)
    assert sorted(r.ad_id for r in P.read_entity(frames["ad"], "ad").collect()) == ["a", "b"]
    assert P.read_day_stats(frames["day"]).collect() == P.read_day_stats(day).collect()
    left = spark.read.parquet(path)
    assert sorted((r.kind, r.reject_reason, r.body) for r in left.collect()) == [
        ("ad", "no id", '{"ad":{"name":"x"}}'), ("ad", "no payload", "oops"), ("ad", "status 401", ok),
        ("day", "status missing", GOOD["day"])]
    seen = {(r.kind, r.reason): r.n for r in spark.read.json(counts).collect() if r.n}
    assert seen == {("ad", "accepted"): 2, ("ad", "status"): 1, ("ad", "no payload"): 1, ("ad", "no id"): 1,
                    ("day", "accepted"): 1, ("day", "status"): 1}
