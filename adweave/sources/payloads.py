"""Landed JSON responses -> flat rows.

Landing rows are ``account_id, ad_id, window_start, status, body``: one response
each. Parsing, carrying and exploding happen inside the row, so no source in this
module shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adweave import schemas as S
from adweave.functions import scalars as X
from adweave.operators.carry import carried
from adweave.operators.dedupe import latest_per_key

_KINDS = {**{e: S.entity_body(e) for e in S.ENTITY_FIELDS},
          "day": S.day_body(S.STATS_METRICS),
          "lifetime": S.lifetime_body(S.STATS_METRICS + S.CONVERSION_METRICS), "geo": S.GEO_BODY}


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landing table: Parquet in the LANDING layout."""
    return spark.read.schema(S.LANDING).parquet(path)


def payload_outer(kind: str) -> str:
    """Name of the top-level array a usable body of this kind must have."""
    return _KINDS[kind].split(" ", 1)[0]


def _body(kind: str, metrics: list[str] | None = None) -> Column:
    """The body's columns, of its bags only the metrics asked for."""
    narrow = {"day": S.day_body, "lifetime": S.lifetime_body}
    return F.from_json("body", narrow[kind](metrics) if metrics and kind in narrow else _KINDS[kind])


def _reason(kind: str, body: Column) -> Column:
    """Why a response is not usable, NULL if it is."""
    return F.when(F.coalesce(F.col("status"), F.lit(0)) != 200, F.concat(
        F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("missing")))) \
        .when(~body[payload_outer(kind)].isNotNull(), "no payload")


def triage(landing: DataFrame, kind: str) -> DataFrame:
    """Tag each response: NULL ``reject_reason`` means usable.

    A response that did not return 200, is not JSON or lacks the payload's array is
    kept with its reason instead of aborting the run or vanishing. The body is parsed the
    way the readers parse it, so what is usable here is what they read.
    """
    return landing.withColumn("reject_reason", _reason(kind, _body(kind)))


def parsed(landing: DataFrame, kind: str) -> DataFrame:
    """Tagged responses with ``parsed``, the body's columns, instead of a usable body's text.

    Written once, it feeds the readers and the rejects: they take such a frame wherever they
    take a landing, and the text is not parsed again.
    """
    found = landing.withColumn("parsed", _body(kind))
    found = found.withColumn("reject_reason", _reason(kind, F.col("parsed")))
    usable = F.isnull("reject_reason")
    return found.withColumns({"parsed": F.when(usable, F.col("parsed")),
                              "body": F.when(~usable, F.col("body"))})


def _found(landing: DataFrame, kind: str, metrics: list[str] | None = None) -> DataFrame:
    """Usable responses with ``parsed``. An unusable body then yields no row in any reader."""
    if "parsed" in landing.columns:
        return landing.where(F.isnull("reject_reason"))
    return accepted(landing).withColumn("parsed", _body(kind, metrics))


def accepted(landing: DataFrame) -> DataFrame:
    """Responses worth parsing."""
    return landing.where(F.col("status") == 200)


def _nameless(kind: str) -> Column | None:
    """Entities of a parsed body that have no id."""
    if kind not in S.ENTITY_WRAPPERS:
        return None
    outer, inner = S.ENTITY_WRAPPERS[kind]
    return F.filter(F.col("parsed")[outer], lambda e: e[inner]["id"].isNull())


def outcomes(kind: str) -> list[Column]:
    """How the responses of a parsed landing fared, as sums to observe in passing."""
    reason = F.col("reject_reason")
    nameless = _nameless(kind)
    return [F.count_if(F.isnull(reason)).alias("accepted"),
            F.count_if(F.startswith(reason, F.lit("status "))).alias("status"),
            F.count_if(reason == "no payload").alias("no payload"),
            *([] if nameless is None else [F.coalesce(F.sum(
                F.when(F.isnull(reason), F.size(nameless))), F.lit(0)).alias("no id")])]


def rejects(landing: DataFrame, kind: str) -> DataFrame:
    """What no reader of this kind returns: unusable responses, and entities without an id."""
    tagged = landing if "parsed" in landing.columns else parsed(landing, kind)
    lost = tagged.where(F.col("reject_reason").isNotNull()).drop("parsed")
    nameless = _nameless(kind)
    if nameless is None:
        return lost
    items = tagged.where(F.isnull("reject_reason")).withColumn("e", F.explode(nameless))
    return lost.unionByName(items.withColumns(
        {"body": F.to_json("e"), "reject_reason": F.lit("no id")}).drop("e", "parsed"))


def read_entity(landing: DataFrame, entity: str, render_dates: bool = False,
                rest: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Campaign, ad-squad or ad payloads -> one row per entity, prefix-renamed.

    Optional keys become nullable columns, an entity without an id is a reject. Unknown keys
    are left out, or carried along as JSON text in the column named by ``rest`` (that takes a
    landing with its bodies). Dates are cut to the day; ``render_dates`` gives the extract's
    ``MM/DD/YYYY 0:00`` text. The account the response was requested for travels along as
    ``account_id``, and so do the landing's columns named in ``keep``.
    """
    outer, inner = S.ENTITY_WRAPPERS[entity]
    found = _found(landing, entity)
    items, known = F.col("parsed")[outer], f"e.{inner}.*"
    more = []
    if rest:
        from adweave.sources.drift import rest_column

        shape, extra = rest_column(entity)
        items = F.arrays_zip(items.alias("e"), F.from_json("body", shape)[outer].alias("x"))
        more = [extra.alias(rest)]
    own = ["account_id", *(keep or [])]
    rows = found.select(*own, F.explode(items).alias("z" if rest else "e"))
    rows = rows.select(*own, "z.*") if rest else rows
    flat = rows.select(*own, known, *more).where(F.col("id").isNotNull())
    dates = {c: X.entity_day(F.col(c)) for c in S.ENTITY_DATES if c in flat.columns}
    if render_dates:
        dates = {c: X.extract_day_text(d) for c, d in dates.items()}
    return flat.withColumns(dates).withColumnsRenamed(S.entity_renames(entity))


def one_version(rows: DataFrame, entity: str) -> DataFrame:
    """One row per id: retries land an entity again, the latest version stays."""
    return latest_per_key(rows, [f"{entity}_id"], [f"{entity}_updated_at"])


def read_ads(landing: DataFrame, accounts: DataFrame | None = None,
             render_dates: bool = False) -> DataFrame:
    """Ads, tagged with their account's timezone when accounts are given."""
    ads = read_entity(landing, "ad", render_dates)
    if accounts is None:
        return ads
    zones = accounts.select(F.col("ad_account_id").alias("account_id"),
                            F.col("ad_account_timezone").alias("timezone"))
    return ads.join(zones, "account_id", "inner")


def value_text(value: Column) -> Column:
    """``value.cast("string")`` of a VARIANT.

    The cast costs a microsecond a value, several times what its JSON text does, so it is left to
    what is not a number of usual size: only those read alike (quotes, exponents, 0.0000001).
    """
    def text(json: Column) -> Column:
        plain = (json >= "-") & (json < ":") & (F.length(json) <= 18) & ~F.contains(json, F.lit("E")) \
            & ~F.contains(json, F.lit("0.000000"))
        return F.when(plain, json).otherwise(value.cast("string"))

    # An array of one names the JSON text, so it is made once; most metrics are not there at all.
    return F.when(value.isNotNull(), F.get(F.transform(F.array(F.to_json(value)), text), F.lit(0)))


def _texts(bag: Column, metrics: list[str], names: dict[str, str] | None = None) -> list[Column]:
    names = names or {}
    return [value_text(bag[m]).alias(names.get(m, m)) for m in metrics]


def read_day_stats(landing: DataFrame, metrics: list[str] | None = None,
                   carry_forward: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Time series -> one text row per (ad, day).

    Only the first element of the outer array counts. With ``carry_forward`` a metric
    absent on a day keeps the value of an earlier day of the same response. Of a key that
    comes twice in one bag the last value counts, here and in the other readers. The landing's
    columns named in ``keep`` travel along.
    """
    metrics = metrics or S.STATS_METRICS
    own = ["ad_id", "window_start", *(keep or [])]
    rows = _days(landing, metrics, own).select(*own, F.posexplode(_series(metrics, carry_forward)))
    return rows.select(*own, *_day_texts(F.col("col"), metrics))


def read_day_series(landing: DataFrame, metrics: list[str] | None = None, carry_forward: bool = True,
                    keep: list[str] | None = None) -> DataFrame:
    """The rows of ``read_day_stats`` as one array ``series`` a response; no days, no row."""
    metrics = metrics or S.STATS_METRICS
    own = ["ad_id", "window_start", *(keep or [])]
    texts = F.transform(_series(metrics, carry_forward), lambda d: F.struct(*_day_texts(d, metrics)))
    # An array of one, not a filter: that would move below the parsing and parse again.
    some = F.filter(F.array(texts), lambda s: F.size(s) > 0)
    return _days(landing, metrics, own).select(*own, F.explode(some).alias("series"))


def _days(landing: DataFrame, metrics: list[str], own: list[str]) -> DataFrame:
    series = F.get(F.col("parsed")["timeseries_stats"], F.lit(0))["timeseries_stat"]["timeseries"]
    return _found(landing, "day", metrics).select(*own, series.alias("days"))


def _series(metrics: list[str], carry_forward: bool) -> Column:
    bags = F.transform("days", lambda d: d["stats"])
    return F.arrays_zip(
        F.transform("days", lambda d: d["start_time"]).alias("adstats_date"),
        (carried(bags, metrics) if carry_forward else bags).alias("stats"))


def _day_texts(item: Column, metrics: list[str]) -> list[Column]:
    return [item["adstats_date"].alias("adstats_date"), *_texts(item["stats"], metrics)]


def read_lifetime_stats(landing: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Lifetime totals: exactly one row per usable response, also when it has no metric."""
    metrics = metrics or S.STATS_METRICS
    found = _found(landing, "lifetime", metrics) \
        .select("ad_id", F.col("parsed")["lifetime_stats"].alias("found"))
    stats = F.get("found", F.lit(0))["lifetime_stat"]["stats"]
    # An array of one, not a filter: that would move below the parsing and parse again.
    one = F.when(F.col("found").isNotNull(), F.array(F.struct(stats.alias("stats"))))
    return found.select("ad_id", F.inline(one)).select("ad_id", *_texts(F.col("stats"), metrics))


def read_conversions(landing: DataFrame) -> DataFrame:
    return read_lifetime_stats(landing, S.CONVERSION_METRICS)


def read_geo(landing: DataFrame, carry_forward: bool = True) -> DataFrame:
    """Geo breakdown: one row per (ad, item); no item, no row. Metrics become ``geo_*``."""
    items = F.get(F.col("parsed")["lifetime_stats"], F.lit(0))["lifetime_stat"]["dimension_stats"]
    found = _found(landing, "geo").select("ad_id", items.alias("items"))
    fields = S.GEO_DIMENSIONS + S.GEO_METRICS
    bags = carried(F.col("items"), fields) if carry_forward else F.col("items")
    return found.select("ad_id", F.posexplode(bags).alias("pos", "item")).select(
        "ad_id", "pos", *_texts(F.col("item"), fields, {m: f"geo_{m}" for m in S.GEO_METRICS}))
