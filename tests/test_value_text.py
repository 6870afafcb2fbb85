"""Texts of payload values: the short way gives what the cast gives."""

from pyspark.sql import functions as F

from adweave.sources.payloads import read_day_stats, value_text

_VALUES = [
    "0", "-0", "12", "-7", "100.0", "1.50", "0.0", "-0.0", "0.05", "123.456", "1e2", "1E-7", "5e-1", "0.0000001",
    "0.000001", "0.00000123", "1000000000000000000", "9223372036854775807", "9223372036854775808", "1e400",
    "12345678901234567890123456789012345678", "123456789012345678901234567890123456789012", "0.1234567", "10.10",
    "1200", "1200.00", "3.14159265358979", "true", "false", "null", '""', '"a"', '"12"', '"1.50"', '"two words"',
    r'"q\\"q"', r'"b\\\\s"', r'"l\\nf"', r'"\\u00e9"', '"é"', '"a/b"', '"\u007f"', '{"a":1}', "[1,2]", '"[x]"']


def test_value_text_is_the_cast(spark):
    rows = spark.createDataFrame([(v.replace("\\\\", "\\"),) for v in _VALUES], "j string") \
        .withColumn("v", F.from_json("j", "variant"))
    seen = rows.select("j", value_text(F.col("v")).alias("short"), F.col("v").cast("string").alias("cast")).collect()
    assert sum(r.cast is not None for r in seen) >= len(_VALUES) - 3
    assert [(r.j, r.short) for r in seen] == [(r.j, r.cast) for r in seen]


def test_values_need_no_cast(spark):
    """What a day's metrics usually are is decided by their JSON text."""
    plan = read_day_stats(spark.createDataFrame(
        [], "account_id string, ad_id string, window_start date, status int, body string"),
        ["impressions"])._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" in plan.lower() or "tojson" in plan.lower()


def test_carried_over_many_days(spark):
    """Three metrics over 40 days: one sent once, one every fifth day, one set to null at the end."""
    days = []
    for n in range(40):
        bag = ['"swipes":' + str(n)] if n % 5 == 0 else []
        bag += ['"impressions":7.50'] if n == 0 else []
        bag += ['"spend":null'] if n == 30 else ['"spend":"x"'] if n == 3 else []
        days.append(f'{{"start_time":"{n}","stats":{{{",".join(bag)}}}}}')
    body = f'{{"timeseries_stats":[{{"timeseries_stat":{{"timeseries":[{",".join(days)}]}}}}]}}'
    landing = spark.createDataFrame([("1", "a", None, 200, body)],
                                    "account_id string, ad_id string, window_start date, status int, body string")
    rows = read_day_stats(landing, ["impressions", "swipes", "spend"]).collect()
    assert [(int(r.adstats_date), r.swipes, r.spend) for r in rows] == [
        (n, str(n - n % 5), "x" if 3 <= n < 30 else None) for n in range(40)]
    assert {r.impressions for r in rows} == {rows[0].impressions} != {None}
