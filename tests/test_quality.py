import datetime as dt

from tessera.operators import quality as Q

RULES = [Q.not_null("id"), Q.positive("amount"), Q.in_range("score", 0, 100),
         Q.date_range("day", "2024-01-01", "2024-12-31"), Q.max_length("name", 3)]


def _df(spark):
    rows = [
        (1, 5.0, 50, dt.date(2024, 6, 1), "abc"),      # valid
        (None, 5.0, 50, dt.date(2024, 6, 1), "abc"),   # not_null
        (3, -1.0, 50, dt.date(2024, 6, 1), "abc"),     # positive
        (4, 5.0, 101, dt.date(2024, 6, 1), "abc"),     # range
        (5, 5.0, 50, dt.date(2025, 1, 1), "abc"),      # date_range
        (6, 5.0, 50, dt.date(2024, 6, 1), "abcd"),     # max_length
        (7, None, None, None, None),                   # nulls pass all but not_null
    ]
    return spark.createDataFrame(rows, "id int, amount double, score int, day date, name string")


def test_errors_per_rule(spark):
    got = {r.id: r._errors for r in Q.with_errors(_df(spark), RULES).collect()}
    assert got[1] == [] and got[7] == []
    assert got[None] == ["id: is null"]
    assert got[3] == ["amount: must be positive"]
    assert got[4] == ["score: outside [0, 100]"]
    assert got[5] == ["day: date outside [2024-01-01, 2024-12-31]"]
    assert got[6] == ["name: longer than 3"]


def test_modes(spark):
    df = _df(spark)
    ok, bad = Q.split_by_mode(df, RULES, "strict")
    assert ok.count() == 2 and bad.count() == 5 and "_errors" not in ok.columns
    ok, bad = Q.split_by_mode(df, RULES, "warn")
    assert ok.count() == 7 and bad.count() == 5
    ok, bad = Q.split_by_mode(df, RULES, "skip")
    assert ok.count() == 7 and bad.count() == 0


def test_summary_nulls_alerts(spark):
    s = Q.quality_summary(_df(spark), RULES).first()
    assert (s.records_read, s.records_valid, s.records_rejected) == (7, 2, 5)
    assert s.rejection_rate == round(5 / 7, 4)
    nulls = {r.column_name: r.null_count for r in Q.null_counts(_df(spark), ["id", "amount"]).collect()}
    assert nulls == {"id": 1, "amount": 1}
    assert Q.alerts({"records_read": 10, "records_rejected": 2}, 700) == [
        "rejection rate 0.200 > 0.1", "processing time 700s > 600s"]
    assert Q.alerts({"records_read": 0}, 1) == ["no data"]


def test_observed_metrics(spark):
    out, obs = Q.observed(_df(spark), RULES)
    out.write.format("noop").mode("overwrite").save()
    assert obs.get == {"records_read": 7, "records_rejected": 5}
