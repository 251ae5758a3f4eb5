from __future__ import annotations

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from sprintmart.functions import dates, fields, keys, numbers, text
from sprintmart.plans.staging import fill_missing
from sprintmart.schemas import CUSTOM_FIELDS


def apply(spark, values, make, dtype="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_trim_strips_every_kind_of_space(spark):
    values = ["\t a b\n", "\xa0x ", "", None, " \x1c　", "in ner"]
    assert apply(spark, values, text.trim_ws) == ["a b", "x", "", None, "", "in ner"]
    assert apply(spark, values, text.trim_ws) == [None if v is None else v.strip() for v in values]


def test_initcap_after_delimiters(spark):
    values = ["IN-PROGRESS foo_bar a.b(c)", "it's  two", "", None, "ON THE TEAM", "é-à/x\ty"]
    want = ["In-Progress Foo_Bar A.B(C)", "It's  Two", "", None, "On The Team", "É-À/X\tY"]
    assert apply(spark, values, text.initcap_delims) == want


def test_null_tokens(spark):
    got = apply(spark, ["None", "nan", "", "none", None], text.null_tokens_to_null)
    assert got == [None, None, "", "none", None]


def test_value_map_keeps_the_rest(spark):
    got = apply(spark, ["a", "b", None, "c"], lambda c: text.value_map(c, {"a": "b", "b": "x"}))
    assert got == ["b", "x", None, "c"]


def test_lacks_text_ignores_case_and_keeps_null(spark):
    got = apply(spark, ["My ACME x", "acm", None, ""], lambda c: text.lacks_text(c, "Acme"))
    assert got == [False, True, True, True]


def test_any_column_match_looks_everywhere(spark):
    df = spark.createDataFrame(
        [(1, "abc", ["x"]), (2, None, ["needle here"]), (34, "y", None)], "n int, s string, a array<string>"
    )
    assert [r.n for r in df.filter(text.any_column_match(df, "needle")).collect()] == [2]
    assert [r.n for r in df.filter(text.any_column_match(df, "34")).collect()] == [34]
    assert [r.n for r in df.filter(text.any_column_match(df, "^ab|^y$", regex=True)).collect()] == [1, 34]


def test_number_parsing(spark):
    values = ["8", " 8 ", "8.0", "None", "", None, "1d", "1e3", "Infinity", "NaN", "-.5", "+7", "0x1", "1."]
    want = [8.0, 8.0, 8.0, None, None, None, None, 1000.0, None, None, -0.5, 7.0, None, 1.0]
    assert apply(spark, values, numbers.to_number) == want
    assert apply(spark, values[:6], numbers.safe_int) == [8, 8, None, None, None, None]
    ids = ["12", "12.0", "12.5", "9007199254740993", "x", None]
    assert apply(spark, ids, numbers.to_identifier) == [12, 12, None, 9007199254740993, None, None]


def test_half_even_rounding(spark):
    halves = [0.5, 1.5, 2.5, -0.5, -1.5, None]
    assert apply(spark, halves, numbers.to_whole, "double") == [0, 2, 2, 0, -2, None]
    assert apply(spark, [2.675, 1.125, 1.135, 0.0], lambda c: numbers.round_half_even(c, 2), "double") == [
        round_numpy(v) for v in [2.675, 1.125, 1.135, 0.0]
    ]
    assert apply(spark, ["2.5", "x", None], numbers.whole_or_zero) == [2, 0, 0]


def round_numpy(value: float) -> float:
    import numpy as np

    return float(np.round(value, 2))


def test_booleans(spark):
    got = apply(spark, ["true", "false", "", None, " TRUE ", "maybe"], numbers.to_bool)
    assert got == [True, False, False, False, True, False]


def test_monthly_amount(spark):
    df = spark.createDataFrame([(120.0, "Yearly"), (120.0, "Monthly"), (120.0, None)], "a double, f string")
    got = [r[0] for r in df.select(numbers.monthly_amount(F.col("a"), F.col("f"))).collect()]
    assert got == [10.0, 120.0, 120.0]


def test_day_first_dates(spark):
    values = ["13/04/2024", "03/04/2024", "31/02/2024", "xx", None, "None"]
    want = [date(2024, 4, 13), date(2024, 4, 3), None, None, None, None]
    assert apply(spark, values, dates.parse_day_first) == want
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed|Cannot parse"):
        apply(spark, ["31/02/2024x"], lambda c: dates.parse_day_first(c, strict=True))
    shown = apply(spark, ["13/04/2024"], lambda c: dates.format_day_first(dates.parse_day_first(c)))
    assert shown == ["13/04/2024"]


def test_iso_dates(spark):
    values = ["2024-01-02T23:30:00Z", "2024-01-02T23:30:00-03:00", "2024-01-02", "soon", None]
    want = [date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 2), None, None]
    assert apply(spark, values, dates.iso_date) == want


def test_epoch_days_depend_on_the_zone_only(spark):
    near_midnight = str(int(datetime(2024, 1, 2, 1, 0, tzinfo=timezone.utc).timestamp() * 1000))
    values = [near_midnight, "12x", "", None, "-5", "9" * 25, "9" * 17]
    assert apply(spark, values, dates.epoch_ms_date)[0] == date(2024, 1, 2)
    for session_zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", session_zone)
        try:
            got = apply(spark, values, lambda c: dates.epoch_ms_date(c, "America/Sao_Paulo"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [date(2024, 1, 1), None, None, None, None, None, None]


def test_latest_skips_null(spark):
    df = spark.sql("select date'2024-01-01' a, cast(null as date) b union all select null, null")
    assert [r[0] for r in df.select(dates.latest(F.col("a"), F.col("b"))).collect()] == [date(2024, 1, 1), None]


def test_stable_id_tells_parts_apart(spark):
    df = spark.sql("select * from values ('a', null, 'b'), ('a', 'b', null), ('a', '', 'b') t(x, y, z)")
    ids = df.select(keys.stable_id("t", F.col("x"), F.col("y"), F.col("z")).alias("i"))
    assert len({r.i for r in ids.collect()}) == 3
    assert ids.collect() == ids.collect()


def field(name, value, options=None):
    config = None if options is None else {"options": [{"id": None, "name": o, "orderindex": i + 10} for i, o in enumerate(options)]}
    return {"id": None, "name": name, "type": None, "value": value, "type_config": config}


@pytest.fixture(scope="module")
def tasks(spark):
    from pyspark.sql import types as T

    cases = {
        "absent": [field("Other", "1")],
        "none": None,
        "users": [field("Reviewer", '[{"username":"ann"},{"username":"bob"}]')],
        "repeated": [field("Reviewer", '[{"username":"ann"}]'), field("Reviewer", "[]"), field("Reviewer", None)],
        "object": [field("Reviewer", '{"username":"ann"}')],
        "in": [field("Pick", "1", ["a", "b"])],
        "out": [field("Pick", "1", ["a", "b"]), field("Pick", "2", ["a", "b"])],
        "negative": [field("Pick", "-1", ["a", "b"])],
        "word": [field("Pick", "b", ["a", "b"])],
        "float": [field("Pick", "1.0", ["a", "b"])],
        "null last": [field("Pick", "0", ["a", "b"]), field("Pick", None, ["a", "b"])],
        "no options": [field("Pick", "0")],
    }
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("f", CUSTOM_FIELDS)])
    return spark.createDataFrame(list(cases.items()), schema)


def collect(df, column):
    return {r[0]: r[1] for r in df.select("id", column).collect()}


def test_user_of_field(tasks):
    got = collect(tasks, fields.user_of_field(F.col("f"), "Reviewer"))
    assert {k: v for k, v in got.items() if v} == {"users": "ann", "repeated": "ann"}


def test_option_of_field(tasks):
    got = collect(tasks, fields.option_of_field(F.col("f"), "Pick", "?"))
    named = {k: v for k, v in got.items() if v != "?"}
    assert named == {"in": "b", "float": "b", "null last": "a"}
    assert collect(tasks, fields.option_of_field(F.col("f"), "Pick"))["out"] is None


def test_scalar_takes_the_last_even_if_null(tasks):
    got = collect(tasks, fields.scalar_of_field(F.col("f"), "Pick"))
    assert got["null last"] is None and got["out"] == "2" and got["absent"] is None


def test_choose_option_by_name(tasks):
    chosen = fields.choose_option(F.col("f"), "Pick", F.lit("b"))
    got = collect(tasks, F.transform(chosen, lambda f: f["value"]))
    assert got["out"] == ["11", "11"] and got["word"] == ["11"] and got["absent"] == ["1"]
    assert got["no options"] == ["0"] and got["none"] is None
    missing = collect(tasks, F.transform(fields.choose_option(F.col("f"), "Pick", F.lit("z")), lambda f: f["value"]))
    assert missing["out"] == ["1", "2"]


def test_keep_and_append(tasks):
    kept = collect(tasks, F.size(fields.keep_fields(F.col("f"), "Reviewer")))
    assert kept["repeated"] == 3 and kept["in"] == 0
    appended = collect(tasks, F.size(fields.append_field(F.col("f"), F.get(F.col("f"), F.lit(0)))))
    assert appended["repeated"] == 4 and appended["none"] == 0


def test_first_item(spark):
    df = spark.sql("select array(named_struct('email', 'a')) p union all select array() union all select null")
    assert [r[0] for r in df.select(fields.first_item(F.col("p"), "email")).collect()] == ["a", None, None]


def test_fill_missing(spark):
    df = spark.sql("select cast(null as int) a, cast(null as double) b, cast(null as string) c, cast(null as boolean) d")
    assert tuple(fill_missing(df).first()) == (0, 0.0, "0", False)
