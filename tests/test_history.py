from __future__ import annotations

import random
from datetime import date

from tellerframe.operators.history import as_of_fill, as_of_join, load_history, merge_history, start_history
from tellerframe.plans.marts import dim_date
from tellerframe.sources.storage import fresh_path, materialize

D1, D2, D3 = date(2024, 1, 1), date(2024, 6, 1), date(2024, 9, 1)


def staged(spark, *data):
    return spark.createDataFrame(list(data), "id string, segment string, tenure int")


def merge(dimension, batch, day):
    return merge_history(dimension, batch, "id", "sk", ["segment"], day)


def versions(rows, df):
    return rows(df, "id", "segment", "effective_from", "effective_to", "is_current")


def history(spark):
    first = start_history(staged(spark, ("a", "Mass", 1), ("b", "Mass", 1), ("c", "Mass", 1)), "id", "sk", D1)
    return merge(first, staged(spark, ("a", "Mass", 2), ("b", "Affluent", 2), ("d", "Mass", 0)), D2)


def test_merge_keeps_closes_and_inserts(spark, rows):
    assert versions(rows, history(spark)) == [
        ("a", "Mass", D1, None, True),
        ("b", "Affluent", D2, None, True),
        ("b", "Mass", D1, D2, False),
        ("c", "Mass", D1, None, True),
        ("d", "Mass", D2, None, True),
    ]


def test_keys_are_unique_per_version(spark):
    found = history(spark).collect()
    assert len({r.version_sk for r in found}) == len(found) == 5
    assert len({r.sk for r in found}) == len({(r.sk, r.id) for r in found}) == 4


def test_untracked_columns_are_refreshed(spark):
    current = {r.id: r for r in history(spark).filter("is_current").collect()}
    assert (current["a"].tenure, current["a"].effective_from) == (2, D1) and current["c"].tenure == 1


def test_same_load_twice_changes_nothing(spark, rows):
    once = history(spark)
    twice = merge(once, staged(spark, ("a", "Mass", 2), ("b", "Affluent", 2), ("d", "Mass", 0)), D2)
    assert versions(rows, twice) == versions(rows, once)


def test_correction_on_the_same_day_replaces(spark, rows):
    fixed = merge(history(spark), staged(spark, ("b", "Private", 2)), D2)
    assert [v for v in versions(rows, fixed) if v[0] == "b"] == [("b", "Mass", D1, D2, False), ("b", "Private", D2, None, True)]


def test_change_to_and_from_null_opens_versions(spark, rows):
    first = start_history(staged(spark, ("a", None, 1)), "id", "sk", D1)
    second = merge(first, staged(spark, ("a", "Mass", 1)), D2)
    third = merge(second, staged(spark, ("a", None, 1)), D3)
    assert [(v[1], v[2], v[3]) for v in versions(rows, third)] == [(None, D1, D2), (None, D3, None), ("Mass", D2, D3)]


def test_empty_batch_keeps_the_dimension(spark, rows):
    once = history(spark)
    assert versions(rows, merge(once, staged(spark).limit(0), D3)) == versions(rows, once)


def loaded(spark, loads, log=None, dimension=None):
    log = log or fresh_path(spark, "loads")
    for day, *data in loads:
        after = load_history(dimension, staged(spark, *data), "id", "sk", ["segment"], day, log)
        dimension = materialize(after, "dimension")
    return dimension


def test_backdated_load_keeps_the_newer_version(spark, rows):
    """Loads of 1, 5 and 3 August."""
    days = [date(2024, 8, d) for d in (1, 5, 3)]
    got = loaded(spark, [(day, ("a", segment, 1)) for day, segment in zip(days, "ABC")])
    assert versions(rows, got) == [
        ("a", "A", days[0], days[2], False),
        ("a", "B", days[1], None, True),
        ("a", "C", days[2], days[1], False),
    ]


def test_any_order_of_loads_gives_one_table(spark, rows):
    """Random loads, some keys missing from some, shuffled, some of them twice: the table of the plain timeline."""
    draw = random.Random(11)
    every = [None, "Mass", "Affluent"]
    loads = [
        (date(2024, 1, 1 + d), *((k, draw.choice(every), d) for k in "abcdef" if draw.random() < 0.7)) for d in range(5)
    ]
    expected = []
    for key in "abcdef":
        own = []
        for day, *data in loads:
            for k, segment, tenure in data:
                if k != key:
                    continue
                if own and own[-1][1] == segment:
                    own[-1] = (key, segment, tenure, own[-1][3])
                else:
                    own.append((key, segment, tenure, day))
        ends = [v[3] for v in own[1:]] + [None]
        expected += [(*v, end, end is None) for v, end in zip(own, ends)]
    columns = ("id", "segment", "tenure", "effective_from", "effective_to", "is_current")
    keys = None
    for _ in range(2):
        order = loads + [draw.choice(loads)]
        draw.shuffle(order)
        got = loaded(spark, order)
        assert rows(got, *columns) == sorted(expected, key=lambda r: [(v is not None, v) for v in r])
        found = rows(got, "sk", "version_sk")
        assert len(set(found)) == len(found) and (keys is None or found == keys)
        keys = found


def test_a_repeated_day_takes_back_what_it_said(spark, rows):
    """The second load of a day lacks a key and restores another: no version of the first one stays."""
    got = loaded(spark, [(D1, ("a", "Mass", 1)), (D2, ("a", "Affluent", 1), ("b", "Mass", 1)), (D2, ("a", "Mass", 2))])
    assert versions(rows, got) == [("a", "Mass", D1, None, True)]


def test_dimension_without_a_log_gets_one(spark, rows):
    got = loaded(spark, [(date(2024, 3, 1), ("b", "Private", 1))], dimension=materialize(history(spark), "dimension"))
    assert [v for v in versions(rows, got) if v[0] == "b"] == [
        ("b", "Affluent", D2, None, True),
        ("b", "Mass", D1, date(2024, 3, 1), False),
        ("b", "Private", date(2024, 3, 1), D2, False),
    ]
    assert [v for v in versions(rows, got) if v[0] != "b"] == [v for v in versions(rows, history(spark)) if v[0] != "b"]


def test_point_in_time(spark, rows):
    facts = spark.createDataFrame(
        [("b", date(2023, 12, 31)), ("b", D1), ("b", date(2024, 5, 31)), ("b", D2), ("x", D2)], "id string, day date"
    )
    joined = as_of_join(facts, history(spark), "id", "day", ["segment"])
    assert rows(joined, "id", "day", "segment") == [
        ("b", date(2023, 12, 31), None),
        ("b", D1, "Mass"),
        ("b", date(2024, 5, 31), "Mass"),
        ("b", D2, "Affluent"),
        ("x", D2, None),
    ]


def test_date_dimension(spark):
    days = {r.full_date: r for r in dim_date(spark).collect()}
    assert len(days) == 4017 and max(days) == date(2030, 12, 30)
    leap = days[date(2024, 2, 29)]
    assert (leap.date_sk, leap.day_of_week, leap.day_of_week_num, leap.month_name, leap.month_short) == (20240229, "Thursday", 4, "February", "Feb")
    assert (leap.last_day_of_month, leap.fiscal_period, leap.quarter_name, leap.is_holiday_ca) == (date(2024, 2, 29), "2024-Q1", "Q1", False)
    assert days[date(2024, 12, 26)].is_holiday_ca and days[date(2024, 12, 29)].day_of_week_num == 0
    assert days[date(2024, 12, 30)].week_of_year == 1


def test_fill_gives_the_rows_of_the_range_join(spark, rows):
    drawn = random.Random(3)
    days = [date(2024, 1, 1).toordinal() + n for n in range(0, 400, 3)]
    versions = []
    for key in "abc":
        starts = sorted(drawn.sample(days, 9))
        ends = [*starts[1:], None]
        ends[4] = starts[4] + 1  # a gap until the next version
        versions += [(key, date.fromordinal(s), e and date.fromordinal(e), f"{key}{i}") for i, (s, e) in enumerate(zip(starts, ends))]
    dimension = spark.createDataFrame(versions, "id string, effective_from date, effective_to date, label string")
    facts = [(n, drawn.choice([*"abcd", None]), drawn.choice([None, *map(date.fromordinal, days)])) for n in range(500)]
    facts = spark.createDataFrame(facts, "n int, id string, day date")
    for unit in ("day", "month", "year"):
        filled = as_of_fill(facts, dimension, "id", "day", ["label"], unit)
        assert rows(filled) == rows(as_of_join(facts, dimension, "id", "day", ["label"]))


def test_fill_takes_moments_and_versions_of_no_length(spark, rows):
    dimension = spark.createDataFrame(
        [("a", D1, D2, "one"), ("a", D2, D2, "never"), ("a", D2, None, "two")], "id string, effective_from date, effective_to date, label string"
    )
    facts = spark.sql("select 'a' as id, timestamp'2024-05-31 23:59:59' as at union all select 'a', timestamp'2024-06-01 00:00:00' union all select 'a', timestamp'2023-12-31 23:00:00'")
    assert rows(as_of_fill(facts, dimension, "id", "at", ["label"]), "label") == [(None,), ("one",), ("two",)]


def test_hot_key_is_filled_in_slices(spark):
    hot = spark.range(10_000).selectExpr(
        "'hot' as id", "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id * 6) as effective_from",
        "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, (id + 1) * 6) as effective_to", "id as version",
    )
    facts = spark.range(50_000).selectExpr(
        "if(id % 10 = 0, 'hot', cast(id as string)) as id", "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 59999) as at", "id % 59999 div 6 as expected"
    )
    filled = as_of_fill(facts, hot, "id", "at", ["version"])
    assert filled.filter("id = 'hot' and not version <=> expected or id != 'hot' and version is not null").isEmpty()
    # the windows over moments are dealt by key and slice
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "Window" in line]
    assert sum("_slice" in line.rsplit("[_key", 1)[-1].split("]")[0] for line in over) == 1 and len(over) == 2
