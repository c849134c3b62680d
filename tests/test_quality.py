"""Quality checks against a plain-Python model, on random tables with nulls,
NaN, null key parts, ties and missing columns, and on a few tables by hand."""

import itertools
import math
import random

import pytest

from lakeward.operators import quality

NAN = float("nan")
KINDS = {"code": "string", "level": "int", "share": "double", "region": "string"}
VALUES = {
    "code": ["k1", "k2", "k3", "", None],
    "level": [-1, 0, 7, None],
    "share": [0.0, -0.0, 0.5, NAN, None],
    "region": ["n", None],
}


def table(seed):
    rng = random.Random(seed)
    size = rng.choice([0, 1, 2, 5, 40])
    return [tuple(rng.choice(VALUES[c]) for c in KINDS) for _ in range(size)]


def frame(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in KINDS.items()))


def key(value):
    """Spark's equality: NaN equals itself, the zeros are one, null is null."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


class Model:
    """The checks' rules over a list of tuples."""

    def __init__(self, rows):
        self.rows, self.at = rows, {c: i for i, c in enumerate(KINDS)}

    def nulls(self, column):
        return sum(r[self.at[column]] is None for r in self.rows)

    def not_null(self, column):
        if column not in self.at:
            return f"not_null:{column}", False, f"Column '{column}' not found"
        n = self.nulls(column)
        return f"not_null:{column}", n == 0, f"'{column}' has {n} null(s)" if n else f"'{column}' OK"

    def row_count(self, least):
        return "row_count", len(self.rows) >= least, f"{len(self.rows)} rows (minimum {least})"

    def schema(self, expected):
        gone = sorted(set(expected) - set(self.at))
        return "schema", not gone, f"Missing columns: {gone}" if gone else "Schema OK"

    def no_duplicates(self, keys):
        distinct = {tuple(key(r[self.at[k]]) for k in keys) for r in self.rows}
        extra = len(self.rows) - len(distinct)
        name = f"no_duplicates:{keys}"
        return name, extra == 0, f"{extra} duplicate row(s) on {keys}" if extra else None

    def null_rate(self, column, limit):
        share = self.nulls(column) / max(len(self.rows), 1)
        return f"null_rate:{column}", share <= limit, f"'{column}' null rate {share:.2%} (max {limit:.2%})"


def agree(found, wanted):
    assert len(found) == len(wanted)
    for got, (name, passed, message) in zip(found, wanted, strict=True):
        assert (got.check_name, got.passed) == (name, passed)
        if message is not None:
            assert got.message == message


@pytest.mark.parametrize("seed", range(8))
def test_each_check_follows_the_model(spark, seed):
    rows = table(seed)
    data, model = frame(spark, rows), Model(rows)
    columns = ["share", "absent", "code"]
    agree(quality.check_not_null(data, columns), [model.not_null(c) for c in columns])
    for least in (0, 2, 41):
        agree(quality.check_row_count(data, least), [model.row_count(least)])
    for keys in (["code"], ["share", "region"], list(KINDS)):
        agree(quality.check_no_duplicates(data, keys), [model.no_duplicates(keys)])
    for limit in (0.0, 1 / 3, 1.0):
        agree(quality.check_null_rate(data, "level", limit), [model.null_rate("level", limit)])


@pytest.mark.parametrize("seed", range(8, 14))
def test_the_suite_is_the_checks_in_order(spark, seed):
    rows = table(seed)
    data, model = frame(spark, rows), Model(rows)
    expected, required, keys = ["region", "zone", "area", "code"], ["region", "share"], ["region", "level"]
    wanted = [
        model.schema(expected), model.row_count(2), *(model.not_null(c) for c in required), model.no_duplicates(keys)
    ]
    passed, found = quality.validate_dataframe(data, expected, required, keys, min_rows=2)
    agree(found, wanted)
    assert passed is False and wanted[0][2] == "Missing columns: ['area', 'zone']"
    lazy = quality.validation_frame(data, expected, required, keys, min_rows=2).collect()
    assert sorted(map(tuple, lazy)) == sorted((r.check_name, r.passed, r.message) for r in found)
    # without keys the suite ends before the duplicates
    agree(quality.evaluate(data, expected, required, None, 2), wanted[:-1])
    passed, found = quality.validate_dataframe(data, list(KINDS), [], list(KINDS), min_rows=0)
    assert passed is all(w[1] for w in (model.schema([]), model.row_count(0), model.no_duplicates(list(KINDS))))
    assert len(found) == 3


def test_nothing_to_check_is_no_failure(spark):
    data = frame(spark, [])
    assert quality.check_not_null(data, []) == []
    assert quality.check_schema(data, [])[0].passed
    outcome = []
    passed, same = quality.run_checks(outcome)
    assert passed is True and same is outcome
    mixed = [quality.CheckResult("first", True, ""), quality.CheckResult("second", False, "why")]
    passed, same = quality.run_checks(mixed)
    assert passed is False and same is mixed


def test_columns_that_do_not_exist_fail_their_check(spark):
    data = frame(spark, table(3))
    for found in (quality.check_null_rate(data, "absent", 1.0), quality.check_no_duplicates(data, ["code", "absent"])):
        assert [r.passed for r in found] == [False] and "not found" in found[0].message


def test_percentages_round_as_text_formatting_does(spark):
    """Every share of up to 16 rows, exact ties among them."""
    for n in (3, 7, 8, 16):
        rows = [("x", None if i < n // 2 else 1, 0.0, "r") for i in range(n)]
        agree(quality.check_null_rate(frame(spark, rows), "level", 0.125), [Model(rows).null_rate("level", 0.125)])


def test_results_become_a_frame(spark):
    made = quality.results_frame(spark, [quality.CheckResult("name", True, "text")])
    assert made.columns == ["check_name", "passed", "message"] and [tuple(r) for r in made.collect()] == [("name", True, "text")]
    mixed = quality.checks_frame(
        frame(spark, [("k1", 1, NAN, None)] * 2), not_null=["share"], min_rows=1, key_columns=["code"],
        null_rates={"region": 0.5}, expected_columns=["code"],
    ).collect()
    assert {r.check_name: r.passed for r in mixed} == {
        "schema": True, "row_count": True, "not_null:share": True, "no_duplicates:['code']": False, "null_rate:region": False
    }


# ---------------------------------------------------------------- row level


def test_repeated_keys_by_the_unique_index_rule(spark):
    """All pairs of a small alphabet, some twice: only whole keys collide."""
    parts = ["a", "b", None]
    rows = [p for k, p in enumerate(itertools.product(parts, parts)) for _ in range(1 + k % 2)]
    found = quality.duplicate_keys(spark.createDataFrame(rows, "x string, y string"), ["x", "y"]).collect()
    assert {(r.x, r.y, r.n) for r in found} == {(*p, rows.count(p)) for p in set(rows) if None not in p and rows.count(p) > 1}


def test_references_must_exist_unless_they_are_null(spark):
    rng = random.Random(6)
    children = [(rng.choice([1, 2, 3, None]), rng.choice(["u", "v", None])) for _ in range(60)]
    parents = [(1, "u"), (2, "v"), (2, "v"), (3, None)]
    child = spark.createDataFrame(children, "id int, kind string")
    parent = spark.createDataFrame(parents, "pid int, pkind string")
    lost = sorted(c for c in children if None not in c and c not in parents)
    assert sorted(tuple(r) for r in quality.relationships(child, parent, ["id", "kind"], ["pid", "pkind"]).collect()) == lost
    assert quality.check_relationships(child, parent, ["id", "kind"], ["pid", "pkind"])[0].passed is (not lost)


@pytest.mark.parametrize("seed", [2, 4])
def test_column_statistics(spark, seed):
    rows = [r for r in table(seed) if not (isinstance(r[2], float) and math.isnan(r[2]))]
    row = quality.column_stats(frame(spark, rows)).first().asDict()
    model = Model(rows)
    assert row["n_rows"] == len(rows)
    for c in KINDS:
        known = [r[model.at[c]] for r in rows if r[model.at[c]] is not None]
        assert row[f"{c}__nulls"] == model.nulls(c)
        assert row[f"{c}__min"] == (min(known) if known else None) and row[f"{c}__max"] == (max(known) if known else None)
