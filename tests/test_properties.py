"""Property tests: Spark expressions against the Python rules they
reproduce.  Each hypothesis example is a batch of values evaluated in one
Spark job."""

import datetime as dt
import hashlib
import re
import unicodedata

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions import names
from lakeward.functions.text import iso_text, sanitize_string, unique_index_name_col
from lakeward.operators import records
from lakeward.plans import governance

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       　"
text_piece = st.sampled_from(["nan", "NaN", "NAT", "nat", "na", "n", "x", "\x00", "é", "ção", "1"] + list(SPACES))
texts = st.lists(text_piece, max_size=6).map("".join)


def py_sanitize(v):
    if v is None:
        return None
    cleaned = v.replace("\x00", "")
    return None if cleaned.strip().lower() in {"nat", "nan"} else cleaned


@SETTINGS
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=60))
def test_sanitize_string_matches_python(spark, values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.o for r in d.select("i", sanitize_string(F.col("s")).alias("o")).collect()}
    assert [got[i] for i in range(len(values))] == [py_sanitize(v) for v in values]


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)), min_size=1, max_size=60))
def test_iso_text_matches_isoformat(spark, values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, ts timestamp_ntz")
    got = {r.i: r.o for r in d.select("i", iso_text(F.col("ts")).alias("o")).collect()}
    assert [got[i] for i in range(len(values))] == [v.isoformat() for v in values]


name_text = st.text(
    alphabet=st.sampled_from(list("abcXYZ019_ -.#/çãéÅ你ß") + ["́", "‿", "½"]),
    min_size=1, max_size=40,
)


@SETTINGS
@given(st.lists(st.tuples(name_text, name_text, name_text), min_size=1, max_size=40))
def test_constraint_name_matches_driver(spark, triples):
    d = spark.createDataFrame([(i, *t) for i, t in enumerate(triples)], "i int, t string, a string, b string")
    got = {r.i: r.o for r in d.select("i", unique_index_name_col(F.col("t"), [F.col("a"), F.col("b")]).alias("o")).collect()}
    for i, triple in enumerate(triples):
        text = "_".join(("uq", *triple))
        kept = [c if c == "_" or unicodedata.category(c)[0] in "LN" else "_" for c in text]
        digest = hashlib.sha1("".join(kept).encode()).hexdigest()
        assert got[i] == "".join(kept[:54]) + "_" + digest[:8]


segment = st.sampled_from(["a", "b", "ab", "x1", "dag.py", "mir", "compras_gov"])
rel_paths = st.lists(segment, min_size=1, max_size=5).map("/".join)
patterns = st.sampled_from(["a/", "ab", "^a/", "x1/", "b/dag", "compras_gov/", r"\.py$", "mir"])


def py_selected(rel: str, pats: list[str]) -> bool:
    for p in pats:
        m = re.search(p, rel)
        if m and "/" not in rel[m.end():].lstrip("/"):
            return True
    return False


@SETTINGS
@given(st.lists(rel_paths, min_size=1, max_size=40), st.lists(patterns, min_size=1, max_size=3))
def test_select_paths_matches_rule(spark, rels, pats):
    root = "/srv/dags"
    d = spark.createDataFrame([(i, f"{root}/{r}") for i, r in enumerate(rels)], "i int, path string")
    kept = {r.i for r in governance.select_paths(d, "path", "\n".join(pats), root).collect()}
    assert kept == {i for i, r in enumerate(rels) if py_selected(r, pats)}


leaf = st.sampled_from([T.LongType(), T.StringType()])
field_names = st.sampled_from(list("abcdefg"))


def struct_types(depth=3):
    if depth == 0:
        return leaf
    return st.one_of(
        leaf,
        st.lists(st.tuples(field_names, st.deferred(lambda: struct_types(depth - 1))), min_size=1, max_size=4, unique_by=lambda x: x[0]).map(
            lambda fs: T.StructType([T.StructField(n, t) for n, t in fs])
        ),
    )


def sample_value(t, n=1):
    if isinstance(t, T.StructType):
        return {f.name: sample_value(f.dataType, n) for f in t.fields}
    return n if isinstance(t, T.LongType) else f"v{n}"


@SETTINGS
@given(st.lists(st.tuples(field_names, struct_types()), min_size=1, max_size=5, unique_by=lambda x: x[0]))
def test_flatten_order_matches_json_normalize(spark, fields):
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    record = {f.name: sample_value(f.dataType) for f in schema.fields}
    expected = list(pd.json_normalize([record], sep="__").columns)
    got = records.flatten(spark.createDataFrame([tuple(record[f.name] for f in schema.fields)], schema)).columns
    assert got == expected


cell = st.sampled_from(["1", "x", "", "NA", "null", "n/a", "a b", "é", '"q,1"', "0012", "-nan", "None", "nan"])


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.sampled_from(["A", "B", "A", "", "c", "B"]), min_size=1, max_size=5),
    st.lists(st.lists(cell, min_size=1, max_size=5), max_size=6),
    st.integers(min_value=0, max_value=2),
    st.booleans(),
)
def test_parse_csv_matches_pandas(header, rows, skiprows, has_header):
    import io

    from lakeward.sources import bundles

    width = len(header)
    body = [r[:width] for r in rows]
    lines = ["junk line"] * skiprows + [",".join(header)] + [",".join(r) for r in body]
    text = "\n".join(lines) + "\n"
    try:
        expected = pd.read_csv(io.StringIO(text), skiprows=skiprows, header=0 if has_header else None, dtype=str)
    except pd.errors.EmptyDataError:
        with __import__("pytest").raises(bundles.EmptyCsv):
            bundles.parse_csv_text(text, skiprows, None, has_header)
        return
    got_header, got_rows = bundles.parse_csv_text(text, skiprows, None, has_header)
    got_rows = list(got_rows)
    exp_rows = [[None if pd.isna(v) else v for v in r] for r in expected.itertuples(index=False, name=None)]
    assert got_rows == exp_rows
    if has_header:
        assert got_header == [str(c) for c in expected.columns]


keys_st = st.one_of(st.none(), st.integers(min_value=0, max_value=8))


@SETTINGS
@given(
    st.lists(st.tuples(keys_st, st.text(alphabet="abc", max_size=2), st.text(alphabet="xy", max_size=2)), max_size=25),
    st.lists(st.tuples(keys_st, st.text(alphabet="ABC", max_size=2), st.text(alphabet="pq", max_size=2)), max_size=15),
)
def test_upsert_matches_model(spark, target_rows, batch_rows):
    from lakeward.plans import tables

    # unique non-null keys per side (the batch check would raise otherwise)
    def unique_keys(rows):
        seen, out = set(), []
        for r in rows:
            if r[0] is None or r[0] not in seen:
                out.append(r)
                if r[0] is not None:
                    seen.add(r[0])
        return out

    target_rows, batch_rows = unique_keys(target_rows), unique_keys(batch_rows)
    t = spark.createDataFrame(target_rows, "k long, a string, b string")
    b = spark.createDataFrame(batch_rows, "k long, a string, c string")
    got = sorted(map(repr, (tuple(r) for r in tables.upsert_frames(t, b, ["k"]).collect())))

    # model: ON CONFLICT (k) DO UPDATE SET a, c (only the batch's columns)
    table = [[k, a, bb, None] for k, a, bb in target_rows]
    index = {row[0]: row for row in table if row[0] is not None}
    for k, a, c in batch_rows:
        if k is not None and k in index:
            index[k][1], index[k][3] = a, c
        else:
            table.append([k, a, None, c])
    assert got == sorted(repr(tuple(r)) for r in table)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.text(alphabet="uv", max_size=2)), max_size=60, unique_by=lambda r: (r[0], r[1], r[2])))
def test_dedup_matches_model(spark, rows):
    from lakeward.operators import dedup

    d = spark.createDataFrame(rows, "k long, o long, v string")
    got = sorted(tuple(r) for r in dedup.remove_duplicates(d, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in sorted(rows, key=lambda r: (r[1], r[2])):
        best.setdefault(k, (k, o, v))
    assert got == sorted(best.values())


@SETTINGS
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=60))
def test_py_strip_matches_python(spark, values):
    from lakeward.functions.text import py_strip

    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.o for r in d.select("i", py_strip(F.col("s")).alias("o")).collect()}
    assert [got[i] for i in range(len(values))] == [None if v is None else v.strip() for v in values]
