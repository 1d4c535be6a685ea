"""Config text to typed structs: valid, invalid and odd input."""

import json

import pytest
from pyspark.sql import functions as F

from sampleward.functions import config_json, text
from sampleward.functions.compliance import (
    SIZE_FIELDS,
    block_percent,
    block_percent_of,
    first_given,
    granted_rows,
    is_empty,
    limit_rows,
    wanted_rows,
)
from sampleward.sources.catalog import label_match

MAX_LONG = 9223372036854775807


def requests(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    rows = config_json.parse_requests(df).orderBy("i").collect()
    return [(r["size"] and tuple(r["size"]), r["spec"]) for r in rows]


SIZES = [
    ('{"size":{"count":1}}', (1, None)),
    ('{"size":{"count":2600}}', (2600, None)),
    ('{"size":{"percentage":0.004}}', (None, 0.004)),
    ('{"size":{"percentage":100.0}}', (None, 100.0)),
    ('{"size":{"percentage":28}}', (None, 28.0)),
    ('{"size":{"count":23,"percentage":34.6}}', (23, 34.6)),
    ('{"size":{"count":0}}', (0, None)),
    ('{"size":{"count":-1}}', None),
    ('{"size":{"percentage":0}}', None),
    ('{"size":{"percentage":-0.002}}', None),
    ('{"size":{"percentage":100.002}}', None),
    ('{"size":{"count":23,"percentage":"12.5"}}', None),
    ('{"size":{"count":12.0}}', None),
    ('{"size":{"count":"19"}}', None),
    ('{"size":{"count":true}}', None),
    ('{"size":{"count":99999999999999999999}}', (MAX_LONG, None)),
    ('{"size":{"count":null,"percentage":5}}', (None, 5.0)),
    ('{"size":{"count":[1],"percentage":5}}', None),
    ('{"size":{}}', None),
    ('{"size":5}', None),
    ('{"Size":{"count":3}}', None),
    ("[1]", None),
    ("null", None),
    ("", None),
    ('"{}"', None),
    ("{rows:5}", None),
    ("{'size':{'count':3}}", None),
    (None, None),
    ('{"__doc__":"x","size":{"count":3,"more":[1]}}', (3, None)),
]


def test_sizes(spark):
    got = requests(spark, [t for t, _ in SIZES])
    assert [g[0] for g in got] == [want for _, want in SIZES]


def spec_of(value):
    return value and (value["type"], value["properties"] and tuple(value["properties"]))


SPECS = [
    ('{"spec":"abc"}', ("random", None)),
    ('{"spec":[]}', ("random", None)),
    ('{"spec":{}}', None),
    ('{"spec":null}', None),
    ('{"spec":{"type":5}}', None),
    ('{"spec":{"type":"other"}}', None),
    ('{"spec":{"type":"random"}}', ("random", None)),
    (
        '{"spec":{"type":" Sorted ","properties":{"by":" B","direction":"asc"}}}',
        (" Sorted ", None),
    ),
    (
        '{"spec":{"type":"sorted","properties":{"by":"B","direction":" desc"}}}',
        ("sorted", ("B", " desc")),
    ),
    ('{"spec":{"properties":{"by":"B","direction":"ASC"}}}', (None, ("B", "ASC"))),
    ('{"spec":{"type":"sorted","properties":{"by":123,"direction":"ASC"}}}', ("sorted", None)),
    ('{"spec":{"type":"sorted","properties":{"by":"","direction":"ASC"}}}', ("sorted", None)),
    ('{"spec":{"type":"sorted","properties":{"by":"c\\t","direction":"ASC"}}}', ("sorted", None)),
    ('{"spec":{"type":"sorted","properties":{"by":"c","direction":"ASC_NOT"}}}', ("sorted", None)),
    ('{"spec":{"type":"sorted","properties":"x"}}', ("sorted", None)),
]


def test_specs(spark):
    got = requests(spark, [t for t, _ in SPECS])
    assert [spec_of(g[1]) for g in got] == [want for _, want in SPECS]


def test_policies(spark):
    body = {
        "limit": {"count": 1050, "percentage": 35.1},
        "default_sample": {"size": {"count": 9, "percentage": 6.5}, "spec": {"type": "random"}},
    }
    df = spark.createDataFrame([(json.dumps(body),), ('{"limit": 3}',)], "content string")
    first, second = config_json.parse_policies(df).collect()
    assert tuple(first["limit"]) == (1050, 35.1) and tuple(first["size"]) == (9, 6.5)
    assert first["spec"]["type"] == "random"
    assert (second["limit"], second["size"], second["spec"]) == (None, None, None)


@pytest.mark.parametrize(
    "limit,size,rows,want",
    [
        ((1000, 30.1), (18, 11.2), 10, 3),
        ((1234, 35.1), (3000, 11.7), 10000, 1234),
        ((1050, 35.1), (9, 6.5), 5, 1),
        ((1050, 35.1), (9, 6.5), 100, 9),
        ((1050, 35.1), (9, 6.5), 1000, 65),
        ((1050, 35.1), (9, 6.5), 6000, 390),
        ((1050, 35.1), (9, 6.5), 15000, 975),
        ((1050, 35.1), (9, 6.5), 60000, 1050),
        ((1050, 35.1), (9, 6.5), 0, 0),
        ((1000, None), (MAX_LONG, None), 10, 1000),
        ((None, 50.0), (None, 10.0), 11, 2),
    ],
)
def test_granted_rows(spark, limit, size, rows, want):
    df = spark.createDataFrame(
        [(rows, limit, size)],
        "n bigint, l struct<count:bigint,percentage:double>, s struct<count:bigint,percentage:double>",
    )
    got = df.select(granted_rows(F.col("n"), F.col("l"), F.col("s")).alias("g")).first().g
    assert got == want


def test_percentages_are_computed_in_double(spark):
    df = spark.createDataFrame(
        [(1000, (None, 16.1), (None, 32.3))],
        "n bigint, s struct<count:bigint,percentage:double>, l struct<count:bigint,percentage:double>",
    )
    row = df.select(
        wanted_rows(F.col("n"), F.col("s")).alias("w"), limit_rows(F.col("n"), F.col("l")).alias("l")
    ).first()
    assert (row.w, row.l) == (162, 322)


def test_block_percent(spark):
    vectors = [(12, 12, 100), (1, 1, 100), (3, 40, 100), (700000, 2, 1), (0, 5, 0)]
    vectors += [(30, 7, 24), (40, 9, 23)]
    df = spark.createDataFrame(vectors, "rows bigint, amount bigint, want bigint")
    assert df.filter(block_percent(F.col("rows"), F.col("amount")) != F.col("want")).count() == 0
    assert all(block_percent_of(rows, amount) == want for rows, amount, want in vectors)


def test_emptiness_and_merge(spark):
    kind = "struct<count:bigint,percentage:double>"
    df = spark.createDataFrame(
        [((0, None), (17, 1.0)), ((None, None), (17, None)), (None, (17, 2.0))], f"a {kind}, b {kind}"
    )
    rows = df.select(
        is_empty(F.col("a"), SIZE_FIELDS).alias("e"),
        first_given(SIZE_FIELDS, F.col("a"), F.col("b")).alias("m"),
    ).collect()
    assert [r.e for r in rows] == [False, True, True]
    assert [tuple(r.m) for r in rows] == [(0, None), (17, None), (17, 2.0)]


def test_table_refs(spark):
    vectors = {
        "a.b.c": ("a", "b", "c", None),
        " a . b . c @ EU ": ("a", "b", "c", "EU"),
        "a.b.c@": ("a", "b", "c", None),
        "a.b": None,
        "a.b.c.d": None,
        "a..c": None,
        "a. .c": None,
        "a.b.c@x@y": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in vectors], "t string")
    got = df.select("t", text.parse_table_ref(F.col("t")).alias("r")).collect()
    assert {row.t: row.r and tuple(row.r) for row in got} == vectors


def test_text_helpers(spark):
    row = (
        spark.range(1)
        .select(
            text.format_table_ref(F.lit(" a"), F.lit("b "), F.lit("c"), F.lit(" EU ")).alias("with_at"),
            text.format_table_ref(F.lit("a"), F.lit("b"), F.lit("c"), F.lit(" ")).alias("without"),
            text.valid_identifier(F.lit("Ab-c.é" + "x" * 2000)).alias("ident"),
            text.with_trailing_slash(F.lit("a/b")).alias("prefix"),
            text.object_uri_parts(F.lit("gs://bu/x/y.json")).alias("uri"),
            text.object_uri_parts(F.lit("s3://bu/x")).alias("bad_uri"),
            text.config_object_path(F.lit("a"), F.lit("b"), F.lit("c")).alias("path"),
        )
        .first()
    )
    assert (row.with_at, row.without) == ("a.b.c@EU", "a.b.c")
    assert row.ident.startswith("ab_c__x") and len(row.ident) == 1023
    assert (row.prefix, row.path) == ("a/b/", "a/b/c.json")
    assert tuple(row.uri) == ("bu", "x/y.json") and row.bad_uri is None


def test_iso_to_epoch(spark):
    stem = "2022-10-07T11:01:38"
    good = [stem + end for end in ("", ".1", ".12", ".123", "Z", ".1Z", ".12Z", ".123Z")]
    bad = ["", "x", "2022-13-01T00:00:00", None]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = [row.e for row in df.select(text.iso_to_epoch(F.col("t")).alias("e")).collect()]
    assert got == [1665140498] * len(good) + [None] * len(bad)


def test_label_match(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "2"},), ({"a": "1"},), ({"a": "2", "b": "2"},), ({},)], "l map<string,string>"
    )
    hit = [r.m for r in df.select(label_match(F.col("l"), {"a": "1", "b": "2"}).alias("m")).collect()]
    assert hit == [True, False, False, False]
    assert all(r.m for r in df.select(label_match(F.col("l"), {}).alias("m")).collect())
