"""Payload fields: every edge of the JSON text, and one parse for all fields."""

import pytest
from pyspark.sql import functions as F

from lakezones.functions.payload import JoinedField, ListField, TextField, extract_fields, payload_schema
from lakezones.plans.refined_customers import CUSTOMER_FIELDS, refined_customers


def extract(spark, content, *fields):
    df = spark.createDataFrame([(content,)], "content string")
    return tuple(extract_fields(df, fields).first())


def first_name(spark, content, length=100):
    return extract(spark, content, TextField("first_name", ("firstName",), length))[0]


@pytest.mark.parametrize(
    "content, expected",
    [
        (None, ""),
        ("{bad", ""),
        ("", ""),
        ('[{"firstName":"A"}]', ""),
        ("{}", ""),
        ('{"firstName":null}', ""),
        ('{"FIRSTNAME":"A"}', ""),
        ('{"firstName":12}', "12"),
        ('{"firstName":1.50}', "1.5"),
        ('{"firstName":true}', "true"),
        ('{"firstName":{"a":1}}', '{"a":1}'),
        ('{"firstName":[1,2]}', "[1,2]"),
        ('{"firstName":"A","firstName":"B"}', "B"),
        ('{"firstName":"  A B  "}', "A B"),
        ('{"firstName":"\\tA"}', "\tA"),
        ('{"firstName":""}', ""),
        ('{"firstName":"Zoë 北京"}', "Zoë 北京"),
    ],
)
def test_text_field(spark, content, expected):
    assert first_name(spark, content) == expected


def test_text_is_trimmed_before_it_is_cut(spark):
    assert first_name(spark, '{"firstName":"   %s   "}' % ("é" * 120)) == "é" * 100
    assert first_name(spark, '{"firstName":"abcdef"}', 3) == "abc"


@pytest.mark.parametrize(
    "emails, expected",
    [
        ('[{"value":" a@x "},{"value":"a@x"}]', "a@x"),
        ('[{"value":"b"},{"value":"a"},{"value":"b"}]', "b,a"),
        ('[{"value":"A"},{"value":"a"}]', "A,a"),
        ('[{"value":""},{"value":null},{},{"value":"  "},{"value":"c"}]', "c"),
        ("[]", ""),
        ("null", ""),
        ('"a@x"', ""),
        ('[{"value":"%s"},{"value":"%s"}]' % ("x" * 60, "y" * 60), "x" * 60 + "," + "y" * 39),
    ],
)
def test_list_field(spark, emails, expected):
    field = ListField("email", ("emails",), "value")
    assert extract(spark, '{"emails":%s}' % emails, field) == (expected,)


@pytest.mark.parametrize(
    "content, expected",
    [
        ('{"firstName":"A","lastName":"B"}', "A B"),
        ('{"firstName":" A ","lastName":" B "}', "A   B"),
        ('{"firstName":"A"}', ""),
        ('{"lastName":"B"}', ""),
        ('{"firstName":"A","lastName":null}', ""),
        ('{"firstName":"","lastName":""}', ""),
        ('{"firstName":"","lastName":"B"}', "B"),
    ],
)
def test_joined_field(spark, content, expected):
    assert extract(spark, content, JoinedField("full_name", (("firstName",), ("lastName",)))) == (expected,)


@pytest.mark.parametrize(
    "embedded, expected",
    [
        ('{"address":{"city":" Ulm "}}', "Ulm"),
        ('{"address":{"City":"Ulm"}}', ""),
        ('{"address":null}', ""),
        ('{"address":[]}', ""),
        ('"none"', ""),
        ("null", ""),
    ],
)
def test_nested_field(spark, embedded, expected):
    field = TextField("city", ("_embedded", "address", "city"), 80)
    assert extract(spark, '{"_embedded":%s}' % embedded, field) == (expected,)


ODD_PAYLOADS = [
    None,
    "{bad",
    '{"firstName":"A", bad',
    '{"firstName":"A","emails":[{"value":"a"}',
    "[1]",
    '"text"',
    "7",
    '{"emails":"x","firstName":"A","lastName":"B","_embedded":{"address":{"city":"C"}}}',
    '{"firstName":"A","emails":"x","lastName":"B"}',
    '{"emails":[1,{"value":"v"}],"firstName":"A"}',
    '{"emails":["a"],"lastName":"B","location":"L"}',
    '{"_embedded":"x","firstName":"A","emails":[{"value":"v"}]}',
    '{"_embedded":{"address":"x","other":1},"firstName":"A"}',
    '{"_embedded":{"address":{"country":{"code":"DE"},"city":7,"state":null}},"location":["L"]}',
    '{"location":{"a":[1,"b"]},"firstName":3.0,"lastName":false}',
    '{"firstName":"A","firstName":"B","emails":[{"value":"x","value":"y"}]}',
    '{"firstName":"A"} trailing',
    '{"firstName":"A"}{"firstName":"B"}',
    "   ",
]


def test_one_parse_gives_what_a_parse_per_field_gives(spark):
    df = spark.createDataFrame(list(enumerate(ODD_PAYLOADS)), "n int, content string")
    together = extract_fields(df, CUSTOMER_FIELDS, keep=["n"]).orderBy("n").collect()
    for field in CUSTOMER_FIELDS:
        alone = extract_fields(df, [field], keep=["n"]).orderBy("n").collect()
        for one, all_fields, content in zip(alone, together, ODD_PAYLOADS):
            assert one[field.alias] == all_fields[field.alias], (field.alias, content)


def test_schema_holds_only_the_wanted_paths():
    fields = [TextField("a", ("x", "y")), TextField("b", ("x", "z")), ListField("c", ("l",), "v")]
    assert payload_schema(fields).simpleString() == "struct<x:struct<y:string,z:string>,l:array<struct<v:string>>>"


def test_refined_plan_parses_once_and_has_no_scratch_columns(spark, tmp_path):
    raw = spark.createDataFrame(
        [(2, 5, None, "u", '{"firstName":"A"}'), (1, 4, None, "u", None)],
        "Customer_Key long, customer_id long, created timestamp, updated string, Content string",
    )
    raw.write.parquet(str(tmp_path / "raw"))
    refined = refined_customers(spark.read.parquet(str(tmp_path / "raw")))
    plan = refined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert refined.columns == [
        "customer_key", "customer_id", "created", "updated", "updated_on", "email", "first_name", "last_name",
        "full_name", "location", "country_code", "state", "city", "postal_code",
    ]
    assert [row.customer_id for row in refined.collect()] == [4, 5]
    assert refined.filter(F.col("updated_on").isNull()).count() == 0
