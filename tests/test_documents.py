import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sluice.functions.naming import column_names
from sluice.operators import flatten as fl
from sluice.operators import infer as inf
from sluice.types import RuleViolation


def test_names_extend_to_the_left():
    paths = ["/root/a", "/root/a/id", "/root/b", "/root/b/id", "/root/b/@x:y", "/root/b/id/$"]
    generic = column_names(paths, "generic")
    assert generic["/root/a/id"] == "id" and generic["/root/b/id"] == "b_id" and generic["/root/b/@x:y"] == "atr_x_y"
    custom = column_names(paths, "custom")
    assert custom["/root/a/id"] == "a_id" and custom["/root/a"] == "root_a"
    assert custom["/root/b/id/$"] == custom["/root/b/id"] == "b_id"
    assert column_names(["/root/w/v/u"], "custom", update=["v/u"])["/root/w/v/u"] == "w_v_u"
    assert column_names(["/root/peci:Name"], "generic", remove=["peci:"])["/root/peci:Name"] == "name"


def test_flatten_lists_and_scopes(spark):
    docs = [
        '{"id": 1, "items": [{"x": 1, "subs": [{"s": 9}, {"s": 8}]}, {"x": 2}], "tail": true}',
        '{"id": 2, "items": [], "tags": ["a", null, "b"]}',
        '{"id": 2, "items": [], "tags": ["a", null, "b"]}',
        "{}", "not json", None, '{"id": 3, "deep": {"er": {"v": 1.5}}, "m": [[1, 2], [3]]}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    out = fl.flatten_json(df, "doc", naming="generic")
    got = {tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in out.collect()}
    item = lambda **kw: tuple(sorted(kw.items()))
    assert got == {
        item(id="1", tail="true"), item(id="1", tail="true", x="1"), item(id="1", tail="true", x="2"),
        item(id="1", tail="true", x="1", s="9"), item(id="1", tail="true", x="1", s="8"),
        item(id="2"), item(id="2", tags="a"), item(id="2", tags="b"),
        item(id="3", v="1.5"), item(id="3", v="1.5", m="1"), item(id="3", v="1.5", m="2"), item(id="3", v="1.5", m="3"),
    }
    assert out.count() == len(got)


def test_conflicting_types_have_columns_of_their_own(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": {"b": 2}}',), ('{"a": "t"}',)], "doc string")
    out = fl.flatten_json(df, "doc")
    assert out.columns == ["root_a", "a_b"] and set(rows(out)) == {("1", None), ("t", None), (None, "2")}
    assert "parse_json" not in out._jdf.queryExecution().executedPlan().toString().lower()
    want = [("/root/a", "bigint"), ("/root/a", "object"), ("/root/a", "string"), ("/root/a/b", "bigint")]
    assert rows(fl.json_paths(df, "doc")) == sorted(want, key=repr)


def test_conflicts_within_conflicts_and_lists(spark):
    """Against a plain walk over the parsed documents: objects, lists and scalars in one place, at several levels."""
    docs = [
        '{"k": 1, "x": [1, {"y": 2}, {"y": {"z": 3, "it\'s": [4, {"q": 5}]}}, [6, [7]]]}', '{"k": 2, "x": {"y": "t"}}', '{"k": 3, "x": null}',
        '{"k": 4, "x": {"y": [{"z": "u"}, 8, {}]}}', '{"k": 5, "x": "s"}', '{"k": {"deep": 1}, "x": []}', '[{"k": 9}, 10]', "11",
    ]
    out = fl.flatten_json(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc", naming="generic")

    def text(v):
        return {True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else str(v)

    def walk(v, name, around):
        """The rows of a value: of its lists' elements, and its own unless it is a list."""
        scalars, lists = {}, []

        def apart(v, name):
            if isinstance(v, dict):
                for k, inner in v.items():
                    apart(inner, k)
            elif isinstance(v, list):
                lists.append((name, v))
            elif v is not None:
                scalars[name] = text(v)

        apart(v, name)
        own = {**around, **scalars}
        for list_name, items in lists:
            for item in items:
                yield from walk(item, list_name, own)
        yield own

    want = {tuple(sorted(r.items())) for d in docs for r in walk(json.loads(d), "root", {}) if r}
    got = {tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in out.collect()}
    assert got == want


def test_paths_through_lists(spark):
    docs = ['{"l": [{"x": [[1, {"y": null}]]}, 2]}', "{}", "no", None, '[{"z": true}]']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    assert {r[0] for r in fl.json_paths(df, "doc").collect()} == {"/root/l", "/root/l/x", "/root/l/x/y", "/root/z"}
    assert fl.json_paths(df.limit(0), "doc").count() == 0


def test_too_many_fields_are_refused(spark):
    df = spark.createDataFrame([(f'{{"{i}": 1}}',) for i in range(40)], "doc string")
    assert len(fl.document_schema(df, "doc").fields) == 40
    with pytest.raises(RuleViolation):
        fl.document_schema(df, "doc", most_fields=39)


def test_given_schema_needs_no_extra_job(spark):
    df = spark.createDataFrame([('{"a": 1, "l": [{"b": 2}]}',)], "doc string")
    out = fl.flatten_json(df, "doc", "a INT, l ARRAY<STRUCT<b: INT>>")
    assert rows(out) == [("1", "2"), ("1", None)]
    assert out.columns == ["root_a", "l_b"]


def test_malformed_split_is_complete(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{",), (None,), ("[1]",)], "doc string")
    split = fl.split_json(df, "doc")
    assert split.good.count() == 2 and split.bad.count() == 2


def test_cell_classes(spark):
    want = {
        "": "", "  ": "", "2020-01-31": "yyyy-MM-dd", "2020-1-31": "yyyy-MM-dd", "2020/01/31": "yyyy/MM/dd", "31-01-2020": "dd-MM-yyyy",
        "01/02/2020": "dd/MM/yyyy", "01/31/2020": "MM/dd/yyyy", "20200131": "yyyyMMdd", "20201331": "bigint",
        "2020-01-31T10:11:12": "yyyy-MM-ddTHH:mm:ss", "31JAN2020:10:11:12": "ddMMMyyyy:HH:mm:ss", "2020-01-31 10:11:12": "yyyy-MM-dd HH:mm:ss",
        "31XXX2020:10:11:12": "string", "2020-02-30": "string", "2020-13-01": "string", "0": "bigint", "-12": "bigint", "012": "string", "1.50": "double", "-0.5": "double", "1.": "string",
        "abc": "string", "12 3": "string",
    }
    df = spark.createDataFrame([(k,) for k in want], "c string")
    assert {r["c"]: r["k"] for r in df.select("c", inf.classify(F.col("c")).alias("k")).collect()} == want
    assert spark.range(1).select(inf.classify(F.lit(None).cast("string"))).first()[0] == ""


def test_votes(spark):
    df = spark.createDataFrame(
        [("1", "1", "20200101", "01/02/2020", "31/12/2020", "", "1"), ("2", "2.5", "7", "13/02/2020", "12/31/2020", "", "x"), ("", "3", "20200102", "14/02/2020", "", "", "2.5")],
        "a string, b string, c string, d string, e string, f string, g string")
    got = inf.types_of(inf.infer_types(df))
    assert got == {"a": "bigint", "b": "double", "c": "bigint", "d": "dd/MM/yyyy", "e": "string", "f": "string", "g": "string"}
    cast = inf.cast_inferred(df, got)
    assert dict(cast.dtypes) == {"a": "bigint", "b": "double", "c": "bigint", "d": "date", "e": "string", "f": "string", "g": "string"}
    assert str(cast.first()["d"]) == "2020-02-01"


def test_delimiters(spark):
    for sep, name in ((",", "comma"), ("|", "pipe"), ("\t", "tab"), (" ", "spaces")):
        lines = spark.createDataFrame([(sep.join(["a", "b", str(i)]),) for i in range(20)], "value string")
        assert inf.detect_delimiter(lines).first()["candidate"] == name
        assert inf.detect_quoting(lines, inf.DELIMITERS[name]).first()["quoting"] == "none"
    lines = spark.createDataFrame([(f'"a","b{i}"',) for i in range(5)], "value string")
    assert inf.detect_quoting(lines, ",").first()["quoting"] == "all"


def test_quoted_delimiters_and_long_integers(spark):
    lines = spark.createDataFrame([('1|"x, y"|2',), ('3|"x, y"|4|5',), ('6|"x, y"|7',)], "value string")
    assert inf.detect_delimiter(lines).first()["candidate"] == "pipe"
    df = spark.createDataFrame([("12345678901234567890", "9223372036854775807"), ("1", "2")], "a string, b string")
    types = inf.types_of(inf.infer_types(df))
    assert types == {"a": "string", "b": "bigint"}
    assert inf.cast_inferred(df, types).where("a IS NULL OR b IS NULL").count() == 0


def test_ragged(spark):
    lines = spark.createDataFrame([("a,b",), ('"x,y",b',), ("a,b,c",), ("a",)], "value string")
    split = inf.split_ragged(lines, ",")
    assert rows(split.good) == [('"x,y",b',), ("a,b",)]
    assert split.bad.count() == 2
    assert rows(inf.split_fields(split.good, ",", ["p", "q"])) == [("a", "b"), ("x,y", "b")]
