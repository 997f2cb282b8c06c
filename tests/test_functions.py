import datetime

import pytest
from pyspark.sql import functions as F

from tabularium.functions import casts, fallback, names, nested, text


def one(spark, value, ddl, *cols):
    return spark.createDataFrame([value], ddl).select(*cols).first()


def test_name_styles():
    assert names.normalise_name("geneName", "snake") == "gene_name"
    assert names.normalise_name("Gene-Name X", "snake") == "gene_name_x"
    assert names.normalise_name("Rhea ID", "spaced") == "rhea_id"
    assert names.normalise_name("  A - b  c", "runs") == "a_b_c"
    assert names.normalise_name("RHEA_ID", "lower") == "rhea_id"
    with pytest.raises(ValueError):
        names.normalise_name("x", "other")


def test_clashing_names_are_an_error(spark):
    with pytest.raises(ValueError):
        names.normalise_names(spark.createDataFrame([(1, 2)], "aB int, a_b int"), "snake")


def test_safe_and_strict_casts(spark):
    df = spark.createDataFrame([("7",), ("n/a",), ("",), (None,), (" 7 ",), ("7.5",)], "s string")
    assert [r[0] for r in df.select(casts.safe("s", "int")).collect()] == [7, None, None, None, 7, None]
    assert [r[0] for r in df.filter("s = '7'").select(casts.strict("s", "int")).collect()] == [7]
    with pytest.raises(Exception, match="not a int"):
        df.select(casts.strict("s", "int")).collect()


def test_dates(spark):
    df = spark.createDataFrame([("2020-01-02",), ("2020-1-2",), ("2020-01-02T10:00",), ("",), (None,), ("2020-02-30",)], "s string")
    assert [r[0] for r in df.select(casts.safe_date("s")).collect()] == [datetime.date(2020, 1, 2), None, None, None, None, None]
    assert one(spark, ("2020-01-02T10:00Z",), "s string", casts.safe_date(casts.date_prefix("s")))[0] == datetime.date(2020, 1, 2)


def test_utc_timestamp_ignores_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = one(spark, ("2021-03-28T02:30:00.1234567+02:00",), "s string", casts.utc_timestamp("s"))[0]
            assert got == datetime.datetime(2021, 3, 28, 0, 30, 0, 123456)
            assert one(spark, ("1969-12-31T23:59:59.5Z",), "s string", casts.utc_timestamp("s"))[0] == datetime.datetime(1969, 12, 31, 23, 59, 59, 500000)
            assert one(spark, ("soon",), "s string", casts.utc_timestamp("s"))[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_truthy_and_present(spark):
    ddl = "a string, b string, n int, m int"
    assert tuple(one(spark, ("", "x", 0, 5), ddl, fallback.first_truthy(F.col("a"), F.col("b")),
                     fallback.first_truthy(F.col("n"), F.col("m"), kind="number"), fallback.first_present(F.col("a"), F.col("b")))) == ("x", 5, "")
    assert one(spark, ([], [1]), "a array<int>, b array<int>", fallback.first_truthy(F.col("a"), F.col("b"), kind="list"))[0] == [1]


def test_null_tokens_and_present_casts(spark):
    df = spark.createDataFrame([("NA", " - ", "1"), ("x", "", "z")], "a string, b string, c string")
    assert [tuple(r) for r in casts.null_tokens(df, ["", "NA", "-"]).collect()] == [(None, None, "1"), ("x", None, "z")]
    assert casts.cast_present(df, {"c": "int", "gone": "int"}).schema["c"].dataType.simpleString() == "int"


@pytest.mark.parametrize("raw, want", [("uniprotkb:P1", "P1"), ("plain", "plain"), ("a:b:c", "b:c"), ("x:", ""), (None, None)])
def test_after_first(spark, raw, want):
    assert one(spark, (raw,), "s string", text.after_first(F.col("s"), ":"))[0] == want


@pytest.mark.parametrize("raw, want", [("1.10.8.10", (1, 10, 8, 10)), ("1.10", (1, 10, 0, 0)), ("", (0, 0, 0, 0)), (None, (0, 0, 0, 0)),
                                       ("1.x.2", (1, None, 2, 0))])
def test_dotted_levels(spark, raw, want):
    assert tuple(one(spark, (raw,), "s string", *text.dotted_levels(F.col("s"), ["a", "b", "c", "d"]))) == want


@pytest.mark.parametrize("raw, want", [("a.CZI", ".czi"), ("a.b.tar", ".tar"), (".hidden", "(none)"), ("none", "(none)"), ("a..b", ".b"), ("x.", "(none)")])
def test_extension(spark, raw, want):
    assert one(spark, (raw,), "s string", text.extension(F.col("s")))[0] == want


def test_accession_path(spark):
    path = lambda a: one(spark, (a,), "s string", text.accession_path(F.col("s")))[0]
    assert path("S-BIAD144") == "S-BIAD/144/S-BIAD144/Files"
    assert path("S-BIAD2119") == "S-BIAD/119/S-BIAD2119/Files"
    assert path("S-BSST7") == "S-BSST/007/S-BSST7/Files"
    assert path("EMPIAR1") is None
    with pytest.raises(Exception, match="invalid accession"):
        one(spark, ("EMPIAR1",), "s string", text.accession_path(F.col("s"), strict=True))


def test_optional_regex_group(spark):
    from tabularium.plans.molecules import MOLAR_UNITS
    pattern = text.stated_quantity("km", MOLAR_UNITS, of="for")
    note = "Km=0.15 mM for ethanol (pH 7); KM = 2 µM; km=1.2.3 nM for x, done"
    got = one(spark, (note,), "s string", text.match_structs(F.col("s"), pattern, {"v": 1, "u": 2, "s": 3}, {"s": "unknown"}))[0]
    # The first value is followed by a bracket, which the pattern does not end on.
    assert [tuple(g) for g in got] == [("2", "µM", "unknown"), ("1.2.3", "nM", "x")]


def test_next_link_preview_relation(spark):
    r = one(spark, ('<https://x/y?c=1>; rel="next"', "abcdef", "has_role X:1 ! label"), "h string, t string, l string",
            text.next_link(F.col("h")), text.preview(F.col("t"), 3), *text.relation_parts(F.col("l")))
    assert tuple(r) == ("https://x/y?c=1", "abc…", "has_role", "X:1")


def variant(spark, doc):
    return spark.createDataFrame([(doc,)], "doc string").select(F.parse_json("doc").alias("v"))


def test_scalar_list_and_missing(spark):
    v = F.col("v")
    for doc, want in [('{"a":{"n":"x"}}', "x"), ('{"a":[{"n":"y"},{"n":"z"}]}', "y"), ('{"a":[]}', None), ('{"b":1}', None), ('{"a":null}', None)]:
        assert variant(spark, doc).select(nested.item_or_first(v, "$.a", ".n")).first()[0] == want
    for doc, want in [('{"d":[1,2]}', 2), ('{"d":7}', 7), ("{}", 0)]:
        assert variant(spark, doc).select(nested.list_or_count(v, "$.d")).first()[0] == want


def test_keyed_lookup_first_last_and_blank(spark):
    attrs = [("a", "1"), ("A", "2"), ("a", "3"), ("b", ""), ("b", "4")]
    ddl = "x array<struct<name: string, value: string>>"
    x = F.col("x")
    got = one(spark, (attrs,), ddl, nested.kv_get(x, "a"), nested.kv_get(x, "a", keep="last"), nested.kv_get(x, "A", ignore_case=True, keep="last"),
              nested.kv_get(x, "b"), nested.kv_get(x, "b", skip_blank=True), nested.kv_get(x, "c"))
    assert tuple(got) == ("1", "3", "3", "", "4", None)
    assert one(spark, ([],), ddl, nested.kv_get(x, "a", keep="last"))[0] is None
    assert one(spark, (None,), ddl, nested.kv_get(x, "a"))[0] is None


def test_join_list(spark):
    x = F.col("x")
    got = one(spark, (["b", "", None, "a", "b"],), "x array<string>", nested.join_list(x), nested.join_list(x, distinct=True, order=True),
              nested.join_list(x, keep_blank=True), nested.list_size(F.lit(None).cast("array<int>")))
    assert tuple(got) == ("b | a | b", "a | b", "b |  | a | b", 0)
    assert one(spark, ([],), "x array<string>", nested.join_list(x))[0] is None


def test_tree_of_any_depth(spark):
    doc = '{"name":"r","files":[{"name":"d","files":[{"name":"e","files":[{"name":"f.txt","size":3}]},{"name":"g","size":1,"type":"raw"}]},{"name":"h"}]}'
    df = variant(spark, doc).withColumn("id", F.lit(1))
    rows = {r["path"]: (r["name"], r["size"], r["type"]) for r in nested.leaf_files(df, ["id"], "v").collect()}
    assert rows == {"r/d/e/f.txt": ("f.txt", 3, "txt"), "r/d/g": ("g", 1, "raw"), "r/h": ("h", None, None)}
    with pytest.raises(Exception, match="tree deeper than 2 levels"):
        nested.leaf_files(df, ["id"], "v", depth=2).collect()
    deep = "".join('{"name":"n","files":[' for _ in range(15)) + '{"name":"leaf","size":9}' + "]}" * 15
    got = nested.leaf_files(variant(spark, deep).withColumn("id", F.lit(1)), ["id"], "v").collect()
    assert [(r["path"].count("/"), r["size"]) for r in got] == [(15, 9)]
    bare = variant(spark, '[{"name":"a.x","size":1},{"name":"b.y","size":2}]').withColumn("id", F.lit(1))
    assert {r["path"] for r in nested.leaf_files(bare, ["id"], "v").collect()} == {"a.x", "b.y"}


def test_attribute_search_order(spark):
    leaf = '{"attributes":[{"name":"organism","value":"%s"}]}'
    doc = '{"section":{"attributes":[{"name":"Organism","value":""}],"subsections":[{"subsections":[%s]},%s]},"subsections":[%s]}' % (leaf % "deep", leaf % "late", leaf % "outer")
    got = nested.find_attribute(variant(spark, doc), "v", "ORGANISM", "o").first()["o"]
    assert got == "deep"


def test_matrix_rules(spark):
    ddl = "id int, A array<double>, C array<double>, G array<double>, T array<double>"
    good, short, gone = (1, [1.0, 2.0], [0.0, 0.0], [3.0, 4.0], [5.0, 6.0]), (2, [1.0], [1.0, 2.0], [1.0], [1.0]), (3, [1.0], [1.0], [1.0], None)
    df = spark.createDataFrame([good, short, gone], ddl)
    problem = nested.matrix_problem([F.col(b) for b in nested.BASES])
    assert [r[0] for r in df.orderBy("id").select(problem).collect()] == [None, "unequal lengths", "missing bases: T"]
    rows = nested.matrix_long(df, ["id"]).orderBy("pos", "base").collect()
    assert [(r["pos"], r["base"], r["n"]) for r in rows][:4] == [(0, "A", 1.0), (0, "C", 0.0), (0, "G", 3.0), (0, "T", 5.0)] and len(rows) == 8
    with pytest.raises(Exception, match="missing bases|unequal"):
        nested.matrix_long(df, ["id"], strict=True).collect()


def test_pivot_and_long_form_of_attributes(spark):
    df = spark.createDataFrame([(1, [("a", "x"), ("b", "y"), ("a", "z")]), (2, [])], "id int, m array<struct<name: string, value: string>>")
    names = [r["key"] for r in nested.attribute_names(df, "m").collect()]
    got = nested.pivot_keys(df, ["id"], "m", "k_", names).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "z", "y"), (2, None, None)]
    assert nested.pivot_keys(df, ["id"], "m", "k_", ["b"]).columns == ["id", "k_b"]
    assert sorted(tuple(r) for r in nested.attribute_rows(df, ["id"], "m").collect()) == [(1, "a", "z"), (1, "b", "y")]


def test_link_header_grammar(spark):
    link = lambda h: one(spark, (h,), "s string", text.next_link(F.col("s")))[0]
    assert link('<https://x/1,2>; title="a"; rel=next, <https://x/0>; rel="prev"') == "https://x/1,2"
    assert link('<https://x/0>; rel="prev", <https://x/2>; REL="last next"') == "https://x/2"
    assert link('<https://x/0>; rel="nextish"') is None and link("") is None and link(None) is None
