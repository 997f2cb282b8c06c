import gzip
import io
import json
import zipfile

import pandas as pd
import pytest

from pyspark.sql import functions as F

from tabularium.plans import files, genes, molecules, studies
from tabularium.sources import archive, delimited, landed, listing, obo, xmlsrc
from tabularium.streaming import landing


def test_page_files_with_several_envelopes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"hits": [{"id": 1}, {"id": 2}]}, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([{"id": 3}], indent=2))
    (tmp_path / "c.json").write_text(json.dumps({"hits": [], "response": {"result": [{"id": 4}]}}))
    (tmp_path / "d.json").write_text("{broken")
    pages = landed.read_pages(spark, str(tmp_path))
    assert pages.count() == 4
    items = landed.unwrap_pages(pages, "page", ["$.hits", "$.response.result", "$"], keep=["file"])
    assert sorted(r[0] for r in items.select(F.variant_get("item", "$.id", "int")).collect()) == [1, 2, 3, 4]
    paths = ["$.hits", "$.response.result", "$"]
    rejected = landed.rejected_pages(pages, "page", paths, keep=["file"]).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["reason"]) for r in rejected] == [("d.json", "unreadable")]
    with pytest.raises(Exception, match="rejected: unreadable"):
        landed.unwrap_pages(pages, "page", paths, strict=True).collect()
    odd = spark.createDataFrame([('{"error":1}',), ('{"hits":{"a":1}}',), ('{"hits":[]}',), (None,), ("[]",)], "page string")
    assert [r["reason"] for r in landed.rejected_pages(odd, "page", ["$.hits"]).collect()] == ["no known envelope", "wrong shape", "unreadable", "no known envelope"]
    assert [r["reason"] for r in landed.rejected_pages(odd, "page", ["$.hits", "$"]).collect()] == ["no known envelope", "wrong shape", "unreadable"]


def test_header_counts_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("b,more,a\ntwo,m,1\nq,n,bad\n")
    rows = delimited.read_table(spark, str(tmp_path / "a"), "a int, b string, c date", sep=",")
    assert rows.columns == ["a", "b", "c", "more"] and [tuple(r) for r in rows.collect()] == [(1, "two", None, "m"), (None, "q", None, "n")]
    (tmp_path / "a" / "y.csv").write_text("a,b,more\n1,two,m\n")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_table(spark, str(tmp_path / "a"), "a int, b string, c date", sep=",").collect()


def test_gaps_over_bucket_borders(spark):
    rows = [("s", p) for p in (1, 2, 9, 10, 11, 30, 31, 99)] + [("t", 5), ("u", None)]
    df = spark.createDataFrame(rows, "source string, page int")
    for bucket in (1, 3, 10, 1000):
        assert sorted(tuple(r) for r in landed.page_gaps(df, "source", "page", bucket).collect()) == [("s", 3, 8), ("s", 12, 29), ("s", 32, 98)]


def test_page_audit_and_gaps(spark):
    rows = [("s", 1, 10, 32, "a", "b"), ("s", 2, 10, 32, "b", "b"), ("s", 2, 10, 32, "b", "b"), ("s", 5, 2, 32, "e", None), ("t", 0, 0, 0, None, None)]
    df = spark.createDataFrame(rows, "source string, page int, n int, total int, cur string, nxt string")
    got = {r["source"]: r for r in landed.page_audit(df, "source", "page", "n", "total", "cur", "nxt", 10).collect()}
    s = got["s"]
    assert (s["n_pages"], s["n_records"], s["missing_pages"], s["repeated_pages"], s["stuck_cursors"], s["open_ends"], s["complete"]) == (3, 22, 2, 1, 1, 1, False)
    assert got["t"]["complete"] and got["t"]["empty_pages"] == 1 and got["t"]["stuck_cursors"] == 0
    assert [tuple(r) for r in landed.page_gaps(df, "source", "page").collect()] == [("s", 3, 4)]


def test_delimited_options(spark, tmp_path):
    path = tmp_path / "t.tsv.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("# note\na\tb\tc\n1\tx\tNA\n2\t\"q\n# late\n3\ty\tz\textra\n")
    rows = delimited.read_table(spark, str(path), "a int, b string, c string", comment="#", null_values=["NA"], partitions=3)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x", None), (2, '"q', None), (3, "y", "z")]
    assert rows.rdd.getNumPartitions() == 3


def test_annotation_file(spark, tmp_path):
    line = "\t".join(f"v{i}" for i in range(17))
    path = tmp_path / "g.gaf.gz"
    with gzip.open(path, "wt") as fh:
        fh.write(f"!gaf-version: 2.2\n{line}\n!x\n{line}\n")
    rows = delimited.read_annotations(spark, str(path))
    assert rows.columns == list(delimited.GAF_COLUMNS) and rows.count() == 2 and rows.first()["gene_product_form_id"] == "v16"


def test_zip_member(spark, tmp_path):
    for name, members in {"a.zip": {"README": "x", "d.tsv": "h\n1\tä\n2\tb", "sub/e.tsv": "z"}, "b.zip": {"only.md": "x"}}.items():
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for member, body in members.items():
                z.writestr(member, body)
        (tmp_path / name).write_bytes(buffer.getvalue())
    lines = archive.archive_lines(archive.read_archives(spark, str(tmp_path)), ".tsv", batch=2)
    assert [(r["member"], r["line_no"], r["line"]) for r in lines.orderBy("member", "line_no").collect()] == [("d.tsv", 0, "h"), ("d.tsv", 1, "1\tä"), ("d.tsv", 2, "2\tb"), ("sub/e.tsv", 0, "z")]


def test_xml_rows(spark, tmp_path):
    path = tmp_path / "p.xml"
    path.write_text("""<?xml version="1.0"?><R><DisorderList count="3">
      <Disorder id="1"><OrphaCode>58</OrphaCode><Name> A </Name><ExternalReferenceList><ExternalReference><Source>OMIM</Source><Reference>1</Reference></ExternalReference>
        <ExternalReference><Source>ICD</Source><Reference>2</Reference></ExternalReference></ExternalReferenceList></Disorder>
      <Disorder id="2"><OrphaCode>59</OrphaCode><Name>B</Name><ExternalReferenceList count="0"/></Disorder>
      <Disorder id="3"><OrphaCode>x</OrphaCode><Name>C</Name></Disorder></DisorderList></R>""")
    rows = molecules.disorder_xrefs(xmlsrc.read_xml(spark, str(path), "Disorder", molecules.DISORDER_XML))
    assert sorted((r["disorder_name"], r["orpha_code"], r["xref_source"], r["xref_id"]) for r in rows.collect()) == [
        ("A", 58, "ICD", "2"), ("A", 58, "OMIM", "1"), ("B", 59, None, None), ("C", None, None, None)]


def test_obo_keeps_terms_only(spark, tmp_path):
    path = tmp_path / "o.obo"
    path.write_text("format-version: 1.2\n\n[Term]\nid: X:1\nname: one\nis_a: X:0 ! zero\nrelationship: has_role X:9 ! nine\n\n"
                    "[Term]\nid: X:2\nis_a: X:1\n\n[Typedef]\nid: has_role\nis_a: X:1\n")
    got = {tuple(r) for r in obo.term_edges(obo.read_stanzas(spark, str(path))).collect()}
    assert got == {("X:1", "one", "X:0", "is_a"), ("X:1", "one", "X:9", "has_role"), ("X:2", "", "X:1", "is_a")}


def test_listing(spark):
    raw = ["drwxr-xr-x  2 ftp ftp  4096 Mar 22  2023 experiments", "-rw-r--r-- 1 ftp ftp 1234567 Jan 1 10:00 a b.CZI", "total 12"]
    df = spark.createDataFrame([(s,) for s in raw], "line string")
    assert sorted(tuple(r) for r in listing.parse_listing(df, "line").collect()) == [
        ("a b.CZI", "file", 1234567, 1.235, ".czi"), ("experiments", "dir", 4096, 0.004, "(none)")]


def test_stream_equals_batch_and_reads_new_files_only(spark, tmp_path):
    pages, out, state = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "state")
    pages.mkdir()
    (pages / "1.json").write_text(json.dumps({"hits": [{"accession": "a"}, {"accession": "b"}]}, indent=1))
    flatten = lambda df: studies.STUDY_RECORDS.from_pages(df, "value")
    landing.land_new(landing.page_stream(spark, str(pages), whole=True), flatten, out, state)
    assert spark.read.parquet(out).count() == 2
    (pages / "2.json").write_text(json.dumps({"hits": [{"accession": "c"}]}))
    landing.land_new(landing.page_stream(spark, str(pages), whole=True), flatten, out, state)
    landing.land_new(landing.page_stream(spark, str(pages), whole=True), flatten, out, state)
    batch = flatten(landed.read_pages(spark, str(pages)).select(F.col("page").alias("value")))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(map(tuple, batch.collect()))


def test_wrong_types_lose_the_value_not_the_record(spark):
    doc = '{"molecules":[{"molecule_chembl_id":"C1","max_phase":4,"molecule_properties":{"hbd":"x","full_mwt":12.5}},{"molecule_chembl_id":"C2","molecule_properties":null}]}'
    rows = molecules.DRUGS.from_pages(spark.createDataFrame([(doc,)], "page string")).orderBy("chembl_id").collect()
    assert [(r["chembl_id"], r["max_phase"], r["hbd_count"], r["molecular_weight"]) for r in rows] == [("C1", 4, None, 12.5), ("C2", None, None, None)]


PLANS = [p for m in (studies, genes, molecules) for p in vars(m).values() if type(p).__name__ == "JsonTable"]


def test_every_json_table_keeps_its_schema_without_rows(spark):
    empty = spark.createDataFrame([], "page string")
    full = spark.createDataFrame([("{}",)], "record string")
    for plan in PLANS:
        a, b = plan.from_pages(empty), plan.from_records(full)
        assert a.schema.simpleString() == b.schema.simpleString() and a.count() == 0, plan.name


def test_records_are_made_once_where_they_are_made_of_columns(spark):
    made = spark.range(3).select("id", F.to_json(F.struct(F.lit("C1").alias("molecule_chembl_id"), F.col("id").alias("max_phase"))).alias("record"))
    rows = molecules.DRUGS.from_records(made, keep=["id"])
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("struct(molecule_chembl_id, C1") == 1
    odd = spark.createDataFrame([("{}",), (None,), ("[]",), ('{"a": 1, "a": 2}',), ('{"molecule_chembl_id": "C1"',), (' {"molecule_chembl_id": "C2"}',)], "record string")
    assert [r.chembl_id for r in molecules.DRUGS.from_records(odd, keep=["record"]).collect()] == [None, "C2"]


def test_every_text_table_reads_an_empty_folder_of_lines(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    for table in (t for t in vars(files).values() if isinstance(t, files.TextTable)):
        assert table.read(spark, str(tmp_path)).count() == 0, table.name


def test_number_sent_as_text(spark):
    pages = spark.createDataFrame([('{"calls":[{"gene":{"geneId":"g"},"expressionScore":"97.5","rank":"x","condition":{"anatEntityId":"a"}}]}',)], "page string")
    row = genes.EXPRESSION_CALLS.from_pages(pages).first()
    assert (row["gene_id"], row["expression_score"], row["expression_rank"]) == ("g", 97.5, None)


def test_small_archives_share_a_batch(monkeypatch):
    """Lines of many archives go on together, at most batch lines or about CHARACTERS of text at once."""
    class Archives:
        def select(self, *columns):
            return self

        def mapInPandas(self, function, schema):
            return function

    def zipped(lines):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("a.tsv", "".join(f"{line}\n" for line in lines))
        return buffer.getvalue()

    def sizes(batch):
        frames = pd.DataFrame({"path": [f"{i}.zip" for i in range(50)], "content": [zipped(["x" * 10, "y"])] * 50})
        found = list(archive.archive_lines(Archives(), ".tsv", batch)(iter([frames[:20], frames[20:], frames[:0]])))
        rows = pd.concat(found)
        assert rows["path"].tolist() == [f"{i}.zip" for i in range(50) for _ in range(2)]
        assert rows["line_no"].tolist() == [0, 1] * 50 and rows["line"].tolist() == ["x" * 10, "y"] * 50
        return [len(f) for f in found]

    assert sizes(1000) == [100] and sizes(30) == [30, 30, 30, 10]
    monkeypatch.setattr(archive, "CHARACTERS", 100)
    assert max(sizes(1000)) < 25
