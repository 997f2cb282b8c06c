"""Plans and forms that keep work and memory in proportion to the input."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabularium.checks import declared, registry
from tabularium.checks.all import CHECKS
from tabularium.checks.measures import first_of_name, matrices
from tabularium.operators import ecology, enrichment, fits, multiple, network, quantiles, ranks, sequences
from tabularium.plans import molecules
from tabularium.sources import xmlsrc

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_motifs_of_parts_need_no_join(spark):
    rows = [(3, "hot bolt", "LARGE", 1), (1, "hot bolt", "SMALL", 1), (2, "hot bolt", "LARGE", 13), (9, "hot bolt", "LARGE", 2), (7, None, "LARGE", 1), (8, "rod", None, 5)]
    parts = spark.createDataFrame(rows, "p_partkey long, p_name string, p_type string, p_size int")
    assert "Join" not in plan(matrices(parts)) and "Join" not in plan(first_of_name(parts))
    wanted = {r.p_name: r.m for r in matrices(parts).where("p_partkey = 3").collect()}
    assert {r.p_name: r.m for r in first_of_name(parts).collect()} == wanted


def test_overlaps_have_tasks_by_their_pairs(spark, monkeypatch):
    monkeypatch.setattr(enrichment, "TASK_PAIRS", 10)
    rows = [(s, m) for s in range(12) for m in range(10 + s % 3)] + [(99, 500), (None, 1), (3, None), (0, 0)]
    found = enrichment.set_overlaps(spark.createDataFrame(rows, "s long, m long"), "s", "m")
    pairs = sum(n * (n - 1) // 2 for n in [12] * 10 + [8, 4])
    said = plan(found)
    assert "RepartitionByExpression [_key#" in said and f"], {-(-pairs // 10)}" in said
    assert found._jdf.queryExecution().executedPlan().toString().count("ENSURE_REQUIREMENTS") == 0
    got = {(r.a, r.b): (r.shared, r.jaccard) for r in found.collect()}
    size = {s: 10 + s % 3 for s in range(12)}
    shared = {(a, b): min(size[a], size[b]) for a in range(12) for b in range(a + 1, 12)}
    assert got == {(a, b): (n, n / (size[a] + size[b] - n)) for (a, b), n in shared.items()}


def test_bootstrap_hashes_a_row_once(spark):
    df = spark.range(50).select("id", F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    said = plan(fits.bootstrap_mean(df, "v", "id", ["g"], 40))
    assert said.count("md5(") <= 2 and "lambda" not in said


def test_bray_curtis_shuffles_samples_and_not_pairs(spark, monkeypatch):
    monkeypatch.setattr(ecology, "BLOCK_SAMPLES", 7)
    cells = {(f"s{s:02}", t): 1 + (s * 7 + t * 3) % 11 for s in range(30) for t in range(12) if (s + t) % 3 or t == 11 and s % 10}
    cells |= {("alone", 99): 4}
    df = spark.createDataFrame([(s, str(t), n) for (s, t), n in cells.items()], "sample string, taxon string, n long").repartition(5)
    found = ecology.bray_curtis(df)
    assert "Join" not in plan(found)
    names, taxa = sorted({s for s, _ in cells}), {t for _, t in cells}
    total = {s: sum(n for (x, _), n in cells.items() if x == s) for s in names}
    want = {}
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            shared = sum(min(cells.get((a, t), 0), cells.get((b, t), 0)) for t in taxa)
            if shared:
                want[a, b] = (shared, 1 - 2 * shared / (total[a] + total[b]))
    rows = found.collect()
    assert len(rows) == len(want) and {(r.a, r.b): (r.shared, r.distance) for r in rows} == want


@pytest.mark.parametrize("kind", ["long", "double"])
def test_bray_curtis_gives_pairs_strip_by_strip(spark, monkeypatch, kind):
    """Common and rare taxa, blocks of several strips; before, a task gave all pairs of two blocks in one table."""
    for name, value in {"BLOCK_SAMPLES": 20, "BLOCKS": 3, "STRIP_PAIRS": 64}.items():
        monkeypatch.setattr(ecology, name, value, raising=False)
    rng = random.Random(5)
    counts = {s: {f"t{t}": rng.randrange(1, 40000) * (1 if kind == "long" else 0.25) for t in range(40) if rng.random() < (0.9 if t < 4 and s % 7 else 0.06)} for s in range(-30, 30)}
    df = spark.createDataFrame([(s, t, n) for s, c in counts.items() for t, n in c.items()], f"sample long, taxon string, n {kind}").repartition(4)
    steps, own = [], type(df.groupBy("sample")).applyInArrow

    def kept(grouped, step, schema):
        steps.append(step)
        return own(grouped, step, schema)

    monkeypatch.setattr(type(df.groupBy("sample")), "applyInArrow", kept)
    found = ecology.bray_curtis(df)
    want = {}
    for a, b in itertools.combinations(sorted(counts), 2):
        if shared := sum(min(n, counts[b].get(t, 0)) for t, n in counts[a].items()):
            want[a, b] = (shared, 1 - 2 * shared / (sum(counts[a].values()) + sum(counts[b].values())))
    rows = found.collect()
    assert len(rows) == len(want) and {(r.a, r.b): (r.shared, r.distance) for r in rows} == want
    dense = pa.RecordBatch.from_pydict({"id": list(range(40)), "sample": list(range(40)), "total": [3] * 40, "taxa": [["t"]] * 40, "ns": [[3]] * 40,
                                        "at_home": [i < 20 for i in range(40)], "same": [False] * 40, "pair": [0] * 40})
    given = [b.num_rows for b in steps[0](iter([dense]))]
    assert sum(given) == 400 and max(given) <= 64


def test_rounding_without_decimals(spark):
    values = [0.0, -0.0, 1e-10, -1e-10, 5e-10, -5e-10, 0.1234567885, 0.1234567895, -0.1234567885, 2.5e-9, 1 / 3, -2 / 3, 1.0000000005, 123.4567890125, 1e5 + 1e-9, 1e20, -1e300, 2.0 ** 31 + 0.3, float("inf"), float("-inf"), float("nan"), None]
    rng = random.Random(6)
    values += [rng.uniform(-1, 1) for _ in range(3000)] + [round(rng.uniform(-9, 9), 9) + sign * 5e-10 for _ in range(1000) for sign in (1, -1)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (6, 9):
        got = declared.rounded(df.withColumns({"w": F.col("v"), "x": F.col("v").cast("float")}), digits, "w", "x")
        assert "rint" in plan(got).lower()
        exact = got.select("w", "x", (F.round("v", digits) + F.lit(0.0)).alias("e"), (F.round(F.col("v").cast("float"), digits) + F.lit(0.0)).alias("f"))
        assert exact.where("NOT w <=> e OR NOT x <=> f OR string(w) <> string(e)").collect() == []


def test_windows_of_positions_beyond_exact_quotients(spark):
    first = 1000 * 2 ** 46
    df = spark.createDataFrame([("r", first + 999, first + 1000), ("r", first + 1001, first + 1001)], "r string, s long, e long")
    got = {(r.bin, r.bin_start, r.n_genes, r.covered) for r in sequences.gene_density(df, "r", "s", "e", 1000).collect()}
    assert got == {(2 ** 46, first + 1, 1, 2), (2 ** 46 + 1, first + 1001, 1, 1)}


def test_xml_fields_read_a_document_once(spark):
    docs = ["<r xmlns:c='u'><c:a> x </c:a><a>y</a><i><k>M</k><v/></i><i><k>M</k><v>9</v></i><i><k>N</k><v>7</v></i></r>", "<r><b>&lt;1</b></r>", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, doc string").repartition(2)
    paths = {t: xmlsrc.text_path(t) for t in "abz"} | {"m": xmlsrc.item_path("i", "k", "M", "v"), "n": xmlsrc.item_path("i", "k", "N", "v")}
    found = xmlsrc.xml_fields(df, "doc", paths, keep=["id"])
    one_by_one = df.select("id", *[xmlsrc.xml_text(F.col("doc"), t).alias(t) for t in "abz"],
                           *[xmlsrc.xml_item(F.col("doc"), "i", "k", k.upper(), "v").alias(k) for k in "mn"])
    assert sorted(found.collect()) == sorted(one_by_one.collect())
    assert plan(found).count("XPathStringEvaluator(") == 1
    assert plan(molecules.compounds(df, "doc")).count("XPathStringEvaluator(") == 1


def test_acquisition_reads_a_document_once(spark):
    df = spark.createDataFrame([("<a/>",), (None,)], "doc string").repartition(2)
    assert plan(xmlsrc.select_acquisition(df, "doc")).count("from_xml(") == 1


def test_records_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(registry, "RECORDS", 10)
    rows = registry.table(spark, SMALL, "part").count()
    for name in ["table_compounds", "s9_xml_fields", "s10_xml_item", "s17_acquisition_xml", "n23_column_sums", "table_disorder_xrefs"]:
        said = plan(CHECKS[name].run(spark, SMALL))
        assert "RepartitionByExpression [p_partkey#" in said or f"Repartition {-(-rows // 10)}, true" in said, name
    assert registry.spread(spark, SMALL, "part", "p_partkey").rdd.getNumPartitions() == -(-rows // 10)
    assert len(CHECKS["s8_xml_rows"].run(spark, SMALL).inputFiles()) > 1


def test_rows_are_not_shuffled_to_their_groups_quantiles(spark):
    rows = [(g, float(i % 37) if i % 5 else None) for g in ("a", "b", None) for i in range(60)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    found = quantiles.stretch(df, "v", ["g"], 0.0, 1.0, "s")
    said = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in said and "Exchange hashpartitioning" not in said
    assert sorted(found.collect(), key=str) == sorted([(g, v, None if v is None else v / 36) for g, v in rows], key=str)


def test_many_tests_have_tasks_by_their_number(spark, monkeypatch):
    df = spark.createDataFrame([(i, "ab"[i % 2], ((i * 37) % 101) / 101) for i in range(200)], "id long, g string, p double")
    want = sorted(multiple.adjust(df, "p", ["g"]).collect())
    monkeypatch.setattr(multiple, "TASK_TESTS", 5)
    found = multiple.adjust(df, "p", ["g"])
    assert "], 40" in plan(found) and "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(found.collect()) == want


def test_a_column_is_ranked_once_where_no_row_lacks_the_other(spark, monkeypatch):
    made = []
    monkeypatch.setattr(ranks, "stored", lambda df, label: made.append((label, df)) or df)
    rows = [("g" if i % 3 else None, float(i % 7), float((i * i) % 11), float(-i % 5), None if i % 4 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, a double, b double, c double, d double")
    found = ranks.spearman(df, ["a", "b", "c", "d"], ["g"]).collect()
    sides = dict(made)["value-counts"].select("pair", "side").distinct().count()
    assert sides == 3 + 1 + 3  # a, b and c with each other; d; a, b and c where d is there

    def mean_ranks(v):
        return [sum(w < x for w in v) + (sum(w == x for w in v) + 1) / 2 for x in v]
    for r in found:
        both = [(x[1 + "abcd".index(r.a)], x[1 + "abcd".index(r.b)]) for x in rows if x[0] == r.g]
        x, y = (mean_ranks(v) for v in zip(*[p for p in both if None not in p]))
        mx, my = sum(x) / len(x), sum(y) / len(y)
        top = sum((p - mx) * (q - my) for p, q in zip(x, y))
        rho = top / (sum((p - mx) ** 2 for p in x) * sum((q - my) ** 2 for q in y)) ** 0.5
        assert r.n == len(x) and abs(r.rho - rho) < 1e-6
    assert len(found) == 12


def test_edges_are_made_once(spark, monkeypatch):
    labels = []
    keep = network.stored
    monkeypatch.setattr(network, "stored", lambda df, label: labels.append(label) or keep(df, label))
    edges = [(a, b) for a in range(9) for b in range(a + 1, 9) if (a * b) % 4 != 1]
    made = spark.createDataFrame(edges, "a long, b long").repartition(2).distinct()
    found = network.clustering(made)
    assert labels.count("edges") == 1 and "LogicalRDD" not in plan(found)
    near = {n: {a + b - n for a, b in edges if n in (a, b)} for n in range(9)}
    want = {n: sum(b in near[a] for a in s for b in s if a < b) for n, s in near.items()}
    assert {r.node: r.n_triangles for r in found.collect()} == want
    assert network.triangles(made).count() == sum(want.values()) // 3


def test_kinetics_read_only_what_they_need(spark):
    page = '{"results":[{"primaryAccession":"P1","references":[{"citation":{}}],"comments":[{"commentType":"KINETICS","reaction":{"name":"A = B"},"texts":[{"value":"Km=2 mM for x;"}]}]}]}'
    found = molecules.kinetics(spark.createDataFrame([("1.1", page)], "ec string, page string").repartition(2), "page", "ec")
    said = plan(found)
    assert "citationCrossReferences" not in said and "reaction" not in said
    assert [tuple(r) for r in found.collect()] == [("1.1", "P1", "unknown", "x", 2.0, "mM")]
