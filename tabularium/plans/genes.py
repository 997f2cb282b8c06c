"""Gene, genome, expression, ontology-of-life and cell-line records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.casts import safe, truthy_number
from tabularium.functions.fallback import first_truthy
from tabularium.functions.nested import count_where, first_item, has_items, join_list, field_list, list_size, pivot_keys
from tabularium.functions.rows import struct_rows
from tabularium.functions.text import joined_name, scaled, span_length
from tabularium.plans.base import JsonTable

SPECIES = JsonTable(
    "species", "name: string, common_name: string, taxon_id: string, assembly: string, genebuild: string",
    lambda r, _: {
        "species_name": r["name"],
        "common_name": r["common_name"],
        "taxon_id": safe(r["taxon_id"], "int"),
        "assembly": r["assembly"],
        "genebuild": r["genebuild"],
    }, ("species", "$"))

EXON = "array<struct<id: string>>"
TRANSCRIPT = f"array<struct<id: string, display_name: string, biotype: string, start: bigint, end: bigint, is_canonical: int, Exon: {EXON}>>"
GENE = ("id: string, display_name: string, seq_region_name: string, start: bigint, end: bigint, strand: int, biotype: string, "
        f"description: string, Transcript: {TRANSCRIPT}")

GENES = JsonTable(
    "genes", GENE,
    lambda r, _: {
        "gene_id": r["id"],
        "symbol": r["display_name"],
        "chromosome": r["seq_region_name"],
        "start": r["start"],
        "end": r["end"],
        "strand": r["strand"].cast("tinyint"),
        "biotype": r["biotype"],
        "description": r["description"],
        "transcript_count": list_size(r["Transcript"]),
        "span_kb": scaled(span_length(r["start"], r["end"]), 1000.0, 1),
    })

TRANSCRIPTS = JsonTable(
    "transcripts", GENE,
    lambda r, t: {
        "transcript_id": t["id"],
        "name": t["display_name"],
        "biotype": t["biotype"],
        "length": span_length(F.coalesce(t["start"], F.lit(0)), F.coalesce(t["end"], F.lit(0))),
        "exon_count": list_size(t["Exon"]),
        "is_canonical": truthy_number(t["is_canonical"]),
    }, items=lambda r: r["Transcript"])

# Records of the three tables below come from documents keyed by species.
ASSEMBLIES = JsonTable(
    "assemblies",
    "_portal: string, assembly_name: string, base_pairs: bigint, top_level_region: array<struct<coord_system: string>>",
    lambda r, _: {
        "portal": F.coalesce(r["_portal"], F.lit("")),
        "assembly_name": F.coalesce(r["assembly_name"], F.lit("")),
        "total_length_bp": r["base_pairs"],
        "num_chromosomes": count_where(r["top_level_region"], lambda x: x["coord_system"] == "chromosome"),
        "num_scaffolds": count_where(r["top_level_region"], lambda x: ~F.coalesce(x["coord_system"] == "chromosome", F.lit(False))),
    })

GENE_COUNTS = JsonTable(
    "gene_counts", "_division: string, gene_count: string, coding_count: string, assembly_name: string",
    lambda r, _: {
        "division": F.coalesce(r["_division"], F.lit("")),
        "gene_count": safe(r["gene_count"], "bigint"),
        "coding_gene_count": safe(r["coding_count"], "bigint"),
        "assembly": F.coalesce(r["assembly_name"], F.lit("")),
    })

REGION_GENES = JsonTable(
    "region_genes", "id: string, external_name: string, biotype: string, start: bigint, end: bigint, strand: bigint, description: string",
    lambda r, _: {
        "gene_id": F.coalesce(r["id"], F.lit("")),
        "gene_name": F.coalesce(r["external_name"], F.lit("")),
        "biotype": F.coalesce(r["biotype"], F.lit("")),
        "start": r["start"],
        "end": r["end"],
        "strand": r["strand"],
        "description": F.coalesce(r["description"], F.lit("")),
    })

DIVISION_SPECIES = JsonTable(
    "division_species", "name: string, common_name: string, taxon_id: string, assembly_name: string, strain: string",
    lambda r, _: {
        "species": F.coalesce(r["name"], F.lit("")),
        "common_name": F.coalesce(r["common_name"], F.lit("")),
        "taxon_id": safe(r["taxon_id"], "bigint"),
        "assembly": F.coalesce(r["assembly_name"], F.lit("")),
        "strain": F.coalesce(r["strain"], F.lit("")),
    })


def by_species(plan: JsonTable, df: DataFrame, doc: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of a document that maps species to record, with the species as a column."""
    entries = struct_rows(df, keep, F.map_entries(F.from_json(doc, "map<string,string>")), ["key", "value"])
    return plan.from_records(entries.withColumnRenamed("key", "species"), "value", keep=[*keep, "species"])


def _expression_call(r: Column, _: Column) -> dict[str, Column]:
    entity = F.coalesce(
        F.when(r["condition"]["anatomicalEntity"].isNotNull(), F.struct(
            r["condition"]["anatomicalEntity"]["id"].alias("id"), r["condition"]["anatomicalEntity"]["anatEntityId"].alias("alt_id"),
            r["condition"]["anatomicalEntity"]["name"].alias("name"), r["condition"]["anatomicalEntity"]["anatEntityName"].alias("alt_name"))),
        F.struct(r["condition"]["id"].alias("id"), r["condition"]["anatEntityId"].alias("alt_id"),
                 r["condition"]["name"].alias("name"), r["condition"]["anatEntityName"].alias("alt_name")))
    return {
        "gene_id": r["gene"]["geneId"],
        "gene_name": F.coalesce(first_truthy(r["gene"]["geneName"], r["gene"]["name"]), F.lit("")),
        "anatomical_entity_id": F.coalesce(entity["id"], entity["alt_id"], F.lit("")),
        "anatomical_entity_name": F.coalesce(entity["name"], entity["alt_name"], F.lit("")),
        "expression_score": F.coalesce(F.nullif(r["expressionScore"], F.lit(0.0)), r["score"]),
        "expression_rank": F.coalesce(F.nullif(r["expressionRank"], F.lit(0.0)), r["rank"]),
        "call_type": F.coalesce(first_truthy(r["expressionState"], r["callType"]), F.lit("")),
    }


ENTITY = "id: string, anatEntityId: string, name: string, anatEntityName: string"
EXPRESSION_CALLS = JsonTable(
    "expression_calls",
    f"gene: struct<geneId: string, geneName: string, name: string>, condition: struct<anatomicalEntity: struct<{ENTITY}>, {ENTITY}>, "
    "expressionScore: double, score: double, expressionRank: double, rank: double, expressionState: string, callType: string",
    _expression_call, ("data.expressionCalls", "expressionCalls", "data", "calls", "$"))


def expression_calls(df: DataFrame, gene_id: str, page: str = "page", keep: Sequence[str] = ()) -> DataFrame:
    """Calls of pages that were asked for by gene: a call that names no gene has the one asked for, in column ``gene_id``."""
    asked = df.withColumn("_asked", F.col(gene_id).cast("string"))
    rows = EXPRESSION_CALLS.from_pages(asked, page, keep=[*keep, "_asked"])
    return rows.withColumn("gene_id", F.coalesce(F.nullif("gene_id", F.lit("")), "_asked")).drop("_asked")


def _strain(r: Column, _: Column) -> dict[str, Column]:
    """Sections hold one block or a list of blocks; the first block is read."""
    def block(section: str, name: str, fields: str) -> Column:
        text = r[section][name]
        as_list = F.from_json(F.when(F.ltrim(text).startswith("["), text), f"array<struct<{fields}>>")
        as_one = F.from_json(F.when(F.ltrim(text).startswith("{"), text), f"struct<{fields}>")
        return F.coalesce(F.get(as_list, F.lit(0)), as_one)

    species = block("Name and taxonomic classification", "species", "genus: string, species: string")
    physiology = "Physiology and metabolism"
    isolation = block("Isolation, sampling and environmental information", "isolation",
                      "`isolation source category`: string, `isolation source`: string, country: string")
    return {
        "bacdive_id": safe(r["General"]["BacDive-ID"], "bigint"),
        "species_name": joined_name(species["genus"], species["species"]),
        "gram_stain": block("Morphology", "cell morphology", "`gram stain`: string")["gram stain"],
        "oxygen_tolerance": block(physiology, "oxygen tolerance", "`oxygen tolerance`: string")["oxygen tolerance"],
        "isolation_source": first_truthy(isolation["isolation source category"], isolation["isolation source"]),
        "temperature_optimum": safe(block(physiology, "temperature", "`temperature optimum`: string")["temperature optimum"], "double"),
        "ph_optimum": safe(block(physiology, "pH", "`pH optimum`: string")["pH optimum"], "double"),
        "country": isolation["country"],
    }


STRAINS = JsonTable(
    "strains",
    "General: struct<`BacDive-ID`: string>, `Name and taxonomic classification`: struct<species: string>, "
    "Morphology: struct<`cell morphology`: string>, "
    "`Physiology and metabolism`: struct<`oxygen tolerance`: string, temperature: string, pH: string>, "
    "`Isolation, sampling and environmental information`: struct<isolation: string>",
    _strain, ("results",))

LABELLED = "array<struct<id: string, label: string>>"
CELL_LINE = (f"ac: string, id: string, ca: string, ox: {LABELLED}, di: {LABELLED}, sx: string, ag: string, "
             "`str`: struct<marker: array<struct<id: string, alleles: string>>>, xref: array<struct<db: string, id: string>>, cc: string")


def _cell_line_base(r: Column) -> dict[str, Column]:
    return {
        "accession": r["ac"],
        "name": r["id"],
        "category": r["ca"],
        "species": first_item(r["ox"])["label"],
        "disease": first_item(r["di"])["label"],
        "sex": r["sx"],
        "age_at_sampling": r["ag"],
    }


CELL_LINES = JsonTable(
    "cell_lines", CELL_LINE,
    lambda r, _: {
        **_cell_line_base(r),
        "str_available": has_items(r["str"]["marker"]),
        "xref_count": list_size(r["xref"]),
    }, ("cell-line", "$"))

_CELL_PANEL = JsonTable(
    "cell_panel", CELL_LINE,
    lambda r, _: {
        **_cell_line_base(r),
        "str_loci_count": list_size(r["str"]["marker"]),
        "xref_count": list_size(r["xref"]),
        "xref_databases": join_list(field_list(r["xref"], "db"), distinct=True, order=True),
        "comments": F.when(~F.ltrim(r["cc"]).rlike("^[\\[{]"), r["cc"]),
        "_markers": F.transform(F.filter(r["str"]["marker"], lambda m: m["id"].isNotNull()),
                                lambda m: F.struct(m["id"].alias("id"), F.coalesce(m["alleles"], F.lit("")).alias("alleles"))),
    })


def cell_panel(df: DataFrame, loci: Sequence[str], record: str = "record") -> DataFrame:
    """Panel rows with one ``str_`` column per given locus."""
    flat = _CELL_PANEL.from_records(df, record)
    return pivot_keys(flat, [c for c in flat.columns if c != "_markers"], "_markers", "str_", loci, name="id", value="alleles")


def _ortholog(r: Column, full: bool) -> dict[str, Column]:
    head = {"omaid": r["omaid"], "canonicalid": r["canonicalid"], "entry_nr": r["entry_nr"]}
    middle = {"rel_type": r["rel_type"], "distance": safe(r["distance"], "double"), "score": safe(r["score"], "double")} if full else {}
    return {**head, **middle, "species": r["species"]["species"], "taxon_id": safe(r["species"]["taxon_id"], "bigint"),
            "sequence_length": safe(r["sequence_length"], "bigint")}


ORTHOLOG = ("omaid: string, canonicalid: string, entry_nr: bigint, rel_type: string, distance: string, score: string, "
            "species: struct<species: string, taxon_id: string>, sequence_length: string")
ORTHOLOGS = JsonTable("orthologs", ORTHOLOG, lambda r, _: _ortholog(r, True))
HOG_MEMBERS = JsonTable("hog_members", ORTHOLOG, lambda r, _: _ortholog(r, False), ("members", "$"))
