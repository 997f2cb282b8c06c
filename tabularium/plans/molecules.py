"""Compound, drug, enzyme, motif, domain and structure records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.casts import blank_to_null, date_prefix, safe, safe_date, strict, trimmed
from tabularium.functions.fallback import first_truthy
from tabularium.functions.nested import field_list, first_item, join_list, list_size, matrix_long, pivot_known
from tabularium.functions.rows import item_rows, struct_rows
from tabularium.functions.text import dotted_levels, equation_participants, fixed_part, match_rows, match_structs, stated_quantity, span_length, split_once
from tabularium.plans.base import JsonTable
from tabularium.sources.xmlsrc import item_path, text_path, xml_fields

DRUGS = JsonTable(
    "drugs",
    "molecule_chembl_id: string, pref_name: string, max_phase: string, indication_class: string, first_approval: string, "
    "molecule_properties: struct<full_molformula: string, full_mwt: string, alogp: string, hbd: string, hba: string, num_ro5_violations: string>",
    lambda r, _: {
        "chembl_id": r["molecule_chembl_id"],
        "pref_name": r["pref_name"],
        "max_phase": safe(safe(r["max_phase"], "double"), "tinyint"),
        "molecular_formula": r["molecule_properties"]["full_molformula"],
        "molecular_weight": safe(r["molecule_properties"]["full_mwt"], "double"),
        "alogp": safe(r["molecule_properties"]["alogp"], "double"),
        "hbd_count": safe(r["molecule_properties"]["hbd"], "smallint"),
        "hba_count": safe(r["molecule_properties"]["hba"], "smallint"),
        "ro5_violations": safe(r["molecule_properties"]["num_ro5_violations"], "tinyint"),
        "indication_class": r["indication_class"],
        "first_approval_year": safe(r["first_approval"], "smallint"),
    }, ("molecules",))

ACTIVITIES = JsonTable(
    "activities",
    "molecule_chembl_id: string, standard_type: string, standard_value: string, standard_units: string, pchembl_value: string, assay_chembl_id: string",
    lambda r, _: {
        "molecule_chembl_id": r["molecule_chembl_id"],
        "standard_type": r["standard_type"],
        "standard_value": safe(r["standard_value"], "double"),
        "standard_units": r["standard_units"],
        "pchembl_value": safe(r["pchembl_value"], "double"),
        "assay_chembl_id": r["assay_chembl_id"],
    }, ("activities",))


def compounds(df: DataFrame, doc: str) -> DataFrame:
    """Compound rows of namespaced XML answers; a blank number is null, another text fails the job."""
    raw = xml_fields(df, doc, {
        "chebi_id": text_path("chebiId"), "name": text_path("chebiAsciiName"), "formula": text_path("Formulae"),
        "monoisotopic_mass": item_path("ChemicalDataItem", "datatype", "MONOISOTOPIC MASS", "data"),
        "charge": text_path("charge"), "inchi": text_path("inchi"), "smiles": text_path("smiles"), "star_rating": text_path("entityStar")})
    return raw.withColumns({
        "monoisotopic_mass": strict(blank_to_null("monoisotopic_mass"), "double"),
        "charge": strict(blank_to_null("charge"), "int"),
        "star_rating": strict(blank_to_null("star_rating"), "int"),
    })


# Units of concentration in summaries of kinetic constants; the long form also knows the last.
MOLAR_UNITS = ("M", "mM", "µM", "uM", "nM")

ENZYME_ENTRY = (
    "primaryAccession: string, organism: struct<scientificName: string>, "
    "proteinDescription: struct<recommendedName: struct<fullName: struct<value: string>>>, "
    "comments: array<struct<commentType: string, reaction: struct<name: string>, texts: array<struct<value: string>>>>, "
    "references: array<struct<citation: struct<citationCrossReferences: array<struct<database: string, id: string>>>>>")


#: What of an entry the kinetic constants need.
KINETICS_ENTRY = (
    "primaryAccession: string, organism: struct<scientificName: string>, "
    "comments: array<struct<commentType: string, texts: array<struct<value: string>>>>")


def _texts(comments: Column) -> Column:
    kinetics = F.filter(comments, lambda k: k["commentType"] == "KINETICS")
    return F.transform(F.flatten(F.transform(kinetics, lambda k: F.coalesce(k["texts"], F.array()))),
                       lambda t: F.coalesce(t["value"], F.lit("")))


def _enzyme(r: Column, _: Column) -> dict[str, Column]:
    """Summary of all entries of one answer, in the order of the entries."""
    entries = F.coalesce(r["results"], F.array())
    comments = F.flatten(F.transform(entries, lambda e: F.coalesce(e["comments"], F.array())))
    organisms = F.array_distinct(F.filter(F.transform(entries, lambda e: e["organism"]["scientificName"]), lambda v: v.isNotNull() & (v != "")))
    reactions = F.filter(comments, lambda k: (k["commentType"] == "CATALYTIC ACTIVITY") & F.contains(k["reaction"]["name"], F.lit("=")))
    substrates = F.array_distinct(F.flatten(F.transform(reactions, lambda k: equation_participants(k["reaction"]["name"]))))
    km = F.flatten(F.transform(_texts(comments), lambda t: F.transform(
        match_structs(t, stated_quantity("km", MOLAR_UNITS[:-1]), {"v": 1, "u": 2}), lambda m: F.concat(m["v"], F.lit(" "), m["u"]))))
    papers = F.flatten(F.transform(entries, lambda e: F.flatten(F.transform(
        F.coalesce(e["references"], F.array()), lambda p: F.coalesce(p["citation"]["citationCrossReferences"], F.array())))))
    pubmed = F.array_distinct(F.transform(F.filter(papers, lambda p: p["database"] == "PubMed"), lambda p: p["id"]))
    return {
        "name": first_item(entries)["proteinDescription"]["recommendedName"]["fullName"]["value"],
        "organism_count": F.size(organisms),
        "substrate_count": F.size(substrates),
        "km_values": join_list(km, keep_blank=True),
        "references_count": F.size(pubmed),
        "source": F.lit("uniprot"),
    }


ENZYMES = JsonTable("enzymes", f"results: array<struct<{ENZYME_ENTRY}>>", _enzyme)


def kinetics(df: DataFrame, page: str, ec_number: str) -> DataFrame:
    """One row per kinetic constant in the free text of all entries; malformed numbers are dropped.

    Of an entry only what this needs is read.
    """
    keys = ["ec_number", "uniprot_id", "organism"]
    results = F.from_json(page, f"struct<results: array<struct<{KINETICS_ENTRY}>>>")["results"]
    entries = struct_rows(df.withColumn("ec_number", F.col(ec_number)), ["ec_number"], results, ["primaryAccession", "organism", "comments"])
    named = entries.select("ec_number", F.coalesce("primaryAccession", F.lit("")).alias("uniprot_id"),
                           F.coalesce("organism.scientificName", F.lit("unknown")).alias("organism"), "comments")
    texts = item_rows(named, keys, _texts(F.col("comments")), "_t")
    found = match_rows(texts, F.col("_t"), stated_quantity("km", MOLAR_UNITS, of="for"), {"km_value": 1, "km_unit": 2, "substrate": 3}, {"substrate": "unknown"})
    return found.select("ec_number", "uniprot_id", "organism", "substrate", safe("km_value", "double").alias("km_value"),
                        "km_unit").filter(F.col("km_value").isNotNull())


def _superfamily(r: Column, _: Column) -> dict[str, Column]:
    code = F.coalesce(first_truthy(r["cathCode"], r["superfamilyId"], r["superfamily_id"], r["id"]), F.lit(""))
    names = ("class", "architecture", "topology", "homologous_superfamily")
    count = lambda *fields: first_truthy(*[safe(r[f], "int") for f in fields], kind="number")
    return {
        "superfamily_id": code,
        **dict(zip(names, dotted_levels(code, names))),
        "domain_count": count("numDomains", "domain_count", "num_domains"),
        "pdb_count": count("numPdbs", "pdb_count", "num_pdbs"),
    }


SUPERFAMILIES = JsonTable(
    "superfamilies",
    "cathCode: string, superfamilyId: string, superfamily_id: string, id: string, numDomains: string, domain_count: string, "
    "num_domains: string, numPdbs: string, pdb_count: string, num_pdbs: string",
    _superfamily, ("data", "results", "$"))


def _domain(r: Column, _: Column) -> dict[str, Column]:
    domain = F.coalesce(first_truthy(r["domain_id"], r["domainId"], r["id"]), F.lit(""))
    segment = first_item(r["segments"])
    inside = F.size(r["segments"]) > 0
    start = F.when(inside, F.coalesce(segment["start"], segment["startRes"])).otherwise(first_truthy(r["startRes"], r["start_res"]))
    stop = F.when(inside, F.coalesce(segment["stop"], segment["stopRes"])).otherwise(first_truthy(r["stopRes"], r["stop_res"]))
    return {
        "domain_id": domain,
        "pdb_id": F.coalesce(F.lower(fixed_part(domain, 1, 4)), r["pdbId"], F.lit("")),
        "chain_id": F.coalesce(F.upper(fixed_part(domain, 5, 1)), r["chainId"], F.lit("")),
        "start_res": safe(start, "int"),
        "stop_res": safe(stop, "int"),
        "domain_length": span_length(safe(start, "int"), safe(stop, "int")),
    }


DOMAINS = JsonTable(
    "domains",
    "domain_id: string, domainId: string, id: string, pdbId: string, chainId: string, startRes: string, start_res: string, "
    "stopRes: string, stop_res: string, segments: array<struct<start: string, startRes: string, stop: string, stopRes: string>>",
    _domain, ("data", "results", "$"))

SOURCE = "array<struct<organism: struct<valueOf_: string>>>"


def _map_entry(r: Column, _: Column) -> dict[str, Column]:
    method = first_item(r["structure_determination_list"]["structure_determination"])
    organisms = F.transform(
        F.flatten(F.transform(r["sample"]["supramolecule_list"]["supramolecule"], lambda s: F.coalesce(s["natural_source"], F.array()))),
        lambda n: n["organism"]["valueOf_"])
    return {
        "emdb_id": r["emdb_id"],
        "title": r["admin"]["title"],
        "resolution_angstrom": safe(first_item(method["image_processing"])["final_reconstruction"]["resolution"]["valueOf_"], "float"),
        "method": method["method"],
        "organism": join_list(organisms, distinct=True, order=True),
        "deposition_date": safe_date(date_prefix(r["admin"]["key_dates"]["deposition"])),
        "fitted_pdb_ids": join_list(field_list(r["crossreferences"]["pdb_list"]["pdb_reference"], "pdb_id")),
    }


DENSITY_MAPS = JsonTable(
    "density_maps",
    "emdb_id: string, admin: struct<title: string, key_dates: struct<deposition: string>>, "
    "structure_determination_list: struct<structure_determination: array<struct<method: string, "
    "image_processing: array<struct<final_reconstruction: struct<resolution: struct<valueOf_: string>>>>>>>, "
    f"sample: struct<supramolecule_list: struct<supramolecule: array<struct<natural_source: {SOURCE}>>>>, "
    "crossreferences: struct<pdb_list: struct<pdb_reference: array<struct<pdb_id: string>>>>",
    _map_entry)

SIGNATURES = JsonTable(
    "signatures",
    "metadata: struct<accession: string, name: string, type: string, short_name: string, member_databases: map<string,string>>, "
    "extra_fields: struct<go_terms: array<string>>",
    lambda r, _: {
        "accession": F.coalesce(r["metadata"]["accession"], F.lit("")),
        "name": F.coalesce(r["metadata"]["name"], F.lit("")),
        "type": F.coalesce(r["metadata"]["type"], F.lit("")),
        "short_name": F.coalesce(r["metadata"]["short_name"], F.lit("")),
        "member_databases": list_size(r["metadata"]["member_databases"]),
        "go_term_count": list_size(r["extra_fields"]["go_terms"]),
    }, ("results",))


def _matrix(r: Column, _: Column) -> dict[str, Column]:
    parts = split_once(r["matrix_id"], ".", "base_id", "version")
    return {
        "matrix_id": r["matrix_id"],
        "name": r["name"],
        "collection": r["collection"],
        "tf_family": r["tf_family"],
        "base_id": parts["base_id"],
        "version": safe(parts["version"], "int"),
    }


MATRICES = JsonTable("matrices", "matrix_id: string, name: string, collection: string, tf_family: string", _matrix, ("results",))

_MATRIX_COUNTS = JsonTable(
    "matrix_counts", "matrix_id: string, pfm: struct<A: array<double>, C: array<double>, G: array<double>, T: array<double>>",
    lambda r, _: {"matrix_id": r["matrix_id"], **{b: r["pfm"][b] for b in "ACGT"}})


def matrix_counts(df: DataFrame, record: str = "record") -> DataFrame:
    """Counts of motif matrices as (matrix_id, pos, base, n); a malformed matrix fails the job."""
    return matrix_long(_MATRIX_COUNTS.from_records(df, record), ["matrix_id"], strict=True)


LIPIDS = JsonTable(
    "lipids",
    "lm_id: string, name: string, systematic_name: string, category: string, main_class: string, sub_class: string, "
    "exact_mass: string, formula: string, inchi_key: string, pubchem_cid: string",
    lambda r, _: {
        "lm_id": r["lm_id"],
        "name": r["name"],
        "systematic_name": r["systematic_name"],
        "category": r["category"],
        "main_class": r["main_class"],
        "sub_class": r["sub_class"],
        "exact_mass": safe(r["exact_mass"], "double"),
        "formula": r["formula"],
        "inchi_key": r["inchi_key"],
        "pubchem_cid": r["pubchem_cid"],
    })


def _structure_entry(r: Column, _: Column) -> dict[str, Column]:
    def texts(c: Column) -> Column:
        return F.from_json(F.when(F.ltrim(c).startswith("["), c), "array<string>")

    methods, own = r["experimental_method"], r["organism_scientific_name"]
    related = F.filter(F.transform(r["related_structures"], lambda s: s["organism_scientific_name"]), lambda v: v.isNotNull() & ~v.isin("", "[]"))
    name = lambda c: F.coalesce(F.get(texts(c), F.lit(0)), F.when(~F.ltrim(c).startswith("["), F.nullif(c, F.lit(""))))
    return {
        "title": r["title"],
        "experimental_method": F.nullif(F.coalesce(F.array_join(texts(methods), "; "), methods), F.lit("")),
        "resolution": r["resolution"],
        "deposition_date": r["deposition_date"],
        "release_date": r["release_date"],
        "organism": F.coalesce(name(own), name(F.get(related, F.lit(0)))),
    }


_STRUCTURES = JsonTable(
    "structures",
    "title: string, experimental_method: string, resolution: double, deposition_date: string, release_date: string, "
    "organism_scientific_name: string, related_structures: array<struct<organism_scientific_name: string>>",
    _structure_entry)


def structures(df: DataFrame, doc: str = "doc") -> DataFrame:
    """Entries of documents that map an id to a list of records; ids with an empty list are skipped."""
    entries = struct_rows(df, [], F.map_entries(F.from_json(doc, "map<string,array<string>>")), ["key", "value"])
    first = entries.select(F.col("key").alias("pdb_id"), F.get("value", F.lit(0)).alias("record")).filter(F.col("record").isNotNull())
    return _STRUCTURES.from_records(first, "record", keep=["pdb_id"])


MODEL = "array<struct<chain: string, template: string, from: string, to: string, coverage: string, identity: string, similarity: string, gmqe: string, qmean: string, created_date: string>>"

MODELS = JsonTable(
    "models", f"result: struct<structures: {MODEL}>",
    lambda r, m: {
        "chain": m["chain"],
        "template": m["template"],
        "seq_from": strict(m["from"], "int"),
        "seq_to": strict(m["to"], "int"),
        **{c: strict(m[c], "float") for c in ("coverage", "identity", "similarity", "gmqe", "qmean")},
        "created_date": safe_date(m["created_date"]),
    }, items=lambda r: r["result"]["structures"])

REFERENCE = "struct<ExternalReference: array<struct<Source: string, Reference: string, DisorderMappingRelation: struct<Name: string>>>>"

DISORDER_XML = ("OrphaCode string, Name string, DisorderType struct<Name: string>, DisorderGroup struct<Name: string>, "
                f"ExpertLink string, ExternalReferenceList {REFERENCE}")


def disorder_xrefs(disorders: DataFrame) -> DataFrame:
    """Cross-references of disorder elements, one null row for a disorder without any."""
    rows = disorders.select("*", F.explode_outer("ExternalReferenceList.ExternalReference").alias("_x"))
    return rows.select(
        safe(trimmed("OrphaCode"), "bigint").alias("orpha_code"), trimmed("Name").alias("disorder_name"),
        trimmed("DisorderType.Name").alias("disorder_type"), trimmed("DisorderGroup.Name").alias("disorder_group"),
        trimmed("ExpertLink").alias("expert_link"), trimmed("_x.Source").alias("xref_source"), trimmed("_x.Reference").alias("xref_id"),
        trimmed("_x.DisorderMappingRelation.Name").alias("xref_relation"))


# Gene cross-reference sources and their columns.
GENE_XREFS = {
    "HGNC": "hgnc_id",
    "Ensembl": "ensembl_id",
    "OMIM": "omim_id",
    "SwissProt": "swissprot_id",
    "Genatlas": "genatlas_id",
    "Reactome": "reactome_id",
    "IUPHAR": "iuphar_id",
}

DISORDER_GENE_XML = (
    "OrphaCode string, Name string, DisorderGeneAssociationList struct<DisorderGeneAssociation: array<struct<SourceOfValidation: string, "
    f"Gene: struct<Symbol: string, Name: string, ExternalReferenceList: {REFERENCE}>, DisorderGeneAssociationType: struct<Name: string>, "
    "DisorderGeneAssociationStatus: struct<Name: string>>>>")


def disorder_genes(disorders: DataFrame) -> DataFrame:
    """Gene associations of disorder elements, the known gene cross-references as columns."""
    rows = struct_rows(disorders.withColumnRenamed("Name", "_name"), ["OrphaCode", "_name"],
                       F.col("DisorderGeneAssociationList.DisorderGeneAssociation"),
                       ["SourceOfValidation", "Gene", "DisorderGeneAssociationType", "DisorderGeneAssociationStatus"])
    refs = F.col("Gene.ExternalReferenceList.ExternalReference")
    return rows.select(
        safe(trimmed("OrphaCode"), "bigint").alias("orpha_code"), trimmed("_name").alias("disorder_name"),
        trimmed("Gene.Symbol").alias("gene_symbol"), trimmed("Gene.Name").alias("gene_name"),
        trimmed("DisorderGeneAssociationType.Name").alias("association_type"),
        trimmed("DisorderGeneAssociationStatus.Name").alias("association_status"),
        trimmed("SourceOfValidation").alias("source_of_validation"),
        *pivot_known(refs, GENE_XREFS, name="Source", value="Reference"))
