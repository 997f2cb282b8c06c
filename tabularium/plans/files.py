"""Tables that arrive as delimited files: layout, types and finishing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.casts import cast_present, in_range
from tabularium.functions.text import after_first
from tabularium.plans.base import TextTable
from tabularium.sources.delimited import GAF_COLUMNS, MITAB_COLUMNS


def _text(*names: str) -> str:
    return ", ".join(f"`{n}` string" for n in names)


# Evidence channels of a protein link, scores from 0 to 1000.
CHANNELS = ("neighborhood", "neighborhood_transferred", "fusion", "cooccurence", "coexpression", "coexpression_transferred",
            "experiments", "experiments_transferred", "database", "database_transferred", "textmining", "textmining_transferred")


def _links(df: DataFrame) -> DataFrame:
    scores = [*CHANNELS, "combined_score"]
    fits = F.lit(True)
    for s in scores:
        fits = fits & in_range(s, 0, 65_535)
    checked = df.filter(F.when(fits, F.lit(True)).otherwise(F.raise_error(F.lit("score outside 0..65535")).cast("boolean")))
    return checked.withColumnsRenamed({"protein1": "protein_a", "protein2": "protein_b"})


PROTEIN_LINKS = TextTable(
    "protein_links", "protein1 string, protein2 string, " + ", ".join(f"{c} int" for c in (*CHANNELS, "combined_score")),
    sep=" ", finish=_links)

PROTEIN_INFO = TextTable(
    "protein_info", "`#string_protein_id` string, `Preferred Name` string, protein_size int, annotation string", style="spaced")


def _interactions(df: DataFrame) -> DataFrame:
    both = F.col("idA").startswith("uniprotkb:") & F.col("idB").startswith("uniprotkb:")
    return df.withColumns({"accA": after_first(F.col("idA"), ":"), "accB": after_first(F.col("idB"), ":"), "both_uniprot": both})


INTERACTIONS = TextTable("interactions", _text(*MITAB_COLUMNS), finish=_interactions)

ANNOTATIONS = TextTable("annotations", _text(*GAF_COLUMNS), header=False, comment="!")

FISSION_GENES = TextTable(
    "fission_genes",
    "`Systematic ID` string, `Primary Name` string, `Product Description` string, uniprot_id string, chromosome string, "
    "start_position int, end_position int, strand string", comment="!", style="spaced")

NOMENCLATURE_TYPES = {
    "date_approved_reserved": "date", "date_symbol_changed": "date", "date_name_changed": "date", "date_modified": "date",
    "entrez_id": "bigint",
}

NOMENCLATURE = TextTable(
    "nomenclature",
    _text("hgnc_id", "symbol", "name", "status", "locus_group", "locus_type", "entrez_id", "date_approved_reserved",
          "date_symbol_changed", "date_name_changed", "date_modified"),
    null_values=("", '""'), finish=lambda df: cast_present(df, NOMENCLATURE_TYPES))

PROTEIN_OVERVIEW = TextTable(
    "protein_overview", _text("Gene", "Gene synonym", "Ensembl", "Uniprot", "Chromosome", "Position", "Protein class", "Evidence"),
    null_values=("", "NA", "N/A", "-"))

TAXON_NAME_TYPES = {"record_no": "bigint", "record_lnk_no": "bigint", "genus_record_no": "bigint", "sp_record_no": "bigint"}


def _taxon_names(df: DataFrame) -> DataFrame:
    rank = (F.when(F.col("subsp_epithet").isNotNull(), "subspecies").when(F.col("sp_epithet").isNotNull(), "species")
            .otherwise("genus"))
    return cast_present(df, TAXON_NAME_TYPES).withColumn("rank", rank)


TAXON_NAMES = TextTable(
    "taxon_names", _text("genus_name", "sp_epithet", "subsp_epithet", "status", "authors", "nomenclatural_type", "record_no", "record_lnk"),
    sep=",", quote='"', null_values=("", "NA", "null"), finish=_taxon_names)

RRNA_TAXONOMY = TextTable("rrna_taxonomy", "path string, taxid bigint, rank string, remark string, `release` string")

RRNA_MAP = TextTable(
    "rrna_map", "primaryAccession string, start bigint, stop bigint, path string, organism_name string, taxid bigint")

ORTHOGROUPS = TextTable("orthogroups", "og_id string, level_taxid bigint, og_name string", header=False)
ORTHOGROUP_GENES = TextTable("orthogroup_genes", "og_id string, gene_id string", header=False)
ORTHO_GENES = TextTable(
    "ortho_genes",
    "gene_id string, organism_taxid bigint, protein_id string, uniprot_id string, gene_name string, ncbi_gene_id bigint, description string",
    header=False)

PATHWAYS = TextTable("pathways", _text("pathway_id", "pathway_name", "species"), header=False)
PATHWAY_HIERARCHY = TextTable("pathway_hierarchy", _text("parent_id", "child_id"), header=False)
PATHWAY_PROTEINS = TextTable(
    "pathway_proteins", _text("uniprot_id", "reactome_id", "url", "pathway_name", "evidence_code", "species"), header=False)

REACTIONS = TextTable("reactions", "`Rhea ID` int, Equation string, `ChEBI ID` string", style="spaced")
REACTION_PROTEINS = TextTable("reaction_proteins", "RHEA_ID int, DIRECTION string, MASTER_ID int, ID string")
REACTION_PATHWAYS = TextTable(
    "reaction_pathways", "RHEA_ID int, RHEA_DIRECTION_ID int, REACTOME_ID string, REACTOME_PATHWAY_NAME string")

REVIEWED_PROTEINS = TextTable(
    "reviewed_proteins",
    "Entry string, `Entry Name` string, `Protein names` string, `Gene Names` string, Organism string, Length bigint, Mass bigint, "
    "Sequence string, `Gene Ontology IDs` string, `Gene Ontology (GO)` string, Keywords string, Features bigint, "
    "Annotation double, Reviewed string", style="runs")

RESULT_TYPES = TextTable("result_types", _text("resultId", "description"))
