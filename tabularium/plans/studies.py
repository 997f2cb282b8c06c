"""Study, experiment, sample, project and article records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabularium.functions.casts import date_prefix, safe, safe_date, typed_null, yes_no
from tabularium.functions.fallback import first_truthy
from tabularium.functions.nested import TAXON_LEVELS, field_list, first_item, join_list, kv_get, strip_outer, stringify_pairs
from tabularium.functions.text import before_first, joined_name, lineage
from tabularium.plans.base import JsonTable

ATTRIBUTES = "attributes: array<struct<name: string, value: string>>"


def _experiment(r: Column, _: Column) -> dict[str, Column]:
    def attribute(name: str) -> Column:
        return kv_get(r["attributes"], name, skip_blank=True)

    return {
        "accession": r["accession"],
        "title": first_truthy(attribute("Title"), r["title"]),
        "organism": attribute("Organism"),
        "experiment_type": attribute("Experiment Type"),
        "technology": first_truthy(attribute("Technology Type"), attribute("Technology")),
        "submission_date": safe_date(first_truthy(attribute("Submission Date"), r["submissionDate"])),
        "release_date": safe_date(first_truthy(attribute("Release Date"), r["releaseDate"])),
        "sample_count": safe(F.coalesce(F.nullif(F.nullif(r["numberOfComponents"], F.lit("0")), F.lit("")), attribute("Number of samples")), "int"),
    }


EXPERIMENTS = JsonTable(
    "experiments",
    f"accession: string, title: string, submissionDate: string, releaseDate: string, numberOfComponents: string, {ATTRIBUTES}",
    _experiment, ("hits",))

IMAGE_STUDIES = JsonTable(
    "image_studies",
    "accession: string, accno: string, title: string, author: string, release_date: string, files: string, views: string",
    lambda r, _: {
        "accession": first_truthy(r["accession"], r["accno"]),
        "title": r["title"],
        "author": r["author"],
        "release_date": safe_date(r["release_date"]),
        "file_count": safe(r["files"], "int"),
        "views": safe(r["views"], "bigint"),
        "organism": typed_null("string"),
        "imaging_method": typed_null("string"),
    }, ("hits",))

STUDY_RECORDS = JsonTable(
    "study_records",
    "accession: string, title: string, type: string, organism: string, releaseDate: string, filesCount: string, "
    "links: array<struct<url: string, type: string>>",
    lambda r, _: {
        "accession": r["accession"],
        "title": r["title"],
        "study_type": r["type"],
        "organism": r["organism"],
        "release_date": safe_date(r["releaseDate"]),
        "file_count": safe(r["filesCount"], "int"),
        "linked_databases": join_list(field_list(r["links"], "type")),
    }, ("hits",))


def _access_study(r: Column, _: Column) -> dict[str, Column]:
    given = first_truthy(r["technology"], r["studyTechnology"])
    tagged = kv_get(r["attributes"], "technology", ignore_case=True, name="tag")
    # A list of data sets, or their number.
    as_list = F.from_json(F.when(r["datasets"].startswith("["), r["datasets"]), "array<string>")
    count = F.coalesce(F.when(F.size(as_list) > 0, F.size(as_list)),
                       F.nullif(safe(r["datasets"], "int"), F.lit(0)), safe(r["datasetsCount"], "int"), F.lit(0))
    papers = F.transform(r["publications"], lambda p: F.coalesce(first_truthy(p["pubmedId"], p["doi"]), F.lit("")))
    return {
        "study_id": first_truthy(r["egaStableId"], r["stableId"], r["id"], r["accessionId"]),
        "title": r["title"],
        "study_type": first_truthy(r["studyType"], r["type"]),
        "submission_date": safe_date(date_prefix(first_truthy(r["submissionDate"], r["creationTime"], r["firstPublished"]))),
        "dataset_count": count,
        "technology": F.coalesce(given, tagged),
        "pubmed_ids": strip_outer(join_list(papers, keep_blank=True)),
    }


ACCESS_STUDIES = JsonTable(
    "access_studies",
    "egaStableId: string, stableId: string, id: string, accessionId: string, title: string, studyType: string, type: string, "
    "submissionDate: string, creationTime: string, firstPublished: string, technology: string, studyTechnology: string, "
    "attributes: array<struct<tag: string, value: string>>, datasets: string, datasetsCount: string, "
    "publications: array<struct<pubmedId: string, doi: string>>",
    _access_study, ("$", "response.result", "result"))

ACCESS_DATASETS = JsonTable(
    "access_datasets",
    "egaStableId: string, stableId: string, id: string, datasetType: string, type: string, numberOfFiles: string, "
    "fileCount: string, status: string, accessType: string",
    lambda r, _: {
        "dataset_id": first_truthy(r["egaStableId"], r["stableId"], r["id"]),
        "data_type": first_truthy(r["datasetType"], r["type"]),
        "file_count": F.coalesce(first_truthy(safe(r["numberOfFiles"], "int"), safe(r["fileCount"], "int"), kind="number"), F.lit(0)),
        "access_status": F.coalesce(first_truthy(r["status"], r["accessType"]), F.lit("controlled")),
    }, ("$", "response.result", "result"))

ARCHIVE_STUDIES = JsonTable(
    "archive_studies",
    "study_accession: string, study_title: string, study_type: string, first_public: string, last_updated: string, "
    "center_name: string, tax_id: string",
    lambda r, _: {
        "study_accession": r["study_accession"],
        "study_title": r["study_title"],
        "study_type": r["study_type"],
        "first_public": safe_date(r["first_public"]),
        "last_updated": safe_date(r["last_updated"]),
        "center_name": r["center_name"],
        "tax_id": safe(r["tax_id"], "bigint"),
    })

ARCHIVE_RUNS = JsonTable(
    "archive_runs",
    "run_accession: string, experiment_accession: string, instrument_model: string, library_strategy: string, "
    "read_count: string, base_count: string",
    lambda r, _: {
        "run_accession": r["run_accession"],
        "experiment_accession": r["experiment_accession"],
        "instrument_model": r["instrument_model"],
        "library_strategy": r["library_strategy"],
        "read_count": safe(r["read_count"], "bigint"),
        "base_count": safe(r["base_count"], "bigint"),
    })

NAMED = "array<struct<name: string>>"

PROJECTS = JsonTable(
    "projects",
    "accession: string, title: string, submissionDate: string, publicationDate: string, submissionType: string, "
    f"organisms: {NAMED}, organismParts: {NAMED}, diseases: {NAMED}, instruments: {NAMED}, experimentTypes: {NAMED}, "
    f"quantificationMethods: {NAMED}, identifiedPTMStrings: array<string>, keywords: array<string>, countries: array<string>, "
    "totalFileDownloads: string",
    lambda r, _: {
        "accession": r["accession"],
        "title": r["title"],
        "submission_date": safe_date(r["submissionDate"]),
        "publication_date": safe_date(r["publicationDate"]),
        "submission_type": r["submissionType"],
        "organisms": join_list(r["organisms"]["name"], keep_blank=True),
        "organism_parts": join_list(r["organismParts"]["name"], keep_blank=True),
        "diseases": join_list(r["diseases"]["name"], keep_blank=True),
        "instruments": join_list(r["instruments"]["name"], keep_blank=True),
        "experiment_types": join_list(r["experimentTypes"]["name"], keep_blank=True),
        "quant_methods": join_list(r["quantificationMethods"]["name"], keep_blank=True),
        "ptms": join_list(r["identifiedPTMStrings"], keep_blank=True),
        "keywords": join_list(r["keywords"], keep_blank=True),
        "countries": join_list(r["countries"], keep_blank=True),
        "total_downloads": safe(r["totalFileDownloads"], "bigint"),
    }, ("$", "_embedded.projects"))

PROJECT_FILES = JsonTable(
    "project_files",
    "fileName: string, fileCategory: struct<name: string>, fileSizeBytes: string, _links: map<string, struct<href: string>>",
    lambda r, _: {
        "file_name": r["fileName"],
        "file_type": r["fileCategory"]["name"],
        "size_bytes": safe(r["fileSizeBytes"], "bigint"),
        "download_url": F.get(F.filter(F.map_values(r["_links"]), lambda link: F.contains(link["href"], F.lit("ftp"))), F.lit(0))["href"],
    }, ("_embedded.files",))

PEPTIDES = JsonTable(
    "peptides",
    "peptideSequence: string, proteinAccession: string, charge: string, missedCleavages: string, "
    f"bestSearchEngineScore: map<string, string>, ptms: {NAMED}",
    lambda r, _: {
        "peptide_sequence": r["peptideSequence"],
        "protein_accession": r["proteinAccession"],
        "charge": safe(r["charge"], "int"),
        "missed_cleavages": safe(r["missedCleavages"], "int"),
        "best_search_engine_score": safe(first_item(F.map_values(r["bestSearchEngineScore"])), "double"),
        "ptms": join_list(F.transform(r["ptms"], lambda m: F.coalesce(m["name"], F.lit(""))), keep_blank=True),
    }, ("_embedded.peptideevidences",))

TRAIT_STUDIES = JsonTable(
    "trait_studies",
    "accessionId: string, publicationInfo: struct<pubmedId: string, title: string, author: string, publicationDate: string, journal: string>, "
    "diseaseTrait: struct<trait: string>, initialSampleSize: string, replicationSampleSize: string, snpCount: bigint, "
    "imputed: boolean, fullPvalueSet: boolean",
    lambda r, _: {
        "accession_id": r["accessionId"],
        "pubmed_id": r["publicationInfo"]["pubmedId"],
        "title": r["publicationInfo"]["title"],
        "author": r["publicationInfo"]["author"],
        "publication_date": r["publicationInfo"]["publicationDate"],
        "journal": r["publicationInfo"]["journal"],
        "disease_trait": r["diseaseTrait"]["trait"],
        "initial_sample_size": r["initialSampleSize"],
        "replication_sample_size": r["replicationSampleSize"],
        "snp_count": r["snpCount"],
        "imputed": r["imputed"],
        "full_pvalue_set": r["fullPvalueSet"],
    }, ("_embedded.studies",))


def _association(r: Column, _: Column) -> dict[str, Column]:
    locus = first_item(r["loci"])
    allele = first_item(locus["strongestRiskAlleles"])["riskAlleleName"]
    return {
        "snp_id": before_first(F.coalesce(allele, F.lit("")), "-"),
        "risk_allele": allele,
        "risk_frequency": r["riskFrequency"],
        "pvalue": r["pvalue"],
        "pvalue_mlog": r["pvalueMlog"],
        "pvalue_description": r["pvalueDescription"],
        "or_per_copy": r["orPerCopyNum"],
        "beta_num": r["betaNum"],
        "beta_unit": r["betaUnit"],
        "beta_direction": r["betaDirection"],
        "standard_error": r["standardError"],
        "range": r["range"],
        "snp_type": r["snpType"],
        "locus_description": locus["description"],
        "genes": join_list(field_list(locus["authorReportedGenes"], "geneName"), ", "),
    }


ASSOCIATIONS = JsonTable(
    "associations",
    "loci: array<struct<description: string, strongestRiskAlleles: array<struct<riskAlleleName: string>>, "
    "authorReportedGenes: array<struct<geneName: string>>>>, riskFrequency: string, pvalue: double, pvalueMlog: double, "
    "pvalueDescription: string, orPerCopyNum: double, betaNum: double, betaUnit: string, betaDirection: string, "
    "standardError: double, `range`: string, snpType: string",
    _association, ("_embedded.associations",))

ARTICLES = JsonTable(
    "articles",
    "pmid: string, pmcid: string, doi: string, title: string, abstractText: string, pubYear: string, journalTitle: string, "
    "source: string, citedByCount: string, isOpenAccess: string, "
    "authorList: struct<author: array<struct<lastName: string, initials: string>>>, "
    "meshHeadingList: struct<meshHeading: array<struct<descriptorName: string>>>, "
    "grantsList: struct<`grant`: array<struct<grantId: string>>>",
    lambda r, _: {
        "pmid": r["pmid"],
        "pmcid": r["pmcid"],
        "doi": r["doi"],
        "title": r["title"],
        "abstract": r["abstractText"],
        "pub_year": safe(r["pubYear"], "int"),
        "journal_title": r["journalTitle"],
        "source": r["source"],
        "citation_count": safe(r["citedByCount"], "int"),
        "is_open_access": yes_no(r["isOpenAccess"]),
        "authors": join_list(F.transform(
            F.filter(r["authorList"]["author"], lambda a: F.coalesce(a["lastName"], F.lit("")) != ""),
            lambda a: joined_name(a["lastName"], a["initials"]))),
        "mesh_terms": join_list(field_list(r["meshHeadingList"]["meshHeading"], "descriptorName")),
        "grant_ids": join_list(field_list(r["grantsList"]["grant"], "grantId")),
    }, ("resultList.result",))


RELATED = "struct<data: struct<id: string>>"

MICROBIOME_STUDIES = JsonTable(
    "microbiome_studies",
    "id: string, attributes: struct<`study-name`: string, `study-abstract`: string, `samples-count`: bigint, `centre-name`: string, "
    "bioproject: string, `secondary-accession`: string, `data-origination`: string, `is-private`: boolean, "
    "`public-release-date`: string, `last-update`: string>, relationships: struct<biomes: struct<data: array<struct<id: string>>>>",
    lambda r, _: {
        "accession": r["id"],
        "study_name": r["attributes"]["study-name"],
        "study_abstract": r["attributes"]["study-abstract"],
        "samples_count": r["attributes"]["samples-count"],
        "centre_name": r["attributes"]["centre-name"],
        "bioproject": r["attributes"]["bioproject"],
        "secondary_accession": r["attributes"]["secondary-accession"],
        "data_origination": r["attributes"]["data-origination"],
        "is_private": r["attributes"]["is-private"],
        "public_release_date": r["attributes"]["public-release-date"],
        "last_update": r["attributes"]["last-update"],
        "biomes": field_list(r["relationships"]["biomes"]["data"], "id"),
    }, ("data",))

MICROBIOME_SAMPLES = JsonTable(
    "microbiome_samples",
    "id: string, attributes: struct<`sample-name`: string, `sample-desc`: string, longitude: double, latitude: double, "
    "`collection-date`: string, `environment-biome`: string, `environment-feature`: string, `environment-material`: string>, "
    f"relationships: struct<biome: {RELATED}>",
    lambda r, _: {
        "accession": r["id"],
        "sample_name": r["attributes"]["sample-name"],
        "sample_desc": r["attributes"]["sample-desc"],
        "longitude": r["attributes"]["longitude"],
        "latitude": r["attributes"]["latitude"],
        "collection_date": r["attributes"]["collection-date"],
        "environment_biome": r["attributes"]["environment-biome"],
        "environment_feature": r["attributes"]["environment-feature"],
        "environment_material": r["attributes"]["environment-material"],
        "biome": r["relationships"]["biome"]["data"]["id"],
    }, ("data",))

MICROBIOME_ANALYSES = JsonTable(
    "microbiome_analyses",
    "id: string, attributes: struct<`experiment-type`: string, `pipeline-version`: string, `analysis-status`: string, "
    "`instrument-platform`: string, `instrument-model`: string, `complete-time`: string, "
    "`analysis-summary`: array<struct<key: string, value: string>>>, "
    f"relationships: struct<sample: {RELATED}, run: {RELATED}, assembly: {RELATED}>",
    lambda r, _: {
        "accession": r["id"],
        "experiment_type": r["attributes"]["experiment-type"],
        "pipeline_version": r["attributes"]["pipeline-version"],
        "analysis_status": r["attributes"]["analysis-status"],
        "instrument_platform": r["attributes"]["instrument-platform"],
        "instrument_model": r["attributes"]["instrument-model"],
        "complete_time": r["attributes"]["complete-time"],
        "sample_accession": r["relationships"]["sample"]["data"]["id"],
        "run_accession": r["relationships"]["run"]["data"]["id"],
        "assembly_accession": r["relationships"]["assembly"]["data"]["id"],
        "summary": F.coalesce(stringify_pairs(r["attributes"]["analysis-summary"]), F.array()),
    }, ("data",))


def _taxon(r: Column, _: Column) -> dict[str, Column]:
    levels = {safe_name: r["attributes"]["hierarchy"][raw] for raw, safe_name in TAXON_LEVELS.items()}
    return {
        "taxon_id": r["id"],
        "lineage": lineage(r["attributes"]["lineage"], list(levels.values())),
        "count": r["attributes"]["count"],
        **levels,
    }


TAXON_COUNTS = JsonTable(
    "taxon_counts",
    "id: string, attributes: struct<lineage: string, count: bigint, hierarchy: struct<"
    + ", ".join(f"`{raw}`: string" for raw in TAXON_LEVELS) + ">>",
    _taxon, ("data",))

GO_SLIM = JsonTable(
    "go_slim", "id: string, attributes: struct<description: string, lineage: string, count: bigint>",
    lambda r, _: {
        "go_id": r["id"],
        "description": r["attributes"]["description"],
        "lineage": r["attributes"]["lineage"],
        "count": r["attributes"]["count"],
    }, ("data",))
