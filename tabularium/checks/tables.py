"""One query per declared table: raw records made row by row from the given tables, then the plan."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tabularium.checks import shapes
from tabularium.checks.registry import check, spread, table
from tabularium.plans import files, genes, molecules, studies
from tabularium.session import fresh_path

c, lit, struct, when, array = F.col, F.lit, F.struct, F.when, F.array


def obj(**fields):
    """Struct literal; a null field will be a missing key."""
    return struct(*[v.alias(k) for k, v in fields.items()])


def text_of(column):
    return c(column).cast("string")


def as_json(df, key, record):
    """(key, record text) of a table whose records are the given struct."""
    return df.select(key, F.to_json(record).alias("record"))


def paged(df, key, envelope, record):
    """(key, page text): one envelope per row with the record in a list."""
    body = F.concat(lit("["), F.to_json(record), lit("]"))
    for step in reversed(envelope.split(".")):
        body = F.concat(lit('{"' + step + '":'), body, lit("}"))
    return df.select(key, body.alias("page"))


def day(column="o_orderdate"):
    return F.date_format(column, "yyyy-MM-dd")


# ---- studies ---------------------------------------------------------------


@check("table_experiments", """
SELECT 'E-' || p_partkey AS accession, p_name AS title, NULL::VARCHAR AS organism, NULL::VARCHAR AS experiment_type, NULL::VARCHAR AS technology,
  NULL::DATE AS submission_date, CASE WHEN p_size NOT IN (20, 21) THEN DATE '2020-01-01' + p_size END::DATE AS release_date,
  CASE WHEN p_size IN (13, 14) THEN NULL ELSE p_size END AS sample_count FROM part""")
def _(spark, d):
    pages = shapes.part_records(spark, d).select(F.concat(lit('{"totalHits":1,"hits":['), c("record"), lit("]}")).alias("page"))
    return studies.EXPERIMENTS.from_pages(pages)


@check("table_image_studies", """
SELECT o_orderkey, o_orderkey::VARCHAR AS accession, o_orderpriority AS title, NULL::VARCHAR AS author,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate::DATE END AS release_date, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END::INTEGER AS file_count,
  o_custkey AS views, NULL::VARCHAR AS organism, NULL::VARCHAR AS imaging_method FROM orders""")
def _(spark, d):
    bad = c("o_orderstatus") == "P"
    record = obj(accession=when(bad, text_of("o_orderkey")).otherwise(""), accno=text_of("o_orderkey"), title=c("o_orderpriority"),
                 release_date=when(bad, lit("soon")).otherwise(day()), files=when(bad, lit("many")).otherwise(text_of("o_custkey")), views=c("o_custkey"))
    return studies.IMAGE_STUDIES.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "hits", record), keep=["o_orderkey"])


@check("table_study_records", """
SELECT o_orderkey::VARCHAR AS accession, o_orderpriority AS title, 'study' AS study_type, o_orderstatus AS organism, o_orderdate::DATE AS release_date,
  o_custkey::INTEGER AS file_count, CASE o_orderstatus WHEN 'O' THEN 'A | B' WHEN 'F' THEN 'A' END AS linked_databases FROM orders""")
def _(spark, d):
    kind = lambda k: obj(url=lit("u"), type=lit(k))
    links = when(c("o_orderstatus") == "O", array(kind("A"), kind(""), kind("B"))).when(c("o_orderstatus") == "F", array(kind("A")))
    record = obj(accession=text_of("o_orderkey"), title=c("o_orderpriority"), type=lit("study"), organism=c("o_orderstatus"),
                 releaseDate=day(), filesCount=c("o_custkey"), links=links)
    return studies.STUDY_RECORDS.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "hits", record))


@check("table_access_studies", """
SELECT 'S' || o_orderkey AS study_id, o_orderpriority AS title, 'wgs' AS study_type, o_orderdate::DATE AS submission_date,
  CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 7 ELSE 0 END AS dataset_count, CASE WHEN o_orderstatus = 'O' THEN 'direct' ELSE o_orderpriority END AS technology,
  CASE o_orderstatus WHEN 'O' THEN '12 | doi:1' WHEN 'F' THEN '5' END AS pubmed_ids FROM orders""")
def _(spark, d):
    s = c("o_orderstatus")
    tags = array(obj(tag=lit("other"), value=lit("x")), obj(tag=lit("Technology"), value=c("o_orderpriority")))
    paper = lambda p, q: obj(pubmedId=lit(p), doi=lit(q))
    record = obj(
        stableId=when(s == "O", lit("")).otherwise(F.concat(lit("S"), text_of("o_orderkey"))), id=F.concat(lit("S"), text_of("o_orderkey")),
        title=c("o_orderpriority"), type=lit("wgs"), creationTime=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        technology=when(s == "O", lit("direct")), attributes=tags,
        datasetsCount=when(s == "F", lit(7)), publications=when(s == "O", array(paper("12", "z"), paper("", "doi:1"))).when(s == "F", array(paper("", ""), paper("5", ""))))
    base = F.to_json(record)
    withlist = when(s == "O", F.concat(F.regexp_replace(base, "\\}$", ""), lit(',"datasets":["a",{"b":1},3]}'))).otherwise(base)
    page = when(s == "O", F.concat(lit("["), withlist, lit("]"))).when(s == "F", F.concat(lit('{"response":{"result":['), withlist, lit("]}}"))).otherwise(
        F.concat(lit('{"result":['), withlist, lit("]}")))
    return studies.ACCESS_STUDIES.from_pages(table(spark, d, "orders").select(page.alias("page")))


@check("table_access_datasets", """
SELECT o_orderkey, 'D' || o_orderkey AS dataset_id, 'bam' AS data_type, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END::INTEGER AS file_count,
  CASE WHEN o_orderstatus = 'P' THEN 'controlled' ELSE o_orderstatus END AS access_status FROM orders""")
def _(spark, d):
    ok = c("o_orderstatus") != "P"
    record = obj(id=F.concat(lit("D"), text_of("o_orderkey")), type=lit("bam"), numberOfFiles=lit(0), fileCount=when(ok, c("o_custkey")),
                 accessType=when(ok, c("o_orderstatus")))
    return studies.ACCESS_DATASETS.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "response.result", record), keep=["o_orderkey"])


@check("table_archive_studies", """
SELECT o_orderkey::VARCHAR AS study_accession, o_orderpriority AS study_title, 'RNA-Seq' AS study_type, o_orderdate::DATE AS first_public, NULL::DATE AS last_updated,
  '' AS center_name, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS tax_id FROM orders""")
def _(spark, d):
    record = obj(study_accession=text_of("o_orderkey"), study_title=c("o_orderpriority"), study_type=lit("RNA-Seq"), first_public=day(), last_updated=lit(""),
                 center_name=lit(""), tax_id=when(c("o_orderstatus") == "P", lit("")).otherwise(text_of("o_custkey")))
    return studies.ARCHIVE_STUDIES.from_records(as_json(table(spark, d, "orders"), "o_orderkey", record))


@check("table_archive_runs", """
SELECT l_orderkey::VARCHAR AS run_accession, l_partkey::VARCHAR AS experiment_accession, l_returnflag AS instrument_model, l_linestatus AS library_strategy,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END AS read_count, l_linenumber::BIGINT AS base_count FROM lineitem""")
def _(spark, d):
    record = obj(run_accession=text_of("l_orderkey"), experiment_accession=text_of("l_partkey"), instrument_model=c("l_returnflag"), library_strategy=c("l_linestatus"),
                 read_count=when(c("l_returnflag") == "R", lit("")).otherwise(text_of("l_suppkey")), base_count=text_of("l_linenumber"))
    return studies.ARCHIVE_RUNS.from_records(as_json(table(spark, d, "lineitem"), "l_orderkey", record))


@check("table_projects", """
SELECT o_orderkey::VARCHAR AS accession, 't' AS title, o_orderdate::DATE AS submission_date, NULL::DATE AS publication_date, 'COMPLETE' AS submission_type,
  o_orderpriority || ' | ' || o_orderstatus AS organisms, NULL::VARCHAR AS organism_parts, NULL::VARCHAR AS diseases, o_orderstatus AS instruments, NULL::VARCHAR AS experiment_types,
  NULL::VARCHAR AS quant_methods, NULL::VARCHAR AS ptms, 'a | b' AS keywords, CASE WHEN o_orderstatus = 'O' THEN 'UK' END AS countries, o_custkey AS total_downloads FROM orders""")
def _(spark, d):
    record = obj(accession=text_of("o_orderkey"), title=lit("t"), submissionDate=day(), publicationDate=lit("n/a"), submissionType=lit("COMPLETE"),
                 organisms=array(obj(name=c("o_orderpriority")), obj(name=c("o_orderstatus"))), instruments=array(obj(name=c("o_orderstatus"))),
                 organismParts=F.array().cast("array<struct<name: string>>"),
                 keywords=array(lit("a"), lit("b")), countries=when(c("o_orderstatus") == "O", array(lit("UK"))), totalFileDownloads=c("o_custkey"))
    return studies.PROJECTS.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "_embedded.projects", record))


@check("table_project_files", """
SELECT page_id::VARCHAR || '.raw' AS file_name, 'RAW' AS file_type, length(html)::BIGINT AS size_bytes, CASE WHEN url LIKE '%ftp%' THEN url ELSE 'ftp://x/' || page_id END AS download_url FROM pages""")
def _(spark, d):
    links = obj(self=obj(href=c("url")), ftp=obj(href=F.concat(lit("ftp://x/"), text_of("page_id"))))
    record = obj(fileName=F.concat(text_of("page_id"), lit(".raw")), fileCategory=obj(name=lit("RAW")), fileSizeBytes=F.length("html"), _links=links)
    return studies.PROJECT_FILES.from_pages(paged(table(spark, d, "pages"), "page_id", "_embedded.files", record))


@check("table_peptides", """
SELECT l_orderkey::VARCHAR AS peptide_sequence, l_partkey::VARCHAR AS protein_accession, l_linenumber AS charge, CASE WHEN l_returnflag = 'R' THEN NULL ELSE 1 END AS missed_cleavages,
  l_extendedprice AS best_search_engine_score, CASE l_returnflag WHEN 'A' THEN 'ox | ' WHEN 'N' THEN 'ph' END AS ptms FROM lineitem""")
def _(spark, d):
    flag = c("l_returnflag")
    ptm = lambda n: obj(name=lit(n))
    record = obj(peptideSequence=text_of("l_orderkey"), proteinAccession=text_of("l_partkey"), charge=c("l_linenumber"), missedCleavages=when(flag == "R", lit("?")).otherwise(lit("1")),
                 bestSearchEngineScore=obj(mascot=c("l_extendedprice"), other=lit(1)),
                 ptms=when(flag == "A", array(ptm("ox"), obj(name=lit("")))).when(flag == "N", array(ptm("ph"))))
    return studies.PEPTIDES.from_pages(paged(table(spark, d, "lineitem"), "l_orderkey", "_embedded.peptideevidences", record))


@check("table_trait_studies", """
SELECT o_orderkey::VARCHAR AS accession_id, o_custkey::VARCHAR AS pubmed_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 't' END AS title, NULL::VARCHAR AS author,
  strftime(o_orderdate, '%Y-%m-%d') AS publication_date, NULL::VARCHAR AS journal, o_orderpriority AS disease_trait, NULL::VARCHAR AS initial_sample_size, NULL::VARCHAR AS replication_sample_size,
  o_custkey AS snp_count, o_orderstatus = 'O' AS imputed, NULL::BOOLEAN AS full_pvalue_set FROM orders""")
def _(spark, d):
    record = obj(accessionId=text_of("o_orderkey"), publicationInfo=obj(pubmedId=text_of("o_custkey"), title=when(c("o_orderstatus") != "P", lit("t")), publicationDate=day()),
                 diseaseTrait=obj(trait=c("o_orderpriority")), snpCount=c("o_custkey"), imputed=c("o_orderstatus") == "O")
    return studies.TRAIT_STUDIES.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "_embedded.studies", record))


@check("table_associations", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN '' ELSE 'rs' || l_partkey END AS snp_id, CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'rs' || l_partkey || '-T' END AS risk_allele,
  NULL::VARCHAR AS risk_frequency, l_tax AS pvalue, NULL::DOUBLE AS pvalue_mlog, NULL::VARCHAR AS pvalue_description, l_quantity AS or_per_copy, NULL::DOUBLE AS beta_num, NULL::VARCHAR AS beta_unit,
  NULL::VARCHAR AS beta_direction, NULL::DOUBLE AS standard_error, '[1-2]' AS "range", NULL::VARCHAR AS snp_type, CASE WHEN l_returnflag <> 'R' THEN 'locus' END AS locus_description,
  CASE l_returnflag WHEN 'A' THEN 'G1, G2' WHEN 'N' THEN NULL END AS genes FROM lineitem""")
def _(spark, d):
    flag = c("l_returnflag")
    genes = when(flag == "A", array(obj(geneName=lit("G1")), obj(geneName=lit("")), obj(geneName=lit("G2"))))
    locus = obj(description=lit("locus"), strongestRiskAlleles=array(obj(riskAlleleName=F.concat(lit("rs"), text_of("l_partkey"), lit("-T")))), authorReportedGenes=genes)
    record = obj(loci=when(flag != "R", array(locus)), pvalue=c("l_tax"), orPerCopyNum=c("l_quantity"), range=lit("[1-2]"))
    body = F.concat(lit('{"_embedded":{"associations":['), F.to_json(record), lit("]}}"))
    return studies.ASSOCIATIONS.from_pages(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", body.alias("page")), keep=["l_orderkey", "l_linenumber"])


@check("table_articles", """
SELECT doc_id::VARCHAR AS pmid, NULL::VARCHAR AS pmcid, NULL::VARCHAR AS doi, source AS title, text AS abstract, 2020 AS pub_year, NULL::VARCHAR AS journal_title, lang AS source,
  n_chars::INTEGER AS citation_count, lang = 'en' AS is_open_access, 'Doe J | Roe' AS authors, CASE WHEN lang = 'en' THEN source END AS mesh_terms, NULL::VARCHAR AS grant_ids FROM documents""")
def _(spark, d):
    authors = obj(author=array(obj(lastName=lit("Doe"), initials=lit("J")), obj(lastName=lit(""), initials=lit("X")), obj(lastName=lit("Roe"), initials=lit(""))))
    mesh = when(c("lang") == "en", obj(meshHeading=array(obj(descriptorName=c("source")))))
    record = obj(pmid=text_of("doc_id"), title=c("source"), abstractText=c("text"), pubYear=lit("2020"), source=c("lang"), citedByCount=c("n_chars"),
                 isOpenAccess=when(c("lang") == "en", "Y").otherwise("N"), authorList=authors, meshHeadingList=mesh)
    return studies.ARTICLES.from_pages(paged(table(spark, d, "documents"), "doc_id", "resultList.result", record))


@check("table_microbiome_studies", """
SELECT o_orderkey::VARCHAR AS accession, o_orderpriority AS study_name, NULL::VARCHAR AS study_abstract, o_custkey AS samples_count, NULL::VARCHAR AS centre_name, NULL::VARCHAR AS bioproject,
  NULL::VARCHAR AS secondary_accession, NULL::VARCHAR AS data_origination, o_orderstatus = 'O' AS is_private, NULL::VARCHAR AS public_release_date, strftime(o_orderdate, '%Y-%m-%d') AS last_update,
  CASE o_orderstatus WHEN 'O' THEN 'root:a;root:b' WHEN 'F' THEN '' END AS biomes FROM orders""")
def _(spark, d):
    s = c("o_orderstatus")
    biome = lambda v: obj(id=lit(v))
    data = when(s == "O", array(biome("root:a"), biome(""), biome("root:b"))).when(s == "F", array(biome("")))
    attrs = obj(**{"study-name": c("o_orderpriority"), "samples-count": c("o_custkey"), "is-private": s == "O", "last-update": day()})
    record = obj(id=text_of("o_orderkey"), attributes=attrs, relationships=obj(biomes=obj(data=data)))
    rows = studies.MICROBIOME_STUDIES.from_pages(paged(table(spark, d, "orders"), "o_orderkey", "data", record))
    return rows.withColumn("biomes", F.array_join("biomes", ";"))


@check("table_microbiome_samples", """
SELECT c_custkey::VARCHAR AS accession, c_name AS sample_name, NULL::VARCHAR AS sample_desc, c_acctbal AS longitude, NULL::DOUBLE AS latitude, NULL::VARCHAR AS collection_date, NULL::VARCHAR AS environment_biome,
  c_mktsegment AS environment_feature, NULL::VARCHAR AS environment_material, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'root:' || c_nationkey END AS biome FROM customer""")
def _(spark, d):
    attrs = obj(**{"sample-name": c("c_name"), "longitude": c("c_acctbal"), "environment-feature": c("c_mktsegment")})
    data = when(c("c_acctbal") >= 0, obj(id=F.concat(lit("root:"), text_of("c_nationkey"))))
    record = obj(id=text_of("c_custkey"), attributes=attrs, relationships=obj(biome=obj(data=data)))
    return studies.MICROBIOME_SAMPLES.from_pages(paged(table(spark, d, "customer"), "c_custkey", "data", record))


@check("table_microbiome_analyses", """
SELECT event_id::VARCHAR AS accession, event_type AS experiment_type, '5.0' AS pipeline_version, 'completed' AS analysis_status, NULL::VARCHAR AS instrument_platform, NULL::VARCHAR AS instrument_model,
  NULL::VARCHAR AS complete_time, user_id::VARCHAR AS sample_accession, CASE WHEN event_type = 'click' THEN 'R1' END AS run_accession, NULL::VARCHAR AS assembly_accession,
  CASE WHEN event_type = 'view' THEN '' ELSE 'user=' || user_id || ';flag=true' END AS summary FROM events""")
def _(spark, d):
    pair = lambda k, v: obj(key=lit(k), value=v)
    pairs = when(c("event_type") != "view", array(pair("user", text_of("user_id")), pair("flag", lit("true"))))
    attrs = obj(**{"experiment-type": c("event_type"), "pipeline-version": lit("5.0"), "analysis-status": lit("completed"), "analysis-summary": pairs})
    rels = obj(sample=obj(data=obj(id=text_of("user_id"))), run=obj(data=when(c("event_type") == "click", obj(id=lit("R1")))))
    record = obj(id=text_of("event_id"), attributes=attrs, relationships=rels)
    rows = studies.MICROBIOME_ANALYSES.from_pages(paged(table(spark, d, "events"), "event_id", "data", record))
    return rows.withColumn("summary", F.array_join(F.transform("summary", lambda p: F.concat(p["key"], lit("="), p["value"])), ";"))


@check("table_taxon_counts", """
SELECT p_partkey::VARCHAR AS taxon_id, CASE WHEN p_size > 25 THEN p_name ELSE p_type || ';;;' || p_brand || ';;;;' END AS lineage, p_size::BIGINT AS count, p_type AS superkingdom, NULL::VARCHAR AS kingdom,
  NULL::VARCHAR AS phylum, p_brand AS class_, NULL::VARCHAR AS "order", NULL::VARCHAR AS family, NULL::VARCHAR AS genus, NULL::VARCHAR AS species FROM part""")
def _(spark, d):
    attrs = obj(lineage=when(c("p_size") > 25, c("p_name")).otherwise(""), count=c("p_size"), hierarchy=obj(**{"super kingdom": c("p_type"), "class": c("p_brand")}))
    return studies.TAXON_COUNTS.from_pages(paged(table(spark, d, "part"), "p_partkey", "data", obj(id=text_of("p_partkey"), attributes=attrs)))


@check("table_go_slim", "SELECT 'GO:' || p_partkey AS go_id, p_name AS description, p_type AS lineage, p_size::BIGINT AS count FROM part")
def _(spark, d):
    record = obj(id=F.concat(lit("GO:"), text_of("p_partkey")), attributes=obj(description=c("p_name"), lineage=c("p_type"), count=c("p_size")))
    return studies.GO_SLIM.from_pages(paged(table(spark, d, "part"), "p_partkey", "data", record))


# ---- genes -----------------------------------------------------------------


@check("table_species", "SELECT c_custkey, c_name AS species_name, c_mktsegment AS common_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS taxon_id, 'A1' AS assembly, NULL::VARCHAR AS genebuild FROM customer")
def _(spark, d):
    record = obj(name=c("c_name"), common_name=c("c_mktsegment"), taxon_id=when(c("c_acctbal") < 0, lit("?")).otherwise(text_of("c_nationkey")), assembly=lit("A1"))
    return genes.SPECIES.from_pages(paged(table(spark, d, "customer"), "c_custkey", "species", record), keep=["c_custkey"])


def gene_record():
    """A gene per document; its lines are the transcripts, an exon per sentence end."""
    lines = shapes.paragraphs(c("text"))
    transcripts = F.transform(lines, lambda s, i: struct(
        F.concat(lit("T"), i.cast("string")).alias("id"), F.left(s, lit(5)).alias("display_name"), lit("coding").alias("biotype"), i.cast("bigint").alias("start"),
        F.length(s).cast("bigint").alias("end"), when(i == 0, lit(1)).otherwise(lit(0)).alias("is_canonical"),
        F.transform(F.regexp_extract_all(s, lit("\\."), lit(0)), lambda x: struct(x.alias("id"))).alias("Exon")))
    return obj(id=text_of("doc_id"), display_name=c("source"), seq_region_name=c("lang"), start=c("doc_id"), end=c("doc_id") + c("n_chars"), strand=lit(-1),
               biotype=lit("coding"), Transcript=when(c("lang") != "fr", transcripts))


@check("table_genes", f"""
SELECT doc_id::VARCHAR AS gene_id, source AS symbol, lang AS chromosome, doc_id AS start, doc_id + n_chars AS "end", (-1)::TINYINT AS strand, 'coding' AS biotype, NULL::VARCHAR AS description,
  CASE WHEN lang <> 'fr' THEN len(list_filter(string_split(text, chr(10)), lambda s: trim(s, ' ') <> '')) ELSE 0 END::INTEGER AS transcript_count, round((n_chars + 1) / 1000.0, 1)::DOUBLE AS span_kb FROM documents""")
def _(spark, d):
    return genes.GENES.from_records(as_json(table(spark, d, "documents"), "doc_id", gene_record()))


@check("table_transcripts", """
WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: trim(s, ' ') <> '') AS ls FROM documents WHERE lang <> 'fr'),
u AS (SELECT doc_id, unnest(ls) AS s, unnest(range(len(ls))) AS i FROM l)
SELECT doc_id, 'T' || i AS transcript_id, s[1:5] AS name, 'coding' AS biotype, length(s) - i + 1 AS length, length(s) - length(replace(s, '.', '')) AS exon_count, i = 0 AS is_canonical FROM u""".replace(
    "length(s) - length(replace(s, '.', '')) AS exon_count", "(length(s) - length(replace(s, '.', '')))::INTEGER AS exon_count"))
def _(spark, d):
    return genes.TRANSCRIPTS.from_records(as_json(table(spark, d, "documents"), "doc_id", gene_record()), keep=["doc_id"])


@check("table_assemblies", """
SELECT vec_id::VARCHAR AS species, 'EnsemblPlants' AS portal, '' AS assembly_name, label::BIGINT AS total_length_bp, len(list_filter(embedding, lambda x: x > 0))::INTEGER AS num_chromosomes,
  len(list_filter(embedding, lambda x: NOT x > 0))::INTEGER AS num_scaffolds FROM embeddings""")
def _(spark, d):
    regions = F.transform("embedding", lambda x: struct(when(x > 0, lit("chromosome")).otherwise(lit("scaffold")).alias("coord_system")))
    record = obj(_portal=lit("EnsemblPlants"), base_pairs=c("label"), top_level_region=regions)
    doc = F.concat(lit('{"'), text_of("vec_id"), lit('":'), F.to_json(record), lit("}"))
    return genes.by_species(genes.ASSEMBLIES, table(spark, d, "embeddings").select(doc.alias("doc")), "doc")


@check("table_gene_counts", "SELECT c_name AS species, '' AS division, c_custkey AS gene_count, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END::BIGINT AS coding_gene_count, c_mktsegment AS assembly FROM customer")
def _(spark, d):
    record = obj(gene_count=c("c_custkey"), coding_count=when(c("c_acctbal") < 0, lit("none")).otherwise(text_of("c_nationkey")), assembly_name=c("c_mktsegment"))
    doc = F.concat(lit('{"'), c("c_name"), lit('":'), F.to_json(record), lit("}"))
    return genes.by_species(genes.GENE_COUNTS, table(spark, d, "customer").select(doc.alias("doc")), "doc")


@check("table_region_genes", """
SELECT p_partkey::VARCHAR AS gene_id, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS gene_name, p_type AS biotype, p_partkey AS start, p_partkey + p_size AS "end", 1::BIGINT AS strand, '' AS description FROM part""")
def _(spark, d):
    record = obj(id=text_of("p_partkey"), external_name=when(c("p_size") > 25, c("p_name")), biotype=c("p_type"), start=c("p_partkey"), end=c("p_partkey") + c("p_size"), strand=lit(1))
    return genes.REGION_GENES.from_records(as_json(table(spark, d, "part"), "p_partkey", record))


@check("table_division_species", """
SELECT c_name AS species, '' AS common_name, c_custkey AS taxon_id, 'A' AS assembly, c_mktsegment AS strain FROM customer""")
def _(spark, d):
    record = obj(name=c("c_name"), taxon_id=c("c_custkey"), assembly_name=lit("A"), strain=c("c_mktsegment"))
    page = F.concat(lit("["), F.to_json(record), lit("]"))
    return genes.DIVISION_SPECIES.from_pages(table(spark, d, "customer").select(page.alias("page")))


@check("table_divisions", "SELECT c_mktsegment AS division, count(*) AS species_count FROM customer GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM customer")
def _(spark, d):
    from tabularium.operators.aggregate import source_counts
    record = obj(name=c("c_name"), taxon_id=c("c_custkey"))
    rows = genes.DIVISION_SPECIES.from_records(as_json(table(spark, d, "customer"), "c_mktsegment", record), keep=["c_mktsegment"])
    return source_counts(rows, "c_mktsegment").withColumnsRenamed({"c_mktsegment": "division", "n_rows": "species_count"})


@check("table_expression_calls_asked", """
SELECT CASE WHEN p_size > 25 THEN 'G' || p_partkey ELSE 'asked ' || p_partkey END AS gene_id, '' AS gene_name, p_type AS anatomical_entity_id, '' AS anatomical_entity_name,
  97.5::DOUBLE AS expression_score, NULL::DOUBLE AS expression_rank, 'EXPRESSED' AS call_type FROM part""")
def _(spark, d):
    gene = when(c("p_size") > 25, obj(geneId=F.concat(lit("G"), text_of("p_partkey"))))
    call = F.to_json(obj(gene=gene, condition=obj(anatEntityId=c("p_type")), expressionScore=lit("97.5"), callType=lit("EXPRESSED")))
    pages = table(spark, d, "part").select(F.concat(lit("asked "), text_of("p_partkey")).alias("wanted"), F.concat(lit('{"calls":['), call, lit("]}")).alias("page"))
    return genes.expression_calls(pages, "wanted")


@check("table_expression_calls", """
SELECT 'G' || p_partkey AS gene_id, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS gene_name, CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS anatomical_entity_id,
  CASE WHEN p_size > 25 THEN '' ELSE 'n' END AS anatomical_entity_name, CASE WHEN p_size > 25 THEN p_retailprice ELSE 7.0 END AS expression_score, NULL::DOUBLE AS expression_rank, 'EXPRESSED' AS call_type FROM part""")
def _(spark, d):
    big = c("p_size") > 25
    condition = when(big, F.to_json(obj(anatomicalEntity=obj(id=c("p_brand"))))).otherwise(F.to_json(obj(anatEntityId=c("p_type"), anatEntityName=lit("n"))))
    head = obj(gene=obj(geneId=F.concat(lit("G"), text_of("p_partkey")), name=when(big, c("p_name"))), expressionScore=when(big, c("p_retailprice")).otherwise(lit(0.0)),
               score=lit(7.0), callType=lit("EXPRESSED"))
    call = F.concat(F.regexp_replace(F.to_json(head), "\\}$", ""), lit(',"condition":'), condition, lit("}"))
    page = when(big, F.concat(lit('{"data":{"expressionCalls":['), call, lit("]}}"))).when(c("p_size") > 15, F.concat(lit('{"calls":['), call, lit("]}"))).otherwise(F.concat(lit("["), call, lit("]")))
    return genes.EXPRESSION_CALLS.from_pages(table(spark, d, "part").select(page.alias("page")))


@check("table_strains", """
SELECT p_partkey AS bacdive_id, CASE WHEN p_size > 45 THEN NULL WHEN p_size > 25 THEN p_type || ' ' || p_brand ELSE p_type END AS species_name, CASE WHEN p_size > 25 THEN 'negative' END AS gram_stain,
  'aerobe' AS oxygen_tolerance, p_name AS isolation_source, CASE WHEN p_size > 10 THEN p_size END::DOUBLE AS temperature_optimum, 7.5::DOUBLE AS ph_optimum, CASE WHEN p_size > 25 THEN 'X' END AS country FROM part""")
def _(spark, d):
    size = c("p_size")
    many = size > 25
    species = when(size > 45, F.to_json(F.array().cast("array<string>"))).when(many, F.to_json(array(obj(genus=c("p_type"), species=c("p_brand")), obj(genus=lit("z"), species=lit("z"))))).otherwise(F.to_json(obj(genus=c("p_type"))))
    temp = F.to_json(array(obj(**{"temperature optimum": when(size > 10, size.cast("string")).otherwise(lit("warm"))})))
    iso = when(many, F.to_json(array(obj(**{"isolation source category": lit(""), "isolation source": c("p_name"), "country": lit("X")})))).otherwise(
        F.to_json(obj(**{"isolation source category": c("p_name")})))
    morphology = when(many, lit('{"cell morphology":{"gram stain":"negative"}}')).otherwise(lit('{"cell morphology":[]}'))
    rec = F.concat(lit('{"General":{"BacDive-ID":'), text_of("p_partkey"), lit('},"Name and taxonomic classification":{"species":'), species, lit('},"Morphology":'), morphology,
                   lit(',"Physiology and metabolism":{"oxygen tolerance":{"oxygen tolerance":"aerobe"},"temperature":'), temp, lit(',"pH":{"pH optimum":"7.5"}},'),
                   lit('"Isolation, sampling and environmental information":{"isolation":'), iso, lit("}}"))
    return genes.STRAINS.from_pages(table(spark, d, "part").select(F.concat(lit('{"count":1,"results":['), rec, lit("]}")).alias("page")))


def cell_line_record():
    size = c("p_size")
    markers = when(size > 25, array(obj(id=lit("D5"), alleles=size.cast("string")), obj(id=lit("TH01"), alleles=c("p_brand")), obj(id=lit("D5"), alleles=c("p_type"))))
    xrefs = when(size > 10, array(obj(db=c("p_type"), id=lit("1")), obj(db=lit("ATCC"), id=lit("2")), obj(db=lit(""), id=lit("3")), obj(db=lit("ATCC"), id=lit("4"))))
    return obj(ac=F.concat(lit("CVCL_"), text_of("p_partkey")), id=c("p_name"), ca=lit("Cancer"), ox=array(obj(id=lit("9606"), label=c("p_brand"))), sx=c("p_type"),
               str=obj(marker=markers), xref=xrefs, cc=when(size > 40, c("p_type")))


@check("table_cell_lines", """
SELECT 'CVCL_' || p_partkey AS accession, p_name AS name, 'Cancer' AS category, p_brand AS species, NULL::VARCHAR AS disease, p_type AS sex, NULL::VARCHAR AS age_at_sampling, p_size > 25 AS str_available,
  CASE WHEN p_size > 10 THEN 4 ELSE 0 END AS xref_count FROM part""")
def _(spark, d):
    page = F.concat(lit('{"total":1,"cell-line":['), F.to_json(cell_line_record()), lit("]}"))
    return genes.CELL_LINES.from_pages(table(spark, d, "part").select(page.alias("page")))


@check("table_cell_panel", """
SELECT 'CVCL_' || p_partkey AS accession, p_name AS name, 'Cancer' AS category, p_brand AS species, NULL::VARCHAR AS disease, p_type AS sex, NULL::VARCHAR AS age_at_sampling,
  CASE WHEN p_size > 25 THEN 3 ELSE 0 END AS str_loci_count, CASE WHEN p_size > 10 THEN 4 ELSE 0 END AS xref_count, CASE WHEN p_size > 10 THEN least('ATCC', p_type) || ' | ' || greatest('ATCC', p_type) END AS xref_databases,
  CASE WHEN p_size > 40 THEN p_type END AS comments, CASE WHEN p_size > 25 THEN p_type END AS str_D5, CASE WHEN p_size > 25 THEN p_brand END AS str_TH01 FROM part""")
def _(spark, d):
    return genes.cell_panel(as_json(table(spark, d, "part"), "p_partkey", cell_line_record()), loci=["D5", "TH01"])


def ortholog_record():
    return obj(omaid=text_of("l_orderkey"), canonicalid=text_of("l_partkey"), entry_nr=c("l_orderkey"), rel_type=c("l_returnflag"), distance=c("l_tax"), score=when(c("l_returnflag") == "R", lit("n/a")).otherwise(text_of("l_quantity")),
               species=when(c("l_linestatus") == "O", obj(species=c("l_linestatus"), taxon_id=c("l_suppkey"))), sequence_length=c("l_linenumber"))


@check("table_orthologs", """
SELECT l_orderkey::VARCHAR AS omaid, l_partkey::VARCHAR AS canonicalid, l_orderkey AS entry_nr, l_returnflag AS rel_type, l_tax AS distance, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS score,
  CASE WHEN l_linestatus = 'O' THEN 'O' END AS species, CASE WHEN l_linestatus = 'O' THEN l_suppkey END AS taxon_id, l_linenumber::BIGINT AS sequence_length FROM lineitem""")
def _(spark, d):
    return genes.ORTHOLOGS.from_records(as_json(table(spark, d, "lineitem"), "l_orderkey", ortholog_record()))


@check("table_hog_members", """
SELECT l_orderkey::VARCHAR AS omaid, l_partkey::VARCHAR AS canonicalid, l_orderkey AS entry_nr, CASE WHEN l_linestatus = 'O' THEN 'O' END AS species, CASE WHEN l_linestatus = 'O' THEN l_suppkey END AS taxon_id,
  l_linenumber::BIGINT AS sequence_length FROM lineitem""")
def _(spark, d):
    return genes.HOG_MEMBERS.from_pages(paged(table(spark, d, "lineitem"), "l_orderkey", "members", ortholog_record()))


# ---- molecules -------------------------------------------------------------


@check("table_drugs", """
SELECT p_partkey::VARCHAR AS chembl_id, p_name AS pref_name, 4::TINYINT AS max_phase, CASE WHEN p_size > 10 THEN p_brand END AS molecular_formula, CASE WHEN p_size > 10 THEN p_retailprice END AS molecular_weight,
  NULL::DOUBLE AS alogp, CASE WHEN p_size > 10 THEN p_size END::SMALLINT AS hbd_count, NULL::SMALLINT AS hba_count, NULL::TINYINT AS ro5_violations, p_type AS indication_class,
  CASE WHEN p_size = 13 THEN NULL ELSE 1990 END::SMALLINT AS first_approval_year FROM part""")
def _(spark, d):
    props = when(c("p_size") > 10, obj(full_molformula=c("p_brand"), full_mwt=text_of("p_retailprice"), alogp=lit(""), hbd=c("p_size"), num_ro5_violations=lit("300")))
    record = obj(molecule_chembl_id=text_of("p_partkey"), pref_name=c("p_name"), max_phase=lit("4.0"), indication_class=c("p_type"), first_approval=when(c("p_size") != 13, lit(1990)), molecule_properties=props)
    return molecules.DRUGS.from_pages(paged(table(spark, d, "part"), "p_partkey", "molecules", record))


@check("table_activities", """
SELECT l_orderkey::VARCHAR AS molecule_chembl_id, 'IC50' AS standard_type, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS standard_value, 'nM' AS standard_units, l_tax AS pchembl_value,
  l_partkey::VARCHAR AS assay_chembl_id FROM lineitem""")
def _(spark, d):
    record = obj(molecule_chembl_id=text_of("l_orderkey"), standard_type=lit("IC50"), standard_value=when(c("l_returnflag") == "R", lit(">10")).otherwise(text_of("l_quantity")), standard_units=lit("nM"),
                 pchembl_value=text_of("l_tax"), assay_chembl_id=text_of("l_partkey"))
    return molecules.ACTIVITIES.from_pages(paged(table(spark, d, "lineitem"), "l_orderkey", "activities", record))


@check("table_compounds", """
SELECT 'CHEBI:' || p_partkey AS chebi_id, p_name AS name, '' AS formula, CASE WHEN p_type <> 'SMALL' THEN p_retailprice END AS monoisotopic_mass, p_size AS charge, '' AS inchi, '' AS smiles, NULL::INTEGER AS star_rating FROM part""")
def _(spark, d):
    from tabularium.checks.sources import compound_xml
    return molecules.compounds(spread(spark, d, "part", "p_partkey").select(compound_xml().alias("doc")), "doc")


def enzyme_page():
    """One answer per order line with two entries: kinetics in both, one shared and one own reference."""
    q, t = text_of("l_quantity"), text_of("l_tax")
    typed = lambda kind, text=None, name=None: obj(
        commentType=lit(kind), reaction=obj(name=name if name is not None else lit(None).cast("string")),
        texts=array(obj(value=text if text is not None else lit(""))))
    reaction = typed("CATALYTIC ACTIVITY", name=F.concat(lit("A + flag "), c("l_returnflag"), lit(" + A = B")))
    kinetics = lambda v, rest: typed("KINETICS", F.concat(lit("Km="), v, rest))
    refs = lambda *ids: array(*[obj(citation=obj(citationCrossReferences=array(obj(database=lit(db), id=lit(i))))) for db, i in ids])
    name = obj(recommendedName=obj(fullName=obj(value=c("l_linestatus"))))
    entry = lambda acc, org, comments, r: obj(primaryAccession=lit(acc), organism=obj(scientificName=org), proteinDescription=name, comments=comments, references=r)
    first = entry("P1", c("l_returnflag"), array(reaction, kinetics(q, lit(" mM for ethanol; more"))), refs(("PubMed", "1"), ("DOI", "2")))
    second = entry("P2", lit("A"), array(typed("FUNCTION", lit("Km=9 mM")), kinetics(t, lit(" µM"))), refs(("PubMed", "1"), ("PubMed", "3")))
    return F.to_json(obj(results=array(first, second)))


@check("table_enzymes", """
SELECT l_orderkey, l_linestatus AS name, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS organism_count, 2 AS substrate_count, l_quantity::VARCHAR || ' mM | ' || l_tax::VARCHAR || ' µM' AS km_values, 2 AS references_count, 'uniprot' AS source FROM lineitem""")
def _(spark, d):
    return molecules.ENZYMES.from_records(spread(spark, d, "lineitem", "l_orderkey").select("l_orderkey", enzyme_page().alias("record")), keep=["l_orderkey"])


@check("table_kinetics", """
SELECT l_orderkey::VARCHAR AS ec_number, 'P1' AS uniprot_id, l_returnflag AS organism, 'ethanol' AS substrate, l_quantity AS km_value, 'mM' AS km_unit FROM lineitem
UNION ALL SELECT l_orderkey::VARCHAR, 'P2', 'A', 'unknown', l_tax, 'µM' FROM lineitem""")
def _(spark, d):
    pages = table(spark, d, "lineitem").select(text_of("l_orderkey").alias("ec"), enzyme_page().alias("page"))
    return molecules.kinetics(pages, "page", "ec")


@check("table_superfamilies", """
SELECT p_partkey, CASE WHEN p_size > 40 THEN '' ELSE '1.' || p_size END AS superfamily_id, CASE WHEN p_size > 40 THEN 0 ELSE 1 END AS class, CASE WHEN p_size > 40 THEN 0 ELSE p_size END AS architecture, 0 AS topology, 0 AS homologous_superfamily,
  p_size AS domain_count, NULL::INTEGER AS pdb_count FROM part""")
def _(spark, d):
    record = obj(cathCode=lit(""), id=when(c("p_size") <= 40, F.concat(lit("1."), text_of("p_size"))), numDomains=lit(0), num_domains=text_of("p_size"), pdb_count=lit("few"))
    return molecules.SUPERFAMILIES.from_pages(paged(table(spark, d, "part"), "p_partkey", "data", record), keep=["p_partkey"])


@check("table_domains", """
SELECT p_partkey, CASE WHEN p_size > 25 THEN '1ABCd00' ELSE '1' END AS domain_id, CASE WHEN p_size > 25 THEN '1abc' ELSE 'x' END AS pdb_id, CASE WHEN p_size > 25 THEN 'D' ELSE '' END AS chain_id, p_size AS start_res,
  CASE WHEN p_size > 25 THEN p_size * 2 END AS stop_res, CASE WHEN p_size > 25 THEN p_size + 1 END AS domain_length FROM part""")
def _(spark, d):
    big = c("p_size") > 25
    record = obj(domainId=when(big, lit("1ABCd00")).otherwise("1"), pdbId=lit("x"), segments=when(big, array(obj(startRes=text_of("p_size"), stop=(c("p_size") * 2).cast("string")), obj(startRes=lit("9"), stop=lit("9")))),
                 start_res=text_of("p_size"))
    return molecules.DOMAINS.from_pages(paged(table(spark, d, "part"), "p_partkey", "results", record), keep=["p_partkey"])


@check("table_density_maps", """
SELECT 'EMD-' || o_orderkey AS emdb_id, o_orderpriority AS title, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END::FLOAT AS resolution_angstrom, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'spa' END AS method,
  CASE WHEN o_orderstatus = 'O' THEN 'a | b' END AS organism, o_orderdate::DATE AS deposition_date, CASE WHEN o_orderstatus = 'F' THEN '1abc | 2abc' END AS fitted_pdb_ids FROM orders""")
def _(spark, d):
    s = c("o_orderstatus")
    value = lambda v: obj(valueOf_=v)
    source = lambda *names: obj(natural_source=array(*[obj(organism=value(lit(n))) for n in names]))
    method = when(s != "P", array(obj(method=lit("spa"), image_processing=array(obj(final_reconstruction=obj(resolution=value(text_of("o_custkey"))))))))
    record = obj(emdb_id=F.concat(lit("EMD-"), text_of("o_orderkey")), admin=obj(title=c("o_orderpriority"), key_dates=obj(deposition=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))),
                 structure_determination_list=obj(structure_determination=method), sample=obj(supramolecule_list=obj(supramolecule=when(s == "O", array(source("b", ""), source("a", "b"))))),
                 crossreferences=obj(pdb_list=obj(pdb_reference=when(s == "F", array(obj(pdb_id=lit("1abc")), obj(pdb_id=lit("2abc")))))))
    return molecules.DENSITY_MAPS.from_records(as_json(table(spark, d, "orders"), "o_orderkey", record))


@check("table_map_methods", "SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS method, count(*) AS count FROM orders GROUP BY 1")
def _(spark, d):
    from tabularium.operators.aggregate import group_count
    method = when(c("o_orderstatus") != "P", array(obj(method=c("o_orderstatus"))))
    record = obj(emdb_id=text_of("o_orderkey"), structure_determination_list=obj(structure_determination=method))
    return group_count(molecules.DENSITY_MAPS.from_records(as_json(table(spark, d, "orders"), "o_orderkey", record)), "method")


@check("table_signatures", """
SELECT 'IPR' || p_partkey AS accession, p_name AS name, p_type AS type, '' AS short_name, CASE WHEN p_size > 25 THEN 2 ELSE 0 END AS member_databases, CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS go_term_count FROM part""")
def _(spark, d):
    meta = obj(accession=F.concat(lit("IPR"), text_of("p_partkey")), name=c("p_name"), type=c("p_type"), member_databases=when(c("p_size") > 25, obj(pfam=obj(PF1=lit("x")), smart=lit("y"))))
    record = obj(metadata=meta, extra_fields=obj(go_terms=when(c("p_size") > 10, array(obj(identifier=lit("GO:1"))))))
    return molecules.SIGNATURES.from_pages(paged(table(spark, d, "part"), "p_partkey", "results", record))


@check("table_matrices", """
SELECT 'MA' || p_partkey || CASE WHEN p_size > 25 THEN '.' || p_size ELSE '' END AS matrix_id, p_name AS name, 'CORE' AS collection, NULL::VARCHAR AS tf_family, 'MA' || p_partkey AS base_id, CASE WHEN p_size > 25 THEN p_size END AS version FROM part""")
def _(spark, d):
    record = obj(matrix_id=F.concat(lit("MA"), text_of("p_partkey"), when(c("p_size") > 25, F.concat(lit("."), text_of("p_size"))).otherwise("")), name=c("p_name"), collection=lit("CORE"))
    return molecules.MATRICES.from_pages(paged(table(spark, d, "part"), "p_partkey", "results", record))


@check("table_matrix_counts", """
WITH l AS (SELECT vec_id, embedding, unnest(range(len(embedding)))::INTEGER AS pos FROM embeddings)
SELECT vec_id::VARCHAR AS matrix_id, pos, base, CASE base WHEN 'A' THEN embedding[pos + 1]::DOUBLE WHEN 'C' THEN 1.0 WHEN 'G' THEN 2.0 ELSE 3.0 END AS n FROM l, (VALUES ('A'), ('C'), ('G'), ('T')) b(base)""")
def _(spark, d):
    flat = lambda v: F.transform("embedding", lambda _: lit(v))
    pfm = obj(A=c("embedding").cast("array<double>"), C=flat(1.0), G=flat(2.0), T=flat(3.0))
    return molecules.matrix_counts(as_json(table(spark, d, "embeddings"), "vec_id", obj(matrix_id=text_of("vec_id"), pfm=pfm)))


@check("table_lipids", """
SELECT p_partkey::VARCHAR AS lm_id, p_name AS name, NULL::VARCHAR AS systematic_name, p_type AS category, p_brand AS main_class, NULL::VARCHAR AS sub_class, CASE WHEN p_size = 13 THEN NULL ELSE p_retailprice END AS exact_mass,
  NULL::VARCHAR AS formula, NULL::VARCHAR AS inchi_key, p_size::VARCHAR AS pubchem_cid FROM part""")
def _(spark, d):
    record = obj(lm_id=text_of("p_partkey"), name=c("p_name"), category=c("p_type"), main_class=c("p_brand"), exact_mass=when(c("p_size") == 13, lit("-")).otherwise(text_of("p_retailprice")), pubchem_cid=c("p_size"), surplus=lit(1))
    return molecules.LIPIDS.from_pages(as_json(table(spark, d, "part"), "p_partkey", array(record)).withColumnRenamed("record", "page"))


@check("table_structures", """
SELECT o_orderkey::VARCHAR AS pdb_id, o_orderpriority AS title, CASE o_orderstatus WHEN 'O' THEN 'X-ray; NMR' ELSE 'EM' END AS experimental_method, CASE WHEN o_orderstatus = 'O' THEN o_custkey END::DOUBLE AS resolution,
  strftime(o_orderdate, '%Y%m%d') AS deposition_date, NULL::VARCHAR AS release_date, CASE o_orderstatus WHEN 'O' THEN 'human' ELSE 'yeast' END AS organism FROM orders WHERE o_orderstatus <> 'P'""")
def _(spark, d):
    o = c("o_orderstatus") == "O"
    shared = obj(title=c("o_orderpriority"), resolution=when(o, c("o_custkey")), deposition_date=F.date_format("o_orderdate", "yyyyMMdd"))
    first = F.concat(F.regexp_replace(F.to_json(shared), "\\}$", ""), when(o, lit(',"experimental_method":["X-ray","NMR"],"organism_scientific_name":["human","mouse"]}')).otherwise(
        lit(',"experimental_method":"EM","related_structures":[{"x":1},{"organism_scientific_name":["yeast"]}]}')))
    doc = F.concat(lit('{"'), text_of("o_orderkey"), lit('":['), when(c("o_orderstatus") == "P", lit("")).otherwise(F.concat(first, lit(',{"title":"second"}'))), lit("]}"))
    return molecules.structures(table(spark, d, "orders").select(doc.alias("doc")))


@check("table_models", """
SELECT doc_id::VARCHAR AS uniprot_id, upper(lang) AS gene, 'A' AS chain, s[1:4] AS template, i::INTEGER AS seq_from, length(s)::INTEGER AS seq_to, 0.5::FLOAT AS coverage, NULL::FLOAT AS identity, NULL::FLOAT AS similarity,
  (length(s) / 4.0)::FLOAT AS gmqe, NULL::FLOAT AS qmean, DATE '2020-02-03' AS created_date
FROM (SELECT doc_id, lang, unnest(ls) AS s, unnest(range(len(ls))) AS i FROM (SELECT doc_id, lang, list_filter(string_split(text, chr(10)), lambda s: trim(s, ' ') <> '') AS ls FROM documents))""")
def _(spark, d):
    from tabularium.operators.lookup import label_by
    items = F.transform(shapes.paragraphs(c("text")), lambda s, i: struct(
        lit("A").alias("chain"), F.left(s, lit(4)).alias("template"), i.alias("from"), F.length(s).alias("to"), lit("0.5").alias("coverage"), (F.length(s) / 4).alias("gmqe"), lit("2020-02-03").alias("created_date")))
    docs = as_json(table(spark, d, "documents").withColumn("key", F.concat_ws(":", c("doc_id").cast("string"), "lang")), "key", obj(result=obj(structures=items)))
    rows = molecules.MODELS.from_records(docs, keep=["key"])
    return rows.withColumns({"uniprot_id": F.substring_index("key", ":", 1),
                             "gene": label_by(F.substring_index("key", ":", -1), {"en": "EN", "fr": "FR", "de": "DE", "es": "ES"})}).drop("key")


def association_xml():
    from tabularium.checks.sources import escaped, tag
    ref = lambda s, r: tag("ExternalReference", F.concat(tag("Source", lit(s)), tag("Reference", r)))
    gene = tag("Gene", F.concat(tag("Symbol", c("p_brand")), tag("ExternalReferenceList", F.concat(ref("HGNC", text_of("p_size")), ref("OMIM", c("p_type")), ref("Other", lit("x")), ref("HGNC", text_of("p_partkey"))))))
    one = tag("DisorderGeneAssociation", F.concat(tag("SourceOfValidation", lit("  ")), gene, tag("DisorderGeneAssociationType", tag("Name", c("p_type")))))
    many = when(c("p_type") == "SMALL", lit("")).when(c("p_size") > 25, F.concat(one, one)).otherwise(one)
    return tag("Disorder", F.concat(tag("OrphaCode", text_of("p_partkey")), tag("Name", escaped(c("p_name"))), tag("DisorderGeneAssociationList", many)))


@check("table_disorder_xrefs", """
SELECT p_partkey AS orpha_code, p_name AS disorder_name, NULL::VARCHAR AS disorder_type, NULL::VARCHAR AS disorder_group, NULL::VARCHAR AS expert_link, x.s AS xref_source, CASE x.s WHEN 'BRAND' THEN p_brand WHEN 'TYPE' THEN p_type END AS xref_id, NULL::VARCHAR AS xref_relation
FROM part, (VALUES ('BRAND'), ('TYPE'), (NULL)) x(s) WHERE (x.s IS NULL AND p_type = 'SMALL') OR (x.s = 'BRAND' AND p_type <> 'SMALL') OR (x.s = 'TYPE' AND p_type <> 'SMALL' AND p_size > 25)""")
def _(spark, d):
    from tabularium.checks.sources import disorder_xml
    from tabularium.sources.xmlsrc import parse_xml
    docs = spread(spark, d, "part", "p_partkey").select(parse_xml(disorder_xml(), molecules.DISORDER_XML).alias("x"))
    return molecules.disorder_xrefs(docs.select("x.*"))


@check("table_disorder_genes", """
SELECT p_partkey AS orpha_code, p_name AS disorder_name, p_brand AS gene_symbol, NULL::VARCHAR AS gene_name, p_type AS association_type, NULL::VARCHAR AS association_status, NULL::VARCHAR AS source_of_validation,
  p_partkey::VARCHAR AS hgnc_id, NULL::VARCHAR AS ensembl_id, p_type AS omim_id, NULL::VARCHAR AS swissprot_id, NULL::VARCHAR AS genatlas_id, NULL::VARCHAR AS reactome_id, NULL::VARCHAR AS iuphar_id
FROM part, range(2) r(i) WHERE p_type <> 'SMALL' AND (i = 0 OR p_size > 25)""")
def _(spark, d):
    from tabularium.sources.xmlsrc import parse_xml
    docs = spread(spark, d, "part", "p_partkey").select(parse_xml(association_xml(), molecules.DISORDER_GENE_XML).alias("x"))
    return molecules.disorder_genes(docs.select("x.*"))


# ---- files -----------------------------------------------------------------


def lines(df, sep, *fields):
    """Lines of text fields; a null field is empty."""
    return df.select(F.concat_ws(sep, *[F.coalesce(f.cast("string"), lit("")) for f in fields]).alias("value"))


@check("table_protein_links", "SELECT 'P' || l_partkey AS protein_a, 'S' || l_suppkey AS protein_b, " + ", ".join(
    f"{(i * 10 + 0)} + l_linenumber AS {name}" for i, name in enumerate(files.CHANNELS)) + ", (l_quantity * 10)::INTEGER AS combined_score FROM lineitem")
def _(spark, d):
    from tabularium.session import fresh_path
    path = fresh_path(spark, "links")
    fields = [F.concat(lit("P"), text_of("l_partkey")), F.concat(lit("S"), text_of("l_suppkey")), *[c("l_linenumber") + i * 10 for i in range(len(files.CHANNELS))], (c("l_quantity") * 10).cast("int")]
    lines(table(spark, d, "lineitem"), " ", *fields).write.option("compression", "gzip").text(path)
    rows = files.TextTable(files.PROTEIN_LINKS.name, files.PROTEIN_LINKS.schema, sep=" ", header=False, finish=files.PROTEIN_LINKS.finish)
    return rows.read(spark, path, partitions=spark.sparkContext.defaultParallelism)


@check("table_protein_info", "SELECT 'P' || p_partkey AS \"#string_protein_id\", p_name AS preferred_name, p_size AS protein_size, p_type AS annotation FROM part")
def _(spark, d):
    return files.PROTEIN_INFO.from_lines(lines(table(spark, d, "part"), "\t", F.concat(lit("P"), text_of("p_partkey")), c("p_name"), c("p_size"), c("p_type")), "value")


@check("table_interactions", "SELECT 'uniprotkb:P' || l_partkey AS \"idA\", CASE WHEN l_returnflag = 'R' THEN 'EBI' || l_suppkey ELSE 'uniprotkb:S' || l_suppkey END AS \"idB\", "
       + ", ".join(f"'-' AS \"{n}\"" for n in ("altA", "altB", "aliasA", "aliasB", "method", "author", "publication", "taxonA", "taxonB", "interaction_type", "source_db", "interaction_id"))
       + ", l_tax::VARCHAR AS confidence, 'P' || l_partkey AS \"accA\", CASE WHEN l_returnflag = 'R' THEN 'EBI' || l_suppkey ELSE 'S' || l_suppkey END AS \"accB\", l_returnflag <> 'R' AS both_uniprot FROM lineitem")
def _(spark, d):
    b = when(c("l_returnflag") == "R", F.concat(lit("EBI"), text_of("l_suppkey"))).otherwise(F.concat(lit("uniprotkb:S"), text_of("l_suppkey")))
    return files.INTERACTIONS.from_lines(lines(table(spark, d, "lineitem"), "\t", F.concat(lit("uniprotkb:P"), text_of("l_partkey")), b, *[lit("-")] * 12, c("l_tax")), "value")


@check("table_annotations", f"SELECT {', '.join({'aspect': 'p_type', 'go_id': 'p_brand', 'db_object_id': 'p_partkey::VARCHAR'}.get(n, "'x'") + f' AS {n}' for n in files.GAF_COLUMNS)} FROM part")
def _(spark, d):
    values = {"aspect": c("p_type"), "go_id": c("p_brand"), "db_object_id": c("p_partkey")}
    raw = lines(table(spark, d, "part"), "\t", *[values.get(n, lit("x")) for n in files.GAF_COLUMNS])
    both = raw.select(F.explode(array(lit("! a comment"), c("value"))).alias("value"))
    return files.ANNOTATIONS.from_lines(both, "value")


@check("table_fission_genes", """
SELECT 'SP' || p_partkey AS systematic_id, p_name AS primary_name, p_type AS product_description, NULL::VARCHAR AS uniprot_id, p_brand AS chromosome, p_partkey::INTEGER AS start_position, (p_partkey + p_size)::INTEGER AS end_position, '1' AS strand FROM part""")
def _(spark, d):
    raw = lines(table(spark, d, "part"), "\t", F.concat(lit("SP"), text_of("p_partkey")), c("p_name"), c("p_type"), lit(None), c("p_brand"), c("p_partkey"), c("p_partkey") + c("p_size"), lit(1))
    return files.FISSION_GENES.from_lines(raw, "value")


@check("table_nomenclature", """
SELECT 'HGNC:' || p_partkey AS hgnc_id, p_name AS symbol, p_brand || ' "x' AS name, CASE WHEN p_size = 13 THEN NULL ELSE p_type END AS status, 'g' AS locus_group, 't' AS locus_type, CASE WHEN p_size = 14 THEN NULL ELSE p_partkey END AS entrez_id,
  DATE '2013-06-27' AS date_approved_reserved, NULL::DATE AS date_symbol_changed, NULL::DATE AS date_name_changed, DATE '2020-01-01' AS date_modified FROM part""")
def _(spark, d):
    raw = lines(table(spark, d, "part"), "\t", F.concat(lit("HGNC:"), text_of("p_partkey")), c("p_name"), F.concat(c("p_brand"), lit(' "x')), when(c("p_size") == 13, lit('""')).otherwise(c("p_type")), lit("g"), lit("t"),
                when(c("p_size") == 14, lit("x1")).otherwise(text_of("p_partkey")), lit("2013-06-27"), lit(""), lit("2013-6-7"), lit("2020-01-01"))
    return files.NOMENCLATURE.from_lines(raw, "value")


@check("table_protein_overview", """
SELECT p_name AS "Gene", NULL::VARCHAR AS "Gene synonym", p_brand AS "Ensembl", CASE WHEN p_size = 13 THEN NULL ELSE p_type END AS "Uniprot", '1' AS "Chromosome", NULL::VARCHAR AS "Position", NULL::VARCHAR AS "Protein class", 'e' AS "Evidence" FROM part""")
def _(spark, d):
    raw = lines(table(spark, d, "part"), "\t", c("p_name"), lit("N/A"), c("p_brand"), when(c("p_size") == 13, lit("-")).otherwise(c("p_type")), lit("1"), lit("NA"), lit(""), lit("e"))
    return files.PROTEIN_OVERVIEW.from_lines(raw, "value")


@check("table_taxon_names", """
SELECT p_type AS genus_name, CASE WHEN p_size > 10 THEN p_name END AS sp_epithet, CASE WHEN p_size > 40 THEN p_brand END AS subsp_epithet, 'correct, "name"' AS status, NULL::VARCHAR AS authors, NULL::VARCHAR AS nomenclatural_type, p_partkey AS record_no,
  NULL::VARCHAR AS record_lnk, CASE WHEN p_size > 40 THEN 'subspecies' WHEN p_size > 10 THEN 'species' ELSE 'genus' END AS rank FROM part""".replace('correct, "name"', "correct, name"))
def _(spark, d):
    raw = lines(table(spark, d, "part"), ",", c("p_type"), when(c("p_size") > 10, c("p_name")), when(c("p_size") > 40, c("p_brand")).otherwise(lit("NA")), lit('"correct, name"'), lit("null"), lit(""), c("p_partkey"), lit("NA"))
    return files.TAXON_NAMES.from_lines(raw, "value")


@check("table_species_per_genus", "SELECT p_type AS genus_name, count(*) AS n_species FROM part WHERE p_size BETWEEN 11 AND 40 GROUP BY 1")
def _(spark, d):
    from tabularium.operators.aggregate import group_count
    raw = lines(table(spark, d, "part"), ",", c("p_type"), when(c("p_size") > 10, c("p_name")), when(c("p_size") > 40, c("p_brand")), lit("s"), lit(""), lit(""), c("p_partkey"), lit(""))
    return group_count(files.TAXON_NAMES.from_lines(raw, "value").filter("rank = 'species'"), "genus_name", out="n_species")


@check("table_rrna_taxonomy", "SELECT p_type || ';' || p_brand || ';' AS path, p_partkey AS taxid, p_name AS rank, NULL::VARCHAR AS remark, '138' AS release FROM part")
def _(spark, d):
    return files.RRNA_TAXONOMY.from_lines(lines(table(spark, d, "part"), "\t", F.concat("p_type", lit(";"), "p_brand", lit(";")), c("p_partkey"), c("p_name"), lit(None), lit("138")), "value")


@check("table_rrna_map", "SELECT 'AB' || l_partkey AS \"primaryAccession\", l_linenumber::BIGINT AS start, l_suppkey AS stop, l_returnflag || ';' AS path, 'sp ' || l_linestatus AS organism_name, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_orderkey END AS taxid FROM lineitem")
def _(spark, d):
    raw = lines(table(spark, d, "lineitem"), "\t", F.concat(lit("AB"), text_of("l_partkey")), c("l_linenumber"), c("l_suppkey"), F.concat("l_returnflag", lit(";")), F.concat(lit("sp "), "l_linestatus"), when(c("l_returnflag") == "R", lit("?")).otherwise(text_of("l_orderkey")))
    return files.RRNA_MAP.from_lines(raw, "value")


@check("table_orthogroups", "SELECT p_partkey || 'at' || p_size AS og_id, p_size::BIGINT AS level_taxid, p_name AS og_name FROM part")
def _(spark, d):
    return files.ORTHOGROUPS.from_lines(lines(table(spark, d, "part"), "\t", F.concat(text_of("p_partkey"), lit("at"), text_of("p_size")), c("p_size"), c("p_name")), "value")


@check("table_orthogroup_genes", "SELECT l_orderkey::VARCHAR AS og_id, l_partkey::VARCHAR AS gene_id FROM lineitem")
def _(spark, d):
    return files.ORTHOGROUP_GENES.from_lines(lines(table(spark, d, "lineitem"), "\t", c("l_orderkey"), c("l_partkey")), "value")


@check("table_ortho_genes", "SELECT p_partkey::VARCHAR AS gene_id, p_size::BIGINT AS organism_taxid, p_brand AS protein_id, NULL::VARCHAR AS uniprot_id, p_name AS gene_name, CASE WHEN p_size = 13 THEN NULL ELSE p_partkey END AS ncbi_gene_id, p_type AS description FROM part")
def _(spark, d):
    raw = lines(table(spark, d, "part"), "\t", c("p_partkey"), c("p_size"), c("p_brand"), lit(None), c("p_name"), when(c("p_size") == 13, lit("12;13")).otherwise(text_of("p_partkey")), c("p_type"))
    return files.ORTHO_GENES.from_lines(raw, "value")


@check("table_pathways", "SELECT 'R-' || p_partkey AS pathway_id, p_name AS pathway_name, p_type AS species FROM part")
def _(spark, d):
    return files.PATHWAYS.from_lines(lines(table(spark, d, "part"), "\t", F.concat(lit("R-"), text_of("p_partkey")), c("p_name"), c("p_type")), "value")


@check("table_pathway_hierarchy", "SELECT o_custkey::VARCHAR AS parent_id, o_orderkey::VARCHAR AS child_id FROM orders")
def _(spark, d):
    return files.PATHWAY_HIERARCHY.from_lines(lines(table(spark, d, "orders"), "\t", c("o_custkey"), c("o_orderkey")), "value")


@check("table_pathway_proteins", "SELECT page_id::VARCHAR AS uniprot_id, 'R' AS reactome_id, url, 'n' AS pathway_name, 'IEA' AS evidence_code, 'sp' AS species FROM pages")
def _(spark, d):
    return files.PATHWAY_PROTEINS.from_lines(lines(table(spark, d, "pages"), "\t", c("page_id"), lit("R"), c("url"), lit("n"), lit("IEA"), lit("sp")), "value")


@check("table_reactions", "SELECT p_partkey::INTEGER AS rhea_id, p_name || ' = ' || p_type AS equation, 'CHEBI:1;CHEBI:2' AS chebi_id FROM part")
def _(spark, d):
    return files.REACTIONS.from_lines(lines(table(spark, d, "part"), "\t", c("p_partkey"), F.concat("p_name", lit(" = "), "p_type"), lit("CHEBI:1;CHEBI:2")), "value")


@check("table_reaction_proteins", "SELECT l_orderkey::INTEGER AS \"RHEA_ID\", l_returnflag AS \"DIRECTION\", l_partkey::INTEGER AS \"MASTER_ID\", 'P' || l_suppkey AS \"ID\" FROM lineitem")
def _(spark, d):
    return files.REACTION_PROTEINS.from_lines(lines(table(spark, d, "lineitem"), "\t", c("l_orderkey"), c("l_returnflag"), c("l_partkey"), F.concat(lit("P"), text_of("l_suppkey"))), "value")


@check("table_reaction_pathways", "SELECT l_orderkey::INTEGER AS \"RHEA_ID\", l_partkey::INTEGER AS \"RHEA_DIRECTION_ID\", 'R' || l_suppkey AS \"REACTOME_ID\", l_returnflag AS \"REACTOME_PATHWAY_NAME\" FROM lineitem")
def _(spark, d):
    return files.REACTION_PATHWAYS.from_lines(lines(table(spark, d, "lineitem"), "\t", c("l_orderkey"), c("l_partkey"), F.concat(lit("R"), text_of("l_suppkey")), c("l_returnflag")), "value")


@check("table_reviewed_proteins", """
SELECT p_partkey::VARCHAR AS entry, p_brand AS entry_name, p_name AS protein_names, p_type AS gene_names, 'Homo sapiens' AS organism, p_size::BIGINT AS length, p_partkey * 110 AS mass, 'MKV' AS sequence, NULL::VARCHAR AS gene_ontology_ids,
  NULL::VARCHAR AS "gene_ontology_(go)", 'k' AS keywords, 3::BIGINT AS features, 5.0::DOUBLE AS annotation, 'reviewed' AS reviewed FROM part""")
def _(spark, d):
    raw = lines(table(spark, d, "part"), "\t", c("p_partkey"), c("p_brand"), c("p_name"), c("p_type"), lit("Homo sapiens"), c("p_size"), c("p_partkey") * 110, lit("MKV"), lit(None), lit(None), lit("k"), lit(3), lit("5.0"), lit("reviewed"))
    return files.REVIEWED_PROTEINS.from_lines(raw, "value")


# ---- files with a header ---------------------------------------------------


def declared(plan):
    """Names and types of a text table."""
    return [(quoted or plain, dtype) for quoted, plain, dtype in re.findall(r"(?:`([^`]+)`|(\w+)) (\w+)", plan.schema)]


def with_header(spark, d, plan, lacking, sep, compression):
    """Files that a table is read from by name: declared columns in reverse order, one left out, one surplus."""
    names = [n for n, _ in declared(plan)[::-1] if n != lacking]
    path = fresh_path(spark, "header")
    cells = [F.concat(lit(f"{n[:2]}-"), text_of("p_partkey")).alias(n) for n in names]
    table(spark, d, "part").select(F.col("p_name").alias("surplus"), *cells).write.options(header=True, sep=sep, compression=compression).csv(path)
    return plan.read(spark, path)


def _named(name, plan, lacking, sep=",", compression="none", renamed=None, typed=(), more=""):
    columns = []
    for column, dtype in declared(plan):
        kind = {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE"}.get(dict(typed).get(column, dtype), "VARCHAR")
        value = f"NULL::{kind}" if column == lacking or kind != "VARCHAR" else f"'{column[:2]}-' || p_partkey"
        columns.append(f'{value} AS "{(renamed or {}).get(column, column)}"')
    check(f"s4_header_{name}", f"SELECT {', '.join(columns)}, p_name AS surplus{more} FROM part")(
        lambda spark, d: with_header(spark, d, plan, lacking, sep, compression))


_named("nomenclature", files.NOMENCLATURE, "entrez_id", "\t", "gzip", typed=files.NOMENCLATURE_TYPES.items())
_named("taxon_names", files.TAXON_NAMES, "subsp_epithet", typed=files.TAXON_NAME_TYPES.items(), more=", 'species' AS rank")
_named("protein_overview", files.PROTEIN_OVERVIEW, "Position", "\t", "gzip")
_named("fission_genes", files.FISSION_GENES, "strand", "\t", renamed={"Systematic ID": "systematic_id", "Primary Name": "primary_name", "Product Description": "product_description"})
_named("result_types", files.RESULT_TYPES, None, "\t")
