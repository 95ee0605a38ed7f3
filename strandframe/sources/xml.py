"""XML sources through the built-in reader with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _xml(spark: SparkSession, path, tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


PROTEIN_ENTRY = """
_dataset string, accession array<string>, name array<string>,
protein struct<recommendedName: struct<fullName: string>, submittedName: array<struct<fullName: string>>>,
proteinExistence struct<_type: string>,
gene array<struct<name: array<struct<_VALUE: string, _type: string>>>>,
geneLocation array<struct<name: array<struct<_VALUE: string, _type: string>>>>,
dbReference array<struct<_type: string, _id: string, property: array<struct<_type: string, _value: string>>>>
"""


def read_uniprot_xml(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """Protein entries, and their cross references whose first property is the entry name."""
    e = _xml(spark, path, "entry", PROTEIN_ENTRY)
    zero = F.lit(0)
    gene = F.get(F.get("gene", zero)["name"], zero)
    place = F.get(F.get("geneLocation", zero)["name"], zero)
    has_gene = F.size(F.coalesce("gene", F.array().cast("array<struct<name:array<struct<_VALUE:string,_type:string>>>>"))) > 0
    gene_ids = F.filter("dbReference", lambda r: r["_type"] == "GeneId")
    entries = e.select(
        F.get("accession", zero).alias("accession"), F.get("name", zero).alias("name"), F.col("_dataset").alias("dataset"),
        F.coalesce(F.col("protein.recommendedName.fullName"), F.get(F.col("protein.submittedName"), zero)["fullName"]).alias("proteinName"),
        F.col("proteinExistence._type").alias("proteinType"),
        F.when(has_gene, gene["_type"]).otherwise(place["_type"]).alias("geneType"),
        F.when(has_gene, gene["_VALUE"]).otherwise(place["_VALUE"]).alias("geneName"),
        F.try_element_at(gene_ids, F.lit(-1))["_id"].alias("dbRefId"))
    refs = e.select(F.get("accession", zero).alias("accession"), F.explode("dbReference").alias("r"))
    first = F.get(F.col("r.property"), zero)
    refs = refs.filter(first["_type"] == "entry name").select(
        "accession", F.col("r._id").alias("dbRefId"), F.col("r._type").alias("dbRefType"), first["_value"].alias("dbRefName"))
    return entries, refs


DOMAIN_PROTEIN = """
_id string, _length int,
interpro array<struct<_id: string, _name: string, _type: string,
  match: array<struct<_id: string, _name: string, _dbname: string,
    location: array<struct<_start: int, _end: int, _score: string, _status: string, _evidence: string>>>>,
  child_list: struct<rel_ref: array<struct<_ipr_ref: string>>>,
  classification: array<struct<_id: string, _class_type: string, category: string, description: string>>>>
"""


def read_interpro_xml(spark: SparkSession, path) -> dict[str, DataFrame]:
    """Hits, matches, child references and classifications of domain matches."""
    p = _xml(spark, path, "protein", DOMAIN_PROTEIN)
    hit = p.select(F.col("_id").alias("protein_id"), F.col("_length").alias("protein_length"), F.explode("interpro").alias("h"))
    hits = hit.select("protein_id", "protein_length", F.col("h._id").alias("interpro_id"), F.col("h._name").alias("interpro_name"), F.col("h._type").alias("interpro_type"))
    match = hit.select("protein_id", F.explode("h.match").alias("m")).select("protein_id", "m", F.explode("m.location").alias("l"))
    matches = match.select(
        "protein_id", F.col("m._id").alias("match_id"), F.col("m._name").alias("match_name"), F.col("m._dbname").alias("match_db_name"),
        F.col("l._start").alias("start"), F.col("l._end").alias("end"), F.col("l._score").alias("score"), F.col("l._status").alias("status"), F.col("l._evidence").alias("evidence"))
    children = hit.select("protein_id", F.col("h._id").alias("interpro_id"), F.explode("h.child_list.rel_ref").alias("c")).select(
        "protein_id", "interpro_id", F.col("c._ipr_ref").alias("child_reference"))
    classes = hit.select("protein_id", F.explode("h.classification").alias("c")).select(
        "protein_id", F.col("c._id").alias("id"), F.col("c._class_type").alias("class_type"), F.col("c.category").alias("category"), F.col("c.description").alias("description"))
    return {"hits": hits, "matches": matches, "children": children, "classifications": classes}


DOMAIN_ENTRY = """
_id string, _type string, name string, abstract string,
class_list struct<classification: array<struct<_id: string, _class_type: string, category: string, description: string>>>,
pub_list struct<publication: array<struct<db_xref: array<struct<_db: string, _dbkey: string>>>>>
"""


def read_interpro_entries(spark: SparkSession, path) -> dict[str, DataFrame]:
    """Domain dictionary, GO terms, domain-GO links and domain-publication links."""
    d = _xml(spark, path, "interpro", DOMAIN_ENTRY)
    domains = d.select(F.col("_id").alias("id"), "name", F.col("_type").alias("type"), F.trim(F.regexp_replace("abstract", r"\s+", " ")).alias("abstract"))
    go = d.select(F.col("_id").alias("domain_id"), F.explode("class_list.classification").alias("c")).filter("c._class_type = 'GO'")
    terms = go.select(F.col("c._id").alias("id"), F.col("c.category").alias("category"), F.col("c.description").alias("description"))
    links = go.select("domain_id", F.col("c._id").alias("go_id"))
    pubs = d.select(F.col("_id").alias("domain_id"), F.explode("pub_list.publication").alias("p"))
    pubs = pubs.select("domain_id", F.get(F.col("p.db_xref"), F.lit(0))["_dbkey"].alias("pubmed_id")).filter("pubmed_id IS NOT NULL")
    return {"domains": domains, "go": terms, "go_links": links, "publications": pubs}


SAMPLE = "_alias string, _accession string"
EXPERIMENT = "_accession string, DESIGN struct<LIBRARY_DESCRIPTOR: struct<LIBRARY_NAME: string>>"
RUN = ("_accession string, EXPERIMENT_REF struct<_accession: string>, "
       "DATA_BLOCK array<struct<FILES: struct<FILE: array<struct<_filename: string>>>>>")
MAP_ALIGNMENT = "_MAP1 string, _MAP2 string"
RESTRICTION_MAP = "SEQUENCE_ANNOTATION array<struct<_IDENTIFIER: string, _INSILICO: string>>"


def sra_read_groups(spark: SparkSession, sample: str, experiment: str, run: str) -> DataFrame:
    """Read groups (run, sample, library) of one submission, with the files of each run."""
    samples = _xml(spark, sample, "SAMPLE", SAMPLE)
    alias = F.coalesce(samples.agg(F.max("_alias")).scalar(), F.lit("UNKNOWN"))
    experiments = _xml(spark, experiment, "EXPERIMENT", EXPERIMENT).select(
        F.col("_accession").alias("experiment"), F.trim("DESIGN.LIBRARY_DESCRIPTOR.LIBRARY_NAME").alias("library"))
    runs = _xml(spark, run, "RUN", RUN)
    files = F.flatten(F.transform("DATA_BLOCK", lambda b: F.transform(b["FILES"]["FILE"], lambda f: f["_filename"])))
    rows = runs.select(F.col("_accession").alias("run"), F.col("EXPERIMENT_REF._accession").alias("experiment"), files.alias("files"))
    return rows.join(experiments, "experiment", "left").select("run", alias.alias("sample"), "library", "files")


def run_files(groups: DataFrame) -> DataFrame:
    """File -> read group id; several files of a run get a number."""
    several = F.size("files") > 1
    return groups.select("run", several.alias("m"), F.posexplode("files").alias("i", "file")).select(
        "file", F.when(F.col("m"), F.concat("run", F.lit("_"), F.col("i") + 1)).otherwise(F.col("run")).alias("rg"))


def read_map_alignments(spark: SparkSession, path) -> DataFrame:
    """Mentions of contigs in restriction-map alignments, one row each (``contig``)."""
    pairs = _xml(spark, path, "MAP_ALIGNMENT", MAP_ALIGNMENT)
    silico = F.when(F.col("_MAP1").contains("in silico"), F.col("_MAP1")).when(F.col("_MAP2").contains("in silico"), F.col("_MAP2"))
    maps = _xml(spark, path, "RESTRICTION_MAP", RESTRICTION_MAP)
    note = F.get("SEQUENCE_ANNOTATION", F.lit(0))
    placed = F.when(F.lower(note["_INSILICO"]).contains("false"), F.lit("0")).otherwise(note["_IDENTIFIER"])
    both = pairs.select(silico.alias("id")).unionByName(maps.select(placed.alias("id")))
    return both.filter("id IS NOT NULL").select(F.regexp_replace("id", r"\s+.*$", "").alias("contig"))
