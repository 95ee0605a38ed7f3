"""Hits, domains and their joins to genes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dna, names
from .scale import concat_in_parts, first_per_key


def header_parts(header: Column) -> dict[str, Column]:
    """What the headers of protein sets are made of: the first word, its parts between bars, the text
    up to the first ``key=``, the values of the keys, and an enzyme number anywhere."""
    trimmed = F.trim(header)
    word = F.substring_index(trimmed, " ", 1)
    rest = F.trim(F.substring(trimmed, F.length(word) + 1, F.length(trimmed)))
    free = F.split(F.regexp_replace(rest, "(^| )([A-Za-z]+)=", "\n$2="), "\n")
    keys = F.slice(free, 2, F.size(free))
    numbers = F.filter(F.split(header, "[^0-9.]+"), lambda x: F.size(F.split(x, "[.]")) == 4)
    return {
        "word": word, "bars": F.split(word, "[|]"), "rest": rest, "text": F.trim(F.get(free, F.lit(0))),
        "keys": keys, "enzyme": F.coalesce(F.get(numbers, F.lit(0)), F.lit("")),
    }


def key_value(keys: Column, key: str) -> Column:
    """First word of the value of a key, empty without it."""
    found = F.get(F.filter(keys, lambda x: x.startswith(f"{key}=")), F.lit(0))
    return F.coalesce(F.substring_index(F.substring(found, len(key) + 2, F.length(found)), " ", 1), F.lit(""))


def parse_protein_header(df: DataFrame, header: str = "header", kind: str = "protein", genera: Sequence[str] | None = None,
                         need_genes: bool = False) -> DataFrame:
    """Header -> (id, description ``xref~~~EC~~~gene~~~product``) for protein, phage and virulence sets.

    A phage header is ``id|xref|... product``, a virulence header ``id (number) [gene] (locus) - product``.
    """
    p = header_parts(F.col(header))
    part = lambda i: F.coalesce(F.get(p["bars"], F.lit(i)), F.lit(""))
    if kind == "phage":
        return df.withColumns({"id": part(0), "description": F.concat_ws("~~~", F.lit(""), part(1), p["rest"])})
    if kind == "virulence":
        product = F.substring(p["rest"], F.position(F.lit(" - "), p["rest"]) + 3, F.length(p["rest"]))
        before = F.filter(F.split(F.substring_index(p["rest"], " - ", 1), " "), lambda x: ~x.startswith("("))
        located = F.size(F.split(F.substring_index(p["rest"], " - ", 1), "[(]")) > 2  # a locus in brackets follows a gene
        gene = F.when(located, F.coalesce(F.get(before, F.lit(0)), F.lit(""))).otherwise(F.lit(""))
        return df.withColumns({"id": F.concat_ws("~~~", p["word"], p["enzyme"], gene, product), "description": F.lit("")})
    out = df.filter(F.exists(F.array(*map(F.lit, genera)), lambda g: F.contains(F.col(header), g))) if genera else df
    gene = key_value(p["keys"], "GN")
    if need_genes:
        out = out.filter(gene != "")
    xref = F.regexp_extract(part(2), "^[A-Za-z0-9_]*", 0)
    return out.withColumns({"id": p["word"], "description": F.concat_ws("~~~", xref, p["enzyme"], gene, p["text"])})


def split_tilde(hits: DataFrame, columns: Sequence[str] = ("locus_tag", "target_id", "hit_accession", "hit_name")) -> DataFrame:
    """Fields xref, EC, gene and product out of the last column that carries ``~~~``; it also becomes the description."""
    text = F.lit(None).cast("string")
    for c in columns:
        if c in hits.columns:
            text = F.when(F.col(c).contains("~~~"), F.concat_ws(" ", F.col(c), F.col("description"))).otherwise(text)
    part = F.split(text, "~~~")
    fields = {n: F.get(part, F.lit(i)) for i, n in enumerate(("xref", "EC", "gene", "product"))}
    return hits.withColumns({**fields, "description": F.when(text.isNotNull(), F.get(part, F.lit(3))).otherwise(F.col("description"))})


def query_coverage(hits: DataFrame, proteins: DataFrame) -> DataFrame:
    """Ungapped aligned query letters over the query length, as a percentage with two decimals."""
    sizes = proteins.select(F.col("name").alias("query_id"), F.length("seq").alias("_len"))
    letters = F.length(F.regexp_replace("query_string", r"[-\s]", ""))
    return hits.join(sizes, "query_id").withColumn("coverage", F.round(letters / F.col("_len") * 100, 2)).drop("_len")


def filter_hits(hits: DataFrame, min_cov: float = 1, min_sim: float = 1, min_id: float = 1,
                max_evalue: float | None = None) -> DataFrame:
    """Thresholds in percent; hits to itself and coverage above 100 are left out."""
    keep = (
        (F.col("query_id") != F.col("target_id")) & F.col("coverage").between(min_cov, 100)
        & (F.col("similarity") >= min_sim) & (F.col("identity") >= min_id))
    if max_evalue is not None:
        keep = keep & (F.col("evalue") <= max_evalue)
    return hits.filter(keep)


def top_hits(hits: DataFrame, k: int, ties: Sequence[str] = ("target_id",)) -> DataFrame:
    """The k best hits per query by e-value.

    The rank filter is applied in every map task before the shuffle, so a query
    with very many hits sends k rows per task.
    """
    w = Window.partitionBy("query_id").orderBy("evalue", *ties)
    return hits.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


@dataclass(frozen=True)
class Preset:
    cov: float
    identity: float
    sim: float
    evalue: float | None
    top: int


# Thresholds per database step.
PRESETS = {
    "ABX": Preset(60, 90, 1, 1e-10, 1),
    "IS": Preset(30, 20, 30, 1e-5, 1),
    "PDB": Preset(40, 40, 40, None, 10),
    "VFDB": Preset(40, 40, 40, None, 1),
    "COGS": Preset(80, 40, 70, None, 10),
    "UNIPROT": Preset(70, 50, 1, None, 15),
}


def annotate_hits(hits: DataFrame, step: str, ties: Sequence[str] = ("target_id",)) -> DataFrame:
    p = PRESETS[step]
    return top_hits(filter_hits(hits, p.cov, p.sim, p.identity, p.evalue), p.top, ties)


def sort_hits(hits: DataFrame) -> DataFrame:
    return hits.orderBy("query_id", "evalue")


def best_hit(hits: DataFrame, ties: Sequence[str] = ("target_id",), key: str = "query_id", score: str = "bits") -> DataFrame:
    """Highest score, then lowest e-value: a partial aggregate."""
    return first_per_key(hits, [key], [-F.col(score), F.col("evalue"), *[F.col(c) for c in ties]])


def gene_number(tag="locus_tag") -> Column:
    return F.regexp_extract(tag, r"0*(\d+)$", 1).try_cast("bigint")


def order_genes(genes: DataFrame) -> DataFrame:
    return genes.orderBy(gene_number(), "locus_tag")


def order_features(features: DataFrame) -> DataFrame:
    return features.orderBy("seqname", "lo", F.col("hi").desc())


def combine_annotations(genes: DataFrame, tables: dict[str, DataFrame], key: str = "locus_tag") -> DataFrame:
    """Each gene with one list per table, empty when nothing matched.

    The tables are reduced to a fixed number of rows per gene first (``top_hits``,
    ``best_hit``), which bounds the lists. Tables of any size per gene join row by
    row with ``gene_rows``.
    """
    out = genes
    for name, t in tables.items():
        rest = [c for c in t.columns if c != key]
        listed = t.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias(name))
        out = out.join(listed, key, "left")
        out = out.withColumn(name, F.coalesce(name, F.array().cast(listed.schema[name].dataType)))
    return out


def gene_rows(genes: DataFrame, table: DataFrame, key: str = "locus_tag") -> DataFrame:
    """One row per gene and matching table row; a gene without one appears once."""
    return genes.join(table, key, "left")


def hits_with_entries(hits: DataFrame, entries: DataFrame, key: str = "accession") -> DataFrame:
    return hits.join(entries, key)


def hits_without_entry(hits: DataFrame, entries: DataFrame, key: str = "accession") -> DataFrame:
    """The misses that the lookup treats as an error."""
    return hits.join(entries.select(key).distinct(), key, "left_anti")


def hits_with_cogs(hits: DataFrame, protein_to_group: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Protein -> group -> description, both optional."""
    two = hits.join(protein_to_group, "target_id", "left")
    return two.join(descriptions, "group_id", "left")


def consolidate_tags(tags: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Repeated tags of a feature joined by ``;`` in stable order."""
    return concat_in_parts(tags, [*key, "tag"], [F.col(c) for c in order], "value", ";", "value")


def notes_to_tags(features: DataFrame, keys: Sequence[str], note: str = "note") -> DataFrame:
    """``key: value; key: value`` notes -> rows (tag, value), trimmed and distinct."""
    each = features.select(*keys, F.explode(F.split(note, ";")).alias("_x"))
    rows = each.select(*keys, F.split("_x", r"\s*:\s*").alias("p"))
    rows = rows.select(*keys, F.trim(F.get("p", F.lit(0))).alias("tag"), F.trim(F.coalesce(F.get("p", F.lit(1)), F.lit(""))).alias("value"))
    return rows.filter((F.col("tag") != "") & (F.col("value") != "")).distinct()


def domains_on_genome(matches: DataFrame, genes: DataFrame) -> DataFrame:
    """Domain matches (protein coordinates) as genome features of their gene."""
    joined = matches.join(genes.select("locus_tag", "seqname", "lo", "hi", "strand"), "locus_tag")
    start, end = dna.genome_position("start", "end", "lo", "hi", "strand")
    return joined.withColumns({"g_start": start, "g_end": end})


def describe_hits(hits: DataFrame) -> DataFrame:
    gene, product = names.gene_and_product("description")
    return hits.withColumns({"gene": gene, "product": product})


def annotate(genes: DataFrame, hits: dict[str, DataFrame]) -> DataFrame:
    """Preset filter and best hit per database, then the products of a gene joined by ``;``.

    ``hits`` maps a preset name to a hit table whose query is the locus tag.
    """
    found = None
    for step, table in hits.items():
        best = best_hit(annotate_hits(table, step)).select(
            F.col("query_id").alias("locus_tag"), F.lit(step).alias("step"), F.concat(F.lit(step), F.lit(":"), "target_id").alias("value"))
        found = best if found is None else found.unionByName(best)
    # one value per database
    listed = found.groupBy("locus_tag").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("step", "value"))), lambda x: x["value"]), ";").alias("found"))
    return genes.join(listed, "locus_tag", "left")
