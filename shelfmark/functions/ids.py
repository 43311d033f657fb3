"""Identifiers, years, DOIs and links as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def found(col: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, null if there is none."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def record_id_from_name(col: Column, mode: str = "suffix") -> Column:
    return found(col, r"(?i)(\d+)\.pdf$") if mode == "suffix" else found(col, r"(?:^|[^0-9])(\d{6,8})(?:[^0-9]|$)")


def year_from_path(col: Column) -> Column:
    return found(col, r"(?:^|/)(20\d{2})(?:/|$)").cast("int")


def pub_year(col: Column, mode: str = "robust") -> Column:
    """Year of a publication date under one of five rules."""
    dashed, slashed = F.contains(col, F.lit("-")), F.contains(col, F.lit("/"))
    last = F.substring(F.substring_index(col, "/", -1), 1, 4)
    if mode == "robust":
        return found(col, r"((?:19|20)\d{2})").cast("int")
    if mode == "layout":
        return found(col, r"^([12]\d{3})").cast("int")
    if mode == "reconcile":
        return F.when(slashed, last).otherwise(F.substring(col, 1, 4)).try_cast("int")
    rule = F.when(dashed & (F.length(col) >= 4), F.substring_index(col, "-", 1)).when(slashed & (F.length(col) >= 10), last)
    if mode == "lookup":
        rule = rule.when(F.regexp_like(col, F.lit(r"^\d{4}$")), col)
    return rule.try_cast("int")


def org_code(orgs: Column, rules: list[tuple[str, str]]) -> Column:
    """The code of the first rule whose text is inside the first three organisations."""
    joined = F.lower(F.array_join(F.slice(orgs, 1, 3), " "))
    return F.coalesce(*[F.when(F.contains(joined, F.lit(text.lower())), code) for text, code in rules], F.lit("UNKNOWN"))


def org_code_regex(col: Column, rules: list[tuple[str, str]]) -> Column:
    return F.coalesce(*[F.when(F.regexp_like(col, F.lit(f"(?i){pattern}")), code) for pattern, code in rules], F.lit("UNKNOWN"))


def doi_prefix(col: Column) -> Column:
    return F.when(F.coalesce(col, F.lit("")) != "", F.substring_index(col, "/", 1))


def is_data_doi(col: Column, prefixes: list[str]) -> Column:
    return F.coalesce(doi_prefix(col).isin(*prefixes), F.lit(False))


#: Product types of papers, and id prefixes that are not papers.
PAPER_TYPES = ("Journal Article", "Conference", "Technical Report", "Book", "Thesis")
OTHER_PREFIXES = ("code-", "dataset-", "biblio-")


def is_paper(record_id: Column, product_type: Column, types: tuple[str, ...] = PAPER_TYPES, others: tuple[str, ...] = OTHER_PREFIXES) -> Column:
    other = F.lit(False)
    for prefix in others:
        other = other | F.startswith(record_id, F.lit(prefix))
    return F.coalesce(product_type.isin(*types), F.lit(False)) & ~other


def no_doi(doi: Column) -> Column:
    return F.coalesce(doi, F.lit("")) == ""


def missing_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"no_{c}": F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in columns})


def doi_candidates(col: Column) -> Column:
    """Clean-up candidates of a DOI in order, without repeats; each has a registrant.

    As it is; without marks at its end; without a word that is glued to a digit, any and then a capitalised one; without the last of five digits
    or more, and of any digits; and one, two and three characters shorter. Each but the first two starts from the DOI as it is.
    """
    plain = r"^10\.\d+/[\w.-]+"
    shorter = lambda n: F.substring(col, F.lit(1), F.length(col) - n)
    if_like = lambda pattern, n: F.when(F.regexp_like(col, F.lit(plain + pattern)), shorter(n))
    forms = [
        col, F.regexp_replace(col, r"[.,;:)\]}\\\"]+$", ""), F.regexp_replace(col, r"(?<=\d)[A-Za-z][\w./-]*$", ""), F.regexp_replace(col, r"(?<=\d)[A-Z][a-z]\w*$", ""),
        if_like(r"\d{5}$", 1), if_like(r"\d$", 1), *[if_like(f".{{{n}}}$", n) for n in (1, 2, 3)],
    ]
    return F.array_distinct(F.filter(F.array(*forms), lambda x: F.regexp_like(x, F.lit(r"^10\.\d{4,9}/"))))


def rewrite_url(col: Column) -> Column:
    pdf = F.regexp_replace(col, r"/(?:abs|html)/", "/pdf/")
    return F.when(F.regexp_like(col, F.lit(r"/(?:abs|html)/")), pdf).when(F.contains(col, F.lit("/content/")), F.concat(F.regexp_replace(col, r"(\.full)?(\.pdf)?$", ""), F.lit(".full.pdf"))).otherwise(col)


def url_host(col: Column) -> Column:
    return F.lower(found(col, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)"))


def as_list(col: Column) -> Column:
    """A list, or a list written as text with or without brackets and quotes."""
    inner = F.regexp_replace(col, r'^\s*\[|\]\s*$', "")
    items = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), r"""^["']|["']$""", ""))
    return F.when(F.startswith(F.trim(col), F.lit("[")), F.filter(items, lambda x: x != "")).when(F.coalesce(F.trim(col), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(F.trim(col)))


def subject_code(col: Column) -> Column:
    return found(col, r"^(\d{2})\s+.+$")


def rewrite_paths(col: Column, rules: list[tuple[str, str]]) -> Column:
    """The first rule whose old prefix the path has puts the new prefix in its place."""
    out = F.lit(None).cast("string")
    for old, new in reversed(rules):
        out = F.when(F.startswith(col, F.lit(old)), F.concat(F.lit(new), F.substring(col, F.lit(len(old) + 1), F.length(col)))).otherwise(out)
    return F.coalesce(out, col)


def doi_urls(df: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """record_id, doi, url: the candidate URLs of each template of the DOI's prefix, ``{suffix}`` and ``{doi}`` filled in."""
    table = df.sparkSession.createDataFrame(templates, "prefix string, template string")
    rows = df.withColumn("prefix", doi_prefix(F.col("doi"))).join(F.broadcast(table), "prefix")
    suffix = F.expr("substr(doi, length(prefix) + 2)")
    url = F.replace(F.replace(F.col("template"), F.lit("{suffix}"), suffix), F.lit("{doi}"), F.col("doi"))
    return rows.select("record_id", "doi", url.alias("url"))
