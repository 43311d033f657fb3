"""Text, names, contacts, answers and scores as column expressions."""

from __future__ import annotations

import difflib
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
STOP_WORDS = ("a", "an", "and", "for", "in", "of", "on", "the", "to", "with")


def tokens(col: Column, pattern: str = "[a-z0-9]+") -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(f"({pattern})"), F.lit(1)))


def name_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of the tokens of three letters or more."""
    x, y = tokens(a, "[a-z]{3,}"), tokens(b, "[a-z]{3,}")
    union = F.size(F.array_union(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / union)


def title_match(query: Column, other: Column, threshold: float = 0.7) -> Column:
    """At least that share of the query's tokens, stop words aside, is in the other title."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    q = F.array_except(tokens(query), stop)
    return F.when(F.size(q) == 0, False).otherwise(F.size(F.array_intersect(q, tokens(other))) >= threshold * F.size(q))


def clean_title(col: Column) -> Column:
    return F.substring(F.trim(F.regexp_replace(col, r"[^A-Za-z0-9]+", " ")), 1, 200)


def extract_emails(col: Column, head: int | None = None, spelled: bool = True) -> Column:
    """Addresses in the whole text, or in its first ``head`` characters.

    ``spelled`` adds those written as ``a at b dot c``. As ``at`` is also a common word, it finds some that were none (``it was at 10.1.2.3``).
    """
    start = F.coalesce(col, F.lit(""))
    start = start if head is None else F.substring(start, 1, head)
    found = F.regexp_extract_all(start, F.lit(f"({EMAIL})"), F.lit(1))
    if spelled:
        open_ = F.regexp_replace(F.regexp_replace(start, r"(?i)\s+(?:at|\[at\]|\(at\))\s+", "@"), r"(?i)\s+(?:dot|\[dot\]|\(dot\))\s+", ".")
        found = F.array_union(found, F.regexp_extract_all(open_, F.lit(f"({EMAIL})"), F.lit(1)))
    return F.array_sort(F.array_distinct(found))


def split_multi_email(col: Column) -> Column:
    """(primary, extras); text without any valid address stays as it is."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), r"(?i)\s+or\s+|\s+and\s+|[;,/\s]+"), lambda x: F.regexp_replace(x, r"^[<>(),:;]+|[<>(),:;]+$", ""))
    valid = F.array_distinct(F.filter(parts, lambda x: F.regexp_like(x, F.lit(f"^{EMAIL}$"))))
    none = F.array().cast("array<string>")
    return F.when(F.size(valid) > 0, F.struct(F.get(valid, F.lit(0)).alias("primary"), F.slice(valid, 2, F.size(valid)).alias("extras"))).otherwise(F.struct(col.alias("primary"), none.alias("extras")))


def email_checks(email: Column, authors: Column, own_domains: list[str]) -> Column:
    local, domain = F.lower(F.substring_index(email, "@", 1)), F.lower(F.substring_index(email, "@", -1))
    syntax = F.regexp_like(email, F.lit(f"^{EMAIL}$")) & (F.length(local) <= 64) & (F.length(domain) <= 255) & ~F.contains(email, F.lit(".."))
    overlap = F.exists(F.filter(F.split(F.lower(F.coalesce(authors, F.lit(""))), "[^a-z]+"), lambda x: F.length(x) >= 3), lambda x: F.contains(local, x))
    kind = F.when(domain.isin(*own_domains), "own").when(F.regexp_like(domain, F.lit(r"\.(?:gov|mil)$")), "government").when(F.regexp_like(domain, F.lit(r"\.edu$|\.ac\.")), "academic").otherwise("other")
    return F.struct(
        syntax.alias("syntax"), overlap.alias("author_overlap"), kind.alias("domain_class"),
        F.regexp_like(email, F.lit(r"(?i)\[at\]|\(at\)| at | dot ")).alias("obfuscated"), (F.regexp_count(email, F.lit("@")) > 1).alias("multiple"),
    )


def email_verdict(syntax: Column, multiple: Column, obfuscated: Column, reachable: Column, deliverable: Column) -> Column:
    return (
        F.when(~syntax, "syntax_bad").when(multiple, "multi_addr").when(obfuscated, "obfusc")
        .when(~F.coalesce(reachable, F.lit(True)), "unreachable").when(~F.coalesce(deliverable, F.lit(True)), "not_deliverable").otherwise("valid")
    )


def parse_author(col: Column) -> Column:
    name = F.trim(F.regexp_replace(F.regexp_replace(col, r"\(ORCID:[^)]*\)", ""), r"\[[^\]]*\]", ""))
    orcid = F.nullif(F.regexp_extract(col, r"ORCID:\s*([0-9X-]+)", 1), F.lit(""))
    return F.struct(name.alias("name"), F.regexp_extract_all(col, F.lit(r"\[([^\]]*)\]"), F.lit(1)).alias("affiliations"), orcid.alias("orcid"))


def page_has_email(html: Column, email: Column) -> Column:
    local, domain = F.substring_index(email, "@", 1), F.substring_index(email, "@", -1)
    hidden = F.concat(local, F.lit(" at "), F.replace(domain, F.lit("."), F.lit(" dot ")))
    return F.contains(F.lower(html), F.lower(email)) | F.contains(F.lower(html), F.lower(hidden))


def affil_matches_domain(domain: Column, affiliation: Column, generic: list[str], abbreviations: list[tuple[str, str]]) -> Column:
    text = F.lower(F.coalesce(affiliation, F.lit("")))
    parts = F.filter(F.split(F.lower(domain), r"\."), lambda x: (F.length(x) >= 3) & ~x.isin(*generic))
    direct = F.exists(parts, lambda x: F.contains(text, x))
    for short, full in abbreviations:
        direct = direct | (F.array_contains(parts, short) & F.contains(text, F.lit(full)))
    return F.coalesce(direct, F.lit(False))


def is_placeholder(col: Column, data_card: bool = False) -> Column:
    """Values that stand for none; on data cards every DOI that holds ``not`` as well."""
    low = F.lower(F.trim(F.coalesce(col, F.lit(""))))
    if data_card:
        return (F.length(low) < 2) | F.contains(low, F.lit("not"))
    return (F.length(low) < 2) | low.isin("not specified", "unknown", "null", "n/a", "none") | F.startswith(low, F.lit("[not"))


def is_data_host(url: Column, domains: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, domains)), lambda d: F.contains(F.lower(url), d))


def header_field(col: Column, key: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(col, rf"(?m)^{key}:[ \t]*(.*)$", 1)), F.lit(""))


def header_fields(col: Column, keys: list[str]) -> Column:
    """A map of the header fields that have a value."""
    entries = F.array(*[F.struct(F.lit(key).alias("key"), header_field(col, key).alias("value")) for key in keys])
    return F.map_from_entries(F.filter(entries, lambda x: x["value"].isNotNull()))


def _answer_lines(col: Column, key: str) -> Column:
    """What follows ``key:`` on the lines that begin with it."""
    return F.regexp_extract_all(col, F.lit(rf"(?im)^[ \t]*{key}:[ \t]*(.*?)[ \t\r]*$"), F.lit(1))


def parse_verdict(col: Column, labels: list[str], default: str = "UNCLEAR") -> Column:
    """The label on the last verdict line that has one; of several the first in the list."""
    label = lambda line: F.coalesce(*[F.when(F.contains(F.upper(line), F.lit(x)), x) for x in labels])
    found = F.filter(F.transform(_answer_lines(col, "verdict"), label), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(default))


def parse_why(col: Column) -> Column:
    """The last reason line's text."""
    return F.coalesce(F.try_element_at(_answer_lines(col, "why"), F.lit(-1)), F.lit(""))


def truncate_middle(col: Column, n: int, marker: str = " ... ") -> Column:
    half = n // 2
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, half), F.lit(marker), F.right(col, F.lit(n - half)))).otherwise(col)


#: LaTeX patterns and what each becomes, in order.
LATEX = (
    (r"\\(?:begin|end)\{[^}]+\}", ""),
    (r"\\href\{[^}]*\}\{([^}]*)\}", "$1"),
    (r"\\(?:textbf|emph|texttt)\{([^}]*)\}", "$1"),
    (r"\\[a-zA-Z]+\*?\s*(?:\[[^\]]*\])?", ""),
)


def strip_latex(col: Column) -> Column:
    for pattern, text in LATEX:
        col = F.regexp_replace(col, pattern, text)
    return col


def upsert_block(body: Column, block: Column, start: str, end: str) -> Column:
    """(text, status): the first marked block replaced, or the block added at the end."""
    whole = F.concat(F.lit(start + "\n"), block, F.lit("\n" + end))
    at = F.locate(start, body)
    stop = F.locate(end, body)
    has = (at > 0) & (stop > at)
    replaced = F.concat(F.substring(body, F.lit(1), at - 1), whole, F.substring(body, stop + len(end), F.length(body)))
    text = F.when(has, replaced).otherwise(F.concat(F.rtrim(body), F.lit("\n\n"), whole, F.lit("\n")))
    return F.struct(text.alias("text"), F.when(~has, "inserted").when(text == body, "idempotent").otherwise("updated").alias("status"))


def report_score(col: Column, axis: str | None = None) -> Column:
    """A score of 0 to 10 from a report's text, or from its lines that name ``axis``: n/10, ~n%, a/b, n%, or strong, moderate and weak."""
    text = col if axis is None else F.array_join(F.regexp_extract_all(col, F.lit(rf"(?im)^(.*\b{axis}\b.*)$"), F.lit(1)), "\n")
    number = lambda pattern, scale: F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("double") * scale
    part = lambda group: F.nullif(F.regexp_extract(text, r"(\d+)\s*/\s*(\d+)", group), F.lit("")).cast("double")
    words = F.when(F.regexp_like(text, F.lit("(?i)strong")), 8.0).when(F.regexp_like(text, F.lit("(?i)moderate")), 6.0).when(F.regexp_like(text, F.lit("(?i)weak")), 3.0)
    return F.coalesce(number(r"(\d+(?:\.\d+)?)\s*/\s*10\b", 1.0), number(r"~\s*(\d+(?:\.\d+)?)\s*%", 0.1), F.round(F.try_divide(10 * part(1), part(2)), 4), number(r"(\d+(?:\.\d+)?)\s*%", 0.1), words)


def tag_terms(docs: DataFrame, patterns: list[tuple[str, str]]) -> DataFrame:
    """doc_id, tag for each named pattern found in the text; one scan for all patterns."""
    tags = F.array(*[F.when(F.regexp_like("text", F.lit(pattern)), F.lit(name)) for name, pattern in patterns])
    return docs.select("doc_id", F.explode(F.array_compact(tags)).alias("tag"))


def math_density(col: Column, marks: str = "=+*<>^_\\{}") -> Column:
    return (F.length(col) - F.length(F.translate(col, marks, ""))) / F.greatest(F.length(col), F.lit(1))


#: Characters of formulas, a LaTeX command, and words of equations.
MATH_CHARS = "αβγδεζηθικλμνξπρστυφχψωΓΔΘΛΞΠΣΦΨΩ∑∫≈≥≤±→∞"
LATEX_COMMAND = r"\\[A-Za-z]+"
EQUATION_WORDS = r"(?i)\b(?:equation|theorem|lemma|integral|matrix|eigenvalue|derivative)s?\b"


def equation_density(col: Column, pages: Column) -> Column:
    """(math_ratio, latex_per_page, keywords, dense): dense above 0.005 of characters, 5 commands a page or 20 words."""
    text = F.coalesce(col, F.lit(""))
    ratio, latex = math_density(text, MATH_CHARS), F.regexp_count(text, F.lit(LATEX_COMMAND)) / F.greatest(pages, F.lit(1))
    words = F.regexp_count(text, F.lit(EQUATION_WORDS))
    return F.struct(ratio.alias("math_ratio"), latex.alias("latex_per_page"), words.alias("keywords"), ((ratio > 0.005) | (latex > 5) | (words > 20)).alias("dense"))


def composite_score(col: Column, weights: list[tuple[str, float]]) -> Column:
    out = F.lit(0.0)
    for pattern, weight in weights:
        out = out + F.when(F.regexp_like(col, F.lit(pattern)), weight).otherwise(0.0)
    return out


#: Signal kinds and their patterns.
SIGNALS = {
    "doi": r"(?i)\b(10\.\d{4,9}/[\w.\-/:()#]+?)(?=[\s,;\"'\)\]]|$)",
    "url": r"(?i)(https?://[\w\-._~:/?#\[\]@!$&'()*+,;=%]+)",
    "arxiv": r"(?i)(?:arxiv[:/\s]+|arxiv\.org/abs/)\s*(\d{4}\.\d{4,5}|[a-z\-]+/\d{7})",
    "github": r"(?i)github\.com[:/]([\w.\-]+/[\w.\-]+?)(?=[/.\s\"')\]]|$)",
    "gitlab": r"(?i)gitlab\.com/([\w./\-]+?)(?=[/.\s\"')\]]|$)",
    "hf": r"(?i)huggingface\.co/([\w.\-]+/[\w.\-]+?)(?=[/.\s\"')\]]|$)",
    "genbank": r"\b([A-Z]{1,2}\d{5,8}|[A-Z]{4,6}\d{8,10})\b",
    "geo": r"\b(GSE\d{2,7}|GDS\d{2,6}|GSM\d{2,8})\b",
    "sra": r"\b(SR[APRSXZ]\d{4,8}|PRJ[ENPD][A-Z]?\d{4,8})\b",
    "pride": r"\b(PXD\d{6,8})\b",
    "pdb": r"(?i)(?:PDB[:\s]+|pdb\s+id\s+|RCSB\s+)([1-9][A-Z0-9]{3})\b",
    "zenodo": r"(?i)zenodo\.org/(?:record|doi/10\.5281/zenodo\.)/?(\d{5,10})",
    "figshare": r"(?i)figshare\.com/[\w/]*?(\d{6,})",
    "email": f"({EMAIL})",
    "license": r"(CC BY[A-Z0-9 .-]*\d)",
}
#: Kinds that name a stored data set, and kinds that name code or a model that runs.
DEPOSITS = ("genbank", "geo", "sra", "pride", "pdb", "zenodo", "figshare")
RUNNABLE = ("github", "gitlab", "hf")


def extract_signals(docs: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """Distinct (doc_id, kind, value), marks at the end and a ``.git`` ending removed; all kinds in one scan."""
    def of(kind: str, pattern: str) -> Column:
        plain = lambda v: F.regexp_replace(F.regexp_replace(v, r"[.,;:)\"'\]]+$", ""), r"\.git$", "")
        return F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("kind"), plain(v).alias("value")))

    kinds = [of(kind, pattern) for kind, pattern in (patterns or SIGNALS).items()]
    return docs.select("doc_id", F.explode(F.concat(*kinds)).alias("s")).select("doc_id", "s.kind", "s.value").distinct()


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Sequence-match ratio; only for rows that no native test decides."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def ratio_bound(a: Column, b: Column) -> Column:
    """What ``seq_ratio`` can't exceed: twice the characters that both hold, each as often as the rarer side has it, of all characters."""
    times = lambda text, c: F.length(text) - F.length(F.replace(text, c, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(b, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(times(a, c), times(b, c))))
    sizes = F.length(a) + F.length(b)
    return F.when(sizes == 0, 1.0).otherwise(2 * shared / sizes)


def title_scores(df: DataFrame, least: float | None = None) -> DataFrame:
    """title_score of (text, title): containment natively, and the ratio on the remaining rows alone.

    With ``least`` a score that can't reach it, by the lengths or by ``ratio_bound``, is null and isn't computed; all others are as without.
    """
    tidy = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    df = df.withColumn("_t", tidy(F.coalesce("text", F.lit("")))).withColumn("_q", tidy(F.coalesce("title", F.lit(""))))
    quick = F.when((F.col("_q") == "") | (F.col("_t") == ""), 0.0).when(F.contains("_t", F.col("_q")), 1.0).when(F.contains(F.col("_t"), F.substring("_q", 1, 60)), 0.95)
    head = F.substring("_t", 1, 1000)
    out_of_reach = F.lit(False)
    if least is not None:
        sizes = 2 * F.least(F.length(head), F.length("_q")) / (F.length(head) + F.length("_q"))
        out_of_reach = quick.isNull() & F.when(sizes < least, True).otherwise(ratio_bound(head, F.col("_q")) < least)
    df = df.withColumns({"title_score": quick, "_out": out_of_reach})
    open_ = F.col("title_score").isNull() & ~F.col("_out")
    slow = df.where(open_).withColumn("title_score", seq_ratio(head, F.col("_q")))
    return df.where(~open_).unionByName(slow).drop("_t", "_q", "_out")


def fix_emails(df: DataFrame) -> DataFrame:
    """``email`` and each of ``authors`` (name, email) reduced to its primary address; ``extras`` holds the others, ``changed`` the fields that had any."""
    own = split_multi_email(F.col("email"))
    each = F.transform(F.coalesce("authors", F.array().cast("array<struct<name:string,email:string>>")), lambda a: F.struct(a["name"].alias("name"), split_multi_email(a["email"]).alias("s")))
    df = df.withColumn("_own", own).withColumn("_each", each)
    more = F.flatten(F.transform("_each", lambda a: a["s"]["extras"]))
    flags = F.array_compact(F.array(F.when(F.size("_own.extras") > 0, F.lit("email")), F.when(F.size(more) > 0, F.lit("authors"))))
    fixed = F.transform("_each", lambda a: F.struct(a["name"].alias("name"), a["s"]["primary"].alias("email")))
    return df.withColumns({"email": F.col("_own.primary"), "authors": fixed, "extras": F.concat(F.col("_own.extras"), more), "changed": flags}).drop("_own", "_each")


_FIELD = re.compile(r'"([^"\\]+)"[ \t]*:[ \t]*')


def _first_object(text: str) -> dict | None:
    """What the JSON decoder reads from the earliest brace that opens an object with a key."""
    decoder, at = json.JSONDecoder(), text.find("{")
    while at >= 0:
        try:
            found = decoder.raw_decode(text, at)[0]
        except ValueError:
            found = None
        if found:
            return found
        at = text.find("{", at + 1)
    return None


def _whole_fields(text: str) -> dict:
    """The fields of a cut or broken object whose values the decoder can still read."""
    decoder, out = json.JSONDecoder(), {}
    for name in _FIELD.finditer(text):
        try:
            out[name.group(1)] = decoder.raw_decode(text, name.end())[0]
        except ValueError:
            continue
    return out


@F.pandas_udf(T.StringType())
def repair_json(raw: pd.Series) -> pd.Series:
    """A broken answer's object as JSON: the first that decodes, else its fields that do; null if there are none."""
    found = [_first_object(text) or _whole_fields(text) if text else None for text in raw]
    return pd.Series([json.dumps(x) if x else None for x in found], dtype=object)


def parse_answers(df: DataFrame, col: str) -> DataFrame:
    """``answer``, a map of the object in a structured answer, fences aside; ``error`` holds the first 500 characters if there is none.

    What stands between the first and the last brace is read natively; only the rows where that is no object reach ``repair_json``.
    """
    bare = F.regexp_replace(F.coalesce(F.col(col), F.lit("")), "```[a-z]*", "")
    as_map = lambda c: F.from_json(c, "map<string,string>")
    rows = df.withColumn("_bare", bare).withColumn("_native", as_map(F.nullif(F.regexp_extract("_bare", r"(?s)\{.*\}", 0), F.lit(""))))
    whole = F.coalesce(F.size("_native"), F.lit(0)) > 0
    answers = rows.where(whole).withColumn("answer", F.col("_native")).unionByName(rows.where(~whole).withColumn("answer", as_map(repair_json("_bare"))))
    return answers.withColumn("error", F.when(F.col("answer").isNull(), F.substring("_bare", 1, 500))).drop("_bare", "_native")
