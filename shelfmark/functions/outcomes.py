"""Outcome classes of attempts, answers, payloads and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STUB_SIZES = (3038, 1817, 2711, 4231)
#: How many more attempts the buckets of attempts, responses and errors are worth; any other HTTP 5xx is worth one, all else none.
RETRY = {"reset": 3, "timeout": 3, "timeout_or_exception": 3, "unavailable": 1, "tls": 1, "dnserr": 1}
#: Sources to try for each mode of absence, in order.
ABSENCE_PLAN = {
    "never_deposited": ("open_access", "preprint_by_doi", "citation_index"),
    "sso_walled": ("preprint_by_doi", "open_access"),
    "publisher_403": ("open_access", "preprint_by_doi"),
    "unknown": ("repository", "open_access", "preprint_by_doi", "citation_index"),
}


def bucket_attempt(status: Column, size: Column, saved: Column) -> Column:
    return (
        F.when(status == 404, "not_found").when(status == 403, "forbidden").when(status == 503, "unavailable")
        .when((status == 200) & (size <= 1024), "empty").when((status == 200) & saved.isNull(), "wrong_type_or_redirect")
        .when(status == 0, "timeout_or_exception").otherwise("other")
    )


def bucket_status(col: Column) -> Column:
    return (
        F.when(col == "ok", "ok").when(col.like("too_small_%"), "too_small").when(col.like("http_4%"), "http_4xx")
        .when(col.like("%html%"), "html").when(col == "skip_no_url", "skip_no_url").otherwise(F.concat(F.lit("other:"), F.coalesce(col, F.lit(""))))
    )


def bucket_response(status: Column, content_type: Column, magic: Column, size: Column, redirected: Column, error: Column | None = None) -> Column:
    """A document by its first bytes or its declared type; without an answer, ``error`` tells a timeout from the rest."""
    late = F.lit(False) if error is None else F.coalesce(F.regexp_like(F.lower(error), F.lit("timeout|timed out")), F.lit(False))
    document = F.coalesce(magic == "25504446", F.lit(False)) | F.coalesce(F.contains(F.lower(content_type), F.lit("pdf")), F.lit(False))
    return (
        F.when(F.coalesce(status, F.lit(0)) == 0, F.when(late, "timeout").otherwise("exception")).when(status != 200, F.concat(F.lit("http_"), status.cast("string")))
        .when(~document, F.when(redirected, "redirect_off").otherwise("wrong_type")).when(F.coalesce(size, F.lit(0)) <= 1024, "empty").otherwise("recovered_pdf")
    )


def classify_error(name: Column, message: Column) -> Column:
    text = F.lower(F.concat_ws(" ", name, message))
    has = lambda *words: F.regexp_like(text, F.lit("|".join(words)))
    return (
        F.when(has("timeout", "timed out"), "timeout").when(has("reset"), "reset").when(has("certificate", "ssl"), "ssl_error")
        .when(has("tls", "handshake"), "tls").when(has("name or service", "getaddrinfo", "nodename"), "dnserr").otherwise("urlerr")
    )


def classify_payload(size: Column, magic: Column, text_chars: Column, least: int = 4096, cap: int = 100_000_000, stubs: tuple[int, ...] = STUB_SIZES) -> Column:
    return (
        F.when(size.isin(*stubs), "stub").when(F.coalesce(size, F.lit(0)) < least, "too_small").when(size > cap, "oversize")
        .when(magic != "25504446", "wrong_magic").when(F.coalesce(text_chars, F.lit(0)) == 0, "no_text").otherwise("valid")
    )


def classify_integrity(size: Column, pages: Column, chars: Column) -> Column:
    return (
        F.when(F.coalesce(size, F.lit(0)) == 0, "zero").when(F.coalesce(pages, F.lit(0)) == 0, "truncated")
        .when(chars < pages * 100, "image").otherwise("good")
    )


def retryable(bucket: Column) -> Column:
    """How many more attempts a bucket is worth."""
    out = F.when(F.regexp_like(bucket, F.lit(r"^http_5\d\d$")), 1).otherwise(0)
    for name, times in RETRY.items():
        out = F.when(bucket == name, times).otherwise(out)
    return out


def absence_mode(has_link: Column, status: Column, body_size: Column, walled: Column) -> Column:
    return F.when(~has_link, "never_deposited").when(walled, "sso_walled").when((status == 403) & (body_size < 1024), "publisher_403").otherwise("unknown")


def absence_sources(mode: Column, plan: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The sources to try for a mode, in order."""
    out = F.array().cast("array<string>")
    for name, sources in (plan or ABSENCE_PLAN).items():
        out = F.when(mode == name, F.array(*map(F.lit, sources))).otherwise(out)
    return out


def registry_type(lookup_status: Column, value: Column) -> Column:
    return F.when(lookup_status == 200, value).when(lookup_status == 404, "not_in_crossref").otherwise(F.concat(F.lit("error_"), lookup_status.cast("string")))


def recheck_status(lookup_status: Column, relations: Column) -> Column:
    """Whether a record that was looked up again (200 with the relations of its links) offers a full text."""
    found = F.when(F.coalesce(F.array_contains(relations, "fulltext"), F.lit(False)), "has_pdf").otherwise("no_pdf")
    return F.when(lookup_status == 200, found).when(lookup_status == 404, "not_found").otherwise(F.concat(F.lit("error_"), lookup_status.cast("string")))


def oa_status(lookup_status: Column, value: Column) -> Column:
    return F.when(lookup_status == 200, value).when(lookup_status == 404, "not_in_unpaywall").otherwise(F.concat(F.lit("error_"), lookup_status.cast("string")))


def pick_link(links: Column) -> Column:
    """The best of an array of (url, content_type, intended): highest score, then the last URL."""
    score = lambda x: (
        F.when(F.contains(x["content_type"], F.lit("pdf")), 10).otherwise(0)
        + F.when(x["intended"] == "text-mining", 5).when(x["intended"] == "similarity-checking", 3).otherwise(0)
    )
    scored = F.transform(links, lambda x: F.struct(score(x).alias("score"), x["url"].alias("url")))
    return F.array_max(F.filter(scored, lambda x: x["score"] > 0))["url"]


def pick_oa_url(best_pdf: Column, others: Column, best_url: Column) -> Column:
    return F.coalesce(best_pdf, F.get(F.filter(others, lambda x: x.isNotNull()), F.lit(0)), best_url)


def rank_oa_locations(locations: Column) -> Column:
    """URLs of an array of (url_for_pdf, host_type): repositories first, given order within each, repeats dropped."""
    real = F.filter(locations, lambda x: x["url_for_pdf"].isNotNull())
    repository = lambda x: F.coalesce(x["host_type"] == "repository", F.lit(False))
    ordered = F.concat(F.filter(real, repository), F.filter(real, lambda x: ~repository(x)))
    return F.array_distinct(F.transform(ordered, lambda x: x["url_for_pdf"]))
