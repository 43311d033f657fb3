"""Whole jobs composed of the library's operators; each returns tables and leaves writing them to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ids, outcomes
from shelfmark.functions import text as tx
from shelfmark.operators import joins, merges, reports, windows
from shelfmark.streaming import streams


def consolidate(scan: DataFrame, records: DataFrame, listing: DataFrame, priorities: dict[str, int], files: DataFrame | None = None) -> dict[str, DataFrame]:
    """From scanned files (path, source, size and what the pick needs) to the catalog's tables.

    ``inventory`` (the last row of each path, with its record id, year and where the year is from), ``extra`` (paths beside the kept one of a record and source), ``plan`` (one
    planned canonical path a record), ``records`` (with the attributes of their picks, and stubs) and, where ``files`` (path, record_id, source, size, first_seen) is given,
    ``files`` (after the scan, which has a ``seen``: added, updated or kept).
    """
    inventory = scan.withColumns({"record_id": ids.record_id_from_name(F.col("path")), "path_year": ids.year_from_path(F.col("path"))}).where("record_id is not null")
    inventory = joins.resolve_year(merges.insert_replace(inventory, ["path"], [F.desc("instance_id")]), records)
    picks = windows.pick_canonical(inventory, priorities).withColumn("path_year", ids.year_from_path(F.col("path")))
    out = {
        "inventory": inventory, "extra": windows.extra_paths(inventory), "records": joins.apply_canonical(records, picks),
        "plan": merges.plan_layout(merges.assign_canonical_path(picks, records), listing),
    }
    if files is not None:
        new = inventory.select("path", "record_id", "source", "size", F.col("seen").alias("last_verified"), F.col("seen").alias("first_seen"))
        old = files.select("path", "record_id", "source", "size", F.col("first_seen").alias("last_verified"), "first_seen")
        out["files"] = merges.upsert(old, new, "path", [], ["record_id", "source", "size", "last_verified"], ["first_seen"])
    return out


def refresh(records: DataFrame, batch: DataFrame, excluded: Column, run_tag: str, org_rules: list[tuple[str, str]] | None = None, top: int = 12) -> dict[str, DataFrame]:
    """``records`` after the batch, ``decisions`` on excluded ones, ``run`` (the counts of a run row) and ``orgs`` (the ``top`` organisations left).

    The last row of a record in the batch wins; its null title or year leaves the old one. With ``org_rules`` the batch holds
    an array ``orgs``, of which they make the code; else it has an ``org_code``.
    """
    code = F.col("org_code") if org_rules is None else ids.org_code(F.col("orgs"), org_rules)
    last = merges.insert_replace(batch, ["record_id"], [F.desc("seen"), F.desc("batch_row")])
    new = last.select("record_id", "title", ids.pub_year(F.col("publication_date"), "robust").alias("year"), code.alias("org_code"), F.lit(None).cast("string").alias("product_type"))
    merged = merges.upsert(records, new, "record_id", ["title", "year"], ["org_code"], ["product_type"])
    left, decisions = merges.exclude_records(merged, excluded, run_tag)
    return {"records": left, "decisions": decisions, "run": merges.merge_counts(merged, "refresh", {"run_tag": run_tag}), "orgs": reports.top_counts(left, "org_code", top)}


def recovery(
    records: DataFrame, attempts: DataFrame, files: DataFrame, rules: list[tuple[str, Column]], lookups: DataFrame | None = None, templates: DataFrame | None = None, data_prefixes: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Planning and accounting of the records without a file.

    ``queue`` (their state), ``plan`` (record_id, pos, source for pending ones, by the rules in order), ``first`` (the winning source and
    the attempts before it), ``sources`` (records first won by each), ``lost`` (the last failures), ``gap`` (look-up against download) and ``scope`` (pending
    records by whether they are papers and have a DOI of data). Only pending papers whose DOI is not of data are planned where ``lookups`` (record_id, best_pdf,
    others, best_url, links) is given; ``urls`` (record_id, rank, kind, url) then holds where to try them: the open-access place, the registry's best link and those of the DOI's ``templates`` (prefix, template).
    """
    names, held = tuple(name for name, _ in rules), files.where("size > 0")
    bucketed = attempts.withColumn("bucket", outcomes.bucket_attempt(F.col("http_status"), F.col("bytes"), F.col("saved_path")))
    tried = bucketed.join(records.select("record_id"), "record_id", "left_semi")
    queue = streams.queue_from_attempts(joins.todo(tried, held), names)
    # the queue's pending rows, without sorting every attempt for each use
    pending = joins.todo(records.join(streams.pending_records(bucketed, names), "record_id", "left_semi"), held)
    paper, data = ids.is_paper(F.col("record_id"), F.col("product_type")), ids.is_data_doi(F.col("doi"), list(data_prefixes)) if data_prefixes else F.lit(False)
    scope = pending.groupBy(paper.alias("paper"), data.alias("data_doi")).agg(F.count("*").alias("n"))
    wanted = pending if lookups is None else pending.where(paper & ~data)
    first = windows.first_success(tried.withColumn("ok", F.col("bucket") == "other"))
    out = {
        "queue": queue, "plan": joins.source_plan(wanted, rules), "first": first, "sources": reports.source_yield(first),
        "lost": reports.final_status(tried), "gap": reports.yield_gap(tried), "gap_buckets": reports.yield_gap_buckets(tried), "scope": scope,
    }
    if lookups is not None:
        out["urls"] = _recovery_urls(wanted, lookups, templates)
    return out


def _recovery_urls(wanted: DataFrame, lookups: DataFrame, templates: DataFrame | None) -> DataFrame:
    held = lookups.join(wanted.select("record_id"), "record_id", "left_semi")
    place = lambda rank, kind, url: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), url.alias("url"))
    found = F.array(place(0, "open_access", outcomes.pick_oa_url(F.col("best_pdf"), F.col("others"), F.col("best_url"))), place(1, "registry", outcomes.pick_link(F.col("links"))))
    urls = held.select("record_id", F.inline(found)).where("url is not null")
    if templates is not None:
        urls = urls.unionByName(joins.doi_urls_by_table(wanted, templates).select("record_id", F.lit(2).alias("rank"), F.lit("template").alias("kind"), "url"))
    return urls


def findability(docs: DataFrame, registry: DataFrame, kind: str = "data") -> dict[str, DataFrame]:
    """From texts to verdicts: signals, their clean-up candidates, what the registry (kind, value, status, resource_type) resolves, and the reports.

    ``validated``, ``verdicts``, ``report``, ``rates`` and ``types``.
    """
    signals = tx.extract_signals(docs)
    signals = signals.where((F.col("kind") != "doi") | ~tx.is_placeholder(F.col("value"), data_card=kind == "data"))
    forms = F.when(F.col("kind") == "doi", ids.doi_candidates(F.col("value"))).otherwise(F.array("value"))
    candidates = signals.select("doc_id", "kind", "value", F.posexplode_outer(forms).alias("pos", "candidate"))
    validated = joins.validate_signals(candidates, registry).withColumn("ok", F.col("resolved").isNotNull())
    verdicts = (reports.findability_data if kind == "data" else reports.findability_code)(docs, validated)
    return {"validated": validated, "verdicts": verdicts, "report": reports.findability_report(verdicts), "rates": reports.signal_rates(validated), "types": reports.strong_types(validated)}


def contacts(docs: DataFrame, own_domains: list[str], head: int | None = None, spelled: bool = True) -> DataFrame:
    """email, papers, orgs and verdict of every address in the documents (doc_id, text, org_code), ``spelled`` ones too; reachability isn't looked up."""
    found = docs.select(F.col("doc_id").alias("record_id"), "org_code", F.explode(tx.extract_emails(F.col("text"), head, spelled)).alias("email"))
    k = tx.email_checks(F.col("email"), F.lit(None).cast("string"), own_domains)
    people = reports.author_rollup(found).withColumn("k", k)
    return people.select("email", "papers", "orgs", tx.email_verdict(F.col("k.syntax"), F.col("k.multiple"), F.col("k.obfuscated"), F.lit(True), F.lit(True)).alias("verdict"))


def contact_bindings(docs: DataFrame, authors: DataFrame, pages: DataFrame, generic: list[str], spelled: bool = True) -> DataFrame:
    """record_id, email, author, affil, named and confidence of every address in the documents (record_id, text), ``spelled`` ones too.

    ``authors`` (record_id, source, raw) holds author entries of several sources with affiliations and identifiers in brackets; ``pages`` (record_id, html) confirm an address that they show.
    """
    found = docs.select("record_id", F.explode(tx.extract_emails(F.col("text"), None, spelled)).alias("raw_email"))
    one = tx.split_multi_email(F.col("raw_email"))
    found = found.select("record_id", one["primary"].alias("email")).distinct()
    people = authors.withColumn("p", tx.parse_author(F.col("raw"))).select("record_id", "source", F.col("p.name").alias("name"), F.array_join("p.affiliations", "; ").alias("affiliation"))
    hint = F.regexp_replace(F.substring_index("email", "@", 1), "[^A-Za-z]+", " ")
    tri = joins.triangulate(found.withColumn("name_hint", hint), people, generic)
    hits = found.join(pages, "record_id").where(tx.page_has_email(F.col("html"), F.col("email"))).select("record_id", "email")
    first = people.groupBy("record_id").agg(F.min("name").alias("author"))
    return reports.email_confidence(tri, hits).join(first, "record_id", "left")


def daily_snapshot(records: DataFrame, files: DataFrame, attempts: DataFrame, k: float = 5) -> dict[str, DataFrame]:
    """The tables of a day's state: totals, types with and without a DOI, organisations, years, coverage, inflated cells, queue and the share of records with a file row."""
    return {
        "totals": reports.snapshot(records, files), "types": reports.top_counts(records, "product_type", 12),
        "types_no_doi": reports.top_counts(records.where(ids.no_doi(F.col("doi"))), "product_type", 12), "orgs": reports.top_counts(records, "org_code", 15),
        "years": reports.distinct_by_year(files.withColumn("year", F.col("path_year"))), "coverage": reports.coverage_matrix(records), "inflated": reports.inflated_cells(records, k),
        "queue": reports.queue_status(streams.queue_from_attempts(attempts)), "held": windows.intersection_rate(records, files, "record_id"),
    }


def selection(pool: DataFrame, scores: DataFrame, findability: DataFrame, excludes: DataFrame, n: int) -> DataFrame:
    """The n best candidates of ``pool`` (doc_id, stratum, score): judges' consensus and findability give tiers, and strata take turns."""
    verdicts = reports.consensus(scores).select(F.col("item_id").alias("doc_id"), "verdict")
    tiers = joins.crosswalk(verdicts, findability).where("tier is not null").select("doc_id", "tier")
    candidates = pool.join(tiers, "doc_id").select(F.col("doc_id").alias("record_id"), "tier", "stratum", "score")
    return windows.select_tiered(candidates, excludes, n)


def judge(answers: DataFrame, labels: list[str]) -> DataFrame:
    """item_id, judge, verdict, score and error of raw answers (item_id, judge, raw): of a JSON object, cut or whole, its ``verdict`` and ``score``; else of a text with verdict lines, the last.

    A verdict that isn't among ``labels`` is UNCLEAR, a score that isn't a number null.
    """
    parsed = tx.parse_answers(answers, "raw")
    said = F.upper(F.trim(F.col("answer")["verdict"]))
    verdict = F.when(F.col("error").isNotNull(), tx.parse_verdict(F.col("raw"), labels)).when(said.isin(*labels), said).otherwise("UNCLEAR")
    return parsed.select("item_id", "judge", verdict.alias("verdict"), F.col("answer")["score"].try_cast("double").alias("score"), "error")


def judged_selection(pool: DataFrame, answers: DataFrame, findability: DataFrame, excludes: DataFrame, n: int, labels: list[str], baseline: str) -> dict[str, DataFrame]:
    """From raw answers to a selection: ``verdicts`` (``judge``), each judge's ``agreement`` with the baseline, and ``selected``.

    Answers that are UNCLEAR don't vote; an item that no judge decided isn't selected.
    """
    verdicts = judge(answers, labels)
    return {"verdicts": verdicts, "agreement": reports.judge_agreement(verdicts, baseline), "selected": selection(pool, verdicts.where("verdict <> 'UNCLEAR'"), findability, excludes, n)}


def augment(docs: DataFrame, links: DataFrame, people: DataFrame, start: str = "<!-- contacts -->", end: str = "<!-- end contacts -->") -> DataFrame:
    """record_id, text, status: each document with a marked block that names its contacts; ``no_contact`` leaves the text alone."""
    names = joins.contacts_for(links, people)
    block = F.concat(F.lit("Contacts: "), F.array_join("names", ", "))
    j = docs.join(names, "record_id", "left").withColumn("u", tx.upsert_block(F.coalesce("text", F.lit("")), block, start, end))
    none = F.coalesce(F.size("names"), F.lit(0)) <= 0
    return j.select("record_id", F.when(none, F.col("text")).otherwise(F.col("u.text")).alias("text"), F.when(none, "no_contact").otherwise(F.col("u.status")).alias("status"))
