"""Ordered, auditable rule engine for who speaks in a document; every rule is a native expression.

A rule is a condition and a struct of labels; the first that holds wins, so the
whole engine is one COALESCE and Catalyst evaluates it inside the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions import urls

# The vocabularies of the rules and the labels they give.
STRONG_DOCTYPE = (
    r"(feedback-statement|statement-on-cp|note-from-the-(?:central-bank|financial-regulator)|a-note-from-the-central-bank"
    r"|consumer-protection-code(?:-for-licensed-moneylenders)?-public-response|^cp-?\d+[a-z]?(?:\.pdf)?$|^dp-?\d+[a-z]?(?:\.pdf)?$)"
)
DOCTYPE = (
    r"(consultation-paper|discussion-paper|cp-?\d+[a-z]?-+consultation|consultation-on-|summary-of-(?:submissions|responses|comments)"
    r"|regulatory-impact|impact-analysis|impact-assessment|^gn-?\d|guidance-note|code-of-(?:practice|conduct)|-requirements(?:-|\.|$)|addendum|rulebook"
    r"|-regulations(?:-|\.|$)|cross-industry-guidance|guidance-on-|-guidelines(?:-|\.|$)|administrative-sanctions|consumer-protection-code"
    r"|macroprudential-framework|macro-prudential-policy|frequently-asked-questions|minimum-competency)"
)
ATTRIBUTED = (
    r"((?:submission|response|reponse|repsonse|replies|feedback|comments?|cover-letter|cover-e-?mail|letter)[-_ ]*(?:from|by)[-_ ]"
    r"|(?:submission|response|reponse|repsonse)[-_ ]*to[-_ ]|[-_](?:submission|response|reponse|repsonse|replies|comments)(?:[-_.(]|$)"
    r"|^(?:response|submission)[-_]|-to-cp-?\d)"
)
CP_PREFIXED = r"^(?:cp|dp)-?\d+[a-z]?[-_ ]+\S"
CONSULTATION_PATHS = ("/consultation-papers/", "/discussion-papers/")
CONSULTATION_OVERRIDES = {"/consultation-papers/cp71/": "cp70"}
ISSUER_MARKERS = {
    "consultation paper cp": 1, "discussion paper dp": 1, "feedback statement": 3, "feedback response": 4, "submissions were received in response": 4,
    "would like to thank all parties": 4, "key decisions and next steps": 4, "closing date for submissions": 3, "the central bank invites": 3,
    "we invite comments": 2, "responses to this consultation": 2, "this consultation paper": 3, "this discussion paper": 3,
    "central bank of ireland\nbosca": 2, "t: +353 (0)1 224": 2, "comments should be addressed to": 3, "© central bank of ireland": 3,
    "this paper is for consultation": 3, "submissions should be sent": 3,
}
RESPONDENT_MARKERS = {
    "we welcome the opportunity": 3, "welcomes the opportunity to respond": 3, "thank you for the opportunity": 3, "dear sir": 2, "dear madam": 2,
    "yours sincerely": 2, "yours faithfully": 2, "on behalf of our members": 3, "our response to": 2, "this submission": 3, "our submission": 3,
    "re: cp": 2, "response to cp": 3, "response to consultation paper": 3, "submission to the central bank": 3,
    "we would like to thank the central bank": 3, "in response to the central bank": 3, "appreciate the opportunity": 2,
    "appreciates the opportunity": 3, "welcomes the opportunity to comment": 3, "welcomes the opportunity to provide": 3,
    "response to the consultation": 3, "submission to the financial regulator": 3, "mabs submission": 3, "the following comments": 3,
    "i attended the session": 3, "i am a member": 2,
}
TITLE_MARKERS = ("central bank of ireland", "financial regulator", "central bank commission")
TOPICS = (
    ("cbi-research", ("/research-technical-papers/", "/economic-letters/", "/financial-stability-notes/", "/consumer-protection-research/")),
    ("cbi-policy-analysis", ("/financial-stability-review/", "/quarterly-bulletins/", "/macro-financial-review/", "/regulatory-and-supervisory-outlook-reports/", "/household-credit-market-report/", "/sme-market-reports/", "/systemic-risk-pack/", "/financial-crime-bulletin/", "/irish-retail-payments-forum/")),
    ("cbi-corporate-report", ("/corporate-reports/", "/annual-reports")),
    ("cbi-regulatory-material", ("/regulation/",)),
    ("cbi-statistical-material", ("/statistics/",)),
    ("cbi-correspondence", ("/correspondence/",)),
    ("cbi-speech-or-news-material", ("/news-and-media/", "/media-release/")),
    ("cbi-consumer-material", ("/consumer-hub",)),
)
VOICES = {
    "central-bank": "cbi-institutional", "stakeholder": "stakeholder", "external-authority": "external-authority", "judicial-tribunal": "judicial-tribunal",
    "third-party": "third-party", "mixed": "mixed", "unresolved": "unknown",
}
ROLES = {
    "cbi-consultation-feedback": "feedback-statement", "cbi-consultation-material": "consultation-or-discussion-material",
    "cbi-discussion-material": "consultation-or-discussion-material", "external-authority-report": "external-assessment",
    "judicial-or-tribunal-material": "judicial-or-tribunal-record", "cbi-research": "research-paper", "cbi-speech-or-news-material": "speech-or-news",
    "cbi-policy-analysis": "policy-analysis", "cbi-regulatory-material": "regulatory-material", "cbi-statistical-material": "statistical-material",
    "cbi-correspondence": "correspondence", "cbi-corporate-report": "corporate-report", "cbi-consumer-material": "consumer-information",
}


def score(text: Column, markers: dict[str, int]) -> Column:
    """Struct of the points (each phrase once) and the phrases found, in marker order."""
    low = F.lower(text)
    hits = F.array_compact(F.array(*[F.when(low.contains(p), F.struct(F.lit(w).alias("w"), F.lit(p).alias("p"))) for p, w in markers.items()]))
    return F.struct(F.aggregate(hits, F.lit(0), lambda acc, h: acc + h["w"]).alias("points"), F.transform(hits, lambda h: h["p"]).alias("phrases"))


def contains_any(value: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | value.contains(p)
    return out


def topical_class(path: Column) -> Column:
    out = F.when(F.lit(False), "")
    for name, parts in TOPICS:
        out = out.when(contains_any(path, parts), name)
    return out.otherwise("other-cbi-material")


def consultation_id(path: Column) -> Column:
    """Canonical id such as cp71; misnumbered folders first."""
    found = F.regexp_extract(path, r"/cp[-_ ]?0*(\d+)([a-z]?)/", 0)
    number = F.regexp_extract(path, r"/cp[-_ ]?0*(\d+)([a-z]?)/", 1)
    out = F.when(F.lit(False), "")
    for folder, ident in CONSULTATION_OVERRIDES.items():
        out = out.when(path.contains(folder), ident)
    return out.when(found != "", F.concat(F.lit("cp"), number, F.regexp_extract(path, r"/cp[-_ ]?0*(\d+)([a-z]?)/", 2)))


def engagement_id(path: Column, consultation: Column) -> Column:
    pattern = r"/(?:dp[-_ ]?0*(\d+)[a-z]?|dis(?:cus|ucs)sion-paper[-_ ]?0*(\d+))/"
    one, two = F.regexp_extract(path, pattern, 1), F.regexp_extract(path, pattern, 2)
    number = F.when(one != "", one).when(two != "", two)
    return F.coalesce(consultation, F.concat(F.lit("dp"), number.cast("int").cast("string")))


def voice_for(authorship: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in VOICES.items() for x in kv])[authorship]


# Containers and submissions that were opened and audited page by page.
MIXED_DOCUMENTS = {
    "/publications/corporate-reports/strategic-plan/submissions/strategic-plan2019-2021-public-engagement-submissions.pdf": (
        "cbi-corporate-report",
        "audited-composite:cbi-framing-pages-1-5;stakeholder-submissions-pages-6-114",
    ),
}
AUDITED_STAKEHOLDERS = {
    "/sector-stakeholder-dialogues/lending-framework-review-2024-joint-submission-from-cuda-cuma-ilcu-and-nsf.pdf": "joint-credit-union-sector-submission",
    "/sector-stakeholder-dialogues/lending-framework-review-2024-submission-from-collaborative-finance-clg.pdf": "collaborative-finance-submission",
}
ISSUER = "Central Bank of Ireland"
HOST_EVIDENCE = "centralbank.ie host path is not authorship evidence"


def classify(df: DataFrame, url: str, text: str, mixed: dict[str, tuple[str, str]] = MIXED_DOCUMENTS, audited: dict[str, str] = AUDITED_STAKEHOLDERS) -> DataFrame:
    """Adds authorship, document_class, basis, confidence, consultation_id, engagement_id and the derived fields.

    ``mixed`` maps path parts to (class, basis) and ``audited`` path parts to
    evidence: the reviewed exceptions, which come before every rule.  Phrases are
    looked up once a row, and only where the path and file name leave the question
    open; every step is a projection of its own, so nothing is evaluated twice.
    """
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    bare = lambda c: F.regexp_replace(c, "^-+|-+$", "")
    body = F.coalesce(F.col(text), F.lit(""))
    work = df.withColumn("_path", F.lower(urls.unquote(urls.path(F.col(url)))))
    path = F.col("_path")
    work = work.withColumn("_name", F.substring_index(path, "/", -1)).withColumn("_hosted", contains_any(path, CONSULTATION_PATHS))
    name, discussion = F.col("_name"), path.contains("/discussion-papers/")
    for column, pattern in (("_strong", STRONG_DOCTYPE), ("_cue", DOCTYPE), ("_attributed", ATTRIBUTED)):
        work = work.withColumn(column, F.when(F.col("_hosted"), F.regexp_extract(name, pattern, 1)).otherwise(""))
    strong, cue, attributed = F.col("_strong"), F.col("_cue"), F.col("_attributed")
    prefix = F.regexp_replace(F.when(cue != "", F.left(name, F.position(cue, name) - 1)), r"^[-_ .]+|[-_ .]+$", "")
    responder = discussion & (cue != "") & name.rlike("-{2,}discussion-paper") & (prefix != "") & ~prefix.rlike(r"^(?:dp|discussion-paper)[-_ ]?\d*[a-z]?$")
    work = work.withColumn("_responder", F.when(F.col("_hosted") & F.coalesce(responder, F.lit(False)), F.left(prefix, F.lit(80))))
    settled = ~F.col("_hosted") | (strong != "") | (attributed != "") | F.col("_responder").isNotNull() | ((cue == "") & name.rlike(CP_PREFIXED))
    work = work.withColumn("_low", F.when(~settled, F.lower(body)))
    for column, markers in (("_issuer", ISSUER_MARKERS), ("_other", RESPONDENT_MARKERS)):
        hits = F.array_compact(F.array(*[F.when(F.col("_low").contains(p), F.struct(F.lit(w).alias("w"), F.lit(p).alias("p"))) for p, w in markers.items()]))
        work = work.withColumn(f"{column}_hits", F.when(F.col("_low").isNotNull(), hits))
    points = lambda c: F.aggregate(c, F.lit(0), lambda acc, h: acc + h["w"])
    work = work.withColumn("_issuer_points", points(F.col("_issuer_hits"))).withColumn("_other_points", points(F.col("_other_hits")))
    work = work.withColumn("_has_text", F.col("_low").rlike(r"\S"))
    issuer, other, has_text = F.col("_issuer_points"), F.col("_other_points"), F.col("_has_text")
    in_title = contains_any(F.left("_low", F.lit(300)), TITLE_MARKERS) & (other == 0)
    work = work.withColumn("_in_title", in_title)
    boosted = issuer + F.when(F.col("_in_title"), 2).otherwise(0)
    phrases = lambda c: F.transform(c, lambda h: h["p"])
    boosted_hits = F.concat(phrases(F.col("_issuer_hits")), F.when(F.col("_in_title"), F.array(F.lit("cbi-name-in-title-block"))).otherwise(F.array().cast("array<string>")))
    first3 = lambda c: F.array_join(F.slice(c, 1, 3), ";")
    versus = lambda a, b: F.concat(F.lit("("), a.cast("string"), F.lit("v"), b.cast("string"), F.lit(")"))
    submission = F.when(discussion, "stakeholder-discussion-submission").otherwise("stakeholder-consultation-submission")
    material = F.when(discussion, "cbi-discussion-material").otherwise("cbi-consultation-material")

    def rule(condition: Column, authorship: str, document_class, basis, confidence: str) -> Column:
        return F.when(condition, F.struct(F.lit(authorship).alias("authorship"), as_col(document_class).alias("document_class"), as_col(basis).alias("basis"), F.lit(confidence).alias("confidence")))

    rules = [
        *[rule(path.contains(p), "mixed", c, b, "high") for p, (c, b) in mixed.items()],
        *[rule(path.contains(p), "stakeholder", "stakeholder-consultation-submission", f"audited-non-consultation-stakeholder:{e}", "high") for p, e in audited.items()],
        rule(~F.col("_hosted"), "unresolved", topical_class(path), "host-path-only:non-consultation", "low"),
        rule(strong != "", "central-bank", F.when(contains_any(name, ("feedback-statement", "statement-on-cp")), "cbi-consultation-feedback").otherwise(material), F.concat(F.lit("filename-strong-cbi-doctype:"), bare(strong)), "high"),
        rule(attributed != "", "stakeholder", submission, F.concat(F.lit("filename-attribution:"), bare(attributed)), "high"),
        rule(F.col("_responder").isNotNull(), "stakeholder", "stakeholder-discussion-submission", F.concat(F.lit("filename-discussion-responder-prefix:"), "_responder"), "high"),
        rule((cue != "") & has_text & (other >= F.greatest(issuer + 3, F.lit(4))), "stakeholder", submission, F.concat(F.lit("content-overrides-generic-doctype"), versus(other, issuer), F.lit(":"), first3(phrases(F.col("_other_hits")))), "medium"),
        rule(cue != "", "central-bank", material, F.concat(F.lit("filename-cbi-doctype:"), bare(cue)), "high"),
        rule(name.rlike(CP_PREFIXED), "central-bank", material, "filename-cp-prefix-without-attribution", "medium"),
        rule(has_text & (other >= boosted + 3), "stakeholder", submission, F.concat(F.lit("content-stakeholder"), versus(other, boosted), F.lit(":"), first3(phrases(F.col("_other_hits")))), "medium"),
        rule(has_text & (boosted >= other + 3), "central-bank", material, F.concat(F.lit("content-cbi"), versus(boosted, other), F.lit(":"), first3(boosted_hits)), "medium"),
        rule(has_text, "unresolved", "consultation-hosted-unresolved", F.concat(F.lit("content-inconclusive"), versus(boosted, other)), "low"),
        rule(F.lit(True), "unresolved", "consultation-hosted-unresolved", "no-filename-cue-and-no-text", "low"),
    ]
    # One value from here on: the chain is not evaluated again for each field.
    chosen = work.withColumn("_label", F.explode(F.array(F.coalesce(*rules))))
    out = chosen.select(*df.columns, "_path", "_label.*").withColumn("consultation_id", consultation_id(F.col("_path")))
    out = out.withColumn("engagement_id", engagement_id(F.col("_path"), F.col("consultation_id"))).drop("_path")
    if audited:
        out = out.withColumn("consultation_id", F.when(~F.col("basis").startswith("audited-non-consultation"), F.col("consultation_id")))
    host_only = F.col("basis") == "host-path-only:non-consultation"
    out = out.withColumn("legacy_authorship", F.when(host_only, "central-bank").otherwise(F.col("authorship")))
    out = out.withColumn("institutional_voice", voice_for(F.col("authorship")))
    out = out.withColumn("author_org", F.when(F.col("institutional_voice") == "cbi-institutional", ISSUER))
    role = F.when(F.col("document_class").startswith("stakeholder-"), "consultation-submission").otherwise(F.coalesce(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])[F.col("document_class")], F.lit("other")))
    status = F.when(F.col("basis").rlike("^(adjudicated:|audited-|manual-)"), "manual-reviewed").when(F.col("institutional_voice") == "unknown", "unreviewed").otherwise("rule-classified")
    return out.withColumn("document_role", role).withColumn("review_status", status).withColumn("review_evidence", F.when(host_only, HOST_EVIDENCE).otherwise(F.col("basis")))


def apply_overrides(labelled: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A reviewed row replaces the given fields; identifiers and legacy labels stay."""
    named = overrides.select(key, *[F.col(c).alias(f"_o_{c}") for c in fields], F.lit(True).alias("_reviewed"))
    out = labelled.join(named, key, "left")
    for c in fields:
        out = out.withColumn(c, F.coalesce(f"_o_{c}", c))
    return out.drop("_reviewed", *[f"_o_{c}" for c in fields])


def risk_reasons(contained: Column, uncertain: Column, sensitive: Column) -> Column:
    """Names of the reasons for a manual look; none means out of scope."""
    return F.array_compact(F.array(F.when(contained, "mixed-container"), F.when(uncertain, "low-confidence"), F.when(sensitive, "sensitive-title")))


# Ordered classes of workbooks by parts of the URL or of the file name, each with its reason.
WORKBOOKS = (
    ("url", ("chartpack", "/publications/quarterly-bulletins/", "/research-exchange/staff-insights/", "/financial-conditions-of-credit-unions/"), "research_supporting_data", "Research/publication supporting data or chartpack"),
    ("url", ("reporting-template", "reporting_template", "return-template"), "regulatory_reporting_template", "URL identifies a reporting/return template"),
    ("url", ("/reporting-requirements/", "/statistical-reporting-requirements/"), "regulatory_reporting_template", "Located under reporting requirements"),
    ("name", ("application", "questionnaire", "sign-off", "submission-form"), "application_or_form", "Filename identifies an application/form/questionnaire"),
    ("url", ("/forms",), "application_or_form", "Located in forms or filename identifies a form"),
    ("name", ("-form.", "_form."), "application_or_form", "Located in forms or filename identifies a form"),
    ("url", ("beneficial-ownership-form", "self-reporting", "insider-list"), "application_or_form", "URL identifies a form or submission list"),
    ("url", ("taxonomy", "validation", "business-rules", "known-issues", "dpm_dictionary", "dpm-dictionary", "schema_excel", "data-quality-checks"), "regulatory_taxonomy_or_validation", "URL identifies taxonomy, validation or business-rule metadata"),
    ("url", ("outsourcing-register", "/resolution/bifr/", "daofi-mcr"), "regulatory_reporting_template", "URL identifies a regulatory register or return"),
    ("url", ("covered-bond-programmes", "asset-covered-securities", "net-short-positions", "/regulation/psd2/article-"), "official_list_or_disclosure", "URL identifies a published regulatory list/disclosure"),
    ("url", ("/statistics/data-and-analysis/", "/statistics/interest-rates-exchange-rates/", "/statistics/statistical-publications/", "/statistics/frontier-statistics/", "/financial-system/access-to-cash/", "public-data", "publishing-dashboard", "levels-of-compliance", "securities-lending-isins"), "published_data", "Located in a published-data area"),
    ("name", ("template", "return", "schedule"), "regulatory_reporting_template", "Filename identifies a template/return/schedule"),
)
OTHER_WORKBOOK = ("other_workbook", "No deterministic URL classification matched")


def workbook_class(url: Column) -> Column:
    """Struct of a workbook's class and the reason for it; the first that holds."""
    whole = F.lower(url)
    parts = {"url": whole, "name": F.substring_index(F.substring_index(whole, "/", -1), "?", 1)}
    both = lambda label, reason: F.struct(F.lit(label).alias("category"), F.lit(reason).alias("reason"))
    out = F.when(F.lit(False), both("", ""))
    for where, words, label, reason in WORKBOOKS:
        out = out.when(contains_any(parts[where], words), both(label, reason))
    return out.otherwise(both(*OTHER_WORKBOOK))


def workbook_category(url: Column) -> Column:
    return workbook_class(url)["category"]


# Bodies and titles whose mention sends a document to a manual look.
SENSITIVE = (
    r"(?i)\b(?:imf|international monetary fund|world bank|oecd|ecb|european central bank|european commission|esma|eiopa|eba|ifsat|appeal tribunal|tribunal|court"
    r"|mr justice|mrs justice|justice [a-z]|prof(?:essor)?\.? [a-z])\b"
)


def review_queue(df: DataFrame, sha: str, contained: Column, uncertain: Column, texts: list[str]) -> DataFrame:
    """Rows with a reason for a manual look, their reasons joined, in order of hash."""
    joined = F.concat_ws(" ", *texts)
    out = df.withColumn("reasons", F.array_join(risk_reasons(contained, uncertain, joined.rlike(SENSITIVE)), "; "))
    return out.filter(F.col("reasons") != "").orderBy(sha)
