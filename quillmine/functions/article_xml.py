"""Articles from their XML.

Mixed content rules out Spark's own XML functions: they lose text around inline markup or fail the
job on malformed input.  So an article is parsed by the standard library in Arrow batches.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine import schemas
from quillmine.functions.arrow import with_columns

ARTICLE = r"(?s)<PubmedArticle>.*?</PubmedArticle>"
CONTROL = re.compile(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]")
DECLARATION = re.compile(r"^\s*<\?xml[^>]*\?>|<!DOCTYPE[^>]*>")
DOI_PREFIX = re.compile(r"(doi:|https?://(dx\.)?doi\.org/)")
MARK = "Electronic address:"


def split_articles(batches: DataFrame, data: str = "data") -> DataFrame:
    """One row for each article in the batches' XML: its number in the batch, its XML and PMID.

    Articles without a PMID are left out; the batch's other columns stay."""
    found = batches.select(*[c for c in batches.columns if c != data], F.posexplode(F.regexp_extract_all(F.col(data), F.lit(ARTICLE), F.lit(0))).alias("article_pos", "raw_xml"))
    return found.withColumn("pmid", F.regexp_extract("raw_xml", r"<PMID[^>]*>(\d+)</PMID>", 1)).where("pmid <> ''")


def _text(parent: ET.Element | None, path: str) -> str | None:
    found = parent.find(path) if parent is not None else None
    return found.text if found is not None and found.text else None


def _mixed(element: ET.Element) -> str:
    """An element's text, that of its children and what stands between them."""
    return "".join([element.text or "", *[(c.text or "") + (c.tail or "") for c in element]]).strip()


def _only(**fields) -> dict:
    return {k: v for k, v in fields.items() if v}


def _number(text: str | None) -> int | str | None:
    try:
        return int(text) if text is not None else None
    except ValueError:
        return text


def _date(element: ET.Element | None) -> dict:
    """year, month and day, as numbers where they are, and as much of an ISO date as they make."""
    if element is None:
        return {}
    year, month, day = (_number(_text(element, f"./{p}")) for p in ("Year", "Month", "Day"))
    if isinstance(month, str):
        try:
            month = datetime.strptime(month[:3], "%b").month
        except ValueError:
            pass
    elif month is not None and not 1 <= month <= 12:
        month = None
    out = {k: v for k, v in (("year", year), ("month", month), ("day", day)) if v is not None}
    if year is not None:
        parts = [str(year)]
        for p in (month, day):
            if not isinstance(p, int):
                break
            parts.append(f"{p:02d}")
        out["iso_date"] = "-".join(parts)
    return out


def _authors(article: ET.Element) -> list[dict]:
    out = []
    for a in article.findall("./AuthorList/Author"):
        if not (last := _text(a, "./LastName")):
            continue
        one = _only(last_name=last, first_name=_text(a, "./ForeName"), initials=_text(a, "./Initials"))
        if place := _text(a, "./AffiliationInfo/Affiliation"):
            before, mark, _ = place.partition(MARK)
            if mark:
                one["is_corresponding"] = True
            one["affiliation"] = before.strip().rstrip(",.") if mark else place
        if a.get("EqualContribution") == "Y":
            one["equal_contribution"] = True
        out.append(one)
    return out


def _mesh(medline: ET.Element) -> list[dict]:
    out = []
    for h in medline.findall("./MeshHeadingList/MeshHeading"):
        name = h.find("./DescriptorName")
        if name is None or not name.text:
            continue
        one = {"descriptor": name.text, "descriptor_ui": name.get("UI", ""), "descriptor_major": name.get("MajorTopicYN") == "Y"}
        if more := [{"name": q.text, "ui": q.get("UI", ""), "major": q.get("MajorTopicYN") == "Y"} for q in h.findall("./QualifierName") if q.text]:
            one["qualifiers"] = more
        out.append(one)
    return out


def _journal(medline: ET.Element) -> dict:
    about, article = medline.find("./MedlineJournalInfo"), medline.find("./Article")
    out = _only(title_abbreviated=_text(about, "./MedlineTA"), nlm_id=_text(about, "./NlmUniqueID"), issn_linking=_text(about, "./ISSNLinking"), country=_text(about, "./Country"))
    journal = article.find("./Journal") if article is not None else None
    if journal is None:
        return out
    out |= _only(title=_text(journal, "./Title"), iso_abbreviation=_text(journal, "./ISOAbbreviation"), issn=_text(journal, "./ISSN"))
    if "issn" in out:
        out["issn_type"] = journal.find("./ISSN").get("IssnType", "")
    if (issue := journal.find("./JournalIssue")) is not None:
        out |= _only(volume=_text(issue, "./Volume"), issue=_text(issue, "./Issue")) | {"cited_medium": issue.get("CitedMedium", "")}
    return out | _only(pagination=_text(article, "./Pagination/MedlinePgn"))


def normalize_doi(doi: str) -> str:
    return DOI_PREFIX.sub("", doi.strip().lower(), count=1).rstrip(".;,) /") if DOI_PREFIX.match(doi.strip().lower()) else doi.strip().lower().rstrip(".;,) /")


def parse_element(root: ET.Element) -> dict:
    """A PubmedArticle element as nested fields; {} without a PMID."""
    if not (pmid := _text(root, ".//PMID")):
        return {}
    out: dict = {"pmid": pmid}
    medline, data = root.find(".//MedlineCitation"), root.find(".//PubmedData")
    if medline is not None:
        article = medline.find("./Article")
        if article is not None:
            title, abstract = article.find("./ArticleTitle"), article.findall("./Abstract/AbstractText")
            labelled = [f"{label}: {_mixed(t)}" if (label := t.get("Label")) else _mixed(t) for t in abstract]
            out["title"] = _mixed(title) if title is not None else ""
            out["abstract"], out["authors"], out["language"] = " ".join(labelled), _authors(article), _text(article, "./Language") or ""
            out["publication_types"] = [{"type": p.text, "ui": p.get("UI", "")} for p in article.findall("./PublicationTypeList/PublicationType") if p.text]
            out["publication_date"] = _date(article.find("./Journal/JournalIssue/PubDate")) or _date(article.find("./ArticleDate"))
            grants = [_only(id=_text(g, "./GrantID"), agency=_text(g, "./Agency"), country=_text(g, "./Country"), acronym=_text(g, "./Acronym")) for g in article.findall("./GrantList/Grant")]
            out["grants"] = [g for g in grants if g]
        kinds = {p["type"] for p in out.get("publication_types", [])}
        related = {c.get("RefType"): c for c in reversed(medline.findall(".//CommentsCorrections"))}
        inner = root.find(".//Article")
        out["mesh_headings"], out["journal"] = _mesh(medline), _journal(medline)
        out["keywords"] = [{"keyword": k.text, "major": k.get("MajorTopicYN") == "Y", "owner": g.get("Owner", "")} for g in medline.findall("./KeywordList") for k in g.findall("./Keyword") if k.text]
        out["is_retracted"] = "Retracted Publication" in kinds or "RetractionIn" in related or "PartialRetractionIn" in related
        out["retraction_of_pmid"] = (_text(related.get("RetractionOf"), "./PMID") or "").strip()
        out["is_preprint"] = "Preprint" in kinds or (inner is not None and inner.get("PubModel") == "Preprint")
    if data is not None:
        ids = [{"id": i.text, "type": i.get("IdType", "")} for i in data.findall("./ArticleIdList/ArticleId") if i.text]
        out["publication_status"], out["article_ids"] = _text(data, "./PublicationStatus") or "", ids
        if dois := [i["id"] for i in ids if i["type"] == "doi"]:
            out["doi"] = normalize_doi(dois[-1])
        out["history"] = [d | {"status": p.get("PubStatus")} for p in data.findall("./History/PubMedPubDate") if (d := _date(p)) and p.get("PubStatus")]
    return out


def parse_article(xml: str | None) -> dict:
    """The first article in a text of XML; {} if there is none or it isn't well-formed."""
    return next(iter(parse_articles(xml)), {})


def parse_articles(xml: str | None) -> list[dict]:
    """All articles with a PMID in a text of XML, declared or not, in a set or not."""
    body = DECLARATION.sub("", CONTROL.sub("", xml or ""))
    try:
        root = ET.fromstring(f"<all>{body}</all>")
    except ET.ParseError:
        return []
    return [a for e in root.iter("PubmedArticle") if (a := parse_element(e))]


def spine_row(xml: str | None) -> tuple:
    """The columns of ``schemas.PARSED_COLUMNS``; nested fields as JSON text, what is missing as empty."""
    a = parse_article(xml)
    date = a.get("publication_date", {})
    year, month = date.get("year"), date.get("month")
    listed = lambda k: json.dumps(a.get(k) or [], ensure_ascii=False)
    return (
        a.get("title", ""), a.get("abstract", ""), listed("authors"), json.dumps(a.get("journal") or {}, ensure_ascii=False), year if isinstance(year, int) else None, month if isinstance(month, int) else None,
        a.get("doi", ""), listed("publication_types"), listed("mesh_headings"), listed("keywords"), a.get("language", ""), listed("grants"), a.get("publication_status", ""), listed("article_ids"),
        a.get("is_retracted", False), a.get("retraction_of_pmid", ""), a.get("is_preprint", False),
    )


def parse_frame(raw: DataFrame, xml: str = "raw_xml") -> DataFrame:
    """The frame with the parsed columns; its own ``pmid`` stays the key."""
    return with_columns(raw, [xml], f"{xml} string, {schemas.PARSED_COLUMNS}", lambda x: (x, *spine_row(x)))
