"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmine import schemas

# The resolvers that may stand before a DOI, and what may trail it.
DOI_PREFIX = r"^(doi:|https?://(dx\.)?doi\.org/)"
DOI_TRAIL = r"[.;,) /]+$"
# Publication types that exclude a paper, with the reason given.
EXCLUSIONS = {"Review": "Review", "Case Reports": "Case Report", "Comment": "Letter or Comment", "Letter": "Letter or Comment"}
# White_Space of Unicode.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ROLE_WIDTH = 24
RULES = (
    "You extract structured facts from one scientific paper.\n\nRULES:\n"
    "1. Use only what the paper's text says.\n"
    "2. Judge every field by itself.\n"
    "3. Of several readings take the most literal one that can be defended.\n"
    "4. Where the text does not say, return null rather than a guess.\n"
    "5. Hold all fields to the same standard."
)


def strip_space(text: Column) -> Column:
    """Without Unicode white space at either end; trim() alone would only take U+0020."""
    return F.trim(text, F.lit(SPACE))


def normalize_doi(doi: Column) -> Column:
    """Lower case, without a resolver in front and without punctuation at the end."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip_space(doi)), DOI_PREFIX, ""), DOI_TRAIL, "")


def normalize_title(title: Column) -> Column:
    return strip_space(F.lower(title))


def title_block_key(title: Column) -> Column:
    """The first three words of a title, or all of one that has fewer."""
    three = F.regexp_replace(F.regexp_extract(title, r"(?U)^\s*(\S+\s+\S+\s+\S+)", 1), r"(?U)\s+", " ")
    return F.coalesce(F.nullif(three, F.lit("")), title)


def clean_xml(text: Column) -> Column:
    """Without the control characters that XML forbids."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def llm_input(title: Column, abstract: Column, mesh_json: Column, keywords_json: Column) -> Column:
    """Title, abstract and, if there are any, MeSH descriptors followed by keywords, under headings."""
    named = lambda column, kind, field: F.filter(F.transform(F.coalesce(F.from_json(column, kind), F.array().cast(kind)), lambda x: x[field]), lambda x: x != "")
    words = F.concat(named(mesh_json, schemas.MESH, "descriptor"), named(keywords_json, schemas.KEYWORDS, "keyword"))
    head = F.concat(F.lit("# Title:\n"), F.coalesce(title, F.lit("")), F.lit("\n\n# Abstract:\n"), F.coalesce(abstract, F.lit("")), F.lit("\n\n"))
    return F.when(F.size(words) > 0, F.concat(head, F.lit("# Keywords:\n"), F.array_join(words, "; "), F.lit("\n\n"))).otherwise(head)


def exclusion_reason(pub_type_json: Column) -> Column:
    """The reason of the first excluding publication type; '' if none excludes."""
    kinds = F.transform(F.from_json(pub_type_json, schemas.PUB_TYPES), lambda p: p["type"])
    first = F.get(F.filter(kinds, lambda k: k.isin(*EXCLUSIONS)), F.lit(0))
    return F.coalesce(F.create_map(*[F.lit(x) for kv in EXCLUSIONS.items() for x in kv])[first], F.lit(""))


def author_name(author: Column) -> Column:
    trimmed = lambda f: F.coalesce(strip_space(author[f]), F.lit(""))
    last, initials, first = trimmed("last_name"), trimmed("initials"), trimmed("first_name")
    return F.when((last != "") & (initials != ""), F.concat(last, F.lit(" "), initials)).when(last != "", last).when(first != "", first).otherwise("Unknown")


def author_block(authors_json: Column) -> Column:
    """Lines for the first, the corresponding and the last author, labels padded to one width.

    An author corresponds if so flagged or starred in name or affiliation; one author alone is first
    and not last; without authors, or where the JSON doesn't parse, the block is empty.
    """
    authors = F.filter(F.coalesce(F.from_json(authors_json, schemas.AUTHORS), F.array().cast(schemas.AUTHORS)), lambda a: a.isNotNull())

    def line(label: str, author: Column) -> Column:
        place = F.coalesce(strip_space(author["affiliation"]), F.lit(""))
        lead = F.concat(F.rpad(F.lit(label), ROLE_WIDTH, " "), author_name(author))
        return F.when(place != "", F.concat(lead, F.lit(" — "), place)).otherwise(lead)

    starred = lambda a: F.coalesce(a["is_corresponding"], F.lit(False)) | F.coalesce(a["affiliation"].contains("*"), F.lit(False)) | F.coalesce(a["last_name"].contains("*"), F.lit(False))
    first = F.transform(F.slice(authors, 1, 1), lambda a: line("First author:", a))
    writing = F.transform(F.filter(authors, starred), lambda a: line("Corresponding (*):", a))
    last = F.when(F.size(authors) > 1, F.transform(F.slice(authors, -1, 1), lambda a: line("Last author:", a))).otherwise(F.array().cast("array<string>"))
    return F.when(F.size(authors) > 0, F.array_join(F.concat(first, writing, last), "\n")).otherwise("")


def system_message(instruction: str | None) -> str:
    extra = (instruction or "").strip()
    return f"{RULES}\n\nDOMAIN CONTEXT:\n{extra}" if extra else RULES


def user_message(title: Column, abstract: Column, block: Column, **extra: Column) -> Column:
    """The prompt's user part: what is null or blank is left out."""
    some = lambda label, c: F.when(F.coalesce(strip_space(c), F.lit("")) != "", F.concat(F.lit(f"{label}: "), strip_space(c)))
    others = [F.concat(F.lit(f"{name}: "), column.cast("string")) for name, column in extra.items()]
    writers = F.when(block != "", F.concat(F.lit("\nAuthors:\n"), block))
    return F.concat_ws("\n", F.lit("PAPER:"), some("Title", title), some("Abstract", abstract), *others, writers, F.lit("\nExtract all fields from this paper according to the schema."))


def shorten(text: Column, length: int = 50) -> Column:
    return F.when(F.char_length(text) > length, F.concat(F.substring(text, 1, length), F.lit("…"))).otherwise(text)


def cache_key(namespace: Column, params: Column) -> Column:
    return F.md5(F.concat_ws(":", namespace, params))


def wrap_label(text: Column, width: int = 40, back: int = 12) -> Column:
    """Broken in two at the last space of the ``back`` places up to ``width``; cut there if it has none."""
    tail = F.substring(text, width - back + 2, back)  # the places where it may break, the last one last
    at = F.char_length(F.regexp_extract(tail, "^(.*) ", 1))
    broken = F.concat(F.substring(text, 1, width - back + 1), F.substring(tail, F.lit(1), at), F.lit("\n"), text.substr(F.lit(width - back + 3) + at, F.char_length(text)))
    return F.when(F.char_length(text) <= width, text).when(tail.contains(" "), broken).otherwise(F.concat(F.substring(text, 1, width), F.lit("…")))


def pretty(text: Column, labels: dict[str, str]) -> Column:
    """The label of a value, or the value."""
    table = F.create_map(*[F.lit(x) for item in labels.items() for x in item]) if labels else None
    return text if table is None else F.coalesce(table[text], text)


def title_case(text: Column) -> Column:
    """Each word's first letter in upper case, the others in lower case, words being runs of letters."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")


def affiliation_of(author: Column) -> Column:
    """The first of an author's ``affiliations``, or, where they are missing or empty, the ``affiliation``."""
    many = author["affiliations"]
    return F.coalesce(F.when(F.size(many) > 0, F.coalesce(F.get(many, F.lit(0)), F.lit(""))), author["affiliation"], F.lit(""))


def id_list_key(ids: Column) -> Column:
    """The hash of a list of ids as they stand, joined by commas."""
    return F.md5(F.concat_ws(",", ids))
