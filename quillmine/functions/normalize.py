"""Ladders that bring free answers to the values that reports count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmine.functions.text import strip_space

# Other names of the two specialties.
RADIOLOGY = ["radiology", "diagnostic and interventional radiology", "medical imaging", "ultrasound", "computed tomography", "radiodiagnostics", "diagnostic imaging", "radiological sciences", "radiology and radiation oncology", "radiology and nuclear medicine", "interventional radiology", "nuclear medicine and radiology"]
CARDIOLOGY = ["cardiology", "cardiovascular medicine", "cardiovascular surgery", "cardiac surgery", "structural interventional cardiology", "cardiovascular center", "heart center", "cardiac center"]
# Imaging terms that make a free answer relevant, and plain answers.
IMAGING = ["cardiac mri", "cardiac magnetic resonance", "cmr", "cardiovascular magnetic resonance", "cardiac ct", "coronary ct", "ccta", "ctca", "cardiac computed tomography"]
REFUSALS = ["notrelevant", "not_relevant", "not relevant", "irrelevant", "false", "0", "no"]
CONSENTS = ["relevant", "true", "yes", "1"]
# Study designs that count as original research, and the canonical names.
DESIGNS = ["prospective", "retrospective", "cohort", "observational study", "cross-sectional", "rct", "registry", "clinical study", "original", "original research", "observational"]
STUDIES = ["OriginalResearch", "CaseReportOrSeries", "Review", "SystematicReviewOrMetaAnalysis", "Other"]
# Names too general to be an institution, words that don't count, corporate forms, ward prefixes.
GENERIC = ["cardiovascular center", "cardiovascular centre", "heart center", "heart centre", "cardiology center", "cardiology centre", "institute of cardiology", "institute of cardiovascular", "medical center", "medical centre", "research center", "research centre", "university hospital", "general hospital", "city hospital", "national hospital", "district hospital", "regional hospital", "school of medicine", "college of medicine", "faculty of medicine", "medical school", "school of medical", "department of medicine", "university heart center", "university heart centre", "universitäres herzzentrum", "university heart and vascular center"]
STOPWORDS = ["the", "and", "for", "of", "in", "at", "on", "a", "an", "de", "du"]
CORPORATE = ["gmbh", "ag", "inc.", "inc", "llc", "ltd.", "ltd", "s.a.", "sa", "plc", "bv", "nv"]
WARD = r"^(medizinische\s+klinik|klinik\s+(f[üu]r|der|des|an\s+der|und)|klinikum\s+(der|des)\s+universit[äa]|clinique\s+de|servicio\s+de|i\.\s+medizinische|ii\.\s+medizinische|iii\.\s+medizinische)"


# What a free answer becomes: the first rule that holds decides, so the order of the rules is part of them.  A rule is
# (how the answer is tested, with what, the value); answers are tested in lower case.
SPECIALTY_RULES = [("is", RADIOLOGY, "Radiology"), ("is", CARDIOLOGY, "Cardiology"), ("is", ["unclear", ""], "Unclear"), ("is", ["notreported"], "NotReported")]
RELEVANCE_RULES = [
    ("is", ["main"], "Main"), ("is", ["secondary"], "Secondary"), ("is", REFUSALS, "NotRelevant"), ("is", CONSENTS, "Main"),
    ("begins", ["not relevant", "notrelevant", "irrelevant"], "NotRelevant"), ("begins", ["relevant", "yes"], "Main"), ("holds", IMAGING, "Main"), ("longer", 30, "Main"),
]
STUDY_RULES = [
    *[("is", [name.lower()], name) for name in STUDIES], ("is", DESIGNS, "OriginalResearch"), ("holds", ["systematic", "meta-analysis", "meta analysis"], "SystematicReviewOrMetaAnalysis"),
    ("holds", ["case report", "case series"], "CaseReportOrSeries"), ("holds", ["review"], "Review"),
]


def by_rules(answer: Column, rules: list[tuple], otherwise: str) -> Column:
    """The value of the first rule that holds for an answer; null has none of what rules ask for."""
    some = lambda words, test: reduce(lambda x, y: x | y, [test(w) for w in words])
    tests = {"is": answer.isin, "begins": lambda words: some(words, answer.startswith), "holds": lambda words: some(words, answer.contains), "longer": lambda n: F.char_length(answer) > n}
    out = F.when(F.lit(False), otherwise)
    for how, what, value in rules:
        out = out.when(tests[how](what), value)
    return out.otherwise(otherwise)


def specialty(raw: Column) -> Column:
    return by_rules(F.lower(strip_space(raw)), SPECIALTY_RULES, "Other")


def relevance(raw: Column) -> Column:
    """Main, Secondary or NotRelevant; an answer that explains itself at length is Main."""
    return by_rules(F.lower(strip_space(raw)), RELEVANCE_RULES, "NotRelevant")


def study_type(raw: Column) -> Column:
    return by_rules(F.regexp_replace(F.lower(strip_space(raw)), r"(?U)\s+", " "), STUDY_RULES, "Other")


def majority(first: Column, last: Column, corresponding: Column) -> Column:
    """What two of three say; Unclear if none says anything, Mixed otherwise, even on a single vote."""
    votes = [F.when((v != "") & ~v.isin("Unclear", "NotReported"), v) for v in (first, last, corresponding)]
    a, b, c = votes
    return F.when((a == b) | (a == c), a).when(b == c, b).when(F.coalesce(*votes).isNull(), "Unclear").otherwise("Mixed")


def institution(name: Column) -> Column:
    """One spelling for institutions that differ by IRCCS, word order, dashes or Centre."""
    n = strip_space(F.regexp_replace(name, r"(?i),?\s+IRCCS\b", ""))
    n = strip_space(F.regexp_replace(n, r"\s*,\s*$", ""))
    n = F.regexp_replace(n, r"(?i)^(.+?)\s+Medical\s+University$", "Medical University of $1")
    return F.regexp_replace(F.regexp_replace(n, r"\s+-\s+", "-"), r"(?i)\bCentre\b", "Center")


def meaningful_institution(name: Column, least: int = 3) -> Column:
    """Whether a name says which institution: not generic, no ward, no company, enough words that count."""
    n = strip_space(F.lower(name))
    words = F.split(n, r"[\s,.\-]+")
    counting = F.filter(words, lambda w: (F.char_length(w) > 2) & ~w.isin(STOPWORDS))
    return ~n.isin(GENERIC) & ~n.rlike(WARD) & ~F.exists(words, lambda w: w.isin(CORPORATE)) & (F.size(counting) >= least)
