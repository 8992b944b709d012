"""Papers by keywords in their authors' affiliations."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmine import schemas


@dataclass
class KeywordFilter:
    keywords: list[str]
    output_column: str = "matches"
    min_author_matches: int = 1
    also_check_columns: list[str] = field(default_factory=list)
    case_sensitive: bool = False
    drop_non_matching: bool = False

    def __post_init__(self):
        if not self.keywords or self.min_author_matches < 1:
            raise ValueError("keywords and at least one author are needed")


def matches(config: KeywordFilter, columns: list[str], authors: str = "authors") -> Column:
    """Whether enough authors' affiliations hold a keyword, or any of the other text columns does.

    An author counts once.  JSON that doesn't parse, and null affiliations, match nothing."""
    fold = (lambda c: c) if config.case_sensitive else F.lower
    words = F.array(*[F.lit(k if config.case_sensitive else k.lower()) for k in config.keywords])
    hit = lambda text: F.exists(words, lambda k: fold(F.coalesce(text, F.lit(""))).contains(k))
    listed = F.coalesce(F.from_json(F.col(authors), schemas.AUTHORS), F.array().cast(schemas.AUTHORS)) if authors in columns else F.array().cast(schemas.AUTHORS)
    found = F.size(F.filter(listed, lambda a: hit(a["affiliation"]))) >= config.min_author_matches
    for c in config.also_check_columns:
        if c in columns:
            found = found | hit(F.col(c).cast("string"))
    return found


def filter_papers(papers: DataFrame, config: KeywordFilter) -> DataFrame:
    found = matches(config, papers.columns)
    return papers.where(found) if config.drop_non_matching else papers.withColumn(config.output_column, found)


def filter_statistics(tagged: DataFrame, column: str) -> DataFrame:
    n = F.count("*")
    hit = F.count_if(F.coalesce(F.col(column), F.lit(False)))
    return tagged.agg(hit.alias("n_matched"), n.alias("n_total"), F.round(hit / F.greatest(n, F.lit(1)), 4).alias("match_rate"))
