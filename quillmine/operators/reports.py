"""The aggregates behind the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmine.functions.geography import region
from quillmine.functions.normalize import institution


def journal_title(journal_json: Column) -> Column:
    """The first of the names that a journal has; blank ones are passed over."""
    names = [F.get_json_object(journal_json, f"$.{k}") for k in ("title", "journal_title", "iso_abbrev")]
    return F.coalesce(*[F.when(n != "", n) for n in names])


def journal_name(journal_json: Column) -> Column:
    """As analyses name a journal: its title, or its abbreviated one, or nothing."""
    names = [F.get_json_object(journal_json, f"$.{k}") for k in ("title", "title_abbreviated")]
    return F.coalesce(*[F.when(n != "", n) for n in names], F.lit(""))


def most_common(df: DataFrame, value: str, k: int | None = None, order: str = "_pos") -> DataFrame:
    """(value, n): the most frequent values, ties in the order in which they first occur."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("__first")).orderBy(F.desc("n"), "__first")
    return (counted if k is None else counted.limit(k)).drop("__first")


def per_year(df: DataFrame) -> DataFrame:
    return df.where("year is not null").groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


def flag_share(df: DataFrame, column: str, *by: str) -> DataFrame:
    """How many rows have a flag, null being no, and their percentage."""
    hit = F.count_if(F.coalesce(F.col(column).cast("boolean"), F.lit(False)))
    return df.groupBy(*by).agg(F.count("*").alias("total"), hit.alias("flagged"), F.round(100.0 * hit / F.greatest(F.count("*"), F.lit(1)), 2).alias("pct"))


def distinct_per_paper(df: DataFrame, values: Column, name: str) -> DataFrame:
    """A row for each different trimmed, non-blank value of a paper's array."""
    trimmed = F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v != ""))
    return df.withColumn(name, F.explode(trimmed))


def scope_distribution(papers: DataFrame, registry: DataFrame, journal: Column, flagged: Column) -> DataFrame:
    """Papers by the scope of their journal; journals that the registry lacks are Other, papers without one don't count."""
    titled = papers.select(F.lower(journal).alias("journal"), flagged.alias("flagged")).where("journal is not null and journal <> ''")
    return titled.join(registry, "journal", "left").groupBy(F.coalesce("scope", F.lit("Other")).alias("scope")).agg(F.count("*").alias("total"), F.count_if("flagged").alias("european"))


def classify_by_part(names: DataFrame, name: str, table: DataFrame) -> DataFrame:
    """(name, scope): by equal names, else by the first table entry that holds or is held by the name; else Other.

    ``table`` is (entry, scope, ord), a list of fixed values; only distinct names meet it."""
    low = F.lower(F.trim(name))
    distinct = names.select(name).distinct().withColumn("__low", low)
    held = F.broadcast(table)
    joined = distinct.join(held, F.col("__low").contains(F.col("entry")) | F.col("entry").contains(F.col("__low")), "left")
    rank = F.struct((F.col("__low") != F.col("entry")).alias("part"), "ord")
    return joined.groupBy(name).agg(F.coalesce(F.min_by("scope", rank), F.lit("Other")).alias("scope"))


def registry_top(papers: DataFrame, journal: str, flagged: Column, k: int) -> DataFrame:
    out = papers.where(F.col(journal).isNotNull()).groupBy(F.col(journal).alias("journal_name")).agg(F.count("*").alias("count_total"), F.count_if(flagged).alias("count_european"))
    return out.orderBy(F.desc("count_total"), "journal_name").limit(k)


def by_year_and(df: DataFrame, category: Column, default: str, name: str = "category") -> DataFrame:
    kind = F.when(F.coalesce(category, F.lit("")) == "", F.lit(default)).otherwise(category)
    return df.groupBy("year", kind.alias(name)).agg(F.count("*").alias("n"))


def shares(counts: DataFrame, group: str = "year", least: int = 15, listed: list[str] | None = None, name: str = "category") -> DataFrame:
    """Each category's percentage of its group, for groups of at least ``least``; only listed categories are shown, all count."""
    total = F.sum("n").over(Window.partitionBy(group))
    out = counts.withColumn("total", total).where(F.col("total") >= least).withColumn("share", 100.0 * F.col("n") / F.col("total"))
    return out if listed is None else out.where(F.col(name).isin(listed))


def two_eras(df: DataFrame, category: str, first: tuple[int, int], second: tuple[int, int]) -> DataFrame:
    """Shares of a category in two spans of years and their difference in points; those that occur in either."""
    era = F.when(F.col("year").between(*first), "a").when(F.col("year").between(*second), "b")
    counted = df.withColumn("era", era).where("era is not null").groupBy(category).agg(F.count_if(F.col("era") == "a").alias("a"), F.count_if(F.col("era") == "b").alias("b"))
    sums = counted.agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    pct = lambda n, t: F.when(F.col(t) > 0, 100.0 * F.col(n) / F.col(t)).otherwise(0.0)
    return counted.crossJoin(F.broadcast(sums)).select(category, pct("a", "ta").alias("share_first"), pct("b", "tb").alias("share_second"), (pct("b", "tb") - pct("a", "ta")).alias("difference"))  # sums is one row


def country_totals(df: DataFrame, countries: Column, original: Column, k: int) -> DataFrame:
    """The countries with most papers, each counted once a paper, and how many are original research."""
    out = distinct_per_paper(df.withColumn("__o", original), countries, "country").where("country <> 'unknown'")
    return out.groupBy("country").agg(F.count("*").alias("total"), F.count_if("__o").alias("original")).orderBy(F.desc("total"), "country").limit(k)


def region_by_year(df: DataFrame, country: Column) -> DataFrame:
    return by_year_and(df, region(country), "Unknown", "region")


def top_per_group(counts: DataFrame, group: str, k: int, value: str) -> DataFrame:
    row = F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), value)).cast("long")
    return counts.withColumn("rank", row).where(F.col("rank") <= k)


def rank(counts: DataFrame, value: str, first: str | None = None) -> DataFrame:
    """Places by count; ties get places of their own, in the order of the column ``first``, such as where a
    value first occurs, or by name.

    Only values of one count are sorted together: what ranks before them follows from how many values there
    are of each larger count."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("__many"))
    before = F.coalesce(F.sum("__many").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a count
    row = F.row_number().over(Window.partitionBy("n").orderBy(*([first] if first else []), value))
    placed = counts.withColumn("__row", row).join(sizes.select("n", before.alias("__before")), "n")
    return placed.withColumn("rank", (F.col("__row") + F.col("__before")).cast("long")).select(*counts.columns, "rank")


def role_counts(df: DataFrame, value: str = "entity") -> DataFrame:
    """Papers of each entity in any, first and last place of a list of authors, from (pmid, entity, is_first, is_last)."""
    once = df.groupBy(value, "pmid").agg(F.max("is_first").alias("f"), F.max("is_last").alias("l"))
    return once.groupBy(value).agg(F.count("*").alias("any"), F.count_if("f").alias("first"), F.count_if("l").alias("last"))


def contingency(df: DataFrame, row: str, column: str, rows: list[str], columns: list[str]) -> DataFrame:
    """Percentages of the listed columns within each listed row."""
    counted = df.where(F.col(row).isin(rows) & F.col(column).isin(columns)).groupBy(row, column).agg(F.count("*").alias("n"))
    return counted.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def moving_average(counts: DataFrame, cut: bool = False) -> DataFrame:
    """Five-point centred averages by year, padded with zeros; ``cut`` leaves out the last three points.  One row a year."""
    by = Window.orderBy("year")
    out = counts.withColumn("average", F.sum("n").over(by.rowsBetween(-2, 2)) / 5.0)
    if cut:
        out = out.withColumn("__left", F.row_number().over(Window.orderBy(F.desc("year")))).where("__left > 3").drop("__left")
    return out


def annual_change(counts: DataFrame, group: str, years: tuple[int, int] = (2001, 2026), min_years: int = 6, min_papers: int = 15) -> DataFrame:
    """Percent change a year of each group's counts, by a log-linear fit over all the years, gaps being zero.

    Null where fewer than ``min_years`` years have papers or there are fewer than ``min_papers``."""
    calendar = counts.select(group).distinct().withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1])).cast("array<long>")))
    dense = calendar.join(counts, [group, "year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    fit = (F.exp(F.regr_slope(F.log(F.col("n") + 0.5), F.col("year").cast("double"))) - 1) * 100
    out = dense.groupBy(group).agg(fit.alias("apc"), F.count_if(F.col("n") > 0).alias("years"), F.sum("n").alias("papers"))
    return out.select(group, "papers", F.when((F.col("years") >= min_years) & (F.col("papers") >= min_papers), F.col("apc")).alias("apc"))


def change_bounds(changes: DataFrame) -> DataFrame:
    p = F.percentile("apc", F.array(F.lit(0.05), F.lit(0.95)))
    return changes.where("apc is not null").agg(p.alias("p")).select(F.col("p")[0].alias("p5"), F.col("p")[1].alias("p95"))


def colour_bounds(*changes: DataFrame) -> DataFrame:
    """The 5th and 95th percentile of all changes as the ends of a scale: within -25 and 45, with 0 inside."""
    every = changes[0].select("apc")
    for more in changes[1:]:
        every = every.union(more.select("apc"))
    low, high = F.greatest("p5", F.lit(-25.0)), F.least("p95", F.lit(45.0))
    return change_bounds(every).select(F.when(low >= 0, -2.0).otherwise(low).alias("vmin"), F.when(high <= 0, 2.0).otherwise(high).alias("vmax"))


def bridge_names(counts: DataFrame, name: str, bridge: dict[str, str | None], value: str = "n") -> DataFrame:
    """Counts under other names: what maps to nothing is left out, what maps to one name adds up."""
    table = F.create_map(*[F.lit(x) for kv in bridge.items() if kv[1] is not None for x in kv])
    gone = [k for k, v in bridge.items() if v is None]
    kept = counts.where(~F.col(name).isin(gone)) if gone else counts
    return kept.groupBy(F.coalesce(table[F.col(name)], F.col(name)).alias(name)).agg(F.sum(value).alias(value))


def typed_panel(df: DataFrame, names: Column, original: Column, k: int, normal=None, keep=None, name: str = "entity") -> DataFrame:
    """The most frequent entities of papers: different raw names count once a paper and are brought to one
    spelling after that, so two spellings in a paper count twice; ``keep`` is a condition on the spelling."""
    out = distinct_per_paper(df.withColumn("__o", original), names, name)
    if normal is not None:
        out = out.withColumn(name, normal(F.col(name)))
    if keep is not None:
        out = out.where(keep(F.col(name)))
    return out.groupBy(name).agg(F.count("*").alias("total"), F.count_if("__o").alias("original")).orderBy(F.desc("total"), name).limit(k)


def top_within_top(df: DataFrame, group: str, value: str, groups: int, k: int) -> DataFrame:
    """The k most frequent values within each of the most frequent groups."""
    first = df.groupBy(group).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), group).limit(groups)
    inside = df.join(F.broadcast(first), group)  # as many rows as groups are wanted
    return top_per_group(inside.groupBy(group, value).agg(F.count("*").alias("n")), group, k, value)


def journal_bar(papers: DataFrame, journal: str, original: Column, scopes: DataFrame, k: int = 20) -> DataFrame:
    """Journals by papers, with how many are original research and the journal's scope."""
    out = papers.where(F.col(journal) != "").groupBy(journal).agg(F.count("*").alias("total"), F.count_if(original).alias("original")).orderBy(F.desc("total"), journal).limit(k)
    return out.join(scopes, F.lower(out[journal]) == scopes["journal_key"], "left").select(journal, "total", "original", F.coalesce("scope", F.lit("Other")).alias("scope"))


def country_years(df: DataFrame, countries: Column, original: Column) -> DataFrame:
    """Papers of each country and year, a country once a paper."""
    out = distinct_per_paper(df.withColumn("__o", original), countries, "country").where("country <> 'unknown' and year is not null")
    return out.groupBy("country", "year").agg(F.count("*").alias("total"), F.count_if("__o").alias("original"))


def bridge_last(values: DataFrame, name: str, bridge: dict[str, str | None], value: str, order: str) -> DataFrame:
    """Values under other names, where the last in order wins; what maps to nothing is left out."""
    table = F.create_map(*[F.lit(x) for kv in bridge.items() if kv[1] is not None for x in kv])
    gone = [k for k, v in bridge.items() if v is None]
    kept = values.where(~F.col(name).isin(gone)) if gone else values
    return kept.groupBy(F.coalesce(table[F.col(name)], F.col(name)).alias(name)).agg(F.max_by(value, order).alias(value))


def focus_profile(df: DataFrame, places: Column, pattern: str) -> DataFrame:
    """Papers with a focus institution, given by a pattern, among their affiliations: anywhere, first, last, first and last."""
    hit = lambda a: F.coalesce(a.rlike(pattern), F.lit(False))
    some, first, last = F.coalesce(F.exists(places, hit), F.lit(False)), hit(F.get(places, F.lit(0))), hit(F.get(places, F.size(places) - 1))
    rows = df.select(some.alias("s"), first.alias("f"), last.alias("l"))
    return rows.agg(F.count("*").alias("papers"), F.count_if("s").alias("any"), F.count_if("f").alias("first"), F.count_if("l").alias("last"), F.count_if(F.col("f") & F.col("l")).alias("both"))


def names_focus(name: Column, aliases: list[str], place: str, any_of: list[str], none_of: list[str] | None = None) -> Column:
    """Whether a normalised name is that of the focus institution: an alias, or the place with one of some words
    and none of others."""
    low = F.lower(institution(name))
    holds = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))
    said = low.contains(place) & holds(any_of)
    return low.isin(aliases) | (said & ~holds(none_of) if none_of else said)


def ranked_with_variants(counts: DataFrame, name: str, variants: dict[str, list[str]]) -> DataFrame:
    """Ranks after the variants of a name have been added up under it."""
    table = F.create_map(*[F.lit(x) for main, others in variants.items() for other in others for x in (other, main)])
    merged = counts.groupBy(F.coalesce(table[F.col(name)], F.col(name)).alias(name)).agg(F.sum("n").alias("n"))
    return rank(merged, name)


def rolled_up(counts: DataFrame, value: str, normal) -> DataFrame:
    """A distribution over normalised values, without empty ones."""
    return counts.groupBy(normal(F.col(value)).alias(value)).agg(F.sum("n").alias("n")).where("n > 0")


def merged_shares(papers: DataFrame, journal: str, flagged: Column, original: Column, since: int, k: int = 10) -> DataFrame:
    """The leading journals since a year: all papers, flagged and original ones, under names cut to length."""
    from quillmine.functions.text import shorten

    recent = papers.where(F.col("year") >= since).where(F.col(journal) != "")
    out = recent.groupBy(journal).agg(F.count("*").alias("total"), F.count_if(flagged).alias("european"), F.count_if(original).alias("original"))
    return out.orderBy(F.desc("total"), journal).limit(k).withColumn("label", shorten(F.col(journal)))


def compared_roles(df: DataFrame, first: str, corresponding: str, last: str) -> DataFrame:
    """How often each specialty is that of the first, the corresponding and the last author, by the last."""
    roles = F.array(*[F.struct(F.lit(role).alias("role"), F.col(c).alias("specialty")) for role, c in (("first", first), ("corr", corresponding), ("last", last))])
    out = df.select(F.inline(roles)).where("specialty <> ''").groupBy("specialty")
    return out.agg(*[F.count_if(F.col("role") == r).alias(r) for r in ("first", "corr", "last")]).orderBy(F.desc("last"), "specialty")


def json_field_counts(df: DataFrame, column: str, fields: list[str], default: str = "Unclear") -> DataFrame:
    """(field, value, n) of JSON fields, blank and missing ones under a default."""
    value = lambda f: F.get_json_object(column, f"$.{f}")
    said = lambda f: F.when(F.coalesce(value(f), F.lit("")) == "", F.lit(default)).otherwise(value(f))
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), said(f).alias("value")) for f in fields])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count("*").alias("n"))


def snapshot(papers: DataFrame, records: DataFrame, fields: list[str]) -> dict:
    """A report document from small aggregates: corpus, run, distributions and leading journals."""
    from quillmine.operators.extractions import field_distribution, snapshot_summary

    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  aggregates: a row for each year, language and so on
    spread: dict[str, dict[str, int]] = {f: {} for f in fields}
    for r in field_distribution(records, fields).collect():
        spread[r["field"]][r["value"]] = r["n"]
    return {
        "corpus": {"total": papers.count(), "by_year": rows(per_year(papers)), "by_language": rows(most_common(papers, "language")), "top_journals": rows(most_common(papers, "journal", 10))},
        "run": snapshot_summary(records, papers).first().asDict(), "distributions": spread,
    }
