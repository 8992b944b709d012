"""Small results as files: JSON, and the sheets of a workbook."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.operators import reports as R
from quillmine.operators.extractions import field_distribution, snapshot_summary

MOST = 10_000  # rows that a download may have


def json_bytes(df: DataFrame, most: int = MOST) -> bytes:
    """The first rows as a JSON array of records; for results that a user looks at, not for tables."""
    return json.dumps([json.loads(r[0]) for r in df.limit(most).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()], ensure_ascii=False).encode()


def sheets(papers: DataFrame, records: DataFrame, fields: list[str]) -> dict[str, DataFrame]:
    """The frames behind a run's workbook: summary, years, journals and field distributions."""
    return {
        "Summary": snapshot_summary(records, papers), "Years": R.per_year(papers), "Journals": R.most_common(papers, "journal", 20),
        "Fields": field_distribution(records, fields).orderBy("field", F.desc("n"), "value"),
    }


def write_workbook(frames: dict[str, DataFrame], path: str, most: int = MOST) -> None:
    """A sheet a frame; needs openpyxl."""
    try:
        from openpyxl import Workbook
    except ImportError as e:
        raise RuntimeError("workbooks need openpyxl") from e
    book = Workbook()
    book.remove(book.active)
    for name, df in frames.items():
        sheet = book.create_sheet(name)
        sheet.append(df.columns)
        for r in df.limit(most).collect():
            sheet.append(list(r))
    book.save(path)


def dashboard(df: DataFrame, year: str, specialty: str, region: str, journal: str, study: str, order: str = "_pos") -> dict[str, DataFrame]:
    """The frames of the overview: papers by year, specialties, leading regions and journals, study types."""
    top = lambda c, k=None: R.most_common(df, c, k, order)
    return {"years": R.per_year(df.withColumnRenamed(year, "year")), "specialties": top(specialty), "regions": top(region, 8), "journals": top(journal, 10), "studies": top(study)}
