"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from quillmine.queries.literature import QUERIES

HEADLINE = ["xml_split_parse", "parsed_papers_by_year", "dedup_doi", "dedup_title_exact", "dedup_fuzzy_pairs", "dedup_full", "filter_keyword_tag", "explore_first", "explore_random", "explore_stride", "run_summary", "extraction_latest_wins", "field_distribution", "funding_top10", "year_category_share", "country_topk", "apc_by_country", "json_repair_chain", "affiliation_parse", "author_block"]


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = dict(QUERIES)
    names = list(HEADLINE)
    try:
        from quillmine.llm.queries import QUERIES as more

        found |= more
        names += sorted(more, key=lambda n: int(n[2:].split("_")[0]))
    except ImportError:
        pass
    QUERIES["papers_by_year"](spark, folder).collect()  # the first query pays for starting up
    times = {}
    for name in names:
        begun = time.time()
        found[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - begun, 3)
    print(json.dumps({"metric": "total wall-clock of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
