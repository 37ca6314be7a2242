"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR picks the test tables and BENCH_CPUS the cores.  Every query runs once to warm
up and is then timed; rows are produced in full and thrown away by the no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dumpwinnow.plans.build import build
from dumpwinnow.sources.specs import LOADED_TABLES
from sample import queries as q
from sample.catalog import dump_lines, library

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINES = (
    "load_track",
    "copy_text_decode",
    "normalize_text",
    "match_union",
    "kept_tracks_from_dump",
    "subset_track",
    "kept_sizes",
    "integrity_loaded",
    "pk_duplicates",
    "fk_orphans",
    "column_profile",
    "ci_lookup",
    "fuzzy_name_lookup",
    "fuzzy_title_lookup",
    "navigate_tracks",
    "navigate_tags",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def write_dump(spark: SparkSession, folder: str) -> str:
    """The derived catalog as dump files, many parts to a table."""
    for spec in LOADED_TABLES:
        dump_lines(spark, SF_DIR, spec.table).write.text(f"{folder}/{spec.dump_file}")
    return folder


def main() -> None:
    spark = session()
    found = q.all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        query = found[name]
        run(query(spark, SF_DIR))
        seconds[name] = timed(lambda query=query: run(query(spark, SF_DIR)))
    work = tempfile.mkdtemp(prefix="bench-")
    dump = write_dump(spark, f"{work}/dump")
    names = library(spark, SF_DIR)
    seconds["build_from_dump_files"] = timed(
        lambda: build(spark, dump, f"{work}/out", "bench", names, mode="tolerant")
    )
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
