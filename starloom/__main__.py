"""Command line for the batch jobs (``spark-submit -m``-style entry).

    python -m starloom vaccination-ingest --raw '<raw>/vacinacao/*.csv' --out <prestructured>/vacinacao
    python -m starloom vaccination-deliver --root <raw>/vacinacao --layer <prestructured>/vacinacao [--drop-withdrawn]
    python -m starloom vaccination-tables --prestructured ... --localities ... --out .../structured/vacinacao
    python -m starloom srag-ingest --source 2020=.../INFLUD20.csv --source 2021=... [--year 2021] --out ...
    python -m starloom deaths --prestructured ... --out ...
    python -m starloom notifications --raw '.../not_srag/*.csv' --out ...
    python -m starloom population --census .../tabela3175.csv --out .../structured
    python -m starloom calendar --out .../structured/tempo/dm_data [--start 2021-01-01 --end 2023-02-01]

Before the job: --state-code, --state-name, --first-day and --ages restrict the
tables (the source system's state, days and ages by default).

The session comes from the environment (``spark-submit`` / cluster config).
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from .plans import jobs
from .plans import vocab as V
from .plans.star import Scope


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="starloom")
    ap.add_argument("--source-caps", action="store_true",
                    help="cap fact output files as the source system did (small data only)")
    ap.add_argument("--state-code", default=V.STATE_CODE, help="letters of the state in the data")
    ap.add_argument("--state-name", default=V.STATE_NAME, help="its name in the localities")
    ap.add_argument("--first-day", default=V.FIRST_DOSE_DAY, help="first day of the vaccination fact")
    ap.add_argument("--ages", default=f"{V.AGE_MIN}-{V.AGE_MAX}", help="MIN-MAX, inclusive")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("vaccination-ingest")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("vaccination-deliver")
    p.add_argument("--root", required=True, help="folder of the raw files, at any depth")
    p.add_argument("--layer", required=True)
    p.add_argument("--drop-withdrawn", action="store_true", help="files that are gone lose their rows")
    p = sub.add_parser("vaccination-tables")
    p.add_argument("--prestructured", required=True)
    p.add_argument("--localities", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--one-name", action="store_true", help="one row a code: the description of most rows")
    p.add_argument("--versioned", action="store_true", help="replace each table atomically")
    p = sub.add_parser("srag-ingest")
    p.add_argument("--source", action="append", required=True, help="YEAR=PATH")
    p.add_argument("--year", action="append", type=int, default=[], help="repeatable; 0 or none = every year")
    p.add_argument("--fill", default=None)
    p.add_argument("--out", required=True)
    p = sub.add_parser("deaths")
    p.add_argument("--prestructured", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("notifications")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("population")
    p.add_argument("--census", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("calendar")
    p.add_argument("--out", required=True)
    p.add_argument("--start", default=V.CALENDAR_START)
    p.add_argument("--end", default=V.CALENDAR_END)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"starloom-{a.job}").getOrCreate()
    low, high = (int(x) for x in a.ages.split("-"))
    scope = Scope(a.state_code, a.state_name, a.first_day, low, high)
    fact_cap = V.MAX_FILES_FACT if a.source_caps else None
    if a.job == "vaccination-ingest":
        result = {"rows": jobs.ingest_vaccination(spark, a.raw, a.out)}
    elif a.job == "vaccination-deliver":
        result = dataclasses.asdict(jobs.deliver_vaccination(spark, a.root, a.layer, drop_withdrawn=a.drop_withdrawn))
    elif a.job == "vaccination-tables":
        result = jobs.build_vaccination_tables(spark, a.prestructured, a.localities, a.out, scope,
                                               max_files=fact_cap, one_name=a.one_name, versioned=a.versioned)
    elif a.job == "srag-ingest":
        sources = {int(y): path for y, path in (s.split("=", 1) for s in a.source)}
        years = [y for y in a.year if y != 0] or None
        result = {"rows": jobs.ingest_srag(spark, sources, a.out, years, a.fill, scope=scope)}
    elif a.job == "deaths":
        result = jobs.build_deaths_fact(spark, a.prestructured, a.out, fact_cap, scope) or {"out": a.out}
    elif a.job == "notifications":
        result = jobs.build_notification_fact(spark, a.raw, a.out, fact_cap, scope=scope) or {"out": a.out}
    elif a.job == "population":
        result = jobs.build_population(spark, a.census, a.out,
                                       V.MAX_FILES_POPULATION if a.source_caps else None, scope)
    else:
        result = jobs.build_calendar(spark, a.out, a.start, a.end) or {"out": a.out}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
