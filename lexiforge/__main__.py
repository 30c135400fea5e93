"""python -m lexiforge run|check|validate: the curation run, the checks of a dataset, and the check of its citations."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexiforge", description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    run = sub.add_parser("run")
    run.add_argument("--config", "-c")
    run.add_argument("--step", action="append", help="only these stages")
    run.add_argument("--force", action="store_true")
    run.add_argument("--retry-failed", action="store_true")
    run.add_argument("--verbose", "-v", action="store_true")
    check = sub.add_parser("check")
    check.add_argument("--file", "-f", required=True)
    valid = sub.add_parser("validate")
    for name in ("--input", "--output", "--registry", "--date"):
        valid.add_argument(name, required=True)
    valid.add_argument("--lenient", action="store_true")
    valid.add_argument("--no-context", action="store_true")
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if getattr(a, "verbose", False) else logging.INFO)
    log = logging.getLogger("lexiforge")
    spark = SparkSession.builder.appName("lexiforge").getOrCreate()

    from pyspark.sql import functions as F

    from .operators import report, temporal
    from .plans.curate import Curation
    from .plans.providers import make_providers
    from .plans.settings import Settings
    from .sources import files, sinks, storage

    if a.what == "run":
        settings = Settings.load(a.config).require()
        job = Curation(spark, settings, make_providers(settings.provider()))
        if a.retry_failed:
            job.retry_failed()
        log.info("ran: %s", ", ".join(job.run(a.step, a.force)) or "nothing")
        if job.done("evaluate"):
            q = report.quality_summary(job.read("evaluate")).first()
            log.info("health %s (%s): %s good pairs of high, %s of medium quality, %s bad ones", q.health_score, q.health_band, q.high_quality, q.medium_quality, q.low_quality)
        storage.clean(spark)
    elif a.what == "check":
        df = files.read_json(spark, a.file, files.QA).withColumn("seq", F.monotonically_increasing_id())
        for f in (report.dataset_issues, report.check_lengths, report.check_citations, report.check_format, report.distribution_totals, report.check_content):
            f(df).show(truncate=False)
    else:
        df, laws = files.read_json(spark, a.input, files.QA), files.read_registry(spark, a.registry)
        checked = temporal.validated(df, laws, a.date, not a.lenient)
        if not a.no_context:
            checked = temporal.add_context(checked, laws, a.date)
        sinks.write_validated(checked, a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
