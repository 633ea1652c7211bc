"""CRM outreach tables: ``spark-submit visitmart/jobs/outreach.py --boxes ... --target ...``.

With ``--pipelines`` the rows carry ids, the pipeline's name and the batch time; without
it they hold the parsed columns only. The target is emptied and loaded again.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from visitmart.functions.daywindow import SHIFT_HOURS
from visitmart.plans.outreach import outreach_ods, outreach_parsed, outreach_rejects
from visitmart.session import build_session
from visitmart.sinks.load import truncate_load
from visitmart.sources.tables import named_table


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--boxes", required=True, metavar="TABLE")
    parser.add_argument("--pipelines", metavar="TABLE")
    parser.add_argument("--pipeline-id", required=True)
    parser.add_argument("--target", required=True, metavar="TABLE")
    parser.add_argument("--rejects", metavar="TABLE", help="also load the values that could not be read")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace, now: datetime) -> None:
    boxes = named_table(spark, args.boxes)
    if args.pipelines:
        batched_at = now.astimezone(timezone.utc).replace(tzinfo=None) + timedelta(hours=SHIFT_HOURS)
        rows = outreach_ods(boxes, named_table(spark, args.pipelines), args.pipeline_id, batched_at)
    else:
        rows = outreach_parsed(boxes, args.pipeline_id)
    truncate_load(rows, args.target)
    if args.rejects:
        truncate_load(outreach_rejects(boxes, args.pipeline_id), args.rejects)


def main(argv: Sequence[str] | None = None) -> None:
    run(build_session("outreach"), arguments(argv), datetime.now(timezone.utc))


if __name__ == "__main__":
    main()
