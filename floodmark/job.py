"""One round of loading as a Spark job.

    spark-submit floodmark/job.py --store <folder> --landing <folder>

How often it runs is up to a scheduler.  The first round loads the history,
later ones what started since the last round and every alert still open.
"""

from __future__ import annotations

import argparse

from floodmark.plans import loads
from floodmark.session import build_session, size_for_inputs
from floodmark.sources.landing import DOCUMENTS, Landing
from floodmark.store import Store
from floodmark.streaming.stream_load import stream_alerts, utc_now


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load landed alerts into the store.")
    parser.add_argument("--store", required=True, help="folder of the stored tables")
    parser.add_argument("--landing", required=True, help="folder of the landed documents")
    parser.add_argument(
        "--initial-days", type=int, default=loads.INITIAL_DAYS, help="history of the first load"
    )
    parser.add_argument(
        "--max-minutes",
        type=int,
        help=f"clamp later loads to the last minutes ({loads.UPDATE_MINUTES} is usual);"
        " older alerts are then left out",
    )
    parser.add_argument(
        "--input-bytes", type=int, help="size shuffles by this instead of by the landed files"
    )
    parser.add_argument(
        "--files-per-batch", type=int, help="with --stream: files of alert pages per micro-batch"
    )
    parser.add_argument(
        "--accept-gaps", action="store_true",
        help="load batches with missing pages or details instead of waiting for them",
    )
    parser.add_argument(
        "--stream", metavar="CHECKPOINT", help="load new alert pages as a stream instead"
    )
    return parser.parse_args(words)


def main(words: list[str] | None = None) -> None:
    args = arguments(words)
    spark = build_session("floodmark-load", args.input_bytes)
    store, landing = Store(spark, args.store), Landing(spark, args.landing)
    if args.input_bytes is None:
        size_for_inputs(spark, *(landing.documents(kind) for kind in DOCUMENTS))
    now = utc_now()
    if args.stream is None:
        loads.run_cycle(
            store, landing, now, args.initial_days, args.max_minutes, not args.accept_gaps
        )
        return
    if not store.exists():
        store.create()
    loads.refresh_managed_objects(store, landing, now)
    stream = stream_alerts(
        store,
        landing,
        args.stream,
        files_per_batch=args.files_per_batch,
        wait=not args.accept_gaps,
    )
    stream.awaitTermination()


if __name__ == "__main__":
    main()
