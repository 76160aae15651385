"""Command line: check a specification, and run one of its pipelines.

    python -m maskflow -f metastore.yml                   check only
    python -m maskflow -f metastore.yml -r <pipeline id>  run until stopped
    python -m maskflow -f metastore.yml -r <id> --available-now
"""

from __future__ import annotations

from argparse import ArgumentParser

from .plans.loader import run_loader
from .plans.pipeline import run_stream
from .session import get_session
from .spec import LoaderPipeline, Store
from .streaming import MemorySink

_PREVIEW_ROWS = 30


def main(arguments: list[str] | None = None) -> None:
    parser = ArgumentParser(prog="maskflow", description=__doc__.splitlines()[0])
    parser.add_argument("-f", "--filepath", help="path to a YAML specification")
    parser.add_argument("-r", "--run", help="id of the pipeline to run")
    parser.add_argument("--checkpoint", help="checkpoint folder, in place of the usual one")
    parser.add_argument(
        "--available-now", action="store_true", help="stop when the source is used up"
    )
    args = parser.parse_args(arguments)
    store = Store.load(filepath=args.filepath)
    if args.run:
        pipeline = store.pipeline(args.run)
        print(f"Running {args.run!r}")
        spark = get_session(args.run)
        if isinstance(pipeline, LoaderPipeline):
            bad = run_loader(spark, store, args.run)
            where = "in the quarantine" if pipeline.quarantine_filepath_env else "not kept"
            print(f"Lines left out: {bad.count()}, {where}")
            for line in bad.take(_PREVIEW_ROWS):
                why = "; ".join(": ".join(filter(None, reason)) for reason in line["reasons"])
                print(f"{line['value']}  [{why}]")
        else:
            run = run_stream(
                spark,
                store,
                args.run,
                available_now=args.available_now,
                checkpoint=args.checkpoint,
            )
            if isinstance(run.data_sink, MemorySink) and not args.available_now:
                for snapshot in run.snapshots(n=_PREVIEW_ROWS):
                    snapshot.show(_PREVIEW_ROWS, truncate=False)
                run.stop()
            else:
                run.await_termination()
    print("Completed.")


if __name__ == "__main__":
    main()
