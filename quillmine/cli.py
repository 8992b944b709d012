"""quillmine run | inspect | status | import-legacy"""

from __future__ import annotations

import argparse
import json

from quillmine import files
from quillmine.plans import config as C


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quillmine")
    parser.add_argument("--output", default=None, help="folder of the spine and the logs")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="run the configured steps")
    run.add_argument("--config")
    run.add_argument("--steps", help="comma-separated")
    run.add_argument("--progress", choices=["json", "tty", "log"], default="json")
    commands.add_parser("inspect", help="metadata of a step, or of all").add_argument("step", nargs="?")
    commands.add_parser("status", help="the spine's rows and columns")
    commands.add_parser("import-legacy", help="batch files of a folder").add_argument("folder")
    args = parser.parse_args(argv)
    overrides: dict = {"general": {}}
    if args.output:
        overrides["general"]["output_dir"] = args.output
    if getattr(args, "steps", None):
        overrides["general"]["steps"] = args.steps.split(",")
    config = C.load(getattr(args, "config", None), overrides)
    folder = config["general"]["output_dir"]
    if args.command == "inspect" and args.step:
        print(files.read_text(f"{folder}/step_log/{args.step}_meta.json") or f"no metadata of step {args.step}")
        return 0
    from quillmine.plans import steps

    if args.command == "inspect":
        print(json.dumps(steps.step_logs(f"{folder}/step_log")))
        return 0
    from pyspark.sql import SparkSession

    from quillmine.sources.batches import import_folder
    from quillmine.spine import Spine

    spine = Spine(SparkSession.builder.appName("quillmine").getOrCreate(), f"{folder}/papers")
    if args.command == "status":
        print(json.dumps(spine.inspect()))
    elif args.command == "import-legacy":
        print(json.dumps(import_folder(spine, args.folder)))
    else:
        steps.run(spine, config, f"{folder}/step_log", steps.reporter(args.progress))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
