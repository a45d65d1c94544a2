"""Command line: run a pipeline over inputs, write a configuration to start from, show steps, check a configuration."""

from __future__ import annotations

import argparse
import sys

from . import __name__ as package
from .plans.pipeline import STAGES, TEMPLATES, Config, describe, run_batch

VERSION = "0.2"


def diagram(config: Config) -> str:
    return " -> ".join(config.steps)


def ask(steps=tuple(STAGES), answer=input) -> dict:
    """A configuration from questions: which steps, then parameters whose answer is not empty."""
    import json

    chosen = [s for s in steps if answer(f"{s}? [y/N] ").strip().lower() in ("y", "yes")]
    spec: dict = {"steps": chosen}
    for s in chosen:
        for f in describe(s):
            given = answer(f"{s}.{f['name']} [{f['default']}]: ").strip()
            if given:
                try:
                    value = json.loads(given)
                except ValueError:
                    value = given
                spec.setdefault(s, {})[f["name"]] = value
    return spec


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog=package)
    parser.add_argument("--version", action="version", version=VERSION)
    verbs = parser.add_subparsers(dest="verb", required=True)
    go = verbs.add_parser("run")
    go.add_argument("input", nargs="+")
    go.add_argument("--config")
    go.add_argument("--template", choices=TEMPLATES)
    go.add_argument("--steps", help="comma-separated")
    go.add_argument("--set", action="append", default=[], metavar="step.key=value")
    go.add_argument("--output", required=True)
    go.add_argument("--batch", action="store_true")
    init = verbs.add_parser("init")
    init.add_argument("path")
    init.add_argument("--template", choices=TEMPLATES, default="basic")
    init.add_argument("--ask", action="store_true")
    info = verbs.add_parser("info")
    info.add_argument("step", nargs="?")
    check = verbs.add_parser("validate")
    check.add_argument("config")
    check.add_argument("--diagram", action="store_true")
    args = parser.parse_args(argv)
    try:
        if args.verb == "info":
            if args.step and args.step not in STAGES:
                raise ValueError(f"unknown step {args.step!r}")
            print("\n".join(f"{f['name']}: {f['type']} = {f['default']!r}" for f in describe(args.step)) if args.step else "\n".join(STAGES))
            return 0
        if args.verb == "init":
            Config.from_dict(ask() if args.ask else TEMPLATES[args.template]).save(args.path)
            return 0
        if args.verb == "validate":
            config = Config.load(args.config)
            print(diagram(config) if args.diagram else config.hash())
            return 0
        config = Config.load(args.config) if args.config else Config.from_dict(TEMPLATES[args.template] if args.template else {})
        if args.steps:
            config = Config.from_dict(config.to_dict() | {"steps": args.steps.split(",")})
        config = config.overridden(args.set)
        config = Config(config.steps, config.params, config.run | {"output_root": args.output})
        if len(args.input) > 1 and not args.batch:
            raise ValueError("several inputs need --batch")
    except (ValueError, TypeError, OSError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("ligandry").getOrCreate()
    found = run_batch(spark, args.input, config)
    for name, outcome in found.items():
        print(f"{name}: {outcome.error or outcome.path}")
    return int(any(o.error for o in found.values()))


if __name__ == "__main__":
    raise SystemExit(main())
