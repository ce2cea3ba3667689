"""Command line: process, run-stage, eval, kb-ingest, kb-search."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from chalkline import config, profile
from chalkline.errors import ChalklineError, StageUnavailable
from chalkline.operators.frames import DEFAULT_LIMIT
from chalkline.memory import remembering
from chalkline.plans import jobs
from chalkline.providers import Offline, OpenAI
from chalkline.scratch import seen_by_all
from chalkline.sources import store


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="chalkline", description=__doc__)
    verbs = out.add_subparsers(dest="verb", required=True)

    def verb(name: str, *positional: str, many: str | None = None) -> argparse.ArgumentParser:
        sub = verbs.add_parser(name)
        for p in positional:
            sub.add_argument(p)
        if many:
            sub.add_argument(many, nargs="+")
        sub.add_argument("--verbose", "-v", action="store_true", help="log what each step does")
        sub.add_argument("--offline", action="store_true", help="answer by fixed rules instead of hosted models")
        return sub

    for sub in (p := verb("process", "video"), s := verb("run-stage", "stage"), e := verb("eval")):
        sub.add_argument("--profile", "-p", default="generic")
    p.add_argument("--out", "-o", required=True)
    for sub in (s, e):
        sub.add_argument("--job", "-j", required=True)
    for sub in (p, s):
        sub.add_argument("--max-cost", type=float, default=DEFAULT_LIMIT)
    e.add_argument("--grounding-n", type=int, default=5)
    e.add_argument("--run-commands", action="store_true", help="let the profile's command run over extracted code")
    i, q = verb("kb-ingest", many="jobs"), verb("kb-search", "query")
    for sub in (i, q):
        sub.add_argument("--collection", "-c", required=True)
    q.add_argument("--k", type=int, default=8)
    return out


def dotenv(path: str = ".env") -> None:
    """Variables of a file that are not set already."""
    import os

    if Path(path).is_file():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, mark, value = line.partition("=")
            if mark and not line.lstrip().startswith("#"):
                os.environ.setdefault(name.strip(), value.strip().strip("'\""))


def log_to_stderr(verbose: bool = False) -> None:
    """This package's messages, with their time and level; debug messages too if ``verbose``."""
    own = logging.getLogger("chalkline")
    if not own.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        own.addHandler(handler)
    own.setLevel(logging.DEBUG if verbose else logging.INFO)


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    settings = config.load()
    provider = Offline() if args.offline else None
    memory = lambda p: remembering(p, seen_by_all(spark, settings.cache_dir))
    if args.verb in ("process", "run-stage", "eval"):
        chosen = profile.load(args.profile)
    if args.verb == "process":
        for r in jobs.process(spark, args.video, args.out, settings, chosen, provider=provider, max_cost=args.max_cost):
            print(f"{r.name}: {r.status} ({r.detail})")
    elif args.verb == "run-stage":
        jobs.run_stage(spark, args.stage, args.job, settings, chosen, provider=provider, max_cost=args.max_cost)
        print(f"{args.stage}: done")
    elif args.verb == "eval":
        judge = provider or (OpenAI(settings.openai_api_key) if settings.openai_api_key else None)
        print(jobs.evaluate_job(spark, args.job, settings, chosen, provider=judge, grounding_n=args.grounding_n, run_commands=args.run_commands))
    else:
        kept = store.build(settings.vector_store, spark, settings.kb_dir)
        if args.verb == "kb-ingest":
            n = jobs.ingest_jobs(spark, args.jobs, args.collection, kept, memory(provider or OpenAI(settings.openai_api_key)), settings.embed_model)
            print(f"{n} note(s) into {args.collection}")
        else:
            embedder = provider or (OpenAI(settings.openai_api_key) if settings.openai_api_key else None)
            rows = jobs.search_collection(spark, args.query, kept, args.collection, memory(embedder) if embedder else None, settings.embed_model, args.k).collect()
            for r in rows:
                print(f"{r.score:.4f}  {r.concept}  [{r.source_video} @ {r.source_timestamp:.0f}s]  {r.summary}")
            if not rows:
                print("Nothing found.")
    return 0


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    log_to_stderr(args.verbose)
    dotenv()
    spark = SparkSession.builder.appName("chalkline").getOrCreate()
    try:
        return run(args, spark)
    except StageUnavailable as error:
        print(f"error: {error}", file=sys.stderr)
        return 2
    except (ChalklineError, FileNotFoundError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
