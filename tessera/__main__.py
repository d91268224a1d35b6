"""The command line: label the images below a folder with the models of a configuration."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from .plans import consensus
from .session import session
from .sources import clients, sinks, tasks


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tessera", description="Ask several models about images and reconcile what they say.")
    for name, default in (("data-dir", "data"), ("output-dir", "outputs"), ("models-config", "configs/models.yaml"),
        ("prompts-config", "configs/prompts.yaml")):
        parser.add_argument(f"--{name}", default=default)
    parser.add_argument("--mock", action="store_true", help="ask mock models only")
    parser.add_argument("--overwrite", action="store_true", help="delete files of an earlier run first")
    for name, default in (("limit", None), ("concurrent-models", 3), ("concurrent-images", 1), ("request-timeout", 120), ("retry", 0)):
        parser.add_argument(f"--{name}", type=int, default=default)
    return parser.parse_args(words)


def run(spark, args: argparse.Namespace) -> int:
    """Do what the arguments say; 0 also where there is nothing to do."""
    prompt = tasks.prompt(args.prompts_config)
    models, left_out = tasks.usable_models(tasks.model_configs(spark, args.models_config), args.mock, args.request_timeout)
    for row in left_out.orderBy("place").collect():
        print(f"Skipping {row.reason} model config {row.name!r} with provider {row.provider!r}")
    known = models.orderBy("place").collect()
    if not known:
        print("No enabled models found for the current run")
        return 0
    images = tasks.image_tasks(spark, args.data_dir)
    images = images if args.limit is None else tasks.first_tasks(images, args.limit)
    if images.isEmpty():
        print("No images found in data directory")
        return 0
    sinks.prepare(spark, args.output_dir, args.overwrite)
    at_once, retries = max(1, args.concurrent_models), max(0, args.retry)
    requests = tasks.calls(images, models)
    answers = tasks.mock_answers(requests.filter("provider = 'mock'"))
    if any(m.provider != "mock" for m in known):
        real = requests.filter("provider <> 'mock'").repartition(max(1, args.concurrent_images))
        own = lambda row, text: clients.answer(json.loads(row["config"]) | {"timeout": row["timeout"]}, row["path"], text)
        said = tasks.ask(real, own, prompt, retries, concurrent=at_once)
        answers = answers.unionByName(said.drop("latency_ms"), allowMissingColumns=True)
    out = consensus.consensus(answers, images)
    records = consensus.materialized(out["records"], "records")
    for tree, text in ((sinks.WHOLE, "whole"), (sinks.FINAL, "final")):
        sinks.write_items(records.select("item", F.col(text).alias("text")), f"{args.output_dir.rstrip('/')}/{tree}")
    total = sinks.write_summary(out["summary"].join(images.select("item", "path"), "item"), args.output_dir)
    stats = {r.decision: r.n for r in consensus.run_stats(out["decisions"]).collect()}
    print(f"total images: {total}")
    for decision in ("accepted", "review", "failed"):
        print(f"{decision}: {stats.get(decision, 0)}")
    print(f"output path: {args.output_dir}")
    return 0


if __name__ == "__main__":
    raise SystemExit(run(session(), arguments()))
