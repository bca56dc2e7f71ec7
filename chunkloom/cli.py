"""Command line: stage, chunk, shard, embed, index, merge-index, publish, eval."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys

from pyspark.sql import SparkSession

from chunkloom import config
from chunkloom.plans import pipeline
from chunkloom.ship import ship
from chunkloom.sources.files import MissingInput

log = logging.getLogger("chunkloom")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chunkloom")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, help_: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name, help=help_)
        s.add_argument("--config", action="append", default=[])
        return s

    s = command("stage", "read raw files, an evaluation pack and the model into the run")
    s.add_argument("--input", help="raw Parquet or JSON")
    s.add_argument("--languages", default="")
    s.add_argument("--eval-source", action="append", default=[], metavar="NAME=PATH", help="a table of the evaluation pack")
    s.add_argument("--skip-model", action="store_true")
    s.add_argument("--skip-corpus", action="store_true")
    s = command("chunk", "cut files into chunks")
    s.add_argument("--language")
    s.add_argument("--input-glob")
    s.add_argument("--out")
    s = command("shard", "deduplicate, pair, split and shard")
    s.add_argument("--language", help="only this language's chunks")
    s.add_argument("--target-chunks", type=int)
    s.add_argument("--no-pairs", action="store_true")
    s.add_argument("--eval-list")
    s = command("embed", "embed what is not embedded yet")
    s.add_argument("--shard-id", type=int, help="only this shard")
    s.add_argument("--engine")
    s.add_argument("--gpu-id", type=int, help="the device that the tasks' engines see")
    s.add_argument("--base-port", type=int, help="first port of the embedding services")
    s.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)
    s = command("index", "build the index")
    which = s.add_mutually_exclusive_group()
    which.add_argument("--shard-id", type=int)
    which.add_argument("--all", action="store_true")
    s.add_argument("--factory")
    s = command("merge-index", "one index over all shards")
    s.add_argument("--mode", choices=("ondisk", "sharded"))
    s = command("publish", "write the published views")
    s.add_argument("--repo-id", help="a path or URI that the folder is copied to")
    s.add_argument("--dry-run", action="store_true")
    s = command("eval", "score retrieval")
    s.add_argument("--split", choices=("test", "valid"), default="test")
    s.add_argument("--index", choices=("exact", "ann", "both"), default="exact")
    s.add_argument("--base-port", type=int)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 2 for missing input or arguments."""
    logging.basicConfig(stream=sys.stderr, level=os.environ.get("CHUNKLOOM_LOG", "INFO"), format="%(asctime)s %(levelname)s %(name)s %(message)s")
    a = parser().parse_args(argv)
    cfg = config.load(a.config)
    if a.command == "index" and a.shard_id is None and not a.all:
        log.error("index needs --shard-id or --all")
        return 2
    spark = ship(spark or SparkSession.builder.appName(f"chunkloom-{a.command}").getOrCreate())
    try:
        if a.command == "stage":
            if a.languages:
                cfg.corpus.languages = a.languages.split(",")
            if not a.skip_corpus and not a.input:
                log.error("stage needs --input or --skip-corpus")
                return 2
            raw = None if a.skip_corpus else spark.read.json(a.input) if a.input.endswith((".json", ".jsonl")) else spark.read.parquet(a.input)
            sources = dict(x.split("=", 1) for x in a.eval_source)
            pipeline.stage(spark, cfg, raw, sources, a.skip_corpus, a.skip_model or cfg.engine.name == "hashed_tf")
        elif a.command == "chunk":
            pipeline.chunk(spark, cfg, [a.language] if a.language else None, a.input_glob, a.out)
        elif a.command == "shard":
            log.info("%d shards", pipeline.shard(spark, cfg, a.target_chunks, not a.no_pairs, a.eval_list, languages=[a.language] if a.language else None).count())
        elif a.command == "embed":
            cfg.engine.name = a.engine or cfg.engine.name
            if a.gpu_id is not None:
                os.environ["CUDA_VISIBLE_DEVICES"] = str(a.gpu_id)
                spark.sparkContext.environment["CUDA_VISIBLE_DEVICES"] = str(a.gpu_id)
            log.info("%d rows embedded", pipeline.embed(spark, cfg, a.resume, a.shard_id, a.base_port))
        elif a.command == "index":
            log.info("index at %s", pipeline.index(spark, cfg, a.factory, a.shard_id))
        elif a.command == "merge-index":
            log.info("index at %s", pipeline.merge_index(spark, cfg, a.mode or cfg.index.merge))
        elif a.command == "publish":
            cfg.publish.repo_id = a.repo_id or cfg.publish.repo_id
            log.info("%s", pipeline.publish(spark, cfg, dry_run=a.dry_run))
        else:
            print(json.dumps(pipeline.evaluate(spark, cfg, a.split, a.index, a.base_port)))
    except MissingInput as e:
        log.error("no input: %s", e)
        return 2
    except (KeyError, ValueError, FileNotFoundError) as e:
        log.error("%s", e)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
