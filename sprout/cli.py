"""Command line: ``python -m sprout --mod train|search|test ...``.

Option names and defaults follow the source command line (fixed values in
``defaults``): ``--input`` labelled lines, ``--output`` labelled lines out,
``--model`` model folder (Parquet), the six ``<param>_start/_end/_step``
triples (train uses the ``_start`` values), ``--test_sent`` for one sentence
in test mode (``--test_input`` scores a Parquet table of texts instead).
Search writes every configuration, and ``--test_input`` every scored row, as
Parquet to ``--output``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from . import defaults
from .plans.modes import search_mode, test_mode, train_mode
from .session import ensure_checkpoint_dir

# Command-line defaults (input, output and model paths, the
# test-mode sentence) and the parameter names, in loop order, with their
# (start, end, step) defaults.
DEFAULT_INPUT, DEFAULT_OUTPUT, DEFAULT_MODEL = "data/bank_final.txt", "output", "model"
DEFAULT_TEST_SENTENCE = "I go to the bank and withdraw some money"
PARAMETERS = [
    ("n", int, (defaults.N, defaults.N, 1)),
    ("m", int, (defaults.M, defaults.M, 100)),
    ("num_iter", int, (defaults.NUM_ITER, defaults.NUM_ITER, 100)),
    ("threshold", float, (defaults.THRESHOLD, defaults.THRESHOLD, 0.1)),
    ("alpha", float, (defaults.ALPHA, defaults.ALPHA, defaults.ALPHA)),
    ("delta", float, (defaults.DELTA, defaults.DELTA, defaults.DELTA)),
]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sprout")
    p.add_argument("--input", default=DEFAULT_INPUT)
    p.add_argument("--output", default=DEFAULT_OUTPUT)
    p.add_argument("--model", default=DEFAULT_MODEL)
    p.add_argument("--legacy_model", default=None, help="also write/read the (ngram,weight) text form here")
    p.add_argument("--mod", default="help", choices=["train", "search", "test", "help"])
    p.add_argument("--test_sent", default=None)
    p.add_argument("--test_input", default=None, help="Parquet table with a text column to score")
    p.add_argument("--text_col", default="text")
    p.add_argument("--key_cols", default=None, help="comma-separated key columns of --test_input")
    p.add_argument("--scala_epochs", action="store_true",
                   help="run num_iter + 1 epochs per training (the Scala loop bounds)")
    p.add_argument("--fixed_vocab", action="store_true",
                   help="train mode: keep round 1's vocabulary (the notebook variant)")
    p.add_argument("--strip_chars", type=int, default=1, help="characters dropped from each line end (3: notebook)")
    for name, kind, (start, end, step) in PARAMETERS:
        p.add_argument(f"--{name}_start", type=kind, default=start)
        p.add_argument(f"--{name}_end", type=kind, default=end)
        p.add_argument(f"--{name}_step", type=kind, default=step)
    return p


def _named(values) -> str:
    return "best configuration: " + " ".join(f"{name}={v}" for (name, _, _), v in zip(PARAMETERS, values))


def main(argv=None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    if args.mod == "help":
        print("--mod train, search or test")
        return None
    spark = spark or SparkSession.builder.appName("sprout").getOrCreate()
    ensure_checkpoint_dir(spark)
    extra = 1 if args.scala_epochs else 0
    if args.mod == "train":
        result = train_mode(spark, args.input, args.output, args.model,
                            n=args.n_start, m=args.m_start, n_iter=args.num_iter_start + extra,
                            threshold=args.threshold_start, alpha=args.alpha_start,
                            delta=args.delta_start, legacy_model_path=args.legacy_model,
                            strip_chars=args.strip_chars, refresh_vocab=not args.fixed_vocab)
        print(f"trained {len(result.models)} models; held-out accuracy {result.test_accuracy}")
        return result
    if args.mod == "search":
        ranges = {name: (getattr(args, f"{name}_start"), getattr(args, f"{name}_end"),
                         getattr(args, f"{name}_step")) for name, _, _ in PARAMETERS}
        if extra:
            start, end, step = ranges["num_iter"]
            ranges["num_iter"] = (start + extra, end + extra, step)
        results, best = search_mode(spark, args.input, strip_chars=args.strip_chars, **ranges)
        results.write.mode("overwrite").parquet(args.output)
        print(f"{results.count()} configurations written to {args.output}")
        row = best.first()
        if row is None:  # empty grid: the start values stand, with accuracy 0
            start = tuple(getattr(args, f"{name}_start") for name, _, _ in PARAMETERS)
            print(_named(start), "accuracy=0.0")
        else:
            print(_named((row.n, row.m, row.num_iter, row.threshold, row.alpha, row.delta)), f"accuracy={row.accuracy}")
        return results, best
    model_path = args.legacy_model or args.model
    if args.test_input:
        texts = spark.read.parquet(args.test_input)
        keys = args.key_cols.split(",") if args.key_cols else [texts.columns[0]]
        out = test_mode(spark, model_path, texts, keys, text=args.text_col, legacy=bool(args.legacy_model))
        out.write.mode("overwrite").parquet(args.output)
        out = spark.read.parquet(args.output)
        print(f"{out.count()} scored rows written to {args.output}")
        return out
    sentence = args.test_sent if args.test_sent is not None else DEFAULT_TEST_SENTENCE
    texts = spark.createDataFrame([(0, sentence)], "id long, text string")
    out = test_mode(spark, model_path, texts, ["id"], legacy=bool(args.legacy_model))
    row = out.first()
    print(f"{row.label} {row.score}")
    return out
