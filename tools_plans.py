"""Write condensed physical plans of the main jobs to PLANS.md.

Long constant lookups and weight vectors are elided. Run:
    python tools_plans.py /root/testdata/sf0.1
"""

import re
import sys

from pyspark.sql import functions as F

from sprout.operators import Vocabulary, featurize, select_vocab
from sprout.operators.gradient import gradient
from sprout.operators.vocab import class_counts_with_totals, rank_vocab, tokenized
from sprout.plans.search import _group_counts
from sprout.plans.selftrain import score_rows
from sprout.plans.train import train_model
from sprout.session import build_session
from sprout.sources import sentences, split_train_test


def condensed(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = re.sub(r"\[keys: .*?\]\]", "[<lookup>]", plan, flags=re.S)
    plan = re.sub(r"\[(-?[0-9.E-]+,){20,}[^\]]*\]", "[<weights>]", plan)
    plan = re.sub(r"'(-?[0-9.E-]+,){20,}[^']*'", "'<weights>'", plan)
    return "\n".join(line if len(line) < 200 else line[:197] + "..." for line in plan.splitlines())


def main(sf_dir: str) -> None:
    spark = build_session(conf={"spark.ui.showConsoleProgress": "false"})
    train, test = split_train_test(sentences(spark, sf_dir))
    vocab = Vocabulary.from_frame(select_vocab(train, 1, 400), 1)
    model, _ = train_model(train, vocab, 1, 0.002, 0.05)
    rows = tokenized(train, 1)
    counts = class_counts_with_totals(rows, F.col("label"))
    feats = featurize(train.where("label != 0"), vocab)
    sections = [
        ("Class counts of the labelled rows, totals under the NULL N-gram", counts),
        ("Top-m vocabulary by information gain", rank_vocab(counts, 100, 20, 400)),
        ("Featurization (constant lookup, no exchange)", feats),
        ("One gradient step (DataFrame form; the loop runs it over columnar blocks)",
         gradient(feats.select("label", "fids"), model.weights, 0.002)),
        ("Held-out scoring", score_rows(test, model)),
        ("Search: class counts of four configurations in one aggregation",
         _group_counts(rows.select("sent_id", "ng", F.array_repeat("label", 4).alias("labs")), [0, 1, 2, 3])),
    ]
    out = ["# Physical plans", "", f"Generated by `tools_plans.py` on `{sf_dir}`, local[8], AQE on "
           "(initial plans; lookups and weight vectors elided).", ""]
    for title, df in sections:
        out += [f"## {title}", "", "```", condensed(df), "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
